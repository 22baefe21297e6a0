"""SimHash near-duplicates by pigeonhole blocks.

Defined results: null, empty and blank texts have fingerprint zero and are
linked like any other; a text with fewer words than a shingle is one shingle;
repeated rows and equal texts share a fingerprint; an empty table gives an empty
one; columns besides the id and the text are ignored.  A null id never becomes
a component's name unless the component has no other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from quarrymill.llm.common import WORD, components, fresh, quoted, small_batches, written

SHINGLE, DISTANCE, PIECES, SEED = 3, 2, 5, 42
HASHES = 1 << 18  # of shingles, held at once by a task
BLOCK_PAIRS = 64  # blocks with more fingerprints are linked by neighbour keys
_LANE = np.uint64(0x0101010101010101)
_WORDS = re.compile(WORD.encode())
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, at most ``HASHES`` at a time."""
    found = (m.group() for m in _WORDS.finditer(text.encode().translate(_LOWER)))
    if len(text) <= HASHES:
        found = iter(_WORDS.findall(text.encode().translate(_LOWER)))
    words = list(islice(found, HASHES))
    if 0 < len(words) < shingle:
        yield np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    while len(words) >= shingle:
        joined = words if shingle == 1 else map(b" ".join, zip(*(words[i:] for i in range(shingle))))
        yield np.fromiter(map(xxh64_intdigest, joined, repeat(SEED)), np.uint64, len(words) - shingle + 1)
        rest = list(islice(found, HASHES))
        words = words[len(words) - shingle + 1:] + rest if rest else []


def bit_counts(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of each document's hashes have each of the 64 bits.

    ``hashes`` holds all documents' hashes in a row, ``ends`` where each stops.
    Eight counters share a 64-bit lane, flushed before one can pass 255.
    """
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    sizes = ends - starts
    out = np.zeros((len(ends), 64), np.int64)
    full = np.flatnonzero(sizes > 0)
    if not len(full):
        return out
    starts, sizes = starts[full], sizes[full]
    runs = -(-sizes // 255)
    owner = np.repeat(np.arange(len(full)), runs)
    first = np.cumsum(runs) - runs
    cuts = starts[owner] + 255 * (np.arange(len(owner)) - first[owner])
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANE, cuts)
        counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
        out[full, k::8] = counts
    return out


def _words_of(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    over = 2 * counts > sizes[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def majority(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit word per document: bits set in over half of its hashes."""
    return _words_of(bit_counts(hashes, ends), np.diff(ends, prepend=0))


def fingerprints(texts, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit SimHashes; no more than some ``HASHES`` hashes are held at once, however long the texts."""
    n = len(texts)
    counts, sizes = np.zeros((n, 64), np.int64), np.zeros(n, np.int64)
    parts, owners, held = [], [], 0

    def settle():
        if parts:
            lengths = np.array([len(p) for p in parts])
            np.add.at(counts, owners, bit_counts(np.concatenate(parts), np.cumsum(lengths)))
            np.add.at(sizes, owners, lengths)

    for i, text in enumerate(texts):
        for part in _hashes(text, shingle) if text else ():
            parts.append(part)
            owners.append(i)
            held += len(part)
            if held >= HASHES:
                settle()
                parts, owners, held = [], [], 0
    settle()
    return _words_of(counts, sizes)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """The signed 64-bit SimHash of a text column."""

    @F.pandas_udf("bigint")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts, shingle).view(np.int64))

    return simhash(text)


def _pieces(pieces: int) -> list[tuple[int, int]]:
    """(shift, mask) of each piece of 64 bits."""
    limits = [64 * i // pieces for i in range(pieces + 1)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(limits, limits[1:])]


def _mask(parts, pieces: int) -> int:
    whole = sum(_pieces(pieces)[p][1] << _pieces(pieces)[p][0] for p in parts)
    return whole - (1 << 64) if whole >> 63 else whole


def links(prints: DataFrame, distance: int = DISTANCE, pieces: int = PIECES,
          block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """Edges ``(u, v)`` whose closure links all distinct fingerprints within ``distance`` bits.

    ``prints`` has one row ``fp`` per distinct fingerprint.  ``distance`` changed
    bits leave at least ``pieces - distance`` pieces whole, so a close pair
    agrees in one of the blocks made of that many pieces.  Blocks of up to
    ``block_pairs`` fingerprints are joined with themselves and verified.  In a
    larger one, a third of all fingerprints may meet, so pairs are not listed:
    two fingerprints within two bits are both within one bit of some value, and
    each member is tied to the smallest one at every such value.  At most 65
    members can share a value, and the ties have the same closure.
    """
    if distance != 2:
        raise ValueError("large blocks are tied through values one bit away, which covers two bits")
    chosen = list(combinations(range(pieces), pieces - distance))
    blocks = F.array(*[
        F.struct(F.lit(i).cast("tinyint").alias("block"),
                 F.col("fp").bitwiseAND(F.lit(_mask(c, pieces))).alias("key"))
        for i, c in enumerate(chosen)
    ])
    rows = prints.select("fp", F.explode(blocks).alias("b")).select("fp", "b.block", "b.key")
    sizes = rows.groupBy("block", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = written(rows.join(sizes, ["block", "key"]), "simhash-blocks")

    small = shared.where(F.col("n") <= block_pairs)
    one = small.select("block", "key", F.col("fp").alias("u"))
    two = small.select("block", "key", F.col("fp").alias("v"))
    near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= distance
    paired = one.join(two, ["block", "key"]).where((F.col("u") < F.col("v")) & near).select("u", "v")

    bit = [1 << i if i < 63 else -(1 << 63) for i in range(64)]
    crowded = shared.where(F.col("n") > block_pairs).select("fp").distinct()
    ties = crowded.select(
        "fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(b)) for b in bit])).alias("via")
    )
    centres = ties.groupBy("via").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1")
    tied = ties.join(centres, "via").where("u <> fp").select("u", F.col("fp").alias("v"))
    return paired.union(tied).distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fp`` (signed), ``root`` (a fingerprint of the component) and ``component_id``.

    One row per input row.  Documents meet only through distinct fingerprints
    with their smallest id, so a group of copies of any size is one row in the
    search.
    """
    prints = written(
        small_batches(df).select(quoted(id_col).alias("doc_id"), fingerprint(quoted(text_col), shingle).alias("fp")),
        "simhash-prints",
    )
    return grouped(prints)


def grouped(prints: DataFrame) -> DataFrame:
    """:func:`near_duplicates` of a table of ``doc_id, fp``; its other columns stay."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp")))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    table = written(named.join(least, "root").select("fp", "root", "component_id"), "simhash-components")
    return prints.join(table, "fp").select(*prints.columns, "root", "component_id")


def hex_digits(fp: Column) -> Column:
    """16 lowercase hexadecimal digits of a signed 64-bit word."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, the one with the smallest id; all columns stay.

    The search writes ids, fingerprints and hashes of texts, no texts.  A row that stays is
    known by its id and 128 bits of hash of its text, so texts are shuffled once, to meet these.
    Where several rows share that id and fingerprint, one of them stays.
    """
    mine, *tags = fresh(df, "near_id", "tag", "tag2")
    own = fresh(df.select("*", *[F.lit(0).alias(t) for t in tags]), "own_tag", "own_tag2")
    text = quoted(text_col)
    hashes = dict(zip(own, [F.xxhash64(text), F.xxhash64(F.lit(17), text)]))
    prints = written(
        small_batches(df).select(
            quoted(id_col).alias("doc_id"), fingerprint(text, shingle).alias("fp"),
            *[h.alias(t) for t, h in zip(tags, hashes.values())]),
        "simhash-prints",
    )
    keepers = written(
        grouped(prints).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("doc_id", "root").agg(F.min(F.struct("fp", *tags)).alias("row"), F.count("*").alias("rows")),
        "simhash-keepers",
    )
    sides = keepers.select(F.col("doc_id").alias(mine), *[F.col("row")[t].alias(t) for t in tags])
    same = quoted(id_col).eqNullSafe(F.col(mine))
    for t, o in zip(tags, own):
        same &= F.col(t) == F.col(o)
    kept = df.withColumns(hashes).join(sides, same)
    if not keepers.where("rows > 1").isEmpty():
        kept = kept.dropDuplicates([mine, *own])
    return kept.drop(mine, *tags, *own)
