"""Ranked lexical search with term bounds tightened by pairs (pair-bound MaxScore).

The documents are reduced, where they are read, to the terms that any item asks for: one
row per document with its length and term counts.  From these come the statistics, for
every term its largest impact and its best documents, and for pairs of terms that
items often ask for together the *joint* largest impact over the documents that hold both.

An item's terms are paired where a pair's bound lies below the sum of its terms' bounds.
The units (pairs and single terms) with the least bounds, as long as their sum is below
a score that fifty documents are known to reach, cannot lift a document into the answer
alone: only documents with one of the other, *essential* terms are looked at.  Of those, the
ones whose essential score and the bound of the rest fall short are passed over, and
what remains is scored in full.  Every step compares safe bounds, so the answer is exact.

Defined results: null and empty texts have no term and are no documents of the
statistics; an item without any term, or whose terms no document holds, gives no row; rows that repeat an id
are documents of their own, ordered by id (nulls first) and then by row; items that share an id are searched as one
item with the terms of all, and items without an id are not searched; very long texts are read whole; other columns are ignored; an empty table gives an empty answer.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from quarrymill.llm.common import ascii_lower, quoted, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 50
PARTNERS = 4  # pairs kept per term, those that most items ask for; more only tighten bounds
SIEVE = 1 << 20  # bits of the table by which words that no item asks for are passed over: its size is fixed
SLICE_BYTES = 8 << 20
_TERM = re.compile(TERM)
_LOWER = {c: c + 32 for c in range(65, 91)}
_FORWARD = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.string())), ("tfs", pa.list_(pa.int64()))])


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``item_id, term``."""
    found = F.regexp_extract_all(ascii_lower(quoted(text_col)), F.lit(TERM), F.lit(0))
    return items.select(quoted(id_col).alias("item_id"), F.explode(found).alias("term")).distinct()


def _reduce(batches, sieve: bytes):
    """Documents as counts of the terms that pass the sieve; a few more may pass than items ask for."""
    last = len(sieve) * 8 - 1
    for batch in batches:
        step = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            ids, sizes, terms, tfs = part.column(0).to_pylist(), [], [], []
            for text in part.column(1).to_pylist():
                words = _TERM.findall(text.translate(_LOWER)) if text else []
                wanted = []
                for word, n in Counter(words).items():
                    bit = zlib.crc32(word.encode()) & last
                    if sieve[bit >> 3] >> (bit & 7) & 1:
                        wanted.append((word, n))
                sizes.append(len(words))
                terms.append([w for w, _ in wanted])
                tfs.append([n for _, n in wanted])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(terms, pa.list_(pa.string())), pa.array(tfs, pa.list_(pa.int64()))], schema=_FORWARD)


def _sieve(vocabulary: DataFrame, bits: int = SIEVE) -> bytes:
    """One bit per hash of a wanted term: at most ``bits`` numbers reach the driver, whatever the vocabulary."""
    made = bytearray(bits // 8)
    hashed = vocabulary.select(F.crc32(F.col("term").cast("binary")).bitwiseAND(F.lit(bits - 1)).alias("bit")).distinct()
    for row in hashed.collect():
        made[row["bit"] >> 3] |= 1 << (row["bit"] & 7)
    return bytes(made)


def forward(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, n`` and ``counts`` (arrays of term and number), a written table."""
    rows = docs.select(quoted(id_col).cast("bigint").alias("doc_id"), quoted(text_col).alias("text"))
    reduced = rows.mapInArrow(partial(_reduce, sieve=_sieve(vocabulary)),
                              "doc_id long, n long, terms array<string>, tfs array<long>").where("n > 0")
    return written(reduced.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n",
        F.arrays_zip(F.col("terms").alias("term"), F.col("tfs").alias("tf")).alias("counts")), "search-forward")


def _postings(table: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """``row, doc_id, term, gain``: the gain is a term's impact before its weight."""
    m = F.expr(f"50 + cast((50 * cast(n as decimal(38, 0)) * {n_docs}) div {max(1, n_terms)} as bigint)")
    each = table.select("row", "doc_id", m.alias("m"), F.explode("counts").alias("c"))
    return each.select("row", "doc_id", F.col("c.term").alias("term"),
                       F.expr("(1000000000 * c.tf) div (1000 * c.tf + 20 * m)").alias("gain"))


def pairs_asked(asked: DataFrame, terms: DataFrame, partners: int = PARTNERS) -> DataFrame:
    """``one, two``: for each term the neighbours that most items put beside it.

    The terms of an item are lined up by their bound, and those next to each other pair up, so a long
    item gives as many pairs as it has terms.  Each term keeps ``partners`` of them with terms of larger bound.
    """
    line = asked.join(terms.select("term", "bound"), "term")
    place = Window.partitionBy("item_id").orderBy("bound", "term")
    beside = line.select("item_id", F.col("term").alias("one"), *[
        F.lead("term", k).over(place).alias(f"next{k}") for k in (1, 2, 3)])
    both = beside.select("one", F.explode(F.array("next1", "next2", "next3")).alias("two")).where("two is not null")
    asked_for = both.groupBy("one", "two").agg(F.count("*").alias("items"))
    best = Window.partitionBy("one").orderBy(F.desc("items"), "two")
    return asked_for.withColumn("place", F.row_number().over(best)).where(F.col("place") <= partners).select("one", "two")


def joint_bounds(line: DataFrame, pairs: DataFrame) -> DataFrame:
    """``one, two, joint``: the largest sum of two terms' impacts over the documents that hold both.

    ``line`` has the postings ``row, term, impact``, dealt out by row.  The intersection lists are
    built where a document's postings lie, so only one maximum per pair and task is shuffled.
    """
    numbered = written(pairs.select(F.monotonically_increasing_id().alias("pair"), "one", "two"), "search-asked-pairs")
    sides = numbered.select("pair", F.explode(F.array("one", "two")).alias("term"))
    lists = line.join(sides, "term").groupBy("row", "pair").agg(F.count("*").alias("n"), F.sum("impact").alias("joint"))
    return lists.where("n = 2").groupBy("pair").agg(F.max("joint").alias("joint")).join(numbered, "pair").drop("pair")


def units(asked: DataFrame, pairs: DataFrame) -> DataFrame:
    """``item_id, unit, bound, terms``: the pairs and single terms that an item's bound is made of.

    A pair is used where it saves the most of all pairs of either of its terms, so no term is in two.
    ``asked`` has the items' terms with their ``bound``, ``pairs`` the ``one, two, saving, both``.
    """
    one = asked.select("item_id", F.col("term").alias("one"))
    two = asked.select("item_id", F.col("term").alias("two"))
    there = one.join(pairs, "one").join(two, ["item_id", "two"])
    rank = (F.desc("saving"), "one", "two")
    sided = there.select("*", F.explode(F.array("one", "two")).alias("side"))
    first = sided.withColumn("place", F.row_number().over(Window.partitionBy("item_id", "side").orderBy(*rank)))
    used = first.where("place = 1").groupBy("item_id", "one", "two").agg(
        F.count("*").alias("sides"), F.min("both").alias("bound")).where("sides = 2")
    used = written(used.select("item_id", "one", "two", "bound"), "search-units")
    taken = used.select("item_id", F.explode(F.array("one", "two")).alias("term"))
    alone = asked.join(taken, ["item_id", "term"], "left_anti").select(
        "item_id", F.col("term").alias("unit"), "bound", F.array("term").alias("terms"))
    return used.select("item_id", F.col("one").alias("unit"), "bound", F.array("one", "two").alias("terms")).union(alone)


def _best(scores: DataFrame, top: int) -> DataFrame:
    """An item's ``top`` best rows, for items with so many."""
    place = Window.partitionBy("item_id").orderBy(F.desc("score"), "row")
    first = scores.withColumn("place", F.row_number().over(place)).where(F.col("place") <= top)
    full = first.where(F.col("place") == top).select("item_id")
    return first.join(full, "item_id").drop("place")


def _in_full(chosen: DataFrame, impacts: DataFrame, asked: DataFrame) -> DataFrame:
    """Whole scores of chosen ``item_id, row``."""
    held = chosen.select("item_id", "row").join(impacts, "row").select(
        "item_id", "row", "doc_id", F.explode("impacts").alias("term", "impact"))
    return held.join(asked, ["item_id", "term"]).groupBy("item_id", "row", "doc_id").agg(F.sum("impact").alias("score"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, partners: int = PARTNERS,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``item_id, rank, doc_id, score`` of every item's ``top`` best documents with a score above zero."""
    asked = written(item_terms(items), "search-asked")
    vocabulary = asked.select("term").distinct()
    table = forward(docs, vocabulary, id_col, text_col)
    n_docs, n_terms = table.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    found = _postings(table, n_docs, n_terms).join(vocabulary, "term")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("bigint")
    terms = written(found.groupBy("term").agg(F.count("*").alias("df"), F.max("gain").alias("most")).select(
        "term", weight.alias("w"), (weight * F.col("most")).alias("bound")), "search-terms")
    impacts = written(
        found.join(terms, "term").select("row", "doc_id", "term", (F.col("w") * F.col("gain")).alias("impact"))
        .groupBy("row", "doc_id").agg(F.map_from_entries(F.collect_list(F.struct("term", "impact"))).alias("impacts")),
        "search-impacts")
    postings = impacts.select("row", F.explode("impacts").alias("term", "impact"))

    best = Window.partitionBy("term").orderBy(F.desc("impact"), "row")
    heads = written(postings.withColumn("place", F.row_number().over(best)).where(F.col("place") <= top)
                    .select("term", "row", "impact"), "search-heads")
    sums = asked.join(heads, "term").groupBy("item_id", "row").agg(F.sum("impact").alias("score"))
    known = written(_best(sums.where("score > 0"), top), "search-known")
    floors = written(_in_full(known, impacts, asked).groupBy("item_id").agg(F.min("score").alias("floor")), "search-floors")

    # documents stay where their rows lie while what items and pairs gain from them is added up
    line = impacts.repartition("row").select("row", "doc_id", F.explode("impacts").alias("term", "impact"))
    joint = joint_bounds(line, pairs_asked(asked, terms, partners))
    a, b = (terms.select(F.col("term").alias(n), F.col("bound").alias(f"bound_{n}")) for n in ("one", "two"))
    both = F.greatest("bound_one", "bound_two", "joint")  # a document holds one of them, the other, or both
    saved = F.col("bound_one") + F.col("bound_two") - both
    pairs = written(joint.join(a, "one").join(b, "two").select(
        "one", "two", both.alias("both"), saved.alias("saving")).where("saving > 0"), "search-pairs")

    terms_of = asked.join(terms, "term")
    least = Window.partitionBy("item_id").orderBy("bound", "unit").rowsBetween(Window.unboundedPreceding, 0)
    ordered = units(terms_of, pairs).withColumn("sum", F.sum("bound").over(least)).join(floors, "item_id", "left")
    passed = F.col("sum") < F.coalesce("floor", F.lit(0))
    plan = written(ordered.select("item_id", "sum", passed.alias("passed"), F.explode("terms").alias("term")), "search-plan")
    rest = plan.where("passed").groupBy("item_id").agg(F.max("sum").alias("rest"))
    limits = written(asked.select("item_id").distinct().join(rest, "item_id", "left").join(floors, "item_id", "left").select(
        "item_id", F.coalesce("rest", F.lit(0)).alias("rest"), F.coalesce("floor", F.lit(0)).alias("floor")), "search-limits")

    essential = plan.where("not passed").select("item_id", "term")
    seen = line.join(essential, "term").groupBy("row", "item_id").agg(F.first("doc_id").alias("doc_id"), F.sum("impact").alias("score"))
    seen = written(seen.join(limits, "item_id").where("score + rest >= floor").select("item_id", "row", "doc_id", "score"), "search-seen")
    higher = _best(seen.where("score > 0"), top).groupBy("item_id").agg(F.min("score").alias("higher"))
    bar = limits.join(higher, "item_id", "left").select(
        "item_id", "rest", F.greatest("floor", F.coalesce("higher", F.lit(0))).alias("bar"))
    hopeful = written(seen.join(bar, "item_id").where("score + rest >= bar").select("item_id", "row", "doc_id", "score"), "search-hopeful")
    open_terms = plan.where("passed").select("item_id", "term")
    rest_of = hopeful.join(open_terms, "item_id").join(postings, ["row", "term"]).select("item_id", "row", "doc_id", F.col("impact").alias("score"))
    scored = hopeful.union(rest_of).groupBy("item_id", "row", "doc_id").agg(F.sum("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"), "row"))
    return scored.where("score > 0").withColumn("rank", rank).where(F.col("rank") <= top).select(
        "item_id", "rank", "doc_id", "score")
