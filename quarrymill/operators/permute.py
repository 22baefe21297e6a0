"""Permutation test on the number of long runs of a sequence."""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.operators import ordered

ROWS_PER_CHUNK = 1_000_000
ROWS_PER_BLOCK = 8_000_000  # rows whose places are packed together: the more, the smaller the steps between them
TASKS_PER_CORE = 4
BATCH_BYTES = 16 << 20
WORD = 1 << 32
# fixed values of the draw, which SQL states as well: odd multipliers below 2^31
SPREAD, STEP, FIRST, SECOND = 1_640_531_527, 97_531, 739_982_445, 695_872_825
_BLOCK = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("codes", pa.binary())])
_PACKED = pa.schema([("rep", pa.int32()), ("chunk", pa.int32()), ("n", pa.int64()), ("places", pa.binary()),
                     ("values", pa.binary()), ("codes", pa.binary())])
_RUNS = pa.schema([("rep", pa.int32()), ("chunk", pa.int32()), ("runs", pa.int64()), ("first_code", pa.int64()),
                   ("first_len", pa.int64()), ("last_code", pa.int64()), ("last_len", pa.int64()), ("inner", pa.int64())])


def observed_runs(df: DataFrame, order: str, value: str, at_least: int) -> DataFrame:
    """One row ``long_runs``: the statistic of the sequence as it is."""
    return ordered.long_runs(df, [], [order], value, at_least, order)


def draws(keys: np.ndarray, rep: int, seed: int) -> np.ndarray:
    """32-bit places of keys in one shuffle; keys that differ modulo 2^32 have different places."""
    x = (keys.astype(np.uint64) * np.uint64(SPREAD) + np.uint64(rep * STEP + seed)) & np.uint64(WORD - 1)
    x ^= x >> np.uint64(15)
    x = (x * np.uint64(FIRST)) & np.uint64(WORD - 1)
    x ^= x >> np.uint64(12)
    x = (x * np.uint64(SECOND)) & np.uint64(WORD - 1)
    return (x ^ (x >> np.uint64(15))).astype(np.uint32)


def draw_sql(key: str, rep: str, seed: int) -> str:
    """The same number in SQL of 64-bit integers, for keys from 0 to 2^32 - 1."""
    x0 = f"(({key} * {SPREAD} + {rep} * {STEP} + {seed}) % {WORD})"
    x1 = f"(xor({x0}, {x0} >> 15) * {FIRST} % {WORD})"
    x2 = f"(xor({x1}, {x1} >> 12) * {SECOND} % {WORD})"
    return f"xor({x2}, {x2} >> 15)"


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest bytes first: high bytes of small numbers take next to nothing."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def _numbers(data: bytes, n: int, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(-1, n).T).view(kind).ravel()


def _blocks(batches, parts: int):
    """All rows of a task as one pair of packed arrays, once for each part of the shuffles."""
    keys, codes = [], []
    for batch in batches:
        keys.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint32))
        codes.append(batch.column(1).to_numpy(zero_copy_only=False))
    if not keys:
        return
    keys, codes = np.concatenate(keys), np.concatenate(codes)
    order = np.argsort(keys, kind="stable")
    steps = np.diff(keys[order], prepend=np.uint32(0))
    made = zstandard.compress(steps.tobytes(), 1), zstandard.compress(codes[order].tobytes(), 1)
    for part in range(parts):
        yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((part, *made), _BLOCK.types)], schema=_BLOCK)


def _pack(batches, replicates: int, parts: int, seed: int, chunks: int):
    """Rows of a block dealt out to a part of the shuffles and to ranges of their places in each.

    A range has its places in order, as steps from one to the next, and its values as numbers in a list of
    those of the block, or as they are where there are many.
    """
    limits = np.array([-(-(c * WORD) // chunks) for c in range(chunks)], np.uint64) << np.uint64(32)
    for batch in batches:
        for part, packed_keys, packed_codes in zip(*(batch.column(i).to_pylist() for i in range(3))):
            keys = np.cumsum(np.frombuffer(zstandard.decompress(packed_keys), np.uint32), dtype=np.uint32)
            codes = np.frombuffer(zstandard.decompress(packed_codes), np.int64)
            values, number = np.unique(codes, return_inverse=True)
            listed = len(values) * 16 <= max(256, len(codes) // chunks)
            number = number.astype(np.uint64)
            out, held = [], 0
            for rep in range(1 + part, replicates + 1, parts):
                sorted_rows = np.sort(draws(keys, rep, seed).astype(np.uint64) << np.uint64(32) | number)
                at = np.append(np.searchsorted(sorted_rows, limits), len(sorted_rows))
                place, own = (sorted_rows >> np.uint64(32)).astype(np.uint32), sorted_rows.astype(np.uint32)
                own = own.astype(_kind(values)) if listed else values[own]
                for c in np.flatnonzero(np.diff(at)):
                    here = slice(at[c], at[c + 1])
                    row = (rep, int(c), int(at[c + 1] - at[c]), _planes(np.diff(place[here], prepend=np.uint32(0))),
                           values.tobytes() if listed else b"", _planes(own[here]))
                    out.append(row)
                    held += len(row[3]) + len(row[5])
                if held >= BATCH_BYTES or len(out) >= 4_096:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), _PACKED.types)], schema=_PACKED)
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), _PACKED.types)], schema=_PACKED)


def _kind(values: np.ndarray) -> type:
    return np.uint8 if len(values) <= 256 else np.uint32


def _runs(table: pa.Table, at_least: int) -> pa.Table:
    """First run, last run and number of long runs between them, of one range of one shuffle."""
    places, lists, numbers = [], [], []
    for n, steps, values, codes in zip(*(table.column(c).to_pylist() for c in ("n", "places", "values", "codes"))):
        places.append(np.cumsum(_numbers(steps, n, np.uint32), dtype=np.uint32))
        if values:
            lists.append(np.frombuffer(values, np.int64))
            numbers.append(_numbers(codes, n, _kind(lists[-1])))
        else:
            found, number = np.unique(_numbers(codes, n, np.int64), return_inverse=True)
            lists.append(found)
            numbers.append(number)
    every = np.unique(np.concatenate(lists))
    number = np.concatenate([np.searchsorted(every, a)[b] for a, b in zip(lists, numbers)])
    # rows with one place follow each other by value
    code = np.sort(np.concatenate(places).astype(np.uint64) << np.uint64(32) | number.astype(np.uint64)).astype(np.uint32)
    starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    lengths = np.diff(np.r_[starts, len(code)])
    row = (table.column("rep")[0].as_py(), table.column("chunk")[0].as_py(), len(starts), int(every[code[0]]), int(lengths[0]),
           int(every[code[-1]]), int(lengths[-1]), int((lengths[1:-1] >= at_least).sum()))
    return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(row, _RUNS.types)], schema=_RUNS)


def _joined(pieces: Column, at_least: int) -> Column:
    """Long runs of chunk summaries in order: a run that goes on in the next chunk is one."""
    long = lambda n: (n >= at_least).cast("bigint")

    def add(a: Column, p: Column) -> Column:
        goes_on = a.code.eqNullSafe(p.first_code)
        first = F.when(goes_on, a.len + p.first_len).otherwise(p.first_len)
        closed = F.when(goes_on, 0).otherwise(long(a.len))
        one = p.runs == 1
        return F.struct(
            p.last_code.alias("code"), F.when(one, first).otherwise(p.last_len).alias("len"),
            (a.n + closed + F.when(one, 0).otherwise(long(first) + p.inner)).alias("n"))

    start = F.struct(F.lit(None).cast("bigint").alias("code"), F.lit(0).cast("bigint").alias("len"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(pieces, start, add, lambda a: a.n + long(a.len))


def simulated_runs(df: DataFrame, key: str, value: str, at_least: int, replicates: int, seed: int = 0,
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``(rep, long_runs)`` for that many random orders of the whole sequence.

    An order is that of a mixed 32-bit number of a row's whole-number key, so it repeats on any
    cluster; keys that agree modulo 2^32 follow each other by value.  Rows are gathered in blocks of some
    ``ROWS_PER_BLOCK``, and a block goes to several tasks, each of which deals it out to a part of the orders:
    places in their order as steps and values as numbers of a list, which is about two bytes a row and order.  An order of more than
    ``rows_per_chunk`` rows is cut in ranges of places, which are sorted apart; a range hands on its first run,
    its last run and how many long ones lie between, and these are joined up in turn.  A null is a value of its own.
    """
    rows = df.count()
    chunks = max(1, -(-rows // rows_per_chunk))
    blocks = max(1, -(-rows // ROWS_PER_BLOCK))
    parts = max(1, min(replicates, -(-TASKS_PER_CORE * df.sparkSession.sparkContext.defaultParallelism // blocks)))
    place = F.coalesce(F.pmod(F.col(key).cast("bigint"), F.lit(WORD)), F.lit(0).cast("bigint"))
    coded = df.select(place.alias("key"), F.xxhash64(value).alias("code"))
    gathered = coded.repartition(blocks).mapInArrow(partial(_blocks, parts=parts), "part int, keys binary, codes binary")
    packed = gathered.repartition(blocks * parts).mapInArrow(
        partial(_pack, replicates=replicates, parts=parts, seed=seed, chunks=chunks),
        "rep int, chunk int, n long, places binary, values binary, codes binary")

    def runs(table: pa.Table) -> pa.Table:
        return _runs(table, at_least)

    pieces = packed.groupBy("rep", "chunk").applyInArrow(runs, (
        "rep int, chunk int, runs long, first_code long, first_len long, last_code long, last_len long, inner long"))
    whole = F.sort_array(F.collect_list(F.struct("chunk", "runs", "first_code", "first_len", "last_code", "last_len", "inner")))
    return pieces.groupBy("rep").agg(_joined(whole, at_least).alias("long_runs"))


def p_value(simulated: DataFrame, observed: DataFrame, replicates: int) -> DataFrame:
    """Share of replicates that reach the observed statistic."""
    seen = observed.scalar()
    return simulated.agg(
        F.max(seen).alias("observed"), F.round(F.avg("long_runs"), 6).alias("mean_simulated"),
        (F.count_if(F.col("long_runs") >= seen) / F.lit(replicates)).alias("p_value"),
    )
