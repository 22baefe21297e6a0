"""Optimal length buckets and token-budget batches.

Every text of a bucket is padded to the bucket's boundary.  From the histogram of
all lengths, dynamic programming finds the boundaries with the least padding
for a given number of buckets; batches of a bucket hold as many texts as the token
budget allows at its boundary.

Defined results: null, empty and blank texts have length 0; a text longer than the
budget is a batch of its own; equal lengths share a bucket and are ordered by a
hash of the id; repeated rows take places of their own; a table with fewer
different lengths than buckets has no padding; an empty table gives an empty
one; other columns stay, and clashing names are given way to.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import fresh, quoted, word_count, written

BUCKETS, BUDGET, ROWS_PER_TASK = 16, 65_536, 100_000
OUTPUTS = ("length", "bucket", "boundary", "batch", "slot")


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Upper limits of the buckets with the least padding, ascending.

    With ``N`` the running count of texts, one bucket over lengths ``(i, j]``
    costs ``length[j] * (N[j] - N[i])`` padded tokens, so the best cost for
    ``j`` is the lowest of the lines ``best[i] - N[i] * x`` at ``x = length[j]``.
    Slopes fall with ``i`` and ``x`` rises, so a bucket's layer is one walk along
    the lower envelope: ``buckets * lengths`` steps in all.
    """
    m = len(lengths)
    if m == 0:
        return []
    if m <= buckets:
        return [int(x) for x in lengths]
    x = [int(v) for v in lengths]
    total = [0, *np.cumsum(counts).tolist()]
    best = [0] + [x[j] * total[j + 1] for j in range(m)]
    choice = [[0] * (m + 1)]
    for _ in range(1, buckets):
        hull: list[int] = []
        at, now, picked = 0, [0] * (m + 1), [0] * (m + 1)

        def above(a: int, b: int, c: int) -> bool:
            """Line b is nowhere below both a and c (slopes -total, falling)."""
            return (best[c] - best[a]) * (total[b] - total[a]) <= (best[b] - best[a]) * (total[c] - total[a])

        for j in range(1, m + 1):
            i = j - 1
            while len(hull) - at >= 2 and above(hull[-2], hull[-1], i):
                hull.pop()
            hull.append(i)
            v = x[j - 1]
            while at + 1 < len(hull) and best[hull[at + 1]] - total[hull[at + 1]] * v <= best[hull[at]] - total[hull[at]] * v:
                at += 1
            i = hull[at]
            now[j], picked[j] = best[i] - total[i] * v + v * total[j], i
        best, choice = now, [*choice, picked]
    limits, j = [], m
    for layer in reversed(choice):
        limits.append(x[j - 1])
        j = layer[j]
        if j == 0:
            break
    return limits[::-1]


def _bucket(length: Column, limits: list[int]) -> Column:
    """Index of the first limit at or above the length."""
    return F.size(F.filter(F.array(*[F.lit(v).cast("bigint") for v in limits]), lambda v: v < length))


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
         budget: int = BUDGET, rows_per_task: int = ROWS_PER_TASK, keep: list[str] | None = None,
         outputs: tuple[str, ...] = OUTPUTS) -> DataFrame:
    """Columns ``keep`` (all by default) and ``outputs`` per row of ``df``.

    The kept columns are written once with their lengths; leave the texts out of ``keep``
    where the batches are to name documents only.

    Only the histogram, one row per different length, reaches the driver; there
    are at most ``sqrt(2 * tokens)`` different lengths in a corpus, and no more
    than its longest text has tokens.  Places in a bucket are numbered in ranges
    of a hash, as many as its rows need, so a bucket that holds a third of all rows
    is spread over many tasks.
    """
    keep = df.columns if keep is None else keep
    length, rnd, part = fresh(df, "length", "draw", "part")
    # written, so that texts are read and counted once: the optimizer would copy the count
    # into the search of the bucket and run it there for every limit
    sized = written(df.select(
        *[quoted(c) for c in dict.fromkeys([*keep, id_col])], word_count(quoted(text_col)).alias(length)), "pack-lengths")
    histogram = sized.groupBy(length).agg(F.count("*").alias("n"))
    found = sorted(histogram.collect())
    limits = boundaries(np.array([r[0] for r in found], np.int64), np.array([r[1] for r in found], np.int64), buckets)
    if not limits:
        limits = [0]
    index = np.searchsorted(limits, [r[0] for r in found])
    rows = np.bincount(index, weights=[r[1] for r in found], minlength=len(limits)) if found else [0]
    parts = [max(1, -(-int(n) // rows_per_task)) for n in rows]

    bucket, slot, place = fresh(sized, "bucket", "slot", "place")
    in_bucket = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col(bucket) + 1)
    marked = sized.withColumn(bucket, _bucket(F.col(length), limits)).withColumn(
        rnd, F.shiftrightunsigned(F.xxhash64(F.lit(31), quoted(id_col)), 32)
    ).withColumn(part, F.floor(F.col(rnd) * in_bucket / F.lit(float(1 << 32))).cast("int"))
    counts = written(marked.groupBy(F.col(bucket).alias("b"), F.col(part).alias("p")).agg(F.count("*").alias("n")), "pack-parts")
    before = Window.partitionBy("b").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("b", "p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("o"))
    inside = Window.partitionBy(bucket, part).orderBy(rnd, quoted(id_col), length)
    numbered = marked.withColumn(place, F.row_number().over(inside)).join(
        offsets, (F.col(bucket) == F.col("b")) & (F.col(part) == F.col("p"))
    ).withColumn(place, F.col("o") + F.col(place) - 1)
    boundary = F.element_at(F.array(*[F.lit(v).cast("bigint") for v in limits]), F.col(bucket) + 1)
    texts = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(boundary, F.lit(1)))).cast("bigint")
    made = [F.col(length), F.col(bucket), boundary, F.floor(F.col(place) / texts), F.col(place) % texts]
    return numbered.select(*[quoted(c) for c in keep], *[c.cast("bigint").alias(o) for c, o in zip(made, outputs)])
