"""Exact k nearest neighbours over cells, most of which need not be visited."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.session import written

BLOCK_ROWS = 8192
SLICE_ROWS = 512
MOST_CELLS = 4096
SLACK = 1e-6  # distances are compared to nine places; a bound must not be closer than its rounding


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("f8")


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances, as exact as doubles allow for the sizes met here."""
    d = a @ (-2.0 * b).T
    d += (a * a).sum(1)[:, None]
    d += (b * b).sum(1)[None, :]
    return np.maximum(d, 0.0, out=d)


def _centres(train: DataFrame, ident: str, vector: str, cells: int) -> np.ndarray:
    """Some rows, the same ones in every run, as the centres of the cells: ``MOST_CELLS`` at most."""
    some = train.orderBy(F.xxhash64(F.lit(3), ident), ident).limit(cells).select(vector).toPandas()
    return _matrix(some[vector])


def _cell(vector: Column, centres: np.ndarray) -> Column:
    @F.pandas_udf("cell int, away double")
    def nearest_centre(vec: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(vec), centres)
        cell = d.argmin(1)
        return pd.DataFrame({"cell": cell.astype("i4"), "away": np.sqrt(d[np.arange(len(d)), cell])})

    return nearest_centre(vector)


def cells_in_reach(vector: Column, bound: Column, own: Column, centres: np.ndarray, radius: np.ndarray) -> Column:
    """Cells besides the own one that may hold a row closer than ``bound``.

    No row of a cell is closer than its centre's distance less the cell's radius.
    A query without a bound must visit every cell.
    """
    @F.pandas_udf("array<int>")
    def reach(vec: pd.Series, most: pd.Series, home: pd.Series) -> pd.Series:
        least = np.sqrt(_distances(_matrix(vec), centres)) - radius[None, :]
        limit = np.sqrt(most.fillna(np.inf).to_numpy(dtype="f8"))
        near = least <= limit[:, None] + SLACK
        near[np.arange(len(near)), home.to_numpy()] = False
        return pd.Series([np.flatnonzero(row).astype("i4") for row in near])

    return reach(vector, bound, own)


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    values = pa.concat_arrays([c.flatten() for c in column.chunks])
    lengths = np.unique(np.concatenate([pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in column.chunks]))
    if len(lengths) != 1 or column.null_count:
        raise ValueError("all vectors must have one length")
    return values.to_numpy(zero_copy_only=False).astype("f8").reshape(len(column), -1)


def _kth(d: np.ndarray, k: int) -> np.ndarray:
    """The k-th smallest number of each row, infinite where there are fewer."""
    if d.shape[1] < k:
        return np.full(len(d), np.inf)
    found = np.partition(d, k - 1, axis=1)[:, k - 1]
    return np.where(np.isnan(found), np.inf, found)


def _block_best(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """For each row of ``right`` those of ``left`` that may be among its k nearest, k at most.

    A row that knows its bound takes what lies within it, so nothing is sorted but the few rows that do.
    """
    left = left.sort_by("id") if left.num_rows else left  # equal distances then fall by id
    n = right.num_rows if left.num_rows else 0
    rows, columns, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    if n:
        a, b = _vectors(right["vec"]), _vectors(left["vec"])
        same = [(right[c].to_numpy(), left[c].to_numpy()) for c in ("id", "apart") if c in left.column_names]
        bound = right["bound"].to_numpy().astype("f8") if "bound" in right.column_names else np.full(n, np.nan)
    for start in range(0, n, SLICE_ROWS):  # bounds the distance matrix
        piece = slice(start, start + SLICE_ROWS)
        d, limit = _distances(a[piece], b), bound[piece].copy()
        open_ = np.flatnonzero(np.isnan(limit))
        if len(open_):
            free = d[open_]
            for mine, theirs in same:
                free[mine[piece][open_][:, None] == theirs[None, :]] = np.inf
            limit[open_] = _kth(free, k)
        row, column = np.nonzero(d <= limit[:, None] + SLACK)
        near = np.round(d[row, column], 9)
        keep = np.isfinite(near)
        for mine, theirs in same:  # a row is no neighbour of itself
            keep &= mine[piece][row] != theirs[column]
        row, column, near = row[keep], column[keep], near[keep]
        order = np.lexsort((column, near, row))
        row, column, near = row[order], column[order], near[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < k
        rows.append(row[keep] + start)
        columns.append(column[keep])
        distances.append(near[keep])
    rows, columns = np.concatenate(rows), np.concatenate(columns)
    return pa.table({"query": right["id"].take(rows), "neighbour": left["id"].take(columns),
                     "label": left["label"].take(columns), "distance2": np.concatenate(distances)})


def _search(train: DataFrame, visits: DataFrame, k: int, kinds: dict) -> DataFrame:
    """What each visited block offers: ``train`` by (cell, block, part), ``visits`` by (cell, block, part)."""
    def block_best(left: pa.Table, right: pa.Table) -> pa.Table:
        return _block_best(left, right, k)

    schema = f"query {kinds['id']}, neighbour {kinds['id']}, label {kinds['label']}, distance2 double"
    keys = ["cell", "block", "part"]
    return train.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(block_best, schema)


def nearest(
    train: DataFrame, queries: DataFrame, ident: str, vector: str, label: str, k: int,
    block_rows: int = BLOCK_ROWS, apart: str | None = None,
) -> DataFrame:
    """``(query, neighbour, label, distance2, place)``: the k nearest other rows of each query.

    Rows that agree in the column ``apart``, such as a fold, are no neighbours of each other.

    Every row belongs to the cell of its nearest centre.  A query first searches its own
    cell; its k-th distance there bounds what a better row can be, so it then visits
    only the cells that reach within that distance.  A cell is cut in blocks of
    ``block_rows`` rows, and its visitors in parts; a block and a part meet in one
    matrix product that returns the rows within the query's bound, k at most, or k where it has none.  The answer is exact whatever the
    cells are; how many are passed over depends on how clustered the rows
    are.  Distances are squared and compared to nine places, equal ones by id.
    """
    rows = train.count()
    cells = max(1, min(MOST_CELLS, rows // 64, max(8, -(-rows // block_rows))))
    centres = _centres(train, ident, vector, cells) if rows else np.zeros((1, 1))
    cells = len(centres)
    more = [F.col(apart).alias("apart")] if apart else []
    kept = ["apart"] if apart else []
    t = train.select(F.col(ident).alias("id"), F.col(vector).alias("vec"), F.col(label).alias("label"), *more)
    t = written(t.withColumn("c", _cell(F.col("vec"), centres)).select("id", "vec", "label", *kept, "c.cell", "c.away"), "knn-rows")
    q = queries.select(F.col(ident).alias("id"), F.col(vector).alias("vec"), *more)
    q = written(q.withColumn("c", _cell(F.col("vec"), centres)).select("id", "vec", *kept, "c.cell"), "knn-queries")
    radius = np.full(cells, -np.inf)
    sizes = {}
    for r in t.groupBy("cell").agg(F.max("away").alias("r"), F.count("*").alias("n")).collect():  # one row per cell
        radius[r["cell"]], sizes[r["cell"]] = r["r"], r["n"]
    kinds = dict(t.dtypes)
    blocks = F.element_at(
        F.array(*[F.lit(-(-sizes.get(c, 0) // block_rows) or 1) for c in range(cells)]), F.col("cell") + 1)

    def search(visits: DataFrame) -> DataFrame:
        visitors = written(visits, "knn-visits")  # one row per query with the cells that it visits
        one = F.explode("cells").alias("cell")
        counts = {r["cell"]: r["count"] for r in visitors.select(one).groupBy("cell").count().collect()}
        parts = F.element_at(
            F.array(*[F.lit(-(-counts.get(c, 0) // block_rows) or 1) for c in range(cells)]), F.col("cell") + 1)
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        left = t.withColumn("block", F.pmod(F.hash("id"), blocks)).withColumn("part", every(parts))
        right = visitors.select("*", one).drop("cells").withColumn("part", F.pmod(F.hash("id"), parts)).withColumn("block", every(blocks))
        return _search(left.select("cell", "block", "part", "id", "vec", "label", *kept), right, k, kinds)

    ranked = Window.partitionBy("query").orderBy("distance2", "neighbour")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k)

    home = written(best(search(q.select("id", "vec", *kept, F.array("cell").alias("cells")))), "knn-home")
    bounds = home.where(F.col("place") == k).select(F.col("query").alias("id"), F.col("distance2").alias("bound"))
    reach = cells_in_reach(F.col("vec"), F.col("bound"), F.col("cell"), centres, radius)
    away = q.join(bounds, "id", "left").select("id", "vec", *kept, "bound", reach.alias("cells"))
    return best(home.drop("place").union(search(away)))


def vote(neighbours: DataFrame) -> DataFrame:
    """``(query, predicted)``: the commonest label, the smallest of several."""
    counts = neighbours.groupBy("query", "label").agg(F.count("*").alias("n"))
    return counts.groupBy("query").agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("predicted")
    )


def accuracy_by_k(df: DataFrame, ident: str, vector: str, label: str, fold: str, largest: int) -> DataFrame:
    """``(k, accuracy)`` of voting among the ``k`` nearest rows of other folds, for every ``k`` up to ``largest``.

    One search finds the ``largest`` nearest of each row; a neighbour votes for every ``k`` from its place on, so all
    ``k`` are judged from the same rows.
    """
    near = nearest(df, df, ident, vector, label, largest, apart=fold)
    votes = near.withColumn("k", F.explode(F.sequence(F.col("place"), F.lit(largest))))
    counts = votes.groupBy("query", "k", "label").agg(F.count("*").alias("n"))
    chosen = counts.groupBy("query", "k").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("predicted"))
    truth = df.select(F.col(ident).alias("query"), F.col(label).alias("truth"))
    hit = (F.col("predicted") == F.col("truth")).cast("double")
    return chosen.join(truth, "query").groupBy("k").agg(F.avg(hit).alias("accuracy"))


def best_k(scores: DataFrame) -> DataFrame:
    """The ``k`` of the highest accuracy, the smallest of several."""
    return scores.agg(F.min_by(F.struct("k", "accuracy"), F.struct(-F.col("accuracy"), F.col("k"))).alias("b")).select("b.*")
