"""Mixing sources to token targets by entropy balancing.

Among all rates between 0 and ``most`` copies per document that meet every source's
token target, the one closest to "each document once" (least relative entropy)
is ``min(most, exp(lambda_s * size))``: documents are tilted exponentially by
their size, with one multiplier per source.  The multipliers solve a convex dual
whose gradient and curvature are sums over documents, so Newton steps, held
inside a shrinking bracket, run as aggregates.  Rates become whole copies by
rounding their running sum over sizes, which keeps each source's words within
half of its longest document, and the rest is settled with small documents.

All statistics stand on counts per (source, size): a source with a third of all
rows is as many rows there as it has different sizes.  Only DataFrame functions
are used.

Defined results: null, empty and blank texts have size 0 and take nothing; null
is a source of its own, last in order; repeated rows are drawn separately; ties
of size are drawn by a hash of the id; an empty table gives an empty one;
a table without any word has targets of 0.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrymill.llm.common import fresh, quoted, word_count, written

LOG_MOST = 0.6931471805599453  # ln 2: the rate's upper bound is two copies


@dataclass(frozen=True)
class Plan:
    """``weights`` repeat over the sources in order; ``share`` of all words is taken;
    no source and no document is taken more than ``most`` (two) times."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: float = 1.5
    most: int = 2
    tolerance: float = 1e-9
    rounds: int = 60
    cell_rows: int = 50_000


def _exact(value: Column) -> Column:
    """A sum that does not depend on the order of its rows, so that reruns agree."""
    return F.sum(value.cast("decimal(38,6)")).cast("double")


def _ranked_sources(sized: DataFrame) -> DataFrame:
    """``source, rank, words``: one row per source, numbered by code point, null last.

    Numbering runs in ranges of the distinct names, so that very many sources
    are not sorted in one task.
    """
    words = sized.groupBy("source").agg(F.sum("size").alias("words"))
    ranged = written(
        words.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id()), "mix-sources",
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return ranged.withColumn("place", F.row_number().over(inside)).join(offsets, "part").select(
        "source", (F.col("offset") + F.col("place") - 1).alias("rank"), "words")


def targets(sized: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``source, rank, words, target``: water filling of the weights under the caps.

    A target is ``min(most * words, level * weight)`` with the level at which all
    targets sum to the wanted words.  Raising the level caps some sources,
    whose excess raises it again; each pass is one aggregate over the sources,
    and the capped set only grows.
    """
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in plan.weights]),
        (F.col("rank") % len(plan.weights) + 1).cast("int"),
    )
    table = written(_ranked_sources(sized).withColumn("weight", weight), "mix-weights")
    wanted = (table.agg(F.sum("words")).first()[0] or 0) * plan.share
    level, capped = 0.0, -1
    while True:
        full = F.lit(plan.most) * F.col("words") < F.lit(level) * F.col("weight")
        taken, free, now = table.agg(
            F.sum(F.when(full, F.col("words") * plan.most).otherwise(0)),
            F.sum(F.when(full, F.lit(0.0)).otherwise(F.col("weight"))),
            F.count_if(full),
        ).first()
        if not free or now == capped:
            break
        capped = now
        level = (wanted - (taken or 0)) / free
    cap = F.col("words").cast("double") * plan.most
    return table.withColumn("target", F.least(cap, F.lit(level) * F.col("weight")))


def multipliers(cells: DataFrame, goals: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``rank, lam``: the dual solution per source by safeguarded Newton steps.

    ``cells`` is ``rank, size, n``; ``goals`` is ``rank, words, target``.  Sizes
    are scaled by the source's mean.  The dual's gradient rises with the
    multiplier, so each evaluation narrows a bracket, and a step that would
    leave it is replaced by bisection.  A source whose target is its cap has
    no finite solution: all its rates are the cap.
    """
    counted = cells.groupBy("rank").agg(F.sum("n").alias("docs"))
    state = goals.join(counted, "rank").select(
        "rank", "target", "words",
        (F.col("words") / F.col("docs")).alias("scale"),
        F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
        ((F.col("words") == 0) | (F.col("target") >= F.col("words") * plan.most * (1 - 1e-12))).alias("done"),
    )
    state = written(state, "mix-state")
    for _ in range(plan.rounds):
        open_ = state.where("not done")
        if open_.isEmpty():
            break
        x = F.col("size") / F.col("scale")
        power = F.exp(F.least(F.col("lam") * x, F.lit(LOG_MOST)))
        bent = F.when(F.col("lam") * x < LOG_MOST, power * x * F.col("size")).otherwise(0.0)
        sums = cells.join(open_.select("rank", "scale", "lam"), "rank").groupBy("rank").agg(
            _exact(F.col("n") * F.col("size") * power).alias("got"), _exact(F.col("n") * bent).alias("slope"))
        gap = F.col("got") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap >= 0, F.col("lam")).otherwise(F.col("high"))
        moved = state.join(sums, "rank", "left").withColumns({"gap": gap, "low2": low, "high2": high})
        newton = F.col("lam") - F.try_divide("gap", "slope")
        inside = (newton > F.coalesce("low2", F.lit(float("-inf")))) & (newton < F.coalesce("high2", F.lit(float("inf"))))
        middle = (F.when(F.col("low2").isNull(), F.least(2 * F.col("high2"), F.col("high2") - 1))
                  .when(F.col("high2").isNull(), F.greatest(2 * F.col("low2"), F.col("low2") + 1))
                  .otherwise((F.col("low2") + F.col("high2")) / 2))
        step = F.when((F.col("slope") > 0) & inside, newton).otherwise(middle)
        close = F.abs("gap") <= F.lit(plan.tolerance) * F.greatest("target", F.lit(1.0))
        stop = F.col("done") | close
        state = written(moved.select(
            "rank", "target", "words", "scale",
            F.when(stop, F.col("lam")).otherwise(step).alias("lam"),
            F.when(stop, F.col("low")).otherwise(F.col("low2")).alias("low"),
            F.when(stop, F.col("high")).otherwise(F.col("high2")).alias("high"),
            stop.alias("done"),
        ), "mix-state")
    full = F.col("target") >= F.col("words") * plan.most * (1 - 1e-12)
    return state.select(
        "rank", F.coalesce(F.try_divide("lam", "scale"), F.lit(0.0)).alias("lam"), (full & (F.col("words") > 0)).alias("full"))


def _rate(plan: Plan) -> Column:
    tilted = F.exp(F.least(F.col("lam") * F.col("size"), F.lit(LOG_MOST)))
    return F.when(F.col("size") == 0, 0.0).when(F.col("full"), float(plan.most)).otherwise(
        F.least(tilted, F.lit(float(plan.most))))


def copies_per_cell(cells: DataFrame, solved: DataFrame, goals: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``rank, size, salt, n, copies``: whole copies of the ``n`` documents of a cell.

    Cells of a source are taken from the longest texts down.  The running sum
    of their rates is rounded, and a cell gets what the rounded sum gains: the
    error in copies never passes one half, so that in words never passes half
    the longest text.  What is still missing or too much is then added to, or
    taken from, the shortest texts up to the last one that fits.
    """
    down = Window.partitionBy("rank").orderBy(F.desc("size"), "salt")
    rates = cells.join(solved, "rank").withColumn("sum", F.sum(F.col("n") * _rate(plan)).over(
        down.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.round("sum").cast("bigint")
    drawn = rates.withColumn("whole", whole).withColumn(
        "copies", F.col("whole") - F.lag("whole", 1, 0).over(down)
    ).withColumn("copies", F.least(F.greatest("copies", F.lit(0)), F.col("n") * plan.most))
    drawn = written(drawn.select("rank", "size", "salt", "n", "copies"), "mix-drawn")
    rest = drawn.groupBy("rank").agg(F.sum(F.col("copies") * F.col("size")).alias("got")).join(
        goals.select("rank", "target"), "rank").select("rank", (F.col("target") - F.col("got")).alias("rest"))
    up = Window.partitionBy("rank").orderBy("size", "salt").rowsBetween(Window.unboundedPreceding, -1)
    # room: copies that the cell can still take, or give
    room = F.when(F.col("size") == 0, 0).when(
        F.col("rest") >= 0, F.col("n") * plan.most - F.col("copies")).otherwise(F.col("copies"))
    fill = drawn.join(rest, "rank").withColumn("room", room)
    fill = fill.withColumn("below", F.coalesce(F.sum(F.col("room") * F.col("size")).over(up), F.lit(0)))
    fits = F.greatest(F.lit(0), F.least(
        F.col("room"), F.floor((F.abs("rest") - F.col("below")) / F.greatest("size", F.lit(1)))))
    return fill.select(
        "rank", "size", "salt", "n",
        (F.col("copies") + F.signum("rest").cast("bigint") * fits.cast("bigint")).alias("copies"))


def _sizes(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return written(df.select(
        quoted(id_col).alias("doc_id"), quoted(source_col).alias("source"),
        word_count(quoted(text_col)).alias("size")), "mix-sizes")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        plan: Plan = Plan()) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies, taken``, one row per row of ``df``."""
    return mix_sized(_sizes(df, id_col, text_col, source_col), plan)


def mix_sized(sized: DataFrame, plan: Plan = Plan()) -> DataFrame:
    """``mix`` for a table ``doc_id, source, size``."""
    return _copies(_numbered(sized, plan)[0]).select(
        "doc_id", "source", "size", F.col("words").alias("source_size"), "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _copies(numbered: DataFrame) -> DataFrame:
    """``numbered`` with what is taken of each row as ``copies``."""
    return numbered.withColumn(
        "copies", (F.col("each") + (F.col("place") <= F.col("extra")).cast("bigint")).cast("bigint"))


def _draw(doc_id: Column) -> Column:
    """The order of a cell's documents."""
    return F.xxhash64(F.lit(11), doc_id)


def _salt(doc_id: Column, salts: Column) -> Column:
    """The part of a cell that a document is in; 0 where the cell is whole."""
    return F.coalesce(F.pmod(F.xxhash64(F.lit(13), doc_id), salts), F.lit(0))


def _numbered(sized: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The rows of ``sized`` with their ``place`` in their cell (source, size, salt), and the cells that have salts.

    All of a cell are taken ``each`` times, those up to the place ``extra`` once more.
    """
    if plan.most != 2:
        raise ValueError("rates are bounded by two copies")
    goals = written(targets(sized, plan), "mix-goals")
    names = goals.select(F.col("source").alias("name"), "rank", "words", "target")
    ranked = sized.join(names, F.col("source").eqNullSafe(F.col("name")))
    cells = written(ranked.groupBy("rank", "size").agg(F.count("*").alias("n")), "mix-cells")
    solved = multipliers(cells, goals, plan)

    # a cell too large to be numbered in one task is dealt by hash into salts
    hot = cells.where(F.col("n") > plan.cell_rows).select(
        "rank", "size", F.ceil(F.col("n") / plan.cell_rows).alias("salts"))
    salted = ranked.join(hot, ["rank", "size"], "left").withColumn(
        "salt", _salt(F.col("doc_id"), F.col("salts"))).withColumn("draw", _draw(F.col("doc_id")))
    fine = cells.where(F.col("n") <= plan.cell_rows).withColumn("salt", F.lit(0).cast("bigint")).unionByName(
        salted.where("salts is not null").groupBy("rank", "size", "salt").agg(F.count("*").alias("n")))
    dealt = written(copies_per_cell(fine, solved, goals, plan), "mix-copies")

    place = F.row_number().over(Window.partitionBy("rank", "size", "salt").orderBy("draw", "doc_id"))
    each = F.floor(F.col("copies") / F.col("n"))
    numbered = salted.withColumn("place", place).join(
        dealt.withColumn("each", each).withColumn("extra", F.col("copies") - F.col("each") * F.col("n")),
        ["rank", "size", "salt"])
    return numbered, hot.join(names, "rank").select(F.col("name").alias("source"), "size", "salts")


def repeat_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                plan: Plan = Plan()) -> DataFrame:
    """Rows of ``df``, each as often as the mix takes it; all columns stay.

    What a cell takes is one row, with the last draw that is taken once more.  So texts meet
    a table that grows with the sizes that occur and not with the documents, and where the planner
    broadcasts it no text is shuffled.  Rows whose draw is another's, as all that share an id, are
    numbered among those of one id, source and size, and the copies of these are dealt out one by
    one, so that their sum is kept.
    """
    mine, source, size, draw, salts, salt, each, last, times, again, of, long, part, place, total, rows = fresh(
        df, "mixed_id", "mixed_source", "mixed_size", "draw", "salts", "salt", "each", "last", "times", "again",
        "of_source", "of_size", "of_salt", "place", "total", "rows")
    sized = _sizes(df, id_col, text_col, source_col)
    numbered, hot = _numbered(sized, plan)
    rules = written(
        numbered.where("copies > 0").groupBy("rank", "source", "size", "salt").agg(
            F.max("each").cast("int").alias(each),
            F.max(F.when(F.col("place") == F.col("extra"), F.col("draw"))).alias(last),
        ).select(F.col("source").alias(of), F.col("size").alias(long), F.col("salt").alias(part), each, last), "mix-rules")
    hot = written(hot.select(F.col("source").alias(source), F.col("size").alias(long), F.col("salts").alias(salts)), "mix-hot")
    shared = written(
        sized.groupBy(_draw(F.col("doc_id")).alias(last)).agg(F.count("*").alias("n")).where("n > 1").select(last),
        "mix-shared")

    here, columns = df.withColumns({size: word_count(quoted(text_col)), draw: _draw(quoted(id_col))}), df.columns
    alone = here if shared.isEmpty() else here.join(shared, F.col(draw) == F.col(last), "left_anti")
    salted = alone.join(
        hot, quoted(source_col).eqNullSafe(F.col(source)) & (F.col(size) == F.col(long)), "left",
    ).drop(source, long).withColumn(salt, _salt(quoted(id_col), F.col(salts)))
    more = F.coalesce(F.col(draw) <= F.col(last), F.lit(False)).cast("int")
    joined = salted.join(
        rules, quoted(source_col).eqNullSafe(F.col(of)) & (F.col(size) == F.col(long)) & (F.col(salt) == F.col(part)),
    ).withColumn(times, F.col(each) + more).where(F.col(times) > 0).select(*[quoted(c) for c in columns], times)
    if not shared.isEmpty():
        given = _copies(numbered).join(shared, F.col("draw") == F.col(last), "left_semi")
        inside = Window.partitionBy(quoted(id_col), quoted(source_col), size).orderBy(F.xxhash64(quoted(text_col)))
        groups = given.groupBy(F.col("doc_id").alias(mine), F.col("source").alias(of), F.col("size").alias(long)).agg(
            F.sum("copies").alias(total), F.count("*").alias(rows)).where(F.col(total) > 0)
        whole = F.floor(F.col(total) / F.col(rows))
        dealt = here.join(shared, F.col(draw) == F.col(last), "left_semi").withColumn(place, F.row_number().over(inside)).join(
            groups, quoted(id_col).eqNullSafe(F.col(mine)) & quoted(source_col).eqNullSafe(F.col(of))
            & (F.col(size) == F.col(long)))
        one = (F.col(place) <= F.col(total) - whole * F.col(rows)).cast("int")
        dealt = dealt.withColumn(times, (whole + one).cast("int")).where(F.col(times) > 0)
        joined = joined.unionByName(dealt.select(*[quoted(c) for c in columns], times))
    return joined.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(times)))).drop(times, again)
