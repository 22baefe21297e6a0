"""Small worked examples of the operators."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarrymill.functions import codes, dates, recode, text, validate
from quarrymill.operators import (
    aggregates, bagging, boosting, features, graph, joins, metrics, models, neighbours, ordered, permute, project, resample, sets, sgd, topk,
)
from quarrymill.plans import bands


def column(spark, values, kind="STRING"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, x {kind}")


def apply(spark, fn, values, kind="STRING"):
    return [r.y for r in column(spark, values, kind).select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


# ---- ordered ---------------------------------------------------------------

def test_running_ratio(spark):
    games = column(spark, ["W", "L", "W", "W", "L"]).withColumn("team", F.lit("t"))
    out = ordered.running_ratio(games, ["team"], ["i"], F.col("x") == "W", "i").orderBy("i")
    assert [r.ratio for r in out.collect()] == [None, 1.0, 2.0, 3.0, 1.5]


def test_whatever_is_no_win_is_a_loss(spark):
    out = ordered.running_ratio(column(spark, ["W", None, "D"]), [], ["i"], F.col("x") == "W", "i").orderBy("i")
    assert [(r.wins, r.losses) for r in out.collect()] == [(1, 0), (1, 1), (1, 2)]


def test_running_total_skips_nulls(spark):
    out = ordered.running_total(column(spark, [None, 23, 12, None, 4], "INT"), [], ["i"], "x", "i").orderBy("i")
    assert [r.total for r in out.collect()] == [0, 23, 35, 35, 39]


def brute_slice(values, target):
    for i in range(len(values)):
        for j in range(i + 2, len(values) + 1):
            if sum(values[i:j]) == target:
                return values[i:j]


@pytest.mark.parametrize("seed", range(3))
def test_contiguous_sum(spark, seed):
    rng = random.Random(seed)
    values = [rng.randrange(1, 9) for _ in range(80)]
    want = brute_slice(values, 40)
    got = ordered.contiguous_sum(column(spark, values, "BIGINT"), "i", "x", 40).first()
    assert (got.low, got.high, got.total) == (min(want), max(want), 40)
    assert got.last_idx - got.first_idx + 1 == len(want)


def test_contiguous_sum_without_a_slice(spark):
    got = ordered.contiguous_sum(column(spark, [2, 2, 2], "BIGINT"), "i", "x", 7).first()
    assert got.total is None


def test_window_pairs_and_first_failure(spark):
    rng = random.Random(8)
    values = [rng.randrange(1, 12) for _ in range(60)]
    df = column(spark, values, "BIGINT").withColumn("idx", F.col("i") + 1)
    checked = joins.pair_sum_in_lookback(df, "idx", "x", 5)
    want = {
        i + 1: any(a != b and a + b == v for a, b in itertools.combinations(values[i - 5: i], 2))
        for i, v in enumerate(values) if i >= 5
    }
    assert {r.idx: r.valid for r in checked.collect()} == want
    first = ordered.first_failure(checked, "idx", F.col("valid"), ["idx", "x"]).first()
    assert first.idx == min(i for i, ok in want.items() if not ok) and first.x == values[first.idx - 1]


def test_equal_values_make_no_pair(spark):
    df = column(spark, [5, 5, 10], "BIGINT").withColumn("idx", F.col("i") + 1)
    assert [r.valid for r in joins.pair_sum_in_lookback(df, "idx", "x", 2).collect()] == [False]


def test_difference_histogram(spark):
    values = [8, 2, 11, 3, 7, 6, 3]
    out = aggregates.difference_histogram(column(spark, values, "INT"), "x")
    assert {r.step: r.n for r in out.collect()} == {1: 3, 2: 1, 3: 3}


# ---- joins -----------------------------------------------------------------

@pytest.mark.parametrize("seed", range(3))
def test_pair_and_triple_sums(spark, seed):
    rng = random.Random(seed)
    values = [rng.randrange(0, 25) for _ in range(18)]
    df = column(spark, values, "INT")
    pairs = {tuple(sorted(p)) for p in itertools.combinations(values, 2) if sum(p) == 24}
    assert {(r.low, r.high) for r in joins.pair_sums(df, "x", 24).collect()} == pairs
    triples = {tuple(sorted(p)) for p in itertools.combinations(values, 3) if sum(p) == 24}
    assert {(r.a, r.b, r.c) for r in joins.triple_sums(df, "x", 24).collect()} == triples


def test_one_row_is_no_pair_with_itself(spark):
    assert joins.pair_sums(column(spark, [5, 1], "INT"), "x", 10).collect() == []
    assert joins.triple_sums(column(spark, [4, 4, 1], "INT"), "x", 12).collect() == []


@pytest.mark.parametrize("low,high", [(1, 3), (-3, -1), (0, 0), (-2, 5)])
def test_band_join(spark, low, high):
    rng = random.Random(5)
    left, right = [rng.randrange(-30, 30) for _ in range(25)], [rng.randrange(-30, 30) for _ in range(25)]
    got = bands.band_join(
        column(spark, left, "INT").select(F.col("x").alias("a")),
        column(spark, right, "INT").select(F.col("x").alias("b")), "a", "b", low, high,
    )
    want = sorted((a, b) for a in left for b in right if low <= b - a <= high)
    assert sorted((r.a, r.b) for r in got.collect()) == want


def test_single_gaps(spark):
    out = joins.single_gaps(column(spark, [1, 2, 4, 4, 7, 9, 12], "INT"), "x")
    assert sorted((r.low, r.missing, r.high) for r in out.collect()) == [(2, 3, 4), (7, 8, 9)]


def test_group_max_filtered_and_unfiltered(spark):
    df = spark.createDataFrame([("g", 90, 0.40), ("g", 10, 0.40), ("g", 95, 0.30)], "g STRING, made INT, pct DOUBLE")
    enough = df.where("made >= 82")
    assert joins.rows_at_group_max(enough, ["g"], "pct").count() == 1
    assert sorted(r.made for r in joins.rows_at_group_max(df, ["g"], "pct", enough).collect()) == [10, 90]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "join_pair_sum", "join_triple_sum", "join_band", "join_window_pairs", "join_anti_gap", "join_cross_grid",
    "win_contiguous_sum", "param_grid", "perm_test_runs", "prep_standardize", "agg_share_of_total", "fit_knn",
])
def test_no_nested_loops(spark, folder, name):
    from __spark_entry__ import queries

    plan = plan_of(queries()[name](spark, folder))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_pushdown_and_pruning(spark, folder):
    from __spark_entry__ import queries

    plan = plan_of(queries()["filter_compare"](spark, folder))
    assert "GreaterThan(l_quantity,25.0)" in plan
    plan = plan_of(queries()["agg_conditional_count"](spark, folder))
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double>" in plan


def test_prefix_limits_groups_before_the_shuffle(spark, folder):
    from __spark_entry__ import queries

    assert "WindowGroupLimit" in plan_of(queries()["win_prefix_cutoff"](spark, folder))


# ---- top-n, sets -----------------------------------------------------------

def test_three_tie_rules(spark):
    df = column(spark, [9, 8, 8, 7, None], "INT")
    assert sorted(r.x for r in topk.top_with_ties(df, "x", 2).collect()) == [8, 8, 9]
    assert [r.i for r in topk.first_n(df.where("x IS NOT NULL"), 2, "x", "i").collect()] == [3, 1]
    assert topk.last_of_best(df.where("x < 9"), "x", "i").first().i == 2


def test_shuffles_are_permutations(spark):
    df = column(spark, list("abcdefgh"))
    out = topk.shuffled_replicates(df, "i", 4).collect()
    orders = {}
    for r in sorted(out, key=lambda r: (r.rep, r._draw, r.i)):
        orders.setdefault(r.rep, []).append(r.i)
    assert all(sorted(o) == list(range(8)) for o in orders.values()) and len({tuple(o) for o in orders.values()}) > 1


def test_stack_fills_absent_columns(spark):
    out = sets.stack(spark.createDataFrame([(1, 2)], "a INT, b INT"), spark.createDataFrame([(3,)], "a INT"))
    assert sorted(out.collect()) == [(1, 2), (3, None)]


def test_melt_with_total(spark):
    wide = spark.createDataFrame([("May", 12.5, 3.25, 7.0, 20.75, 6.5)],
                                 "month STRING, a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE")
    wide = wide.withColumn("total", F.round(F.col("a") + F.col("b") + F.col("c") + F.col("d") + F.col("e"), 2))
    long = {r.what: r.amount for r in sets.melt(wide, ["month"], wide.columns[1:], "what", "amount").collect()}
    assert len(long) == 6 and long["total"] == 50.0


# ---- aggregates ------------------------------------------------------------

def test_letter_sets(spark):
    members = [(1, "abc"), (2, "a"), (2, "b"), (2, "c"), (3, "ab"), (3, "ac"), (4, "a"), (4, "a"), (5, "b"), (6, "7")]
    df = spark.createDataFrame(members, "g INT, t STRING")
    out = {r.g: (r.any_member, r.every_member) for r in aggregates.letter_sets(df, "g", "t").collect()}
    assert out == {1: (3, 3), 2: (3, 0), 3: (3, 1), 4: (1, 1), 5: (1, 1), 6: (0, 0)}


def test_null_sums_and_ratio(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, 2.0), ("b", None, None)], "g STRING, x DOUBLE, y DOUBLE")
    out = {r.g: (r.top, r.bottom, r.ratio) for r in aggregates.ratio_of_sums(df, ["g"], "x", "y").collect()}
    assert out == {"a": (1.0, 4.0, 0.25), "b": (0.0, 0.0, None)}


def test_distinct_counts_missing_as_a_value(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "a")], "x INT, y STRING")
    assert {r["column"]: r.n_distinct for r in aggregates.distinct_per_column(df).collect()} == {"x": 2, "y": 2}
    assert aggregates.levels_per_factor(df).collect() == [("y", 1, 0)]
    assert aggregates.missing_per_column(df).collect() == [("y", 1, 1 / 3)]


def test_bins_close_on_the_right(spark):
    out = aggregates.histogram(column(spark, [-1.0, 1.0, 1.5, 3.0, 3.1], "DOUBLE"), "x", 2.0)
    assert {float(r.bin): r.n for r in out.collect()} == {-2.0: 1, 0.0: 1, 2.0: 2, 4.0: 1}


# ---- column functions ------------------------------------------------------

def test_durations(spark):
    texts = ["2 years", "6 months", "1 week", "73 days", None, "5 parsecs"]
    got = apply(spark, recode.duration_years, texts)
    assert got[:5] == [2.0, 0.5, pytest.approx(1 / 52.1429), 0.2, None] and got[5] == pytest.approx(5 / 365)
    assert apply(spark, lambda c: recode.duration_years(c, False), ["5 parsecs", "1 year"]) == [None, 1.0]


def test_first_match_order(spark):
    texts = ["Black Tabby/White", "Torbie/White", "Torbie", "Blue Tick", "Red", "Black Smoke", None]
    assert apply(spark, lambda c: recode.first_match(c, recode.COLOUR_FAMILIES), texts) == [
        "Tabby", "Multiple Colors", "Tortie/Torbie", "Blue", "Red", "Black", None]


def test_sex_and_status(spark):
    texts = ["Spayed Female", "Intact Male", "Unknown"]
    assert apply(spark, lambda c: recode.first_match(c, recode.SEX), texts) == ["Female", "Male", "Unknown"]
    assert apply(spark, lambda c: recode.first_match(c, recode.STATUS), texts) == ["Spayed/Neutered", "Intact", "Unknown"]


def test_holidays(spark):
    days = ["2015-11-26", "2015-12-24", "2015-12-25", "2016-01-01", "2015-11-19"]
    df = column(spark, days).select("i", *[c.alias(n) for n, c in dates.holiday_flags(F.to_date("x")).items()])
    got = [[n for n in dates.HOLIDAYS if r[n]] for r in df.orderBy("i").collect()]
    assert got == [["thanksgiving"], ["christmas_eve"], ["christmas"], ["new_year"], []]


def test_letter_rules(spark):
    rows = [(1, 2, "m", "maple"), (1, 3, "q", "river"), (2, 4, "o", "ooooo"), (1, 99, "x", "xyz")]
    df = spark.createDataFrame(rows, "low INT, high INT, letter STRING, word STRING")
    w, l = F.col("word"), F.col("letter")
    got = df.select(text.letter_count_between(w, l, F.col("low"), F.col("high")).alias("a"),
                    text.letter_at_one_of(w, l, F.col("low"), F.col("high")).alias("b")).collect()
    assert [r.a for r in got] == [True, False, False, True]
    assert [r.b for r in got] == [True, False, False, True]


def test_seats(spark):
    seats = ["FBFBBFFRLR", "FFFFFFFLLL", "BBBBBBBRRR", "BFBFBFBLRL"]
    got = [(r.n, r.r, r.c, r.back) for r in column(spark, seats).select("i", codes.seat_number(F.col("x")).alias("n"),
           codes.seat_row(F.col("x")).alias("r"), codes.seat_column(F.col("x")).alias("c"),
           codes.seat_code(codes.seat_number(F.col("x"))).alias("back")).orderBy("i").collect()]
    assert got == [(357, 44, 5, seats[0]), (0, 0, 0, seats[1]), (1023, 127, 7, seats[2]), (682, 85, 2, seats[3])]


def test_grid_walk(spark):
    rng = random.Random(2)
    grid = ["".join(rng.choice(".#") for _ in range(7)) for _ in range(20)]
    for right, down in [(1, 1), (3, 1), (7, 1), (1, 2)]:
        want = sum(grid[r][(r // down * right) % 7] == "#" for r in range(down, 20, down))
        got = column(spark, grid).agg(F.count_if(codes.grid_cell(F.col("x"), F.col("i"), right, down) == "#")).first()[0]
        assert got == want


def test_record_rules(spark):
    good = "byr:1955 iyr:2013 eyr:2024 hgt:66in hcl:#0a1b2c ecl:hzl pid:012345678"
    texts = [
        good, good + " cid:1", good.replace("hgt:66in ", ""), good.replace("1955", "2003"),
        good.replace("66in", "66"), good.replace("66in", "190in"), good.replace("#0a1b2c", "#0a1b2z"),
        good.replace("#0a1b2c", "0a1b2c"), good.replace("hzl", "red"), good.replace("012345678", "0123456789"),
        good.replace("1955", "soon"), good + " byr:1900", " ".join(f"x{i}:1" for i in range(7)),
    ]
    got = apply(spark, lambda c: validate.record_valid(text.key_values(c)), texts)
    assert got == [True, True] + [False] * 11


def test_text_helpers(spark):
    assert apply(spark, text.money, ["$1,234.50", "n/a", None]) == [1234.5, None, None]
    assert apply(spark, text.first_number, ["a12b3", "none"]) == [12, None]
    assert apply(spark, recode.parse_whole, ["7", "NA", None]) == [7, None, None]
    assert apply(spark, lambda c: recode.case_map(c, {"a": 1}), ["a", "b"]) == [1, None]
    assert apply(spark, dates.month_day_year, ["Dec 11, 2019"])[0].isoformat() == "2019-12-11"


# ---- features and splits ---------------------------------------------------

def test_two_standard_deviations(spark):
    df = column(spark, [1.0, 2.0, 4.0], "DOUBLE")
    for ddof, sd in ((1, 1.527525), (0, 1.247219)):
        z = features.standardize(df, df, ["x"], ddof).orderBy("i").first().x
        assert z == pytest.approx((1 - 7 / 3) / sd, abs=1e-6)


@pytest.mark.parametrize("drop,kept", [("last", "ab"), ("first", "bc"), (None, "abc")])
def test_one_hot_conventions(spark, drop, kept):
    df = column(spark, ["a", "b", "c", "z", None])
    out = features.one_hot(df, "x", ["a", "b", "c"], drop).orderBy("i")
    assert out.columns[2:] == list(kept)
    assert [tuple(r)[2:] for r in out.collect()] == [tuple(int(v == k) for k in kept) for v in ["a", "b", "c", "z", None]]


def test_fits_come_from_the_fit_table(spark):
    fit, new = column(spark, [1, 2, 3, 10], "INT"), column(spark, [None, 7], "INT")
    assert [r.x for r in features.impute_median(fit, new, "x").orderBy("i").collect()] == [2.5, 7.0]
    words, gaps = column(spark, ["b", "a", "a", "b"]), column(spark, [None, "c"])
    assert [r.x for r in features.impute_mode(words, gaps, "x").orderBy("i").collect()] == ["a", "c"]


def test_random_draw_takes_observed_values(spark):
    df = column(spark, ["a", None, "b", None, None, "a"])
    out = {r.i: r.x for r in features.impute_random_draw(df, df, "x", "i", "i").collect()}
    assert len(out) == 6 and out[0] == "a" and set(out.values()) <= {"a", "b"}
    again = {r.i: r.x for r in features.impute_random_draw(df, df, "x", "i", "i").collect()}
    assert out == again


def test_constant_and_near_constant_columns(spark):
    df = spark.range(200).select(
        "id", F.lit(1).alias("one"), F.lit(None).cast("int").alias("none"),
        F.when(F.col("id") > 0, 1).alias("gap"), (F.col("id") == 0).cast("int").alias("rare"),
        (F.col("id") % 2).alias("half"),
    )
    assert features.drop_constant_columns(df).columns == ["id", "gap", "rare", "half"]
    assert features.drop_near_constant_columns(df).columns == ["id", "half"]


def test_unseen_level_sets_no_flag(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    fit, new = column(spark, ["a", "b", "a"]), column(spark, ["a", "q"])
    model = Pipeline(stages=features.column_transformer_stages(fit, {"x": ["a", "b"]}, ids=["i"])).fit(fit)
    got = model.transform(new).orderBy("i").select(vector_to_array("features").alias("v")).collect()
    assert [r.v for r in got] == [[1.0, 0.0], [0.0, 0.0]]


def test_folds(spark):
    df = column(spark, ["X"] * 10 + ["Y"] * 5)
    sizes = {}
    for r in resample.kfold(df, "i", 5, strata=["x"]).collect():
        sizes[(r.fold, r.x)] = sizes.get((r.fold, r.x), 0) + 1
    assert sizes == {(f, v): n for f in range(5) for v, n in (("X", 2), ("Y", 1))}
    plain = [r["count"] for r in resample.kfold(df, "i", 4).groupBy("fold").count().collect()]
    assert sorted(plain) == [3, 4, 4, 4]


def test_even_values():
    assert resample.even_values(2, 50, 3, whole=True) == [2, 26, 50]
    assert resample.even_values(1, 3, 9, whole=True) == [1, 2, 3]
    assert resample.even_values(0.0, 1.0, 3) == [0.0, 0.5, 1.0]


# ---- permutation, graph ----------------------------------------------------

@pytest.mark.parametrize("rows_per_chunk", [1_000_000, 7, 1])
def test_permutation_statistics(spark, rows_per_chunk):
    rng = random.Random(4)
    values = [rng.choice(["a", "a", "b", None]) for _ in range(60)]
    df = column(spark, values)
    simulated = permute.simulated_runs(df, "i", "x", 3, 6, seed=2, rows_per_chunk=rows_per_chunk)
    keys = [r.i for r in df.orderBy("i").collect()]
    of = {r.i: r.x for r in df.collect()}
    orders = {}
    for rep in range(1, 7):
        place = dict(zip(keys, permute.draws(np.array(keys), rep, 2).tolist()))
        assert len(set(place.values())) == len(keys)
        orders[rep] = [of[k] for k in sorted(keys, key=place.get)]
    count = lambda seq: sum(len(list(g)) >= 3 for _, g in itertools.groupby(seq))
    assert {r.rep: r.long_runs for r in simulated.collect()} == {k: count(v) for k, v in orders.items()}
    observed = permute.observed_runs(df, "i", "x", 3)
    got = permute.p_value(simulated, observed, 6).first()
    assert got.observed == count(values)
    assert got.p_value == sum(count(v) >= count(values) for v in orders.values()) / 6


def test_fits_read_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100)
    df = spark.range(0, 1_000, 1, 1)
    sizes = [r["count"] for r in models.spread(df).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1_000 and max(sizes) <= 110
    small = spark.range(0, 100, 1, 1)
    assert models.spread(small) is small
    seen = []
    monkeypatch.setattr(models, "cut_lineage", lambda d: seen.append(d) or d)
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(df.select("id", F.col("id").alias("x"), (F.col("id") % 2).cast("double").alias("label")))
    models.cross_validate({"tree": models.decision_tree(depth=1)}, rows, "id", 2)
    assert max(r["count"] for r in seen[0].groupBy(F.spark_partition_id()).count().collect()) <= 110


@pytest.mark.parametrize("machine", [bagging, boosting])
def test_rows_of_one_kind_are_one_row_in_trees(spark, monkeypatch, machine):
    """2,000 rows of 8 kinds: no written table of a fit but that of the bins has more than kinds times trees rows."""
    sizes = {}

    def spy(df, label, real=machine.written):
        made = real(df, label)
        sizes.setdefault(label, []).append(made.count())
        return made

    monkeypatch.setattr(machine, "written", spy)
    rows = spark.range(2_000).select("id", (F.col("id") % 8).cast("double").alias("a"), (F.col("id") % 8 > 3).cast("int").alias("y"))
    if machine is bagging:
        model = bagging.fit_bag(rows, "id", ["a"], "y", 2, bagging.Bag(trees=3, depth=2))
        scored = bagging.predict_bag(model, rows, ["a"])
        assert sizes["bagged-rows"] == [24]
    else:
        model = boosting.fit_boosted_classes(rows, "id", ["a"], "y", 2, boosting.Settings(rounds=3, depth=2, rows=0.9))
        scored = boosting.predict_boosted_classes(model, rows, ["a"])
        assert sizes["boosted-rows"] == [8, 8, 8]
    assert scored.where("prediction <> y").isEmpty()


def test_a_visit_brings_back_only_what_lies_within_the_bound():
    """A query that knows its k-th distance gets no rows beyond it; one that does not gets k."""
    rng = np.random.default_rng(3)
    rows = rng.normal(size=(700, 4))
    table = lambda ids, v, **more: pa.table({"id": ids, "vec": pa.array(list(v), pa.list_(pa.float64())), **more})
    left = table(np.arange(700), rows, label=np.arange(700) % 3)
    d = ((rows[:600, None] - rows[None]) ** 2).sum(2)
    d[np.arange(600), np.arange(600)] = np.inf
    bound = np.where(np.arange(600) % 2 == 0, np.sort(d, axis=1)[:, 1], np.nan)
    got = neighbours._block_best(left, table(np.arange(600), rows[:600], bound=pa.array(bound, from_pandas=True)), 5).to_pylist()
    found = {}
    for r in got:
        found.setdefault(r["query"], []).append(r["neighbour"])
    for i in range(600):
        assert found[i] == np.argsort(d[i], kind="stable")[:2 if i % 2 == 0 else 5].tolist()


def test_orders_travel_in_few_bytes():
    """Places and values of 200,000 rows: under three bytes a row and order, where a place alone has four."""
    rng = np.random.default_rng(2)
    keys, codes = rng.permutation(400_000)[:200_000], rng.integers(-2**62, 2**62, 5)[rng.integers(0, 5, 200_000)]
    block = permute._blocks([pa.RecordBatch.from_arrays([pa.array(keys), pa.array(codes)], names=["key", "code"])], 1)
    rows = [r for b in permute._pack(block, replicates=4, parts=1, seed=2, chunks=3) for r in b.to_pylist()]
    assert sum(r["n"] for r in rows) == 800_000 and {(r["rep"], r["chunk"]) for r in rows} == {(r, c) for r in range(1, 5) for c in range(3)}
    assert sum(len(r["places"]) + len(r["codes"]) + len(r["values"]) for r in rows) < 3 * 800_000


@pytest.mark.parametrize("rows_per_block", [8_000_000, 90])
def test_orders_of_many_values_and_equal_keys(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(permute, "ROWS_PER_BLOCK", rows_per_block)
    rng = random.Random(8)
    rows = [(i // 2, rng.randrange(2) if i < 300 else i) for i in range(600)] + [(None, 5)]
    df = spark.createDataFrame(rows, "i long, x long")
    of = {r.x: r.h for r in df.select("x", F.xxhash64("x").alias("h")).collect()}
    keys = np.array([i or 0 for i, _ in rows])
    for r in permute.simulated_runs(df, "i", "x", 2, 3, seed=2, rows_per_chunk=50).collect():
        seq = [x for _, x in sorted(zip(permute.draws(keys, r.rep, 2).tolist(), (of[x] for _, x in rows)))]
        assert r.long_runs == sum(len(list(g)) >= 2 for _, g in itertools.groupby(seq))


def test_draws_are_spread_evenly():
    place = permute.draws(np.arange(4_000), 3, 11) / 2**32
    assert np.abs(np.histogram(place, 10, (0, 1))[0] - 400).max() < 90
    other = permute.draws(np.arange(4_000), 4, 11) / 2**32
    assert abs(np.corrcoef(place, other)[0, 1]) < 0.05


def edges(spark, *rows):
    return spark.createDataFrame(list(rows), "parent STRING, child STRING, qty BIGINT")


def test_ancestors_and_cycles(spark):
    e = edges(spark, ("a", "b", 1), ("b", "c", 1), ("d", "c", 1), ("c", "x", 1), ("x", "b", 1), ("y", "z", 1))
    target = spark.createDataFrame([("x",)], "node STRING")
    assert {r.node for r in graph.ancestors(e, target).collect()} == {"a", "b", "c", "d", "x"}
    lone = spark.createDataFrame([("a",)], "node STRING")
    assert graph.ancestors(e, lone).collect() == []


def test_items_below_counts_leaves_beside_inner_nodes(spark):
    e = edges(spark, ("a", "b", 1), ("a", "leaf", 5), ("b", "leaf", 2))
    roots = spark.createDataFrame([("a",), ("b",)], "node STRING")
    assert {r.root: r.total for r in graph.items_below(e, roots).collect()} == {"a": 8, "b": 2}


def test_a_deep_chain_takes_few_rounds(spark, monkeypatch):
    from quarrymill.plans import frontier

    rounds, kept = [], frontier._kept
    monkeypatch.setattr(frontier, "_kept", lambda df: rounds.append(1) or kept(df))
    e = spark.range(600).selectExpr("id AS parent", "id + 1 AS child", "1L AS qty")
    roots = spark.createDataFrame([(0,)], "node BIGINT")
    assert graph.items_below(e, roots).first().total == 600
    assert len(rounds) <= 2 * 12  # a join and a doubling per round, where levels would be 600


@pytest.mark.parametrize("rows", [[("a", "b", 2), ("b", "a", 3)], [("a", "b", 2), ("b", "c", 2), ("c", "a", 7)], [("a", "a", 1)]])
def test_items_below_reports_a_cycle(spark, rows):
    from quarrymill.plans import frontier

    start = spark.createDataFrame([("a", "a", 1)], "root STRING, node STRING, mult BIGINT")
    with pytest.raises(ValueError, match="cycle"):
        frontier.weighted_reach(edges(spark, *rows), start, "parent", "child", "qty")


@pytest.mark.parametrize("few", [100_000, 0])
def test_walks_equal_plain_ones(spark, monkeypatch, few):
    """With ``few`` at zero the jumps stay short and the walk goes on in strides."""
    from quarrymill.plans import frontier

    monkeypatch.setattr(frontier, "FEW", few)
    monkeypatch.setattr(frontier, "DENSE", 1)
    rng = random.Random(3)
    rows = [(f"n{a}", f"n{b}", rng.randint(1, 3)) for b in range(1, 30) for a in rng.sample(range(b), min(b, 2))]
    below = {}
    for a, b, q in reversed(rows):  # children are numbered above their parents
        below.setdefault(a, []).append((b, q))

    def total(node):
        counts = {}
        for b, q in below.get(node, []):
            counts[b] = counts.get(b, 0) + q
            for c, n in total(b).items():
                counts[c] = counts.get(c, 0) + q * n
        return counts

    e = edges(spark, *rows)
    start = spark.createDataFrame([("n0", "n0", 1)], "root STRING, node STRING, mult BIGINT")
    got = frontier.weighted_reach(e, start, "parent", "child", "qty")
    assert {r.node: r.mult for r in got.collect()} == total("n0")
    pairs = sorted((r.ancestor, r.descendant) for r in graph.closure(e).collect())
    assert pairs == sorted((f"n{i}", d) for i in range(30) for d in total(f"n{i}"))


def test_letters_of_a_null_group(spark):
    df = spark.createDataFrame([(None, "ab"), (None, "bc"), ("g", "xy"), ("g", None)], "g STRING, x STRING")
    got = {r.g: (r.any_member, r.every_member) for r in aggregates.letter_sets(df, "g", "x").collect()}
    assert got == {None: (3, 1), "g": (2, 0)}


def _four_classes(spark, n=400):
    rng = random.Random(5)
    rows = [(i, float(rng.randint(0, 20)), rng.random()) for i in range(n)]
    return spark.createDataFrame([(i, a, b, 2 * (a > 9) + (b > 0.4)) for i, a, b in rows], "i INT, a DOUBLE, b DOUBLE, y INT").repartition(4)


def test_boosting_learns_four_classes(spark):
    df = _four_classes(spark)
    train, test = df.where("a % 4 <> 2"), df.where("a % 4 = 2")  # whole values of a are held out
    settings = boosting.Settings(rounds=6, depth=2, rate=0.5, bins=32)
    model = boosting.fit_boosted_classes(train, "i", ["a", "b"], "y", 4, settings)
    scored = boosting.predict_boosted_classes(model, test, ["a", "b"]).collect()
    assert sum(r.prediction == r.y for r in scored) >= 0.97 * len(scored)
    assert all(abs(sum(r.probability) - 1) < 1e-9 for r in scored)
    loss = -sum(math.log(r.probability[r.y]) for r in scored) / len(scored)
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).withColumnRenamed("y", "label")
    plain = models.logistic(0.0001).fit(rows.where("a % 4 <> 2")).transform(rows.where("a % 4 = 2"))
    by_line = -sum(math.log(max(1e-15, r.probability[r.label])) for r in plain.collect()) / len(scored)
    assert loss < by_line < 1.4


def test_boosting_repeats_and_keeps_its_shares(spark):
    df = _four_classes(spark, 120).withColumn("y", F.when(F.col("i") % 10 > 0, F.col("y")))
    settings = boosting.Settings(rounds=2, depth=2, rows=0.7, columns=0.5)
    one, two = (boosting.fit_boosted_classes(d, "i", ["a", "b"], "y", 4, settings) for d in (df, df.repartition(7)))
    assert [[(t.feature, t.cut) for t in ts] for ts in one.trees] == [[(t.feature, t.cut) for t in ts] for ts in two.trees]
    used = [{f for f in t.feature if f >= 0} for ts in one.trees for t in ts]
    assert all(len(u) <= 1 for u in used)  # half of two columns per tree


def test_a_bag_learns_classes_and_values(spark):
    rows = [(i, float(i % 8), float(i // 8 % 8), float(i * 37 % 11), int(i % 8 > 3) * 2 + int(i // 8 % 8 > 5)) for i in range(640)]
    df = spark.createDataFrame(rows, "i BIGINT, a DOUBLE, b DOUBLE, noise DOUBLE, y INT").withColumn("v", F.col("y") * 10.0)
    train, test = df.where("(a + 8 * b) % 5 <> 2"), df.where("(a + 8 * b) % 5 = 2")
    settings = bagging.Bag(trees=15, depth=3)
    model = bagging.fit_bag(train, "i", ["a", "b", "noise"], "y", 4, settings)
    scored = bagging.predict_bag(model, test, ["a", "b", "noise"]).collect()
    assert scored and all(r.prediction == r.y and abs(sum(r.probability) - 1) < 1e-9 for r in scored)
    values = bagging.fit_bag(train, "i", ["a", "b", "noise"], "v", None, settings)
    assert all(abs(r.prediction - r.v) < 2 for r in bagging.predict_bag(values, test, ["a", "b", "noise"]).collect())


def test_a_bag_repeats_and_its_trees_see_their_columns_only(spark):
    rows = [(i, float(i % 8), float(i % 5), float(i % 3), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "i BIGINT, a DOUBLE, b DOUBLE, c DOUBLE, y INT")
    settings = bagging.Bag(trees=9, depth=3, columns=0.67, rows=0.8)
    one, two = (bagging.fit_bag(d, "i", ["a", "b", "c"], "y", 2, settings) for d in (df, df.repartition(7)))
    assert one == two
    size = one.size
    used = [set(one.feature[t * size:(t + 1) * size]) - {-1} for t in range(9)]
    assert all(len(c) == 2 and u <= set(c) for c, u in zip(one.columns, used))
    assert len({tuple(c) for c in one.columns}) > 1 and len({tuple(one.feature[t * size:(t + 1) * size]) for t in range(9)}) > 1


def test_weights_of_a_bag_are_poisson_draws(spark):
    drawn = spark.range(20_000).select(F.explode(bagging.weights(F.col("id"), bagging.Bag(trees=2, rows=1.0))).alias("w"))
    counts = {r.w: r["count"] / 40_000 for r in drawn.groupBy("w").count().collect()}
    assert abs(counts[0] - 0.3679) < 0.01 and abs(counts[1] - 0.3679) < 0.01 and abs(counts[3] - 0.0613) < 0.01


def test_a_bag_with_nulls_and_without_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 5.0, 1), (3, None, 0), (4, 6.0, 1), (5, 1.0, None)] * 4, "i BIGINT, a DOUBLE, y INT")
    model = bagging.fit_bag(df, "i", ["a"], "y", 2, bagging.Bag(trees=25, depth=2))
    assert {(r.a, r.prediction) for r in bagging.predict_bag(model, df, ["a"]).collect()} == {(None, 0), (1.0, 1), (5.0, 1), (6.0, 1)}
    with pytest.raises(ValueError):
        bagging.fit_bag(df.where("y IS NULL"), "i", ["a"], "y", 2)


def test_a_picked_grid_has_one_point_in_every_stratum():
    points = resample.spread_points({"n": (0, 250), "x": (0.0, 1.0), "z": (-1.0, 1.0)}, 25, seed=3)
    assert points == resample.spread_points({"n": (0, 250), "x": (0.0, 1.0), "z": (-1.0, 1.0)}, 25, seed=3)
    assert sorted(int(p["x"] * 25) for p in points) == list(range(25))
    assert sorted(int((p["z"] + 1) / 2 * 25) for p in points) == list(range(25))
    assert sorted(p["n"] for p in points) == [10 * i + 5 for i in range(25)]
    one = resample.spread_points({"x": (0.0, 1.0), "z": (0.0, 1.0)}, 25, designs=1, seed=3)
    gap = lambda ps: min((a["x"] - b["x"]) ** 2 + (a["z"] - b["z"]) ** 2 for i, a in enumerate(ps) for b in ps[:i])
    assert gap(resample.spread_points({"x": (0.0, 1.0), "z": (0.0, 1.0)}, 25, seed=3)) >= gap(one)
    assert resample.spread_points({"x": (2.0, 4.0)}, 1) == [{"x": 3.0}]


def test_boosting_without_rows_or_with_nulls(spark):
    empty = spark.createDataFrame([], "i INT, a DOUBLE, y INT")
    model = boosting.fit_boosted_classes(empty, "i", ["a"], "y", 3, boosting.Settings(rounds=1))
    some = spark.createDataFrame([(1, None)], "i INT, a DOUBLE")
    row = boosting.predict_boosted_classes(model, some, ["a"]).first()
    assert [round(p, 9) for p in row.probability] == [round(1 / 3, 9)] * 3 and row.prediction == 0


def test_accuracy_by_number_of_neighbours(spark):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(3 * (i % 2), 1.5), rng.gauss(0, 1)], i % 2, i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "i INT, v ARRAY<DOUBLE>, y INT, fold INT")
    got = {r.k: r.accuracy for r in neighbours.accuracy_by_k(df, "i", "v", "y", "fold", 7).collect()}
    for k in range(1, 8):
        hits = 0
        for i, v, y, fold in rows:
            near = sorted((round(sum((a - b) ** 2 for a, b in zip(v, w)), 9), j, z) for j, w, z, f in rows if f != fold)[:k]
            ones = sum(z for _, _, z in near)
            hits += int(2 * ones > k) == y
        assert got[k] == pytest.approx(hits / 60)
    best = neighbours.best_k(neighbours.accuracy_by_k(df, "i", "v", "y", "fold", 7)).first()
    assert best.accuracy == max(got.values()) and best.k == min(k for k in got if got[k] == best.accuracy)


def test_closure(spark):
    e = edges(spark, ("a", "b", 1), ("b", "c", 1), ("c", "d", 1), ("a", "c", 1))
    got = sorted((r.ancestor, r.descendant) for r in graph.closure(e).collect())
    assert got == [("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d")]


def test_neighbour_lists(spark):
    out = graph.neighbours(column(spark, [1, 4, 5, 20], "INT"), "x", 1, 3, "above")
    assert {r.v: r.above for r in out.collect()} == {1: [4], 4: [5], 5: [], 20: []}


# ---- metrics and models ----------------------------------------------------

def test_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.4), (0, 2, 0.1)], "t INT, g INT, s DOUBLE")
    scores = {r["class"]: (r.precision, r.recall, r.f1) for r in metrics.class_scores(df, "t", "g").collect()}
    assert scores == {0: (0.5, 0.5, 0.5), 1: (1.0, 0.5, pytest.approx(2 / 3)), 2: (0.0, None, None)}
    assert metrics.roc_auc(df, "t", "s").first().auc == pytest.approx(3.5 / 4)
    assert df.agg(metrics.accuracy("t", "g")).first()[0] == 0.5
    p = column(spark, [0.5, 0.25], "DOUBLE")
    assert p.agg(metrics.log_loss(F.col("x"))).first()[0] == pytest.approx(1.039721, abs=1e-6)


def blobs(spark, n=90):
    rng = random.Random(9)
    rows = [(i, i % 3, [rng.gauss(4 * (i % 3), 0.5), rng.gauss(-3 * (i % 3), 0.5)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id BIGINT, label INT, v ARRAY<DOUBLE>")


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_nearest_neighbours_by_blocks(spark, block_rows):
    rows, df = blobs(spark, 40)
    got = {}
    for r in neighbours.nearest(df, df, "id", "v", "label", 3, block_rows).collect():
        got.setdefault(r.query, []).append((r.place, r.neighbour))
    dist = lambda a, b: round(sum((x - y) ** 2 for x, y in zip(a, b)), 9)
    for i, _, v in rows:
        want = [j for _, j in sorted((dist(v, w), j) for j, _, w in rows if j != i)[:3]]
        assert [j for _, j in sorted(got[i])] == want


@pytest.mark.parametrize("quadratic", [False, True])
def test_discriminants(spark, quadratic):
    _, df = blobs(spark)
    model = models.fit_discriminant(df, "label", "v", quadratic)
    scored = models.predict_discriminant(model, df, "v")
    assert scored.agg(metrics.accuracy("label", "prediction")).first()[0] > 0.95


def test_adaboost_learns_more_than_one_stump(spark):
    _, df = blobs(spark)
    rows = models.embedding_rows(df, "v")
    learners = models.fit_adaboost(rows, 3, rounds=4)
    acc = models.predict_adaboost(learners, rows, 3).agg(metrics.accuracy("label", "prediction")).first()[0]
    assert len(learners) > 1 and acc > 0.95


def test_normalised_scores(spark):
    df = spark.createDataFrame([([1.0, 1.0],), ([1000.0, 0.0],)], "raw ARRAY<DOUBLE>")
    got = [r.p for r in df.select(models.normalised_scores(F.col("raw")).alias("p")).collect()]
    assert got == [[0.5, 0.5], [1.0, 0.0]]


# ---- projection ------------------------------------------------------------

def test_projection_helpers(spark):
    df = spark.createDataFrame([(1, "a", 2.0, "4")], "x INT, y STRING, z DOUBLE, w STRING")
    assert project.select_range(df, "y", "z").columns == ["y", "z"]
    assert project.move_columns(df, ["w"], after="x").columns == ["x", "w", "y", "z"]
    assert project.move_columns(df, ["w"], before="z").columns == ["x", "y", "w", "z"]
    assert project.rename_by_pattern(df, "^x", "k").columns == ["k", "y", "z", "w"]
    assert project.numeric_columns(df) == ["x", "z"] and project.text_columns(df) == ["y", "w"]
    assert project.cast_columns(df, {"w": "int", "y": "int"}).first().asDict() == {"x": 1, "y": None, "z": 2.0, "w": 4}


def test_required_columns_fail_loudly(spark):
    df = column(spark, ["a", None])
    with pytest.raises(Exception, match="missing value in x"):
        project.require_no_nulls(df, ["x"]).collect()
    assert project.require_no_nulls(df.where("x = 'a'"), ["x"]).count() == 1


# ---- nulls, empty input, large numbers --------------------------------------

def test_a_null_key_is_a_group_with_a_maximum(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("a", None)], "k STRING, v INT")
    assert sorted(map(tuple, joins.rows_at_group_max(df, ["k"], "v").collect()), key=str) == [("a", 3), (None, 2)]


def test_products_and_sums_wider_than_an_int(spark):
    df = column(spark, [100_000, 100_001, 5], "INT")
    assert joins.pair_sums(df, "x", 200_001).collect() == [(100_000, 100_001, 100_000 * 100_001)]


def test_triple_sums_with_negative_values_and_a_far_target(spark):
    values = [-5, -2, 0, 0, 1, 4, 7, 7, 3_000_000_000, 2_999_999_997]
    from itertools import combinations

    for target in (0, 9, 14, 6_000_000_000, 1 << 40):
        want = {tuple(sorted(c)) for c in combinations(values, 3) if sum(c) == target}
        got = joins.triple_sums(column(spark, values, "BIGINT"), "x", target)
        assert {(r.a, r.b, r.c) for r in got.collect()} == want
    assert joins.triple_sums(column(spark, [], "BIGINT"), "x", 3).collect() == []


@pytest.mark.parametrize("bandwidth", [None, 0.01, 3.0])
def test_density_equals_the_sum_of_kernels(spark, bandwidth):
    rng = random.Random(4)
    xs = [rng.gauss(0, 1) for _ in range(300)] + [rng.uniform(40, 41) for _ in range(100)] + [None]
    got = sorted(aggregates.density(column(spark, xs, "DOUBLE"), "x", 37, bandwidth).collect())
    xs = xs[:-1]
    mean = sum(xs) / len(xs)
    h = bandwidth or math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) * len(xs) ** -0.2
    peak = 1 / (h * math.sqrt(2 * math.pi))
    assert [r.grid_no for r in got] == list(range(37)) and abs(got[36].grid_x - max(xs)) < 1e-9
    for r in got:
        want = peak * sum(math.exp(-0.5 * ((r.grid_x - x) / h) ** 2) for x in xs) / len(xs)
        assert abs(r.density - want) < 5e-11 * peak


def test_density_of_a_constant_a_single_and_no_value(spark):
    assert aggregates.density(column(spark, [], "DOUBLE"), "x", 5).collect() == []
    for values in ([2.0], [2.0, 2.0, None]):
        row, = aggregates.density(column(spark, values, "DOUBLE"), "x", 5).collect()
        assert (row.grid_x, row.density, row["mean"]) == (2.0, None, 2.0)
    twice = aggregates.density(column(spark, [1.0, 1.0, 4.0], "DOUBLE"), "x", 5, bandwidth=1.0).collect()
    assert len(twice) == 5 and max(twice, key=lambda r: r.density).grid_x == 1.0


def test_random_draw_from_nothing_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "i INT, x INT")
    assert sorted(map(tuple, features.impute_random_draw(df, df, "x", "i", "i").collect())) == [(1, None), (2, None)]


def test_wide_draws_reach_beyond_32_bits(spark):
    from quarrymill.functions.hashing import hash_wide

    top = spark.range(200).agg(F.max(hash_wide("id")), F.min(hash_wide("id"))).first()
    assert (1 << 59) < top[0] < (1 << 60) and 0 <= top[1]


def test_open_categories_become_sparse_vectors(spark):
    fit = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "x STRING")
    levels = features.levels(fit, "x")
    assert sorted(map(tuple, levels.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    apply = spark.createDataFrame([("a",), ("c",), ("new",), (None,)], "x STRING")
    got = {r.x: r.v.toArray().tolist() for r in features.sparse_one_hot(apply, "x", levels, "v").collect()}
    assert got == {"a": [1, 0, 0], "c": [0, 0, 1], "new": [0, 0, 0], None: [0, 0, 0]}


def test_contiguous_sum_takes_the_first_slice_and_wants_positive_values(spark):
    df = spark.createDataFrame(list(enumerate([3, 4, 3, 4, 3])), "i INT, x INT")
    assert ordered.contiguous_sum(df, "i", "x", 7).first().first_idx == 1
    with pytest.raises(ValueError):
        ordered.contiguous_sum(df.withColumn("x", F.lit(0)), "i", "x", 7)


def test_current_ratio_is_the_last_running_one(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}", None if i == 5 else i % 4 == 0) for i in range(40)], "i INT, t STRING, w BOOLEAN")
    history = ordered.running_ratio(df, ["t"], ["i"], F.col("w"), "i")
    last = joins.last_state(history, ["t"], ["i"], ["i", "wins", "losses", "ratio"])
    assert set(last.collect()) == set(ordered.current_ratio(df, ["t"], F.col("w"), "i").select(*last.columns).collect())


def test_far_cells_are_not_visited(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 5)) * 100
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=5)]) for i in range(600)]
    df = spark.createDataFrame(rows, "id INT, v ARRAY<DOUBLE>")
    reach = neighbours.cells_in_reach(F.col("v"), F.lit(25.0), F.lit(0), centres, np.full(12, 6.0))
    visited = df.select(F.size(reach).alias("n")).agg(F.sum("n")).first()[0]
    assert visited < 600 * 2  # of 600 * 11
    unbounded = neighbours.cells_in_reach(F.col("v"), F.lit(None).cast("double"), F.lit(0), centres, np.full(12, 6.0))
    assert {r.n for r in df.select(F.size(unbounded).alias("n")).collect()} == {11}


@pytest.mark.parametrize("n,block_rows", [(700, 8192), (700, 40), (130, 7)])
def test_nearest_rows_of_clusters_equal_brute_force(spark, n, block_rows):
    import numpy as np

    rng = np.random.default_rng(n)
    points = rng.normal(size=(9, 4))[rng.integers(0, 9, n)] * 20 + rng.integers(0, 3, (n, 4))  # with ties
    df = spark.createDataFrame([(i, [float(x) for x in p], i % 3) for i, p in enumerate(points)], "id INT, v ARRAY<DOUBLE>, l INT")
    got = {}
    for r in neighbours.nearest(df, df, "id", "v", "l", 5, block_rows).collect():
        got.setdefault(r["query"], []).append((r.place, r.neighbour))
    for i in range(n):
        d = np.round(np.maximum(((points - points[i]) ** 2).sum(1), 0), 9)
        want = sorted((d[j], j) for j in range(n) if j != i)[:5]
        near = [j for _, j in sorted(got[i])]
        assert np.allclose([d[j] for j in near], [x for x, _ in want], atol=1e-8)


def test_a_shared_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from quarrymill.session import shared_dir

    def session(master, named=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None)
        return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: named))

    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_dir(session(master))
        assert shared_dir(session(master, "hdfs:///shared")) == "hdfs:///shared"
    assert shared_dir(session("local[4]")) and shared_dir(session("local"))


def test_scratch_tables_go_with_the_session(spark, tmp_path):
    from quarrymill import session

    table = session.written(spark.range(3), "t")
    path = table.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    import os

    kept = dict(session._SCRATCH)
    mine = {k: v for k, v in kept.items() if path.endswith(k.rpartition("/")[2])}
    assert len(mine) == 1 and os.path.isdir(path)
    session._SCRATCH.clear()
    session._SCRATCH.update(mine)
    session._clear_scratch()
    assert not os.path.exists(path) and not session._SCRATCH
    session._SCRATCH.update({k: v for k, v in kept.items() if k not in mine})


def test_areas_between_all_pairs_of_classes(spark):
    rows = [("a", 3.0, 1.0, 0.0), ("a", 2.0, 1.0, None), ("b", 2.0, 4.0, 1.0), ("b", 1.0, 1.0, 1.0), ("c", 2.0, 0.0, 5.0), (None, 9.0, 9.0, 9.0)]
    df = spark.createDataFrame(rows, "y STRING, a DOUBLE, b DOUBLE, c DOUBLE")
    got = {(r["class"], r.against): r.auc for r in metrics.roc_auc_pairs(df, "y", {"a": "a", "b": "b", "c": "c", "d": "a"}).collect()}
    place = {"a": 1, "b": 2, "c": 3, "d": 1}

    def plain(own, other):
        mine = [r[place[own]] for r in rows if r[0] == own and r[place[own]] is not None]
        theirs = [r[place[own]] for r in rows if r[0] == other and r[place[own]] is not None]
        wins = [(x > y) + (x == y) / 2 for x in mine for y in theirs]
        return sum(wins) / len(wins) if wins else None

    assert got == {(x, y): plain(x, y) for x in place for y in place if x != y}
    mean = metrics.roc_auc_hand_till(metrics.roc_auc_pairs(df, "y", {"a": "a", "b": "b", "c": "c"})).head().auc
    assert abs(mean - sum(plain(x, y) for x in "abc" for y in "abc" if x != y) / 6) < 1e-12
    assert metrics.roc_auc_hand_till(metrics.roc_auc_pairs(df.limit(0), "y", {"a": "a", "b": "b"})).head().auc is None


def test_counts_of_other_levels_are_kept(spark):
    df = spark.createDataFrame([("a", "F"), ("a", "Q"), ("a", None), ("b", "O"), (None, "F")], "k STRING, s STRING")
    got = {r.k: tuple(r)[1:] for r in aggregates.cross_counts(df, "k", "s", ["F", "O"], "n_").collect()}
    assert got == {"a": (1, 0, 2), "b": (0, 1, 0), None: (1, 0, 0)}
    assert aggregates.cross_counts(df, "k", "s", ["F"], other=None).columns == ["k", "F"]


def _blobs(n, seed=3):
    draw = np.random.default_rng(seed)
    y = draw.integers(0, 3, n)
    centre = np.array([[0.0, 0.0], [900.0, 0.0], [0.0, 9.0]])[y]
    x = centre + draw.normal(size=(n, 2)) * [100.0, 1.0]
    return [(float(a), float(b), int(c)) for (a, b), c in zip(x, y)]


def test_gradient_descent_over_many_shards(spark):
    rows = _blobs(3000)
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, y INT")
    for loss in ("log", "hinge"):
        settings = sgd.Settings(loss=loss, epochs=4, shard_rows=500)
        model = sgd.fit_sgd(df.repartition(7), ["a", "b"], "y", 3, settings)
        again = sgd.fit_sgd(df.repartition(2), ["a", "b"], "y", 3, settings)
        assert np.allclose(model["weights"], again["weights"], rtol=1e-9)
        scored = sgd.predict_sgd(model, df, ["a", "b"])
        assert scored.where("prediction = y").count() > 0.97 * len(rows)
        assert ("probability" in scored.columns) == (loss == "log")
    sums = sgd.predict_sgd(sgd.fit_sgd(df, ["a", "b"], "y", 3, sgd.Settings(epochs=1)), df, ["a", "b"]).select(
        F.aggregate("probability", F.lit(0.0), lambda a, v: a + v).alias("t"))
    assert sums.where("abs(t - 1) > 1e-9").count() == 0


def test_one_shard_equals_plain_gradient_descent(spark):
    rows = _blobs(40)
    settings = sgd.Settings(epochs=3, batch=1000, rate=0.5, penalty=0.01)  # whole batches: order is of no matter
    model = sgd.fit_sgd(spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, y INT"), ["a", "b"], "y", 3, settings)
    x, y = np.array([r[:2] for r in rows]), np.array([r[2] for r in rows])
    z = np.hstack([(x - x.mean(0)) / x.std(0), np.ones((40, 1))])
    w = np.zeros((3, 3))
    for epoch in range(3):
        p = np.exp(z @ w.T)
        slope = ((p / p.sum(1, keepdims=True) - np.eye(3)[y]).T @ z) / 40
        slope[:, :2] += 0.01 * w[:, :2]
        w -= 0.5 / np.sqrt(epoch + 1) * slope
    assert np.allclose(model["weights"] * x.std(0), w[:, :2], atol=1e-9)


def test_gradient_descent_with_gaps_repeated_rows_and_no_rows(spark):
    rows = [(float(i % 2), 1.0, i % 2) for i in range(400)] + [(None, 1.0, 1), (0.0, None, 0), (9.0, 9.0, 7), (9.0, 9.0, None)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, y INT")
    model = sgd.fit_sgd(df, ["a", "b"], "y", 2, sgd.Settings(shard_rows=1))
    scored = sgd.predict_sgd(model, df.where("y < 2"), ["a", "b"])
    assert scored.where("a IS NOT NULL AND b IS NOT NULL AND prediction <> y").count() == 0
    assert scored.where("prediction IS NULL AND probability IS NULL").count() == 2
    with pytest.raises(ValueError):
        sgd.fit_sgd(df.limit(0), ["a", "b"], "y", 2)
    with pytest.raises(ValueError):
        sgd.fit_sgd(df, ["a", "b"], "y", 2, sgd.Settings(loss="square"))


def test_boosting_without_a_better_tree_is_an_error(spark):
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.createDataFrame([(1.0, 0.0), (1.0, 1.0)] * 20, "x DOUBLE, label DOUBLE"))
    with pytest.raises(ValueError):
        models.fit_adaboost(df, classes=2)
