"""The chunked scans against plain Python, with a third of all rows under one key."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarrymill.operators import ordered
from quarrymill.plans import chunked, quantiles


def skewed(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rng.random() < 0.34 else None if rng.random() < 0.05 else f"k{rng.randrange(40)}"
        value = None if rng.random() < 0.1 else rng.randrange(3)
        rows.append((i * 3, key, value))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def rows():
    return skewed()


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "seq BIGINT, key STRING, value BIGINT")


def by_key(rows):
    out = {}
    for seq, key, value in sorted(rows):
        out.setdefault(key, []).append((seq, value))
    return out


# limit -> no key cut, only the hot key cut, nearly every key cut
LIMITS = [1_000_000, 100, 3]


def test_only_large_keys_are_cut(df):
    cut, split = chunked.cut(df, ["key"], "seq", rows_per_chunk=40)
    assert split
    sizes = {(r.key, r._chunk): r["count"] for r in cut.groupBy("key", "_chunk").count().collect()}
    assert max(n for (k, _), n in sizes.items() if k == "hot") <= 40
    assert all((c == chunked.WHOLE) == (k != "hot") for k, c in sizes)
    assert chunked.cut(df, ["key"], "seq")[1] is False


def test_a_table_without_keys_is_cut(df):
    cut, split = chunked.cut(df, [], "seq", rows_per_chunk=20)
    assert split and cut.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 45


@pytest.mark.parametrize("limit", LIMITS)
def test_running_sum_and_number(df, rows, limit):
    got = chunked.running(df, ["key"], ["seq"], {"total": F.col("value"), "no": F.lit(1)}, "seq", limit)
    want = set()
    for key, items in by_key(rows).items():
        total = 0
        for no, (seq, value) in enumerate(items, 1):
            total += value or 0
            want.add((seq, key, total, no))
    assert {(r.seq, r.key, r.total, r.no) for r in got.collect()} == want


@pytest.mark.parametrize("limit", LIMITS)
def test_previous_row(df, rows, limit):
    got = chunked.previous(df, ["key"], ["seq"], {"before": "value"}, "seq", limit)
    want = set()
    for key, items in by_key(rows).items():
        before = None
        for seq, value in items:
            want.add((seq, key, before))
            before = value
    assert {(r.seq, r.key, r.before) for r in got.collect()} == want


def test_without_keys(df, rows):
    got = {r.seq: (r.no, r.before) for r in chunked.previous(
        chunked.row_numbers(df, [], ["seq"], "no", "seq"), [], ["seq"], {"before": "seq"}, "seq"
    ).collect()}
    seqs = sorted(r[0] for r in rows)
    assert got == {s: (i + 1, seqs[i - 1] if i else None) for i, s in enumerate(seqs)}


def test_equal_positions_share_a_chunk_and_stay_right(spark):
    rows = [(i // 100, i) for i in range(500)]
    df = spark.createDataFrame(rows, "day INT, id INT")
    got = chunked.row_numbers(df, [], ["day", "id"], "no", "day")
    assert {(r.id, r.no) for r in got.collect()} == {(i, i + 1) for i in range(500)}
    place = chunked.tie_broken(df, F.col("day"), "id")
    cut = chunked.with_chunks(df, place, rows_per_chunk=20)
    assert cut.groupBy("_chunk").count().agg(F.max("count")).first()[0] <= 40


def test_all_rows_at_one_position_and_empty_table(spark):
    one = spark.createDataFrame([(1, i) for i in range(20)], "p INT, id INT")
    assert sorted(r.no for r in chunked.row_numbers(one, [], ["id"], "no", "p").collect()) == list(range(1, 21))
    assert chunked.row_numbers(one.limit(0), [], ["id"], "no", "p").collect() == []


@pytest.mark.parametrize("block", [5, 7, 100])
def test_lookback_over_block_borders(spark, block):
    values = [random.Random(3).randrange(50) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(values, 1)), "idx INT, v INT")
    frames = {"seen": lambda w: F.collect_list("v").over(w), "low": lambda w: F.min("v").over(w)}
    for r in chunked.lookback(df, [], "idx", 5, frames, block).collect():
        frame = values[max(0, r.idx - 6): r.idx - 1]
        assert r.seen == frame and r.low == (min(frame) if frame else None)


def test_lookback_needs_room(spark):
    with pytest.raises(ValueError):
        chunked.lookback(spark.range(3), [], "id", 9, {}, block=5)


def runs_of(values):
    runs = []
    for v in values:
        if runs and runs[-1][0] == v:
            runs[-1][1] += 1
        else:
            runs.append([v, 1])
    return runs


@pytest.mark.parametrize("limit", LIMITS)
@pytest.mark.parametrize("keys", [["key"], []])
def test_run_lengths(df, rows, keys, limit):
    got = ordered.run_lengths(df, keys, ["seq"], "value", "seq", limit).collect()
    groups = by_key(rows) if keys else {None: [(s, v) for s, _, v in sorted(rows)]}
    want = {
        (key, i, v, n) for key, items in groups.items()
        for i, (v, n) in enumerate(runs_of([v for _, v in items]), 1)
    }
    assert {(r.key if keys else None, r.run_id, r.value, r.len) for r in got} == want
    assert sum(r.len for r in got) == len(rows)


@pytest.mark.parametrize("values", [
    [1] * 40, [1, 2] * 20, [1, 1, 1, 2] * 12, [None] * 10 + [1] * 3 + [None] * 2, [7],
])
@pytest.mark.parametrize("rows_per_chunk", [1, 2, 5])
def test_long_runs_across_chunks(spark, values, rows_per_chunk):
    df = spark.createDataFrame(list(enumerate(values)), "seq INT, v INT")
    cut = chunked.with_chunks(df, "seq", rows_per_chunk, min_chunks=2)
    got = ordered.long_runs(cut, [], ["seq"], "v", 3).first().long_runs
    assert got == sum(n >= 3 for _, n in runs_of(values))


@pytest.mark.parametrize("limit", LIMITS)
def test_long_runs_per_key(df, rows, limit):
    out = ordered.long_runs(df, ["key"], ["seq"], "value", 3, "seq", rows_per_chunk=limit)
    got = {r.key: r.long_runs for r in out.collect()}
    assert got == {
        k: sum(n >= 3 for _, n in runs_of([v for _, v in items])) for k, items in by_key(rows).items()
    }


def test_prefix_short_and_long(df, rows):
    short = ordered.prefix(df, ["key"], ["seq"], 4, "seq", "no")
    want = {s for items in by_key(rows).values() for s, _ in items[:4]}
    assert {r.seq for r in short.collect()} == want
    whole = ordered.prefix(df, ["key"], ["seq"], 5000, "seq", "no")
    assert whole.count() == len(rows)


@pytest.mark.parametrize("values,middle", [
    ([1, 2, 3, 10], 2.5), ([5], 5.0), ([4, 4, 4, 9, 1], 4.0), ([1, None, 3], 2.0), (list(range(101)), 50.0),
])
def test_exact_median(spark, values, middle):
    df = spark.createDataFrame([(v,) for v in values], "x INT")
    assert quantiles.exact_median(df, "x").first().median == middle


@pytest.mark.parametrize("keys", [["key"], []])
def test_carried_rows_are_hash_or_merge_joined(df, keys):
    out = chunked.running(df, keys, ["seq"], {"no": F.lit(1)}, "seq", rows_per_chunk=50)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # the rows themselves are shuffled once: the join reuses the window's partitioning
    assert plan.count("Exchange hashpartitioning(_part") == 1 and "hashpartitioning(coalesce(_chunk" not in plan


def test_no_large_key_means_a_plain_window(df):
    out = chunked.running(df, ["key"], ["seq"], {"no": F.lit(1)}, "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


ORDERS = {
    "asc nulls first": (lambda: [F.col("d").asc(), F.col("id").asc()], lambda: F.col("d")),
    "asc nulls last": (lambda: [F.col("d").asc_nulls_last(), F.col("id").asc()], lambda: F.col("d")),
    "desc nulls last": (lambda: [F.desc("d"), F.desc("id")], lambda: -F.col("d")),
    "desc nulls first": (lambda: [F.desc_nulls_first("d"), F.col("id").asc()], lambda: -F.col("d")),
    "by name": (lambda: ["d", "id"], lambda: F.col("d")),
}


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("order", ORDERS)
def test_rows_without_a_position_come_where_the_order_puts_nulls(spark, order, keys):
    rng = random.Random(7)
    rows = [("a" if i < 40 else "b", None if rng.random() < 0.2 else rng.randrange(30), i) for i in range(50)]
    df = spark.createDataFrame(rows, "k STRING, d INT, id INT")
    by, place = ORDERS[order]
    plain = df.withColumn("no", F.row_number().over(Window.partitionBy(*keys).orderBy(*by())))
    want = {(r.id, r.no) for r in plain.collect()}
    for limit in (3, 1_000):
        got = chunked.row_numbers(df, keys, by(), "no", place(), limit)
        assert {(r.id, r.no) for r in got.collect()} == want


def test_a_missing_tie_breaker_counts_as_the_least(spark):
    rows = [(i // 10, None if i % 10 == 0 else i) for i in range(100)]
    df = spark.createDataFrame(rows, "day INT, id INT")
    place = chunked.tie_broken(df, F.col("day"), "id")
    got = chunked.row_numbers(chunked.with_chunks(df, place, 4), [], ["day", "id"], "no")
    order = sorted(rows, key=lambda r: (r[0], -1 if r[1] is None else r[1]))
    assert {(r.day, r.id, r.no) for r in got.collect()} == {(*r, i) for i, r in enumerate(order, 1)}


def test_large_keys_whose_positions_do_not_overlap_are_cut_at_points_of_their_own(spark):
    df = spark.range(100 * 200).select((F.col("id") / 200).cast("int").alias("k"), F.col("id").alias("p"))
    cut, split = chunked.cut(df, ["k"], "p", rows_per_chunk=20)
    assert split and cut.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0] <= 40


def test_chunks_stay_near_the_limit_when_points_are_a_sample(spark):
    cut = chunked.with_chunks(spark.range(60_000), "id", rows_per_chunk=1_000, min_chunks=1)
    sizes = [r["count"] for r in cut.groupBy("_chunk").count().collect()]
    assert len(sizes) >= 40 and max(sizes) <= 2_000


def test_very_many_large_keys(spark):
    n = 100_000
    df = spark.range(3 * n).select((F.col("id") % n).alias("k"), F.col("id").alias("p"))
    got = chunked.row_numbers(df, ["k"], ["p"], "no", "p", rows_per_chunk=2)
    assert got.groupBy("no").count().orderBy("no").collect() == [(i, n) for i in (1, 2, 3)]


def test_carried_totals_pass_through_groups_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(chunked, "GROUP", 3)
    values = [None if i % 7 == 0 else i % 5 for i in range(90)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "p INT, v INT")
    sums = chunked.running(df, [], ["p"], {"s": F.col("v")}, "p", rows_per_chunk=2)
    before = chunked.previous(df, [], ["p"], {"b": "v"}, "p", rows_per_chunk=2)
    total = 0
    want = {}
    for i, v in enumerate(values):
        total += v or 0
        want[i] = (total, values[i - 1] if i else None)
    got = {r.p: (r.s, r.b) for r in sums.join(before, "p").collect()}
    assert got == want
    runs = ordered.run_lengths(df, [], ["p"], "v", "p", 2).orderBy("run_id").collect()
    assert [(r.value if "value" in r else r.v, r.len) for r in runs] == [tuple(r) for r in runs_of(values)]


def test_number_of_chunks_follows_from_the_rows(spark):
    df = spark.range(100)
    few = chunked.with_uniform_chunks(df, (F.col("id") + 0.5) / 100, 100)
    many = chunked.with_uniform_chunks(df, (F.col("id") + 0.5) / 100, 100, rows_per_chunk=1)
    assert many.select("_chunk").distinct().count() == 100 > few.select("_chunk").distinct().count()
