"""Ordered and window operations on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import joins, ordered, topk
from quarrymill.plans import chunked

LOOKBACK = 25


@query("win_running_ratio", """
WITH s AS (SELECT event_id, user_id,
  sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER w AS wins,
  sum(CASE WHEN event_type = 'purchase' THEN 0 ELSE 1 END) OVER w AS losses
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, user_id, wins::BIGINT AS wins, losses::BIGINT AS losses,
       round(wins::DOUBLE / nullif(losses, 0), 9) AS ratio FROM s
""")
def win_running_ratio(t):
    games = t.events.select("event_id", "user_id", "event_type")
    out = ordered.running_ratio(
        games, ["user_id"], ["event_id"], F.col("event_type") == "purchase", "event_id"
    )
    return out.select("event_id", "user_id", "wins", "losses", F.round("ratio", 9).alias("ratio"))


@query("top_current_ratio", """
WITH s AS (SELECT user_id, count(*) FILTER (event_type = 'purchase') AS wins,
  count(*) FILTER (event_type <> 'purchase') AS losses, max(event_id) AS event_id
  FROM events GROUP BY 1),
r AS (SELECT *, wins::DOUBLE / nullif(losses, 0) AS ratio FROM s),
k AS (SELECT *, rank() OVER (ORDER BY ratio DESC NULLS LAST) AS pos FROM r WHERE ratio IS NOT NULL)
SELECT user_id, event_id, wins, losses, round(ratio, 9) AS ratio FROM k WHERE pos <= 3
""")
def top_current_ratio(t):
    # the last state of a running count is the count
    games = t.events.select("event_id", "user_id", "event_type")
    current = ordered.current_ratio(games, ["user_id"], F.col("event_type") == "purchase", "event_id")
    return topk.top_with_ties(current, "ratio", 3).withColumn("ratio", F.round("ratio", 9))


@query("win_running_sum_null_as_zero", """
SELECT event_id, user_id, round(coalesce(sum(CASE WHEN event_type <> 'error' THEN value END)
  OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING), 0), 4) AS total FROM events
""")
def win_running_sum_null_as_zero(t):
    gaps = t.events.select(
        "event_id", "user_id", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    out = ordered.running_total(gaps, ["user_id"], ["event_id"], "value", "event_id")
    return out.select("event_id", "user_id", F.round("total", 4).alias("total"))


@query("win_row_number", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq
FROM orders
""")
def win_row_number(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    place = chunked.tie_broken(rows, F.unix_date(F.to_date("o_orderdate")), "o_orderkey")
    out = ordered.numbered(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], "seq", place)
    return out.drop("o_orderdate")


@query("win_reverse_number", """
SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS seq
FROM orders
""")
def win_reverse_number(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    place = chunked.tie_broken(rows, F.unix_date(F.to_date("o_orderdate")), "o_orderkey")
    newest_first = [F.desc("o_orderdate"), F.desc("o_orderkey")]
    out = ordered.numbered(rows, ["o_custkey"], newest_first, "seq", -place)
    return out.drop("o_orderdate")


@query("win_prefix_cutoff", """
WITH n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events)
SELECT * FROM n WHERE seq <= 10
""")
def win_prefix_cutoff(t):
    return ordered.prefix(t.events.select("event_id", "user_id"), ["user_id"], ["event_id"], 10, "event_id")


_RUNS = """
WITH f AS (SELECT user_id, event_id, event_type,
  CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w THEN 0 ELSE 1 END AS change
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
g AS (SELECT *, sum(change) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS run_id FROM f),
runs AS (SELECT user_id, run_id, min(event_type) AS event_type, count(*) AS len FROM g GROUP BY 1, 2)
"""


@query("win_run_length", _RUNS + "SELECT user_id, run_id, event_type, len FROM runs")
def win_run_length(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    return ordered.run_lengths(rows, ["user_id"], ["event_id"], "event_type", "event_id")


@query("win_long_runs", _RUNS + "SELECT user_id, count(*) FILTER (len >= 3) AS long_runs FROM runs GROUP BY 1")
def win_long_runs(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    return ordered.long_runs(rows, ["user_id"], ["event_id"], "event_type", 3, "event_id")


@query("win_contiguous_sum", """
WITH e AS (SELECT event_id, (floor(value) + 1)::BIGINT AS v FROM events),
p AS (SELECT v, row_number() OVER w AS idx, (sum(v) OVER w)::BIGINT AS upto FROM e
      WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)),
s AS (SELECT a.idx - 1 AS i, b.idx AS j FROM p a JOIN p b ON b.upto = a.upto - a.v + 1000
      WHERE b.idx - a.idx >= 1 ORDER BY 1 LIMIT 1)
SELECT min(idx) AS first_idx, max(idx) AS last_idx, min(v) AS low, max(v) AS high,
       sum(v)::BIGINT AS total, min(v) + max(v) AS low_plus_high
FROM p, s WHERE idx > s.i AND idx <= s.j
""")
def win_contiguous_sum(t):
    whole = t.events.select("event_id", (F.floor("value") + 1).alias("v"))
    return ordered.contiguous_sum(whole, "event_id", "v", 1000)


@query("win_rolling_lookback", f"""
WITH e AS (SELECT event_id, value, row_number() OVER (ORDER BY event_id) AS idx FROM events),
r AS (SELECT event_id, idx, min(value) OVER w AS low, max(value) OVER w AS high, avg(value) OVER w AS mean
  FROM e WINDOW w AS (ORDER BY idx ROWS BETWEEN {LOOKBACK} PRECEDING AND 1 PRECEDING))
SELECT event_id, low, high, round(mean, 6) AS mean FROM r WHERE idx > {LOOKBACK}
""")
def win_rolling_lookback(t):
    rows = chunked.row_numbers(t.events.select("event_id", "value"), [], ["event_id"], "idx", "event_id")
    framed = chunked.lookback(rows, [], "idx", LOOKBACK, {
        "low": lambda w: F.min("value").over(w),
        "high": lambda w: F.max("value").over(w),
        "mean": lambda w: F.avg("value").over(w),
    })
    return framed.where(F.col("idx") > LOOKBACK).select("event_id", "low", "high", F.round("mean", 6).alias("mean"))


PAIR_CHECK = f"""
WITH e AS (SELECT event_id, (floor(value))::BIGINT AS v, row_number() OVER (ORDER BY event_id) AS idx FROM events),
w AS (SELECT *, list(v) OVER (ORDER BY idx ROWS BETWEEN {LOOKBACK} PRECEDING AND 1 PRECEDING) AS p FROM e),
c AS (SELECT event_id, v, len(list_filter(p, lambda x: list_contains(p, v - x) AND v - x <> x)) > 0 AS valid
      FROM w WHERE idx > {LOOKBACK})
"""


def pair_checks(t):
    whole = t.events.select("event_id", F.floor("value").alias("v"))
    rows = chunked.row_numbers(whole, [], ["event_id"], "idx", "event_id")
    return joins.pair_sum_in_lookback(rows, "idx", "v", LOOKBACK)


@query("win_first_failure", PAIR_CHECK + """
SELECT event_id, v FROM c WHERE NOT valid ORDER BY event_id LIMIT 1
""")
def win_first_failure(t):
    return ordered.first_failure(pair_checks(t), "event_id", F.col("valid"), ["event_id", "v"])


@query("win_successive_diff", """
WITH d AS (SELECT DISTINCT floor(o_totalprice)::BIGINT AS price FROM orders)
SELECT price, price - lag(price) OVER (ORDER BY price) AS difference FROM d
""")
def win_successive_diff(t):
    return ordered.successive_differences(t.orders.select(F.floor("o_totalprice").alias("price")), "price")
