"""Permutation tests on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.operators import permute

REPLICATES = 1000

_SQL = f"""
WITH r AS (SELECT rep, event_id, event_type, {permute.draw_sql("event_id::BIGINT", "rep", 11)} AS draw
  FROM events, range(1, {REPLICATES + 1}) g(rep)),
f AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS change FROM r
  WINDOW w AS (PARTITION BY rep ORDER BY draw, event_id)),
i AS (SELECT rep, sum(change) OVER (PARTITION BY rep ORDER BY draw, event_id ROWS UNBOUNDED PRECEDING) AS run FROM f),
l AS (SELECT rep, run, count(*) AS len FROM i GROUP BY 1, 2),
sim AS (SELECT rep, count(*) FILTER (len >= 3) AS long_runs FROM l GROUP BY 1),
of AS (SELECT event_id, CASE WHEN event_type = lag(event_type) OVER (ORDER BY event_id) THEN 0 ELSE 1 END AS change FROM events),
oi AS (SELECT sum(change) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS run FROM of),
ol AS (SELECT run, count(*) AS len FROM oi GROUP BY 1),
obs AS (SELECT count(*) FILTER (len >= 3) AS observed FROM ol)
"""


def _simulated(t):
    return permute.simulated_runs(t.events, "event_id", "event_type", 3, REPLICATES, seed=11)


@query("perm_test_runs", _SQL + f"""
SELECT max(observed) AS observed, round(avg(long_runs), 6) AS mean_simulated,
       count(*) FILTER (long_runs >= observed)::DOUBLE / {REPLICATES} AS p_value FROM sim, obs
""")
def perm_test_runs(t):
    observed = permute.observed_runs(t.events.select("event_id", "event_type"), "event_id", "event_type", 3)
    return permute.p_value(_simulated(t), observed, REPLICATES)


@query("perm_distribution", _SQL + "SELECT long_runs, count(*) AS replicates FROM sim GROUP BY 1")
def perm_distribution(t):
    return _simulated(t).groupBy("long_runs").agg(F.count("*").alias("replicates"))
