"""Aggregations on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.functions.hashing import hash_int
from quarrymill.operators import aggregates, sets
from quarrymill.operators import ordered
from quarrymill.tables import TABLE_NAMES


@query("agg_count_by", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def agg_count_by(t):
    return aggregates.counts(t.orders, "o_orderpriority").orderBy(F.desc("n"), "o_orderpriority")


@query("agg_share_of_total", """
WITH c AS (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_returnflag, n, round(n::DOUBLE / (SELECT sum(n) FROM c)::DOUBLE, 9) AS prop FROM c
""")
def agg_share_of_total(t):
    return aggregates.shares(t.lineitem, "l_returnflag").withColumn("prop", F.round("prop", 9))


@query("agg_two_level_count", """
SELECT o_orderstatus, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' ELSE 'normal' END AS urgency,
       count(*) AS n FROM orders GROUP BY 1, 2
""")
def agg_two_level_count(t):
    urgency = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "rush").otherwise("normal")
    return aggregates.counts(t.orders, "o_orderstatus", urgency.alias("urgency"))


@query("agg_pivot_counts", """
SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS status_F,
       count(*) FILTER (l_linestatus = 'O') AS status_O, count(*) FILTER (l_linestatus = 'X') AS status_X,
       count(*) FILTER (l_linestatus IS NULL OR l_linestatus NOT IN ('F', 'O', 'X')) AS status_other
FROM lineitem GROUP BY 1
""")
def agg_pivot_counts(t):
    return aggregates.cross_counts(t.lineitem, "l_returnflag", "l_linestatus", ["F", "O", "X"], "status_")


@query("agg_max_by_group", "SELECT p_brand, max(p_retailprice) AS top_price FROM part GROUP BY 1")
def agg_max_by_group(t):
    return t.part.groupBy("p_brand").agg(F.max("p_retailprice").alias("top_price"))


@query("agg_min_of_group_max", """
WITH s AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS seq FROM events),
m AS (SELECT user_id, max(seq) AS top FROM s GROUP BY 1)
SELECT event_id, user_id, seq FROM s WHERE seq <= (SELECT min(top) FROM m)
""")
def agg_min_of_group_max(t):
    rows = t.events.select("event_id", "user_id")
    # the last number of a user is that user's row count
    cutoff = rows.groupBy("user_id").agg(F.count("*").alias("top")).agg(F.min("top")).first()[0]
    return ordered.prefix(rows, ["user_id"], ["event_id"], cutoff or 0, "event_id")


@query("agg_global_mean", """
SELECT round(avg(c_acctbal), 6) AS mean_balance FROM customer WHERE c_acctbal > 0
""")
def agg_global_mean(t):
    return t.customer.where("c_acctbal > 0").agg(F.round(F.avg("c_acctbal"), 6).alias("mean_balance"))


@query("agg_multi_summary", """
SELECT round(avg(l_quantity), 6) AS mean_quantity, round(avg(l_extendedprice), 6) AS mean_price
FROM lineitem WHERE l_discount > 0.05::DOUBLE
""")
def agg_multi_summary(t):
    return t.lineitem.where("l_discount > 0.05D").agg(
        F.round(F.avg("l_quantity"), 6).alias("mean_quantity"),
        F.round(F.avg("l_extendedprice"), 6).alias("mean_price"),
    )


@query("agg_sum_skip_null_ratio", """
SELECT user_id, round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0), 4) AS top,
       round(coalesce(sum(CASE WHEN event_type <> 'error' THEN value END), 0), 4) AS bottom,
       round(coalesce(sum(CASE WHEN event_type = 'purchase' THEN value END), 0)
             / nullif(coalesce(sum(CASE WHEN event_type <> 'error' THEN value END), 0), 0), 9) AS ratio
FROM events GROUP BY 1
""")
def agg_sum_skip_null_ratio(t):
    gaps = t.events.select(
        "user_id",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("bought"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("sound"),
    )
    out = aggregates.ratio_of_sums(gaps, ["user_id"], "bought", "sound")
    return out.select("user_id", F.round("top", 4).alias("top"), F.round("bottom", 4).alias("bottom"),
                      F.round("ratio", 9).alias("ratio"))


@query("agg_conditional_count", """
SELECT l_suppkey, count(*) FILTER (l_quantity >= 40) AS big_lines, count(*) AS all_lines FROM lineitem GROUP BY 1
""")
def agg_conditional_count(t):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_quantity") >= 40).alias("big_lines"), F.count("*").alias("all_lines")
    )


@query("agg_distinct_values", "SELECT DISTINCT p_type FROM part")
def agg_distinct_values(t):
    return t.part.select("p_type").distinct()


@query("agg_distinct_per_column", """
SELECT 'c_custkey' AS "column", count(*) AS n_distinct FROM (SELECT DISTINCT c_custkey FROM customer)
UNION ALL SELECT 'c_name', count(*) FROM (SELECT DISTINCT c_name FROM customer)
UNION ALL SELECT 'c_nationkey', count(*) FROM (SELECT DISTINCT c_nationkey FROM customer)
UNION ALL SELECT 'c_acctbal', count(*) FROM (SELECT DISTINCT c_acctbal FROM customer)
UNION ALL SELECT 'c_mktsegment', count(*) FROM (SELECT DISTINCT nullif(c_mktsegment, 'BUILDING') FROM customer)
""")
def agg_distinct_per_column(t):
    gaps = t.customer.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return aggregates.distinct_per_column(gaps)


@query("agg_levels_per_factor", """
WITH l AS (SELECT 'p_name' AS "column", count(DISTINCT p_name) AS num_levels FROM part
UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part
UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part
UNION ALL SELECT 'o_orderstatus', count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders)
SELECT "column", num_levels, num_levels - 1 AS num_indicators FROM l
""")
def agg_levels_per_factor(t):
    return aggregates.levels_per_factor(t.part).union(aggregates.levels_per_factor(t.orders)).orderBy(
        F.desc("num_levels"), "column"
    )


@query("agg_missing_per_column", """
WITH n AS (SELECT count(*) AS r, count(*) FILTER (l_tax = 0) AS t, count(*) FILTER (l_discount = 0) AS d,
  count(*) FILTER (l_returnflag = 'N') AS f FROM lineitem)
SELECT * FROM (SELECT 'l_tax' AS "column", t AS num_missing, round(t::DOUBLE / r, 9) AS prop_missing FROM n
UNION ALL SELECT 'l_discount', d, round(d::DOUBLE / r, 9) FROM n
UNION ALL SELECT 'l_returnflag', f, round(f::DOUBLE / r, 9) FROM n) WHERE num_missing > 0
""")
def agg_missing_per_column(t):
    gaps = t.lineitem.withColumns({
        "l_tax": F.nullif("l_tax", F.lit(0.0)), "l_discount": F.nullif("l_discount", F.lit(0.0)),
        "l_returnflag": F.nullif("l_returnflag", F.lit("N")),
    })
    found = aggregates.missing_per_column(gaps)
    return found.withColumn("prop_missing", F.round("prop_missing", 9)).orderBy(F.desc("prop_missing"))


@query("agg_product", """
SELECT product(n)::BIGINT AS product FROM (SELECT DISTINCT l_linenumber AS n FROM lineitem)
""")
def agg_product(t):
    return aggregates.product(t.lineitem.select("l_linenumber").distinct(), "l_linenumber")


_LETTERS = """
WITH m AS (SELECT conv_id, row_number() OVER () AS member, list_distinct(regexp_extract_all(lower(text), '[a-z]')) AS l FROM conversations),
s AS (SELECT conv_id, count(*) AS members FROM m GROUP BY 1),
u AS (SELECT conv_id, letter, count(*) AS used_by FROM (SELECT conv_id, unnest(l) AS letter FROM m) GROUP BY 1, 2)
"""


@query("agg_set_union", _LETTERS + """
SELECT s.conv_id, count(u.letter) AS any_member FROM s LEFT JOIN u USING (conv_id) GROUP BY 1
""")
def agg_set_union(t):
    return aggregates.letter_sets(t.conversations, "conv_id", "text").select("conv_id", "any_member")


@query("agg_set_intersection", _LETTERS + """
SELECT s.conv_id, s.members, count(*) FILTER (u.used_by = s.members) AS every_member
FROM s LEFT JOIN u USING (conv_id) GROUP BY 1, 2
""")
def agg_set_intersection(t):
    return aggregates.letter_sets(t.conversations, "conv_id", "text").select(
        "conv_id", "members", "every_member"
    )


@query("agg_min_max_range", """
SELECT o_orderpriority, min(o_totalprice) AS low, max(o_totalprice) AS high,
       round(min(o_totalprice) + max(o_totalprice), 4) AS low_plus_high FROM orders GROUP BY 1
""")
def agg_min_max_range(t):
    return t.orders.groupBy("o_orderpriority").agg(
        F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high")
    ).withColumn("low_plus_high", F.round(F.col("low") + F.col("high"), 4))


@query("agg_diff_histogram", """
WITH d AS (SELECT DISTINCT l_orderkey AS k FROM lineitem),
s AS (SELECT k - coalesce(lag(k) OVER (ORDER BY k), 0) AS step FROM d UNION ALL SELECT 3)
SELECT step, count(*) AS n FROM s GROUP BY 1
""")
def agg_diff_histogram(t):
    return aggregates.difference_histogram(t.lineitem, "l_orderkey")


@query("agg_histogram_bins", """
SELECT (ceil((c_acctbal - 250) / 500) * 500)::BIGINT AS bin, count(*) AS n FROM customer GROUP BY 1
""")
def agg_histogram_bins(t):
    return aggregates.histogram(t.customer, "c_acctbal", 500.0).select(
        F.col("bin").cast("bigint").alias("bin"), "n"
    )


@query("agg_density", """
WITH s AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi, avg(c_acctbal) AS m,
  count(*) AS n, stddev_samp(c_acctbal) * pow(count(*), -0.2::DOUBLE) AS h FROM customer),
g AS (SELECT i, lo + i * ((hi - lo) / 49) AS x FROM s, range(50) r(i))
SELECT g.i::INT AS grid_no, round(g.x, 6) AS grid_x,
       round(sum(exp(-0.5::DOUBLE * ((g.x - c_acctbal) / s.h) * ((g.x - c_acctbal) / s.h)))
             / (any_value(s.n) * any_value(s.h) * sqrt(2 * pi())), 12) AS density,
       round(any_value(s.m), 6) AS mean
FROM customer, g, s GROUP BY 1, 2
""")
def agg_density(t):
    return aggregates.density(t.customer, "c_acctbal", 50).select(
        "grid_no", F.round("grid_x", 6).alias("grid_x"), F.round("density", 12).alias("density"),
        F.round("mean", 6).alias("mean"),
    )


@query("agg_metric_summary", """
WITH f AS (SELECT ('0x' || substr(md5('0:' || doc_id), 1, 8))::BIGINT % 5 AS fold,
  avg(CASE WHEN quality = 1 - toxic THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM labels GROUP BY 1)
SELECT round(avg(accuracy), 4) AS mean, round(stddev_pop(accuracy), 4) AS sd_population,
       round(stddev_samp(accuracy) / sqrt(count(*)), 4) AS std_err FROM f
""")
def agg_metric_summary(t):
    hit = (F.col("quality") == 1 - F.col("toxic")).cast("double")
    folds = t.labels.groupBy((hash_int("doc_id") % 5).alias("fold")).agg(F.avg(hit).alias("accuracy"))
    return aggregates.score_summary(folds, "accuracy")


@query("agg_global_extreme", """
SELECT min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day,
       max(nullif(o_totalprice, 0)) AS top_price, min(nullif(o_totalprice, 0)) AS low_price FROM orders
""")
def agg_global_extreme(t):
    price = F.nullif("o_totalprice", F.lit(0.0))
    return t.orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first_day"), F.to_date(F.max("o_orderdate")).alias("last_day"),
        F.max(price).alias("top_price"), F.min(price).alias("low_price"),
    )


@query("agg_count_all", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in TABLE_NAMES
))
def agg_count_all(t):
    one = lambda name: getattr(t, name).agg(F.count("*").alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows"
    )
    return sets.stack(*[one(name) for name in TABLE_NAMES])
