"""Feature preparation on the shared tables.

Orders up to 1999 are the fit table and all orders the apply table where a fit
is needed, so that fitted figures and applied rows differ.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.functions import dates, recode
from quarrymill.operators import features, project


def _fit_part(orders):
    return orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


@query("prep_impute_median", """
WITH g AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal END AS balance FROM customer),
v AS (SELECT balance, row_number() OVER (ORDER BY balance) AS i, count(*) OVER () AS n FROM g WHERE balance IS NOT NULL),
m AS (SELECT avg(balance) AS middle FROM v WHERE i IN ((n + 1) // 2, n // 2 + 1))
SELECT c_custkey, round(coalesce(balance, (SELECT middle FROM m)), 6) AS balance FROM g
""")
def prep_impute_median(t):
    gaps = t.customer.select(
        "c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_acctbal")).alias("balance")
    )
    return features.impute_median(gaps, gaps, "balance").withColumn("balance", F.round("balance", 6))


@query("prep_impute_mode", """
WITH g AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
m AS (SELECT segment FROM g WHERE segment IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, segment LIMIT 1)
SELECT c_custkey, coalesce(segment, (SELECT segment FROM m)) AS segment FROM g
""")
def prep_impute_mode(t):
    gaps = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return features.impute_mode(gaps, gaps, "segment")


@query("prep_impute_constant", """
SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'missing') AS status FROM orders
""")
def prep_impute_constant(t):
    gaps = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return gaps.na.fill("missing", ["status"])


@query("prep_impute_random_draw", """
WITH g AS (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer),
o AS (SELECT segment AS drawn, row_number() OVER (ORDER BY c_custkey) AS i FROM g WHERE segment IS NOT NULL),
n AS (SELECT count(*) AS n FROM o),
d AS (SELECT c_custkey, segment, ('0x' || substr(md5('5:' || c_custkey), 1, 15))::BIGINT % n.n + 1 AS i FROM g, n)
SELECT c_custkey, coalesce(segment, drawn) AS segment FROM d LEFT JOIN o USING (i)
""")
def prep_impute_random_draw(t):
    gaps = t.customer.select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    return features.impute_random_draw(gaps, gaps, "segment", "c_custkey", "c_custkey", seed=5)


@query("prep_standardize", """
SELECT c_custkey, round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_samp(c_acctbal) OVER (), 8) AS sample_z,
       round((c_acctbal - avg(c_acctbal) OVER ()) / stddev_pop(c_acctbal) OVER (), 8) AS population_z FROM customer
""")
def prep_standardize(t):
    balance = F.col("c_acctbal")
    rows = t.customer.select("c_custkey", balance.alias("sample_z"), balance.alias("population_z"))
    out = features.standardize(rows, rows, ["sample_z"], ddof=1)
    out = features.standardize(rows, out, ["population_z"], ddof=0)
    return out.select("c_custkey", F.round("sample_z", 8).alias("sample_z"),
                      F.round("population_z", 8).alias("population_z"))


_STATUSES = ["F", "O", "P"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("prep_one_hot", "SELECT c_custkey, " + ", ".join(
    f"(c_mktsegment = '{s}')::BIGINT AS {how}_{s}"
    for how, kept in (("last", _SEGMENTS[:-1]), ("first", _SEGMENTS[1:]), ("none", _SEGMENTS)) for s in kept
) + " FROM customer")
def prep_one_hot(t):
    rows = t.customer.select("c_custkey", "c_mktsegment")
    for how, drop in (("last", "last"), ("first", "first"), ("none", None)):
        rows = features.one_hot(rows, "c_mktsegment", _SEGMENTS, drop, prefix=f"{how}_")
    return rows.drop("c_mktsegment")


@query("prep_sparse_one_hot", """
SELECT c_custkey, (dense_rank() OVER (ORDER BY c_name) - 1)::BIGINT AS code, (SELECT count(DISTINCT c_name) FROM customer) AS width
FROM customer
""")
def prep_sparse_one_hot(t):
    """An open category: as many levels as customers, one sparse vector each."""
    rows = t.customer.select("c_custkey", "c_name")
    coded = features.sparse_one_hot(rows, "c_name", features.levels(rows, "c_name"), "flags")
    parts = F.from_json(F.to_json(F.struct("flags")), "flags STRUCT<size: BIGINT, indices: ARRAY<BIGINT>>").flags
    return coded.select("c_custkey", parts.indices[0].alias("code"), parts.size.alias("width"))


@query("prep_level_alignment", """
SELECT p_partkey, CASE p_type WHEN 'SMALL' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'ECONOMY' THEN 3
  WHEN 'STANDARD' THEN 4 END::BIGINT AS type_code FROM part
""")
def prep_level_alignment(t):
    fixed = ["SMALL", "MEDIUM", "LARGE", "ECONOMY", "STANDARD"]  # leaves one type out
    return features.align_levels(t.part.select("p_partkey", "p_type"), "p_type", fixed, "type_code").drop("p_type")


@query("prep_drop_constant_columns", "SELECT l_orderkey, l_quantity, l_tax FROM lineitem")
def prep_drop_constant_columns(t):
    rows = t.lineitem.select("l_orderkey", "l_quantity", F.lit(1).alias("fixed"), "l_tax",
                             F.lit(None).cast("string").alias("empty"))
    return features.drop_constant_columns(rows)


@query("prep_drop_near_zero_variance", "SELECT doc_id, quality, toxic FROM labels")
def prep_drop_near_zero_variance(t):
    rare = t.labels.withColumn("rare", (F.col("doc_id") % 100 == 0).cast("int")).withColumn("fixed", F.lit("x"))
    return features.drop_near_constant_columns(rare)


@query("prep_dichotomize", """
SELECT l_orderkey, l_linenumber, l_partkey, (l_discount <> 0)::INT::DOUBLE AS has_l_discount, (l_tax <> 0)::INT::DOUBLE AS has_l_tax,
  (l_returnflag <> 'N')::INT::DOUBLE AS has_l_returnflag, (l_linestatus <> 'O')::INT::DOUBLE AS has_l_linestatus FROM lineitem
""")
def prep_dichotomize(t):
    gaps = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), F.nullif("l_returnflag", F.lit("N")).alias("l_returnflag"),
        F.nullif("l_linestatus", F.lit("O")).alias("l_linestatus"),
    )
    return features.dichotomize(gaps, ["l_discount", "l_tax", "l_returnflag", "l_linestatus"])


@query("prep_recode_type_to_category", """
SELECT p_size::VARCHAR AS size_class, count(*) AS n FROM part GROUP BY 1
""")
def prep_recode_type_to_category(t):
    recoded = project.cast_columns(t.part.select(F.col("p_size").alias("size_class")), {"size_class": "string"})
    return recoded.groupBy("size_class").agg(F.count("*").alias("n"))


_FIT_PRICE = """
WITH f AS (SELECT avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM orders WHERE o_orderdate < '2000-01-01')
"""


@query("prep_column_transformer", _FIT_PRICE + """
SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS price_z,
  concat_ws(',', (o_orderstatus = 'F')::INT, (o_orderstatus = 'O')::INT, (o_orderstatus = 'P')::INT,
    (o_orderpriority = '1-URGENT')::INT, (o_orderpriority = '2-HIGH')::INT, (o_orderpriority = '3-MEDIUM')::INT,
    (o_orderpriority = '4-NOT SPECIFIED')::INT, (o_orderpriority = '5-LOW')::INT) AS flags FROM orders, f
""")
def prep_column_transformer(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    stages = features.column_transformer_stages(
        rows, {"o_orderstatus": _STATUSES, "o_orderpriority": _PRIORITIES}, ids=["o_orderkey"])
    out = Pipeline(stages=stages).fit(_fit_part(t.orders)).transform(rows)
    values = vector_to_array("features")
    return out.select(
        "o_orderkey", F.round(values[0], 6).alias("price_z"),
        F.array_join(F.slice(values, 2, F.size(values) - 1).cast("array<int>"), ",").alias("flags"),
    )


@query("prep_recipe", _FIT_PRICE + """
SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS price_z,
  1 + 4 + 3 + 12 + 5 + 4 AS width, 4 AS texts_present FROM orders, f
  WHERE year(o_orderdate) < 2000
UNION ALL SELECT o_orderkey, round((o_totalprice - m) / s, 6), 29, 3 FROM orders, f WHERE year(o_orderdate) >= 2000
""")
def prep_recipe(t):
    """Derived columns, then numbers scaled and texts one-hot; the key takes no part.

    The fit ends in 1999, so a later year is an unseen level and sets no flag.
    """
    def steps(orders):
        flags = dates.holiday_flags(F.col("o_orderdate"))
        return orders.withColumns({
            "month": F.month("o_orderdate").cast("string"), "year": F.year("o_orderdate").cast("string"),
            "wording": recode.first_match(F.col("o_orderpriority"), [("rush", ["1", "2"])]), **flags,
        }).drop("o_orderdate", "o_orderpriority", "o_custkey")

    ready = t.orders.transform(steps)
    levels = {
        "o_orderstatus": _STATUSES, "month": sorted(str(m) for m in range(1, 13)),
        "year": [str(y) for y in range(1995, 2000)], "wording": [*_PRIORITIES[2:], "rush"],
    }
    stages = features.column_transformer_stages(ready, levels, ids=["o_orderkey"])
    out = Pipeline(stages=stages).fit(_fit_part(t.orders).transform(steps)).transform(ready)
    values = vector_to_array("features")
    texts = F.slice(values, 6, F.size(values) - 5)
    return out.select(
        "o_orderkey", F.round(values[0], 6).alias("price_z"), F.size(values).alias("width"),
        F.aggregate(texts, F.lit(0.0), lambda a, v: a + v).cast("int").alias("texts_present"),
    )


_AGES = ["years", "months", "weeks", "days"]
_COATS = ["Brown Tabby", "Blue Tick/Tan", "Black Smoke", "White/Red", "Torbie", "Cream"]
_SEXES = ["Neutered Male", "Spayed Female", "Intact Male", "Unknown"]


@query("clean_chain", """
SELECT o_orderkey AS id,
  round((o_orderkey % 30 + 1) / [1.0, 12.0, 52.1429, 365.0][(o_orderkey % 4 + 1)::INT]::DOUBLE, 9) AS age_years,
  ['Tabby', 'Blue', 'Black', 'Multiple Colors', 'Tortie/Torbie', 'Cream'][(o_orderkey % 6 + 1)::INT] AS colour,
  ['Male', 'Female', 'Male', 'Unknown'][(o_orderkey // 4 % 4 + 1)::INT] AS sex,
  ['Spayed/Neutered', 'Spayed/Neutered', 'Intact', 'Unknown'][(o_orderkey // 4 % 4 + 1)::INT] AS status, o_totalprice AS price, substr(o_orderpriority, 3) AS priority,
  month(o_orderdate) AS month, year(o_orderdate) AS year,
  (month(o_orderdate) = 12 AND day(o_orderdate) = 25)::BIGINT AS christmas
FROM orders WHERE o_orderstatus <> 'P' AND o_totalprice IS NOT NULL
""")
def clean_chain(t):
    """Raw texts of age, coat and sex, as a shelter would note them, hang on the order's key."""
    def noted(df):
        pick = lambda texts, i: F.element_at(F.array(*[F.lit(x) for x in texts]), (i % len(texts) + 1).cast("int"))
        key = F.col("o_orderkey")
        return df.withColumns({
            "o_age": F.concat((key % 30 + 1).cast("string"), F.lit(" "), pick(_AGES, key)),
            "o_coat": pick(_COATS, key), "o_sex": pick(_SEXES, F.floor(key / 4)),
        })

    def rename(df):
        return project.rename_by_pattern(df, "^o_").withColumnsRenamed(
            {"orderkey": "id", "totalprice": "price", "orderpriority": "priority", "orderdate": "day"}
        ).withColumn("orderstatus", F.nullif("orderstatus", F.lit("P")))

    def derive(df):
        return df.withColumns({
            "month": F.month("day").cast("bigint"), "year": F.year("day").cast("bigint"),
            "christmas": dates.holiday_flags(F.col("day"))["christmas"],
            "priority": F.regexp_replace("priority", r"^\d-", ""),
            "age_years": F.round(recode.duration_years(F.col("age")), 9),
            "colour": recode.first_match(F.col("coat"), recode.COLOUR_FAMILIES),
            "status": recode.first_match(F.col("sex"), recode.STATUS),
        }).withColumn("sex", recode.first_match(F.col("sex"), recode.SEX))

    def complete(df):
        return df.drop("day", "custkey").na.drop("any")

    def finish(df):
        return df.select(
            "id", "price", "priority", "month", "year", "christmas", "age_years", "colour", "sex", "status")

    return t.orders.transform(noted).transform(rename).transform(derive).transform(complete).transform(finish)


@query("prep_assemble_matrix", """
SELECT l_orderkey, l_linenumber, l_extendedprice AS second, l_quantity + l_tax AS ends FROM lineitem
""")
def prep_assemble_matrix(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    matrix = features.assemble(rows, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    values = vector_to_array("features")
    return matrix.select("l_orderkey", "l_linenumber", values[1].alias("second"),
                         (values[0] + values[3]).alias("ends"))
