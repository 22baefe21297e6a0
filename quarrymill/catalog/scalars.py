"""Column functions on the shared tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrymill.catalog import query
from quarrymill.functions import codes, dates, recode, text, validate
from quarrymill.operators import project


@query("fn_regex_extract", """
SELECT c_custkey, nullif(regexp_extract(c_name, '(\\d+)', 1), '')::BIGINT AS number FROM customer
""")
def fn_regex_extract(t):
    return t.customer.select("c_custkey", text.first_number(F.col("c_name")).alias("number"))


@query("fn_regex_extract_all", """
SELECT p_partkey, p_size || '-' || substr(p_brand, 7) || '-' || p_partkey AS numbers FROM part
""")
def fn_regex_extract_all(t):
    mixed = F.concat(F.lit("size "), F.col("p_size"), F.lit(" of "), F.col("p_brand"), F.lit(", no "), F.col("p_partkey"))
    return t.part.select("p_partkey", F.array_join(text.all_numbers(mixed), "-").alias("numbers"))


@query("fn_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'gear')")
def fn_contains(t):
    return t.part.where(F.col("p_name").contains("gear")).select("p_partkey", "p_name")


# fixed values in the SQL text: the units per year of recode.UNITS_PER_YEAR
@query("fn_duration_to_years", """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size::DOUBLE WHEN 1 THEN round(p_size / 12.0::DOUBLE, 9)
  WHEN 2 THEN round(p_size / 52.1429::DOUBLE, 9) WHEN 3 THEN round(p_size / 365.0::DOUBLE, 9) END AS years
FROM part
""")
def fn_duration_to_years(t):
    units = F.array(*[F.lit(u) for u in ("years", "months", "weeks", "days")])
    unit = F.try_element_at(units, (F.col("p_partkey") % 5 + 1).cast("int"))
    aged = F.concat(F.col("p_size"), F.lit(" "), unit)  # every fifth text is missing
    return t.part.select("p_partkey", F.round(recode.duration_years(aged), 9).alias("years"))


@query("fn_first_match_category", """
SELECT p_partkey, CASE WHEN contains(p_name, 'blue') THEN 'Blue' WHEN contains(p_name, 'green') THEN 'Green'
  WHEN contains(p_name, 'gear') OR contains(p_name, 'bolt') THEN 'Hardware' ELSE p_name END AS family FROM part
""")
def fn_first_match_category(t):
    families = [("Blue", ["blue"]), ("Green", ["green"]), ("Hardware", ["gear", "bolt"])]
    return t.part.select("p_partkey", recode.first_match(F.col("p_name"), families).alias("family"))


@query("fn_split_compound", """
SELECT o_orderpriority, CASE WHEN contains(o_orderpriority, '1') OR contains(o_orderpriority, '2') THEN 'upper'
  WHEN contains(o_orderpriority, '5') THEN 'lower' ELSE o_orderpriority END AS band,
  CASE WHEN contains(o_orderpriority, 'NOT') THEN 'unstated' WHEN contains(o_orderpriority, 'URGENT') THEN 'urgent'
  ELSE o_orderpriority END AS wording, count(*) AS n FROM orders GROUP BY 1, 2, 3
""")
def fn_split_compound(t):
    p = F.col("o_orderpriority")
    return t.orders.groupBy(
        p, recode.first_match(p, [("upper", ["1", "2"]), ("lower", ["5"])]).alias("band"),
        recode.first_match(p, [("unstated", ["NOT"]), ("urgent", ["URGENT"])]).alias("wording"),
    ).agg(F.count("*").alias("n"))


@query("fn_replace_clean", """
SELECT o_orderkey, o_totalprice AS price, replace(o_orderpriority, '-', ' ') AS priority,
       regexp_replace(o_orderpriority, '^\\d-', '') AS wording FROM orders
""")
def fn_replace_clean(t):
    shown = F.concat(F.lit("$"), F.format_number("o_totalprice", 2))
    return t.orders.select(
        "o_orderkey", text.money(shown).alias("price"),
        F.replace("o_orderpriority", F.lit("-"), F.lit(" ")).alias("priority"),
        text.without_prefix(F.col("o_orderpriority"), r"\d-").alias("wording"),
    )


@query("fn_trim_split_slice", """
SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS host, split_part(url, '://', 1) AS scheme,
       split_part(split_part(url, '://', 2), '/', 2) AS folder, right(url, 2) AS ending, substr(url, 1, 7) AS head
FROM pages
""")
def fn_trim_split_slice(t):
    part = lambda c, sep, i: F.split_part(c, F.lit(sep), F.lit(i))
    url = F.trim(F.concat(F.lit(" "), F.col("url"), F.lit("  ")))
    rest = part(url, "://", 2)
    return t.pages.select(
        "page_id", part(rest, "/", 1).alias("host"), part(url, "://", 1).alias("scheme"),
        part(rest, "/", 2).alias("folder"), F.right(url, F.lit(2)).alias("ending"),
        F.substring(url, 1, 7).alias("head"),
    )


@query("fn_concat_labels", """
WITH c AS (SELECT n_regionkey, n_name, count(*) AS n, avg(c_acctbal) AS m FROM customer
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
SELECT r_name, string_agg(n_name || ': ' || n, ', ' ORDER BY n_name) AS label,
       string_agg(n_name || ' mean ' || round(m)::BIGINT, ', ' ORDER BY n_name) AS hover
FROM c JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def fn_concat_labels(t):
    # counted per nation first: a region's label then joins a handful of nations
    per_nation = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count("*").alias("n"), F.avg("c_acctbal").alias("m")
    ).join(t.nation, "n_nationkey")
    shown = per_nation.select(
        F.col("n_regionkey").alias("r_regionkey"), "n_name",
        F.concat("n_name", F.lit(": "), F.col("n")).alias("a"),
        text.labelled(F.col("n_name"), F.lit("mean"), F.round("m").cast("bigint")).alias("b"),
    ).join(t.region, "r_regionkey")
    return shown.groupBy("r_name").agg(
        F.array_sort(F.collect_list(F.struct("n_name", "a", "b"))).alias("s")
    ).select("r_name", F.array_join("s.a", ", ").alias("label"), F.array_join("s.b", ", ").alias("hover"))


@query("fn_count_char", """
SELECT p_partkey, p_name, (len(p_name) - len(replace(p_name, 'o', '')))::BIGINT AS o_count FROM part
WHERE len(p_name) - len(replace(p_name, 'o', '')) BETWEEN 1 AND 2
""")
def fn_count_char(t):
    name, o = F.col("p_name"), F.lit("o")
    return t.part.where(text.letter_count_between(name, o, 1, 2)).select(
        "p_partkey", "p_name", text.count_letter(name, o).cast("bigint").alias("o_count")
    )


@query("fn_position_xor", """
SELECT p_partkey, p_name, (substr(p_name, 1, 1) = 'e')::INT + (substr(p_name, 4, 1) = 'e')::INT = 1 AS valid FROM part
""")
def fn_position_xor(t):
    return t.part.select("p_partkey", "p_name", text.letter_at_one_of(F.col("p_name"), F.lit("e"), 1, 4).alias("valid"))


@query("fn_regex_fullmatch", """
SELECT c_custkey, regexp_full_match(c_name, 'Customer#\\d{9}') AS name_ok,
       regexp_full_match(c_mktsegment, '[A-H][A-Z]{7}') AS segment_ok FROM customer
""")
def fn_regex_fullmatch(t):
    return t.customer.select(
        "c_custkey", validate.matches(F.col("c_name"), r"^Customer#\d{9}\z").alias("name_ok"),
        validate.matches(F.col("c_mktsegment"), r"^[A-H][A-Z]{7}\z").alias("segment_ok"),
    )


@query("fn_range_validate", """
SELECT o_orderkey, year(o_orderdate) BETWEEN 1996 AND 2000 AS year_ok,
       CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 250 BETWEEN 150 AND 193
            WHEN o_orderkey % 3 = 1 THEN o_custkey % 250 BETWEEN 59 AND 76 ELSE false END AS size_ok,
       o_orderstatus IN ('F', 'O') AS code_ok, o_orderstatus = 'X' AS number_ok FROM orders
""")
def fn_range_validate(t):
    unit = F.try_element_at(F.array(F.lit("cm"), F.lit("in")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    size = F.concat(F.col("o_custkey") % 250, F.coalesce(unit, F.lit("")))
    return t.orders.select(
        "o_orderkey",
        validate.whole_between(F.year("o_orderdate").cast("string"), 1996, 2000).alias("year_ok"),
        validate.measure_between(size, validate.HEIGHT_LIMITS).alias("size_ok"),
        validate.one_of(F.col("o_orderstatus"), ["F", "O"]).alias("code_ok"),
        # the status is a letter: not a number, so the rule fails without an error
        validate.whole_between(F.col("o_orderstatus"), 0, 9).alias("number_ok"),
    )


def _travel_records(t):
    """A record text per customer with fields that pass or fail by its own values."""
    key, nation, cents = F.col("c_custkey"), F.col("c_nationkey"), F.floor(F.abs("c_acctbal") * 100)
    field = lambda name, value: F.concat(F.lit(f"{name}:"), value.cast("string"))
    eyes = F.array(*[F.lit(e) for e in [*validate.EYE_COLOURS, "xry"]])
    return t.customer.select("c_custkey", F.concat_ws(
        " ",
        field("byr", 1900 + key % 110), field("iyr", 2008 + nation % 14),
        F.when(key % 11 != 0, field("eyr", 2018 + key % 13)),
        field("hgt", F.concat(150 + nation * 2, F.lit("cm"))),
        F.when(key % 7 != 0, field("hcl", F.concat(F.lit("#"), F.lpad(F.lower(F.hex(key)), 6, "a")))),
        field("ecl", F.try_element_at(eyes, (key % 8 + 1).cast("int"))),
        field("pid", F.lpad(cents.cast("string"), 9, "0")),
        F.when(key % 3 == 0, field("cid", nation)),
    ).alias("record"))


_TRAVEL = """
WITH r AS (SELECT c_custkey, c_nationkey, c_custkey % 11 <> 0 AND c_custkey % 7 <> 0 AS complete,
  1900 + c_custkey % 110 BETWEEN 1920 AND 2002 AS byr, 2008 + c_nationkey % 14 BETWEEN 2010 AND 2020 AS iyr,
  c_custkey % 11 <> 0 AND 2018 + c_custkey % 13 BETWEEN 2020 AND 2030 AS eyr,
  150 + c_nationkey * 2 BETWEEN 150 AND 193 AS hgt,
  c_custkey % 7 <> 0 AND len(printf('%x', c_custkey)) <= 6 AS hcl, c_custkey % 8 < 7 AS ecl, true AS pid FROM customer)
"""


@query("fn_required_keys", _TRAVEL + "SELECT c_custkey, complete FROM r")
def fn_required_keys(t):
    record = text.key_values(F.col("record"))
    return _travel_records(t).select("c_custkey", validate.has_required_keys(record).alias("complete"))


@query("fn_record_valid", _TRAVEL + """
SELECT complete, count(*) AS records,
  count(*) FILTER (complete AND byr AND iyr AND eyr AND hgt AND hcl AND ecl AND pid) AS valid,
  count(*) FILTER (NOT byr) AS bad_byr, count(*) FILTER (NOT iyr) AS bad_iyr, count(*) FILTER (NOT eyr) AS bad_eyr,
  count(*) FILTER (NOT hgt) AS bad_hgt, count(*) FILTER (NOT hcl) AS bad_hcl, count(*) FILTER (NOT ecl) AS bad_ecl,
  count(*) FILTER (NOT pid) AS bad_pid FROM r GROUP BY 1
""")
def fn_record_valid(t):
    records = _travel_records(t).select(text.key_values(F.col("record")).alias("m"))
    m = F.col("m")
    rules = validate.record_rules(m)
    checked = records.select(
        validate.has_required_keys(m).alias("complete"), validate.record_valid(m).alias("ok"),
        *[rule.alias(name) for name, rule in rules.items()],
    )
    return checked.groupBy("complete").agg(
        F.count("*").alias("records"), F.count_if("ok").alias("valid"),
        *[F.count_if(~F.col(name)).alias(f"bad_{name}") for name in rules],
    )


@query("fn_kv_to_map", """
SELECT p_partkey, p_brand AS brand, p_type AS type, (p_size + 1)::BIGINT AS size FROM part
""")
def fn_kv_to_map(t):
    line = F.concat(
        F.lit("size:"), F.col("p_size"), F.lit(" brand:"), F.col("p_brand"), F.lit(" type:"), F.col("p_type"),
        F.lit(" size:"), F.col("p_size") + 1,  # a repeated key: the last one counts
    )
    m = text.key_values(line)
    return t.part.select(
        "p_partkey", m["brand"].alias("brand"), m["type"].alias("type"), m["size"].cast("bigint").alias("size")
    )


@query("fn_json_to_map", """
SELECT event_id, (props->>'k')::BIGINT AS k FROM events
""")
def fn_json_to_map(t):
    props = F.from_json("props", "MAP<STRING, STRING>")
    return t.events.select("event_id", props["k"].cast("bigint").alias("k"))


@query("fn_binary_partition_decode", """
SELECT p_partkey, p_partkey % 1024 AS seat, (p_partkey % 1024) // 8 AS seat_row, p_partkey % 8 AS seat_column FROM part
""")
def fn_binary_partition_decode(t):
    code = codes.seat_code(F.col("p_partkey") % 1024)
    return t.part.select("p_partkey", code.alias("code")).select(
        "p_partkey", codes.seat_number(F.col("code")).alias("seat"),
        codes.seat_row(F.col("code")).alias("seat_row"), codes.seat_column(F.col("code")).alias("seat_column"),
    )


# fixed values: the five walks, as steps right and down
WALKS = [(1, 1), (3, 1), (5, 1), (7, 1), (1, 2)]


@query("fn_strided_grid_lookup", "WITH w AS (SELECT " + ", ".join(
    f"count(*) FILTER (doc_id > 0 AND doc_id % {d} = 0 AND len(text) > 0 AND "
    f"substr(text, ((doc_id // {d}) * {r} % len(text) + 1)::INT, 1) = 'e')::BIGINT AS walk_{r}_{d}"
    for r, d in WALKS
) + " FROM documents) SELECT *, " + " * ".join(f"walk_{r}_{d}" for r, d in WALKS) + "::DOUBLE AS product FROM w")
def fn_strided_grid_lookup(t):
    met = {
        f"walk_{r}_{d}": F.count_if(codes.grid_cell(F.col("text"), F.col("doc_id"), r, d) == "e")
        for r, d in WALKS
    }
    hits = t.documents.agg(*[c.alias(n) for n, c in met.items()])
    product = F.lit(1.0)
    for name in met:
        product = product * F.col(name)
    return hits.withColumn("product", product)


@query("fn_parse_date", """
SELECT o_orderkey, o_orderdate::DATE AS day, o_orderdate AS stamp FROM orders
""")
def fn_parse_date(t):
    shown = F.upper(F.date_format("o_orderdate", "MMM dd, yyyy"))
    stamped = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t.orders.select(
        "o_orderkey", dates.month_day_year(F.initcap(shown)).alias("day"), dates.date_time(stamped).alias("stamp")
    )


@query("fn_date_parts", """
SELECT year(o_orderdate) AS year, month(o_orderdate) AS month, day(o_orderdate) AS day, count(*) AS n
FROM orders GROUP BY 1, 2, 3
""")
def fn_date_parts(t):
    parts = dates.date_parts(F.col("o_orderdate"))
    return t.orders.groupBy(*[c.alias(n) for n, c in parts.items()]).agg(F.count("*").alias("n"))


@query("fn_holiday_flags", """
WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)
SELECT o_orderkey, (month(d) = 12 AND day(d) = 24)::BIGINT AS christmas_eve,
  (month(d) = 12 AND day(d) = 25)::BIGINT AS christmas, (month(d) = 1 AND day(d) = 1)::BIGINT AS new_year,
  (month(d) = 11 AND dayofweek(d) = 4 AND day(d) BETWEEN 22 AND 28)::BIGINT AS thanksgiving FROM d
""")
def fn_holiday_flags(t):
    return t.orders.select("o_orderkey", *[c.alias(n) for n, c in dates.holiday_flags(F.col("o_orderdate")).items()])


@query("fn_coalesce_zero", "SELECT l_orderkey, l_linenumber, l_partkey, l_tax FROM lineitem")
def fn_coalesce_zero(t):
    gap = F.nullif("l_tax", F.lit(0.0))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", recode.zero_if_null(gap).alias("l_tax"))


@query("fn_null_sentinel", """
SELECT p_partkey, p_name, p_brand, nullif(p_type, 'PROMO') AS p_type FROM part
""")
def fn_null_sentinel(t):
    marked = t.part.select(
        "p_partkey", "p_name", "p_brand", F.when(F.col("p_type") == "PROMO", "NA").otherwise(F.col("p_type")).alias("p_type")
    )
    return project.map_columns(marked, recode.null_if_text, project.text_columns(marked))


@query("fn_has_value", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS has_discount
FROM lineitem
""")
def fn_has_value(t):
    gap = F.nullif("l_discount", F.lit(0.0))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", recode.has_value(gap).alias("has_discount"))


@query("fn_parse_int_null_safe", """
SELECT p_partkey, CASE WHEN p_size <> 7 THEN p_size::BIGINT END AS size FROM part
""")
def fn_parse_int_null_safe(t):
    shown = F.when(F.col("p_size") == 7, F.lit("NA")).otherwise(F.col("p_size").cast("string"))
    return t.part.select("p_partkey", recode.parse_whole(shown).alias("size"))


@query("fn_abs_round_arith", """
SELECT o_orderkey, round(o_totalprice / 7, 2) AS seventh, abs(o_custkey - 700) AS distance,
       1 <= o_custkey % 5 AND o_custkey % 5 <= 3 AS in_band FROM orders
""")
def fn_abs_round_arith(t):
    return t.orders.select(
        "o_orderkey", F.round(F.col("o_totalprice") / 7, 2).alias("seventh"),
        F.abs(F.col("o_custkey") - 700).alias("distance"), (F.col("o_custkey") % 5).between(1, 3).alias("in_band"),
    )


@query("fn_scale_constant", "SELECT p_partkey, p_size / 50 AS scaled FROM part")
def fn_scale_constant(t):
    return t.part.select("p_partkey", recode.scaled(F.col("p_size"), 50.0).alias("scaled"))


@query("fn_case_map", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
  WHEN '5-LOW' THEN 5 END AS code FROM orders
""")
def fn_case_map(t):
    code = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3, "5-LOW": 5}
    return t.orders.select("o_orderkey", recode.case_map(F.col("o_orderpriority"), code).alias("code"))
