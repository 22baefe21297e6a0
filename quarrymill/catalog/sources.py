"""Scans, parsers and sinks on the shared tables."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.catalog import query
from quarrymill.operators import features, models
from quarrymill.session import scratch_path
from quarrymill.sources import delimited, html, html_grid, inferred, literal, text


@query("scan_csv", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def scan_csv(t):
    return delimited.csv_round_trip(t.customer, "customer-csv")


@query("scan_csv_folder", """
SELECT c_mktsegment AS segment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
FROM customer GROUP BY 1
""")
def scan_csv_folder(t):
    path = scratch_path(t.spark, "customer-by-segment")
    t.customer.select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias("segment")).write.partitionBy(
        "segment"
    ).option("header", True).csv(path)
    files = delimited.read_csv_folder(
        t.spark, path, "c_custkey BIGINT, c_acctbal DOUBLE", name_column="folder", level="folder"
    )
    return files.groupBy(F.split_part("folder", F.lit("="), F.lit(2)).alias("segment")).agg(
        F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query("scan_ragged_header", """
SELECT c_custkey AS "Key", c_name AS "Note3", c_acctbal AS "Sum", c_mktsegment AS "Note5" FROM customer
""")
def scan_ragged_header(t):
    path = scratch_path(t.spark, "ragged")
    delimited.write_csv(
        t.customer.select(
            F.monotonically_increasing_id().alias("a"), "c_custkey", F.lit("@").alias("b"),
            "c_name", "c_acctbal", "c_mktsegment", F.lit(1).alias("c"),
        ), path,
    )
    # a header with a blank name in third place and a repeated one
    header = ["No", "Key", "", "Note", "Sum", "Note", "End"]
    return delimited.read_ragged_header(
        t.spark, path, header, keep=[1, 3, 4, 5],
        types={1: T.LongType(), 4: T.DoubleType()},
    )


@query("scan_text_lines", """
SELECT o_orderkey AS v, count(*) AS n FROM orders GROUP BY 1
""")
def scan_text_lines(t):
    padded = t.orders.select(F.concat(F.lit("  "), F.col("o_orderkey"), F.lit(" ")).alias("line"))
    path = text.write_text(padded, "line", scratch_path(t.spark, "order-lines"))
    return (
        text.read_lines(t.spark, path).select(F.col("value").cast("bigint").alias("v"))
        .groupBy("v").agg(F.count("*").alias("n"))
    )


@query("scan_text_records", """
SELECT c_custkey AS custkey, c_name AS name, c_mktsegment AS segment, c_nationkey::BIGINT AS nation
FROM customer
""")
def scan_text_records(t):
    # two lines per customer, records apart by a blank line
    body = F.concat(
        F.lit("key:"), F.col("c_custkey"), F.lit(" name:"), F.col("c_name"), F.lit("\nseg:"),
        F.col("c_mktsegment"), F.lit(" nat:"), F.col("c_nationkey"),
    )
    path = text.write_text(
        t.customer.select(body.alias("r")), "r", scratch_path(t.spark, "records"), "\n\n"
    )
    pairs = F.str_to_map(F.col("record"), F.lit(" "), F.lit(":"))
    return text.read_records(t.spark, path).select(pairs.alias("m")).select(
        F.col("m")["key"].cast("bigint").alias("custkey"), F.col("m")["name"].alias("name"),
        F.col("m")["seg"].alias("segment"), F.col("m")["nat"].cast("bigint").alias("nation"),
    )


@query("parse_regex_struct", """
SELECT p_partkey,
       CASE WHEN p_size % 10 <> 0 THEN p_size::BIGINT END AS low,
       CASE WHEN p_size % 10 <> 0 THEN (p_size + 3)::BIGINT END AS high,
       CASE WHEN p_size % 10 <> 0 THEN substr(p_name, 1, 1) END AS letter,
       CASE WHEN p_size % 10 <> 0 THEN split_part(p_name, ' ', 2) END AS word
FROM part
""")
def parse_regex_struct(t):
    # every tenth size leaves out the colon, so those lines do not match
    line = F.concat(
        F.col("p_size"), F.lit("-"), F.col("p_size") + 3, F.lit(" "), F.substring("p_name", 1, 1),
        F.when(F.col("p_size") % 10 == 0, F.lit(" ")).otherwise(F.lit(": ")),
        F.split_part("p_name", F.lit(" "), F.lit(2)),
    )
    fields = {"low": "bigint", "high": "bigint", "letter": "string", "word": "string"}
    return t.part.select("p_partkey", line.alias("line")).select(
        "p_partkey", *text.regex_struct(F.col("line"), r"(\d+)-(\d+) (\w): (\w+)", fields)
    )


@query("parse_rule_lines", """
SELECT p_partkey, p_brand AS parent, split_part(p_name, ' ', 1) AS child, p_size::BIGINT AS qty
FROM part WHERE p_type <> 'PROMO'
UNION ALL
SELECT p_partkey, p_brand, split_part(p_name, ' ', 2), (p_size + 1)::BIGINT
FROM part WHERE p_type <> 'PROMO'
UNION ALL
SELECT p_partkey, p_brand, NULL, NULL FROM part WHERE p_type = 'PROMO'
""")
def parse_rule_lines(t):
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    inside = F.when(F.col("p_type") == "PROMO", F.lit("no other bags.")).otherwise(
        F.concat(
            F.col("p_size"), F.lit(" "), first,
            F.when(F.col("p_size") == 1, F.lit(" bag, ")).otherwise(F.lit(" bags, ")),
            F.col("p_size") + 1, F.lit(" "), second, F.lit(" bags."),
        )
    )
    lines = t.part.select("p_partkey", F.concat("p_brand", F.lit(" bags contain "), inside).alias("line"))
    return text.rule_edges(lines, "line", keep=("p_partkey",))


@query("parse_opcode_lines", """
SELECT event_type AS word, count(*) AS n, sum(CAST(floor(value) AS BIGINT) - 20)::BIGINT AS total
FROM events GROUP BY 1
""")
def parse_opcode_lines(t):
    shifted = F.floor("value") - 20
    line = F.concat(
        F.col("event_type"), F.lit(" "),
        F.when(shifted >= 0, F.concat(F.lit("+"), shifted)).otherwise(shifted.cast("string")),
    )
    parsed = t.events.select(line.alias("line")).select(*text.instruction(F.col("line")))
    return parsed.groupBy("word").agg(F.count("*").alias("n"), F.sum("arg").alias("total"))


@query("scan_html_table", """
SELECT page_id,
       nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title,
       nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS page_lang,
       len(regexp_extract_all(html, '<a href="([^"]*)"', 1))::BIGINT AS n_links,
       replace(nullif(regexp_extract(regexp_extract_all(html, '<a href="([^"]*)"', 1)[1], '^/([^/]*)', 1), ''), '-', ' ') AS first_link
FROM pages
""")
def scan_html_table(t):
    return html.page_fields(t.pages).drop("url", "html")


@query("scan_html_cells", """
SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) - 1 AS row_no,
  l_linenumber::BIGINT AS line, l_extendedprice AS price FROM lineitem
""")
def scan_html_cells(t):
    """One page per order with a table of its lines, stored and read back cell by cell."""
    row = F.concat(F.lit("<tr>\n<td>"), F.col("l_linenumber"), F.lit("</td><td>$"), F.col("l_extendedprice"), F.lit("</td></tr>"))
    rows = F.transform(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_extendedprice", row.alias("tr")))), lambda r: r.tr)
    pages = t.lineitem.groupBy("l_orderkey").agg(
        F.concat(F.lit("<html><table>"), F.array_join(rows, ""), F.lit("</table></html>")).alias("html"))
    stored = delimited.store_table(pages, "pages")
    cells = html.table_cells(stored, keep=["l_orderkey"])
    return cells.select(
        "l_orderkey", "row_no", F.col("cells")[0].cast("bigint").alias("line"),
        F.regexp_replace(F.col("cells")[1], r"[$,]", "").cast("double").alias("price"))


@query("scan_csv_file_names", """
SELECT c_mktsegment AS segment, count(*) AS n, true AS named FROM customer GROUP BY 1
""")
def scan_csv_file_names(t):
    """A folder scan whose rows carry their file's name, the ending taken off."""
    path = scratch_path(t.spark, "customer-files")
    delimited.write_csv(t.customer.select("c_custkey", "c_acctbal", "c_mktsegment"), path)
    files = delimited.read_csv_folder(
        t.spark, path, "c_custkey BIGINT, c_acctbal DOUBLE, c_mktsegment STRING", suffix=".csv", name_column="file")
    return files.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("n"), F.every(F.col("file").rlike(r"^part-[^.]*$")).alias("named"))


@query("literal_table", """
WITH m(month_no, month, season) AS (VALUES
  (1, 'January', 'winter'), (2, 'February', 'winter'), (3, 'March', 'spring'),
  (4, 'April', 'spring'), (5, 'May', 'spring'), (6, 'June', 'summer'),
  (7, 'July', 'summer'), (8, 'August', 'summer'), (9, 'September', 'autumn'),
  (10, 'October', 'autumn'), (11, 'November', 'autumn'), (12, 'December', 'winter'))
SELECT m.month, m.season, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders JOIN m ON month(o_orderdate) = m.month_no GROUP BY 1, 2
""")
def literal_months(t):
    months = literal.literal_table(t.spark, {
        "month_no": list(range(1, 13)),
        "month": ["January", "February", "March", "April", "May", "June", "July", "August",
                  "September", "October", "November", "December"],
        "season": ["winter"] * 2 + ["spring"] * 3 + ["summer"] * 3 + ["autumn"] * 3 + ["winter"],
    }, "month_no INT, month STRING, season STRING")
    per_month = t.orders.groupBy(F.month("o_orderdate").alias("month_no")).agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    return per_month.join(F.broadcast(months), "month_no").drop("month_no")  # 12 literal rows


@query("sink_csv", "SELECT * FROM supplier")
def sink_csv(t):
    return delimited.csv_round_trip(t.supplier, "supplier-csv")


# the model widens every variance by a billionth of the widest feature's
@query("sink_submission", """
WITH x AS (SELECT vec_id, label, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings),
w AS (SELECT max(v) AS widest FROM (SELECT var_pop(x) AS v FROM x GROUP BY d)),
m AS (SELECT label, d, avg(x) AS mu, var_pop(x) + any_value(w.widest) * 1e-9::DOUBLE AS v FROM x, w GROUP BY 1, 2),
c AS (SELECT label, ln(count(*)::DOUBLE / sum(count(*)) OVER ()) AS prior FROM embeddings GROUP BY 1),
l AS (SELECT x.vec_id, m.label, any_value(c.prior) + sum(-0.5::DOUBLE * ln(2 * pi() * v) - (x - mu) * (x - mu) / (2 * v)) AS l
  FROM x JOIN m USING (d) JOIN c ON c.label = m.label GROUP BY 1, 2),
e AS (SELECT vec_id, label, exp(l - max(l) OVER (PARTITION BY vec_id)) AS w FROM l)
SELECT vec_id, """ + ", ".join(
    f"round(sum(w) FILTER (label = {i}) / sum(w), 6) AS label_{i}" for i in range(10)
) + " FROM e GROUP BY 1")
def sink_submission(t):
    rows = models.embedding_rows(t.embeddings)
    model = models.naive_bayes().fit(rows)
    scored = models.probability_columns(model.transform(rows), "vec_id", range(10), prefix="label_")
    rounded = scored.select("vec_id", *[F.round(c, 6).alias(c) for c in scored.columns[1:]])
    return delimited.csv_round_trip(rounded, "submission")


@query("cache_intermediate", """
SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS mean_price
FROM orders GROUP BY 1
""")
def cache_intermediate(t):
    kept = delimited.store_table(t.orders.select("o_orderpriority", "o_totalprice"), "prepared")
    return kept.groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.avg("o_totalprice"), 4).alias("mean_price")
    )


@query("save_model", """
SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER (), 6) AS z FROM orders
""")
def save_model(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    fitted = Pipeline(stages=features.standard_scaler_stages(["o_totalprice"])).fit(orders)
    path = scratch_path(t.spark, "scaler")
    fitted.write().overwrite().save(path)
    scaled = features.vector_columns(PipelineModel.load(path).transform(orders), "scaled", ["z"])
    return scaled.select("o_orderkey", F.round("z", 6).alias("z"))


@query("scan_csv_inferred", """
SELECT o_orderkey, o_custkey::BIGINT AS o_custkey, o_orderstatus, o_totalprice, o_orderdate::DATE AS o_orderdate,
  o_totalprice > 100000 AS large, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey % 10 END AS digit FROM orders
""")
def scan_csv_inferred(t):
    """No schema is stated: numbers, days, truth values and gaps are found in the values."""
    rows = t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"),
        (F.col("o_totalprice") > 100000).alias("large"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 10).alias("digit"))
    path = delimited.write_csv(rows, scratch_path(t.spark, "orders-csv"))
    return inferred.read_csv_by_name(t.spark, path)


@query("scan_csv_other_headers", """
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 THEN c_name END AS c_name, CASE WHEN c_custkey % 3 <> 2 THEN c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE floor(c_acctbal) END AS c_acctbal,
  CASE WHEN c_custkey % 3 = 0 THEN c_nationkey::VARCHAR WHEN c_custkey % 3 = 1 THEN 'n' || c_nationkey END AS mixed
FROM customer
""")
def scan_csv_other_headers(t):
    """Three layouts of one folder: other orders, missing columns, types that widen to doubles and to text."""
    path = scratch_path(t.spark, "customer-layouts")
    whole = F.floor("c_acctbal").alias("c_acctbal")
    layouts = [
        ["c_custkey", "c_name", "c_mktsegment", "c_acctbal", F.col("c_nationkey").alias("mixed")],
        [F.concat(F.lit("n"), F.col("c_nationkey")).alias("mixed"), whole, "c_mktsegment", "c_custkey"],
        ["c_name", "c_custkey", whole],
    ]
    for i, layout in enumerate(layouts):
        delimited.write_csv(t.customer.where(F.col("c_custkey") % 3 == i).select(*layout), f"{path}/{i}")
    return inferred.read_csv_by_name(t.spark, path)


@query("scan_html_grid", """
WITH c AS (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment, c_custkey) AS i,
  row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS j,
  count(*) OVER (PARTITION BY c_nationkey, c_mktsegment) AS n FROM customer),
g AS (SELECT c_nationkey, 0 AS table_no, NULL::INT AS parent_table_no, i AS row_no, 0::BIGINT AS col_no, n AS row_span,
    1::BIGINT AS col_span, false AS is_head, c_mktsegment AS cell FROM c WHERE j = 1
  UNION ALL SELECT c_nationkey, 0, NULL, i, 1, 1, 1, false, c_name FROM c
  UNION ALL SELECT c_nationkey, 0, NULL, i, 2, 1, 1, false, 'see < and >' FROM c
  UNION ALL SELECT c_nationkey, i::INT, 0, 0, 0, 1, 1, false, 'key ' || c_custkey FROM c
  UNION ALL SELECT DISTINCT c_nationkey, 0, NULL::INT, 0, 0, 1, 1, true, 'Segment' FROM c
  UNION ALL SELECT DISTINCT c_nationkey, 0, NULL::INT, 0, 1, 1, 2, true, 'Name & key' FROM c)
SELECT * FROM g
""")
def scan_html_grid(t):
    """A page per nation: segments that span the rows of their customers, and a table inside a cell of each."""
    per_segment = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(
        F.sort_array(F.collect_list(F.struct("c_custkey", "c_name"))).alias("members"))
    row = lambda m, i: F.concat(
        F.lit("<TR>"), F.when(i == 0, F.concat(
            F.lit('<td rowspan="'), F.size("members"), F.lit('">'), F.col("c_mktsegment"))).otherwise(F.lit("")),
        F.lit("<td><b>"), m["c_name"], F.lit("</b></TD><td> see &lt; <table><tr><td>key "), m["c_custkey"],
        F.lit("</table> and &gt;</td></tr>"))
    rows = per_segment.select("c_nationkey", "c_mktsegment", F.array_join(F.transform("members", row), "\n").alias("tr"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("c_mktsegment", "tr"))), lambda r: r.tr), "")
    head = F.lit("<html><!-- <td>no cell --><TABLE BORDER=1><TR><TH>Segment</TH><TH COLSPAN='2'>Name &amp; key</TH></TR>")
    pages = rows.groupBy("c_nationkey").agg(F.concat(head, body, F.lit("</TABLE></html>")).alias("html"))
    stored = delimited.store_table(pages, "nation-pages")
    return html_grid.table_grid(stored, keep=["c_nationkey"])
