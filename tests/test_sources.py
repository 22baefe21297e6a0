"""Files with awkward names, headers and separators."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrymill.catalog import oracles, renditions
from quarrymill.operators import ordered
from quarrymill.sources import delimited, html, html_grid, inferred, literal, text


def test_folder_of_files_with_blanks_in_their_names(spark, tmp_path):
    (tmp_path / "Clint Player.txt").write_text("game,rb\n1,5\n2,NA\n3,2\n")
    (tmp_path / "Xtxt.txt").write_text("game,rb\n1,7\n")
    df = delimited.read_csv_folder(spark, str(tmp_path), "game INT, rb INT", name_column="player")
    assert {(r.player, r.game, r.rb) for r in df.collect()} == {
        ("Clint Player", 1, 5), ("Clint Player", 2, None), ("Clint Player", 3, 2), ("Xtxt", 1, 7)}
    total = ordered.running_total(df, ["player"], ["game"], "rb", "game")
    assert {(r.player, r.game): r.total for r in total.collect()} == {
        ("Clint Player", 1): 5, ("Clint Player", 2): 5, ("Clint Player", 3): 7, ("Xtxt", 1): 7}


def test_folder_keeps_doubled_quotes_commas_and_blanks(spark, tmp_path):
    (tmp_path / "a.txt").write_text('said,n\n"he said ""hi"", ok",1\n" x ",2\n')
    df = delimited.read_csv_folder(spark, str(tmp_path), "said STRING, n INT")
    assert {(r.said, r.n) for r in df.collect()} == {('he said "hi", ok', 1), (" x ", 2)}
    one = delimited.read_ragged_header(spark, str(tmp_path), ["said", "n"], [0, 1], {1: T.IntegerType()})
    assert {tuple(r) for r in one.collect()} == {('he said "hi", ok', 1), (" x ", 2)}


def test_header_with_blank_and_repeated_names(spark, tmp_path):
    (tmp_path / "log.txt").write_text("No,Day,,Side,Own,Side,\n1,4,at,RED,31,27,x\n2,9,,TEAL,18,40,x")
    header = ["No", "Day", "", "Side", "Own", "Side", ""]
    assert delimited.positional_schema(header).names == ["No", "Day", "_c2", "Side3", "Own", "Side5", "_c6"]
    df = delimited.read_ragged_header(
        spark, str(tmp_path), header, [1, 3, 4, 5], {1: T.IntegerType(), 4: T.IntegerType(), 5: T.IntegerType()})
    assert df.collect() == [(4, "RED", 31, 27), (9, "TEAL", 18, 40)]


def test_records_between_blank_lines(spark, tmp_path):
    path = tmp_path / "records.txt"
    path.write_text("a:1 b:2\nc:3\n\nd:4\n\n\n\ne:5\n")
    assert sorted(r.record for r in text.read_records(spark, str(path)).collect()) == ["a:1 b:2 c:3", "d:4", "e:5"]


def test_lines_and_instructions(spark, tmp_path):
    path = tmp_path / "lines.txt"
    path.write_text(" acc +6 \n\njmp -4\n")
    got = text.read_lines(spark, str(path)).select(*text.instruction(F.col("value"))).collect()
    assert got == [("acc", 6), ("jmp", -4)]


def test_rule_lines(spark):
    lines = ["old oak bags contain 1 tin cup bag, 2 wool sock bags.",
             "plain jar bags contain no other bags.", "no 9 bags contain 3 x bags."]
    df = spark.createDataFrame([(x,) for x in lines], "line STRING")
    assert {tuple(r) for r in text.rule_edges(df, "line").collect()} == {
        ("old oak", "tin cup", 1), ("old oak", "wool sock", 2), ("plain jar", None, None), ("no 9", "x", 3)}


def test_regex_struct_is_null_without_a_match(spark):
    df = spark.createDataFrame([("1-3 a: abc",), ("junk",)], "line STRING")
    got = df.select(*text.regex_struct(F.col("line"), r"(\d+)-(\d+) (\w): (\w+)", {
        "low": "int", "high": "int", "letter": "string", "word": "string"})).collect()
    assert got == [(1, 3, "a", "abc"), (None, None, None, None)]


def test_html_tables(spark):
    page = ('<html lang="en"><title>Pay</title><a href="/big-school/x">s</a><table><tr><td>A</td><td>$1,200.50</td></tr>'
            "<tr>\n<td>B</td><td>$3</td></tr></table>")
    df = spark.createDataFrame([(1, page), (2, "<p>none</p>")], "id INT, html STRING")
    fields = html.page_fields(df).drop("html").orderBy("id").collect()
    assert fields == [(1, "Pay", "en", 1, "big school"), (2, None, None, 0, None)]
    cells = html.table_cells(df, keep=["id"]).collect()
    assert [(r.id, r.row_no, r.cells) for r in cells] == [(1, 0, ["A", "$1,200.50"]), (1, 1, ["B", "$3"])]


def test_round_trips(spark):
    df = literal.literal_table(spark, {"m": ["Jan", "NA", None], "x": [1.5, None, 2.0]}, "m STRING, x DOUBLE")
    assert sorted(map(str, delimited.csv_round_trip(df.where("m = 'Jan'"), "t").collect())) == ["Row(m='Jan', x=1.5)"]
    assert delimited.csv_round_trip(df, "t").where("m IS NULL").count() == 2  # the text NA means missing
    assert delimited.store_table(df, "t").count() == 3


def test_names_keep_to_the_rules():
    names = list(renditions())
    assert len(names) == len(set(names)) and not any("pipeline" in n or n.startswith("op") for n in names)
    assert set(oracles()) <= set(names)


def test_texts_with_breaks_blanks_and_quotes_survive_a_round_trip(spark):
    texts = ["two\nlines", "  blanks  ", 'a "quoted" word', "comma, here", "back\\slash", "tail\r\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, t STRING")
    assert {r.i: r.t for r in delimited.csv_round_trip(df, "t").collect()} == dict(enumerate(texts))


def test_records_with_windows_line_ends(spark, tmp_path):
    path = tmp_path / "records.txt"
    path.write_bytes(b"a:1\r\nb:2\r\n\r\nc:3\r\n")
    assert sorted(r.record for r in text.read_records(spark, str(path)).collect()) == ["a:1 b:2", "c:3"]


def test_tags_in_capitals_and_table_heads(spark):
    page = "<TABLE><THEAD><TR CLASS=x><TH>a</TH ></TR></THEAD><tr><Td>1</tD><td id='q'>2</td></tr></TABLE><track src=y>"
    df = spark.createDataFrame([(1, page)], "id INT, html STRING")
    assert [(r.row_no, r.cells) for r in html.table_cells(df).orderBy("row_no").collect()] == [(0, ["a"]), (1, ["1", "2"])]


def test_files_with_other_headers_and_types_become_one_table(spark, tmp_path):
    (tmp_path / "a b.csv").write_bytes(b"\xef\xbb\xbfgame,rb,said\r\n1,5,\"x, \"\"y\"\"\"\r\n2,NA,\r\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "c.csv").write_text("\nrb,day,Game,game\n2.5,2024-02-29,t,3\n,2024-03-01,u\n")
    (tmp_path / "head.csv").write_text("late\n")
    (tmp_path / "none.csv").write_text("")
    df = inferred.read_csv_by_name(spark, str(tmp_path), file_column="file")
    assert {n: k for n, k in df.dtypes} == {
        "game": "bigint", "rb": "double", "said": "string", "day": "date", "Game": "string", "late": "string", "file": "string"}
    order = [df.columns.index(c) for c in ("file", "game", "rb", "said", "day", "Game", "late")]
    assert sorted(tuple(str(r[i]) for i in order) for r in df.collect()) == [
        ("a b.csv", "1", "5.0", 'x, "y"', "None", "None", "None"),
        ("a b.csv", "2", "None", "None", "None", "None", "None"),
        ("c.csv", "3", "2.5", "None", "2024-02-29", "t", "None"),
        ("c.csv", "None", "None", "None", "2024-03-01", "u", "None")]
    stated = inferred.read_csv_by_name(spark, str(tmp_path), types={"rb": "string", "day": "string"})
    assert {dict(stated.dtypes)[c] for c in ("rb", "day")} == {"string"}


def test_blank_and_repeated_header_names_and_folders_without_rows(spark, tmp_path):
    (tmp_path / "log.csv").write_text('No,,Side,"a,b",Side,\n1,at,x,2,y,z\n')
    df = inferred.read_csv_by_name(spark, str(tmp_path))
    assert df.columns == ["No", "_c1", "Side2", "a,b", "Side4"] and df.collect() == [(1, "at", "x", 2, "y")]
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "none.csv").write_text("")
    assert inferred.read_csv_by_name(spark, str(tmp_path / "e")).columns == []
    with pytest.raises(ValueError):
        inferred.read_csv_by_name(spark, str(tmp_path), file_column="No")


@pytest.mark.parametrize("values, kind", [
    (["1", "-2", "+3", None], "bigint"), (["1", "2.5"], "double"), (["1e3", ".5", "7."], "double"),
    (["9223372036854775807"], "bigint"), (["9223372036854775808"], "double"), (["NaN", "1", "-Inf"], "double"),
    (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-02-29"], "date"), (["2023-02-29"], "string"),
    (["2024-02-29", "2024-03-01 10:30:00"], "timestamp"), (["2024-01-01", "5"], "string"), ([None], "string"),
    ([" 1"], "string"), (["1", ""], "string"), (["1_000"], "string"), (["12:30"], "string"),
])
def test_narrowest_type_of_a_column(spark, values, kind):
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    assert inferred.column_types(df) == {"v": kind}


def _grid(spark, page):
    rows = html_grid.table_grid(spark.createDataFrame([(7, page)], "id INT, html STRING"), keep=["id"]).collect()
    return sorted((r.table_no, r.row_no, r.col_no, r.row_span, r.col_span, r.cell) for r in rows)


def test_spans_move_cells_of_rows_below(spark):
    page = ("<table><tr><td rowspan=2>a<td>b<td rowspan='0'>c<tr><td colspan=\"3\">d</table>")
    assert _grid(spark, page) == [(0, 0, 0, 2, 1, "a"), (0, 0, 1, 1, 1, "b"), (0, 0, 2, 2, 1, "c"), (0, 1, 1, 1, 3, "d")]
    grid = html_grid.table_grid(spark.createDataFrame([(page.replace("3", "1"),)], "html STRING"))
    assert sorted((r.row_no, r.col_no, r.cell) for r in html_grid.covered(grid).collect()) == [
        (0, 0, "a"), (0, 1, "b"), (0, 2, "c"), (1, 0, "a"), (1, 1, "d"), (1, 2, "c")]


def test_tables_in_cells_entities_and_missing_end_tags(spark):
    page = ("<p>out<TABLE><TR><TH>x &amp;&nbsp;y<br>z</TH> stray <td>in <table><tr><td>deep <b>wo</b>rd</table> after</td>"
            "<!-- <td>no</td> --><script>'<td>no'</script></table><table><td title='a > b'>1 < 2<td>")
    assert _grid(spark, page) == [
        (0, 0, 0, 1, 1, "x & y z"), (0, 0, 1, 1, 1, "in after"), (1, 0, 0, 1, 1, "deep word"),
        (2, 0, 0, 1, 1, "1 < 2"), (2, 0, 1, 1, 1, "")]


def test_pages_without_tables_long_pages_and_clashing_names(spark):
    assert [_grid(spark, p) for p in (None, "", "<td>no table</td>", "</table>")] == [[]] * 4
    many = "<table>" + "<tr><td>1<td>2" * 60_000 + "</table>"
    assert len(_grid(spark, many)) == 120_000
    assert _grid(spark, "<a " * 300_000) == [] and _grid(spark, "<table><td>" + "<a '" * 100_001)[0][:2] == (0, 0)
    with pytest.raises(ValueError):
        html_grid.table_grid(spark.createDataFrame([("x", 1)], "html STRING, cell INT"), keep=["cell"])
