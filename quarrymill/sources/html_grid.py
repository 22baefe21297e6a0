"""Cells of HTML tables in their grid: nested tables, spans, any case, entities."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CELL_FIELDS = (
    "table_no INT, parent_table_no INT, row_no BIGINT, col_no BIGINT, "
    "row_span BIGINT, col_span BIGINT, is_head BOOLEAN, cell STRING"
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<(/?)([a-z][a-z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>",
    re.I | re.S)
_SPAN = re.compile(r"\b(row|col)span\s*=\s*[\"']?\s*(\d{1,6})", re.I)
_INLINE = frozenset("a abbr b bdi bdo cite code em font i ins del kbd mark q s samp small span strong sub sup tt u var".split())
_MOST = {"row": 65534, "col": 1000}  # the bounds that the HTML standard sets
_FLUSH = 50_000  # cells in one frame, so that a page of many cells is handed on in parts


class _Table:
    """An open table: its rows so far and, per column, the first row that is free again."""

    def __init__(self, number: int, parent: int | None):
        self.number, self.parent = number, parent
        self.row, self.col, self.cell = -1, 0, None
        self.free: dict[int, int] = {}
        self.cells: list[list] = []

    def start_row(self):
        self.cell, self.row, self.col = None, self.row + 1, 0

    def start_cell(self, attributes: str, head: bool):
        if self.row < 0:
            self.start_row()
        spans = {kind.lower(): min(int(n), _MOST[kind.lower()]) for kind, n in _SPAN.findall(attributes)}
        across, down = max(spans.get("col", 1), 1), spans.get("row", 1)
        while self.free.get(self.col, 0) > self.row:
            self.col += 1
        # 0 rows stand for all that follow
        until = self.row + (down or _MOST["row"])
        for c in range(self.col, self.col + across):
            self.free[c] = max(self.free.get(c, 0), until)
        self.cell = [self.row, self.col, until, across, head, []]
        self.cells.append(self.cell)
        self.col += across

    def rows(self):
        for row, col, until, across, head, parts in self.cells:
            text = " ".join(entities.unescape("".join(parts)).split())
            yield self.number, self.parent, row, col, min(until, self.row + 1) - row, across, head, text


def page_cells(page: str | None) -> Iterator[tuple]:
    """The cells of a page's tables, innermost tables first.

    A stack holds the tables that are open; text goes to the cell open in the innermost one.
    """
    stack: list[_Table] = []
    numbers, done = 0, 0
    page = page or ""

    def say(text: str):
        if text and stack and stack[-1].cell is not None:
            stack[-1].cell[5].append(text)

    for token in _TOKEN.finditer(page):
        say(page[done:token.start()])
        done = token.end()
        tag = (token[3] or "").lower()
        closing = bool(token[2])
        if tag == "table" and not closing:
            stack.append(_Table(numbers, stack[-1].number if stack else None))
            numbers += 1
        elif tag == "table" and stack:
            yield from stack.pop().rows()
            say(" ")
        elif tag == "tr" and stack:
            if closing:
                stack[-1].cell = None
            else:
                stack[-1].start_row()
        elif tag in ("td", "th") and stack:
            if closing:
                stack[-1].cell = None
            else:
                stack[-1].start_cell(token[4], tag == "th")
        elif tag and tag not in _INLINE:
            say(" ")
    say(page[done:])
    while stack:
        yield from stack.pop().rows()


def table_grid(pages: DataFrame, html: str = "html", keep: Sequence[str] = ()) -> DataFrame:
    """``(*keep, table_no, parent_table_no, row_no, col_no, row_span, col_span, is_head, cell)``: one row per cell.

    Tables are numbered from 0 by where they open; a table inside a cell has that cell's table as
    parent, and its text is its own, not the outer cell's.  Rows count every ``<tr>``; columns are
    those of the grid, so cells move right past cells that span from rows above.  A span of 0 rows
    reaches the table's end, and none reaches beyond it.  End tags of cells and rows may be missing.
    Entities are replaced, blanks joined to one; comments, scripts and styles are no text.
    A null or empty page and one without tables give no row.  ``keep`` must not hold the new names.

    Where a cell lies depends on all cells before it in the table, which no built-in function
    carries along; pages are read where they lie, without a shuffle, cells handed on in bounded frames.
    """
    fields = T._parse_datatype_string(_CELL_FIELDS).fields
    clash = {f.name for f in fields} & set(keep)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are names of the result")
    schema = T.StructType([pages.schema[k] for k in keep] + list(fields))
    names = schema.names
    n_keep = len(keep)

    def cells(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False, name=None):
                for cell in page_cells(row[n_keep]):
                    out.append(row[:n_keep] + cell)
                    if len(out) == _FLUSH:
                        yield frame(out)
                        out = []
            yield frame(out)

    def frame(rows):
        made = pd.DataFrame(rows, columns=names, dtype=object)
        return made

    return pages.select(*keep, F.col(html).alias("_html")).mapInPandas(cells, schema)


def covered(grid: DataFrame) -> DataFrame:
    """Every grid position with the cell that covers it, spans written out: ``row_no``, ``col_no`` are the position's."""
    place = lambda start, span: F.explode(F.sequence(F.col(start), F.col(start) + F.col(span) - 1))
    down = grid.withColumn("row_no", place("row_no", "row_span"))
    return down.withColumn("col_no", place("col_no", "col_span")).drop("row_span", "col_span")
