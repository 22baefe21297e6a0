"""Fields out of stored web pages, by pattern and without a page loop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hyphens_to_spaces(text: Column) -> Column:
    return F.replace(text, F.lit("-"), F.lit(" "))


def link_targets(html: Column) -> Column:
    """Targets of all links, in page order."""
    return F.regexp_extract_all(html, F.lit('<a href="([^"]*)"'), F.lit(1))


def page_fields(pages: DataFrame, html: str = "html") -> DataFrame:
    """Title, language, number of links, and the first link's leading path part."""
    body = F.col(html)
    links = link_targets(body)
    first = F.try_element_at(links, F.lit(1))
    return pages.withColumns({
        "title": F.nullif(F.regexp_extract(body, "<title>([^<]*)</title>", 1), F.lit("")),
        "page_lang": F.nullif(F.regexp_extract(body, '<html lang="([^"]*)"', 1), F.lit("")),
        "n_links": F.size(links).cast("bigint"),
        "first_link": hyphens_to_spaces(
            F.nullif(F.regexp_extract(first, "^/([^/]*)", 1), F.lit(""))
        ),
    })


def table_cells(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Rows of every table of a page: ``(..., row_no, cells)``.

    Two levels of explode over ``<tr>`` and ``<td>``; money and link texts are
    cleaned by the column functions afterwards.  Tags may be in either case; rows of a table
    inside a cell are not told apart from those around it.
    """
    rows = F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), F.lit(1))
    cells = F.regexp_extract_all(F.col("_row"), F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), F.lit(1))
    kept = keep or []
    return (
        pages.select(*kept, F.posexplode(rows).alias("row_no", "_row"))
        .select(*kept, F.col("row_no").cast("bigint").alias("row_no"), cells.alias("cells"))
    )
