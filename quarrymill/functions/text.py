"""Text into parts: patterns, cleaning, splitting, counting letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_number(text: Column) -> Column:
    """First run of digits as a whole number; null when there is none."""
    return F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit("")).cast("bigint")


def all_numbers(text: Column) -> Column:
    """Every run of digits, as text."""
    return F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1))


def money(text: Column) -> Column:
    """``$1,234.00`` to a number."""
    return F.translate(text, "$,", "").try_cast("double")


def without_prefix(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, f"^(?:{pattern})", "")


def count_letter(text: Column, letter: Column) -> Column:
    """How often a letter occurs in a text."""
    return F.length(text) - F.length(F.replace(text, letter, F.lit("")))


def letter_count_between(text: Column, letter: Column, low, high) -> Column:
    return count_letter(text, letter).between(low, high)


def letter_at_one_of(text: Column, letter: Column, first, second) -> Column:
    """The letter stands at exactly one of two places (counted from 1).

    A place behind the end of the text counts as no match.
    """
    at = lambda i: (F.substr(text, i, F.lit(1)) == letter).cast("int")
    as_col = lambda i: i if isinstance(i, Column) else F.lit(i)
    return at(as_col(first)) + at(as_col(second)) == 1


def labelled(*parts: Column) -> Column:
    """Parts joined by single blanks, as a plot label."""
    return F.concat_ws(" ", *parts)


def key_values(text: Column) -> Column:
    """``"k:v k:v"`` to a map; of a repeated key the last value stays.

    Needs ``spark.sql.mapKeyDedupPolicy=LAST_WIN``, see the session settings.
    """
    return F.str_to_map(text, F.lit(" "), F.lit(":"))
