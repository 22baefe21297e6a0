"""Place codes, and cells of a grid that repeats to the right."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seat_number(code: Column) -> Column:
    """A place code of halving letters (F/B for rows, L/R for columns) as one number.

    Each letter halves the range, so the code is a binary number in disguise.
    """
    return F.conv(F.translate(code, "FBLR", "0101"), 2, 10).cast("bigint")


def seat_row(code: Column) -> Column:
    return seat_number(F.substring(code, 1, 7))


def seat_column(code: Column) -> Column:
    return seat_number(F.substring(code, 8, 3))


def seat_code(number: Column) -> Column:
    """The ten-letter code of a number below 1024."""
    bits = F.lpad(F.conv(number.cast("string"), 10, 2), 10, "0")
    return F.concat(
        F.translate(F.substring(bits, 1, 7), "01", "FB"), F.translate(F.substring(bits, 8, 3), "01", "LR")
    )


def grid_cell(line: Column, row_no: Column, right: int, down: int) -> Column:
    """The character a walk (``right``, ``down``) meets on this row; null where it does not stop.

    Lines repeat to the right.  The walk starts on row 0, which it does not test.
    """
    stop = (F.pmod(row_no, F.lit(down)) == 0) & (row_no > 0) & (F.length(line) > 0)
    step = F.floor(row_no / F.lit(down)) * right
    place = F.pmod(step, F.length(line).cast("bigint")) + 1
    return F.when(stop, F.substr(line, place.cast("int"), F.lit(1)))
