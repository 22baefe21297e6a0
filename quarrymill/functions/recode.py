"""Recoding: labels to codes, many values to few, missing to something."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions.text import first_number

# Units per year used to turn an age in words into years.
UNITS_PER_YEAR = {"year": 1.0, "month": 12.0, "week": 52.1429, "day": 365.0}

# Colour families, tested in this order; the first hit decides.
COLOUR_FAMILIES = [
    ("Tabby", ["Tabby"]), ("Point", ["Point"]), ("Brindle", ["Brindle"]),
    ("Calico", ["Calico"]), ("Merle", ["Merle"]), ("Tricolor", ["Tricolor"]),
    ("Sable", ["Sable"]), ("Blue", ["Blue Tick", "Blue Cream"]), ("Black", ["Black Smoke"]),
    ("Multiple Colors", ["/"]), ("Tortie/Torbie", ["Tortie", "Torbie"]),
]

# The two readings of a sex-and-status text, each in test order.
SEX = [("Male", ["Male"]), ("Female", ["Female"])]
STATUS = [("Spayed/Neutered", ["Neutered", "Spayed"]), ("Intact", ["Intact"])]


def duration_years(text: Column, unknown_is_days: bool = True) -> Column:
    """``"3 months"`` to years.  An unknown unit is read as days, or as missing."""
    n = first_number(text)
    out = None
    for unit, per_year in UNITS_PER_YEAR.items():
        years = n / F.lit(per_year)
        out = F.when(F.contains(text, F.lit(unit)), years) if out is None else out.when(
            F.contains(text, F.lit(unit)), years
        )
    return out.otherwise(n / F.lit(UNITS_PER_YEAR["day"])) if unknown_is_days else out


def first_match(text: Column, families: Sequence[tuple[str, list[str]]]) -> Column:
    """The label of the first family with a word in the text, else the text itself."""
    out = F
    for label, words in families:
        hit = F.contains(text, F.lit(words[0]))
        for word in words[1:]:
            hit = hit | F.contains(text, F.lit(word))
        out = out.when(hit, F.lit(label))
    return out.otherwise(text)


def case_map(text: Column, codes: dict, default=None) -> Column:
    """Labels to codes; an unlisted label gives ``default``."""
    out = F
    for label, code in codes.items():
        out = out.when(text == label, F.lit(code))
    return out.otherwise(F.lit(default))


def null_if_text(text: Column, marker: str = "NA") -> Column:
    """The marker text stands for a missing value."""
    return F.nullif(text, F.lit(marker))


def has_value(col: Column) -> Column:
    """1.0 where a value is present, else 0.0."""
    return col.isNotNull().cast("double")


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0.0))


def parse_whole(text: Column) -> Column:
    """Text to a whole number; a missing or unreadable text stays missing."""
    return text.try_cast("bigint")


def scaled(col: Column, by: float) -> Column:
    return col / F.lit(by)
