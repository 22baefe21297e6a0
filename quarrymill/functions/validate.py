"""Record checks.  A rule gives true or false, never null and never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields of a travel record, the one that may be absent, and
# the limits and codes its fields must keep to.
RECORD_KEYS = ["byr", "iyr", "eyr", "hgt", "hcl", "ecl", "pid", "cid"]
OPTIONAL_KEYS = ["cid"]
YEAR_LIMITS = {"byr": (1920, 2002), "iyr": (2010, 2020), "eyr": (2020, 2030)}
HEIGHT_LIMITS = {"cm": (150, 193), "in": (59, 76)}
EYE_COLOURS = ["amb", "blu", "brn", "gry", "grn", "hzl", "oth"]
HAIR_COLOUR = r"^#[a-f\d]{6}\z"
NINE_DIGITS = r"^\d{9}\z"


def _settled(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def matches(text: Column, pattern: str) -> Column:
    """The whole text matches (``\\z``, so a trailing line break does not pass)."""
    return _settled(text.rlike(pattern))


def whole_between(text: Column, low: int, high: int) -> Column:
    return _settled(text.try_cast("bigint").between(low, high))


def one_of(text: Column, codes: Sequence[str]) -> Column:
    return _settled(text.isin(*codes))


def measure_between(text: Column, limits: dict[str, tuple[int, int]]) -> Column:
    """A number followed by a unit, with limits that depend on the unit."""
    ok = F.lit(False)
    for unit, (low, high) in limits.items():
        number = F.regexp_extract(text, rf"^(\d+){unit}\z", 1)
        ok = ok | whole_between(F.nullif(number, F.lit("")), low, high)
    return ok


def has_keys(record: Column, required: Sequence[str]) -> Column:
    """A map holds every required key, by name."""
    wanted = F.array(*[F.lit(k) for k in required])
    return _settled(F.size(F.array_except(wanted, F.map_keys(record))) == 0)


def has_required_keys(record: Column) -> Column:
    return has_keys(record, [k for k in RECORD_KEYS if k not in OPTIONAL_KEYS])


def record_rules(record: Column) -> dict[str, Column]:
    """One rule per checked field."""
    rules = {k: whole_between(record[k], *limits) for k, limits in YEAR_LIMITS.items()}
    return rules | {
        "hgt": measure_between(record["hgt"], HEIGHT_LIMITS),
        "hcl": matches(record["hcl"], HAIR_COLOUR),
        "ecl": one_of(record["ecl"], EYE_COLOURS),
        "pid": matches(record["pid"], NINE_DIGITS),
    }


def all_pass(required: Column, rules: dict[str, Column]) -> Column:
    """Every rule holds; no rule is looked at where a key is missing."""
    verdict = F.lit(True)
    for rule in rules.values():
        verdict = verdict & rule
    return F.when(required, verdict).otherwise(F.lit(False))


def record_valid(record: Column) -> Column:
    return all_pass(has_required_keys(record), record_rules(record))
