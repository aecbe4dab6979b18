"""Coding expressions: demographic splits, categories and unknowns."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ratewell.schema import CODES


def combination_id(imd: Column, ethnicity: Column) -> Column:
    """1 both splits, 2 deprivation only, 3 ethnicity only, 4 neither; NULL if either is NULL."""
    everyone = CODES.all_persons
    by_imd, by_ethnicity = imd != everyone, ethnicity != everyone
    return (
        F.when(by_imd & by_ethnicity, 1)
        .when(by_imd & ~by_ethnicity, 2)
        .when(~by_imd & by_ethnicity, 3)
        .when(~by_imd & ~by_ethnicity, 4)
    )


def clean_ethnicity(c: Column) -> Column:
    """Unify the source variants of an NHS ethnic category code (fixed values)."""
    return (
        F.when(c.isNull() | (c == "9"), "99")
        .when(c == "A*", "A")
        .when(c == "ZZ", "Z")
        .otherwise(c)
    )


def age_band(age: Column) -> Column:
    """Five-year band label with 85+ on top and Unknown for NULL."""
    low = F.floor(age / 5) * 5
    closed = F.concat_ws("-", low.cast("string"), (low + 4).cast("string"))
    return (
        F.when(age.isNull(), "Unknown")
        .when(age >= 130, age.cast("string"))
        .when(age >= 85, "85+")
        .otherwise(closed)
    )


def default_unknown(c: Column) -> Column:
    """Empty or NULL text becomes the Unknown code."""
    return F.when(c.isNull() | (F.trim(c) == ""), str(CODES.unknown)).otherwise(c)


def recode(c: Column, mapping: dict[str, str], keep: bool = True) -> Column:
    """Replace the mapped values; others stay, or become NULL with ``keep=False``."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = F.try_element_at(table, c)
    return F.coalesce(hit, c) if keep else hit


def population_code(is_total: Column, code: Column) -> Column:
    """All-persons code for total rows, the looked-up code for the others."""
    return F.when(is_total, CODES.all_persons).otherwise(code)


def same_text(c: Column, value: str) -> Column:
    """Case- and padding-insensitive comparison with a constant."""
    return F.lower(F.trim(c)) == value.strip().lower()
