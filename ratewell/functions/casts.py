"""Casts that turn bad values into NULL instead of failing the query."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_int(c: Column) -> Column:
    """Integer part of a number or numeric text; ``'3.7'`` gives 3."""
    return c.try_cast("double").try_cast("int")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def to_date(c: Column) -> Column:
    return c.try_cast("date")


def coerce(c: Column, target: T.DataType) -> Column:
    """Lenient cast to one of the types of the fact layouts."""
    if isinstance(target, T.IntegerType):
        return to_int(c)
    return c.try_cast(target)


def instant(at: datetime) -> Column:
    """A timestamp constant; one without a zone is read in the zone of the session."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp")


def missing(c: Column) -> Column:
    """True for NULL and NaN."""
    return c.isNull() | F.isnan(c)


def finite(c: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)
