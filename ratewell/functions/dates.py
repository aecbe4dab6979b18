"""Reporting-period expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_LABELS = {1: "1 year", 3: "3 year pooled", 5: "5 year pooled"}


def duration_label(start: Column, end: Column) -> Column:
    """Label of a period ending on its 1-, 3- or 5-year anniversary or the day before."""
    label = F.lit(None).cast("string")
    for years in sorted(PERIOD_LABELS, reverse=True):
        anniversary = F.add_months(start, 12 * years)
        hit = (end == anniversary) | (end == F.date_sub(anniversary, 1))
        label = F.when(hit, F.lit(PERIOD_LABELS[years])).otherwise(label)
    return label


def fy_bounds(c: Column) -> tuple[Column, Column]:
    """First and last day of a financial year named ``YYYY-YY`` (or ``YYYY/YY``)."""
    start = F.concat(F.substring(c, 1, 4), F.lit("-04-01")).try_cast("date")
    end = F.concat(F.lit("20"), F.substring(c, -2, 2), F.lit("-03-31")).try_cast("date")
    return start, end


def fy_standardise(c: Column) -> Column:
    """``202122E4`` becomes ``2021-22``."""
    return F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 2))


def serial_to_date(c: Column) -> Column:
    """Spreadsheet serial number or ISO text to ``yyyy-MM-dd`` text; NULL when neither."""
    text = c.cast("string")
    days = F.floor(text.try_cast("double")).try_cast("int")
    from_serial = F.date_add(F.lit("1899-12-30").cast("date"), days)
    day = F.when(days.isNotNull(), from_serial).otherwise(text.try_cast("date"))
    return F.date_format(day, "yyyy-MM-dd")
