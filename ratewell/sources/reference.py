"""Reference tables: age groups and the load of dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratewell.operators.joins import local_table
from ratewell.operators.ranking import quantile_band
from ratewell.sources.sinks import overwrite_table

AGE_SCHEMA = (
    "age_code int, age_type string, min_age int, max_age int, "
    "age_group string, age_group_label string"
)


def age_groups(spark: SparkSession, ranges: dict[int, tuple[int, int, str]] | None = None) -> DataFrame:
    """Five-year bands 1..18 (85+ on top), all ages, and further named ranges."""
    rows = [
        (code, "5-year age group", 5 * code - 5, 5 * code - 1, f"{5 * code - 5}-{5 * code - 1}")
        for code in range(1, 18)
    ]
    rows.append((18, "5-year age group", 85, 120, "85+"))
    rows.append((999, "All", 0, 120, "All ages"))
    for code, (low, high, label) in (ranges or {}).items():
        rows.append((code, "Other", low, high, label))
    labelled = [(*r, r[4] if r[0] >= 19 else f"{r[4]} yrs") for r in rows]
    return local_table(spark, labelled, AGE_SCHEMA)


def ward_quintiles(wards: DataFrame) -> DataFrame:
    """Ward deprivation quintile: the highest score is in quintile 1."""
    banded = quantile_band(wards, "score", 5, invert=True, name="quintile")
    return banded.select("ward_code", "score", "quintile")


def load_reference(tables: dict[str, DataFrame], folder: str) -> None:
    """Replace every given dimension table."""
    for name, df in tables.items():
        overwrite_table(df, f"{folder}/{name}")
