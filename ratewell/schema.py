"""Column layouts and coded values shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Fixed values down to METADATA_COLS: column layouts and grouping keys that must match.
FACT_SCHEMA = T.StructType(
    [
        T.StructField("indicator_id", T.IntegerType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("numerator", T.DoubleType()),
        T.StructField("denominator", T.DoubleType()),
        T.StructField("indicator_value", T.DoubleType()),
        T.StructField("lower_ci95", T.DoubleType()),
        T.StructField("upper_ci95", T.DoubleType()),
        T.StructField("imd_code", T.IntegerType()),
        T.StructField("aggregation_id", T.IntegerType()),
        T.StructField("age_group_code", T.IntegerType()),
        T.StructField("sex_code", T.IntegerType()),
        T.StructField("ethnicity_code", T.IntegerType()),
        T.StructField("creation_date", T.TimestampType()),
        T.StructField("value_type_code", T.IntegerType()),
        T.StructField("source_code", T.IntegerType()),
    ]
)
FACT_COLS = FACT_SCHEMA.fieldNames()

TIDY_SCHEMA = T.StructType(
    FACT_SCHEMA.fields
    + [
        T.StructField("time_period_type", T.StringType()),
        T.StructField("combination_id", T.IntegerType()),
    ]
)
TIDY_COLS = TIDY_SCHEMA.fieldNames()

PROCESSED_SCHEMA = T.StructType(
    FACT_SCHEMA.fields
    + [
        T.StructField("insertion_date_time", T.TimestampType()),
        T.StructField("time_period_type", T.StringType()),
        T.StructField("combination_id", T.IntegerType()),
    ]
)

FLOAT_COLS = ["numerator", "denominator", "indicator_value", "lower_ci95", "upper_ci95"]
RESULT_COLS = ["indicator_value", "lower_ci95", "upper_ci95"]

# Grouping columns for pooling years, and for one age-standardised rate (no age).
POOL_KEYS = [
    "indicator_id", "imd_code", "aggregation_id", "age_group_code", "sex_code",
    "ethnicity_code", "creation_date", "value_type_code", "source_code", "combination_id",
]
DASR_KEYS = [
    "indicator_id", "start_date", "end_date", "imd_code", "aggregation_id", "sex_code",
    "ethnicity_code", "creation_date", "value_type_code", "source_code",
    "time_period_type", "combination_id",
]
DUPLICATE_KEYS = [
    "indicator_id", "time_period_type", "aggregation_id", "start_date", "end_date",
    "imd_code", "ethnicity_code",
]
POPULATION_KEYS = ["aggregation_id", "age_group_code", "ethnicity_code", "imd_code", "sex_code"]
METADATA_COLS = [
    "indicator_id", "age", "year_type", "multiplier", "status_code", "population_type",
]


@dataclass(frozen=True)
class Codes:
    """Coded values of the indicator model (fixed values)."""

    all_persons: int = 999
    unknown: int = -99
    percentage: int = 2
    crude_rate: int = 3
    dasr: int = 4
    ratio: int = 7
    oldest_band: int = 18
    eligible_status: tuple[int, ...] = (1, 2)
    active_status: int = 1
    warehouse_source: int = 1
    census: str = "Census"
    pooled_year_types: tuple[str, ...] = ("Calendar", "Financial")


CODES = Codes()


@dataclass(frozen=True)
class Geography:
    """Area constants of the registered and resident hierarchies (fixed values)."""

    icb_code: str = "E38000258"
    icb_aggregation_id: int = 151
    localities: dict[str, str] = field(
        default_factory=lambda: {
            "North": "E08000025",
            "East": "E08000025",
            "West": "E08000025",
            "Central": "E08000025",
            "South": "E08000025",
            "Solihull": "E08000029",
        }
    )
    not_a_locality: str = "Not applicable"
    closed_practice: str = "Closed practice"
    excluded_practices: tuple[str, ...] = ("M88006",)

    @property
    def authorities(self) -> list[str]:
        return sorted(set(self.localities.values()))


GEOGRAPHY = Geography()

# 2013 European Standard Population, age codes 1..18 with 85+ merged (fixed values).
ESP2013 = [
    5000, 5500, 5500, 5500, 6000, 6000, 6500, 7000, 7000,
    7000, 7000, 6500, 6000, 5500, 5000, 4000, 2500, 2500,
]

# Intentional self-harm, three-character diagnosis codes; X65 is not in the list (fixed values).
SELF_HARM_CODES = [f"X{n}" for n in range(60, 85) if n != 65]
