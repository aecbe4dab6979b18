"""Coding of the census population and the age ranges of indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.functions import codes
from ratewell.operators.ranking import with_surrogate_id
from ratewell.schema import CODES, POPULATION_KEYS

FIVE_YEAR = "5-year age group"


def code_population(
    population: DataFrame,
    imd: DataFrame,
    ethnicity: DataFrame,
    sex: DataFrame,
    ages: DataFrame,
) -> DataFrame:
    """Distinct population rows with deprivation, age, ethnicity and sex codes."""
    quintiles = imd.select(F.col("imd_quintile").alias("__imd"), F.col("imd_code").alias("__imd_code"))
    groups = ethnicity.select("nhs_code", F.col("ethnicity_code").alias("__ethnicity_code"))
    sexes = sex.select("sex", F.col("sex_code").alias("__sex_code"))
    bands = ages.select(
        F.col("min_age").alias("start_age"), F.col("max_age").alias("end_age"),
        F.col("age_code").alias("__age_code"),
    )
    joined = (
        population.withColumn("__imd", F.substring(F.col("imd").cast("string"), 1, 1))
        .join(quintiles, "__imd", "left")
        .join(groups, "nhs_code", "left")
        .join(sexes, "sex", "left")
        .join(bands, ["start_age", "end_age"], "left")
    )
    everyone = F.lit("all")
    coded = {
        "imd_code": codes.population_code(F.lower("imd") == everyone, F.col("__imd_code")),
        "age_code": codes.population_code(F.lower("age_group") == everyone, F.col("__age_code")),
        "ethnicity_code": codes.population_code(
            F.lower("nhs_code") == everyone, F.col("__ethnicity_code")
        ),
        "sex_code": codes.population_code(F.col("sex_code") == 3, F.col("__sex_code")),
    }
    kept = [c for c in population.columns if c not in ("population_id", "nhs_code", "sex_code")]
    return joined.select(
        *kept, *[F.coalesce(c, F.lit(None)).cast("int").alias(name) for name, c in coded.items()]
    ).distinct()


def identified_population(coded: DataFrame, order: list[str]) -> DataFrame:
    """Coded population with a dense ``population_id``."""
    return with_surrogate_id(coded, order)


def unmatched_population(
    facts: DataFrame, population: DataFrame, exclude: tuple[int, ...] = (999, -99, 17)
) -> DataFrame:
    """Distinct fact groups without a population count, some ethnicities left out."""
    counted = (
        population.filter(F.col("observation").isNotNull())
        .withColumnRenamed("age_code", "age_group_code")
        .select(POPULATION_KEYS)
        .distinct()
    )
    wanted = facts.filter(~F.col("ethnicity_code").isin(list(exclude)))
    return (
        wanted.select("start_date", "numerator", *POPULATION_KEYS)
        .distinct()
        .join(counted, POPULATION_KEYS, "left_anti")
    )


def age_metadata(metadata: DataFrame, ages: DataFrame, value_types: DataFrame) -> DataFrame:
    """Single age code and age-code range of every indicator.

    Standardised indicators span five-year bands: all of 1..18 for all ages, else the bands that
    start at the lowest and end at the highest age.  Others use their single code at both ends.
    """
    labels = ages.select(
        F.col("age_group_label").alias("age"), "age_group_label",
        F.col("age_code").alias("single_age_code"), "min_age", "max_age",
    )
    bands = ages.filter(F.col("age_type") == FIVE_YEAR)
    lowest = bands.groupBy("min_age").agg(F.min("age_code").alias("__low"))
    highest = bands.groupBy("max_age").agg(F.min("age_code").alias("__high"))
    types = value_types.groupBy("value_type").agg(F.min("value_type_code").alias("value_type_code"))
    base = (
        metadata.filter(F.col("indicator_id").isNotNull())
        .join(labels, "age", "left")
        .select(
            "indicator_id", "age", "age_group_label", "single_age_code", "min_age", "max_age",
            "value_type", "status_code",
        )
        .distinct()
        .join(types, "value_type", "left")
        .join(lowest, "min_age", "left")
        .join(highest, "max_age", "left")
    )
    single = F.col("single_age_code")
    standardised = F.col("value_type_code") == CODES.dasr
    all_ages = standardised & (single == CODES.all_persons)
    banded = standardised & (single != CODES.all_persons)
    plain = F.col("value_type_code") != CODES.dasr
    low = F.when(all_ages, 1).when(banded, F.col("__low")).when(plain, single)
    open_top = F.when(F.col("max_age") == 120, CODES.oldest_band)
    high = (
        F.when(all_ages, CODES.oldest_band)
        .when(banded, F.coalesce("__high", open_top))
        .when(plain, single)
    )
    return base.select(
        "indicator_id", "age_group_label", "single_age_code", "min_age", "max_age",
        low.alias("min_age_code"), high.alias("max_age_code"),
        "value_type", "value_type_code", "status_code",
    )
