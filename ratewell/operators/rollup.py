"""Geography rollups, demographic splits and person counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions import codes
from ratewell.operators.joins import spread_join
from ratewell.schema import CODES, GEOGRAPHY, POPULATION_KEYS, Geography

PCN, LOCALITY, AUTHORITY, ICB, WARD = "pcn", "locality", "la", "icb", "ward"
REGISTERED_LEVELS = (PCN, LOCALITY, AUTHORITY, ICB)
RESIDENT_LEVELS = (WARD, LOCALITY, AUTHORITY, ICB)

MEASURES = ("numerator", "denominator")


def _sum_levels(
    df: DataFrame, areas: dict[str, Column], keys: list[str], measures: tuple[str, ...]
) -> DataFrame:
    """Totals per level and area in one pass: each row counts once on every level it has.

    ``areas`` gives the area of a row per level; NULL means the row has none on that level.  The
    rows are summed to the finest areas first, so the repetition works on totals.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    columns = {level: f"__{level}" for level in areas}
    placed = df.withColumns({columns[level]: area.cast("string") for level, area in areas.items()})
    finest = placed.groupBy(*keys, *columns.values()).agg(*sums)
    options = [
        F.struct(F.lit(level).alias("level"), F.col(column).alias("area"))
        for level, column in columns.items()
    ]
    return (
        finest.withColumn("__area", F.explode(F.array(*options)))
        .select(*keys, "__area.*", *measures)
        .filter(F.col("area").isNotNull())
        .groupBy("level", "area", *keys)
        .agg(*sums)
    )


def rollup_registered(
    df: DataFrame,
    keys: list[str],
    levels: tuple[str, ...] = REGISTERED_LEVELS,
    measures: tuple[str, ...] = MEASURES,
    geography: Geography = GEOGRAPHY,
) -> DataFrame:
    """Practice rows to network, locality, local authority and the whole system.

    ``df`` carries ``pcn_code`` and ``locality``.  Closed networks and rows without a locality are
    left out on their level only.
    """
    known = F.when(
        ~codes.same_text(F.col("locality"), geography.not_a_locality), F.col("locality")
    )
    areas = {
        PCN: F.when(
            ~codes.same_text(F.col("pcn_code"), geography.closed_practice), F.col("pcn_code")
        ),
        LOCALITY: known,
        AUTHORITY: codes.recode(known, geography.localities, keep=False),
        ICB: F.lit(geography.icb_code),
    }
    return _sum_levels(df, {level: areas[level] for level in levels}, keys, measures)


def rollup_resident(
    df: DataFrame,
    keys: list[str],
    levels: tuple[str, ...] = RESIDENT_LEVELS,
    measures: tuple[str, ...] = ("numerator",),
    outside: str | None = None,
    geography: Geography = GEOGRAPHY,
) -> DataFrame:
    """Event rows to ward, locality, local authority and the whole system of residence.

    Rows whose locality is labelled ``outside`` are left out on the locality level.
    """
    locality = F.col("locality")
    if outside:
        locality = F.when(~codes.same_text(locality, outside), locality)
    areas = {
        WARD: F.col("ward_code"),
        LOCALITY: locality,
        AUTHORITY: F.col("lad_code"),
        ICB: F.lit(geography.icb_code),
    }
    return _sum_levels(df, {level: areas[level] for level in levels}, keys, measures)


def split_sets(
    df: DataFrame,
    keys: list[str],
    dims: tuple[str, ...] = ("imd_code", "ethnicity_code"),
    measures: tuple[str, ...] = MEASURES,
) -> DataFrame:
    """Totals for every combination of kept and collapsed dimensions.

    A collapsed dimension reads 999; a real NULL stays NULL.  Rows are summed to the finest split
    and placed by ``keys`` (a key then holds one row per category pair at most), so the repeated
    rows are summed without another shuffle.
    """
    sums = [F.sum(m).alias(m) for m in measures]
    finest = df.groupBy(*keys, *dims).agg(*sums).repartition(*keys)
    options = [
        F.struct(
            F.lit(mask).alias("split"),
            *[
                (F.lit(CODES.all_persons) if mask >> i & 1 else F.col(d)).alias(d)
                for i, d in enumerate(dims)
            ],
        )
        for mask in range(2 ** len(dims))
    ]
    return (
        finest.withColumn("__split", F.explode(F.array(*options)))
        .select(*keys, "__split.*", *measures)
        .groupBy(*keys, "split", *dims)
        .agg(*sums)
        .drop("split")
    )


def person_counts(df: DataFrame, keys: list[str], person: str, name: str = "numerator") -> DataFrame:
    """Distinct persons per group."""
    people = df.select(*keys, person).distinct()
    return people.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(name))


def combine_num_den(numerators: DataFrame, denominators: DataFrame, keys: list[str]) -> DataFrame:
    """Every denominator group with its numerator, 0 where there were no events.

    Groups with NULL keys match each other.  Both sides are stacked and summed, which takes one
    shuffle of the groups instead of a join's two.
    """
    stacked = denominators.select(*keys, "denominator", F.lit(True).alias("__den")).unionByName(
        numerators.select(*keys, "numerator"), allowMissingColumns=True
    )
    summed = stacked.groupBy(*keys).agg(
        F.coalesce(F.sum("numerator"), F.lit(0.0)).alias("numerator"),
        F.sum("denominator").alias("denominator"),
        F.max("__den").alias("__den"),
    )
    return summed.filter("__den").drop("__den")


def population_totals(population: DataFrame) -> DataFrame:
    """Coded population summed to the keys of the fact table."""
    return (
        population.withColumnRenamed("age_code", "age_group_code")
        .groupBy(*POPULATION_KEYS)
        .agg(F.sum("observation").cast("double").alias("population"))
    )


def attach_population(df: DataFrame, population: DataFrame) -> DataFrame:
    """Fill missing denominators from the coded population."""
    totals = population_totals(population)
    joined = spread_join(df, totals, POPULATION_KEYS)
    return joined.withColumn("denominator", F.coalesce("denominator", "population")).select(df.columns)


def filter_age_range(df: DataFrame, age_metadata: DataFrame) -> DataFrame:
    """Rows whose age code lies in the range of their indicator; without a range all stay."""
    ranges = age_metadata.groupBy("indicator_id").agg(
        F.min("min_age_code").alias("__low"), F.max("max_age_code").alias("__high")
    )
    joined = spread_join(df, ranges, ["indicator_id"])
    inside = F.col("age_group_code").between(F.col("__low"), F.col("__high"))
    return joined.filter(F.coalesce(inside, F.lit(True))).select(df.columns)
