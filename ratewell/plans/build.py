"""Building coded landing facts from practice, episode and patient-level sources."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions import casts, codes, dates
from ratewell.operators import lookup, select
from ratewell.operators.rollup import (
    AUTHORITY,
    ICB,
    LOCALITY,
    PCN,
    WARD,
    rollup_registered,
    rollup_resident,
    split_sets,
)
from ratewell.operators.sets import union_by_name
from ratewell.schema import CODES, FACT_SCHEMA, GEOGRAPHY, SELF_HARM_CODES, Geography

REGISTERED_TYPES = {
    "PCN": PCN,
    "ICB": ICB,
    "Local Authority (registered)": AUTHORITY,
    "Locality (registered)": LOCALITY,
}
RESIDENT_TYPES = {
    "Ward": WARD,
    "ICB": ICB,
    "Local Authority (resident)": AUTHORITY,
    "Locality (resident)": LOCALITY,
}


@dataclass(frozen=True)
class Indicator:
    """What every row of one indicator is stamped with."""

    indicator_id: int
    value_type_code: int
    creation_date: datetime
    source_code: int = CODES.warehouse_source


def area_ids(geography: DataFrame, types: dict[str, str]) -> DataFrame:
    """Id of each (level, area): localities by label, the other levels by code."""
    level = codes.recode(F.col("aggregation_type"), types, keep=False)
    area = F.when(level == LOCALITY, F.col("aggregation_label")).otherwise(F.col("aggregation_code"))
    return (
        geography.filter(F.col("aggregation_type").isin(list(types)))
        .groupBy(level.alias("level"), area.alias("area"))
        .agg(F.min("aggregation_id").alias("aggregation_id"))
    )


def as_facts(df: DataFrame, indicator: Indicator) -> DataFrame:
    """Stamped rows in the landing layout."""
    stamped = select.stamp(df, **asdict(indicator))
    return stamped.select([casts.coerce(F.col(f.name), f.dataType).alias(f.name) for f in FACT_SCHEMA])


def practice_rows(
    register: DataFrame,
    practices: DataFrame,
    dates_table: DataFrame,
    system: str,
    indicator_code: str,
    geography: Geography = GEOGRAPHY,
) -> DataFrame:
    """Distinct practice counts of one register with dates and practice geography."""
    wanted = register.filter(
        (F.col("indicator_code") == indicator_code) & F.col("numerator").isNotNull()
    )
    placed = select.filter_practices(
        lookup.with_practice(wanted, practices), system, geography=geography, drop_closed=False
    )
    return lookup.with_fy_dates(placed, dates_table).select(
        "start_date", "end_date", "practice_code", "pcn_code", "locality",
        "numerator", "denominator",
    ).distinct()


def given_denominator(
    register: DataFrame,
    practices: DataFrame,
    dates_table: DataFrame,
    geography_table: DataFrame,
    system: str,
    indicator_code: str,
    indicator: Indicator,
    geography: Geography = GEOGRAPHY,
) -> DataFrame:
    """Facts of a practice register that comes with its denominator."""
    rows = practice_rows(register, practices, dates_table, system, indicator_code, geography)
    rolled = rollup_registered(rows, ["start_date", "end_date"], geography=geography)
    coded = rolled.join(area_ids(geography_table, REGISTERED_TYPES), ["level", "area"], "left")
    everyone = ["imd_code", "age_group_code", "sex_code", "ethnicity_code"]
    return as_facts(select.stamp_all_persons(coded, everyone), indicator)


def cohort(
    episodes: DataFrame, places: DataFrame, first_month: int, last_month: int, areas: list[str]
) -> DataFrame:
    """Episodes in the period whose patient lives in one of the areas."""
    in_time, in_place = select.in_period(
        F.col("reconciliation_month"), first_month, last_month, F.col("area_code"), areas
    )
    residents = places.filter(in_place).select("episode_id").distinct()
    return episodes.filter(in_time).select("episode_id", "historic").join(
        residents, "episode_id", "left_semi"
    )


def numerator_events(
    members: DataFrame,
    extracts: list[tuple[int, DataFrame, DataFrame]],
    diagnosis_codes: list[str] = SELF_HARM_CODES,
) -> DataFrame:
    """One row per cohort episode with a listed diagnosis, from every extract.

    An extract is (historic flag, episodes, diagnoses).  All inputs meet on the episode id.
    """
    found = []
    for historic, episodes, diagnoses in extracts:
        episode, diagnosis = select.coded_events(
            F.col("admission_method"), F.col("order_in_spell"), F.col("diagnosis_code"),
            diagnosis_codes,
        )
        coded = diagnoses.filter(diagnosis).select("episode_id").distinct()
        admitted = episodes.filter(episode).select("episode_id").distinct()
        found.append(
            members.filter(F.col("historic") == historic)
            .join(coded, "episode_id", "left_semi")
            .join(admitted, "episode_id", "left_semi")
        )
    return union_by_name(*found).distinct()


def with_episode_details(
    events: DataFrame,
    extracts: list[tuple[int, DataFrame]],
    demographic: DataFrame,
    dates_table: DataFrame,
) -> DataFrame:
    """Month, year, age and cleaned ethnicity of each event.

    Every extract (historic flag, episodes) details its own events.  The local demographic table
    comes first for ethnicity; what is left is filled from the current extract (flag 0).  The
    extracts are brought to one row per episode together, so the events meet them in one join.
    """
    own = ["person_id", "age", "reconciliation_month"]
    every = union_by_name(
        *[
            episodes.select("episode_id", *own, "ethnic_category", F.lit(flag).alias("__flag"))
            for flag, episodes in extracts
        ]
    )
    raw = F.min(F.when(F.col("__flag") == 0, F.col("ethnic_category"))).alias("__raw")
    details = every.groupBy("episode_id").agg(
        raw,
        *[
            F.min(F.when(F.col("__flag") == flag, F.col(c))).alias(f"__{c}_{flag}")
            for c in own
            for flag, _ in extracts
        ],
    )
    joined = events.join(details, "episode_id", "left")
    detailed = joined.select(
        "episode_id",
        "historic",
        *[
            F.coalesce(
                *[F.when(F.col("historic") == flag, F.col(f"__{c}_{flag}")) for flag, _ in extracts]
            ).alias("time_period" if c == "reconciliation_month" else c)
            for c in own
        ],
        F.lit(None).cast("string").alias("ethnicity"),
        "__raw",
    )
    return _described(detailed, demographic, dates_table)


def _described(detailed: DataFrame, demographic: DataFrame, dates_table: DataFrame) -> DataFrame:
    """Ethnicity, local before the extract's own, and financial year of detailed events."""
    known = lookup.fill_from(
        detailed, [(demographic, None)], ["person_id"], {"ethnicity": "ethnic_code"}, crowded=True
    )
    cleaned = known.withColumn(
        "ethnicity", codes.clean_ethnicity(F.coalesce("ethnicity", "__raw"))
    ).drop("__raw")
    return lookup.with_financial_year(cleaned, dates_table)


def with_places(events: DataFrame, places: DataFrame) -> DataFrame:
    """Small area of each event: 2021 from the current extract, 2011 from the historic one.

    A current event without a 2021 area has none; a historic event gets one by best fit.
    """
    unknown = F.lit(None).cast("string")
    placed = lookup.fill_from(
        events.withColumns({"lsoa_2021": unknown, "lsoa_2011": unknown}), [(places, None)], ["episode_id"],
        {"lsoa_2021": "lsoa_2021", "lsoa_2011": "lsoa_2011"},
    )
    own = {"lsoa_2021": 0, "lsoa_2011": 1}
    return placed.withColumns({c: F.when(F.col("historic") == flag, F.col(c)) for c, flag in own.items()})


def episode_events(
    episodes: DataFrame,
    diagnoses: DataFrame,
    places: DataFrame,
    demographic: DataFrame,
    dates_table: DataFrame,
    first_month: int,
    last_month: int,
    areas: list[str],
    diagnosis_codes: list[str] = SELF_HARM_CODES,
) -> DataFrame:
    """The events of ``cohort`` and ``numerator_events`` with details and small areas, in one aggregation.

    All that the sources know of an episode is brought together by its id at once, so the id is shuffled
    once, not for each of the steps.  ``episodes`` holds all extracts, told apart by ``historic`` (0 or 1).
    """
    own = ["person_id", "age", "reconciliation_month"]
    in_time, in_place = select.in_period(
        F.col("reconciliation_month"), first_month, last_month, F.col("area_code"), areas
    )
    admitted, coded = select.coded_events(
        F.col("admission_method"), F.col("order_in_spell"), F.col("diagnosis_code"), diagnosis_codes
    )
    known = [
        episodes.select(
            "episode_id", "historic", *own, "ethnic_category", in_time.alias("__timed"), admitted.alias("__admitted")
        ),
        diagnoses.filter(coded).select("episode_id", F.lit(True).alias("__coded")),
        places.select("episode_id", in_place.alias("__resident"), "lsoa_2021", "lsoa_2011"),
    ]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), known)
    of = {flag: F.col("historic") == flag for flag in (0, 1)}
    profile = stacked.filter(F.col("episode_id").isNotNull()).groupBy("episode_id").agg(
        *[F.max(F.col(c)).alias(c) for c in ("__coded", "__resident")],
        *[F.min(c).alias(c) for c in ("lsoa_2021", "lsoa_2011")],
        F.min(F.when(of[0], F.col("ethnic_category"))).alias("__raw"),
        *[F.max(of[flag] & F.col(c)).alias(f"{c}_{flag}") for flag in of for c in ("__timed", "__admitted")],
        *[F.min(F.when(of[flag], F.col(c))).alias(f"__{c}_{flag}") for flag in of for c in own],
    )
    found = [
        F.when(
            F.col(f"__timed_{flag}") & F.col(f"__admitted_{flag}"),
            F.struct(
                F.lit(flag).alias("historic"),
                *[F.col(f"__{c}_{flag}").alias("time_period" if c == "reconciliation_month" else c) for c in own],
                *[
                    (F.col(c) if flag == place else F.lit(None).cast("string")).alias(c)
                    for c, place in (("lsoa_2021", 0), ("lsoa_2011", 1))
                ],
            ),
        )
        for flag in of
    ]
    events = profile.filter(F.col("__coded") & F.col("__resident")).select(
        "episode_id", "__raw", F.inline(F.array_compact(F.array(*found)))
    )
    return _described(events.withColumn("ethnicity", F.lit(None).cast("string")), demographic, dates_table)


def census_denominator(
    located: DataFrame,
    small_areas: dict[str, DataFrame],
    footprint: DataFrame,
    ages: DataFrame,
    ethnicities: DataFrame,
    geography_table: DataFrame,
    indicator: Indicator,
    outside: str | None = None,
    geography: Geography = GEOGRAPHY,
) -> DataFrame:
    """Facts of events with their small areas by place of residence; the denominator comes at staging.

    ``located`` comes from ``episode_events``, or step by step from ``with_places``; ``small_areas`` are the
    lookups of ``with_small_area`` by argument name.
    """
    placed = lookup.keep_footprint(lookup.with_small_area(located, **small_areas), footprint)
    start, end = dates.fy_bounds(F.col("financial_year"))
    coded = lookup.with_age_codes(placed, ages)
    coded = lookup.map_codes(coded, ethnicities, "ethnicity", "nhs_code", "ethnicity_code")
    rows = coded.select(
        start.alias("start_date"),
        end.alias("end_date"),
        casts.to_int(F.col("age")).alias("age_group_code"),
        F.col("imd").alias("imd_code"),
        casts.to_int(F.col("ethnicity")).alias("ethnicity_code"),
        "ward_code", "locality", "lad_code",
        F.lit(1.0).alias("numerator"),
    )
    keys = ["start_date", "end_date", "age_group_code", "imd_code", "ethnicity_code"]
    rolled = rollup_resident(rows, keys, outside=outside, geography=geography)
    ids = area_ids(geography_table, RESIDENT_TYPES)
    whole = F.when(F.col("level") == ICB, geography.icb_aggregation_id)
    with_ids = rolled.join(ids, ["level", "area"], "left").withColumn(
        "aggregation_id", F.coalesce(whole, "aggregation_id")
    )
    split = split_sets(
        with_ids, ["start_date", "end_date", "age_group_code", "aggregation_id"],
        measures=("numerator",),
    )
    open_denominator = split.withColumn("denominator", F.lit(None).cast("double"))
    return as_facts(select.stamp_all_persons(open_denominator, ["sex_code"]), indicator)


AUDIT_KEYS = ["financial_year", "imd_quintile", "age", "sex", "ethnicity", "practice_code"]


def audit_counts(
    audit: DataFrame, demographic: DataFrame, eligible: Column, met: Column
) -> DataFrame:
    """Distinct eligible patients per audit group, and those of them who meet a condition.

    One pass for both counts.  The local ethnicity replaces the source's before patients are
    counted, so a patient with two source codes counts once.
    """
    reached = F.max(F.coalesce(met, F.lit(False))).alias("__met")
    people = audit.filter(eligible).groupBy(*AUDIT_KEYS, "person_id").agg(reached)
    known = lookup.update_from(people, demographic, ["person_id"], "ethnicity", "ethnic_code")
    patients = known.groupBy(*AUDIT_KEYS, "person_id").agg(F.max("__met").alias("__met"))
    return patients.groupBy(*AUDIT_KEYS).agg(
        F.count_if("__met").cast("double").alias("numerator"),
        F.count(F.lit(1)).cast("double").alias("denominator"),
    )


def derived_denominator(
    audit: DataFrame,
    eligible: Column,
    met: Column,
    demographic: DataFrame,
    practices: DataFrame,
    imd: DataFrame,
    ethnicities: DataFrame,
    geography_table: DataFrame,
    system: str,
    indicator: Indicator,
    geography: Geography = GEOGRAPHY,
) -> DataFrame:
    """Facts of patient-level rows: ``met`` among ``eligible`` patients."""
    counted = audit_counts(audit, demographic, eligible, met)
    coded = lookup.map_codes(counted, ethnicities, "ethnicity", "nhs_code", "ethnicity_code")
    coded = lookup.map_codes(coded, imd, "imd_quintile", "imd_quintile", "imd_code")
    coded = select.default_unknown(coded, ["ethnicity", "imd_quintile"])
    start, end = dates.fy_bounds(dates.fy_standardise(F.col("financial_year")))
    placed = select.filter_practices(
        lookup.with_practice(coded, practices), system, size=None, geography=geography
    )
    rows = placed.select(
        start.alias("start_date"),
        end.alias("end_date"),
        casts.to_int(F.col("imd_quintile")).alias("imd_code"),
        casts.to_int(F.col("ethnicity")).alias("ethnicity_code"),
        "pcn_code", "locality", "numerator", "denominator",
    )
    rolled = rollup_registered(
        rows, ["start_date", "end_date", "imd_code", "ethnicity_code"], geography=geography
    )
    ids = area_ids(geography_table, REGISTERED_TYPES)
    with_ids = rolled.join(ids, ["level", "area"], "left")
    split = split_sets(with_ids, ["start_date", "end_date", "aggregation_id"])
    return as_facts(
        select.stamp_all_persons(split, ["age_group_code", "sex_code"]), indicator
    )
