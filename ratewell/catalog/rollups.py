"""Queries over rollups, splits, person counts and the three indicator builds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewell.catalog import enrichment
from ratewell.catalog.registry import FACT_SPEC, query
from ratewell.catalog.tables import CTES, LOADED, OUTSIDE, SYSTEM, Tables, case
from ratewell.operators import lookup, rollup
from ratewell.plans import build
from ratewell.schema import GEOGRAPHY

_AUTHORITY = case("locality", GEOGRAPHY.localities, "NULL")
_SUMS = "sum(numerator) AS numerator, sum(denominator) AS denominator"

CTES.update(
    {
        "practice_rows": (
            "register practices dates",
            "SELECT DISTINCT y.start_date, y.end_date, r.practice_code, pcn_code, locality, numerator, denominator "
            "FROM register r JOIN practices p USING (practice_code) JOIN "
            "(SELECT DISTINCT financial_year_name, start_date, end_date FROM dates) y "
            "ON r.financial_year = y.financial_year_name WHERE lower(system) = 'home' "
            "AND r.indicator_code = 'A' AND numerator IS NOT NULL AND r.practice_code <> 'M88006'",
        ),
        "registered": (
            "practice_rows",
            f"SELECT 'pcn' AS level, pcn_code AS area, start_date, end_date, {_SUMS} FROM practice_rows "
            "WHERE lower(pcn_code) <> 'closed practice' GROUP BY ALL "
            f"UNION ALL SELECT 'locality', locality, start_date, end_date, {_SUMS} FROM practice_rows "
            "WHERE locality <> 'Not applicable' GROUP BY ALL "
            f"UNION ALL SELECT 'la', {_AUTHORITY} AS la, start_date, end_date, {_SUMS} FROM practice_rows "
            f"WHERE {_AUTHORITY} IS NOT NULL GROUP BY ALL "
            f"UNION ALL SELECT 'icb', '{GEOGRAPHY.icb_code}', start_date, end_date, {_SUMS} FROM practice_rows GROUP BY ALL",
        ),
        "registered_ids": (
            "geography",
            "SELECT CASE aggregation_type WHEN 'PCN' THEN 'pcn' WHEN 'ICB' THEN 'icb' "
            "WHEN 'Locality (registered)' THEN 'locality' ELSE 'la' END AS level, "
            "CASE aggregation_type WHEN 'Locality (registered)' THEN aggregation_label ELSE aggregation_code END AS area, "
            "aggregation_id FROM geography WHERE aggregation_type IN "
            "('PCN', 'ICB', 'Local Authority (registered)', 'Locality (registered)')",
        ),
        "resident_ids": (
            "geography",
            "SELECT CASE aggregation_type WHEN 'Ward' THEN 'ward' WHEN 'ICB' THEN 'icb' "
            "WHEN 'Locality (resident)' THEN 'locality' ELSE 'la' END AS level, "
            "CASE aggregation_type WHEN 'Locality (resident)' THEN aggregation_label ELSE aggregation_code END AS area, "
            "aggregation_id FROM geography WHERE aggregation_type IN "
            "('Ward', 'ICB', 'Local Authority (resident)', 'Locality (resident)')",
        ),
        "resident_rows": (
            "located ages ethnicities",
            "SELECT make_date(CAST(substring(financial_year, 1, 4) AS INT), 4, 1) AS start_date, "
            "make_date(2000 + CAST(right(financial_year, 2) AS INT), 3, 31) AS end_date, "
            "TRY_CAST(coalesce(CAST(age_code AS VARCHAR), age_text) AS INT) AS age_group_code, imd AS imd_code, "
            "TRY_CAST(coalesce(CAST(ethnicity_code AS VARCHAR), ethnicity) AS INT) AS ethnicity_code, "
            "ward_code, lad_code, locality FROM (SELECT *, CASE WHEN age IS NULL THEN 'Unknown' WHEN age >= 85 THEN '85+' "
            "ELSE (age // 5 * 5) || '-' || (age // 5 * 5 + 4) END AS age_text FROM located) "
            "LEFT JOIN (SELECT age_group, min(age_code) AS age_code FROM ages GROUP BY age_group) ON age_text = age_group "
            "LEFT JOIN ethnicities ON ethnicity = nhs_code",
        ),
        "resident": (
            "resident_rows",
            " UNION ALL ".join(
                f"SELECT '{level}' AS level, {area} AS area, start_date, end_date, age_group_code, imd_code, "
                f"ethnicity_code, CAST(count(*) AS DOUBLE) AS numerator FROM resident_rows WHERE {keep} GROUP BY ALL"
                for level, area, keep in (
                    ("ward", "ward_code", "ward_code IS NOT NULL"),
                    ("locality", "locality", f"locality <> '{OUTSIDE}'"),
                    ("la", "lad_code", "lad_code IS NOT NULL"),
                    ("icb", f"'{GEOGRAPHY.icb_code}'", "TRUE"),
                )
            ),
        ),
        "audit_people": (
            "audit demographic",
            "SELECT DISTINCT financial_year, imd_quintile, age, sex, "
            "CASE WHEN d.person_id IS NOT NULL THEN ethnic_code ELSE ethnicity END AS ethnicity, practice_code, "
            "a.person_id, complete FROM audit a LEFT JOIN demographic d ON a.person_id = d.person_id "
            "WHERE condition IN ('1-URGENT', '2-HIGH')",
        ),
        "audit_combined": (
            "audit_people",
            "SELECT financial_year, imd_quintile, age, sex, ethnicity, practice_code, "
            "CAST(count(DISTINCT CASE WHEN complete = 1 THEN person_id END) AS DOUBLE) AS numerator, "
            "CAST(count(DISTINCT person_id) AS DOUBLE) AS denominator FROM audit_people GROUP BY ALL",
        ),
    }
)


def practice_rows(t: Tables):
    return build.practice_rows(t.register(), t.practices(), t.dates(), SYSTEM, "A")


def _level(name: str):
    """Register the rollup of practice rows to one level."""

    def rolled(t):
        return rollup.rollup_registered(practice_rows(t), ["start_date", "end_date"], (name,))

    rolled.__name__ = f"rollup_{name}"
    query(
        "area:t start_date:d end_date:d numerator:n denominator:n",
        f"SELECT * FROM registered WHERE level = '{name}'",
        "registered",
    )(rolled)


for _name in rollup.REGISTERED_LEVELS:
    _level(_name)


@query(
    "level:t area:t start_date:d end_date:d numerator:n denominator:n",
    "SELECT * FROM registered",
    "registered",
)
def rollup_all_registered(t):
    return rollup.rollup_registered(practice_rows(t), ["start_date", "end_date"])


@query(
    "level:t area:t historic:i financial_year:t numerator:n",
    " UNION ALL ".join(
        f"SELECT '{level}' AS level, {area} AS area, historic, financial_year, count(*) AS numerator "
        f"FROM located WHERE {keep} GROUP BY ALL"
        for level, area, keep in (
            ("ward", "ward_code", "TRUE"),
            ("locality", "locality", f"locality <> '{OUTSIDE}'"),
            ("la", "lad_code", "TRUE"),
            ("icb", f"'{GEOGRAPHY.icb_code}'", "TRUE"),
        )
    ),
    "located",
)
def rollup_all_resident(t):
    rows = lookup.keep_footprint(enrichment.located(t), t.footprint())
    counted = rows.withColumn("numerator", F.lit(1.0))
    return rollup.rollup_resident(counted, ["historic", "financial_year"], outside=OUTSIDE)


@query(
    "indicator_id:i start_date:d aggregation_id:i imd_code:i ethnicity_code:i numerator:n denominator:n",
    " UNION ALL ".join(
        f"SELECT indicator_id, start_date, aggregation_id, {imd} AS imd_code, {ethnicity} AS ethnicity_code, "
        f"{_SUMS} FROM facts GROUP BY indicator_id, start_date, aggregation_id{keys}"
        for imd, ethnicity, keys in (
            ("imd_code", "ethnicity_code", ", imd_code, ethnicity_code"),
            ("imd_code", "999", ", imd_code"),
            ("999", "ethnicity_code", ", ethnicity_code"),
            ("999", "999", ""),
        )
    ),
    "facts",
)
def split_totals(t):
    return rollup.split_sets(t.facts(), ["indicator_id", "start_date", "aggregation_id"])


@query(
    "practice_code:t financial_year:t numerator:n",
    "SELECT practice_code, financial_year, count(DISTINCT person_id) AS numerator FROM audit "
    "WHERE complete = 1 GROUP BY ALL",
    "audit",
)
def distinct_patients(t):
    return rollup.person_counts(t.audit().filter("complete = 1"), ["practice_code", "financial_year"], "person_id")


@query(
    "financial_year:t imd_quintile:t age:i sex:i ethnicity:t practice_code:t numerator:n denominator:n",
    "SELECT * FROM audit_combined",
    "audit_combined",
)
def combined_counts(t):
    """Numerators and denominators counted apart, then brought together."""
    people = t.audit().filter(F.col("condition").isin("1-URGENT", "2-HIGH"))
    known = lookup.update_from(people, t.demographic(), ["person_id"], "ethnicity", "ethnic_code", crowded=True)
    denominators = rollup.person_counts(known, build.AUDIT_KEYS, "person_id", "denominator")
    numerators = rollup.person_counts(known.filter("complete = 1"), build.AUDIT_KEYS, "person_id")
    return rollup.combine_num_den(numerators, denominators, build.AUDIT_KEYS)


@query(
    "financial_year:t imd_quintile:t age:i sex:i ethnicity:t practice_code:t numerator:n denominator:n",
    "SELECT * FROM audit_combined",
    "audit_combined",
)
def audit_counts(t):
    return build.audit_counts(
        t.audit(), t.demographic(), F.col("condition").isin("1-URGENT", "2-HIGH"), F.col("complete") == 1
    )


def _facts_sql(source: str, stamps: dict[str, str]) -> str:
    return "SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in stamps.items()) + f" FROM {source}"


_EMPTY = {c: "NULL" for c in ("indicator_value", "lower_ci95", "upper_ci95")}
_LOADED = f"TIMESTAMP '{LOADED}'"


@query(
    FACT_SPEC,
    _facts_sql(
        "registered LEFT JOIN registered_ids USING (level, area)",
        {
            **_EMPTY, "indicator_id": "1", "imd_code": "999", "age_group_code": "999", "sex_code": "999",
            "ethnicity_code": "999", "creation_date": _LOADED, "value_type_code": "2", "source_code": "1",
        },
    ),
    "registered registered_ids",
)
def build_given_denominator(t):
    return build.given_denominator(
        t.register(), t.practices(), t.dates(), t.geography(), SYSTEM, "A",
        build.Indicator(1, 2, LOADED),
    )


def _split_sql(source: str, keys: str, sums: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keys}, {imd} AS imd_code, {ethnicity} AS ethnicity_code, {sums} FROM {source} GROUP BY {keys}{more}"
        for imd, ethnicity, more in (
            ("imd_code", "ethnicity_code", ", imd_code, ethnicity_code"),
            ("imd_code", "999", ", imd_code"),
            ("999", "ethnicity_code", ", ethnicity_code"),
            ("999", "999", ""),
        )
    )


@query(
    FACT_SPEC,
    _facts_sql(
        "split",
        {
            **_EMPTY, "denominator": "NULL", "indicator_id": "10", "sex_code": "999",
            "creation_date": _LOADED, "value_type_code": "4", "source_code": "1",
        },
    ),
    "resident resident_ids",
    identified="SELECT * FROM resident LEFT JOIN resident_ids USING (level, area)",
    split=_split_sql(
        "identified", "start_date, end_date, age_group_code, aggregation_id", "sum(numerator) AS numerator"
    ),
)
def build_census_denominator(t):
    located = build.episode_events(
        t.episodes(), t.diagnoses(), t.places(), t.demographic(), t.dates(),
        enrichment.FIRST_MONTH, enrichment.LAST_MONTH, GEOGRAPHY.authorities,
    )
    return build.census_denominator(
        located, t.small_areas(), t.footprint(), t.ages(),
        t.ethnicities(), t.geography(), build.Indicator(10, 4, LOADED), outside=OUTSIDE,
    )


@query(
    FACT_SPEC,
    _facts_sql(
        "split",
        {
            **_EMPTY, "indicator_id": "35", "age_group_code": "999", "sex_code": "999",
            "creation_date": _LOADED, "value_type_code": "2", "source_code": "1",
        },
    ),
    "audit_combined practices imd ethnicities registered_ids",
    coded="SELECT make_date(CAST(substring(financial_year, 1, 4) AS INT), 4, 1) AS start_date, "
    "make_date(2000 + CAST(substring(financial_year, 5, 2) AS INT), 3, 31) AS end_date, "
    "CASE WHEN coalesce(imd_quintile, '') = '' THEN -99 ELSE imd_code END AS imd_code, "
    "CASE WHEN coalesce(ethnicity, '') = '' THEN -99 ELSE ethnicity_code END AS ethnicity_code, "
    "pcn_code, locality, numerator, denominator FROM audit_combined "
    "LEFT JOIN imd USING (imd_quintile) LEFT JOIN ethnicities ON ethnicity = nhs_code "
    "JOIN practices USING (practice_code) WHERE lower(system) = 'home' AND practice_code <> 'M88006' "
    "AND lower(pcn_code) <> 'closed practice'",
    rolled=" UNION ALL ".join(
        f"SELECT '{level}' AS level, {area} AS area, start_date, end_date, imd_code, ethnicity_code, {_SUMS} "
        f"FROM coded WHERE {keep} GROUP BY ALL"
        for level, area, keep in (
            ("pcn", "pcn_code", "TRUE"),
            ("locality", "locality", "locality <> 'Not applicable'"),
            ("la", _AUTHORITY, f"{_AUTHORITY} IS NOT NULL"),
            ("icb", f"'{GEOGRAPHY.icb_code}'", "TRUE"),
        )
    ),
    identified="SELECT * FROM rolled LEFT JOIN registered_ids USING (level, area)",
    split=_split_sql("identified", "start_date, end_date, aggregation_id", _SUMS),
)
def build_derived_denominator(t):
    return build.derived_denominator(
        t.audit(), F.col("condition").isin("1-URGENT", "2-HIGH"), F.col("complete") == 1,
        t.demographic(), t.practices(), t.imd(), t.ethnicities(), t.geography(), SYSTEM,
        build.Indicator(35, 2, LOADED),
    )
