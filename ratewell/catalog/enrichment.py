"""Queries over lookups, record-level fills and the population."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewell.catalog import sql
from ratewell.catalog.registry import query
from ratewell.catalog.tables import CTES, Tables
from ratewell.operators import lookup, rollup, sets
from ratewell.plans import build, population
from ratewell.schema import GEOGRAPHY, SELF_HARM_CODES

FIRST_MONTH, LAST_MONTH = 199601, 200012
_CODES = ", ".join(f"'{c}'" for c in SELF_HARM_CODES)
_AREAS = ", ".join(f"'{a}'" for a in GEOGRAPHY.authorities)

CTES.update(
    {
        "cohort": (
            "episodes places",
            "SELECT episode_id, historic FROM episodes WHERE reconciliation_month BETWEEN "
            f"{FIRST_MONTH} AND {LAST_MONTH} AND episode_id IN "
            f"(SELECT episode_id FROM places WHERE area_code IN ({_AREAS}))",
        ),
        "numerator_rows": (
            "cohort diagnoses episodes",
            "SELECT DISTINCT c.episode_id, c.historic FROM cohort c "
            "JOIN diagnoses d ON c.episode_id = d.episode_id "
            "JOIN episodes e ON c.episode_id = e.episode_id AND c.historic = e.historic "
            "WHERE substring(admission_method, 1, 1) = '2' AND order_in_spell = 1 "
            f"AND substring(diagnosis_code, 1, 3) IN ({_CODES})",
        ),
        "detailed": (
            "numerator_rows episodes demographic dates",
            "SELECT n.episode_id, n.historic, e.person_id, e.age, e.reconciliation_month AS time_period, "
            "financial_year_name AS financial_year, "
            "CASE coalesce(ethnic_code, CASE WHEN n.historic = 0 THEN ethnic_category END) WHEN '9' THEN '99' "
            "WHEN 'A*' THEN 'A' WHEN 'ZZ' THEN 'Z' "
            "ELSE coalesce(ethnic_code, CASE WHEN n.historic = 0 THEN ethnic_category END, '99') END AS ethnicity "
            "FROM numerator_rows n JOIN episodes e USING (episode_id) LEFT JOIN demographic p ON p.person_id = e.person_id "
            "LEFT JOIN (SELECT DISTINCT reconciliation_month, financial_year_name FROM dates) d "
            "ON d.reconciliation_month = e.reconciliation_month",
        ),
        "located": (
            "detailed places lsoa_map wards localities ward_imd footprint",
            "SELECT d.*, w.ward_code, lad_code, locality, quintile AS imd FROM "
            "(SELECT d.*, CASE WHEN d.historic = 0 THEN p.lsoa_2021 ELSE m.lsoa_2021 END AS area21 FROM detailed d "
            "JOIN places p USING (episode_id) LEFT JOIN lsoa_map m ON m.lsoa_2011 = p.lsoa_2011) d "
            "LEFT JOIN wards w ON w.lsoa_2021 = area21 LEFT JOIN localities l ON l.lsoa_2021 = area21 "
            "LEFT JOIN ward_imd i ON i.ward_code = w.ward_code WHERE area21 IN (SELECT lsoa_2021 FROM footprint)",
        ),
        "coded_population": (
            "population imd ethnicities sexes ages",
            "SELECT DISTINCT p.aggregation_id, p.aggregation_type, p.imd, p.age_group, p.start_age, p.end_age, p.sex, "
            "p.observation, CASE WHEN p.imd = 'ALL' THEN 999 ELSE i.imd_code END AS imd_code, "
            "CASE WHEN p.age_group = 'ALL' THEN 999 ELSE a.age_code END AS age_code, "
            "CASE WHEN p.nhs_code = 'ALL' THEN 999 ELSE e.ethnicity_code END AS ethnicity_code, "
            "CASE WHEN p.sex_code = 3 THEN 999 ELSE s.sex_code END AS sex_code FROM population p "
            "LEFT JOIN imd i ON substring(p.imd, 1, 1) = i.imd_quintile "
            "LEFT JOIN ethnicities e ON p.nhs_code = e.nhs_code LEFT JOIN sexes s ON p.sex = s.sex "
            "LEFT JOIN ages a ON p.start_age = a.min_age AND p.end_age = a.max_age",
        ),
        "counted_facts": (
            "",
            "SELECT DATE '2000-01-01' AS start_date, CAST(c_custkey % 17 + 1 AS INT) AS age_group_code, "
            "c_nationkey + 1 AS aggregation_id, CAST(c_custkey % 5 + 1 AS INT) AS imd_code, "
            "CAST(CASE c_custkey % 9 WHEN 4 THEN 999 ELSE c_custkey % 9 + 1 END AS INT) AS ethnicity_code, "
            "CAST(CASE c_custkey % 3 WHEN 2 THEN 999 ELSE c_custkey % 3 + 1 END AS INT) AS sex_code, "
            "CAST(count(o_orderkey) AS DOUBLE) AS numerator, "
            "CASE WHEN c_nationkey = 3 THEN 50.0 END AS denominator "
            "FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL",
        ),
    }
)


def members(t: Tables):
    return build.cohort(t.episodes(), t.places(), FIRST_MONTH, LAST_MONTH, GEOGRAPHY.authorities)


def events(t: Tables):
    current, historic, diagnoses = t.episodes(0), t.episodes(1), t.diagnoses()
    return build.numerator_events(members(t), [(0, current, diagnoses), (1, historic, diagnoses)])


def detailed(t: Tables):
    return build.with_episode_details(
        events(t), [(0, t.episodes(0)), (1, t.episodes(1))], t.demographic(), t.dates()
    )


def located(t: Tables):
    return lookup.with_small_area(build.with_places(detailed(t), t.places()), **t.small_areas())


def coded_population(t: Tables):
    return population.code_population(
        t.population(), t.imd(), t.ethnicities(), t.sexes(), t.ages()
    )


def counted_facts(t: Tables):
    """Order counts of customer groups, without most denominators."""
    orders = t.raw("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    rows = t.raw("customer").join(orders, "c_custkey", "left").selectExpr(
        "DATE '2000-01-01' AS start_date",
        "CAST(c_custkey % 17 + 1 AS INT) AS age_group_code",
        "c_nationkey + 1 AS aggregation_id",
        "CAST(c_custkey % 5 + 1 AS INT) AS imd_code",
        "CAST(CASE c_custkey % 9 WHEN 4 THEN 999 ELSE c_custkey % 9 + 1 END AS INT) AS ethnicity_code",
        "CAST(CASE c_custkey % 3 WHEN 2 THEN 999 ELSE c_custkey % 3 + 1 END AS INT) AS sex_code",
        "CASE WHEN c_nationkey = 3 THEN 50.0D END AS denominator",
        "coalesce(orders, 0) AS orders",
    )
    keys = [c for c in rows.columns if c != "orders"]
    return rows.groupBy(*keys).agg(F.sum("orders").cast("double").alias("numerator"))


@query(
    "indicator_id:i age:t year_type:t multiplier:n status_code:i population_type:t row_count:i",
    f"SELECT f.indicator_id, {sql.META}, count(*) AS row_count FROM facts f LEFT JOIN "
    "(SELECT * FROM metadata WHERE indicator_id <> 2) m ON f.indicator_id = m.indicator_id GROUP BY ALL",
    "facts metadata",
)
def facts_with_metadata(t):
    joined = lookup.with_metadata(t.facts(), t.metadata().filter("indicator_id <> 2"))
    keys = ["indicator_id", "age", "year_type", "multiplier", "status_code", "population_type"]
    return sets.count_by(joined, keys, "row_count")


@query(
    "indicator_id:i age_code:i",
    "SELECT indicator_id, age_code FROM part_metadata m LEFT JOIN ages a ON m.age IS NOT DISTINCT FROM a.age_group_label",
    "part_metadata ages",
)
def indicator_age_codes(t):
    return lookup.age_lookup(t.part_metadata(), t.ages())


@query(
    "age_group_code:i stdpop:n row_count:i",
    f"SELECT age_group_code, {sql.weight('age_group_code')} AS stdpop, count(*) AS row_count FROM facts GROUP BY ALL",
    "facts",
)
def standard_weights(t):
    return sets.count_by(lookup.with_stdpop(t.facts()), ["age_group_code", "stdpop"], "row_count")


@query(
    "practice_code:t indicator_code:t financial_year:t start_date:d end_date:d denominator:n",
    "SELECT r.*, start_date, end_date FROM register r JOIN "
    "(SELECT DISTINCT financial_year_name, start_date, end_date FROM dates) ON financial_year = financial_year_name",
    "register dates",
)
def register_with_dates(t):
    return lookup.with_fy_dates(t.register(), t.dates())


@query(
    "practice_code:t financial_year:t indicator_code:t pcn_code:t locality:t system:t",
    "SELECT * FROM register JOIN practices USING (practice_code)",
    "register practices",
)
def register_with_practices(t):
    return lookup.with_practice(t.register(), t.practices())


@query("episode_id:i historic:i", "SELECT * FROM cohort", "cohort")
def resident_cohort(t):
    return members(t)


@query("episode_id:i historic:i", "SELECT * FROM numerator_rows", "numerator_rows")
def coded_events(t):
    return events(t)


@query(
    "person_id:i practice_code:t ethnicity:t row_count:i",
    "SELECT a.person_id, practice_code, CASE WHEN d.person_id IS NOT NULL THEN ethnic_code ELSE ethnicity END AS ethnicity, "
    "count(*) AS row_count FROM audit a LEFT JOIN demographic d ON a.person_id = d.person_id GROUP BY ALL",
    "audit demographic",
)
def overridden_ethnicity(t):
    updated = lookup.update_from(
        t.audit(), t.demographic(), ["person_id"], "ethnicity", "ethnic_code", crowded=True
    )
    return sets.count_by(updated, ["person_id", "practice_code", "ethnicity"], "row_count")


@query(
    "episode_id:i historic:i person_id:i age:i time_period:i financial_year:t ethnicity:t",
    "SELECT * FROM detailed",
    "detailed",
)
def episode_details(t):
    return detailed(t)


@query(
    "episode_id:i sex:t",
    "SELECT e.episode_id, sex FROM episodes e LEFT JOIN genders g ON e.gender_code = g.gender_code",
    "episodes genders",
)
def episode_sex(t):
    rows = t.episodes().select("episode_id", "historic", F.lit(None).cast("string").alias("sex"))
    described = [
        (t.episodes(flag).join(t.genders(), "gender_code", "left"), F.col("historic") == flag)
        for flag in (0, 1)
    ]
    return lookup.fill_from(rows, described, ["episode_id"], {"sex": "sex"})


@query(
    "episode_id:i lsoa_2021:t ward_code:t lad_code:t locality:t imd:i",
    "SELECT *, area21 AS lsoa_2021 FROM located",
    "located",
)
def located_events(t):
    return lookup.keep_footprint(located(t), t.footprint())


@query(
    "lsoa_2021:t row_count:i",
    "SELECT lsoa_2021, count(*) AS row_count FROM places WHERE lsoa_2021 IN (SELECT lsoa_2021 FROM footprint) GROUP BY ALL",
    "places footprint",
)
def footprint_episodes(t):
    return sets.count_by(lookup.keep_footprint(t.places(), t.footprint()), ["lsoa_2021"], "row_count")


@query(
    "ethnic_category:t code:t row_count:i",
    "SELECT ethnic_category, coalesce(CAST(ethnicity_code AS VARCHAR), ethnic_category) AS code, count(*) AS row_count "
    "FROM episodes LEFT JOIN ethnicities ON ethnic_category = nhs_code GROUP BY ALL",
    "episodes ethnicities",
)
def mapped_ethnicity(t):
    rows = t.episodes().select("ethnic_category", F.col("ethnic_category").alias("code"))
    mapped = lookup.map_codes(rows, t.ethnicities(), "code", "nhs_code", "ethnicity_code")
    return sets.count_by(mapped, ["ethnic_category", "code"], "row_count")


@query(
    "area:t aggregation_id:i row_count:i",
    "SELECT lad AS area, aggregation_id, count(*) AS row_count FROM (SELECT area_code AS lad FROM places) LEFT JOIN "
    "(SELECT * FROM geography WHERE aggregation_type = 'Local Authority (resident)') ON lad = aggregation_code GROUP BY ALL",
    "places geography",
)
def areas_by_code(t):
    rows = t.places().select(F.col("area_code").alias("area"))
    mapped = lookup.map_geography(rows, t.geography(), ["Local Authority (resident)"])
    return sets.count_by(mapped, ["area", "aggregation_id"], "row_count")


@query(
    "practice_code:t area:t aggregation_id:i",
    "SELECT practice_code, locality AS area, aggregation_id FROM practices LEFT JOIN "
    "(SELECT * FROM geography WHERE aggregation_type = 'Locality (registered)') ON locality = aggregation_label",
    "practices geography",
)
def areas_by_label(t):
    rows = t.practices().select("practice_code", F.col("locality").alias("area"))
    return lookup.map_geography(rows, t.geography(), ["Locality (registered)"], by="label")


# population ---------------------------------------------------------------------------------
@query(
    "aggregation_id:i aggregation_type:t imd:t age_group:t start_age:i end_age:i sex:t observation:i "
    "imd_code:i age_code:i ethnicity_code:i sex_code:i",
    "SELECT * FROM coded_population",
    "coded_population",
)
def population_codes(t):
    return coded_population(t)


_ORDER = [
    "aggregation_id", "imd", "start_age", "end_age", "ethnicity_code", "sex", "observation",
]


@query(
    "population_id:i aggregation_id:i imd:t start_age:i end_age:i ethnicity_code:i sex:t observation:i",
    "SELECT *, row_number() OVER (ORDER BY "
    + ", ".join(f"{c} NULLS FIRST" for c in _ORDER)
    + ") AS population_id FROM coded_population",
    "coded_population",
)
def population_ids(t):
    return population.identified_population(coded_population(t), _ORDER)


_MATCH = " AND ".join(
    f"f.{a} = p.{b}"
    for a, b in (
        ("aggregation_id", "aggregation_id"), ("age_group_code", "age_code"),
        ("ethnicity_code", "ethnicity_code"), ("imd_code", "imd_code"), ("sex_code", "sex_code"),
    )
)
_FACT_KEYS = "aggregation_id:i age_group_code:i ethnicity_code:i imd_code:i sex_code:i"


@query(
    f"start_date:d {_FACT_KEYS} numerator:n denominator:n",
    "SELECT f.* REPLACE (coalesce(f.denominator, (SELECT sum(observation) FROM coded_population p "
    f"WHERE {_MATCH})) AS denominator) FROM counted_facts f",
    "counted_facts coded_population",
)
def attached_population(t):
    return rollup.attach_population(counted_facts(t), coded_population(t))


@query(
    f"start_date:d {_FACT_KEYS} numerator:n",
    "SELECT DISTINCT start_date, numerator, f.aggregation_id, age_group_code, f.ethnicity_code, f.imd_code, f.sex_code "
    f"FROM counted_facts f LEFT JOIN coded_population p ON {_MATCH} WHERE observation IS NULL "
    "AND f.ethnicity_code NOT IN (999, -99, 17)",
    "counted_facts coded_population",
)
def unmatched_population(t):
    return population.unmatched_population(counted_facts(t), coded_population(t))


@query(
    "indicator_id:i age_group_label:t single_age_code:i min_age:i max_age:i min_age_code:i max_age_code:i "
    "value_type:t value_type_code:i status_code:i",
    "SELECT *, CASE WHEN value_type_code <> 4 THEN single_age_code WHEN single_age_code = 999 THEN 1 "
    "WHEN value_type_code = 4 THEN (SELECT age_code FROM ages b WHERE b.min_age = j.min_age AND age_type = '5-year age group') "
    "END AS min_age_code, CASE WHEN value_type_code <> 4 THEN single_age_code WHEN single_age_code = 999 THEN 18 "
    "WHEN value_type_code = 4 THEN coalesce((SELECT age_code FROM ages b WHERE b.max_age = j.max_age "
    "AND age_type = '5-year age group'), CASE WHEN max_age = 120 THEN 18 END) END AS max_age_code FROM joined j",
    "part_metadata ages value_types",
    joined="SELECT DISTINCT indicator_id, age, age_group_label, age_code AS single_age_code, min_age, max_age, "
    "m.value_type, value_type_code, status_code FROM part_metadata m LEFT JOIN ages a ON m.age = a.age_group_label "
    "LEFT JOIN value_types v ON m.value_type = v.value_type",
)
def indicator_age_ranges(t):
    return population.age_metadata(t.part_metadata(), t.ages(), t.value_types())


@query(
    "indicator_id:i age_group_code:i row_count:i",
    "SELECT indicator_id, age_group_code, count(*) AS row_count FROM (SELECT CAST(l_partkey AS INT) AS indicator_id, "
    "CAST(l_quantity AS INT) % 18 + 1 AS age_group_code FROM lineitem) JOIN "
    "(SELECT CAST(p_partkey AS INT) AS part, CAST(p_size % 9 AS INT) AS low, "
    "CASE WHEN p_size % 5 = 0 THEN NULL ELSE 15 END AS high FROM part) ON indicator_id = part "
    "WHERE coalesce(age_group_code BETWEEN low AND high, TRUE) GROUP BY ALL",
)
def rows_in_age_range(t):
    rows = t.raw("lineitem").selectExpr(
        "CAST(l_partkey AS INT) AS indicator_id", "CAST(l_quantity AS INT) % 18 + 1 AS age_group_code"
    )
    ranges = t.raw("part").selectExpr(
        "CAST(p_partkey AS INT) AS indicator_id", "CAST(p_size % 9 AS INT) AS min_age_code",
        "CASE WHEN p_size % 5 = 0 THEN NULL ELSE 15 END AS max_age_code",
    )
    kept = rollup.filter_age_range(rows, ranges)
    return sets.count_by(kept, ["indicator_id", "age_group_code"], "row_count")
