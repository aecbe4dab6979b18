"""Queries over sources, cleaning, coding, sets and ranking."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from ratewell.catalog import sql
from ratewell.catalog.registry import FACT_SPEC, query
from ratewell.catalog.tables import (
    LOADED,
    SYSTEM,
    Tables,
    case,
    pick,
    projection,
)
from ratewell.functions import codes, dates
from ratewell.operators import lookup, ranking, select, sets
from ratewell.schema import FACT_COLS, GEOGRAPHY
from ratewell.session import shared_dir
from ratewell.sources import landing, sinks
from ratewell.staging import stage

# sources ------------------------------------------------------------------------------------
TEXT_FACTS = {
    "file_name": "'ID_' || CAST(o_custkey % 40 AS STRING) || '.csv'",
    "indicator_id": case("o_orderkey % 5", {0: "1", 1: "2.9", 2: "bad", 3: ""}, "'3'"),
    "start_date": "CASE WHEN o_orderkey % 9 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
    "end_date": "CAST(CAST(o_orderdate AS DATE) AS STRING)",
    "numerator": "CAST(o_totalprice AS STRING)",
    "denominator": "CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE '1e3' END",
    "indicator_value": "CAST(NULL AS STRING)",
    "lower_ci95": "CAST(NULL AS STRING)",
    "upper_ci95": "CAST(NULL AS STRING)",
    "imd_code": "'999'",
    "aggregation_id": "CAST(o_custkey AS STRING)",
    "age_group_code": "'999'",
    "sex_code": "'999'",
    "ethnicity_code": "'-99'",
    "creation_date": "'2024-01-01 10:30:00'",
    "value_type_code": "'2'",
    "source_code": "'1'",
}
_INTS = {
    "indicator_id", "imd_code", "aggregation_id", "age_group_code", "sex_code", "ethnicity_code",
    "value_type_code", "source_code",
}
_DUCK_TYPES = {"start_date": "DATE", "end_date": "DATE", "creation_date": "TIMESTAMP"}


def duck_cast(column: str) -> str:
    if column in _INTS:
        return f"CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INT) AS {column}"
    return f"TRY_CAST({column} AS {_DUCK_TYPES.get(column, 'DOUBLE')}) AS {column}"


_MANIFEST = {
    "file_name": "'ID_' || CAST(c_custkey % 45 AS STRING) || '.csv'",
    "validation_value": case("c_custkey % 45 % 5", {0: "0", 1: "0.0", 2: "1", 3: "n/a"}, "NULL"),
}
_TEMPLATE_STEPS = {
    "submitted": f"SELECT {projection(TEXT_FACTS)} FROM orders",
    "manifest": f"SELECT DISTINCT {projection(_MANIFEST)} FROM customer",
    "checked": "SELECT file_name, coalesce(TRY_CAST(validation_value AS DOUBLE) = 0, FALSE) AS ok FROM manifest",
}


def _templates(t: Tables):
    manifest = pick(t.raw("customer"), _MANIFEST).distinct()
    return landing.accept_templates(pick(t.raw("orders"), TEXT_FACTS), manifest)


@query(
    FACT_SPEC,
    f"SELECT {', '.join(duck_cast(c) for c in FACT_COLS)} FROM submitted "
    "WHERE file_name IN (SELECT file_name FROM checked WHERE ok)",
    **_TEMPLATE_STEPS,
)
def accepted_templates(t):
    return _templates(t)[0]


@query(
    "file_name:t status:t",
    "SELECT coalesce(s.file_name, c.file_name) AS file_name, "
    "CASE WHEN ok THEN 'accepted' ELSE 'failed' END AS status "
    "FROM (SELECT DISTINCT file_name FROM submitted) s FULL JOIN checked c ON s.file_name = c.file_name",
    **_TEMPLATE_STEPS,
)
def template_status(t):
    return _templates(t)[1]


@query(
    FACT_SPEC + " time_period_type:t combination_id:i",
    f"SELECT {', '.join(duck_cast(c) for c in FACT_COLS)}, NULL AS time_period_type, "
    "CAST(o_orderkey AS VARCHAR) AS combination_id FROM submitted",
    submitted=f"SELECT {projection(TEXT_FACTS)}, o_orderkey FROM orders",
)
def cleaned_types(t):
    text = {**TEXT_FACTS, "time_period_type": "CAST(NULL AS STRING)", "combination_id": "CAST(o_orderkey AS STRING)"}
    return select.clean_types(pick(t.raw("orders"), text))


@query(FACT_SPEC, "SELECT * FROM facts WHERE indicator_id IN (1, 4)", "facts")
def selected_indicators(t):
    return select.select_indicators(t.facts(), "4, 1, 1, ,x")


_LOADS = {
    "indicator_id": "CAST(o_custkey % 30 AS INT)",
    "creation_date": "make_date(2024, 1, CAST(o_custkey % 30 % 5 * (o_orderkey % 4) + 1 AS INT))",
    "order_id": "o_orderkey",
    "status": "o_orderstatus",
}


@query(
    "indicator_id:i creation_date:d order_id:i status:t",
    "SELECT * FROM loads l WHERE creation_date = "
    "(SELECT max(creation_date) FROM loads m WHERE m.indicator_id = l.indicator_id)",
    loads=f"SELECT {projection(_LOADS)} FROM orders",
)
def latest_loads(t):
    loads = pick(t.raw("orders"), _LOADS)
    parts = [loads.filter(F.col("status") == s) for s in ("F", "O", "P")]
    return sets.combine_landing(parts)


@query(
    "indicator_id:i segment:t customers:i",
    "SELECT CAST(c_nationkey AS INT) AS indicator_id, c_mktsegment AS segment, "
    "count(*) FILTER (WHERE c_acctbal < 0) AS customers FROM customer "
    "WHERE c_nationkey IN (1, 2) AND c_mktsegment <> 'MACHINERY' GROUP BY ALL HAVING customers > 0 "
    "UNION ALL SELECT CAST(c_nationkey AS INT), c_mktsegment, count(*) FROM customer "
    "WHERE c_nationkey NOT IN (1, 2, 3) GROUP BY ALL",
)
def replaced_results(t):
    counted = t.raw("customer").groupBy(
        F.col("c_nationkey").alias("indicator_id"), F.col("c_mktsegment").alias("segment")
    )
    old = counted.agg(F.count(F.lit(1)).alias("customers"))
    new = counted.agg(F.count_if(F.col("c_acctbal") < 0).alias("customers")).filter(
        "indicator_id IN (1, 2) AND segment <> 'MACHINERY' AND customers > 0"
    )
    # A managed table in the shared folder, whatever the session's warehouse is.
    scratch = f"results_{uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {scratch} LOCATION '{shared_dir(t.spark)}/{scratch}'")
    table = f"{scratch}.published"
    sinks.create_results(old, table)
    sinks.replace_indicators(new, table, "1, 2, 3")
    found = stage(t.spark.table(table))
    t.spark.sql(f"DROP DATABASE {scratch} CASCADE")
    return found


# scalar functions ---------------------------------------------------------------------------
@query(
    "imd_code:i ethnicity_code:i combination_id:i row_count:i",
    f"SELECT imd_code, ethnicity_code, {sql.COMBINATION} AS combination_id, count(*) AS row_count "
    "FROM (SELECT CASE WHEN aggregation_id % 3 = 0 THEN 999 ELSE imd_code END AS imd_code, "
    "CASE WHEN aggregation_id % 4 = 0 THEN 999 ELSE ethnicity_code END AS ethnicity_code FROM facts) GROUP BY ALL",
    "facts",
)
def split_combinations(t):
    everyone = {"imd_code": 3, "ethnicity_code": 4}
    mixed = t.facts().withColumns(
        {c: F.when(F.col("aggregation_id") % n == 0, 999).otherwise(F.col(c)) for c, n in everyone.items()}
    )
    labelled = select.with_combination_id(mixed)
    return sets.count_by(labelled, ["imd_code", "ethnicity_code", "combination_id"], "row_count")


@query(
    "o_orderkey:i start_date:d end_date:d time_period_type:t",
    f"SELECT *, {sql.label()} AS time_period_type FROM periods",
    periods="SELECT o_orderkey, CAST(o_orderdate AS DATE) AS start_date, "
    "CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR * CAST(o_orderkey % 6 AS INT) AS DATE) "
    "- CAST(o_orderkey % 3 AS INT) AS end_date FROM orders",
)
def period_labels(t):
    start = F.col("o_orderdate").cast("date")
    years = F.add_months(start, (F.col("o_orderkey") % 6 * 12).cast("int"))
    end = F.date_sub(years, (F.col("o_orderkey") % 3).cast("int"))
    rows = t.raw("orders").select("o_orderkey", start.alias("start_date"), end.alias("end_date"))
    return select.with_duration_label(rows)


@query(
    "financial_year:t standard:t start_date:d end_date:d row_count:i",
    "SELECT *, CAST(substring(standard, 1, 4) || '-04-01' AS DATE) AS start_date, "
    "CAST('20' || right(standard, 2) || '-03-31' AS DATE) AS end_date FROM "
    "(SELECT financial_year, substring(financial_year, 1, 4) || '-' || substring(financial_year, 5, 2) AS standard, "
    "count(*) AS row_count FROM audit GROUP BY ALL)",
    "audit",
)
def financial_years(t):
    counted = sets.count_by(t.audit(), ["financial_year"], "row_count")
    standard = dates.fy_standardise(F.col("financial_year"))
    start, end = dates.fy_bounds(standard)
    return counted.select("*", standard.alias("standard"), start.alias("start_date"), end.alias("end_date"))


@query(
    "raw:t cleaned:t row_count:i",
    "SELECT ethnic_category AS raw, CASE ethnic_category WHEN '9' THEN '99' WHEN 'A*' THEN 'A' "
    "WHEN 'ZZ' THEN 'Z' ELSE coalesce(ethnic_category, '99') END AS cleaned, count(*) AS row_count "
    "FROM episodes GROUP BY ALL",
    "episodes",
)
def cleaned_ethnicity(t):
    raw = t.episodes().select(F.col("ethnic_category").alias("raw"))
    return sets.count_by(raw.withColumn("cleaned", codes.clean_ethnicity(F.col("raw"))), ["raw", "cleaned"], "row_count")


@query(
    "band:t row_count:i",
    "SELECT CASE WHEN age IS NULL THEN 'Unknown' WHEN age >= 130 THEN CAST(age AS VARCHAR) WHEN age >= 85 THEN '85+' "
    "ELSE (age // 5 * 5) || '-' || (age // 5 * 5 + 4) END AS band, count(*) AS row_count FROM "
    "(SELECT CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey % 132 END AS age FROM customer) GROUP BY ALL",
)
def age_bands(t):
    age = F.expr("CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_custkey % 132 END")
    return sets.count_by(t.raw("customer").select(codes.age_band(age).alias("band")), ["band"], "row_count")


@query(
    "imd_quintile:t ethnicity:t row_count:i",
    "SELECT CASE WHEN imd_quintile IS NULL OR imd_quintile = '' THEN '-99' ELSE imd_quintile END AS imd_quintile, "
    "CASE WHEN ethnicity IS NULL OR ethnicity = '' THEN '-99' ELSE ethnicity END AS ethnicity, "
    "count(*) AS row_count FROM audit GROUP BY ALL",
    "audit",
)
def unknown_defaults(t):
    filled = select.default_unknown(t.audit(), ["imd_quintile", "ethnicity"])
    return sets.count_by(filled, ["imd_quintile", "ethnicity"], "row_count")


_AUTHORITY = case("locality", GEOGRAPHY.localities, "locality")


@query(
    "practice_code:t locality:t",
    f"SELECT practice_code, {_AUTHORITY} AS locality FROM practices",
    "practices",
)
def recoded_localities(t):
    return select.recode(t.practices().select("practice_code", "locality"), "locality", GEOGRAPHY.localities)


@query(
    "practice_code:t indicator_id:i sex_code:i age_group_code:i value_type_code:i source_code:i "
    "indicator_value:n lower_ci95:n creation_date:s",
    "SELECT practice_code, 35 AS indicator_id, 999 AS sex_code, 999 AS age_group_code, 2 AS value_type_code, "
    f"1 AS source_code, NULL AS indicator_value, NULL AS lower_ci95, TIMESTAMP '{LOADED}' AS creation_date FROM practices",
    "practices",
)
def stamped_rows(t):
    return select.stamp_all_persons(
        t.practices(), ["sex_code", "age_group_code"],
        indicator_id=35, value_type_code=2, source_code=1, creation_date=LOADED,
    )


_ODD = (
    "CASE l_linenumber WHEN 1 THEN CAST('NaN' AS DOUBLE) WHEN 2 THEN CAST('Infinity' AS DOUBLE) "
    "WHEN 3 THEN CAST('-Infinity' AS DOUBLE) WHEN 4 THEN NULL ELSE l_extendedprice END"
)


@query(
    "l_orderkey:i l_linenumber:i numerator:n",
    "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 4 THEN l_extendedprice END AS numerator FROM lineitem",
)
def finite_numbers(t):
    odd = t.raw("lineitem").select("l_orderkey", "l_linenumber", F.expr(_ODD).alias("numerator"))
    return select.finite_or_null(odd, ["numerator"])


_SERIAL = (
    "CASE o_orderkey % 4 WHEN 0 THEN CAST(36526 + o_orderkey % 1000 AS STRING) WHEN 1 THEN '2001-02-03' "
    "WHEN 2 THEN 'never' ELSE NULL END"
)


@query(
    "o_orderkey:i day:t",
    "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN "
    "strftime(DATE '1899-12-30' + CAST(36526 + o_orderkey % 1000 AS INT), '%Y-%m-%d') "
    "WHEN 1 THEN '2001-02-03' END AS day FROM orders",
)
def serial_dates(t):
    return t.raw("orders").select("o_orderkey", dates.serial_to_date(F.expr(_SERIAL)).alias("day"))


@query(
    "indicator_id:i",
    "SELECT DISTINCT indicator_id FROM part_metadata WHERE lower(denominator_source) LIKE '%census%'",
    "part_metadata",
)
def census_indicators(t):
    return select.census_indicator_ids(t.part_metadata())


@query(
    "practice_code:t financial_year:t indicator_code:t pcn_code:t numerator:n",
    "SELECT * FROM register JOIN practices USING (practice_code) WHERE lower(system) = 'home' "
    "AND practice_code <> 'M88006' AND lower(pcn_code) <> 'closed practice' AND numerator IS NOT NULL",
    "register practices",
)
def filtered_practices(t):
    return select.filter_practices(lookup.with_practice(t.register(), t.practices()), SYSTEM)


@query(
    "aggregation_id:i aggregation_type:t aggregation_label:t",
    "SELECT * FROM geography WHERE aggregation_type NOT IN ('Locality (resident)', 'Locality (registered)', 'Ward')",
    "geography",
)
def coded_geographies(t):
    return select.filter_geography(t.geography(), ["Locality (resident)", "Locality (registered)", "Ward"])


# sets, sorts and counts ---------------------------------------------------------------------
@query(
    "o_orderkey:i o_totalprice:n",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def dearest_orders(t):
    return select.top_n(t.raw("orders"), 100, F.desc("o_totalprice"), "o_orderkey")


@query(
    "area:t kind:t",
    "SELECT 'W' || n_nationkey AS area, 'lad ' || (n_nationkey % 4) AS kind FROM nation UNION "
    "SELECT 'W' || c_nationkey, 'lad ' || (c_nationkey % 4) FROM customer UNION "
    "SELECT 'W' || s_nationkey, 'lad ' || (s_nationkey % 2) FROM supplier",
)
def distinct_areas(t):
    def areas(table: str, key: str, modulus: int):
        return t.raw(table).selectExpr(
            f"'W' || CAST({key} AS STRING) AS area", f"'lad ' || CAST({key} % {modulus} AS STRING) AS kind"
        )

    return sets.union_distinct(
        areas("nation", "n_nationkey", 4), areas("customer", "c_nationkey", 4), areas("supplier", "s_nationkey", 2)
    )


@query(
    "key:i segment:t balance:n",
    "SELECT c_custkey AS key, c_mktsegment AS segment, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier",
)
def stacked_accounts(t):
    customers = t.raw("customer").selectExpr("c_custkey AS key", "c_mktsegment AS segment", "c_acctbal AS balance")
    suppliers = t.raw("supplier").selectExpr("s_acctbal AS balance", "s_suppkey AS key")
    return sets.union_by_name(customers, suppliers)


@query(
    "code:t",
    "SELECT aggregation_code AS code FROM geography UNION SELECT practice_code FROM practices",
    "geography practices",
)
def area_code_list(t):
    return sets.code_list((t.geography(), "aggregation_code"), (t.practices(), "practice_code"))


_AREA_ROWS = {
    "Parent Name": "'N' || CAST(s_nationkey AS STRING)",
    "Area Code": "CASE WHEN l_suppkey = 7 THEN 'M88006' ELSE 'P' || CAST(l_suppkey AS STRING) END",
    "Area Type": "l_returnflag",
}


def _area_rows(t: Tables):
    suppliers = t.raw("supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = t.raw("lineitem").groupBy("l_suppkey", "l_returnflag", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n")
    )
    return pick(rows.join(suppliers, "l_suppkey"), {f"`{k}`": v for k, v in _AREA_ROWS.items()} | {"n": "n"})


_AREA_SQL = (
    "SELECT 'N' || s_nationkey AS parent, CASE WHEN l_suppkey = 7 THEN 'M88006' ELSE 'P' || l_suppkey END AS area, "
    "l_returnflag AS kind, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey "
    "GROUP BY s_nationkey, l_suppkey, l_returnflag, l_linenumber"
)


@query(
    "parent:t area:t kind:t n:i",
    "SELECT * FROM area_rows WHERE area IN (SELECT practice_code FROM practices WHERE locality = 'Solihull' OR lower(system) = 'away')",
    "practices",
    area_rows=_AREA_SQL,
)
def filtered_areas(t):
    listed = t.practices().filter("locality = 'Solihull' OR lower(system) = 'away'").select("practice_code")
    rows = select.filter_areas(_area_rows(t), listed, "areacode")
    return rows.withColumnsRenamed({"Parent Name": "parent", "Area Code": "area", "Area Type": "kind"})


@query("kind:t count:i", "SELECT kind, count(*) AS count FROM area_rows GROUP BY kind", area_rows=_AREA_SQL)
def rows_per_area_type(t):
    return sets.count_by(_area_rows(t).withColumnRenamed("Area Type", "kind"), ["kind"])


@query(
    "parent:t count:i",
    "SELECT parent, count(DISTINCT area) AS count FROM area_rows GROUP BY parent",
    area_rows=_AREA_SQL,
)
def areas_per_parent(t):
    rows = _area_rows(t).withColumnsRenamed({"Parent Name": "parent", "Area Code": "area"})
    return sets.groups_by(rows, ["parent"], ["area"])


@query(
    "area:t n:i locality:t",
    "SELECT area, sum(n) AS n, locality FROM area_rows JOIN practices ON area = practice_code GROUP BY area, locality",
    "practices",
    area_rows=_AREA_SQL,
)
def areas_with_practices(t):
    counted = _area_rows(t).groupBy(F.col("Area Code").alias("area")).agg(F.sum("n").alias("n"))
    return lookup.join_on(counted, t.practices().select("practice_code", "locality"), "area", "practice_code")


@query(
    "first_day:d last_day:d",
    "SELECT DISTINCT start_date AS first_day, end_date AS last_day FROM dates",
    "dates",
)
def distinct_years(t):
    return t.dates().selectExpr("start_date AS first_day", "end_date AS last_day").distinct()


# ranking ------------------------------------------------------------------------------------
_BAND = (
    "SELECT *, CASE WHEN raw = 0 THEN 1 ELSE raw END AS quantile FROM "
    "(SELECT *, floor(({n} + 1) - ceil(((total + 1) - place) / (total / CAST({n} AS DOUBLE)))) AS raw FROM ranked)"
)


@query(
    "p_partkey:i price:n quantile:i",
    _BAND.format(n=5),
    ranked="SELECT p_partkey, round(p_retailprice / 10) AS price, "
    "rank() OVER (ORDER BY round(p_retailprice / 10) DESC) AS place, count(*) OVER () AS total FROM part",
)
def price_quintiles(t):
    rows = t.raw("part").select("p_partkey", F.round(F.col("p_retailprice") / 10).alias("price"))
    return ranking.quantile_band(rows, "price", 5)


@query(
    "o_orderkey:i status:t price:n quantile:i",
    _BAND.format(n=10),
    ranked="SELECT o_orderkey, o_orderstatus AS status, round(o_totalprice / 100) AS price, "
    "rank() OVER (PARTITION BY o_orderstatus ORDER BY round(o_totalprice / 100)) AS place, "
    "count(*) OVER (PARTITION BY o_orderstatus) AS total FROM orders",
)
def price_deciles_by_status(t):
    rows = t.raw("orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), F.round(F.col("o_totalprice") / 100).alias("price")
    )
    return ranking.quantile_band(rows, "price", 10, invert=False, by=["status"])


@query(
    "c_custkey:i c_nationkey:i population_id:i",
    "SELECT c_custkey, c_nationkey, row_number() OVER (ORDER BY c_nationkey, c_custkey) AS population_id FROM customer",
)
def numbered_customers(t):
    rows = t.raw("customer").select("c_custkey", "c_nationkey")
    return ranking.with_surrogate_id(rows, ["c_nationkey", "c_custkey"])
