"""Queries over the calculation: completeness, pooling, rates, standardisation, quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.catalog import sql
from ratewell.catalog.registry import FACT_SPEC, TIDY_SPEC, query
from ratewell.catalog.tables import AS_OF, LOADED, Tables
from ratewell.operators import complete, lookup, pooling, standardise
from ratewell.plans import calculate, quality
from ratewell.schema import DASR_KEYS, FACT_SCHEMA, TIDY_COLS, TIDY_SCHEMA
from ratewell.staging import stage, stage_counted


def _enriched(t: Tables) -> DataFrame:
    return lookup.with_metadata(calculate.prepare(t.landing()), t.metadata())


def _kept(t: Tables) -> DataFrame:
    return complete.exclude_incomplete(_enriched(t), current_date=AS_OF)[0]


def _result(t: Tables) -> calculate.Result:
    return calculate.calculate_values(t.landing(), t.metadata(), t.ages(), AS_OF)


def _routed(t: Tables) -> DataFrame:
    return calculate.route(_kept(t))


@query(FACT_SPEC, "SELECT * FROM facts", "facts")
def landing_facts(t):
    return t.facts()


@query(TIDY_SPEC, "SELECT * FROM kept", "kept")
def completed_periods(t):
    return _kept(t)


@query(
    "indicator_id:i excluded_rows:i",
    "SELECT indicator_id, count(*) AS excluded_rows FROM flagged WHERE NOT is_kept GROUP BY indicator_id",
    "flagged",
)
def excluded_rows(t):
    excluded = complete.exclude_incomplete(_enriched(t), current_date=AS_OF)[1]
    return complete.excluded_counts(excluded)


@query(
    "indicator_id:i imd_code:i aggregation_id:i age_group_code:i ethnicity_code:i year_type:t "
    "period_year:i numerator:n denominator:n",
    "SELECT * FROM yearly",
    "yearly",
)
def yearly_totals(t):
    return pooling.yearly_totals(_kept(t))


@query(TIDY_SPEC, "SELECT * FROM pooled", "pooled")
def pooled_years(t):
    return pooling.pool_years(_kept(t))


@query(
    TIDY_SPEC,
    "SELECT indicator_id, CASE WHEN year_type = 'Calendar' THEN make_date(a, 1, 1) ELSE make_date(a, 4, 1) END AS start_date, "
    "CASE WHEN year_type = 'Calendar' THEN make_date(b, 12, 31) ELSE make_date(b + 1, 3, 31) END AS end_date, "
    "sum(numerator) AS numerator, sum(denominator) AS denominator, NULL AS indicator_value, NULL AS lower_ci95, "
    "NULL AS upper_ci95, imd_code, aggregation_id, age_group_code, sex_code, ethnicity_code, creation_date, "
    "value_type_code, source_code, k || ' year pooled' AS time_period_type, combination_id "
    "FROM yearly JOIN given ON period_year BETWEEN a AND b "
    f"GROUP BY {sql.KEYS}, year_type, a, b, k",
    "yearly",
    given="SELECT * FROM (VALUES (1995, 1997, 3), (1998, 2000, 3), (1996, 2000, 5)) AS v(a, b, k)",
)
def pooled_given_windows(t):
    given = t.local([(1995, 1997, 3), (1998, 2000, 3), (1996, 2000, 5), (1999, 2003, 5)], "from int, to int, k int")
    return pooling.pool_years(_kept(t), windows=given)


@query(
    "first:i last:i k:i",
    'SELECT f AS first, f + 2 AS last, 3 AS k FROM (SELECT min(year(o_orderdate)) AS lo, '
    "max(year(o_orderdate)) AS hi FROM orders), LATERAL (SELECT unnest(range(lo, hi - 1)) AS f)",
)
def year_windows(t):
    years = t.raw("orders").select(F.year("o_orderdate").alias(pooling.YEAR))
    return pooling.year_windows(years, 3).withColumnsRenamed({"from": "first", "to": "last"})


@query(
    "priority:t period_year:i first:i last:i k:i numerator:n",
    "SELECT priority, period_year, lo + f AS first, lo + f + k - 1 AS last, k, numerator FROM sums, "
    "(SELECT min(period_year) AS lo, max(period_year) AS hi FROM sums), (VALUES (3), (5)) AS v(k), "
    "range(0, 200) AS r(f) WHERE lo + f + k - 1 <= hi AND period_year BETWEEN lo + f AND lo + f + k - 1",
    sums="SELECT o_orderpriority AS priority, year(o_orderdate) AS period_year, "
    "sum(o_totalprice) AS numerator FROM orders GROUP BY ALL",
)
def expanded_windows(t):
    yearly = (
        t.raw("orders")
        .groupBy(F.col("o_orderpriority").alias("priority"), F.year("o_orderdate").alias(pooling.YEAR))
        .agg(F.sum("o_totalprice").alias("numerator"))
    )
    return pooling.expand_windows(yearly).withColumnsRenamed({"from": "first", "to": "last"})


@query(
    "status:t mode:t",
    "SELECT status, mmdd AS mode FROM (SELECT o_orderstatus AS status, strftime(o_orderdate, '%m-%d') AS mmdd, "
    "row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, strftime(o_orderdate, '%m-%d')) AS place "
    "FROM orders GROUP BY o_orderstatus, strftime(o_orderdate, '%m-%d')) WHERE place = 1",
)
def usual_day(t):
    days = t.raw("orders").select(
        F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "MM-dd").alias("mmdd")
    )
    return complete.group_mode(days, ["status"], "mmdd")


@query(
    "status:t median:n",
    "SELECT o_orderstatus AS status, median(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END) AS median "
    "FROM orders GROUP BY o_orderstatus",
)
def median_price(t):
    prices = t.raw("orders").select(
        F.col("o_orderstatus").alias("status"),
        F.expr("CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_totalprice END").alias("price"),
    )
    return complete.group_median(prices, ["status"], "price")


# rates ------------------------------------------------------------------------------------
_RATE_SPEC = (
    "indicator_id:i start_date:d imd_code:i aggregation_id:i age_group_code:i ethnicity_code:i "
    "numerator:n denominator:n value:n lowercl:n uppercl:n"
)


@query(
    _RATE_SPEC,
    f"SELECT *, {sql.RATE_VALUE} AS value, {sql.SHARE_LOWER} AS lowercl, {sql.SHARE_UPPER} AS uppercl "
    "FROM (SELECT * REPLACE (coalesce(numerator, 0) AS numerator) FROM kept) "
    "WHERE value_type_code = 2 AND denominator <> 0",
    "kept",
)
def percentage_wilson(t):
    rows = _kept(t).filter("denominator <> 0").fillna(0.0, ["numerator"])
    return standardise.calc_percentage(rows)


@query(
    _RATE_SPEC,
    f"SELECT *, {sql.RATE_VALUE} AS value, {sql.RATE_LOWER} AS lowercl, {sql.RATE_UPPER} AS uppercl "
    "FROM (SELECT * REPLACE (coalesce(numerator, 0) AS numerator) FROM kept) "
    "WHERE value_type_code IN (3, 7) AND denominator <> 0",
    "kept",
)
def crude_rate_and_ratio(t):
    return standardise.calc_crude_or_ratio(_kept(t).filter("denominator <> 0"))


@query(
    "indicator_id:i start_date:d imd_code:i aggregation_id:i ethnicity_code:i total_count:n total_pop:n "
    "base_value:n multiplier:n value:n lowercl:n uppercl:n statistic:t method:t confidence:t",
    f"SELECT *, base_value * multiplier AS value, {sql.DASR_LOWER} AS lowercl, {sql.DASR_UPPER} AS uppercl, "
    "'dsr per 100000' AS statistic, 'Dobson' AS method, '95%' AS confidence FROM totals",
    "kept",
    totals=f"SELECT {sql.DASR_GROUP}, {sql.TOTALS} FROM (SELECT *, numerator AS x, denominator AS n, "
    f"{sql.weight('age_group_code')} AS w FROM kept WHERE value_type_code = 4) "
    f"WHERE w IS NOT NULL GROUP BY {sql.DASR_GROUP}",
)
def standardised_rate(t):
    rows = lookup.with_stdpop(_kept(t).filter("value_type_code = 4"))
    return standardise.dsr(standardise.dsr_validate(rows)[0], DASR_KEYS)


# `nation` groups of customers by age class, as input of the standardisation itself.
_NATION_BANDS = (
    "SELECT c_nationkey AS nation, CAST(c_custkey % 18 + 1 AS INT) AS band, "
    "CAST(count(*) FILTER (WHERE c_acctbal < 2000) AS DOUBLE) AS x, CAST(count(*) * 10 AS DOUBLE) AS n "
    "FROM customer GROUP BY ALL"
)


def _nation_bands(t: Tables) -> DataFrame:
    grouped = t.raw("customer").groupBy(
        F.col("c_nationkey").alias("nation"), F.expr("CAST(c_custkey % 18 + 1 AS INT)").alias("band")
    )
    counted = grouped.agg(
        F.count_if(F.col("c_acctbal") < 2000).cast("double").alias("x"),
        (F.count(F.lit(1)) * 10).cast("double").alias("n"),
    )
    return counted.withColumn("w", lookup.standard_population(F.col("band")))


_Z998 = sql.z_value(0.998)
_B95, _B998 = sql.byars("total_count"), sql.byars("total_count", _Z998)


@query(
    "nation:i base_value:n multiplier:n total_count:n total_pop:n value:n lower95_0cl:n upper95_0cl:n "
    "lower99_8cl:n upper99_8cl:n",
    f"SELECT *, base_value * multiplier AS value, {sql.dobson(_B95[0])} AS lower95_0cl, "
    f"{sql.dobson(_B95[1])} AS upper95_0cl, {sql.dobson(_B998[0])} AS lower99_8cl, "
    f"{sql.dobson(_B998[1])} AS upper99_8cl FROM totals",
    bands=_NATION_BANDS,
    totals=f"SELECT nation, {sql.TOTALS} FROM (SELECT *, {sql.weight('band')} AS w, 1000.0 AS multiplier "
    "FROM bands) GROUP BY nation",
)
def standardised_two_levels(t):
    return standardise.dsr(
        _nation_bands(t), ["nation"], "x", "n", "w", multiplier=1000, confidence=(95, 99.8), kind="standard"
    )


@query(
    "nation:i base_value:n multiplier:n uppercl:n",
    f"SELECT *, {sql.DASR_UPPER} AS uppercl FROM totals",
    bands=_NATION_BANDS,
    totals=f"SELECT nation, {sql.TOTALS} FROM (SELECT *, {sql.weight('band')} AS w, 100000.0 AS multiplier "
    "FROM bands) GROUP BY nation",
)
def standardised_upper_limit(t):
    return standardise.dsr(_nation_bands(t), ["nation"], "x", "n", "w", multiplier=1e5, kind="upper")


@query(
    "nation:i total_count:n total_pop:n value:n lowercl:n uppercl:n method:t",
    f"SELECT *, base_value * multiplier AS value, {sql.DASR_LOWER} AS lowercl, {sql.DASR_UPPER} AS uppercl, "
    "'Dobson, with confidence adjusted for non-independent events' AS method FROM totals JOIN spread USING (nation)",
    people="SELECT c_nationkey AS nation, CAST(c_custkey % 18 + 1 AS INT) AS band, "
    "CAST(c_custkey % 3 + 1 AS INT) AS freq, CAST(count(*) FILTER (WHERE c_acctbal < 2000) AS DOUBLE) AS x "
    "FROM customer GROUP BY ALL",
    sized=f"SELECT *, CAST(1000 + 10 * band AS DOUBLE) AS n, {sql.weight('band')} AS w, 100000.0 AS multiplier FROM people",
    spread="SELECT nation, sum(v * freq * freq) AS vardsr FROM (SELECT nation, freq, "
    "sum(x * pow(w / n, 2)) / pow(sum(w), 2) AS v FROM sized GROUP BY nation, freq) GROUP BY nation",
    events="SELECT nation, band, n, w, sum(freq * x) AS x, max(multiplier) AS multiplier FROM sized GROUP BY nation, band, n, w",
    totals="SELECT nation, sum(x) AS total_count, sum(n) AS total_pop, sum(x * w / n) / sum(w) AS base_value, "
    "max(multiplier) AS multiplier FROM events GROUP BY nation",
)
def standardised_dependent_events(t):
    grouped = t.raw("customer").groupBy(
        F.col("c_nationkey").alias("nation"),
        F.expr("CAST(c_custkey % 18 + 1 AS INT)").alias("band"),
        F.expr("CAST(c_custkey % 3 + 1 AS INT)").alias("freq"),
    )
    people = grouped.agg(F.count_if(F.col("c_acctbal") < 2000).cast("double").alias("x"))
    sized = people.withColumns(
        {
            "n": (1000 + 10 * F.col("band")).cast("double"),
            "w": lookup.standard_population(F.col("band")),
        }
    )
    return standardise.dsr(
        sized, ["nation"], "x", "n", "w", multiplier=1e5, event_freq="freq", age_band="band"
    )


@query(
    "indicator_id:i age_group_code:i numerator:n denominator:n faults:t",
    "SELECT *, 'missing standard population' AS faults FROM weighted WHERE w IS NULL",
    "weighted",
)
def standardisation_faults(t):
    return _result(t).rejected


@query(
    "band:i n_varies:b",
    "SELECT band, TRUE AS n_varies FROM bands GROUP BY band HAVING count(DISTINCT n) > 1",
    bands=_NATION_BANDS,
)
def varying_populations(t):
    return standardise.constancy_violations(_nation_bands(t), ["band"], ["n"])


# `nation` groups of which some hold each fault of a standardised rate.
_FAULTY_SQL = (
    "SELECT nation, band, CASE WHEN nation = 3 AND band = 4 THEN -1.0 ELSE x END AS x, "
    "CASE WHEN nation = 5 AND band = 6 THEN NULL WHEN nation = 7 AND band = 8 THEN 0.0 ELSE n END AS n, "
    f"CASE WHEN nation = 9 AND band = 1 THEN NULL ELSE {sql.weight('band')} END AS w, "
    "CASE WHEN nation = 11 AND band > 9 THEN 1000.0 WHEN nation = 13 AND band = 2 THEN NULL ELSE 100000.0 END AS multiplier "
    "FROM bands"
)


def _faulty(t: Tables) -> DataFrame:
    return _nation_bands(t).selectExpr(
        "nation", "band", "CASE WHEN nation = 3 AND band = 4 THEN -1D ELSE x END AS x",
        "CASE WHEN nation = 5 AND band = 6 THEN NULL WHEN nation = 7 AND band = 8 THEN 0D ELSE n END AS n",
        "CASE WHEN nation = 9 AND band = 1 THEN NULL ELSE w END AS w",
        "CASE WHEN nation = 11 AND band > 9 THEN 1000D WHEN nation = 13 AND band = 2 THEN NULL ELSE 100000D END AS multiplier",
    )


_FAULT_FLAGS = (
    "concat_ws('; ', CASE WHEN bool_or(n IS NULL) THEN 'missing denominator' END, "
    "CASE WHEN bool_or(w IS NULL) THEN 'missing standard population' END, "
    "CASE WHEN bool_or(multiplier IS NULL) THEN 'missing multiplier' END, "
    "CASE WHEN bool_or(coalesce(x < 0, FALSE)) THEN 'negative numerator' END, "
    "CASE WHEN bool_or(coalesce(n <= 0, FALSE)) THEN 'denominator not positive' END, "
    "CASE WHEN min(multiplier) <> max(multiplier) THEN 'several multipliers' END"
)


@query(
    "nation:i value:n faults:t",
    "SELECT nation, CASE WHEN faults = '' THEN base_value * multiplier END AS value, faults FROM totals",
    bands=_NATION_BANDS,
    faulty=_FAULTY_SQL,
    totals=f"SELECT nation, {sql.TOTALS}, {_FAULT_FLAGS}) AS faults FROM faulty GROUP BY nation",
)
def standardised_rejects(t):
    rates, rejects = standardise.dsr_checked(_faulty(t), ["nation"], "x", "n", "w", kind="value")
    return rates.select("nation", "value", F.lit("").alias("faults")).unionByName(
        rejects, allowMissingColumns=True
    )


_FAULTY_PEOPLE = {
    "people": "SELECT c_nationkey AS nation, CAST(c_custkey % 18 + 1 AS INT) AS band, "
    "CAST(c_custkey % 3 + 1 AS INT) AS freq, CAST(count(*) FILTER (WHERE c_acctbal < 2000) AS DOUBLE) AS x "
    "FROM customer GROUP BY ALL",
    "sized": "SELECT nation, CASE WHEN nation = 2 AND band = 3 THEN NULL ELSE band END AS band, "
    "CASE WHEN nation = 4 AND band = 5 THEN NULL ELSE freq END AS freq, x, "
    "CAST(1000 + 10 * band + CASE WHEN nation = 6 AND freq = 2 THEN 1 ELSE 0 END AS DOUBLE) AS n, "
    f"CASE WHEN nation = 8 AND freq = 1 THEN 1.0 ELSE {sql.weight('band')} END AS w, "
    "CASE WHEN nation = 10 AND band = 7 THEN 1000.0 ELSE 100000.0 END AS multiplier FROM people",
}


@query(
    "nation:i value:n faults:t",
    "SELECT nation, CASE WHEN faults = '' THEN base_value * multiplier END AS value, faults FROM totals",
    **_FAULTY_PEOPLE,
    events="SELECT nation, band, max(n) AS n, max(w) AS w, sum(freq * x) AS x, max(multiplier) AS multiplier, "
    "min(multiplier) AS least, bool_or(freq IS NULL) AS no_freq, min(n) <> max(n) AS n_varies, min(w) <> max(w) AS w_varies "
    "FROM sized GROUP BY nation, band",
    totals="SELECT nation, sum(x * w / n) / sum(w) AS base_value, max(multiplier) AS multiplier, concat_ws('; ', "
    "CASE WHEN min(least) <> max(multiplier) THEN 'several multipliers' END, "
    "CASE WHEN bool_or(no_freq) THEN 'missing event frequency' END, CASE WHEN bool_or(band IS NULL) THEN 'missing age band' END, "
    "CASE WHEN bool_or(n_varies) THEN 'several populations in an age band' END, "
    "CASE WHEN bool_or(w_varies) THEN 'several standard populations in an age band' END) AS faults FROM events GROUP BY nation",
)
def standardised_dependent_rejects(t):
    grouped = t.raw("customer").groupBy(
        F.col("c_nationkey").alias("nation"),
        F.expr("CAST(c_custkey % 18 + 1 AS INT)").alias("band"),
        F.expr("CAST(c_custkey % 3 + 1 AS INT)").alias("freq"),
    )
    people = grouped.agg(F.count_if(F.col("c_acctbal") < 2000).cast("double").alias("x"))
    weighted = people.withColumn("weight", lookup.standard_population(F.col("band")))
    sized = weighted.selectExpr(
        "nation", "CASE WHEN nation = 2 AND band = 3 THEN NULL ELSE band END AS band",
        "CASE WHEN nation = 4 AND band = 5 THEN NULL ELSE freq END AS freq", "x",
        "CAST(1000 + 10 * band + CASE WHEN nation = 6 AND freq = 2 THEN 1 ELSE 0 END AS DOUBLE) AS n",
        "CASE WHEN nation = 8 AND freq = 1 THEN 1D ELSE weight END AS w",
        "CASE WHEN nation = 10 AND band = 7 THEN 1000D ELSE 100000D END AS multiplier",
    )
    rates, rejects = standardise.dsr_checked(
        sized, ["nation"], "x", "n", "w", event_freq="freq", age_band="band", kind="value"
    )
    return rates.select("nation", "value", F.lit("").alias("faults")).unionByName(
        rejects, allowMissingColumns=True
    )


# the whole calculation ----------------------------------------------------------------------
@query(
    "route:t indicator_id:i time_period_type:t row_count:i",
    "SELECT route, indicator_id, time_period_type, count(*) AS row_count FROM "
    "(SELECT CASE WHEN NOT (indicator_value IS NULL AND coalesce(denominator <> 0, FALSE)) THEN 'keep' "
    "WHEN multiplier IS NULL OR NOT coalesce(status_code IN (1, 2), FALSE) OR value_type_code IS NULL THEN 'skip' "
    "WHEN value_type_code = 2 THEN 'percentage' WHEN value_type_code IN (3, 7) THEN 'rate' "
    "WHEN value_type_code = 4 THEN 'dasr' ELSE 'unsupported' END AS route, * FROM kept) GROUP BY ALL",
    "kept",
)
def eligibility_routes(t):
    return _routed(t).groupBy("route", "indicator_id", "time_period_type").agg(
        F.count(F.lit(1)).alias("row_count")
    )


@query(TIDY_SPEC, "SELECT * FROM combined", "combined")
def calculated_values(t):
    return _result(t).combined


@query(
    TIDY_SPEC + " insertion_date_time:s",
    f"SELECT *, TIMESTAMP '{LOADED}' AS insertion_date_time FROM combined",
    "combined",
)
def processed_values(t):
    return calculate.processed_rows(_result(t).combined, LOADED)


@query(TIDY_SPEC, "SELECT * FROM row_results WHERE route = 'keep'", "row_results")
def kept_rows(t):
    return _result(t).keep


@query(TIDY_SPEC, "SELECT * FROM row_results WHERE route = 'skip'", "row_results")
def skipped_rows(t):
    return _result(t).skip


@query(TIDY_SPEC, "SELECT * FROM routed WHERE route = 'unsupported'", "routed")
def unsupported_rows(t):
    return _result(t).unsupported


@query(TIDY_SPEC, "SELECT * FROM dasr_results", "dasr_results")
def dasr_rows(t):
    return _result(t).dasr


@query(
    "indicator_id:i status_code:i reasons:t",
    "SELECT indicator_id, status_code, concat_ws('; ', "
    "CASE WHEN bool_or(multiplier IS NULL) THEN 'missing multiplier' END, "
    "CASE WHEN bool_or(route = 'skip' AND coalesce(status_code <> 1, TRUE)) "
    "THEN 'status_code = ' || coalesce(CAST(status_code AS VARCHAR), 'NA') END, "
    "CASE WHEN bool_or(value_type_code IS NULL) THEN 'missing value_type_code' END, "
    "CASE WHEN bool_or(route = 'unsupported') THEN 'unsupported value_type_code' END) AS reasons "
    "FROM routed WHERE route IN ('skip', 'unsupported') GROUP BY indicator_id, status_code",
    "routed",
)
def skip_reasons(t):
    return _result(t).skip_reasons


# quality ------------------------------------------------------------------------------------
# Processed facts that never divide by zero, plus values left out on purpose.
_CHECKED = (
    "SELECT * REPLACE (CASE WHEN aggregation_id = 7 THEN NULL ELSE lower_ci95 END AS lower_ci95, "
    "CASE WHEN aggregation_id = 7 THEN 0 ELSE age_group_code END AS age_group_code, "
    "CASE WHEN aggregation_id = 7 THEN NULL ELSE combination_id END AS combination_id, "
    "CASE WHEN aggregation_id = 7 THEN NULL ELSE time_period_type END AS time_period_type) FROM combined"
)


def _published(t: Tables) -> DataFrame:
    """The published table, which the checks read."""
    return stage(_result(t).combined, TIDY_SCHEMA)


def _with_faults(published: DataFrame) -> DataFrame:
    """The published rows, those of one area with values left out and another age code."""
    faulty = F.coalesce(F.col("aggregation_id") == 7, F.lit(False))
    faults = {c: F.when(~faulty, F.col(c)) for c in ("lower_ci95", "combination_id", "time_period_type")}
    faults["age_group_code"] = F.when(faulty, F.lit(0)).otherwise(F.col("age_group_code"))
    return published.withColumns(faults).select(published.columns)


def _checked(t: Tables) -> DataFrame:
    return _with_faults(_published(t))


@query(
    "input_rows:i reference_rows:i passed:b",
    "SELECT (SELECT count(*) FROM combined) AS input_rows, (SELECT count(*) FROM facts) AS reference_rows, "
    "(SELECT count(*) FROM combined) = (SELECT count(*) FROM facts) AS passed",
    "combined",
)
def check_row_counts(t):
    return quality.check_row_counts(_published(t), t.facts())


_MISSING = " OR ".join(
    f"{c} IS NULL" for c in sql.TIDY.split(", ") if c not in ("numerator", "denominator")
)
_ACTIVE = "indicator_id IN (SELECT indicator_id FROM metadata WHERE status_code = 1"


@query(
    TIDY_SPEC,
    f"SELECT * FROM checked WHERE denominator <> 0 AND ({_MISSING}) AND {_ACTIVE} AND precalculated = 'No')",
    "combined metadata",
    checked=_CHECKED,
)
def check_missing_columns(t):
    return quality.check_missing(_checked(t), t.metadata())


@query(
    "indicator_id:i count:i",
    "SELECT indicator_id, count(*) AS count FROM (SELECT DISTINCT indicator_id, age_group_code FROM checked "
    "WHERE value_type_code = 4) GROUP BY indicator_id HAVING count(*) > 1",
    "combined",
    checked=_CHECKED,
)
def check_age_codes(t):
    return quality.check_age_group_code(_checked(t))


@query(
    "indicator_id:i start_date:d end_date:d",
    "SELECT DISTINCT indicator_id, start_date, end_date FROM checked WHERE time_period_type IS NULL",
    "combined",
    checked=_CHECKED,
)
def check_period_labels(t):
    return quality.check_time_period(_checked(t))


@query(
    TIDY_SPEC,
    "SELECT * FROM checked WHERE denominator <> 0 AND (indicator_value IS NULL OR lower_ci95 IS NULL "
    f"OR upper_ci95 IS NULL) AND {_ACTIVE})",
    "combined metadata",
    checked=_CHECKED,
)
def check_active_values(t):
    return quality.check_active_values(_checked(t), t.metadata())


@query(TIDY_SPEC, "SELECT * FROM checked WHERE combination_id IS NULL", "combined", checked=_CHECKED)
def check_combinations(t):
    return quality.check_combination(_checked(t))


@query(
    "indicator_id:i time_period_type:t aggregation_id:i start_date:d end_date:d imd_code:i "
    "ethnicity_code:i row_count:i",
    "SELECT indicator_id, time_period_type, aggregation_id, start_date, end_date, imd_code, ethnicity_code, "
    "count(*) AS row_count FROM combined GROUP BY ALL HAVING count(*) > 1",
    "combined",
)
def check_duplicates(t):
    return quality.check_duplicates(_published(t))


@query(
    "check_id:i check_name:t failures:i passed:b",
    "SELECT *, failures = 0 AS passed FROM ("
    "SELECT 1 AS check_id, 'row counts' AS check_name, abs((SELECT count(*) FROM checked) - (SELECT count(*) FROM facts)) AS failures "
    f"UNION ALL SELECT 2, 'missing columns', count(*) FROM checked WHERE denominator <> 0 AND ({_MISSING}) AND {_ACTIVE} AND precalculated = 'No') "
    "UNION ALL SELECT 3, 'one age code', count(*) FROM (SELECT indicator_id FROM checked WHERE value_type_code = 4 "
    "GROUP BY indicator_id HAVING count(DISTINCT coalesce(age_group_code, -1)) > 1) "
    "UNION ALL SELECT 4, 'time period', count(*) FROM (SELECT DISTINCT indicator_id, start_date, end_date FROM checked WHERE time_period_type IS NULL) "
    "UNION ALL SELECT 5, 'active values', count(*) FROM checked WHERE denominator <> 0 AND (indicator_value IS NULL OR lower_ci95 IS NULL "
    f"OR upper_ci95 IS NULL) AND {_ACTIVE}) "
    "UNION ALL SELECT 6, 'combination', count(*) FROM checked WHERE combination_id IS NULL "
    "UNION ALL SELECT 7, 'duplicates', count(*) FROM (SELECT indicator_id FROM checked GROUP BY indicator_id, time_period_type, "
    "aggregation_id, start_date, end_date, imd_code, ethnicity_code HAVING count(*) > 1))",
    "combined metadata facts",
    checked=_CHECKED,
)
def all_checks(t):
    landed, rows = stage_counted(t.facts(), FACT_SCHEMA)
    result = calculate.calculate_values(landed, t.metadata(), t.ages(), AS_OF)
    return quality.run_all_checks(_with_faults(stage(result.combined, TIDY_SCHEMA)), rows, t.metadata())


_ORDER = ", ".join(f"{c} NULLS FIRST" for c in TIDY_COLS)
_FAILING = {
    (2, "missing columns"): f"denominator <> 0 AND ({_MISSING}) AND {_ACTIVE} AND precalculated = 'No')",
    (4, "time period"): "time_period_type IS NULL",
    (5, "active values"): f"denominator <> 0 AND (indicator_value IS NULL OR lower_ci95 IS NULL OR upper_ci95 IS NULL) AND {_ACTIVE})",
    (6, "combination"): "combination_id IS NULL",
}


@query(
    "check_id:i check_name:t nth:i " + TIDY_SPEC,
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT {i} AS check_id, '{name}' AS check_name, row_number() OVER (ORDER BY {_ORDER}) AS nth, * "
        f"FROM checked WHERE {failing}) WHERE nth <= 10"
        for (i, name), failing in _FAILING.items()
    ),
    "combined metadata",
    checked=_CHECKED,
)
def failing_rows(t):
    return quality.failing_rows(_checked(t), t.metadata(), show_n=10)
