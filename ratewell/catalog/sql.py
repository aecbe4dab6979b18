"""Pieces of SQL shared by the counterparts of several queries."""

from __future__ import annotations

from ratewell.catalog.tables import AS_OF, CTES
from ratewell.functions.intervals import exact_poisson_table, z_value
from ratewell.schema import ESP2013, FACT_COLS, POOL_KEYS

Z = z_value(0.95)
DAY = f"DATE '{AS_OF}'"


def wilson(x: str, n: str) -> tuple[str, str]:
    spread = f"{Z} * sqrt({Z * Z} + 4 * ({x}) * (1 - ({x}) / ({n})))"
    base = f"(2 * (({n}) + {Z * Z}))"
    return (
        f"((2 * ({x}) + {Z * Z} - {spread}) / {base})",
        f"((2 * ({x}) + {Z * Z} + {spread}) / {base})",
    )


def byars(x: str, z: float = Z) -> tuple[str, str]:
    low = (
        f"CASE WHEN ({x}) > 0 THEN ({x}) * pow(1 - 1 / (9.0 * ({x})) - {z} / (3 * sqrt({x})), 3) END"
    )
    high = f"(({x}) + 1) * pow(1 - 1 / (9.0 * (({x}) + 1)) + {z} / (3 * sqrt(({x}) + 1)), 3)"
    return f"({low})", f"({high})"


def poisson(x: str) -> tuple[str, str]:
    parts = []
    for table, large in zip(exact_poisson_table(), byars(x)):
        arms = " ".join(f"WHEN {i} THEN CAST({v!r} AS DOUBLE)" for i, v in enumerate(table))
        parts.append(f"(CASE CAST({x} AS INT) {arms} ELSE {large} END)")
    return tuple(parts)


def weight(code: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {float(w)}" for i, w in enumerate(ESP2013, start=1))
    return f"(CASE {code} {arms} END)"


def label(start: str = "start_date", end: str = "end_date") -> str:
    arms = " ".join(
        f"WHEN {end} IN (CAST({start} + INTERVAL {n} YEAR AS DATE), "
        f"CAST({start} + INTERVAL {n} YEAR AS DATE) - 1) THEN '{text}'"
        for n, text in ((1, "1 year"), (3, "3 year pooled"), (5, "5 year pooled"))
    )
    return f"CASE {arms} END"


COMBINATION = (
    "CASE WHEN imd_code IS NULL OR ethnicity_code IS NULL THEN NULL "
    "WHEN imd_code <> 999 AND ethnicity_code <> 999 THEN 1 WHEN imd_code <> 999 THEN 2 "
    "WHEN ethnicity_code <> 999 THEN 3 ELSE 4 END"
)
KEYS = ", ".join(POOL_KEYS)
META = "age, year_type, multiplier, status_code, population_type"
RESULTS = "indicator_value, lower_ci95, upper_ci95"
TIDY = ", ".join(FACT_COLS) + ", time_period_type, combination_id"


def cycles(source: str) -> dict[str, str]:
    """CTEs past, typical, closing and flagged over the rows of ``source``."""
    return {
        "past": "SELECT lower(year_type) AS yt, lower(time_period_type) AS tp, "
        "strftime(end_date, '%m-%d') AS mmdd, datediff('day', start_date, end_date) + 1 AS days "
        f"FROM {source} WHERE end_date <= {DAY}",
        "typical": "SELECT yt, tp, median(days) AS usual FROM past GROUP BY yt, tp",
        "closing": "SELECT yt, tp, mmdd FROM (SELECT yt, tp, mmdd, row_number() OVER "
        "(PARTITION BY yt, tp ORDER BY count(*) DESC, mmdd) AS place FROM past "
        "GROUP BY yt, tp, mmdd) WHERE place = 1",
        "flagged": "SELECT s.*, coalesce(end_date <= CASE WHEN TRY_CAST(year("
        + DAY + f") || '-' || coalesce(mmdd, '12-31') AS DATE) <= {DAY} "
        f"THEN TRY_CAST(year({DAY}) || '-' || coalesce(mmdd, '12-31') AS DATE) "
        f"ELSE TRY_CAST((year({DAY}) - 1) || '-' || coalesce(mmdd, '12-31') AS DATE) END, FALSE) "
        "AND coalesce(abs(datediff('day', start_date, end_date) + 1 - usual) <= 5, TRUE) AS is_kept "
        f"FROM {source} s LEFT JOIN typical t ON lower(s.year_type) IS NOT DISTINCT FROM t.yt "
        "AND lower(s.time_period_type) IS NOT DISTINCT FROM t.tp "
        "LEFT JOIN closing c ON lower(s.year_type) IS NOT DISTINCT FROM c.yt "
        "AND lower(s.time_period_type) IS NOT DISTINCT FROM c.tp",
    }


CTES.update(
    {
        "labelled": (
            "facts",
            f"SELECT *, {label()} AS time_period_type, {COMBINATION} AS combination_id FROM facts",
        ),
        "enriched": (
            "labelled metadata",
            f"SELECT l.*, {META} FROM labelled l LEFT JOIN metadata m "
            "ON l.indicator_id IS NOT DISTINCT FROM m.indicator_id",
        ),
    }
)
for _name, _body in cycles("enriched").items():
    _needs = {"past": "enriched", "typical": "past", "closing": "past", "flagged": "enriched typical closing"}
    CTES[_name] = (_needs[_name], _body)
CTES.update(
    {
        "kept": ("flagged", "SELECT * EXCLUDE (is_kept) FROM flagged WHERE is_kept"),
        "yearly": (
            "kept",
            f"SELECT {KEYS}, year_type, year(start_date) AS period_year, "
            "coalesce(sum(numerator), 0) AS numerator, coalesce(sum(denominator), 0) AS denominator "
            "FROM kept WHERE population_type = 'Census' AND year_type IN ('Calendar', 'Financial') "
            f"AND start_date IS NOT NULL GROUP BY {KEYS}, year_type, year(start_date)",
        ),
        "windows": (
            "yearly",
            "SELECT CAST(f AS INT) AS first, CAST(f + k - 1 AS INT) AS last, k FROM "
            "(SELECT min(period_year) AS lo, max(period_year) AS hi FROM yearly), "
            "(VALUES (3), (5)) AS v(k), LATERAL (SELECT unnest(range(lo, hi - k + 2)) AS f)",
        ),
        "pooled": (
            "yearly windows",
            "SELECT indicator_id, "
            "CASE WHEN year_type = 'Calendar' THEN make_date(first, 1, 1) ELSE make_date(first, 4, 1) END AS start_date, "
            "CASE WHEN year_type = 'Calendar' THEN make_date(last, 12, 31) ELSE make_date(last + 1, 3, 31) END AS end_date, "
            "sum(numerator) AS numerator, sum(denominator) AS denominator, "
            "CAST(NULL AS DOUBLE) AS indicator_value, CAST(NULL AS DOUBLE) AS lower_ci95, "
            "CAST(NULL AS DOUBLE) AS upper_ci95, imd_code, aggregation_id, age_group_code, sex_code, "
            "ethnicity_code, creation_date, value_type_code, source_code, "
            "k || ' year pooled' AS time_period_type, combination_id "
            "FROM yearly JOIN windows ON period_year BETWEEN first AND last "
            f"GROUP BY {KEYS}, year_type, first, last, k",
        ),
        "every": (
            "pooled kept metadata",
            f"SELECT {TIDY}, {META} FROM pooled LEFT JOIN metadata USING (indicator_id) "
            f"UNION ALL SELECT {TIDY}, {META} FROM kept",
        ),
        "indicator_age": (
            "metadata ages",
            "SELECT indicator_id, min(age_code) AS age_code FROM metadata m "
            "LEFT JOIN ages a ON m.age IS NOT DISTINCT FROM a.age_group_label GROUP BY indicator_id",
        ),
        "routed": (
            "every indicator_age",
            "SELECT e.*, age_code, CASE "
            "WHEN NOT (indicator_value IS NULL AND coalesce(denominator <> 0, FALSE)) THEN 'keep' "
            "WHEN multiplier IS NULL OR NOT coalesce(status_code IN (1, 2), FALSE) "
            "OR value_type_code IS NULL THEN 'skip' "
            "WHEN value_type_code = 2 THEN 'percentage' WHEN value_type_code IN (3, 7) THEN 'rate' "
            "WHEN value_type_code = 4 THEN 'dasr' ELSE 'unsupported' END AS route "
            "FROM every e LEFT JOIN indicator_age USING (indicator_id)",
        ),
    }
)

_W = wilson("coalesce(numerator, 0)", "denominator")
_P = poisson("abs(coalesce(numerator, 0))")
_RATE_LOW, _RATE_HIGH = (f"({p} / denominator * multiplier)" for p in _P)
RATE_VALUE = "(coalesce(numerator, 0) / denominator * multiplier)"
RATE_LOWER = f"(CASE WHEN numerator < 0 THEN -{_RATE_HIGH} ELSE {_RATE_LOW} END)"
RATE_UPPER = f"(CASE WHEN numerator < 0 THEN -{_RATE_LOW} ELSE {_RATE_HIGH} END)"
SHARE_LOWER, SHARE_UPPER = (f"({w} * multiplier)" for w in _W)
_LOW, _HIGH = byars("total_count")


def dobson(limit: str) -> str:
    return (
        f"((base_value + sqrt(vardsr / nullif(total_count, 0)) * ({limit} - total_count)) * multiplier)"
    )


DASR_LOWER, DASR_UPPER = dobson(_LOW), dobson(_HIGH)
DASR_GROUP = (
    "indicator_id, start_date, end_date, imd_code, aggregation_id, sex_code, ethnicity_code, "
    "creation_date, value_type_code, source_code, time_period_type, combination_id"
)
TOTALS = (
    "coalesce(sum(x), 0) AS total_count, sum(n) AS total_pop, "
    "sum(coalesce(x, 0) * w / n) / sum(w) AS base_value, "
    "sum(coalesce(x, 0) * pow(w / n, 2)) / pow(sum(w), 2) AS vardsr, max(multiplier) AS multiplier"
)
CTES.update(
    {
        "row_results": (
            "routed",
            "SELECT route, indicator_id, start_date, end_date, "
            "CASE WHEN route IN ('percentage', 'rate') THEN coalesce(numerator, 0) ELSE numerator END AS numerator, "
            "coalesce(denominator, 0) AS denominator, "
            f"CASE route WHEN 'percentage' THEN {RATE_VALUE} WHEN 'rate' THEN {RATE_VALUE} ELSE indicator_value END AS indicator_value, "
            f"CASE route WHEN 'percentage' THEN {SHARE_LOWER} WHEN 'rate' THEN {RATE_LOWER} ELSE lower_ci95 END AS lower_ci95, "
            f"CASE route WHEN 'percentage' THEN {SHARE_UPPER} WHEN 'rate' THEN {RATE_UPPER} ELSE upper_ci95 END AS upper_ci95, "
            "imd_code, aggregation_id, "
            "CASE WHEN route IN ('percentage', 'rate') THEN age_group_code ELSE age_code END AS age_group_code, "
            "sex_code, ethnicity_code, creation_date, value_type_code, source_code, time_period_type, combination_id "
            "FROM routed WHERE route IN ('keep', 'skip', 'percentage', 'rate')",
        ),
        "weighted": (
            "routed",
            f"SELECT *, numerator AS x, denominator AS n, {weight('age_group_code')} AS w "
            "FROM routed WHERE route = 'dasr'",
        ),
        "dasr_totals": (
            "weighted",
            f"SELECT {DASR_GROUP}, {TOTALS} FROM weighted WHERE w IS NOT NULL AND n > 0 "
            f"GROUP BY {DASR_GROUP}",
        ),
        "dasr_results": (
            "dasr_totals indicator_age",
            "SELECT indicator_id, start_date, end_date, total_count AS numerator, total_pop AS denominator, "
            f"base_value * multiplier AS indicator_value, {DASR_LOWER} AS lower_ci95, {DASR_UPPER} AS upper_ci95, "
            "imd_code, aggregation_id, age_code AS age_group_code, sex_code, ethnicity_code, creation_date, "
            "value_type_code, source_code, time_period_type, combination_id "
            "FROM dasr_totals LEFT JOIN indicator_age USING (indicator_id)",
        ),
        "combined": (
            "row_results dasr_results",
            f"SELECT {TIDY} FROM row_results UNION ALL SELECT {TIDY} FROM dasr_results",
        ),
    }
)
