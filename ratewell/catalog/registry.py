"""Registration of a query with its output columns and its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.catalog.tables import CTES, Tables

FACT_SPEC = (
    "indicator_id:i start_date:d end_date:d numerator:n denominator:n indicator_value:n "
    "lower_ci95:n upper_ci95:n imd_code:i aggregation_id:i age_group_code:i sex_code:i "
    "ethnicity_code:i creation_date:s value_type_code:i source_code:i"
)
TIDY_SPEC = FACT_SPEC + " time_period_type:t combination_id:i"


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    columns: list[tuple[str, str]]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(
    spec: str, sql: str | None = None, uses: str = "", **steps: str
) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function under its name.

    ``spec`` lists ``column:kind`` (i whole number, n number, d date, s time, t text, b flag).
    ``uses`` names inputs of ``CTES``; ``steps`` are further CTEs of the SQL, in order.
    """
    columns = [tuple(item.split(":")) for item in spec.split()]

    def register(build: Callable[[Tables], DataFrame]):
        text = None if sql is None else _statement(sql, columns, uses, steps)
        QUERIES[build.__name__] = Query(build, columns, text)
        return build

    return register


def inputs(uses: str) -> dict[str, str]:
    """The named CTEs after everything they need."""
    found: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in found:
            needs, body = CTES[name]
            for other in needs.split():
                add(other)
            found[name] = body

    for name in uses.split():
        add(name)
    return found


def _statement(sql: str, columns: list[tuple[str, str]], uses: str, steps: dict[str, str]) -> str:
    parts = {**inputs(uses), **steps, "answer": sql}
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    shape = {
        "i": "CAST({c} AS BIGINT)",
        "n": "CASE WHEN round(CAST({c} AS DOUBLE), 6) = 0 THEN 0.0 "
        "ELSE round(CAST({c} AS DOUBLE), 6) END",
        "d": "strftime(CAST({c} AS DATE), '%Y-%m-%d')",
        "s": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S')",
        "t": "CAST({c} AS VARCHAR)",
        "b": "CAST({c} AS BOOLEAN)",
    }
    listed = ", ".join(f"{shape[kind].format(c=name)} AS {name}" for name, kind in columns)
    return f"WITH {ctes}\nSELECT {listed} FROM answer"


def _shown(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind == "i":
        return c.cast("bigint")
    if kind == "n":
        rounded = F.round(c.cast("double"), 6)
        return F.when(rounded == 0, F.lit(0.0)).otherwise(rounded)
    if kind == "d":
        return F.date_format(c, "yyyy-MM-dd")
    if kind == "s":
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("boolean" if kind == "b" else "string")


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    found = QUERIES[name]
    answer = found.build(Tables(spark, folder))
    return answer.select(*[_shown(c, kind).alias(c) for c, kind in found.columns])
