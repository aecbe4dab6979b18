"""Writes: whole tables, appended facts, results replaced per indicator, dated extracts."""

from __future__ import annotations

import json
from datetime import date
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.operators.select import IndicatorIds, normalise_ids
from ratewell.schema import FACT_COLS
from ratewell.staging import stage

LOAD_KEYS = ["load_id", "indicator_id"]


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a whole table."""
    df.write.mode("overwrite").parquet(path)


def append_fact(df: DataFrame, path: str) -> None:
    """Append coded rows in the landing layout."""
    df.select(FACT_COLS).write.mode("append").partitionBy("indicator_id").parquet(path)


def create_results(df: DataFrame, table: str) -> None:
    """Create the results: a view ``table`` over ``table_loads``, which holds every load by indicator.

    A load is written under an id of its own, which the view doesn't show before the load is complete.
    """
    load = uuid4().hex
    rows = _with_load(df, load)
    rows.write.partitionBy(*LOAD_KEYS).format("parquet").saveAsTable(f"{table}_loads")
    _switch(df.sparkSession, table, {load: []})


def drop_results(spark: SparkSession, table: str) -> None:
    """Remove the view and all loads."""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    spark.sql(f"DROP TABLE IF EXISTS {table}_loads")


def _with_load(df: DataFrame, load: str) -> DataFrame:
    """The rows with their load; few files per indicator, Spark splits one that holds much of the data."""
    values = [c for c in df.columns if c != "indicator_id"]
    return df.select(*values, F.lit(load).alias("load_id"), "indicator_id").hint("rebalance", "indicator_id")


def _write(df: DataFrame, table: str) -> str:
    """Write the rows as a load of their own, which nobody sees yet."""
    load = uuid4().hex
    _with_load(df.select(df.sparkSession.table(table).columns), load).write.insertInto(f"{table}_loads")
    return load


def _loads(spark: SparkSession, table: str) -> dict[str, list[int]]:
    """The loads that the view shows, with the indicators that later loads have replaced."""
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    parts = [found[f"loads.{k}"] for k in range(int(found["loads"]))]
    return json.loads("".join(parts))


def _switch(spark: SparkSession, table: str, loads: dict[str, list[int]]) -> None:
    """Show exactly these loads: one statement, before which readers see the old rows and after it the new."""
    shown = [
        f"load_id = '{load}'" + (f" AND (indicator_id IS NULL OR indicator_id NOT IN ({', '.join(map(str, gone))}))" if gone else "")
        for load, gone in loads.items()
    ]
    columns = ", ".join(f"`{c}`" for c in spark.table(f"{table}_loads").columns if c != "load_id")
    text = json.dumps(loads)
    parts = [text[k : k + 3000] for k in range(0, len(text), 3000)]  # catalogs bound the size of a property
    properties = ", ".join([f"'loads' = '{len(parts)}'", *[f"'loads.{k}' = '{part}'" for k, part in enumerate(parts)]])
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({properties}) AS "
        f"SELECT {columns} FROM {table}_loads WHERE {' OR '.join(f'({s})' for s in shown) or 'false'}"
    )


def _drop_hidden(spark: SparkSession, table: str) -> None:
    """Drop the partitions that the view doesn't show, also those of runs that were stopped."""
    loads, held = _loads(spark, table), set()
    for row in spark.sql(f"SHOW PARTITIONS {table}_loads").collect():  # one row for each indicator of a load
        load, indicator = (part.split("=", 1)[1] for part in row["partition"].split("/"))
        number = int(indicator) if indicator.lstrip("-").isdigit() else None
        if load not in loads or number in loads[load]:
            spark.sql(f"ALTER TABLE {table}_loads DROP IF EXISTS PARTITION (load_id = '{load}', indicator_id = {'NULL' if number is None else number})")
        else:
            held.add(load)
    if held != loads.keys():
        _switch(spark, table, {load: gone for load, gone in loads.items() if load in held})


def replace_indicators(df: DataFrame, table: str, ids: IndicatorIds = None) -> None:
    """Delete the rows of ``ids`` from the results, then append ``df``; no ids delete every row.

    Rows of other ids are added to what the results hold.  The new rows are written first, then one
    statement shows them instead of the old; a run that is stopped leaves the old or the new results.
    One writer at a time.
    """
    wanted = normalise_ids(ids)
    gone = None if wanted is None else [int(i) for i in wanted if not isinstance(i, str)]
    _replace(df, table, gone)


def replace_submitted(df: DataFrame, table: str) -> None:
    """Replace the indicators that occur in ``df``; rows without an indicator are added."""
    new = stage(df.select(df.sparkSession.table(table).columns))
    known = new.filter("indicator_id IS NOT NULL").select("indicator_id").distinct()
    _replace(new, table, [r[0] for r in known.collect()])  # one number for each indicator


def _replace(df: DataFrame, table: str, gone: list[int] | None) -> None:
    spark = df.sparkSession
    load = _write(df, table)
    kept = {} if gone is None else {old: sorted({*hidden, *gone}) for old, hidden in _loads(spark, table).items()}
    _switch(spark, table, {**kept, load: []})
    _drop_hidden(spark, table)


def write_csv_extract(df: DataFrame, folder: str, run_date: date, prefix: str = "extract") -> str:
    """Write a CSV extract to a folder named after the date."""
    target = f"{folder}/{prefix}_{run_date:%Y%m%d}"
    df.write.mode("overwrite").csv(target, header=True)
    return target
