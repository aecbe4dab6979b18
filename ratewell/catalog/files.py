"""Queries that write files or tables in the shared folder and read them back."""

from __future__ import annotations

from datetime import date
from uuid import uuid4

from pyspark.sql import functions as F

from ratewell.catalog.projections import TEXT_FACTS, duck_cast
from ratewell.catalog.registry import FACT_SPEC, query
from ratewell.catalog.tables import PRACTICE_EXPRS, Tables, pick, projection
from ratewell.operators import select, sets
from ratewell.schema import FACT_COLS
from ratewell.session import shared_dir
from ratewell.sources import landing, reference, sinks


def _folder(t: Tables, kind: str) -> str:
    return f"{shared_dir(t.spark)}/staging-{kind}-{uuid4().hex}"


@query(FACT_SPEC, "SELECT * FROM facts", "facts")
def appended_facts(t):
    """Two loads of coded facts, scanned as landing facts."""
    folder, facts = _folder(t, "facts"), t.facts()
    for half in (0, 1):
        sinks.append_fact(facts.filter(F.coalesce(F.col("aggregation_id") % 2, F.lit(0)) == half), folder)
    return landing.read_landing(t.spark, folder)


_PRACTICE_COLUMNS = " ".join(f"{c}:t" for c in PRACTICE_EXPRS)


@query(_PRACTICE_COLUMNS, f"SELECT {projection(PRACTICE_EXPRS)} FROM supplier")
def reloaded_reference(t):
    """A dimension table that is loaded twice and scanned: the second load replaces the first."""
    folder, practices = _folder(t, "reference"), pick(t.raw("supplier"), PRACTICE_EXPRS)
    reference.load_reference({"practices": practices.limit(5)}, folder)
    reference.load_reference({"practices": practices}, folder)
    return landing.read_dim(t.spark, f"{folder}/practices", practices.schema)


@query(
    "area_code:i market_segment:t number_internal:i",
    "SELECT c_nationkey AS area_code, c_mktsegment AS market_segment, count(*) AS number_internal FROM customer GROUP BY ALL",
)
def census_names(t):
    """A census file with printed headings, read with plain names and without a column."""
    folder = _folder(t, "census")
    counted = t.raw("customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    printed = counted.toDF("Area Code", "Market Segment", "Number (Internal)").withColumn("In Table", F.lit("x"))
    printed.write.csv(folder, header=True)
    return landing.read_snake(t.spark, folder, drop=["in_table"])


@query(
    "status:t customers:i total:n",
    "SELECT o_orderstatus AS status, count(DISTINCT o_custkey) AS customers, sum(o_totalprice) AS total FROM orders GROUP BY ALL"
)
def dated_extract(t):
    """A dated CSV extract of results, read back."""
    customers = t.raw("orders").groupBy("o_orderstatus", "o_custkey").agg(F.sum("o_totalprice").alias("total"))
    found = customers.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("customers"), F.sum("total").alias("total")
    )
    written = sinks.write_csv_extract(found, _folder(t, "extract"), date(2024, 5, 6))
    return t.spark.read.csv(written, header=True, inferSchema=True)


@query(
    "area:t status:t orders:i price:n note:t",
    "SELECT 'E' || o_custkey AS area, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status, count(*) AS orders, "
    "sum(o_totalprice) AS price, CASE WHEN o_orderstatus = 'F' THEN 'a, \"b\"' || chr(10) || 'c' END AS note "
    "FROM orders GROUP BY o_custkey, o_orderstatus",
)
def landed_extract(t):
    """Extracts with different columns in different order, one without rows and one without data."""
    folder = _folder(t, "api")
    counted = t.raw("orders").groupBy("o_custkey", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("Orders"), F.sum("o_totalprice").alias("Price, all")
    )
    area = F.concat(F.lit("E"), F.col("o_custkey").cast("string")).alias("Area")
    layouts = {
        "F": ["Price, all", area, F.col("o_orderstatus").alias("Status"), "Orders", F.lit('a, "b"\nc').alias("Note")],
        "O": [area, F.col("o_orderstatus").alias("Status"), "Orders", "Price, all"],
        "P": ["Orders", area, "Price, all"],
    }
    for status, columns in layouts.items():
        some = counted.filter(F.col("o_orderstatus") == status).select(*columns)
        some.write.csv(f"{folder}/{status}", header=True, escape='"')
    counted.filter("false").select(F.lit(1).alias("Never seen"), area).coalesce(1).write.csv(f"{folder}/none", header=True)
    t.spark.createDataFrame([("No data for this indicator",)], "v string").coalesce(1).write.text(f"{folder}/empty")
    rows = landing.land_api_csv(t.spark, f"{folder}/*")
    if "Never seen" in rows.columns:
        raise ValueError("a file without rows gave a column")
    return rows.select(
        F.col("Area").alias("area"), F.col("Status").alias("status"), F.col("Orders").alias("orders"),
        F.col("`Price, all`").alias("price"), F.col("Note").alias("note"),
    )


_FILED = "o_custkey % 8"
_SUBMITTED = {c: e for c, e in TEXT_FACTS.items() if c != "file_name"}
_CASTS = ", ".join(duck_cast(c) for c in FACT_COLS)


def _file(spark, df, folder: str, name: str) -> None:
    """``df`` as one CSV file of that name."""
    df.coalesce(1).write.csv(f"{folder}/{name}-parts", header=True, escape='"')
    there = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}-parts")
    system = there.getFileSystem(spark._jsc.hadoopConfiguration())
    (part,) = [s.getPath() for s in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(there, "part-*"))]
    system.rename(part, spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))


def _ingested(t: Tables):
    """Seven submitted files and one other: short, reordered, quoted, empty, incomplete, refused, unknown."""
    folder = _folder(t, "templates")
    orders = pick(t.raw("orders"), {**_SUBMITTED, "filed": _FILED, "status": "o_orderstatus"})
    notes = F.when(F.col("status") == "F", F.lit('first, "line"\nsecond\n\nlast')).otherwise(F.col("status")).alias("notes")
    turned = [*reversed(FACT_COLS)]
    files = {
        "ID_0.csv": (0, FACT_COLS),
        "ID_1.csv": (1, [notes, *turned]),
        "id 2+x.csv": (2, [*FACT_COLS, notes]),
        "ID_3.csv": (-1, FACT_COLS),
        "ID_4.csv": (4, [c for c in FACT_COLS if c != "sex_code"]),
        "ID_5.csv": (5, FACT_COLS),
        "ID_6.csv": (6, FACT_COLS),
        "other.csv": (7, FACT_COLS),
    }
    for name, (number, columns) in files.items():
        _file(t.spark, orders.filter(F.col("filed") == number).select(*columns), folder, name)
    manifest = [("ID_0.csv", "0"), ("ID_1.csv", "0.0"), ("id 2+x.csv", " 0 "), ("ID_3.csv", "0"), ("ID_4.csv", "0"), ("ID_5.csv", "1")]
    return landing.ingest_templates(t.spark, f"{folder}/*.csv", t.local(manifest, "file_name string, validation_value string"))


@query(FACT_SPEC, f"SELECT {_CASTS} FROM submitted WHERE {_FILED} IN (0, 1, 2)", submitted=f"SELECT {projection(_SUBMITTED)}, o_custkey FROM orders")
def ingested_templates(t):
    """The rows of the submitted files that count, whatever their columns' order and their quoted line breaks."""
    return _ingested(t)[0]


@query(
    "file_name:t status:t",
    "SELECT * FROM (VALUES ('ID_0.csv', 'accepted'), ('ID_1.csv', 'accepted'), ('id 2+x.csv', 'accepted'), ('ID_3.csv', 'accepted'), "
    "('ID_4.csv', 'failed'), ('ID_5.csv', 'failed'), ('ID_6.csv', 'failed')) v(file_name, status)",
)
def ingested_status(t):
    return _ingested(t)[1]


@query(
    "shown:i every:i",
    "SELECT least(count(*), 1000) AS shown, count(*) AS every FROM lineitem",
)
def previewed_rows(t):
    """How many rows a preview shows, and how many there are."""
    rows = t.raw("lineitem")
    shown = select.preview(rows.select("l_orderkey")).agg(F.count(F.lit(1)).alias("shown"))
    every = sets.count_by(rows.select(F.lit(1).alias("one")), ["one"], "every")
    return shown.withColumn("one", F.lit(1)).join(every, "one").select("shown", "every")
