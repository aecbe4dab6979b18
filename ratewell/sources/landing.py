"""Landing facts, dimension tables, submitted templates and downloaded CSV extracts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.functions import casts, names
from ratewell.operators.joins import bounded
from ratewell.operators.select import filter_areas
from ratewell.operators.sets import union_by_name
from ratewell.schema import FACT_COLS, FACT_SCHEMA
from ratewell.staging import stage

TEMPLATES = "[iI][dD]*.[cC][sS][vV]"


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FACT_SCHEMA).parquet(path)


def read_dim(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_snake(spark: SparkSession, path: str, drop: list[str] | None = None) -> DataFrame:
    """CSV with inferred types and snake-case names, without the ``drop`` columns."""
    df = spark.read.csv(path, header=True, inferSchema=True)
    return df.toDF(*names.snake(df.columns)).drop(*(drop or []))


def plain_path(path: str = "file_path") -> Column:
    """The path with escaped characters restored."""
    return F.url_decode(F.replace(F.col(path), F.lit("+"), F.lit("%2B")))


def file_name(path: str = "file_path") -> Column:
    """Last part of the path."""
    return F.element_at(F.split(plain_path(path), "/"), -1)


def csv_lines(spark: SparkSession, paths: str | list[str], files: str | None = None) -> DataFrame:
    """The lines of CSV files as a written table that knows where records begin, whatever the number of tasks.

    A file is read in byte blocks, each by a task of its own.  Line breaks inside quotes are no ends of
    records, and whether a block begins inside quotes depends on all blocks before it; so a line is
    numbered for both cases as it is read: ``inside`` says whether quotes are open before it if none were
    where its block begins, ``even`` and ``odd`` count the records that begin up to it if none were, or if
    some were.  Returns file_path, block, line, value, quotes, inside, even and odd.  Lines end with a line
    feed, with or without a carriage return.  ``files`` is a glob on the file name.
    """
    reader = spark.read.option("lineSep", "\n")
    reader = reader if files is None else reader.option("pathGlobFilter", files)
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value",
    )
    layout = pa.schema([
        ("file_path", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("value", pa.string()),
        ("quotes", pa.int64()), ("inside", pa.bool_()), ("even", pa.int64()), ("odd", pa.int64()),
    ])

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # file, block, quotes and records so far
        for batch in batches:
            table = pa.Table.from_batches([batch])
            paths, blocks = table.column("file_path").combine_chunks(), table.column("block").to_numpy()
            codes = paths.dictionary_encode().indices.to_numpy()
            changes = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
            for low, high in zip([0, *changes.tolist()], [*changes.tolist(), len(blocks)]):
                if low == high:
                    continue
                some = batch.slice(low, high - low)
                value = some.column("value")
                key = (some.column("file_path")[0].as_py(), int(blocks[low]))
                if held is None or held[0] != key:
                    held = (key, 0, 0, 0)
                quotes = pc.count_substring(value, '"').to_numpy(zero_copy_only=False)
                upto = held[1] + np.cumsum(quotes)
                inside = (upto - quotes) % 2 == 1
                filled = pc.and_(pc.not_equal(value, ""), pc.not_equal(value, "\r")).to_numpy(zero_copy_only=False)
                even, odd = held[2] + np.cumsum(~inside & filled), held[3] + np.cumsum(inside & filled)
                held = (key, int(upto[-1]), int(even[-1]), int(odd[-1]))
                arrays = [*some.columns, pa.array(quotes, pa.int64()), pa.array(inside), pa.array(even), pa.array(odd)]
                yield pa.RecordBatch.from_arrays(arrays, schema=layout)

    kind = "file_path string, block long, line long, value string, quotes long, inside boolean, even long, odd long"
    return stage(lines.mapInArrow(numbered, kind))


def csv_headers(lines: DataFrame) -> DataFrame:
    """Per file of ``csv_lines``: ``file_path``, its first line ``header``, the column ``names`` and ``has_rows``.

    Names are parsed as CSV, so a quoted comma parts nothing; a nameless column is ``_c<place>``.
    """
    found = stage(
        lines.groupBy("file_path").agg(
            F.rtrim(F.min_by("value", F.struct("block", "line")), F.lit("\r")).alias("header"),
            (F.count_if(F.trim("value") != "") > 1).alias("has_rows"),
        )
    )
    # No header has more columns than commas and one.
    unquoted = F.regexp_replace("header", '"[^"]*"', "")
    commas = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","), F.lit("")))
    width = (found.agg(F.max(commas)).first()[0] or 0) + 1
    cells = F.from_csv("header", F.lit(_layout(width)))
    named = F.array(*[cells[f"_c{i}"] for i in range(width)])
    names_ = F.transform(
        F.slice(named, 1, commas + 1),
        lambda c, i: F.when(F.trim(c) != "", F.trim(c)).otherwise(F.concat(F.lit("_c"), i.cast("string"))),
    )
    return found.select("file_path", "header", "has_rows", names_.alias("names"))


def _layout(width: int) -> str:
    return ", ".join(f"_c{i} string" for i in range(width))


def csv_records(lines: DataFrame) -> DataFrame:
    """The records of ``csv_lines``: file_path, record (its number in the file, from 1) and its text.

    A block's first quotes are those of all blocks before it, a sum over one row for each block.  Lines
    that are a record alone are passed on as they are; only those of longer records are put together, with
    a line feed between them also where the file's first line ends with a carriage return.
    """
    ended, returned = F.rtrim("value", F.lit("\r")), F.col("value").endswith("\r")
    blocks = lines.groupBy("file_path", "block").agg(
        F.sum("quotes").alias("quotes"), F.max("even").alias("even"), F.max("odd").alias("odd"),
        F.min_by(returned, "line").alias("returned"),
    )
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = blocks.withColumn("opened", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1)
    begun = F.when(F.col("opened"), F.col("odd")).otherwise(F.col("even"))
    upto = before.rowsBetween(Window.unboundedPreceding, 0)
    based = opened.withColumns({"base": F.coalesce(F.sum(begun).over(before), F.lit(0)), "returned": F.first("returned").over(upto)})
    placed = lines.join(based.select("file_path", "block", "opened", "base", "returned"), ["file_path", "block"]).select(
        "file_path", "block", "line", "quotes", F.when(F.col("returned"), ended).otherwise(F.col("value")).alias("value"),
        (F.col("base") + F.when(F.col("opened"), F.col("odd")).otherwise(F.col("even"))).alias("record"),
        (F.col("inside") != F.col("opened")).alias("open"),
    )
    alone = ~F.col("open") & (F.col("quotes") % 2 == 0)
    short = placed.filter(alone & (ended != "")).select("file_path", "record", ended.alias("text"))
    pieces = F.sort_array(F.collect_list(F.struct("block", "line", "value")))
    long = placed.filter(~alone).groupBy("file_path", "record").agg(
        F.rtrim(F.array_join(F.transform(pieces, lambda p: p.value), "\n"), F.lit("\r")).alias("text")
    )
    return short.union(long)


def read_by_header(lines: DataFrame, headers: DataFrame) -> DataFrame | None:
    """All-text rows of the files in ``headers``, columns matched by name, with their ``file_name``.

    All files are read at once by place, whatever their headers, and each row's cells are picked by
    the names of its file.  Quoted line breaks stay in their cell.  Files without rows give no columns;
    None when no file has rows.  To the driver go the distinct column names.
    """
    useful = headers.filter("has_rows").select("file_path", "names")
    listed = useful.select(F.explode("names").alias("name")).distinct().orderBy("name").collect()
    if not listed:
        return None
    width = useful.agg(F.max(F.size("names"))).first()[0]
    rows = csv_records(lines).filter("record > 1").join(useful, "file_path")
    cells = F.from_csv("text", F.lit(_layout(width)), {"escape": '"'})
    celled = rows.select("file_path", "names", cells.alias("__row")).select(
        "file_path", "names", F.array(*[F.col(f"__row._c{i}") for i in range(width)]).alias("__cells")
    )
    picked = [
        F.get("__cells", F.nullif(F.array_position("names", F.lit(r["name"])), F.lit(0)).cast("int") - 1).alias(r["name"])
        for r in listed
    ]
    return celled.select(*picked, file_name().alias("file_name"))


def accepted(validation: Column) -> Column:
    """A submission counts when its validation value is the number 0."""
    return F.coalesce(validation.try_cast("double") == 0, F.lit(False))


def accept_templates(rows: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows of the accepted files, and (file_name, status) of every submitted file.

    ``rows`` carry ``file_name`` and the landing columns as text; ``manifest`` holds one
    ``validation_value`` per file.  A file missing from the manifest has failed.
    """
    verdicts = manifest.groupBy("file_name").agg(
        F.bool_and(accepted(F.col("validation_value"))).alias("__ok")
    )
    checked = bounded(verdicts)
    good = checked.filter("__ok").select("file_name")
    typed = [casts.coerce(F.col(f.name), f.dataType).alias(f.name) for f in FACT_SCHEMA]
    status = (
        rows.select("file_name").distinct()
        .join(checked, "file_name", "full")
        .select("file_name", F.when(F.col("__ok"), "accepted").otherwise("failed").alias("status"))
    )
    return rows.join(good, "file_name", "left_semi").select(typed), status


def ingest_templates(
    spark: SparkSession, data_glob: str, manifest: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows of the submitted ``ID*.csv`` files that pass validation, and the status of each file.

    A file without all landing columns has failed.
    """
    lines = csv_lines(spark, data_glob, TEMPLATES)
    headers = csv_headers(lines).withColumn("file_name", file_name())
    complete = F.size(F.array_except(F.array(*[F.lit(c) for c in FACT_COLS]), "names")) == 0
    rows = read_by_header(lines, headers.filter(complete))
    if rows is None:
        text = T.StructType([T.StructField(c, T.StringType()) for c in [*FACT_COLS, "file_name"]])
        rows = spark.createDataFrame([], text)
    submitted = headers.join(manifest, "file_name", "left").select(
        "file_name",
        F.when(complete, F.col("validation_value")).alias("validation_value"),
    )
    return accept_templates(rows, submitted)


def land_api_csv(
    spark: SparkSession, paths: str | list[str], area_codes: DataFrame | None = None
) -> DataFrame | None:
    """All-text rows of downloaded extracts, columns matched by name.

    Files that are blank, have no rows or start with "No data" are left out with their columns;
    None when nothing is left.
    """
    lines = csv_lines(spark, paths)
    headers = csv_headers(lines)
    useful = (F.trim("header") != "") & ~F.ltrim("header").startswith("No data")
    rows = read_by_header(lines, headers.filter(useful))
    if rows is None:
        return None
    rows = rows.drop("file_name")
    return rows if area_codes is None else filter_areas(rows, area_codes)
