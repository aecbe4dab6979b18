"""Intermediate tables in the shared folder."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewell.session import shared_dir


def stage(df: DataFrame, layout: T.StructType | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, read back.

    Work that is read several times is done once, and the table outlives a lost executor.  With a
    ``layout`` the columns are chosen and cast to it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staging-{uuid4().hex}"
    if layout is not None:
        df = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, layout: T.StructType | None = None) -> tuple[DataFrame, int]:
    """``stage``, and how many rows were written, counted as they are."""
    counted = Observation()
    written = stage(df.observe(counted, F.count(F.lit(1)).alias("n")), layout)
    return written, counted.get["n"]
