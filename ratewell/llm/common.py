"""Helpers that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from types import ModuleType
from typing import Any
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` doesn't have, so that columns of the caller can't clash."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def crc_of_id(key: Column) -> Column:
    """crc32 of an integer id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_dir(spark)}/{kind}-{uuid4().hex}"


def files_at(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it of a folder that every executor can reach."""
    if "://" not in folder and not folder.startswith("file:"):
        return pafs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))


def parts_for(spark: SparkSession, size: int, per_part: int) -> int:
    """Partitions of about ``per_part`` bytes, and at least as many as the session shuffles into."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // per_part))


@contextmanager
def small_batches(spark: SparkSession, size: int = 4 << 20) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of about ``size`` bytes, so texts of any length take little memory.

    An executor holds a batch several times: as vectors of doubling size and in the worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def kept_by_worker(name: tuple, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: the object under ``name``, made if it isn't there."""
    home = sys.modules.setdefault("ratewell_kept", ModuleType("ratewell_kept")).__dict__
    if name not in home:
        home[name] = make()
    return home[name]
