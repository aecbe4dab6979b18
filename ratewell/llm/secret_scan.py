"""Secrets in text, told apart by how many owners share them.

Spans are found by pattern; the hash of each candidate's value is counted over the whole corpus by
distinct owner and by distinct repository of an owner.  A value that several owners share is a copied
example; one that a single owner has and that doesn't look like a placeholder is live-looking.  The
generic kind reports only live-looking values.  DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.llm.common import fresh_name, new_folder


@dataclass(frozen=True)
class Kind:
    """A pattern, the group that holds the value, its least length, and whether it reports all it finds."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


# Fixed patterns; a match that is too short is dropped after matching.
KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", r"AKIA[A-Z0-9]+", 0, 20),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24),
    Kind("generic", r"[A-Za-z0-9+/_-]{32,}", 0, 32, False),
)
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|redacted|your|xxxx|(.)\1{7,}|0123456|abcdef0"


def _live_looking(value: Column) -> Column:
    """Ten different characters or more, a digit and a letter, and no placeholder in it."""
    letters = F.array_distinct(F.split(value, ""))
    return (F.size(letters) >= 10) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def scan_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", copied: int = 3) -> DataFrame:
    """Per row of ``docs``: its columns other than text, the counts and the spans.

    Adds row_id, n_assign, n_access, n_hex, base_spans and spans (arrays of kind, start, end, looks, live and
    copied, by start, then kind), with code points from 0 and exclusive ends.  A value looks live if it
    doesn't look like a placeholder, is live if one owner has it besides, copied if ``copied`` owners or
    more have it; null owners are one owner.  Rows are told apart by a number given when the matches are first
    written, so repeated rows and null ids are rows like others.  A null text is empty; an empty table
    gives no rows.  Values that a third of all rows share are combined before each shuffle.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    found = []
    for kind in KINDS:
        hit = text.rlike(kind.pattern)
        gaps = F.transform(F.split(text, kind.pattern, -1), F.length)
        every = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
        value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group))
        zipped = F.arrays_zip(F.slice(gaps, 1, F.size(every)).alias("gap"), F.transform(every, F.length).alias("size"), value.alias("value"))
        found.append(F.when(hit, zipped).alias(f"found_{kind.name}"))
    kept = [F.col(c).alias(c) for c in docs.columns if c != "text"]
    path = new_folder(spark, "secrets")
    # The number of a row is fixed by writing it.
    docs.select(F.struct(*kept).alias("row"), *found).withColumn("row_id", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    matches = None
    for place, kind in enumerate(KINDS):
        here = rows.select(
            "row_id", F.col(f"row.{owner}").alias("owner"), F.col(f"row.{repository}").alias("repository"),
            F.lit(place).alias("place"), F.posexplode(f"found_{kind.name}").alias("nth", "m"),
        )
        matches = here if matches is None else matches.union(here)
    # A text's matches of one kind; their number is bounded by its length.
    before = Window.partitionBy("row_id", "place").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.sum(F.col("m.gap") + F.col("m.size")).over(before)
    spans = matches.select(
        "row_id", "owner", "repository", "place", (until - F.col("m.size")).alias("start"), until.alias("end"),
        (until - F.length("m.value")).alias("hidden"), F.col("m.value").alias("value"),
    )
    right = F.lit(False)
    for place, kind in enumerate(KINDS):
        long = F.length("value") >= kind.least
        right = right | ((F.col("place") == place) & (long if kind.base else long & _mixed(F.col("value"))))
    spans = spans.where(right).withColumn("hash", F.sha2("value", 256)).withColumn("looks", _live_looking(F.col("value"))).drop("value")
    owned = spans.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    owned = owned.groupBy("hash", "owner").agg(F.sum("one").alias("repositories"))
    owned = owned.groupBy("hash").agg(F.count("*").alias("owners"), F.sum("repositories").alias("repositories"))
    spans = spans.join(owned, "hash").withColumn("live", F.col("looks") & (F.col("owners") == 1))
    base = F.col("place").isin([p for p, k in enumerate(KINDS) if k.base])
    spans = spans.where(base | F.col("live")).withColumn("copied", F.col("owners") >= copied)
    named = F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), F.col("place") + 1)
    span = F.struct("start", "place", "end", named.alias("kind"), "hidden", "looks", "live", "copied", "owners", "repositories")
    counts = [F.sum((F.col("place") == p).cast("long")).alias(f"n_{k.name}") for p, k in enumerate(KINDS) if k.base]
    by_row = spans.groupBy("row_id").agg(F.sort_array(F.collect_list(span)).alias("spans"), *counts)
    none = F.array().cast(by_row.schema["spans"].dataType)
    joined = rows.select("row_id", "row").join(by_row, "row_id", "left")
    every = F.coalesce("spans", none)
    return joined.select(
        "row_id", "row", *[F.coalesce(f"n_{k.name}", F.lit(0)).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base],
        every.alias("spans"), F.filter(every, lambda s: s.place < len([k for k in KINDS if k.base])).alias("base_spans"),
    )


def mask_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id", copied: int = 3, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with the value of every secret span replaced by ``mask``, unless it is a widely copied example.

    An example is a value that ``copied`` owners or more have *and* that looks like a placeholder: a
    live-looking key is masked however many have it.
    Rows, columns and their order stay.  The value of an assignment is masked without the name.  Texts
    without secrets are not touched.  See ``scan_secrets`` for nulls, repeats and empty tables.
    """
    body, name = fresh_name(docs, "body"), docs.columns
    found = scan_secrets(docs.withColumn(body, F.col("text")), owner, repository, copied)
    text = F.col(f"row.{body}")
    own = F.filter("spans", lambda s: ~s.copied | s.looks)
    # Overlapping spans are one: a span begins where the last ended, if that is later.
    ends = lambda upto: F.coalesce(F.array_max(F.transform(upto, lambda s: s.end)), F.lit(0).cast("long"))
    index = F.sequence(F.lit(1), F.size(own))
    before = lambda i: ends(F.slice(own, 1, i - 1))
    cut = lambda low, high: F.when(high > low, text.substr((low + 1).cast("int"), (high - low).cast("int"))).otherwise("")
    parts = F.transform(
        index,
        lambda i: F.concat(
            cut(before(i), F.element_at(own, i).hidden),
            F.when(F.element_at(own, i).end > before(i), F.lit(mask)).otherwise(""),
        ),
    )
    rest = cut(ends(own), F.length(text).cast("long"))
    masked = F.when(F.size(own) > 0, F.concat(F.concat_ws("", parts), rest)).otherwise(text)
    return found.select(*[masked.alias("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in name])


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
