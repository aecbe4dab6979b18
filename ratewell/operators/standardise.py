"""Rates with confidence limits, and direct age standardisation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions import intervals
from ratewell.operators.pooling import total
from ratewell.schema import CODES

# The kinds of output; `dsr` has the method and statistic texts.
KINDS = ("value", "lower", "upper", "standard", "full")


def signed(low: Column, high: Column, x: Column, n: Column, multiplier: Column) -> dict[str, Column]:
    """Scaled value and limits of ``x / n``; the limits of a negative ``x`` mirror those of its size.

    ``low`` and ``high`` are the unscaled limits of the size.
    """
    small, large = F.least(low, high) * multiplier, F.greatest(low, high) * multiplier
    return {
        "value": F.try_divide(x, n) * multiplier,
        "lowercl": F.when(x < 0, -large).otherwise(small),
        "uppercl": F.when(x < 0, -small).otherwise(large),
    }


def calc_percentage(df: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Percentage rows with Wilson limits."""
    x, n, multiplier = F.col("numerator"), F.col("denominator"), F.col("multiplier")
    lower, upper = intervals.wilson(x, n, confidence)
    return df.filter(F.col("value_type_code") == CODES.percentage).withColumns(
        {
            "value": F.try_divide(x, n) * multiplier,
            "lowercl": lower * multiplier,
            "uppercl": upper * multiplier,
        }
    )


def calc_crude_or_ratio(
    df: DataFrame, confidence: float = 0.95, fractional: bool = True
) -> DataFrame:
    """Crude-rate and signed-ratio rows; a missing numerator counts as 0."""
    x, n = F.col("numerator"), F.col("denominator")
    rows = df.filter(F.col("value_type_code").isin(CODES.crude_rate, CODES.ratio))
    counted = rows.withColumn("numerator", F.coalesce(x, F.lit(0.0)))
    lower, upper = intervals.poisson_limits(F.abs(x), confidence, fractional)
    limited = counted.withColumns({"__low": F.try_divide(lower, n), "__high": F.try_divide(upper, n)})
    return limited.withColumns(
        signed(F.col("__low"), F.col("__high"), x, n, F.col("multiplier"))
    ).drop("__low", "__high")


def dsr_faults(x: Column, n: Column, stdpop: Column, multiplier: Column) -> dict[str, Column]:
    """Reasons that keep a row out of a standardised rate."""
    return {
        "missing denominator": n.isNull(),
        "missing standard population": stdpop.isNull(),
        "missing multiplier": multiplier.isNull(),
        "negative numerator": F.coalesce(x < 0, F.lit(False)),
        "denominator not positive": F.coalesce(n <= 0, F.lit(False)),
        "negative standard population": F.coalesce(stdpop < 0, F.lit(False)),
        "multiplier not positive": F.coalesce(multiplier <= 0, F.lit(False)),
    }


def dsr_validate(
    df: DataFrame,
    x: str = "numerator",
    n: str = "denominator",
    stdpop: str = "stdpop",
    multiplier: str = "multiplier",
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Usable rows, and rejected rows with their ``faults``; ``strict`` raises on the first kind."""
    faults = dsr_faults(F.col(x), F.col(n), F.col(stdpop), F.col(multiplier))
    if strict:
        counts = df.agg(*[F.count_if(c).alias(name) for name, c in faults.items()]).first()
        found = [f"{name}: {count} rows" for name, count in counts.asDict().items() if count]
        if found:
            raise ValueError("; ".join(found))
    text = F.concat_ws("; ", *[F.when(c, name) for name, c in faults.items()])
    bad = reduce(lambda a, b: a | b, faults.values())
    return df.filter(~bad), df.filter(bad).withColumn("faults", text)


def constancy_violations(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Groups in which a column takes more than one value; NULL counts as a value."""
    varies = [
        (F.min(c).isNotNull() & (F.min(c) != F.max(c)))
        | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1))))
        for c in columns
    ]
    flags = [v.alias(f"{c}_varies") for v, c in zip(varies, columns)]
    result = df.groupBy(*keys).agg(*flags)
    return result.filter(reduce(lambda a, b: a | b, [F.col(f"{c}_varies") for c in columns]))


def assert_constant(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``df`` again, or an error when a column varies inside a group."""
    if not constancy_violations(df, keys, columns).isEmpty():
        raise ValueError(f"{', '.join(columns)} must be constant within {', '.join(keys)}")
    return df


def _dobson(base: Column, variance: Column, events: Column, limit: Column, multiplier: Column) -> Column:
    return (base + F.sqrt(F.try_divide(variance, events)) * (limit - events)) * multiplier


def dsr(
    df: DataFrame,
    keys: list[str],
    x: str = "numerator",
    n: str = "denominator",
    stdpop: str = "stdpop",
    multiplier: str | float = "multiplier",
    confidence: float | tuple[float, float] = 0.95,
    kind: str = "full",
    event_freq: str | None = None,
    age_band: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Directly standardised rate per group, with Dobson limits; see ``dsr_checked``.

    Groups with a fault have no rate; ``strict`` raises if there is one, which runs a job.
    """
    rates, rejects = dsr_checked(
        df, keys, x, n, stdpop, multiplier, confidence, kind, event_freq, age_band
    )
    if strict:
        found = rejects.select("faults").limit(1).collect()
        if found:
            raise ValueError(found[0]["faults"])
    return rates


def dsr_checked(
    df: DataFrame,
    keys: list[str],
    x: str = "numerator",
    n: str = "denominator",
    stdpop: str = "stdpop",
    multiplier: str | float = "multiplier",
    confidence: float | tuple[float, float] = 0.95,
    kind: str = "full",
    event_freq: str | None = None,
    age_band: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rates of the groups without a fault, and the other groups with their ``faults``.

    With ``event_freq`` and ``age_band`` the events of one person are not independent: the variance
    is summed over event frequencies and events are persons times frequency.  A group is at fault
    if it holds a row of ``dsr_faults``, several multipliers or, for dependent events, a row without
    frequency or band or a band with several populations or weights.  Faults are found by the
    aggregation that sums the group.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {', '.join(KINDS)}")
    levels = confidence if isinstance(confidence, tuple) else (confidence,)
    levels = tuple(intervals.confidence_level(c) for c in levels)
    if len(levels) > 2 or (len(levels) == 2 and levels != (0.95, 0.998)):
        raise ValueError("two confidence levels must be 0.95 and 0.998")

    factor = F.col(multiplier) if isinstance(multiplier, str) else F.lit(float(multiplier))
    rows = df.select(
        *keys,
        *[c for c in (event_freq, age_band) if c],
        F.col(x).cast("double").alias("x"),
        F.col(n).cast("double").alias("n"),
        F.col(stdpop).cast("double").alias("w"),
        factor.cast("double").alias("multiplier"),
    )
    if event_freq:
        if not age_band:
            raise ValueError("age_band is needed with event_freq")
        totals = _dependent_events(rows, keys, event_freq, age_band)
        method = "Dobson, with confidence adjusted for non-independent events"
    else:
        totals = rows.groupBy(*keys).agg(
            *_totals(), _variance().alias("vardsr"), _fault_list(_row_faults()).alias("faults")
        )
        method = "Dobson"

    events, base, scale = F.col("total_count"), F.col("base_value"), F.col("multiplier")
    if len(levels) == 2:
        labels = [("lower95_0cl", "upper95_0cl"), ("lower99_8cl", "upper99_8cl")]
    else:
        labels = [("lowercl", "uppercl")]
    columns: dict[str, Column] = {"value": base * scale}
    for level, (low, high) in zip(levels, labels):
        for name, limit in ((low, intervals.byars_lower), (high, intervals.byars_upper)):
            columns[name] = _dobson(base, F.col("vardsr"), events, limit(events, level), scale)
    text = ", ".join(f"{level * 100:g}%" for level in levels)
    columns["confidence"] = F.lit(text)
    per = F.when(scale == F.floor(scale), scale.cast("bigint").cast("string"))
    columns["statistic"] = F.concat(F.lit("dsr per "), F.coalesce(per, scale.cast("string")))
    columns["method"] = F.lit(method)
    rates = totals.filter("faults = ''").withColumns(columns)
    return _of_kind(rates, keys, kind, labels), totals.filter("faults <> ''").select(*keys, "faults")


def _row_faults() -> dict[str, Column]:
    """Whether the rows of a group hold each kind of fault, as aggregates."""
    rows = dsr_faults(F.col("x"), F.col("n"), F.col("w"), F.col("multiplier"))
    found = {name: F.bool_or(c) for name, c in rows.items()}
    return {**found, "several multipliers": _varies("multiplier")}


def _varies(column: str) -> Column:
    return F.coalesce(F.min(column) != F.max(column), F.lit(False))


def _fault_list(flags: dict[str, Column]) -> Column:
    return F.concat_ws("; ", *[F.when(c, name) for name, c in flags.items()])


def _totals() -> list[Column]:
    events = F.coalesce(F.col("x"), F.lit(0.0))
    return [
        total("x").alias("total_count"),
        F.sum("n").alias("total_pop"),
        F.try_divide(F.sum(F.try_divide(events * F.col("w"), F.col("n"))), F.sum("w")).alias("base_value"),
        F.max("multiplier").alias("multiplier"),
    ]


def _variance() -> Column:
    events = F.coalesce(F.col("x"), F.lit(0.0))
    squares = F.sum(events * F.pow(F.try_divide(F.col("w"), F.col("n")), 2.0))
    return F.try_divide(squares, F.pow(F.sum("w"), 2.0))


def _dependent_events(rows: DataFrame, keys: list[str], freq: str, band: str) -> DataFrame:
    """Totals and variance when one person can have several events.

    Both inputs of the closing join hold one row per group.
    """
    by_freq = rows.groupBy(*keys, freq).agg(_variance().alias("v"))
    variance = by_freq.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(
        F.sum(F.col("v") * F.pow(F.col(freq), 2.0)).alias("vardsr")
    )
    flags = {
        **_row_faults(),
        "missing event frequency": F.bool_or(F.col(freq).isNull()),
        "missing age band": F.bool_or(F.col(band).isNull()),
        "several populations in an age band": _varies("n"),
        "several standard populations in an age band": _varies("w"),
    }
    events = rows.groupBy(*keys, band).agg(
        total(F.col(freq) * F.col("x")).alias("x"),
        F.max("n").alias("n"),
        F.max("w").alias("w"),
        F.max("multiplier").alias("multiplier"),
        F.min("multiplier").alias("__least"),
        *[c.alias(f"__{k}") for k, c in enumerate(flags.values())],
    )
    found = {name: F.bool_or(f"__{k}") for k, name in enumerate(flags)}
    # The bands of a group may differ from each other.
    found["several multipliers"] = F.coalesce(F.min("__least") != F.max("multiplier"), F.lit(False))
    totals = events.groupBy(*keys).agg(*_totals(), _fault_list(found).alias("faults"))
    matches = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    )
    return totals.join(variance, matches, "left").drop(*[f"__{k}" for k in keys])


def _of_kind(df: DataFrame, keys: list[str], kind: str, labels: list[tuple[str, str]]) -> DataFrame:
    lows, highs = [low for low, _ in labels], [high for _, high in labels]
    bounds = [name for pair in labels for name in pair]
    columns = {
        "value": ["value"],
        "lower": lows,
        "upper": highs,
        "standard": ["total_count", "total_pop", "value", *bounds],
        "full": ["total_count", "total_pop", "value", *bounds, "confidence", "statistic", "method"],
    }[kind]
    return df.select(*keys, "base_value", "multiplier", *columns)
