"""A third of all rows on one key, compared with plain Python."""

from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from ratewell.operators import joins, lookup, rollup
from ratewell.plans import calculate
from ratewell.schema import FACT_SCHEMA, POPULATION_KEYS
from ratewell.sources.reference import age_groups
from ratewell.staging import stage

METADATA = (
    "indicator_id int, age string, year_type string, multiplier double, status_code int, "
    "population_type string"
)


def crowded_facts(spark, rows=30_000):
    """Rows of one indicator and area for a third of the ids, spread over others for the rest."""
    other = "id % 3 <> 0"
    return spark.range(rows).selectExpr(
        f"cast(case when {other} then id % 40 + 2 else 1 end as int) as indicator_id",
        "make_date(2015 + cast(id % 5 as int), 1, 1) as start_date",
        "make_date(2015 + cast(id % 5 as int), 12, 31) as end_date",
        "cast(id % 7 as double) as numerator",
        "cast(id % 7 + 5 as double) as denominator",
        "cast(null as double) as indicator_value",
        "cast(null as double) as lower_ci95",
        "cast(null as double) as upper_ci95",
        "1 as imd_code",
        f"cast(case when {other} then id % 50 + 2 else 1 end as int) as aggregation_id",
        "999 as age_group_code",
        "999 as sex_code",
        "1 as ethnicity_code",
        "timestamp'2024-01-01' as creation_date",
        "2 as value_type_code",
        "1 as source_code",
    )


def test_pooling_a_crowded_group(spark):
    metadata = joins.local_table(
        spark, [(i, "All ages", "Calendar", 100.0, 1, "Census") for i in range(1, 42)], METADATA
    )
    facts = stage(crowded_facts(spark), FACT_SCHEMA)
    result = calculate.calculate_values(facts, metadata, age_groups(spark), date(2024, 6, 30))
    sums = defaultdict(lambda: [0.0, 0.0])
    for i in range(30_000):
        key = (1, 1) if i % 3 == 0 else (i % 40 + 2, i % 50 + 2)
        year = 2015 + i % 5
        for k in (3, 5):
            for first in range(2015, 2020 - k + 1):
                if first <= year < first + k:
                    pair = sums[(*key, first, k)]
                    pair[0] += i % 7
                    pair[1] += i % 7 + 5
    pooled = result.combined.filter("time_period_type <> '1 year'").collect()
    found = {
        (r.indicator_id, r.aggregation_id, r.start_date.year, int(r.time_period_type[0])): [r.numerator, r.denominator]
        for r in pooled
    }
    assert len(pooled) == len(found)
    assert found == dict(sums)
    assert result.combined.count() == 30_000 + len(found)


@pytest.fixture(params=["-1", "10m"])
def broadcasting(spark, request):
    """With and without broadcasts, so that both ways of a crowded join are taken."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, request.param)
    yield
    spark.conf.unset(key)


def test_population_of_a_crowded_area(spark, monkeypatch, broadcasting):
    original = joins.spread_join
    monkeypatch.setattr(rollup, "spread_join", lambda *a, **k: original(*a, **{**k, "salts": 4}))
    facts = crowded_facts(spark).withColumn("denominator", F.lit(None).cast("double"))
    areas = spark.range(60).selectExpr("cast(id as int) as aggregation_id", "cast(id * 10 as int) as observation")
    population = areas.selectExpr(
        "aggregation_id", "999 as age_code", "1 as ethnicity_code", "1 as imd_code", "999 as sex_code", "observation"
    ).union(areas.selectExpr("aggregation_id", "999", "1", "1", "999", "1"))
    attached = rollup.attach_population(facts, population)
    assert attached.columns == facts.columns
    counts = {r.aggregation_id: (r.n, r.low, r.high) for r in attached.groupBy("aggregation_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("denominator").alias("low"), F.max("denominator").alias("high")
    ).collect()}
    assert sum(n for n, _, _ in counts.values()) == 30_000
    assert counts[1] == (10_000, 11.0, 11.0)
    assert all(low == high == area * 10 + 1 for area, (_, low, high) in counts.items())
    assert set(POPULATION_KEYS) <= set(facts.columns)


def test_override_for_a_crowded_person(spark, monkeypatch, broadcasting):
    original = joins.spread_join
    monkeypatch.setattr(lookup, "spread_join", lambda *a, **k: original(*a, **{**k, "salts": 4}))
    rows = spark.range(9_000).selectExpr(
        "id", "case when id % 3 = 0 then 5 when id % 3 = 1 then null else id end as person_id", "'own' as ethnicity"
    )
    known = spark.range(0, 9_000, 2).selectExpr("id as person_id", "case when id % 4 = 0 then 'new' end as code")
    crowd = known.union(spark.sql("SELECT 5L, 'hot'"))
    updated = lookup.update_from(rows, crowd, ["person_id"], "ethnicity", "code", crowded=True)
    found = {r.id: r.ethnicity for r in updated.collect()}
    assert len(found) == 9_000

    def wanted(i):
        if i % 3 == 0 or i == 5:
            return "hot"
        if i % 3 == 1 or i % 2:
            return "own"
        return "new" if i % 4 == 0 else None

    assert found == {i: wanted(i) for i in range(9_000)}
