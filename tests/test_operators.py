import math
import random
import statistics
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ratewell.operators import complete, joins, lookup, pooling, ranking, rollup, select, sets, standardise
from ratewell.schema import CODES, ESP2013, GEOGRAPHY, POOL_KEYS


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# joins ------------------------------------------------------------------------------------
def test_constant_tables_are_broadcast(spark):
    small = joins.local_table(spark, [(1, "a"), (None, "b")], "k int, v string")
    plan = spark.range(10).selectExpr("cast(id as int) k").join(small, "k")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_bounded_leaves_large_tables_alone(spark):
    df = spark.range(50).toDF("k")
    assert joins.bounded(df, 49) is df
    assert joins.bounded(df, 50) is not df
    assert rows_of(joins.bounded(df, 50)) == rows_of(df)


def test_null_safe_lookup(spark):
    facts = spark.createDataFrame([(1, "x"), (None, "y")], "k int, f string")
    dim = joins.local_table(spark, [(1, "a"), (None, "b")], "k int, v string")
    assert rows_of(joins.lookup_join(facts, dim, ["k"], null_safe=True).select("f", "v")) == [
        ("x", "a"), ("y", "b"),
    ]
    assert rows_of(joins.lookup_join(facts, dim, ["k"]).select("f", "v")) == [("x", "a"), ("y", None)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spread_join_keeps_every_row_of_a_crowded_key(spark, how):
    # A third of the rows share one key, some have none.
    facts = spark.range(30_000).selectExpr(
        "id", "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id % 5000 end as k"
    )
    lookup_table = spark.range(4_000).selectExpr("id as k", "id * 10 as v")
    plain = facts.join(lookup_table, "k", how).select("id", "k", "v")
    assert "BroadcastHashJoin" in joins.spread_join(facts, lookup_table, ["k"], how)._jdf.queryExecution().toString()
    never = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(never, "-1")
    spread = joins.spread_join(facts, lookup_table, ["k"], how, salts=8)
    assert spread.count() == plain.count()
    assert spread.select("id", "k", "v").exceptAll(plain).isEmpty()
    coalescing = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalescing, "false")
    try:
        again = joins.spread_join(facts, lookup_table, ["k"], how, salts=8)
        crowded = again.filter("k = 7").withColumn("p", F.spark_partition_id()).groupBy("p").count()
        assert crowded.count() > 1
    finally:
        spark.conf.unset(coalescing)
        spark.conf.unset(never)


def test_hot_keys_are_found_and_few(spark):
    facts = spark.range(10_000).selectExpr("case when id % 3 = 0 then 7 else id end as k")
    hot = {r[0] for r in joins.hot_keys(facts, ["k"], 0.05).collect()}
    wanted = facts.filter("k = 7").select(F.xxhash64("k")).first()[0]
    assert wanted in hot and len(hot) <= 20


# lookups ----------------------------------------------------------------------------------
def test_update_keeps_unmatched_and_takes_matched_nulls(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    found = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    assert rows_of(lookup.update_from(df, found, ["k"], "v")) == [(1, "x"), (2, None), (3, "c")]


def test_fill_takes_the_first_source_that_knows(spark):
    df = spark.createDataFrame([(1, 0, None), (2, 1, None), (3, 0, "own")], "k int, old int, v string")
    first = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a")], "k int, w string")
    second = spark.createDataFrame([(1, "b"), (2, "b")], "k int, w string")
    filled = lookup.fill_from(
        df, [(first, F.col("old") == 0), (second, F.col("old") == 1)], ["k"], {"v": "w"}
    )
    assert rows_of(filled.select("k", "v")) == [(1, "a"), (2, "b"), (3, "own")]


def test_standard_population_sums_to_100000(spark):
    assert sum(ESP2013) == 100_000
    codes = spark.createDataFrame([(0,), (1,), (18,), (19,), (999,), (None,)], "age_group_code int")
    found = [r[0] for r in lookup.with_stdpop(codes).select("stdpop").collect()]
    assert found == [None, 5000.0, 2500.0, None, None, None]


def test_geography_types_do_not_fan_out(spark):
    geography = joins.local_table(
        spark,
        [(1, "Locality (resident)", "a", "North"), (2, "Locality (registered)", "b", "North")],
        "aggregation_id int, aggregation_type string, aggregation_code string, aggregation_label string",
    )
    df = spark.createDataFrame([("North",), ("South",)], "area string")
    mapped = lookup.map_geography(df, geography, ["Locality (resident)"], by="label")
    assert rows_of(mapped) == [("North", 1), ("South", None)]


def test_practice_filter_ignores_case(spark):
    rows = [
        ("P1", "U1", "HOME ", 1.0), ("P2", "closed PRACTICE", "home", 1.0),
        ("m88006", "U1", "home", 1.0), ("P3", "U1", "away", 1.0), ("P4", "U1", "home", None),
    ]
    df = spark.createDataFrame(rows, "practice_code string, pcn_code string, system string, numerator double")
    assert [r[0] for r in select.filter_practices(df, "Home").collect()] == ["P1"]


def test_preview_and_top_rows(spark):
    df = spark.range(20).toDF("a")
    assert select.preview(df, 3).count() == 3
    assert [r.a for r in select.top_n(df, 2, F.desc("a")).collect()] == [19, 18]


def test_area_filter_without_an_area_column_keeps_all(spark):
    df = spark.createDataFrame([("a",)], "x string")
    listed = spark.createDataFrame([("b",)], "c string")
    assert select.filter_areas(df, listed) is df


# completeness -----------------------------------------------------------------------------
def periods(spark, rows):
    return spark.createDataFrame(
        rows, "indicator_id int, year_type string, time_period_type string, start_date date, end_date date"
    )


def year(i, first, kind="Calendar", label="1 year"):
    return (i, kind, label, date(first, 1, 1), date(first, 12, 31))


def test_open_cycle_is_left_out(spark):
    df = periods(spark, [year(1, y) for y in (2021, 2022, 2023, 2024)])
    kept, excluded = complete.exclude_incomplete(df, current_date=date(2024, 6, 30))
    assert sorted(r.start_date.year for r in kept.collect()) == [2021, 2022, 2023]
    assert [r.start_date.year for r in excluded.collect()] == [2024]
    assert kept.columns == df.columns
    assert rows_of(complete.excluded_counts(excluded)) == [(1, 1)]


def test_cycle_ending_today_is_complete(spark):
    df = periods(spark, [year(1, y) for y in (2022, 2023)])
    assert complete.exclude_incomplete(df, current_date=date(2023, 12, 31))[1].isEmpty()


def test_odd_length_is_left_out_only_when_enforced(spark):
    odd = (1, "calendar", "1 YEAR", date(2022, 7, 1), date(2022, 12, 31))
    df = periods(spark, [year(1, y) for y in (2019, 2020, 2021, 2022)] + [odd])
    today = date(2024, 1, 1)
    assert complete.exclude_incomplete(df, current_date=today)[1].count() == 1
    assert complete.exclude_incomplete(df, current_date=today, enforce_duration=False)[1].isEmpty()
    assert complete.exclude_incomplete(df, current_date=today, tolerance_days=400)[1].isEmpty()


def test_rows_without_label_or_past_use_the_year_end(spark):
    rows = [(1, "Other", None, date(2024, 1, 1), date(2024, 8, 1)), (1, None, None, date(2022, 1, 1), None)]
    kept, excluded = complete.exclude_incomplete(periods(spark, rows), current_date=date(2024, 6, 30))
    assert kept.isEmpty() and excluded.count() == 2


def test_unlabelled_past_rows_form_their_own_cycle(spark):
    rows = [(1, "Other", None, date(2023, 1, 1), date(2023, 2, 10))] * 2
    kept, _ = complete.exclude_incomplete(periods(spark, rows), current_date=date(2024, 6, 30))
    assert kept.count() == 2


def test_leap_day_cycle_without_leap_year_keeps_nothing(spark):
    rows = [(1, "Other", "1 year", date(2023, 3, 1), date(2024, 2, 29))]
    kept, _ = complete.exclude_incomplete(periods(spark, rows), current_date=date(2025, 6, 30))
    assert kept.isEmpty()


def test_mode_takes_the_smallest_of_equals(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, None), (2, None)], "k int, v string")
    assert rows_of(complete.group_mode(df, ["k"], "v")) == [(1, "a")]


def test_median_of_one_group_of_all_rows(spark, capsys):
    rng = random.Random(9)
    for n in (501, 500, 1):
        values = [rng.randrange(10**6) / 8 for _ in range(n)]
        df = joins.local_table(spark, [(1, v) for v in values], "k int, v double")
        found = complete.group_median(df, ["k"], "v")
        assert found.first().median == statistics.median(values)
        weighted = complete.group_median(df.withColumn("w", F.expr("int(v) % 3")), ["k"], "v", "w")
        every = [v for v in values for _ in range(int(v) % 3)]
        assert weighted.first().median == (statistics.median(every) if every else None)
    found.explain()
    assert "percentile" not in capsys.readouterr().out


def test_median_averages_the_middle_pair(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 4.0), (1, None), (2, None)], "k int, v double")
    assert rows_of(complete.group_median(df, ["k"], "v")) == [(1, 2.5), (2, None)]


# pooling ----------------------------------------------------------------------------------
def census(spark, rows):
    """Rows of (area, year, numerator, denominator)."""
    codes = [k for k in POOL_KEYS if k not in ("aggregation_id", "creation_date")]
    layout = ", ".join(f"{k} int" for k in codes) + (
        ", aggregation_id int, creation_date timestamp, start_date date, numerator double, "
        "denominator double, time_period_type string, year_type string, population_type string"
    )
    return spark.createDataFrame(
        [
            (*[1] * len(codes), area, datetime(2024, 1, 1), date(y, 1, 1), x, n, "1 year", "Calendar", "Census")
            for area, y, x, n in rows
        ],
        layout,
    )


def test_windows_cover_the_whole_span_even_for_gappy_groups(spark):
    rows = [(1, y, 1.0, 10.0) for y in range(2015, 2020)] + [(2, 2015, 1.0, 10.0), (2, 2019, None, None)]
    pooled = pooling.pool_years(census(spark, rows))
    found = {
        (r.aggregation_id, r.time_period_type, r.start_date.year): (r.numerator, r.denominator)
        for r in pooled.collect()
    }
    assert found[(1, "3 year pooled", 2015)] == (3.0, 30.0)
    assert found[(1, "5 year pooled", 2015)] == (5.0, 50.0)
    assert found[(2, "3 year pooled", 2015)] == (1.0, 10.0)
    assert found[(2, "3 year pooled", 2017)] == (0.0, 0.0)
    assert (2, "3 year pooled", 2016) not in found
    assert len(found) == 4 + 3


def test_short_span_gives_no_windows(spark):
    assert pooling.pool_years(census(spark, [(1, 2020, 1.0, 2.0), (1, 2021, 1.0, 2.0)])).isEmpty()


def test_pooled_rows_need_one_shuffle_beyond_the_yearly_totals(spark):
    pooled = pooling.pool_years(census(spark, [(1, y, 1.0, 10.0) for y in range(2015, 2020)]))
    text = pooled._jdf.queryExecution().executedPlan().toString()
    main = text.split("Subquery subquery")[0] + text[text.rindex("Generate explode"):]
    assert main.count("Exchange hashpartitioning") == 2


def test_year_windows(spark):
    years = spark.createDataFrame([(2014,), (2018,)], "period_year int")
    assert rows_of(pooling.year_windows(years, 3)) == [(2014, 2016, 3), (2015, 2017, 3), (2016, 2018, 3)]
    assert pooling.year_windows(years, 6).isEmpty()
    with pytest.raises(ValueError):
        pooling.year_windows(years, 0)


def test_two_loads_do_not_pool(spark):
    rows = census(spark, [(1, y, 1.0, 10.0) for y in range(2015, 2018)])
    late = rows.withColumn("creation_date", F.lit(datetime(2024, 2, 1)))
    assert pooling.pool_years(rows.union(late)).count() == 2


# rollups ----------------------------------------------------------------------------------
def test_registered_levels_count_each_practice_once(spark):
    rows = [
        ("U1", "North", 1.0, 10.0), ("U1", "Solihull", 2.0, 10.0), ("closed practice", "East", 4.0, 10.0),
        ("U2", "Not applicable", 8.0, 10.0),
    ]
    df = spark.createDataFrame(rows, "pcn_code string, locality string, numerator double, denominator double")
    rolled = rollup.rollup_registered(df, [])
    found = {(r.level, r.area): r.numerator for r in rolled.collect()}
    assert found == {
        ("pcn", "U1"): 3.0, ("pcn", "U2"): 8.0,
        ("locality", "North"): 1.0, ("locality", "Solihull"): 2.0, ("locality", "East"): 4.0,
        ("la", "E08000025"): 5.0, ("la", "E08000029"): 2.0,
        ("icb", GEOGRAPHY.icb_code): 15.0,
    }


def test_splits_tell_a_missing_category_from_the_total(spark):
    df = spark.createDataFrame(
        [(1, None, 1, 1.0, 2.0), (1, 2, 1, 4.0, 8.0), (1, 2, None, 16.0, 32.0)],
        "area int, imd_code int, ethnicity_code int, numerator double, denominator double",
    )
    found = {(r.imd_code, r.ethnicity_code): r.numerator for r in rollup.split_sets(df, ["area"]).collect()}
    assert found == {
        (None, 1): 1.0, (2, 1): 4.0, (2, None): 16.0,
        (None, 999): 1.0, (2, 999): 20.0, (999, 1): 5.0, (999, None): 16.0, (999, 999): 21.0,
    }


def test_every_split_sums_to_the_total(spark):
    draw = random.Random(3)
    rows = [(draw.randrange(3), draw.randrange(5), draw.randrange(4), float(draw.randrange(9)), 1.0) for _ in range(300)]
    df = spark.createDataFrame(rows, "area int, imd_code int, ethnicity_code int, numerator double, denominator double")
    everyone = CODES.all_persons
    kinds = {}
    for r in rollup.split_sets(df, ["area"]).collect():
        kind = (r.imd_code == everyone, r.ethnicity_code == everyone)
        kinds[kind] = kinds.get(kind, 0) + r.numerator
    assert len(kinds) == 4 and set(kinds.values()) == {sum(r[3] for r in rows)}


def test_groups_without_events_have_zero(spark):
    den = spark.createDataFrame([("a", None, 5.0), ("b", "x", 3.0)], "k string, e string, denominator double")
    num = spark.createDataFrame([("a", None, 2.0)], "k string, e string, numerator double")
    assert rows_of(rollup.combine_num_den(num, den, ["k", "e"])) == [
        ("a", None, 2.0, 5.0), ("b", "x", 0.0, 3.0),
    ]


def test_people_count_once(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "k string, p int")
    assert rows_of(rollup.person_counts(df, ["k"], "p")) == [("a", 2.0), ("b", 1.0)]


def test_latest_load_keeps_ties(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d")], "indicator_id int, creation_date int, v string")
    assert sorted(r.v for r in sets.latest_load(df).collect()) == ["b", "c", "d"]


# standardisation --------------------------------------------------------------------------
def brute_dsr(rows, z=1.959963984540054):
    """Rows of (x, n, w)."""
    weight = sum(w for _, _, w in rows)
    base = sum((x or 0) * w / n for x, n, w in rows) / weight
    variance = sum((x or 0) * (w / n) ** 2 for x, n, w in rows) / weight**2
    events = sum(x or 0 for x, _, _ in rows)
    low = events * (1 - 1 / (9 * events) - z / (3 * math.sqrt(events))) ** 3
    up = (events + 1) * (1 - 1 / (9 * (events + 1)) + z / (3 * math.sqrt(events + 1))) ** 3
    scale = math.sqrt(variance / events)
    return base, base + scale * (low - events), base + scale * (up - events)


def bands(spark, rows):
    return spark.createDataFrame(
        [("g", float(x) if x is not None else None, float(n), float(w)) for x, n, w in rows],
        "k string, x double, n double, w double",
    )


def test_dsr_against_brute_force(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(0, 40) or None, draw.randrange(100, 9000), w) for w in ESP2013]
    found = standardise.dsr(bands(spark, rows), ["k"], "x", "n", "w", 100_000).first()
    base, low, high = brute_dsr(rows)
    assert found.value == pytest.approx(base * 1e5)
    assert found.lowercl == pytest.approx(low * 1e5)
    assert found.uppercl == pytest.approx(high * 1e5)
    assert found.statistic == "dsr per 100000" and found.confidence == "95%"


def test_dsr_without_events_has_no_limits(spark):
    found = standardise.dsr(bands(spark, [(0, 10, 5), (None, 20, 6)]), ["k"], "x", "n", "w", 1000).first()
    assert (found.value, found.lowercl, found.uppercl, found.total_count) == (0.0, None, None, 0.0)


def test_groups_with_faults_have_no_rate(spark):
    kind = "k int, f int, b int, x double, n double, w double, m double"
    rows = [
        (1, 1, 1, 5.0, 100.0, 10.0, 1.0), (1, 1, 2, 5.0, 100.0, 10.0, 100000.0),
        (2, 1, 1, 5.0, None, 10.0, 1.0), (2, 1, 2, 5.0, 100.0, 10.0, 1.0),
        (3, 1, 1, 5.0, 100.0, 10.0, 1.0), (3, 2, 1, 5.0, 200.0, 10.0, 1.0),
        (4, 1, 1, 5.0, 100.0, 10.0, 1.0), (4, 2, 1, 5.0, 100.0, 10.0, 1.0),
        (5, None, 1, 5.0, 100.0, 10.0, 1.0), (6, 1, None, 5.0, 100.0, 10.0, 1.0),
    ]
    df = spark.createDataFrame(rows, kind)
    rates, rejects = standardise.dsr_checked(df, ["k"], "x", "n", "w", "m", kind="value")
    assert sorted(r.k for r in rates.collect()) == [3, 4, 5, 6]
    assert rows_of(rejects) == [(1, "several multipliers"), (2, "missing denominator")]
    rates, rejects = standardise.dsr_checked(
        df, ["k"], "x", "n", "w", "m", kind="standard", event_freq="f", age_band="b"
    )
    assert [(r.k, r.total_count, r.total_pop) for r in rates.collect()] == [(4, 15.0, 100.0)]
    assert rows_of(rejects) == [
        (1, "several multipliers"), (2, "missing denominator"), (3, "several populations in an age band"),
        (5, "missing event frequency"), (6, "missing age band"),
    ]
    with pytest.raises(ValueError, match="several multipliers"):
        standardise.dsr(df.filter("k = 1"), ["k"], "x", "n", "w", "m", strict=True)
    assert standardise.dsr(df.filter("k = 4"), ["k"], "x", "n", "w", "m", strict=True).count() == 1


def test_dsr_uses_the_bands_present(spark):
    rows = [(3, 100, 5000), (5, 200, 6000)]
    found = standardise.dsr(bands(spark, rows), ["k"], "x", "n", "w", 1).first()
    assert found.base_value == pytest.approx((3 / 100 * 5000 + 5 / 200 * 6000) / 11000)


def test_single_events_agree_with_independent_ones(spark):
    rows = [(3, 100, 5000), (5, 200, 6000), (9, 150, 5500)]
    df = bands(spark, rows).withColumns({"band": F.col("w"), "freq": F.lit(1)})
    plain = standardise.dsr(df, ["k"], "x", "n", "w", 1000, kind="standard").first()
    spread = standardise.dsr(
        df, ["k"], "x", "n", "w", 1000, kind="standard", event_freq="freq", age_band="band"
    ).first()
    assert spread[1:] == pytest.approx(plain[1:])


def test_repeat_events_widen_the_limits(spark):
    df = spark.createDataFrame(
        [("g", b, f, float(x), 1000.0, 5000.0) for b in (1, 2) for f, x in ((1, 10), (2, 5), (3, 2))],
        "k string, band int, freq int, x double, n double, w double",
    )
    found = standardise.dsr(df, ["k"], "x", "n", "w", 1000, event_freq="freq", age_band="band").first()
    assert found.total_count == 2 * (10 + 10 + 6)
    variance = sum(
        f**2 * sum(x * (5000 / 1000) ** 2 for _ in (1, 2)) / 10_000**2 for f, x in ((1, 10), (2, 5), (3, 2))
    )
    limit = (found.total_count + 1) * (
        1 - 1 / (9 * (found.total_count + 1)) + 1.959963984540054 / (3 * math.sqrt(found.total_count + 1))
    ) ** 3
    expected = found.value + math.sqrt(variance / found.total_count) * (limit - found.total_count) * 1000
    assert found.uppercl == pytest.approx(expected)


def test_kinds_and_two_levels(spark):
    df = bands(spark, [(3, 100, 5000), (5, 200, 6000)])
    both = standardise.dsr(df, ["k"], "x", "n", "w", 1, confidence=(0.95, 0.998))
    assert "lower95_0cl" in both.columns and "upper99_8cl" in both.columns
    assert standardise.dsr(df, ["k"], "x", "n", "w", 1, kind="value").columns == [
        "k", "base_value", "multiplier", "value",
    ]
    assert standardise.dsr(df, ["k"], "x", "n", "w", 1, kind="lower").columns[-1] == "lowercl"
    with pytest.raises(ValueError):
        standardise.dsr(df, ["k"], "x", "n", "w", 1, kind="other")
    with pytest.raises(ValueError):
        standardise.dsr(df, ["k"], "x", "n", "w", 1, confidence=(0.9, 0.998))


def test_faulty_rows_are_set_apart(spark):
    rows = [(1.0, 10.0, 5.0, 1.0), (-1.0, 10.0, 5.0, 1.0), (1.0, None, None, 1.0), (1.0, 0.0, 5.0, None)]
    df = spark.createDataFrame(rows, "numerator double, denominator double, stdpop double, multiplier double")
    good, bad = standardise.dsr_validate(df)
    assert good.count() == 1
    assert sorted(r.faults for r in bad.collect()) == [
        "missing denominator; missing standard population",
        "missing multiplier; denominator not positive",
        "negative numerator",
    ]
    with pytest.raises(ValueError, match="negative numerator: 1 rows"):
        standardise.dsr_validate(df, strict=True)


def test_missing_counts_as_a_value_for_constancy(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2), ("b", 2), ("c", 1), ("c", 3), ("d", None)], "k string, m int")
    assert sorted(r.k for r in standardise.constancy_violations(df, ["k"], ["m"]).collect()) == ["a", "c"]
    with pytest.raises(ValueError):
        standardise.assert_constant(df, ["k"], ["m"])


def test_negative_ratio_mirrors_its_size(spark):
    df = spark.createDataFrame(
        [(7.0, 20.0), (-7.0, 20.0), (None, 20.0), (0.0, 20.0)], "numerator double, denominator double"
    ).withColumns({"value_type_code": F.lit(7), "multiplier": F.lit(100.0)})
    plus, minus, empty, zero = standardise.calc_crude_or_ratio(df).collect()
    assert minus.value == -plus.value
    assert (minus.lowercl, minus.uppercl) == (-plus.uppercl, -plus.lowercl)
    assert (empty.value, empty.lowercl, empty.uppercl) == (zero.value, zero.lowercl, zero.uppercl)
    assert zero.lowercl == 0 and zero.uppercl > 0


# ranking ----------------------------------------------------------------------------------
def brute_bands(values, n, invert):
    kept = [v for v in values if v is not None]
    total = len(kept)
    found = []
    for v in values:
        if v is None:
            found.append(None)
            continue
        rank = 1 + sum((o > v) if invert else (o < v) for o in kept)
        band = math.floor((n + 1) - math.ceil(((total + 1) - rank) / (total / n)))
        found.append(band or 1)
    return found


@pytest.mark.parametrize("invert", [True, False])
def test_bands_against_brute_force(spark, invert):
    draw = random.Random(11)
    values = [None if draw.random() < 0.05 else (50.0 if draw.random() < 0.33 else float(draw.randrange(200))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v double")
    banded = ranking.quantile_band(df, "v", 5, invert=invert).orderBy("id")
    assert [r.quantile for r in banded.collect()] == brute_bands(values, 5, invert)


def test_bands_per_group(spark):
    groups = {"a": [3.0, 1.0, 2.0], "b": [5.0] * 7, None: [float(i) for i in range(12)]}
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double")
    found = ranking.quantile_band(df, "v", 4, by=["g"]).collect()
    for g, vs in groups.items():
        wanted = sorted(zip(vs, brute_bands(vs, 4, True)))
        assert sorted((r.v, r.quantile) for r in found if r.g == g) == wanted


def test_ids_are_dense_and_ordered(spark):
    df = spark.range(1000).selectExpr("id % 7 as a", "id as b")
    numbered = ranking.with_surrogate_id(df, ["a", "b"], "n", partitions=5).orderBy("n").collect()
    assert [r.n for r in numbered] == list(range(1, 1001))
    assert [(r.a, r.b) for r in numbered] == sorted((r.a, r.b) for r in numbered)
