import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ratewell.catalog import enrichment, run
from ratewell.catalog.tables import Tables
from ratewell.operators.joins import local_table
from ratewell.plans import build, calculate, population, quality
from ratewell.schema import CODES, FACT_SCHEMA, GEOGRAPHY, PROCESSED_SCHEMA, TIDY_COLS, TIDY_SCHEMA
from ratewell.sources.reference import age_groups

TODAY = date(2026, 6, 30)
METADATA = (
    "indicator_id int, age string, year_type string, multiplier double, status_code int, "
    "population_type string, precalculated string"
)
INDICATORS = [
    (1, "All ages", "Calendar", 100.0, 1, "GP registered", "No"),
    (2, "All ages", "Calendar", 1000.0, 2, "GP registered", "No"),
    (3, "<75 yrs", "Calendar", 100000.0, 1, "GP registered", "No"),
    (4, "All ages", "Calendar", 1.0, 1, "GP registered", "Yes"),
    (5, "All ages", "Calendar", None, 1, "GP registered", "No"),
    (6, "All ages", "Calendar", 100.0, 3, "GP registered", "No"),
    (7, "All ages", "Calendar", 100.0, 1, "Census", "No"),
]


def metadata(spark):
    return local_table(spark, INDICATORS, METADATA)


def ages(spark):
    return age_groups(spark, {21: (0, 74, "<75 yrs")})


def fact(indicator, x, n, kind, value=None, age=999, imd=1, ethnicity=1, year=2024, area=1, end=None):
    return (
        indicator, date(year, 1, 1), end or date(year, 12, 31), x, n, value, None, None, imd, area, age,
        999, ethnicity, datetime(2026, 1, 1), kind, 1,
    )


def calculated(spark, rows, **options):
    df = spark.createDataFrame(rows, FACT_SCHEMA)
    return calculate.calculate_values(df, metadata(spark), ages(spark), TODAY, **options)


def test_routes(spark):
    result = calculated(
        spark,
        [
            fact(1, 5.0, 10.0, 2),
            fact(1, None, 10.0, 2),
            fact(1, 5.0, None, 2),
            fact(1, 5.0, 0.0, 2),
            fact(1, 5.0, 10.0, 2, value=42.0),
            fact(2, 30.0, 10.0, 3),
            fact(4, -7.0, 20.0, 7),
            fact(5, 5.0, 10.0, 2),
            fact(6, 5.0, 10.0, 2),
            fact(1, 5.0, 10.0, None),
            fact(1, 5.0, 10.0, 5),
            fact(99, 5.0, 10.0, 2),
        ],
    )
    assert result.percentage.count() == 2
    assert result.crude_ratio.count() == 2
    assert result.keep.count() == 3
    assert result.skip.count() == 4
    assert result.unsupported.count() == 1
    assert result.combined.count() == 11
    shares = sorted(result.percentage.select("numerator", "indicator_value").collect())
    assert [tuple(r) for r in shares] == [(0.0, 0.0), (5.0, 50.0)]
    kept = sorted(r.denominator for r in result.keep.collect())
    assert kept == [0.0, 0.0, 10.0]
    ratio = result.crude_ratio.filter("value_type_code = 7").first()
    assert ratio.indicator_value == pytest.approx(-0.35)
    assert ratio.lower_ci95 < ratio.indicator_value < ratio.upper_ci95
    reasons = {(r.indicator_id, r.reasons) for r in result.skip_reasons.collect()}
    assert reasons == {
        (1, "missing value_type_code; unsupported value_type_code"),
        (5, "missing multiplier"),
        (6, "status_code = 3"),
        (99, "missing multiplier; status_code = NA"),
    }


def test_layout_is_always_the_same(spark):
    result = calculated(spark, [fact(1, 5.0, 10.0, 2)])
    for part in (result.combined, result.keep, result.skip, result.dasr, result.unsupported):
        assert part.columns == TIDY_COLS
    assert {f.name: f.dataType for f in result.combined.schema} == {f.name: f.dataType for f in TIDY_SCHEMA}
    published = calculate.processed_rows(result.combined, datetime(2026, 7, 1))
    assert published.columns == PROCESSED_SCHEMA.fieldNames()


def test_text_input_is_cast(spark):
    df = spark.createDataFrame([fact(1, 5.0, 10.0, 2)], FACT_SCHEMA)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    result = calculate.calculate_values(text, metadata(spark), ages(spark), TODAY)
    assert result.combined.first().indicator_value == 50.0


def test_dasr_takes_the_age_code_of_its_indicator(spark):
    rows = [fact(3, float(i), 1000.0, 4, age=i) for i in range(1, 16)] + [fact(3, 1.0, 10.0, 4, age=999)]
    result = calculated(spark, rows)
    found = result.dasr.collect()
    assert len(found) == 1
    assert (found[0].age_group_code, found[0].numerator, found[0].denominator) == (21, 120.0, 15000.0)
    assert found[0].lower_ci95 < found[0].indicator_value < found[0].upper_ci95
    assert [r.faults for r in result.rejected.collect()] == ["missing standard population"]


def test_census_rows_are_pooled_and_kept(spark):
    rows = [fact(7, 5.0, 10.0, 2, year=y) for y in range(2019, 2024)]
    result = calculated(spark, rows)
    labels = {}
    for r in result.percentage.collect():
        labels.setdefault(r.time_period_type, []).append((r.start_date.year, r.denominator, r.indicator_value))
    assert sorted(labels["1 year"]) == [(y, 10.0, 50.0) for y in range(2019, 2024)]
    assert sorted(labels["3 year pooled"]) == [(y, 30.0, 50.0) for y in (2019, 2020, 2021)]
    assert labels["5 year pooled"] == [(2019, 50.0, 50.0)]


def test_already_pooled_rows_pool_again_unless_told(spark):
    rows = [fact(7, 5.0, 10.0, 2, year=y) for y in range(2019, 2024)]
    rows.append(fact(7, 5.0, 10.0, 2, year=2019, end=date(2021, 12, 31)))
    assert calculated(spark, rows).combined.filter("denominator = 60").count() == 1
    assert calculated(spark, rows, only_yearly=True).combined.filter("denominator = 60").isEmpty()


def test_percentages_bracket_their_value(spark):
    rows = [fact(1, float(x), 40.0, 2, area=x) for x in range(41)]
    for r in calculated(spark, rows).percentage.collect():
        assert r.lower_ci95 - 1e-9 <= r.indicator_value <= r.upper_ci95 + 1e-9
        assert 0 <= r.upper_ci95 <= 100 + 1e-9


def test_missing_metadata_column_is_an_error(spark):
    df = spark.createDataFrame([fact(1, 5.0, 10.0, 2)], FACT_SCHEMA)
    with pytest.raises(Exception, match="multiplier"):
        calculate.calculate_values(df, metadata(spark).drop("multiplier"), ages(spark), TODAY)


def test_facts_never_meet_dimensions_by_sorting(spark):
    result = calculated(spark, [fact(7, 5.0, 10.0, 2, year=y) for y in range(2019, 2024)])
    text = result.combined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text and "Python" not in text


# quality ----------------------------------------------------------------------------------
def test_checks_find_what_is_wrong(spark):
    df = calculated(spark, [fact(1, 5.0, 10.0, 2), fact(1, 5.0, 10.0, 2), fact(2, 3.0, 10.0, 3, imd=None)]).combined
    reference = spark.createDataFrame([fact(1, 5.0, 10.0, 2)], FACT_SCHEMA)
    summary = {r.check_id: (r.failures, r.passed) for r in quality.run_all_checks(df, reference, metadata(spark)).collect()}
    assert summary == {
        1: (2, False), 2: (0, True), 3: (0, True), 4: (0, True), 5: (0, True), 6: (1, False), 7: (1, False),
    }
    assert quality.check_duplicates(df, ids="2").isEmpty()
    assert quality.check_duplicates(df, ["indicator_id"]).first().row_count == 2


# population -------------------------------------------------------------------------------
def test_age_ranges(spark):
    rows = [
        (1, "All ages", "DASR", 1), (2, "<75 yrs", "DASR", 1), (3, "65+ yrs", "DASR", 1),
        (4, "65+ yrs", "Percentage", 1), (5, "unknown", "DASR", 1), (None, "All ages", "DASR", 1),
        (6, "12-17 yrs", "DASR", 2),
    ]
    df = local_table(spark, rows, "indicator_id int, age string, value_type string, status_code int")
    groups = age_groups(spark, {20: (65, 120, "65+ yrs"), 21: (0, 74, "<75 yrs"), 22: (12, 17, "12-17 yrs")})
    types = local_table(spark, [(4, "DASR"), (2, "Percentage")], "value_type_code int, value_type string")
    found = {
        r.indicator_id: (r.min_age_code, r.max_age_code)
        for r in population.age_metadata(df, groups, types).collect()
    }
    assert found == {
        1: (1, 18), 2: (1, 15), 3: (14, 18), 4: (20, 20), 5: (None, None), 6: (None, None),
    }


def test_population_codes_totals_and_unknowns(spark):
    raw = local_table(
        spark,
        [
            (1, 10, "ALL", "ALL", 0, 120, "ALL", 3, "Persons", 100),
            (2, 10, "1 most deprived", "0-4", 0, 4, "A", 1, "Male", 7),
            (3, 10, "1 most deprived", "0-4", 0, 4, "A", 1, "Male", 7),
            (4, 10, "9", "3-5", 3, 5, "?", 2, "Female", None),
        ],
        "population_id int, aggregation_id int, imd string, age_group string, start_age int, end_age int, "
        "nhs_code string, sex_code int, sex string, observation int",
    )
    coded = population.code_population(
        raw,
        local_table(spark, [("1", 1)], "imd_quintile string, imd_code int"),
        local_table(spark, [("A", 1)], "nhs_code string, ethnicity_code int"),
        local_table(spark, [(1, "Male"), (2, "Female")], "sex_code int, sex string"),
        ages(spark),
    )
    found = sorted(
        (tuple(r) for r in coded.select("imd_code", "age_code", "ethnicity_code", "sex_code", "observation").collect()),
        key=repr,
    )
    assert found == [(1, 1, 1, 1, 7), (999, 999, 999, 999, 100), (None, None, None, 2, None)]


# builds -----------------------------------------------------------------------------------
def test_diagnoses_do_not_multiply_events(spark):
    layout = "episode_id bigint, admission_method string, order_in_spell int, reconciliation_month int, historic int"
    episodes = spark.createDataFrame(
        [(1, "21", 1, 202001, 0), (2, "21", 2, 202001, 0), (3, "11", 1, 202001, 0), (4, "2A", 1, 202101, 0), (5, "22", 1, 202001, 0)],
        layout,
    )
    places = spark.createDataFrame(
        [(1, "E08000025"), (1, "E08000025"), (2, "E08000025"), (3, "E08000025"), (4, "E08000025"), (5, "E99")],
        "episode_id bigint, area_code string",
    )
    diagnoses = spark.createDataFrame(
        [(1, "X601"), (1, "X84"), (2, "X60"), (3, "X60"), (4, "X65"), (5, "X60")],
        "episode_id bigint, diagnosis_code string",
    )
    members = build.cohort(episodes, places, 201904, 202508, ["E08000025"])
    assert sorted(r.episode_id for r in members.collect()) == [1, 2, 3, 4]
    found = build.numerator_events(members, [(0, episodes, diagnoses)])
    assert [r.episode_id for r in found.collect()] == [1]


def test_person_with_two_source_ethnicities_counts_once(spark):
    audit = spark.createDataFrame(
        [("202122", "1", 40, 1, "A", "P1", 7, 1), ("202122", "1", 40, 1, "B", "P1", 7, 1)],
        "financial_year string, imd_quintile string, age int, sex int, ethnicity string, practice_code string, "
        "person_id bigint, complete int",
    )
    known = spark.createDataFrame([(7, "C")], "person_id bigint, ethnic_code string")
    counts = build.audit_counts(audit, known, F.lit(True), F.col("complete") == 1)
    assert [(r.ethnicity, r.numerator, r.denominator) for r in counts.collect()] == [("C", 1.0, 1.0)]


def test_codes_are_the_published_ones():
    assert (CODES.all_persons, CODES.unknown) == (999, -99)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_events_are_shuffled_by_episode_once(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    whole = build.episode_events(
        t.episodes(), t.diagnoses(), t.places(), t.demographic(), t.dates(),
        enrichment.FIRST_MONTH, enrichment.LAST_MONTH, GEOGRAPHY.authorities,
    )
    stepwise = build.with_places(enrichment.detailed(t), t.places())
    columns = ["episode_id", "historic", "person_id", "age", "financial_year", "ethnicity", "lsoa_2021", "lsoa_2011"]
    assert sorted(map(str, whole.select(columns).collect())) == sorted(map(str, stepwise.select(columns).collect()))
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(episode_id") == 1


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_checks_read_written_rows_in_one_scan(spark):
    plan = run("all_checks", spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "lineitem" not in plan
    shown = run("failing_rows", spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    limit = shown.index("WindowGroupLimit", shown.index("WindowGroupLimit") + 1)
    assert "Exchange" in shown[:limit]  # the limit below the shuffle is taken by each task
