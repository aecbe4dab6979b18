import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from ratewell.operators.joins import local_table
from ratewell.schema import FACT_COLS, FACT_SCHEMA
from ratewell.sources import landing, reference, sinks
from ratewell.staging import stage

ROW = {
    "indicator_id": "7.0", "start_date": "2024-01-01", "end_date": "2024-12-31", "numerator": "3",
    "denominator": "n/a", "imd_code": "999", "aggregation_id": "5", "age_group_code": "999",
    "sex_code": "999", "ethnicity_code": "999", "creation_date": "2024-05-06 07:08:09",
    "value_type_code": "2", "source_code": "3",
}


def write(folder, name, columns, rows):
    lines = [",".join(columns)] + [",".join(str(r.get(c, "")) for c in columns) for r in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


def test_templates(spark, tmp_path):
    write(tmp_path, "ID_1_good.csv", FACT_COLS, [ROW, {**ROW, "indicator_id": "8"}])
    write(tmp_path, "id_2 turned.csv", [*reversed(FACT_COLS), "note"], [{**ROW, "note": "x"}])
    write(tmp_path, "ID_3_bad.csv", FACT_COLS, [ROW])
    write(tmp_path, "ID_4_short.csv", FACT_COLS[:-1], [ROW])
    write(tmp_path, "ID_5_unlisted.csv", FACT_COLS, [ROW])
    write(tmp_path, "other.csv", FACT_COLS, [ROW])
    manifest = local_table(
        spark,
        [("ID_1_good.csv", "0"), ("id_2 turned.csv", "0.0"), ("ID_3_bad.csv", "2"), ("ID_4_short.csv", "0")],
        "file_name string, validation_value string",
    )
    rows, status = landing.ingest_templates(spark, str(tmp_path), manifest)
    assert {r.file_name: r.status for r in status.collect()} == {
        "ID_1_good.csv": "accepted", "id_2 turned.csv": "accepted", "ID_3_bad.csv": "failed",
        "ID_4_short.csv": "failed", "ID_5_unlisted.csv": "failed",
    }
    assert rows.columns == FACT_COLS
    found = rows.collect()
    assert sorted(r.indicator_id for r in found) == [7, 7, 8]
    assert {(r.numerator, r.denominator, r.start_date) for r in found} == {(3.0, None, date(2024, 1, 1))}


def test_no_templates(spark, tmp_path):
    write(tmp_path, "other.csv", FACT_COLS, [ROW])
    manifest = local_table(spark, [], "file_name string, validation_value string")
    rows, status = landing.ingest_templates(spark, str(tmp_path), manifest)
    assert rows.isEmpty() and status.isEmpty() and rows.columns == FACT_COLS


def test_api_extracts_are_matched_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Area Code,Value\nE1,1.50\nE2,2\n")
    (tmp_path / "b.csv").write_text('Value,Extra,Area Code\n"3, or so",x,E1\n')
    (tmp_path / "c.csv").write_text("No data available\n")
    (tmp_path / "d.csv").write_text("Area Code,Value\n")
    (tmp_path / "e.csv").write_text("")
    rows = landing.land_api_csv(spark, str(tmp_path))
    assert {f.dataType.simpleString() for f in rows.schema} == {"string"}
    found = {(r["Area Code"], r["Value"], r["Extra"]) for r in rows.collect()}
    assert found == {("E1", "1.50", None), ("E2", "2", None), ("E1", "3, or so", "x")}
    listed = local_table(spark, [("E2",), ("E2",)], "code string")
    assert landing.land_api_csv(spark, str(tmp_path), listed).count() == 1


def jobs_of(spark, work):
    tracker, group = spark.sparkContext.statusTracker(), f"jobs-{work.__name__}-{id(work)}"
    spark.sparkContext.setJobGroup(group, "")
    found = work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(tracker.getJobIdsForGroup(group))


def test_headers_quotes_and_files_without_rows(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Area Code,"Value, all",Note\nE1,1,"two\nlines"\nE2,2,"a ""b"", c"\n')
    (tmp_path / "b b.csv").write_text('Note,Area Code\n,E3\n')
    (tmp_path / "c.csv").write_text("Area Code,extra\n")
    rows = landing.land_api_csv(spark, str(tmp_path))
    assert sorted(rows.columns) == ["Area Code", "Note", "Value, all"]
    found = sorted((r["Area Code"], r["Value, all"], r["Note"]) for r in rows.collect())
    assert found == [("E1", "1", "two\nlines"), ("E2", "2", 'a "b", c'), ("E3", None, None)]


def quoted(rng, newline):
    """A well-formed CSV text: cells of quotes, commas and line breaks in quotes, blank lines between records."""
    lines = ["a,b,c"]
    for _ in range(rng.randint(40, 80)):
        cells = []
        for _ in range(3):
            cell = "".join(rng.choice(['x', 'é', ',', '"', newline, newline * 2, ' ']) for _ in range(rng.randint(0, 6)))
            plain = not any(c in cell for c in ',"\n\r')
            cells.append(cell if plain and cell and rng.random() < 0.5 else '"' + cell.replace('"', '""') + '"')
        lines += [",".join(cells)] + [""] * (rng.random() < 0.1)
    return newline.join(lines) + newline * rng.randint(0, 2)


@pytest.mark.parametrize("block", [300, 1 << 20])
def test_blocks_of_a_file_give_the_records_of_the_whole(spark, tmp_path, block):
    rng = random.Random(block)
    for k in range(4):
        (tmp_path / f"f{k}.csv").write_bytes(quoted(rng, "\n" if k % 2 else "\r\n").encode())
    keys = {"spark.sql.files.maxPartitionBytes": str(block), "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        lines = landing.csv_lines(spark, str(tmp_path))
        rows = landing.read_by_header(lines, landing.csv_headers(lines)).select("a", "b", "c", "file_name")
        found = sorted(map(repr, rows.collect()))
        if block < 1000:
            assert lines.select("file_path", "block").distinct().count() > 12
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole = spark.read.schema("a string, b string, c string").options(header=True, multiLine=True, escape='"').csv(str(tmp_path))
    expected = whole.withColumn("file_name", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    assert found == sorted(map(repr, expected.collect())) and len(found) > 100


def test_jobs_do_not_grow_with_headers(spark, tmp_path):
    for k in range(40):
        folder = tmp_path / ("few" if k < 2 else "many")
        folder.mkdir(exist_ok=True)
        (folder / f"f{k}.csv").write_text(f"Area Code,Value {k}\nE{k},{k}\n")
    (_, few), (rows, many) = (
        jobs_of(spark, lambda n=n: landing.land_api_csv(spark, str(tmp_path / n))) for n in ("few", "many")
    )
    assert many < 30 and many <= 2 * few and len(rows.columns) == 39
    assert sorted((r["Area Code"], r["Value 7"]) for r in rows.collect() if r["Value 7"]) == [("E7", "7")]


def test_api_without_data(spark, tmp_path):
    (tmp_path / "c.csv").write_text("No data\n")
    assert landing.land_api_csv(spark, str(tmp_path)) is None


def test_population_file_gets_snake_names(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Area Code,In Table (Internal),Start Age\nE1,x,5\n")
    df = landing.read_snake(spark, str(tmp_path / "p.csv"), drop=["in_table_internal"])
    assert df.columns == ["area_code", "start_age"] and df.first().start_age == 5


def results(spark, rows):
    return spark.createDataFrame(rows, "indicator_id int, v string")


def content(spark, table):
    rows = [tuple(r) for r in spark.table(table).select("indicator_id", "v").collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r))


@pytest.fixture
def published(spark):
    sinks.create_results(results(spark, [(1, "a"), (1, "b"), (2, "c"), (3, "d")]), "published")
    yield "published"
    sinks.drop_results(spark, "published")


def test_replace_some(spark, published):
    sinks.replace_indicators(results(spark, [(1, "new"), (4, "more")]), published, [1, 2])
    assert content(spark, published) == [(1, "new"), (3, "d"), (4, "more")]


def test_replace_all(spark, published):
    sinks.replace_indicators(results(spark, [(2, "only")]), published, "all")
    assert content(spark, published) == [(2, "only")]


def test_replace_with_nothing(spark, published):
    sinks.replace_indicators(results(spark, []), published, "1, 3")
    assert content(spark, published) == [(2, "c")]


def test_replace_what_was_submitted(spark, published):
    sinks.replace_submitted(results(spark, [(2, "x"), (2, "y"), (None, "z")]), published)
    assert content(spark, published) == [
        (1, "a"), (1, "b"), (2, "x"), (2, "y"), (3, "d"), (None, "z"),
    ]


def test_results_can_come_from_themselves(spark, published):
    sinks.replace_indicators(spark.table(published).withColumn("v", F.concat("v", F.lit("!"))), published, None)
    sinks.replace_indicators(spark.table(published).filter("indicator_id = 1"), published, [2])
    assert content(spark, published) == [(1, "a!"), (1, "a!"), (1, "b!"), (1, "b!"), (3, "d!")]


@pytest.mark.parametrize("step", ["_write", "_switch", "_drop_hidden"])
@pytest.mark.parametrize("late", [False, True])
def test_a_stopped_run_leaves_the_old_or_the_new_rows(spark, published, monkeypatch, step, late):
    old, new = content(spark, published), [(1, "new"), (3, "d"), (4, "more")]
    original = getattr(sinks, step)

    def stopped(*args):
        if late:
            original(*args)
        raise KeyboardInterrupt(step)

    monkeypatch.setattr(sinks, step, stopped)
    with pytest.raises(KeyboardInterrupt):
        sinks.replace_indicators(results(spark, [(1, "new"), (4, "more")]), published, [1, 2])
    monkeypatch.undo()
    switched = step == "_drop_hidden" or (step == "_switch" and late)
    assert content(spark, published) == (new if switched else old)
    sinks.replace_indicators(results(spark, [(1, "new"), (4, "more")]), published, [1, 2, 4])
    assert content(spark, published) == new
    assert spark.sql(f"SHOW PARTITIONS {published}_loads").count() == 3


def test_a_write_that_fails_half_way_shows_nothing(spark, published):
    old = content(spark, published)
    rows = spark.range(100, numPartitions=4).selectExpr(
        "cast(id % 5 as int) as indicator_id", "case when id = 99 then raise_error('stop') else 'x' end as v"
    )
    with pytest.raises(Exception, match="stop"):
        sinks.replace_indicators(rows, published, "all")
    assert content(spark, published) == old


def test_results_show_only_the_partitions_of_an_indicator(spark, published):
    sinks.replace_indicators(results(spark, [(1, "new")]), published, [1])
    plan = spark.table(published).filter("indicator_id = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "load_id" in plan.split("PartitionFilters: [")[1]


def test_append_and_selection_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "facts")
    row = (1, date(2024, 1, 1), date(2024, 12, 31), 1.0, 2.0, None, None, None, 1, 1, 1, 1, 1, None, 2, 1)
    sinks.append_fact(spark.createDataFrame([row], FACT_SCHEMA), path)
    sinks.append_fact(spark.createDataFrame([(2, *row[1:])], FACT_SCHEMA), path)
    df = landing.read_landing(spark, path)
    assert df.count() == 2
    plan = df.filter("indicator_id IN (2)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(indicator_id" in plan


def test_tables_are_overwritten(spark, tmp_path):
    path = str(tmp_path / "dims")
    reference.load_reference({"sex": local_table(spark, [(1, "a"), (2, "b")], "c int, s string")}, path)
    reference.load_reference({"sex": local_table(spark, [(3, "z")], "c int, s string")}, path)
    assert [tuple(r) for r in landing.read_dim(spark, f"{path}/sex").collect()] == [(3, "z")]


def test_dated_extract(spark, tmp_path):
    target = sinks.write_csv_extract(spark.range(3), str(tmp_path), date(2025, 9, 10))
    assert target.endswith("extract_20250910")
    assert spark.read.csv(target, header=True).count() == 3


def test_ward_quintiles(spark):
    wards = spark.createDataFrame([(f"W{i}", float(i)) for i in range(10)], "ward_code string, score double")
    found = {r.ward_code: r.quintile for r in reference.ward_quintiles(wards).collect()}
    assert [found[f"W{i}"] for i in range(10)] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(5).toDF("a"))
    assert staged.count() == 5
    assert spark.conf.get("spark.checkpoint.dir") in staged.inputFiles()[0]
