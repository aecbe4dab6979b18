import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from ratewell.functions import casts, codes, dates, intervals, names
from ratewell.operators.select import normalise_ids


def column(spark, values, kind, *expressions):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [tuple(r) for r in df.select(*expressions).collect()]


def poisson_cdf(k, mean):
    return sum(math.exp(-mean + i * math.log(mean) - math.lgamma(i + 1)) for i in range(k + 1))


def gamma_cdf(shape, y):
    term = total = 1.0
    for k in range(1, 400):
        term *= y / (shape + k)
        total += term
    return math.exp(shape * math.log(y) - y - math.lgamma(shape + 1)) * total


def test_wilson_matches_the_formula(spark):
    pairs = [(0, 10), (1, 1), (3, 7), (50, 50), (123, 4567)]
    df = spark.createDataFrame([(float(x), float(n)) for x, n in pairs], "x double, n double")
    rows = df.select("x", "n", *intervals.wilson(F.col("x"), F.col("n"))).collect()
    z = 1.959963984540054
    for x, n, low, high in rows:
        p = x / n
        centre, spread = 2 * x + z * z, z * math.sqrt(z * z + 4 * x * (1 - p))
        assert low == pytest.approx((centre - spread) / (2 * (n + z * z)), abs=1e-12)
        assert high == pytest.approx((centre + spread) / (2 * (n + z * z)), abs=1e-12)
        assert low - 1e-12 <= p <= high + 1e-12


def test_wilson_of_nothing_is_null(spark):
    rows = column(spark, [0.0], "double", *intervals.wilson(F.col("x"), F.lit(0.0)))
    low, high = rows[0]
    assert low is None and high is None


def test_exact_table_solves_the_poisson_tails():
    low, high = intervals.exact_poisson_table()
    assert low[0] == 0
    for k in range(10):
        assert poisson_cdf(k, high[k]) == pytest.approx(0.025, abs=1e-10)
        if k:
            assert poisson_cdf(k - 1, low[k]) == pytest.approx(0.975, abs=1e-10)
    assert high[9] == pytest.approx(17.084803, abs=1e-6)


def test_limits_switch_at_ten(spark):
    rows = column(spark, [9.0, 10.0, 1000.0], "double", "x", *intervals.poisson_limits(F.col("x")))
    low, high = intervals.exact_poisson_table()
    assert rows[0][1:] == (low[9], high[9])
    for x, lower, upper in rows[1:]:
        z = intervals.z_value(0.95)
        assert lower == pytest.approx(x * (1 - 1 / (9 * x) - z / (3 * math.sqrt(x))) ** 3)
        y = x + 1
        assert upper == pytest.approx(y * (1 - 1 / (9 * y) + z / (3 * math.sqrt(y))) ** 3)


def test_fractional_counts_solve_the_gamma_tails(spark):
    values = [0.2, 0.5, 1.5, 4.25, 9.9]
    rows = column(spark, values, "double", "x", *intervals.poisson_limits(F.col("x")))
    for x, low, high in rows:
        assert gamma_cdf(x, low) == pytest.approx(0.025, abs=1e-9)
        assert gamma_cdf(x + 1, high) == pytest.approx(0.975, abs=1e-9)
        assert low < x < high


def test_limits_grow_with_the_count(spark):
    values = [i / 4 for i in range(0, 60)]
    rows = column(spark, values, "double", "x", *intervals.poisson_limits(F.col("x")))
    rows = sorted(r for r in rows if r[0] < 10)
    assert all(a[1] <= b[1] and a[2] <= b[2] for a, b in zip(rows, rows[1:]))


def test_byars_at_zero_has_no_lower_limit(spark):
    assert column(spark, [0.0], "double", intervals.byars_lower(F.col("x")))[0][0] is None


@pytest.mark.parametrize("level", [0.5, 12, 101])
def test_confidence_is_checked(level):
    with pytest.raises(ValueError):
        intervals.z_value(level)


def test_confidence_as_percentage():
    assert intervals.z_value(99.8) == pytest.approx(3.090232306167813)


@pytest.mark.parametrize(
    "start, end, label",
    [
        ("2020-01-01", "2020-12-31", "1 year"),
        ("2020-01-01", "2021-01-01", "1 year"),
        ("2020-04-01", "2023-03-31", "3 year pooled"),
        ("2020-04-01", "2025-04-01", "5 year pooled"),
        ("2020-02-29", "2021-02-28", "1 year"),
        ("2020-02-29", "2021-02-27", "1 year"),
        ("2020-01-01", "2020-06-30", None),
        ("2020-01-01", None, None),
    ],
)
def test_duration_label(spark, start, end, label):
    df = spark.createDataFrame([(start, end)], "s string, e string")
    shown = df.select(dates.duration_label(F.col("s").cast("date"), F.col("e").cast("date")))
    assert shown.first()[0] == label


def test_financial_year(spark):
    rows = column(
        spark, ["202122E4", "199900"], "string",
        dates.fy_standardise(F.col("x")), *dates.fy_bounds(dates.fy_standardise(F.col("x"))),
    )
    assert rows[0] == ("2021-22", date(2021, 4, 1), date(2022, 3, 31))
    # The century of the second part is fixed.
    assert rows[1] == ("1999-00", date(1999, 4, 1), date(2000, 3, 31))


def test_serial_dates(spark):
    rows = column(spark, ["44000", "2020-02-30", "x", None], "string", dates.serial_to_date(F.col("x")))
    assert [r[0] for r in rows] == ["2020-06-18", None, None, None]


def test_lenient_casts(spark):
    rows = column(
        spark, ["3.7", "-3.7", "abc", "", "9e99", "12"], "string",
        casts.to_int(F.col("x")), casts.to_double(F.col("x")),
    )
    assert [r[0] for r in rows] == [3, -3, None, None, None, 12]
    assert rows[4][1] == 9e99


def test_combination_is_null_with_a_missing_code(spark):
    df = spark.createDataFrame(
        [(1, 1), (1, 999), (999, 1), (999, 999), (None, 999), (999, None)], "i int, e int"
    )
    found = [r[0] for r in df.select(codes.combination_id(F.col("i"), F.col("e"))).collect()]
    assert found == [1, 2, 3, 4, None, None]


def test_age_bands(spark):
    rows = column(spark, [0, 4, 5, 84, 85, 129, 130, None], "int", codes.age_band(F.col("x")))
    assert [r[0] for r in rows] == ["0-4", "0-4", "5-9", "80-84", "85+", "85+", "130", "Unknown"]


def test_clean_ethnicity(spark):
    rows = column(spark, ["9", "A*", "ZZ", None, "B"], "string", codes.clean_ethnicity(F.col("x")))
    assert [r[0] for r in rows] == ["99", "A", "Z", "99", "B"]


@pytest.mark.parametrize(
    "given, wanted",
    [
        (None, None), ("All", None), ("*", None), ([], None), ("", None),
        ("10, 11,12", [10, 11, 12]), ([1, "2", None, "", 1.0], [1, 2]), (108, [108]),
        (["x", 3], ["x", 3]), ([float("nan"), 4], [4]),
    ],
)
def test_requested_ids(given, wanted):
    assert normalise_ids(given) == wanted


def test_snake_names():
    assert names.snake(["Area Code", "In Table (internal)", "LSOA21CD", "Area code", "2020"]) == [
        "area_code", "in_table_internal", "lsoa21_cd", "area_code_2", "x2020",
    ]


def test_matching_name():
    assert names.matching(["x", "Area  CODE"], "Area Code") == "Area  CODE"
    assert names.matching(["x"], "Area Code") is None
