"""Indicator inputs derived from the star-schema tables, as DataFrames and as SQL.

Column expressions written as text are valid in Spark and in DuckDB and serve both.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.operators.joins import bounded, local_table, spread_join
from ratewell.operators.sets import union_by_name
from ratewell.schema import FACT_COLS, FACT_SCHEMA, GEOGRAPHY
from ratewell.sources.reference import age_groups
from ratewell.staging import stage

# The day the calculation runs, and the last day of data: the periods then open are incomplete.
AS_OF = date(2001, 6, 30)
DATA_END = date(2001, 8, 1)
LOADED = datetime(2024, 1, 1)
SYSTEM = "Home"
OUTSIDE = "Outside"

AGE_RANGES = {20: (65, 120, "65+ yrs"), 21: (0, 74, "<75 yrs"), 22: (15, 24, "15-24 yrs")}

STANDARDISED = "Directly age standardised rate"
VALUE_TYPES = [
    (2, "Percentage"), (3, "Crude rate"), (4, STANDARDISED),
    (5, "Count"), (7, "Ratio"),
]
METADATA_SCHEMA = (
    "indicator_id int, age string, year_type string, multiplier double, status_code int, "
    "population_type string, denominator_source string, precalculated string, value_type string"
)
METADATA = [
    (1, "All ages", "Calendar", 100.0, 1, "Census", "Census 2021", "No", "Percentage"),
    (2, "All ages", "Calendar", 1000.0, 2, "Census", "mid-year CENSUS", "No", "Crude rate"),
    (3, "All ages", "Financial", 100000.0, 1, "Census", "Census 2021", "No", STANDARDISED),
    (4, "All ages", "Calendar", 1.0, 1, "GP registered", "Practice list", "No", "Ratio"),
    (5, "All ages", "Calendar", 100.0, 3, "GP registered", "Practice list", "No", "Percentage"),
    (6, "65+ yrs", "Financial", None, 1, "Defined cohort", "Audit", "Yes", "Crude rate"),
    (7, "<75 yrs", "Calendar", 100.0, 1, "GP registered", "Practice list", "No", "Count"),
]
ETHNICITIES = [
    ("A", 1), ("B", 2), ("C", 3), ("D", 4), ("E", 5), ("F", 6), ("Z", 17), ("99", -99),
]
GENDERS = [("0", "Unknown"), ("1", "Male"), ("2", "Female")]
LOCALITIES = [*GEOGRAPHY.localities, GEOGRAPHY.not_a_locality]


def literal(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def values(rows: list[tuple], columns: str) -> str:
    """SQL for a small constant table."""
    lines = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {lines}) AS t({columns})"


def case(column: str, options: dict[object, str], other: str) -> str:
    arms = " ".join(f"WHEN {literal(k)} THEN {literal(v)}" for k, v in options.items())
    return f"CASE {column} {arms} ELSE {other} END"


def fy_year(day: str) -> str:
    """First calendar year of the financial year of ``day``."""
    return f"(year({day}) - CASE WHEN month({day}) < 4 THEN 1 ELSE 0 END)"


def fy_name(day: str, mark: str) -> str:
    first = fy_year(day)
    return (
        f"CAST({first} AS STRING) || '{mark}' || substring(CAST({first} + 1 AS STRING), 3, 2)"
    )


INDICATOR = (
    "CASE WHEN l_linenumber = 7 THEN 5 WHEN l_linenumber = 6 THEN 6 "
    "WHEN l_linenumber = 5 AND l_returnflag = 'R' THEN 7 "
    "WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 ELSE 3 END"
)
ORDER_DAY = "CAST(o_orderdate AS DATE)"
SEGMENTS = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4, "MACHINERY": 5}
SEGMENT = "CASE c_mktsegment " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in SEGMENTS.items()
) + " ELSE -99 END"
PERIOD_YEAR = f"CASE WHEN indicator_id IN (3, 6) THEN {fy_year('order_day')} ELSE year(order_day) END"

FACT_EXPRS = {
    "indicator_id": "indicator_id",
    "start_date": "make_date(first_year, CASE WHEN indicator_id IN (3, 6) THEN 4 ELSE 1 END, 1)",
    "end_date": (
        "least(CASE WHEN indicator_id IN (3, 6) THEN make_date(first_year + 1, 3, 31) "
        f"ELSE make_date(first_year, 12, 31) END, DATE '{DATA_END}')"
    ),
    "imd_code": "CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE CAST(c_custkey % 5 + 1 AS INT) END",
    "aggregation_id": "c_nationkey + 1",
    "age_group_code": (
        "CASE WHEN indicator_id <> 3 OR c_custkey % 97 = 5 THEN 999 "
        "ELSE CAST(c_custkey % 18 + 1 AS INT) END"
    ),
    "sex_code": "999",
    "ethnicity_code": f"CASE WHEN c_custkey % 31 = 0 THEN -99 ELSE {SEGMENT} END",
    "value_type_code": case("indicator_id", {1: 2, 2: 3, 3: 4, 5: 2, 6: 3, 7: 5}, "2"),
    "source_code": "1",
}
FACT_KEYS = list(FACT_EXPRS)
FACT_MEASURES = {
    "numerator": "CASE WHEN indicator_id = 2 AND numerator = 0 THEN NULL ELSE numerator END",
    "denominator": (
        "CASE WHEN indicator_id = 1 AND aggregation_id = 25 THEN NULL "
        "WHEN indicator_id = 2 AND aggregation_id = 24 THEN 0 ELSE denominator END"
    ),
}
RATIO_EXPRS = {
    "indicator_id": "4",
    "start_date": "DATE '2000-01-01'",
    "end_date": "DATE '2000-12-31'",
    "numerator": "CAST(round(c_acctbal / 100) AS DOUBLE)",
    "denominator": "CAST(1 + orders AS DOUBLE)",
    "imd_code": "CAST(c_custkey % 5 + 1 AS INT)",
    "aggregation_id": "c_nationkey + 1",
    "age_group_code": "999",
    "sex_code": "999",
    "ethnicity_code": SEGMENT,
    "value_type_code": "7",
    "source_code": "1",
}
BLANK = {c: "CAST(NULL AS DOUBLE)" for c in ("indicator_value", "lower_ci95", "upper_ci95")}
CREATED = {"creation_date": f"TIMESTAMP '{LOADED}'"}

PART_EXPRS = {
    "indicator_id": "CAST(p_partkey AS INT)",
    "age": case(
        "p_size % 6", {0: "All ages", 1: "65+ yrs", 2: "<75 yrs", 3: "15-24 yrs", 4: "20-24 yrs"},
        "'no such label'",
    ),
    "year_type": "CASE WHEN p_size % 2 = 0 THEN 'Calendar' ELSE 'Financial' END",
    "multiplier": "CASE WHEN p_size % 7 = 0 THEN NULL ELSE 100.0 END",
    "status_code": "p_size % 3 + 1",
    "population_type": "CASE WHEN p_size % 2 = 0 THEN 'Census' ELSE 'GP registered' END",
    "denominator_source": (
        "CASE WHEN p_type = 'ECONOMY' THEN 'Census 2021' WHEN p_type = 'SMALL' THEN 'mid-year CENSUS' "
        "WHEN p_type = 'PROMO' THEN NULL ELSE 'Practice list' END"
    ),
    "precalculated": "CASE WHEN p_size % 5 = 0 THEN 'Yes' ELSE 'No' END",
    "value_type": case("p_size % 4", {0: STANDARDISED, 1: "Percentage", 2: "Ratio"}, "NULL"),
}

PRACTICE_EXPRS = {
    "practice_code": "CASE WHEN s_suppkey = 7 THEN 'M88006' ELSE 'P' || CAST(s_suppkey AS STRING) END",
    "pcn_code": (
        "CASE WHEN s_suppkey % 20 = 19 THEN 'closed Practice' "
        "ELSE 'U' || CAST(s_suppkey % 20 AS STRING) END"
    ),
    "locality": case("s_nationkey % 7", dict(enumerate(LOCALITIES)), "NULL"),
    "system": "CASE WHEN s_suppkey % 11 = 10 THEN 'Away' ELSE 'HOME' END",
}
REGISTER_EXPRS = {
    "practice_code": "CASE WHEN l_suppkey = 7 THEN 'M88006' ELSE 'P' || CAST(l_suppkey AS STRING) END",
    "financial_year": fy_name("CAST(l_shipdate AS DATE)", "/"),
    "indicator_code": "l_returnflag",
}
DATE_EXPRS = {
    "day": ORDER_DAY,
    "financial_year_name": fy_name(ORDER_DAY, "/"),
    "start_date": f"make_date({fy_year(ORDER_DAY)}, 4, 1)",
    "end_date": f"make_date({fy_year(ORDER_DAY)} + 1, 3, 31)",
    "reconciliation_month": f"year({ORDER_DAY}) * 100 + month({ORDER_DAY})",
}
EPISODE_EXPRS = {
    "episode_id": "o_orderkey",
    "person_id": "o_custkey",
    "admission_method": "o_orderpriority",
    "order_in_spell": "CAST(o_orderkey % 2 + 1 AS INT)",
    "reconciliation_month": f"year({ORDER_DAY}) * 100 + month({ORDER_DAY})",
    "age": "CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE CAST(o_custkey % 100 AS INT) END",
    "gender_code": "CAST(o_custkey % 3 AS STRING)",
    "ethnic_category": case(
        "o_orderkey % 7", {0: "9", 1: "A*", 2: "ZZ", 3: "B", 4: "C", 5: "X"}, "NULL"
    ),
    "historic": f"CASE WHEN {ORDER_DAY} < DATE '1998-01-01' THEN 1 ELSE 0 END",
}
PLACE_EXPRS = {
    "episode_id": "o_orderkey",
    "area_code": case(
        "c_nationkey % 4", {0: "E08000025", 1: "E08000029", 2: "E08000025"}, "'E08000031'"
    ),
    # Only the current extract's 2021 area counts, so those of historic episodes must be ignored.
    "lsoa_2021": (
        f"CASE WHEN {ORDER_DAY} < DATE '1998-01-01' THEN CASE WHEN o_orderkey % 5 = 0 THEN 'L0' END "
        "WHEN o_orderkey % 11 = 0 THEN NULL ELSE 'L' || CAST(c_nationkey AS STRING) END"
    ),
    "lsoa_2011": "'K' || CAST(c_nationkey AS STRING)",
}
DIAGNOSIS_EXPRS = {
    "episode_id": "l_orderkey",
    "diagnosis_code": (
        "'X' || CAST(60 + l_partkey % 30 AS STRING) || CAST(l_linenumber AS STRING)"
    ),
}
AUDIT_EXPRS = {
    "financial_year": fy_name(ORDER_DAY, "") + " || CASE WHEN year(o_orderdate) > 1999 THEN 'E3' ELSE '' END",
    "imd_quintile": (
        "CASE WHEN o_custkey % 6 = 0 THEN '' WHEN o_custkey % 41 = 0 THEN NULL "
        "ELSE CAST(o_custkey % 5 + 1 AS STRING) END"
    ),
    "age": "CAST(o_custkey % 90 AS INT)",
    "sex": "CAST(o_custkey % 2 + 1 AS INT)",
    "ethnicity": case("o_custkey % 8", {0: "A", 1: "B", 2: "C", 3: "D", 4: "E", 5: ""}, "NULL"),
    "practice_code": "'P' || CAST(o_custkey % 60 AS STRING)",
    "person_id": "o_custkey",
    "condition": "o_orderpriority",
    "complete": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END",
}
DEMOGRAPHIC_EXPRS = {
    # Two thirds are persons that no episode has.
    "person_id": "CASE WHEN c_custkey % 3 = 0 THEN c_custkey ELSE -c_custkey END",
    "ethnic_code": case("c_custkey % 7", {0: "A", 1: "B", 2: "C", 3: "F"}, "NULL"),
}
POPULATION_KEY_EXPRS = {
    "aggregation_id": "c_nationkey + 1",
    "aggregation_type": "'Ward'",
    "imd": "CASE WHEN c_custkey % 53 = 0 THEN 'ALL' ELSE CAST(c_custkey % 5 + 1 AS STRING) || ' most' END",
    "age_group": "CASE WHEN c_custkey % 19 = 0 THEN 'ALL' ELSE 'band' END",
    "start_age": "CAST(CASE WHEN c_custkey % 19 = 0 THEN 0 ELSE 5 * (c_custkey % 17) END AS INT)",
    "end_age": "CAST(CASE WHEN c_custkey % 19 = 0 THEN 120 ELSE 5 * (c_custkey % 17) + 4 END AS INT)",
    "nhs_code": case("c_custkey % 9", {0: "A", 1: "B", 2: "C", 3: "D", 4: "ALL", 5: "Z"}, "'W'"),
    "sex_code": "CAST(c_custkey % 3 + 1 AS INT)",
    "sex": case("c_custkey % 3", {0: "Male", 1: "Female"}, "'Persons'"),
}
SEXES = [(1, "Male"), (2, "Female"), (999, "All (Persons)")]
LSOA_EXPRS = {
    "lsoa_2011": "'K' || CAST(n_nationkey AS STRING)",
    "lsoa_2021": "'L' || CAST(n_nationkey AS STRING)",
}
WARD_EXPRS = {
    "lsoa_2021": "'L' || CAST(n_nationkey AS STRING)",
    "ward_code": "'W' || CAST(n_nationkey AS STRING)",
    "lad_code": case("n_nationkey % 4", {0: "E08000025", 1: "E08000029", 2: "E08000025"}, "'E08000031'"),
}
LOCALITY_EXPRS = {
    "lsoa_2021": "'L' || CAST(n_nationkey AS STRING)",
    "locality": case("n_nationkey % 7", dict(enumerate([*GEOGRAPHY.localities, OUTSIDE])), "NULL"),
}
WARD_IMD_EXPRS = {
    "ward_code": "'W' || CAST(n_nationkey AS STRING)",
    "quintile": "CAST(n_nationkey % 5 + 1 AS INT)",
}
GEOGRAPHY_COLUMNS = "aggregation_id, aggregation_type, aggregation_code, aggregation_label"
FIXED_AREAS = [
    (GEOGRAPHY.icb_aggregation_id, "ICB", GEOGRAPHY.icb_code, "Integrated care board"),
    (201, "Local Authority (registered)", "E08000025", "First authority"),
    (202, "Local Authority (registered)", "E08000029", "Second authority"),
    (211, "Local Authority (resident)", "E08000025", "First authority"),
    (212, "Local Authority (resident)", "E08000029", "Second authority"),
    *[(221 + i, "Locality (registered)", f"LR{i}", n) for i, n in enumerate(GEOGRAPHY.localities)],
    *[(231 + i, "Locality (resident)", f"LS{i}", n) for i, n in enumerate(GEOGRAPHY.localities)],
]
WARD_AREA_EXPRS = {
    "aggregation_id": "300 + n_nationkey",
    "aggregation_type": "'Ward'",
    "aggregation_code": "'W' || CAST(n_nationkey AS STRING)",
    "aggregation_label": "n_name",
}


def projection(exprs: dict[str, str]) -> str:
    return ", ".join(f"{expr} AS {name}" for name, expr in exprs.items())


def pick(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in exprs.items()])


class Tables:
    """The star-schema tables of one folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A table of the folder; its footer is read once."""
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def local(self, rows: list[tuple], schema: str) -> DataFrame:
        return local_table(self.spark, rows, schema)

    # dimensions ---------------------------------------------------------------------------
    def metadata(self) -> DataFrame:
        return self.local(METADATA, METADATA_SCHEMA)

    def part_metadata(self) -> DataFrame:
        return pick(self.raw("part"), PART_EXPRS)

    def ages(self) -> DataFrame:
        return age_groups(self.spark, AGE_RANGES)

    def value_types(self) -> DataFrame:
        return self.local(VALUE_TYPES, "value_type_code int, value_type string")

    def ethnicities(self) -> DataFrame:
        return self.local(ETHNICITIES, "nhs_code string, ethnicity_code int")

    def genders(self) -> DataFrame:
        return self.local(GENDERS, "gender_code string, sex string")

    def sexes(self) -> DataFrame:
        return self.local(SEXES, "sex_code int, sex string")

    def imd(self) -> DataFrame:
        return self.local([(str(i), i) for i in range(1, 6)], "imd_quintile string, imd_code int")

    def practices(self) -> DataFrame:
        return pick(self.raw("supplier"), PRACTICE_EXPRS)

    def dates(self) -> DataFrame:
        """A date dimension: one row per day that has orders."""
        return pick(self.raw("orders").select("o_orderdate").distinct(), DATE_EXPRS)

    def geography(self) -> DataFrame:
        networks = (
            self.practices().filter("pcn_code <> 'closed Practice'").select("pcn_code").distinct()
        )
        return bounded(
            union_by_name(
                self.local(
                    FIXED_AREAS,
                    "aggregation_id int, aggregation_type string, aggregation_code string, aggregation_label string",
                ),
                pick(self.raw("nation"), WARD_AREA_EXPRS),
                networks.selectExpr(
                    "1000 + CAST(substring(pcn_code, 2, 9) AS INT) AS aggregation_id",
                    "'PCN' AS aggregation_type",
                    "pcn_code AS aggregation_code",
                    "'Network ' || pcn_code AS aggregation_label",
                ),
            )
        )

    def small_areas(self) -> dict[str, DataFrame]:
        """Lookups in which every key has a second, larger row that must not count."""
        nation = self.raw("nation")

        def repeated(exprs: dict[str, str], column: str, larger: str) -> DataFrame:
            first = pick(nation, exprs)
            return first.union(first.withColumn(column, F.expr(larger)))

        return {
            "lsoa_2011_to_2021": repeated(LSOA_EXPRS, "lsoa_2021", "'~' || lsoa_2021"),
            "wards": repeated(WARD_EXPRS, "ward_code", "'~' || ward_code"),
            "localities": repeated(LOCALITY_EXPRS, "locality", "'~' || locality"),
            "ward_imd": repeated(WARD_IMD_EXPRS, "quintile", "quintile + 100"),
        }

    def footprint(self) -> DataFrame:
        return pick(self.raw("nation").filter("n_nationkey % 6 <> 5"), LSOA_EXPRS).select("lsoa_2021")

    # facts --------------------------------------------------------------------------------
    def customer_years(self) -> DataFrame:
        """Line counts per customer, indicator and period year.

        Lines are counted per order before they meet the orders, and orders per customer before
        they meet the customers, so no crowded key is joined row by row.
        """
        lines = (
            self.raw("lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"), F.expr(INDICATOR).alias("indicator_id"))
            .agg(
                F.count_if(F.col("l_linestatus") == "F").alias("numerator"),
                F.count(F.lit(1)).alias("denominator"),
            )
        )
        orders = self.raw("orders").select(
            "o_orderkey", "o_custkey", F.expr(ORDER_DAY).alias("order_day")
        )
        return (
            lines.join(orders, "o_orderkey")
            .groupBy(
                F.col("o_custkey").alias("c_custkey"), "indicator_id",
                F.expr(PERIOD_YEAR).alias("first_year"),
            )
            .agg(
                F.sum("numerator").cast("double").alias("numerator"),
                F.sum("denominator").cast("double").alias("denominator"),
            )
        )

    def line_facts(self) -> DataFrame:
        customers = self.raw("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        rows = self.customer_years().join(customers, "c_custkey")
        placed = rows.selectExpr(
            *[f"{e} AS {n}" for n, e in FACT_EXPRS.items()], "numerator", "denominator"
        )
        sums = placed.groupBy(*FACT_KEYS).agg(
            F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator")
        )
        return sums.withColumns({n: F.expr(e) for n, e in {**FACT_MEASURES, **BLANK, **CREATED}.items()})

    def ratio_facts(self) -> DataFrame:
        counts = self.raw("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
            F.count(F.lit(1)).alias("orders")
        )
        rows = self.raw("customer").join(counts, "c_custkey", "left").fillna(0, ["orders"])
        return pick(rows, {**RATIO_EXPRS, **BLANK, **CREATED})

    def facts(self) -> DataFrame:
        both = union_by_name(self.line_facts(), self.ratio_facts())
        return both.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in FACT_SCHEMA])

    def landing(self) -> DataFrame:
        """The facts as a staging table, for calculations that read them several times."""
        return stage(self.facts(), FACT_SCHEMA)

    # sources of the indicator builds ------------------------------------------------------
    def register(self) -> DataFrame:
        counts = pick(self.raw("lineitem"), {**REGISTER_EXPRS, "l_linestatus": "l_linestatus"})
        return (
            counts.groupBy(*REGISTER_EXPRS)
            .agg(
                F.count_if(F.col("l_linestatus") == "F").cast("double").alias("numerator"),
                F.count(F.lit(1)).cast("double").alias("denominator"),
            )
            .withColumn("numerator", F.nullif("numerator", F.lit(0.0)))
        )

    def episodes(self, historic: int | None = None) -> DataFrame:
        rows = pick(self.raw("orders"), EPISODE_EXPRS)
        return rows if historic is None else rows.filter(F.col("historic") == historic)

    def places(self) -> DataFrame:
        customers = self.raw("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        # One customer may hold much of the orders.
        placed = spread_join(orders, customers, ["o_custkey"], "inner")
        return pick(placed, PLACE_EXPRS)

    def diagnoses(self) -> DataFrame:
        return pick(self.raw("lineitem"), DIAGNOSIS_EXPRS)

    def audit(self) -> DataFrame:
        return pick(self.raw("orders"), AUDIT_EXPRS)

    def demographic(self) -> DataFrame:
        return pick(self.raw("customer"), DEMOGRAPHIC_EXPRS)

    def population(self) -> DataFrame:
        rows = pick(self.raw("customer"), POPULATION_KEY_EXPRS)
        return rows.groupBy(*POPULATION_KEY_EXPRS).agg(
            F.count(F.lit(1)).cast("int").alias("observation")
        )


# The same inputs as SQL: name -> (inputs, body).
LINE_COUNTS = "SUM(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS numerator, COUNT(*) AS denominator"
CTES: dict[str, tuple[str, str]] = {
    "metadata": ("", values(METADATA, METADATA_SCHEMA.replace(" int", "").replace(" string", "").replace(" double", ""))),
    "part_metadata": ("", f"SELECT {projection(PART_EXPRS)} FROM part"),
    "value_types": ("", values(VALUE_TYPES, "value_type_code, value_type")),
    "ethnicities": ("", values(ETHNICITIES, "nhs_code, ethnicity_code")),
    "genders": ("", values(GENDERS, "gender_code, sex")),
    "sexes": ("", values(SEXES, "sex_code, sex")),
    "imd": ("", values([(str(i), i) for i in range(1, 6)], "imd_quintile, imd_code")),
    "ages": (
        "",
        "SELECT CAST(i AS INT) AS age_code, '5-year age group' AS age_type, CAST(5 * i - 5 AS INT) AS min_age, "
        "CAST(CASE WHEN i = 18 THEN 120 ELSE 5 * i - 1 END AS INT) AS max_age, "
        "CASE WHEN i = 18 THEN '85+' ELSE (5 * i - 5) || '-' || (5 * i - 1) END AS age_group, "
        "CASE WHEN i = 18 THEN '85+ yrs' ELSE (5 * i - 5) || '-' || (5 * i - 1) || ' yrs' END AS age_group_label "
        "FROM range(1, 19) AS r(i) UNION ALL "
        + values(
            [(999, "All", 0, 120, "All ages", "All ages")]
            + [(c, "Other", lo, hi, t, t) for c, (lo, hi, t) in AGE_RANGES.items()],
            "age_code, age_type, min_age, max_age, age_group, age_group_label",
        ),
    ),
    "practices": ("", f"SELECT {projection(PRACTICE_EXPRS)} FROM supplier"),
    "dates": ("", f"SELECT DISTINCT {projection(DATE_EXPRS)} FROM orders"),
    "geography": (
        "practices",
        values(FIXED_AREAS, GEOGRAPHY_COLUMNS)
        + f" UNION ALL SELECT {projection(WARD_AREA_EXPRS)} FROM nation"
        + " UNION ALL SELECT DISTINCT 1000 + CAST(substring(pcn_code, 2, 9) AS INT), 'PCN', pcn_code, "
        "'Network ' || pcn_code FROM practices WHERE pcn_code <> 'closed Practice'",
    ),
    "lsoa_map": ("", f"SELECT {projection(LSOA_EXPRS)} FROM nation"),
    "wards": ("", f"SELECT {projection(WARD_EXPRS)} FROM nation"),
    "localities": ("", f"SELECT {projection(LOCALITY_EXPRS)} FROM nation"),
    "ward_imd": ("", f"SELECT {projection(WARD_IMD_EXPRS)} FROM nation"),
    "footprint": ("", f"SELECT {projection(LSOA_EXPRS)} FROM nation WHERE n_nationkey % 6 <> 5"),
    "line_rows": (
        "",
        f"SELECT *, {PERIOD_YEAR} AS first_year FROM (SELECT {INDICATOR} AS indicator_id, "
        f"{ORDER_DAY} AS order_day, l_linestatus, c_custkey, c_nationkey, c_mktsegment FROM lineitem "
        "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)",
    ),
    "line_sums": (
        "line_rows",
        f"SELECT {projection(FACT_EXPRS)}, {LINE_COUNTS} FROM line_rows GROUP BY ALL",
    ),
    "ratio_rows": (
        "",
        "SELECT customer.*, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS orders FROM customer",
    ),
    "facts": (
        "line_sums ratio_rows",
        "SELECT indicator_id, start_date, end_date, "
        f"CAST({FACT_MEASURES['numerator']} AS DOUBLE) AS numerator, "
        f"CAST({FACT_MEASURES['denominator']} AS DOUBLE) AS denominator, "
        + projection(BLANK)
        + ", imd_code, aggregation_id, age_group_code, sex_code, ethnicity_code, "
        + projection(CREATED)
        + ", value_type_code, source_code FROM line_sums UNION ALL SELECT "
        + ", ".join(f"{ {**RATIO_EXPRS, **BLANK, **CREATED}[c] } AS {c}" for c in FACT_COLS)
        + " FROM ratio_rows",
    ),
    "register": (
        "",
        f"SELECT {', '.join(REGISTER_EXPRS)}, CAST(NULLIF(numerator, 0) AS DOUBLE) AS numerator, "
        "CAST(denominator AS DOUBLE) AS denominator FROM "
        f"(SELECT {projection(REGISTER_EXPRS)}, {LINE_COUNTS} FROM lineitem GROUP BY ALL)",
    ),
    "episodes": ("", f"SELECT {projection(EPISODE_EXPRS)} FROM orders"),
    "places": (
        "",
        f"SELECT {projection(PLACE_EXPRS)} FROM orders JOIN customer ON o_custkey = c_custkey",
    ),
    "diagnoses": ("", f"SELECT {projection(DIAGNOSIS_EXPRS)} FROM lineitem"),
    "audit": ("", f"SELECT {projection(AUDIT_EXPRS)} FROM orders"),
    "demographic": (
        "", f"SELECT {projection(DEMOGRAPHIC_EXPRS)} FROM customer"
    ),
    "population": (
        "",
        f"SELECT {projection(POPULATION_KEY_EXPRS)}, COUNT(*) AS observation FROM customer GROUP BY ALL",
    ),
}
