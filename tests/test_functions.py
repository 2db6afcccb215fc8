from pyspark.sql import functions as F

from gridcast import schemas
from gridcast.functions import columns as C


def test_tolerant_casts(spark):
    df = spark.createDataFrame([("5.0",), ("NA",), ("NaN",), ("",), (None,), ("-3.7",), ("12",)], "x string")
    out = df.select(C.to_int("x").alias("i"), C.to_double("x").alias("d")).collect()
    assert [r.i for r in out] == [5, None, None, None, None, -3, 12]
    assert [r.d for r in out] == [5.0, None, None, None, None, -3.7, 12.0]


def test_dates_flags_weeks(spark):
    df = spark.createDataFrame([("2020-09-13", "REG", "Wildcard", "A", "A"),
                                ("bad", None, "7", None, "A"),
                                ("2021-01-02", "POST", "Superbowl", "B", "A")], "d string, st string, w string, fav string, home string")
    out = df.select(C.parse_date("d").cast("string").alias("d"), C.playoff_flag("st").alias("p"),
                    C.normalise_week("w", schemas.LITERAL_WEEK_NAMES).alias("w"),
                    C.favourite_is_home("fav", "home").alias("f")).collect()
    assert [r.d for r in out] == ["2020-09-13", None, "2021-01-02"]
    assert [r.p for r in out] == [0, 1, 1]          # null season type counts as playoffs (Q13)
    assert [r.w for r in out] == [18, 7, 21]
    assert [r.f for r in out] == [1, 0, 0]          # null favourite -> 0


def test_exact_avg_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 0.015, -0.045]
    a = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").coalesce(1)
    ea = a.agg(C.exact_avg("x").alias("m")).first().m
    eb = b.agg(C.exact_avg("x").alias("m")).first().m
    from decimal import Decimal
    assert ea == eb == float(sum(Decimal(str(v)) for v in vals)) / len(vals)
    assert spark.createDataFrame([(None,)], "x double").agg(C.exact_avg("x").alias("m")).first().m is None


def test_numbers_that_no_sum_can_hold_are_null(spark):
    """NaN, infinities and out-of-range text have no value, in sums and counts alike."""
    df = spark.createDataFrame([("NaN",), ("Infinity",), ("-Infinity",), ("1e30",), ("x",), ("",), ("1",), ("3",)], "t string")
    r = df.select(C.to_double("t").alias("d")).agg(F.count("d").alias("n"), C.exact_avg("d").alias("m"), C.exact_sum("d").alias("s")).first()
    assert (r.n, r.m, float(r.s)) == (2, 2.0, 4.0)
    raw = df.select(F.col("t").try_cast("double").alias("d")).agg(C.exact_avg("d").alias("m")).first()
    assert raw.m == 2.0


def test_dates_are_read_as_by_the_pattern(spark):
    """Text of four, two and two digits is cast, and all other text meets the pattern: what a
    cast takes beyond it stays null."""
    texts = ["2020-09-13", "2020-02-30", "2020-9-13", "2020-09-1 ", "2020-09-1T", " 2020-09-1", "+2020-09-1", "0000-01-01", "0001-01-01", "9999-12-31",
             "2020-09", "2020", "12020-09-13", "2020-09-13T00:00", "2020/09/13", "20200913", "202-001-01", "2020-1-101", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    rows = df.select("x", C.parse_date("x").cast("string").alias("a"), F.try_to_date("x", "yyyy-MM-dd").cast("string").alias("b")).collect()
    assert [(r.x, r.a) for r in rows] == [(r.x, r.b) for r in rows] and sum(r.a is not None for r in rows) >= 3
    assert "cast(x" in df.select(C.parse_date("x"))._jdf.queryExecution().optimizedPlan().toString()


def test_missing_numbers_are_not_cast(spark):
    """Numbers are cast once, missing ones not at all; the values are those of a plain cast."""
    texts = ["5.0", "NA", "", " ", "NaN", "inf", "-Infinity", "1e19", "1e30", "2147483647", "2147483648", "-2147483649", "0x1p3", " 7 ", "+5", "-0.9", "n/a", None]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    plain = F.when(F.abs(F.col("x").try_cast("double")) < C.EXACT_LIMIT, F.col("x").try_cast("double"))
    for r in df.select(C.to_int("x").alias("i"), plain.try_cast("int").alias("pi"), C.to_double("x").alias("d"), plain.alias("pd")).collect():
        assert (r.i, r.d) == (r.pi, r.pd)
    plan = df.select(C.to_int("x").alias("i"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as double") == 1 and "NA" in plan
    numbers = spark.createDataFrame([(5.7, 3), (float("nan"), 4)], "a double, b int")   # typed already
    assert [tuple(r) for r in numbers.select(C.to_int("a"), C.to_int("b")).collect()] == [(5, 3), (None, 4)]


def test_game_queries_leave_no_method_uncompiled(spark):
    import __spark_entry__ as entry
    from gridcast.session import DEFAULT_CONF
    assert DEFAULT_CONF["spark.sql.codegen.hugeMethodLimit"] == "8000"   # of sessions of jobs too
    for name, limit in (("plays_clean", "8000"), ("op6_mixing", "65535")):
        entry.queries()[name](spark, "/root/testdata/sf0.001")
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == limit
