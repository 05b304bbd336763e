import datetime as dt

from pyspark.sql import functions as F

from reelstar.functions.aggregates import exact_avg_rounded
from reelstar.operators.features import mode_per_group, rolling_sum


def test_mode_tie_break_largest_value_null_lowest(spark):
    rows = [("u", "a"), ("u", "b"), ("v", None), ("v", None), ("v", "z"), ("w", None), ("w", "c")]
    df = spark.createDataFrame(rows, "k string, x string").withColumn("s", F.lit("s"))
    out = {r["k"]: r["m"] for r in mode_per_group(df, ["k"], "x", "m", weight_of="s").collect()}
    assert out == {"u": "b", "v": None, "w": "c"}


def test_exact_avg_half_up(spark):
    # 12.34 and 12.35 average exactly 12.345 -> 12.35 (a double sum could give 12.344999...)
    df = spark.createDataFrame([(12.34,), (12.35,), (None,)], "c double")
    assert df.agg(exact_avg_rounded("c", 2, 2)).first()[0] == 12.35
    assert spark.createDataFrame([(None,)], "c double").agg(exact_avg_rounded("c", 2, 2)).first()[0] is None


def test_rolling_frames_are_inclusive_calendar_days(spark):
    d0 = dt.date(2024, 1, 1)
    days = [0, 1, 7, 8, 30, 31]
    df = spark.createDataFrame([("u", d0 + dt.timedelta(days=k), 1) for k in days], "u string, d date, n long")
    out = df.select("d", rolling_sum("u", "d", "n", 7).alias("s7"), rolling_sum("u", "d", "n", 30).alias("s30"))
    got = {(r["d"] - d0).days: (r["s7"], r["s30"]) for r in out.collect()}
    # day 8 sees days 1..8 (day 0 is 8 days back, outside [-7, 0]); day 31 sees days 1..31
    assert got == {0: (1, 1), 1: (2, 2), 7: (3, 3), 8: (3, 4), 30: (1, 5), 31: (2, 5)}
