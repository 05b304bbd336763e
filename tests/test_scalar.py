import datetime as dt

from pyspark.sql import functions as F

from reelstar.functions import scalar as S

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_age_band_boundaries(spark):
    ages = [(None,), (16,), (24,), (25,), (34,), (35,), (44,), (45,), (54,), (55,), (90,)]
    got = _one(spark, ages, "age int", S.age_band("age"))
    assert got == ["55+", "18-24", "18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55+", "55+"]


def test_device_category(spark):
    got = _one(spark, [("smart_tv",), ("desktop",), ("mobile",), ("tablet",), ("vr",), (None,)],
               "d string", S.device_category("d"))
    assert got == ["TV", "Computer", "Mobile", "Tablet", "Tablet", "Tablet"]


def _delay_rows(spark, deltas):
    rows = [(T0 + dt.timedelta(seconds=d), T0) for d in deltas]
    return spark.createDataFrame(rows, "ingestion_time timestamp_ntz, event_time timestamp_ntz")


def test_late_arrival_strict_bounds(spark):
    df = _delay_rows(spark, [-60, 0, 300, 301, 172799, 172800, 259200])
    got = [r[0] for r in df.select(S.is_late_arrival("ingestion_time", "event_time")).collect()]
    assert got == [False, False, False, True, True, False, False]


def test_within_48h_has_no_lower_bound(spark):
    df = _delay_rows(spark, [-3600, 0, 172799, 172800])
    got = [r[0] for r in df.select(S.is_within_48h("ingestion_time", "event_time")).collect()]
    assert got == [True, True, True, False]


def test_delay_is_difference_of_floored_seconds(spark):
    # event at .9 s, ingest 299.2 s later: floor(ingest) - floor(event) = 300
    ev = T0 + dt.timedelta(microseconds=900_000)
    ing = ev + dt.timedelta(seconds=299, microseconds=200_000)
    df = spark.createDataFrame([(ing, ev)], "ingestion_time timestamp_ntz, event_time timestamp_ntz")
    assert df.select(S.delay_seconds("ingestion_time", "event_time")).first()[0] == 300


def test_epoch_seconds_floor_before_1970(spark):
    df = spark.createDataFrame([(dt.datetime(1969, 12, 31, 23, 59, 59, 500000),), (dt.datetime(1970, 1, 1, 0, 0, 1),)],
                               "t timestamp_ntz")
    assert [r[0] for r in df.select(S.epoch_seconds("t")).collect()] == [-1, 1]


def test_completion_percent(spark):
    rows = [(1800, 60), (7200, 60), (900, None), (100, 0), (None, 30), (1, 3)]
    got = _one(spark, rows, "s int, m int", S.completion_percent("s", "m"))
    assert got == [50.0, 200.0, 25.0, None, None, 0.56]


def test_churn_label(spark):
    rows = [(9.99, 5, 0), (10.0, 5, 100), (10.0, 1, 31), (10.0, 1, 30), (None, 1, 31), (None, 2, 31),
            (50.0, 0, 40), (50.0, 1, None)]
    got = _one(spark, rows, "f double, s long, d int", S.churn_label("f", "s", "d"))
    assert got == [1, 0, 1, 0, 1, 0, 1, 0]


def test_parse_event_time_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10T06:30:00.123456+00:00",), ("2024-01-01T02:00:00+02:00",),
                                ("garbage",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        out = {}
        for tz in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            out[tz] = [r[0] for r in df.select(S.parse_event_time("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    expected = [dt.datetime(2024, 3, 10, 6, 30, 0, 123456), dt.datetime(2024, 1, 1, 0, 0), None]
    assert all(v == expected for v in out.values()), out


def test_date_attributes_sunday_is_one_and_iso_week(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 29),), (dt.date(2024, 12, 30),)], "d date")
    attrs = S.date_attributes("d")
    rows = df.select(attrs["day_of_week"], attrs["week_of_year"], attrs["quarter"]).collect()
    assert [tuple(r) for r in rows] == [(1, 52, 4), (2, 1, 4)]


def test_days_since_bad_text_is_null(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1), "2024-01-01"), (dt.date(2024, 2, 1), "n/a")],
                               "d date, s string")
    assert [r[0] for r in df.select(S.days_since("d", "s")).collect()] == [31, None]


def test_marks_and_stamps_ignore_process_and_session_zones(spark):
    import datetime as dt
    import os
    import time

    from reelstar.functions.scalar import as_of_ts, ntz_lit
    from reelstar.operators import incremental

    key = "spark.sql.session.timeZone"
    before_session, before_tz = spark.conf.get(key), os.environ.get("TZ")
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0),), (dt.datetime(2024, 1, 1, 3, 0),)],
                               "ts timestamp_ntz")
    try:
        os.environ["TZ"] = "America/New_York"
        time.tzset()
        spark.conf.set(key, "Asia/Tokyo")
        r = spark.range(1).select(as_of_ts(dt.datetime(2024, 2, 5)).alias("a"),
                                  ntz_lit("2024-01-01T01:30:00").alias("b")).first()
        assert (r.a, r.b) == (dt.datetime(2024, 2, 5), dt.datetime(2024, 1, 1, 1, 30))
        got = incremental.incremental(df, dt.datetime(2024, 1, 1, 1, 0), "ts").collect()
        assert [x.ts for x in got] == [dt.datetime(2024, 1, 1, 3, 0)]
    finally:
        spark.conf.set(key, before_session)
        if before_tz is None:
            os.environ.pop("TZ", None)
        else:
            os.environ["TZ"] = before_tz
        time.tzset()
