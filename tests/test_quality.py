import pytest
from pyspark.sql import functions as F

from reelstar.operators.quality import DataQualityError, assert_passed, run_checks
from reelstar.sources.fixtures import bind


def test_bindings_pass_the_gate(spark, sf_dir):
    b = bind(spark, sf_dir)
    rows = assert_passed(run_checks({"users": b.users, "content_catalog": b.content_catalog,
                                     "watch_events": b.watch_events, "ratings_late": b.ratings_late}))
    assert len(rows) == 10


def test_injected_faults_fail(spark, sf_dir):
    b = bind(spark, sf_dir)
    users = b.users.unionByName(b.users.limit(2))  # duplicates
    events = b.watch_events.withColumn("event_id", F.when(F.col("event_id") == "1", None)
                                       .otherwise(F.col("event_id")))
    content = b.content_catalog.withColumn("duration_minutes", F.col("duration_minutes").cast("string"))
    rep = run_checks({"users": users, "watch_events": events, "content_catalog": content})
    bad = {(r["table_name"], r["check_name"]): r["violations"] for r in rep.collect() if not r["passed"]}
    assert bad == {("users", "unique:user_id"): 2, ("watch_events", "not_null:event_id"): 1,
                   ("content_catalog", "schema"): 1}
    with pytest.raises(DataQualityError):
        assert_passed(rep)


def test_null_counts_as_one_distinct_value(spark):
    df = spark.createDataFrame([("a",), (None,), (None,)], "user_id string")
    rep = {r["check_name"]: r["violations"] for r in run_checks({"users": df}, expected={}).collect()}
    assert rep == {"not_null:user_id": 2, "unique:user_id": 1}


def test_incremental_gate_in_pipeline(spark, sf_dir):
    """The silver gate checks only the new increment of the event table, but a
    bad new row fails the run, moves no mark and keeps failing on retry."""
    import datetime as dt
    import uuid

    from reelstar.plans import layers as L
    from reelstar.session import work_dir

    b = bind(spark, sf_dir)
    layers = L.Layers.under(spark, work_dir(spark, "t-gate"), prefix=f"rsg{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": b.watch_events, "ratings_late": b.ratings_late})
    day1 = L.run_silver(layers, dt.datetime(2024, 2, 4))
    # day 1 checked the whole event table (no mark yet)
    assert {r["check_name"]: r["total_rows"] for r in day1["dq"]
            if r["table_name"] == "watch_events"}["not_null:event_id"] == b.watch_events.count()
    sessions_before = layers.silver.read("watch_sessions").count()

    late = b.watch_events.limit(1).select(
        F.lit(None).cast("string").alias("event_id"),
        *[c for c in b.watch_events.columns if c != "event_id"]
    ).withColumn("ingestion_time", F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"))
    layers.bronze.append("watch_events", late)
    n = b.watch_events.count() + 1
    by_time = L.Options(increments="time", gate="increment")  # begins with the newest row of day 1
    for opts, checked in ((L.Options(), 1), (L.Options(), 1), (L.Options(gate="whole"), n), (by_time, 2)):
        with pytest.raises(DataQualityError, match=f"watch_events.not_null:event_id: 1 of {checked}$"):
            L.run_silver(layers, dt.datetime(2024, 2, 5), opts)
    assert layers.silver.read("watch_sessions").count() == sessions_before
