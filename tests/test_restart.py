"""Refreshes that are repeated, cut off or run over a changed target."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from reelstar.functions.scalar import parse_event_time
from reelstar.operators import dims, engagement
from reelstar.plans import layers as L
from reelstar.schemas import WATCH_JSON
from reelstar.session import work_dir
from reelstar.sources.fixtures import bind
from reelstar.sources.tables import TableStore
from reelstar.streaming import ingest

DAY1, DAY2, CUT = dt.datetime(2024, 2, 4), dt.datetime(2024, 2, 5), dt.datetime(2024, 1, 15)


def seeded(spark, b, events):
    layers = L.Layers.under(spark, work_dir(spark, "t-restart"), prefix=f"rsr{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": events, "ratings_late": b.ratings_late.limit(0)})
    return layers


def kpis(df):
    cols = sorted(c for c in df.columns if c != "ingestion_time")
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_run_cut_off_after_the_fact_heals(spark, sf_dir, monkeypatch):
    b = bind(spark, sf_dir)
    early = F.col("ingestion_time") < F.lit(CUT)
    layers = seeded(spark, b, b.watch_events.filter(early))
    L.run_all(layers, DAY1)
    layers.bronze.append("watch_events", b.watch_events.filter(~early))
    with monkeypatch.context() as m:
        def lost(*_):
            raise RuntimeError("executor lost")
        m.setattr(engagement, "daily_engagement", lost)
        with pytest.raises(RuntimeError):
            L.run_all(layers, DAY2)
    g = layers.gold
    assert g.read("fact_watch_sessions").count() == b.watch_events.count()
    L.run_all(layers, DAY2)
    fact = g.read("fact_watch_sessions")
    assert fact.count() == b.watch_events.count()
    assert kpis(g.read("daily_engagement")) == kpis(engagement.daily_engagement(fact, DAY2))
    assert g.read("churn_features").agg(F.sum("sessions_count")).first()[0] == \
        g.read("daily_engagement").agg(F.sum("total_sessions")).first()[0]


def test_events_that_share_a_session_are_all_kept_on_rerun(spark, sf_dir):
    b = bind(spark, sf_dir)
    shared = b.watch_events.withColumn("session_id", F.when(F.col("event_id").cast("long") % 3 > 0, F.concat(
        F.lit("s"), (F.col("event_id").cast("long") % 50).cast("string"))))
    early = F.col("ingestion_time") < F.lit(CUT)
    layers = seeded(spark, b, shared.filter(early))
    opts = L.Options(hwm_overlap=dt.timedelta(days=2))
    for _ in range(2):  # the second of each pair adds nothing
        L.run_all(layers, DAY1, opts)
    layers.bronze.append("watch_events", shared.filter(~early))
    for _ in range(2):
        L.run_all(layers, DAY2, opts)
    fact = layers.gold.read("fact_watch_sessions")
    assert fact.count() == b.watch_events.count() == fact.select("event_id").distinct().count()


def test_a_run_with_an_earlier_clock_loads_what_is_new(spark, sf_dir):
    b = bind(spark, sf_dir)
    early = F.col("ingestion_time") < F.lit(CUT)
    layers = seeded(spark, b, b.watch_events.filter(~early))
    L.run_all(layers, DAY2)
    layers.bronze.append("watch_events", b.watch_events.filter(early))  # a backfill
    L.run_all(layers, DAY1)
    g = layers.gold
    fact = g.read("fact_watch_sessions")
    assert fact.count() == b.watch_events.count() == layers.silver.read("watch_sessions").count()
    assert kpis(g.read("daily_engagement")) == kpis(engagement.daily_engagement(fact, DAY2))


def test_failed_replace_keeps_the_rows(spark):
    store = TableStore(spark, f"rs_r{uuid.uuid4().hex[:8]}", work_dir(spark, "t-replace"))
    store.create_namespace()
    store.create("t", spark.range(1).withColumnRenamed("id", "n").schema)
    store.replace_all("t", spark.range(5).withColumnRenamed("id", "n"))
    with pytest.raises(Exception, match="wrong"):
        store.replace_all("t", spark.range(5).select(F.raise_error(F.lit("wrong")).cast("long").alias("n")))
    assert store.read("t").count() == 5


def test_partitioned_append_writes_few_files(spark, sf_dir):
    b = bind(spark, sf_dir)
    layers = seeded(spark, b, b.watch_events.repartition(8))
    L.run_all(layers, DAY2)
    fact = layers.gold.read("fact_watch_sessions")
    assert len(fact.inputFiles()) <= fact.select("event_date").distinct().count() + 8


def test_null_keys_make_no_dimension_rows(spark, sf_dir):
    ev = bind(spark, sf_dir).watch_events
    gaps = ev.withColumn("event_time", F.when(F.col("event_id") % 2 == 0, F.col("event_time"))) \
        .withColumn("device_type", F.when(F.col("event_id") % 3 == 0, F.col("device_type")))
    time = dims.dim_time_increment(gaps, None, DAY1)
    assert time.filter("date_key IS NULL").count() == 0 < time.count()
    assert dims.dim_time_increment(gaps, time, DAY2).count() == 0
    devices = dims.dim_device(gaps, DAY1)
    assert dims.dim_device(gaps, DAY2, existing=devices).count() == 0 < devices.count()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_event_time_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = spark.createDataFrame([("2024-11-03T06:30:00+00:00",), ("2024-11-03T05:30:00.123456Z",), ("x",), (None,)],
                                     "t string").select(parse_event_time("t").cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r[0] for r in rows] == ["2024-11-03 06:30:00", "2024-11-03 05:30:00.123456", None, None]


def test_only_committed_batches_are_read(spark, sf_dir):
    b = bind(spark, sf_dir)
    root = work_dir(spark, "t-commit")
    empty = ingest.read_bronze(spark, f"{root}/watch_events")
    assert empty.count() == 0 and empty.columns[0] == "event_id"
    cols = [f.name for f in WATCH_JSON.fields]
    ingest.to_json_lines(b.watch_events, cols).write.text(f"{root}/in")
    q = ingest.start_ingest(ingest.text_source(spark, f"{root}/in"), WATCH_JSON, "event_id",
                            f"{root}/watch_events", f"{root}/ckpt", trigger={"availableNow": True}, clock=lambda: DAY1)
    ingest.run_until_any_ends([q])
    # a batch that is being written: files, no marker
    done = ingest.read_bronze(spark, f"{root}/watch_events")
    done.limit(10).withColumn("accepted", F.lit(True)).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("accepted").parquet(
        f"{root}/watch_events/batch_id=99")
    assert ingest.read_bronze(spark, f"{root}/watch_events").count() == b.watch_events.count()


def test_rows_without_an_ingestion_time_are_loaded_once(spark, sf_dir):
    b = bind(spark, sf_dir)
    layers = seeded(spark, b, b.watch_events)
    L.run_silver(layers, DAY1)
    late = b.watch_events.limit(2).withColumn("event_id", F.concat(F.lit("late"), "event_id")) \
        .withColumn("ingestion_time", F.lit(None).cast("timestamp_ntz"))
    layers.bronze.append("watch_events", late)
    for _ in range(2):
        L.run_silver(layers, DAY2)
    assert layers.silver.read("watch_sessions").count() == b.watch_events.count() + 2


def test_unchanged_users_keep_their_files(spark, sf_dir):
    b = bind(spark, sf_dir)
    layers = seeded(spark, b, b.watch_events.limit(50))
    L.run_silver(layers, DAY1)
    files = sorted(layers.silver.read("dim_user").inputFiles())
    assert L.run_silver(layers, DAY2)["dim_user"] == "unchanged"
    assert sorted(layers.silver.read("dim_user").inputFiles()) == files
    layers.bronze.replace_all("users", b.users_v2)
    assert L.run_silver(layers, DAY2)["dim_user"] != "unchanged"
