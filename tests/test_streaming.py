import datetime as dt
import os

from pyspark.sql import functions as F

from reelstar.schemas import WATCH_JSON
from reelstar.session import local_path, work_dir
from reelstar.sources.fixtures import bind
from reelstar.streaming import ingest

CLOCK = dt.datetime(2024, 2, 5)
COLS = [f.name for f in WATCH_JSON.fields]


def _run(spark, inbox, out, ckpt):
    q = ingest.start_ingest(ingest.text_source(spark, inbox), WATCH_JSON, "event_id", out, ckpt,
                            trigger={"availableNow": True}, clock=lambda: CLOCK)
    q.awaitTermination()
    return q


def test_restart_and_rejects(spark, sf_dir):
    ev = bind(spark, sf_dir).watch_events
    root = work_dir(spark, "t-stream")
    inbox, out, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    ingest.to_json_lines(ev, COLS).write.text(inbox)
    spark.createDataFrame([("{broken",), ('{"event_id": null, "user_id": "x"}',),
                           ('{"event_id": "w1", "watch_duration_seconds": "long"}',)], "value string") \
        .write.mode("append").text(inbox)
    _run(spark, inbox, out, ckpt)
    _run(spark, inbox, out, ckpt)  # restart with no new files: nothing re-emitted
    good = ingest.read_bronze(spark, out)
    assert good.count() == ev.count() + 1
    # wrong-typed field -> NULL field, row kept
    assert good.filter("event_id = 'w1'").first()["watch_duration_seconds"] is None
    assert ingest.read_bronze(spark, out, rejects=True).count() == 2
    # full microseconds survive the JSON round trip
    joined = good.join(ev.select("event_id", F.col("event_time").alias("t0")), "event_id")
    assert joined.filter(F.col("t0") != F.col("event_time")).count() == 0


def test_replayed_batch_overwrites_its_output(spark, sf_dir):
    ev = bind(spark, sf_dir).watch_events.limit(50)
    root = work_dir(spark, "t-replay")
    writer = ingest.BatchWriter(f"{root}/out", "event_id", clock=lambda: CLOCK)
    raw = ingest.to_json_lines(ev, COLS)
    batch = ingest.parse_json_values(raw, WATCH_JSON)
    writer(batch, 0)
    first = sorted(map(tuple, ingest.read_bronze(spark, f"{root}/out").collect()))
    # replay of batch 0 after a failure, later on the clock: same rows, same stamp
    ingest.BatchWriter(f"{root}/out", "event_id", clock=lambda: CLOCK + dt.timedelta(hours=1))(batch, 0)
    writer(batch.limit(0), 1)  # empty batch: skipped
    assert sorted(map(tuple, ingest.read_bronze(spark, f"{root}/out").collect())) == first
    assert len(first) == 50
    assert not os.path.exists(local_path(f"{root}/out/batch_id=1"))
    # a new batch takes the clock
    ingest.BatchWriter(f"{root}/out", "event_id", clock=lambda: CLOCK + dt.timedelta(hours=2))(batch, 2)
    stamps = ingest.read_bronze(spark, f"{root}/out").groupBy("ingestion_time").count().collect()
    assert sorted((r[0], r[1]) for r in stamps) == [(CLOCK, 50), (CLOCK + dt.timedelta(hours=2), 50)]


def test_two_streams_side_by_side(spark, sf_dir):
    b = bind(spark, sf_dir)
    root = work_dir(spark, "t-two")
    ingest.to_json_lines(b.watch_events, COLS).write.text(f"{root}/in_w")
    ingest.to_json_lines(b.ratings_late, ["rating_id", "user_id", "content_id", "rating_value", "event_time"]) \
        .write.text(f"{root}/in_r")
    qs = ingest.start_bronze_streams(
        spark, {"watch_events": ingest.text_source(spark, f"{root}/in_w"),
                "ratings_late": ingest.text_source(spark, f"{root}/in_r")},
        f"{root}/bronze", f"{root}/ckpt", trigger={"availableNow": True}, clock=lambda: CLOCK)
    for q in qs:
        q.awaitTermination()
    assert ingest.read_bronze(spark, f"{root}/bronze/watch_events").count() == b.watch_events.count()
    assert ingest.read_bronze(spark, f"{root}/bronze/ratings_late").count() == b.ratings_late.count()


def test_stream_feeds_silver_and_gold(spark, sf_dir):
    """Stream -> bronze batches -> silver/gold, twice: the second refresh picks
    up exactly the rows of the batches that arrived in between."""
    import uuid

    from reelstar.plans import layers as L
    from reelstar.schemas import RATINGS_JSON

    b = bind(spark, sf_dir)
    ev = b.watch_events
    rcols = [f.name for f in RATINGS_JSON.fields]
    root = work_dir(spark, "t-stream-silver")
    clocks = iter([dt.datetime(2024, 2, 4), dt.datetime(2024, 2, 5)])
    half = F.col("event_id").cast("long") % 2 == 0
    layers = L.Layers.under(spark, f"{root}/lake", prefix=f"rsst{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": ev.limit(0), "ratings_late": b.ratings_late.limit(0)})
    ingest.to_json_lines(b.ratings_late, rcols).write.text(f"{root}/in_r")
    for part, as_of in ((half, dt.datetime(2024, 2, 4)), (~half, dt.datetime(2024, 2, 5))):
        ingest.to_json_lines(ev.filter(part), COLS).write.mode("append").text(f"{root}/in_w")
        clock = next(clocks)
        for src, schema, key, name in ((f"{root}/in_w", WATCH_JSON, "event_id", "w"),
                                       (f"{root}/in_r", RATINGS_JSON, "rating_id", "r")):
            ingest.start_ingest(ingest.text_source(spark, src), schema, key, f"{root}/bronze_{name}",
                                f"{root}/ckpt_{name}", trigger={"availableNow": True},
                                clock=lambda c=clock: c).awaitTermination()
        stats = L.run_all(layers, as_of, bronze_inputs={
            "watch_events": ingest.read_bronze(spark, f"{root}/bronze_w"),
            "ratings_late": ingest.read_bronze(spark, f"{root}/bronze_r")})
        assert stats["silver"]["watch_sessions"]["rows"] == ev.filter(part).count()
    assert layers.silver.read("watch_sessions").count() == ev.count()
    assert layers.silver.read("ratings").count() == b.ratings_late.count()
    assert layers.gold.read("fact_watch_sessions").count() == ev.count()
