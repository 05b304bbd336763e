"""Compaction of stream batches under a manifest."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from reelstar.plans import layers as L
from reelstar.schemas import BRONZE_WATCH, WATCH_JSON
from reelstar.session import work_dir
from reelstar.sources.files import Files
from reelstar.sources.fixtures import bind
from reelstar.streaming import bronze_log, ingest

T0 = dt.datetime(2024, 2, 4, 23, 50)
COLS = [f.name for f in WATCH_JSON.fields]


def fill(spark, out, batches, events, first=0):
    """Batches of 20 minutes each: several days of ingestion."""
    for n in range(first, first + batches):
        some = events.filter(F.col("event_id").cast("long") % 10 == n % 10).limit(20)
        bad = spark.createDataFrame([("{broken",)], "value string")
        raw = ingest.to_json_lines(some, COLS).unionByName(bad)
        ingest.BatchWriter(out, "event_id", clock=lambda n=n: T0 + n * dt.timedelta(minutes=20))(
            ingest.parse_json_values(raw, WATCH_JSON), n)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_compaction_keeps_rows_and_bounds_files(spark, sf_dir, monkeypatch):
    ev = bind(spark, sf_dir).watch_events
    out = f"{work_dir(spark, 't-compact')}/watch_events"
    assert bronze_log.compact(spark, out)["upto"] == -1  # nothing there yet
    fill(spark, out, 3, ev)
    want, bad = rows(ingest.read_bronze(spark, out)), ingest.read_bronze(spark, out, rejects=True).count()
    planned = ingest.read_bronze(spark, out)
    with monkeypatch.context() as m:
        def lost(*_):
            raise RuntimeError("driver lost")
        m.setattr(Files, "put", lost)
        with pytest.raises(RuntimeError):
            ingest.compact(spark, out)
    assert rows(ingest.read_bronze(spark, out)) == want
    made = ingest.compact(spark, out, max_parts=2)
    assert made["upto"] == 1  # the newest batch may be written again
    assert sorted(p["day"] for p in made["parts"]) == ["2024-02-04", "2024-02-05"]
    assert rows(ingest.read_bronze(spark, out)) == want == rows(planned)
    assert ingest.read_bronze(spark, out, rejects=True).count() == bad == 3
    fill(spark, out, 1, ev)  # a replay of a compacted batch adds nothing
    assert rows(ingest.read_bronze(spark, out)) == want
    for k in range(3, 9):
        fill(spark, out, 1, ev, first=k)
        made = ingest.compact(spark, out, max_parts=2)
        assert max(sum(p["day"] == d for p in made["parts"]) for d in ("2024-02-04", "2024-02-05")) <= 2
    assert made["upto"] == 7 and ingest.read_bronze(spark, out).count() == 9 * 20
    left = [n for n in Files(spark).folders(out) if n.startswith("batch_id=")]
    assert len(left) <= 4  # what the last manifests named, and the newest batch
    with pytest.raises(ValueError):
        ingest.read_bronze(spark, work_dir(spark, "nothing"))


def test_a_refresh_opens_only_new_batches(spark, sf_dir):
    ev = bind(spark, sf_dir).watch_events
    out = f"{work_dir(spark, 't-since')}/watch_events"
    fill(spark, out, 4, ev)
    ingest.compact(spark, out)
    src = ingest.bronze_loads(spark, out)
    assert src.latest == 3 and src.whole().count() == 80 == src.since(None).count()
    assert src.since(2).count() == 20 and all("batch_id=3" in f for f in src.since(2).inputFiles())
    assert src.since(3).count() == 0 and src.since(0).count() == 60


def test_stream_loads_feed_silver_whatever_ids_repeat(spark, sf_dir):
    b = bind(spark, sf_dir)
    out = f"{work_dir(spark, 't-feed')}/watch_events"
    layers = L.Layers.under(spark, work_dir(spark, "t-feed-lake"), prefix=f"rsf{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": b.watch_events.limit(0), "ratings_late": b.ratings_late.limit(0)})
    for k, batches in enumerate((2, 3, 1)):
        fill(spark, out, batches, b.watch_events.filter("event_id < 100"), first=(0, 2, 5)[k])
        if k:
            ingest.compact(spark, out)
        stats = L.run_silver(layers, T0 + dt.timedelta(days=1), bronze_inputs={
            "watch_events": ingest.bronze_loads(spark, out)})
        assert stats["watch_sessions"]["rows"] == 10 * batches
    # batches 0-5 of the ids below 100 by last digit; again as 10 and 11
    fill(spark, out, 2, b.watch_events.filter("event_id < 100"), first=10)
    stats = L.run_silver(layers, T0, bronze_inputs={"watch_events": ingest.bronze_loads(spark, out)})
    assert stats["watch_sessions"]["rows"] == 20
    silver = layers.silver.read("watch_sessions")
    assert silver.count() == 80 and silver.select("event_id").distinct().count() == 60


def test_offset_ranges_and_gaps(spark):
    out = f"{work_dir(spark, 't-offsets')}/watch_events"
    def batch(n, *places):
        rows = [('{"event_id": "e%d-%d"}' % p if p[1] % 3 else "{broken", *p) for p in places]
        raw = spark.createDataFrame(rows, f"value string, {ingest.PARTITION} int, {ingest.OFFSET} long")
        ingest.BatchWriter(out, "event_id", clock=lambda: T0)(ingest.parse_json_values(raw, WATCH_JSON), n)
    batch(0, (0, 10), (0, 11), (1, 5))
    batch(1, (0, 12), (0, 13))
    assert bronze_log.offset_gaps(ingest.offset_ranges(spark, out)) == []
    batch(1, (0, 12), (0, 13))  # a replay
    batch(2, (0, 16), (1, 6), (1, 8))
    batch(3, (0, 16), (0, 17))
    want = [{"kind": "gap", "partition": 0, "first": 14, "last": 15},
            {"kind": "repeat", "partition": 0, "first": 16, "last": 16},
            {"kind": "sparse", "partition": 1, "first": 5, "last": 8}]
    before = ingest.offset_ranges(spark, out)
    assert bronze_log.offset_gaps(before) == want
    ingest.compact(spark, out)
    batch(4, (0, 18))
    ingest.compact(spark, out)
    assert bronze_log.offset_gaps(ingest.offset_ranges(spark, out)) == want
    assert ingest.read_bronze(spark, out).columns == [f.name for f in BRONZE_WATCH.fields]
