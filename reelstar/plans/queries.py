"""Registered queries: one Spark plan per operator of the engagement model.

Every query reads the driver's tables through the bindings in
``sources.fixtures`` (so its work grows with them) and returns a DataFrame.
Queries that exercise stateful behaviour (streaming, table stores, two-day
runs) do their writes below the shared checkpoint folder and return a read
of the result table.

The run clock is injected: day 1 = ``DAY1``, day 2 = ``AS_OF``.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import ntz_lit
from ..operators import dims, engagement, enrich, fact as fact_ops, features, incremental, quality, scd2
from ..schemas import RATINGS_JSON, WATCH_JSON
from ..session import work_dir
from ..sources.fixtures import Bindings, bind
from ..sources.tables import TableStore
from ..streaming import ingest
from . import layers as L

DAY1 = _dt.datetime(2024, 2, 4)
AS_OF = _dt.datetime(2024, 2, 5)
# A previous silver run saw every event ingested before this instant.
PREVIOUS_RUN = _dt.datetime(2024, 1, 20)
# Events ingested before this instant arrive last in the out-of-order queries.
BACKFILL_BEFORE = _dt.datetime(2024, 1, 10)
# dim_time already holds the days before this date (incremental query).
DIM_TIME_EXISTING_BEFORE = _dt.datetime(2024, 1, 15)
# The second daily_engagement write of replace_all starts at this day.
REPLACE_SECOND_FROM = _dt.datetime(2024, 1, 3)

WATCH_COLS = [f.name for f in WATCH_JSON.fields]
RATINGS_COLS = [f.name for f in RATINGS_JSON.fields]


# ---------------------------------------------------------------- shared plans
def _dim_content(b: Bindings, as_of=AS_OF) -> DataFrame:
    return dims.dim_content(b.content_catalog, as_of)


def _sessions(b: Bindings) -> DataFrame:
    return enrich.build_watch_sessions(b.watch_events, _dim_content(b), AS_OF)


def _dim_user_initial(b: Bindings) -> DataFrame:
    return scd2.scd2_initial(scd2.prepare_snapshot(b.users), DAY1)


def _dim_user_applied(b: Bindings) -> DataFrame:
    return scd2.scd2_apply(_dim_user_initial(b), scd2.prepare_snapshot(b.users_v2), AS_OF)


def _fact(b: Bindings) -> DataFrame:
    return fact_ops.build_fact(_sessions(b), scd2.current_rows(_dim_user_initial(b)), AS_OF)


def _daily(b: Bindings) -> DataFrame:
    return engagement.daily_engagement(_fact(b), AS_OF)


def _daily_user(b: Bindings) -> DataFrame:
    return features.daily_user(_fact(b), scd2.current_rows(_dim_user_initial(b)), _dim_content(b))


def _fresh_store(spark: SparkSession, purpose: str) -> TableStore:
    ns = f"rs_{purpose}_{uuid.uuid4().hex[:10]}"
    store = TableStore(spark, ns, work_dir(spark, purpose))
    store.create_namespace()
    return store


# ---------------------------------------------------------------- queries
def q_json_parse(kind: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = bind(spark, sf_dir)
        src, schema, cols = ((b.watch_events, WATCH_JSON, WATCH_COLS) if kind == "watch"
                             else (b.ratings_late, RATINGS_JSON, RATINGS_COLS))
        parsed = ingest.parse_json_values(ingest.to_json_lines(src, cols), schema)
        return ingest.to_bronze(parsed, AS_OF)
    return run


def q_stream_ingest(kind: str):
    """JSON lines of the whole table in two file sets + reject lines; two
    availableNow runs on one checkpoint; then a batch read of bronze."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = bind(spark, sf_dir)
        src, schema, key, cols = ((b.watch_events, WATCH_JSON, "event_id", WATCH_COLS) if kind == "watch"
                                  else (b.ratings_late, RATINGS_JSON, "rating_id", RATINGS_COLS))
        root = work_dir(spark, f"stream-{kind}")
        inbox, out, ckpt = f"{root}/in", f"{root}/bronze", f"{root}/checkpoint"
        early = F.col("ingestion_time") < ntz_lit(PREVIOUS_RUN)
        ingest.to_json_lines(src.filter(early), cols).write.mode("append").text(inbox)
        # a malformed line and a line without its key: both go to the rejects
        bad = spark.range(1).select(F.explode(F.array(
            F.lit("{not json"), F.to_json(F.struct(F.lit(None).cast("string").alias(key)))
        )).alias("value"))
        bad.write.mode("append").text(inbox)

        def clock():  # injected clock: deterministic ingestion stamps
            return AS_OF

        for run_no in range(2):
            if run_no == 1:
                ingest.to_json_lines(src.filter(~early), cols).write.mode("append").text(inbox)
            q = ingest.start_ingest(ingest.text_source(spark, inbox), schema, key, out, ckpt,
                                    trigger={"availableNow": True}, clock=clock)
            q.awaitTermination()
        return ingest.read_bronze(spark, out).select(*cols, "ingestion_time")
    return run


def q_append_if_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bind(spark, sf_dir)
    store = _fresh_store(spark, "seed")
    store.create("content_catalog", L.BRONZE_TABLES["content_catalog"])
    store.append_if_empty("content_catalog", b.content_catalog)
    store.append_if_empty("content_catalog", b.content_catalog)  # no-op: already loaded
    return store.read("content_catalog")


def q_ddl_insert_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL DDL/DML path: CREATE NAMESPACE / CREATE TABLE (NOT NULL key) /
    INSERT INTO ... SELECT of the whole watch-event binding, then a scan."""
    b = bind(spark, sf_dir)
    store = _fresh_store(spark, "ddl")
    store.create("watch_events", L.BRONZE_TABLES["watch_events"])
    store.insert_select("watch_events", b.watch_events)
    return store.read("watch_events")


def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bind(spark, sf_dir)
    return quality.run_checks({"users": b.users, "content_catalog": b.content_catalog,
                               "watch_events": b.watch_events, "ratings_late": b.ratings_late})


def q_age_band(spark, sf_dir):
    b = bind(spark, sf_dir)
    return scd2.prepare_snapshot(b.users).select("user_id", "age", "age_band")


def q_scd2_initial(spark, sf_dir):
    return _dim_user_initial(bind(spark, sf_dir))


def q_scd2_changes(spark, sf_dir):
    b = bind(spark, sf_dir)
    current = scd2.current_rows(_dim_user_initial(b))
    return scd2.scd2_changes(scd2.prepare_snapshot(b.users_v2), current)


def q_scd2_apply(spark, sf_dir):
    return _dim_user_applied(bind(spark, sf_dir))


def q_scd2_current(spark, sf_dir):
    return scd2.current_rows(_dim_user_applied(bind(spark, sf_dir)))


def q_dim_content(spark, sf_dir):
    return _dim_content(bind(spark, sf_dir))


def q_dim_time_full(spark, sf_dir):
    return dims.dim_time_increment(bind(spark, sf_dir).watch_events, None, AS_OF)


def q_dim_time_incremental(spark, sf_dir):
    ev = bind(spark, sf_dir).watch_events
    existing = dims.dim_time_increment(ev.filter(F.col("event_time") < ntz_lit(DIM_TIME_EXISTING_BEFORE)),
                                       None, DAY1)
    return dims.dim_time_increment(ev, existing, AS_OF)


def q_dim_device(spark, sf_dir):
    return dims.dim_device(bind(spark, sf_dir).watch_events, AS_OF)


def _previous_target(b: Bindings) -> DataFrame:
    prev = b.watch_events.filter(F.col("ingestion_time") < ntz_lit(PREVIOUS_RUN))
    return enrich.build_watch_sessions(prev, _dim_content(b, DAY1), DAY1)


def q_hwm(spark, sf_dir):
    return _previous_target(bind(spark, sf_dir)).agg(F.max("source_ingestion_time").alias("hwm"))


def q_incremental_scan(spark, sf_dir):
    b = bind(spark, sf_dir)
    hwm = incremental.high_water_mark(_previous_target(b))
    return incremental.incremental(b.watch_events, hwm, "ingestion_time")


def q_late_arrival(spark, sf_dir):
    return enrich.late_arrival(bind(spark, sf_dir).watch_events)


def q_completion_percent(spark, sf_dir):
    b = bind(spark, sf_dir)
    s = enrich.with_duration(b.watch_events, _dim_content(b))
    from ..functions.scalar import completion_percent
    return s.select("event_id", "watch_duration_seconds", "duration_minutes",
                    completion_percent("watch_duration_seconds", "duration_minutes").alias("completion_percent"))


def q_watch_sessions(spark, sf_dir):
    return _sessions(bind(spark, sf_dir))


def q_ratings_48h(spark, sf_dir):
    return enrich.build_ratings(bind(spark, sf_dir).ratings_late, AS_OF)


def q_fact(spark, sf_dir):
    return _fact(bind(spark, sf_dir)).drop("event_id")


def q_daily_engagement(spark, sf_dir):
    return _daily(bind(spark, sf_dir))


def q_event_mix(spark, sf_dir):
    return engagement.event_mix(_fact(bind(spark, sf_dir)))


def q_distinct_users(spark, sf_dir):
    return engagement.distinct_users(_fact(bind(spark, sf_dir)))


def q_top_days(spark, sf_dir):
    return engagement.top_days(_daily(bind(spark, sf_dir)), 5)


def q_preferred_device(spark, sf_dir):
    return features.preferred_device(_fact(bind(spark, sf_dir)))


def q_favorite_genre(spark, sf_dir):
    b = bind(spark, sf_dir)
    return features.favorite_genre(_fact(b), _dim_content(b))


def q_daily_user(spark, sf_dir):
    return _daily_user(bind(spark, sf_dir))


def q_rolling_7d(spark, sf_dir):
    d = features.with_rolling(_daily_user(bind(spark, sf_dir)))
    return d.select("date", "user_id", "sessions_count", "sessions_7d", "watch_hours_7d")


def q_rolling_30d(spark, sf_dir):
    d = features.with_rolling(_daily_user(bind(spark, sf_dir)))
    return d.select("date", "user_id", "total_watch_hours", "watch_time_30d")


def q_churn_label(spark, sf_dir):
    from ..functions.scalar import churn_label
    d = _daily_user(bind(spark, sf_dir))
    return d.select("date", "user_id", "finish_rate", "sessions_count", "days_since_signup",
                    churn_label("finish_rate", "sessions_count", "days_since_signup").alias("churn_label"))


def q_churn_features(spark, sf_dir):
    b = bind(spark, sf_dir)
    return features.churn_features(_fact(b), scd2.current_rows(_dim_user_initial(b)), _dim_content(b), AS_OF)


def q_replace_all(spark, sf_dir):
    b = bind(spark, sf_dir)
    store = _fresh_store(spark, "replace")
    store.create("daily_engagement", L.GOLD_TABLES["daily_engagement"])
    fact = _fact(b)
    store.replace_all("daily_engagement", engagement.daily_engagement(fact, DAY1))
    later = fact.filter(F.col("event_date") >= F.lit(REPLACE_SECOND_FROM.date()))
    store.replace_all("daily_engagement", engagement.daily_engagement(later, AS_OF))
    return store.read("daily_engagement")


def _two_day_run(spark: SparkSession, sf_dir: str) -> L.Layers:
    """Day 1: bronze holds what was ingested before PREVIOUS_RUN and the
    day-1 users; silver+gold run.  Day 2: the rest of the events/ratings
    arrive, users are replaced by the day-2 snapshot; silver+gold run again
    (incremental fact, SCD2 apply, full replace of the gold aggregates)."""
    b = bind(spark, sf_dir)
    layers = L.Layers.under(spark, work_dir(spark, "two-day"), prefix=f"rs{uuid.uuid4().hex[:8]}")
    before = F.col("ingestion_time") < ntz_lit(PREVIOUS_RUN)
    L.seed_bronze(layers, {
        "users": b.users, "content_catalog": b.content_catalog,
        "watch_events": b.watch_events.filter(before), "ratings_late": b.ratings_late.filter(before),
    })
    L.run_all(layers, DAY1)
    layers.bronze.append("watch_events", b.watch_events.filter(~before))
    layers.bronze.append("ratings_late", b.ratings_late.filter(~before))
    layers.bronze.replace_all("users", b.users_v2)
    L.run_all(layers, AS_OF)
    return layers


def q_two_day_daily(spark, sf_dir):
    return _two_day_run(spark, sf_dir).gold.read("daily_engagement")


def q_two_day_churn(spark, sf_dir):
    return _two_day_run(spark, sf_dir).gold.read("churn_features")


def q_pipeline_end_to_end(spark, sf_dir):
    """The gold fact after both days: day-1 rows keep the key of the day-1
    user version, day-2 rows get the key current after the SCD2 apply."""
    return _two_day_run(spark, sf_dir).gold.read("fact_watch_sessions").drop("event_id")


def _seeded(spark: SparkSession, b: Bindings, purpose: str, events: DataFrame) -> L.Layers:
    layers = L.Layers.under(spark, work_dir(spark, purpose), prefix=f"rs{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": events, "ratings_late": b.ratings_late})
    return layers


def q_same_clock_rerun(spark, sf_dir):
    """Two runs with one clock, the second after more events arrived: the KPIs
    are those of all events."""
    b = bind(spark, sf_dir)
    before = F.col("ingestion_time") < ntz_lit(PREVIOUS_RUN)
    layers = _seeded(spark, b, "same-clock", b.watch_events.filter(before))
    L.run_all(layers, AS_OF)
    layers.bronze.append("watch_events", b.watch_events.filter(~before))
    L.run_all(layers, AS_OF)
    return layers.gold.read("daily_engagement")


def q_reload_after_truncate(spark, sf_dir):
    """The sessions and facts are emptied after a run; the next run loads them
    again, whatever marks were recorded."""
    b = bind(spark, sf_dir)
    layers = _seeded(spark, b, "reload", b.watch_events)
    L.run_all(layers, AS_OF)
    for store, name in ((layers.silver, "watch_sessions"), (layers.gold, "fact_watch_sessions")):
        store.replace_all(name, store.read(name).filter("false"))
    L.run_all(layers, AS_OF)
    return layers.gold.read("daily_engagement")


def _out_of_order(spark: SparkSession, sf_dir: str) -> L.Layers:
    """Loads in any order: a middle slice of the events; the newest ones and
    one in seven events again, a day later; then, under an earlier clock, a
    backfill of the oldest and the same events once more."""
    b = bind(spark, sf_dir)
    at, ev = F.col("ingestion_time"), b.watch_events
    oldest, newest = at < ntz_lit(BACKFILL_BEFORE), at >= ntz_lit(PREVIOUS_RUN)

    def again(days: int) -> DataFrame:
        return ev.filter(F.col("event_id").cast("long") % 7 == 0).withColumn(
            "ingestion_time", F.timestamp_add("DAY", F.lit(days), at))

    layers = _seeded(spark, b, "out-of-order", ev.filter(~oldest & ~newest))
    L.run_all(layers, DAY1)
    layers.bronze.append("watch_events", ev.filter(newest).unionByName(again(1)))
    L.run_all(layers, AS_OF)
    layers.bronze.append("watch_events", ev.filter(oldest))
    layers.bronze.append("watch_events", again(2))
    L.run_all(layers, DAY1)
    return layers


def q_repeated_ids_in_increments(spark, sf_dir):
    return _out_of_order(spark, sf_dir).gold.read("daily_engagement").drop("ingestion_time")


def q_backfill_churn(spark, sf_dir):
    return _out_of_order(spark, sf_dir).gold.read("churn_features").drop("ingestion_time")


def q_stream_compacted(spark, sf_dir):
    """The whole event table through four batches, compacted in between (days
    merged) with a batch half written; the bronze table is the same."""
    b = bind(spark, sf_dir)
    out = f"{work_dir(spark, 'stream-compacted')}/watch_events"
    write = ingest.BatchWriter(out, "event_id", clock=lambda: AS_OF)
    for n in range(4):
        some = b.watch_events.filter(F.col("event_id").cast("long") % 4 == n)
        write(ingest.parse_json_values(ingest.to_json_lines(some, WATCH_COLS), WATCH_JSON), n)
        if n:
            ingest.compact(spark, out, max_parts=1)
    half = ingest.read_bronze(spark, out).withColumn("accepted", F.lit(True))
    half.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").partitionBy("accepted").parquet(
        f"{out}/batch_id=4")
    return ingest.read_bronze(spark, out).select(*WATCH_COLS, "ingestion_time")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "json_parse_watch": q_json_parse("watch"),
    "json_parse_ratings": q_json_parse("ratings"),
    "stream_watch_ingest": q_stream_ingest("watch"),
    "stream_ratings_ingest": q_stream_ingest("ratings"),
    "append_if_empty": q_append_if_empty,
    "ddl_insert_select": q_ddl_insert_select,
    "dq_report": q_dq_report,
    "age_band": q_age_band,
    "scd2_initial": q_scd2_initial,
    "scd2_changes": q_scd2_changes,
    "scd2_apply": q_scd2_apply,
    "scd2_current": q_scd2_current,
    "dim_content": q_dim_content,
    "dim_time_full": q_dim_time_full,
    "dim_time_incremental": q_dim_time_incremental,
    "dim_device": q_dim_device,
    "hwm": q_hwm,
    "incremental_scan": q_incremental_scan,
    "late_arrival": q_late_arrival,
    "completion_percent": q_completion_percent,
    "watch_sessions": q_watch_sessions,
    "ratings_48h": q_ratings_48h,
    "fact_watch_sessions": q_fact,
    "daily_engagement": q_daily_engagement,
    "event_mix": q_event_mix,
    "distinct_users": q_distinct_users,
    "top_days": q_top_days,
    "preferred_device": q_preferred_device,
    "favorite_genre": q_favorite_genre,
    "daily_user": q_daily_user,
    "rolling_7d": q_rolling_7d,
    "rolling_30d": q_rolling_30d,
    "churn_label": q_churn_label,
    "churn_features": q_churn_features,
    "replace_all": q_replace_all,
    "two_day_daily": q_two_day_daily,
    "two_day_churn": q_two_day_churn,
    "pipeline_end_to_end": q_pipeline_end_to_end,
    "same_clock_rerun": q_same_clock_rerun,
    "reload_after_truncate": q_reload_after_truncate,
    "repeated_ids_in_increments": q_repeated_ids_in_increments,
    "backfill_churn": q_backfill_churn,
    "stream_compacted": q_stream_compacted,
}
