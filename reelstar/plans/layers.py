"""Layer runs: bronze seed -> silver -> gold (the scheduled batch jobs).

Each step computes its target once and writes it; counts come from
``Observation`` metrics of the write, not from re-running the plan.  One
injected clock (``as_of``) stamps a whole run.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from .. import schemas
from ..functions.aggregates import count_if
from ..functions.scalar import ntz_lit
from ..operators import dims, engagement, enrich, fact as fact_ops, features, incremental, quality, scd2
from ..operators.joins import heavy_keys
from ..sources.ledger import LOAD, LOAD_DATE, Loads, among, days_of
from ..sources.tables import BUCKET, TableStore, row_count


@dataclass
class Layers:
    bronze: TableStore
    silver: TableStore
    gold: TableStore

    @classmethod
    def under(cls, spark: SparkSession, root: str, provider: str = "parquet",
              prefix: str = "rs", catalog: str | None = None) -> "Layers":
        stores = {
            layer: TableStore(spark, f"{prefix}_{layer}", f"{root.rstrip('/')}/{layer}", provider, catalog)
            for layer in ("bronze", "silver", "gold")
        }
        return cls(**stores)


@dataclass
class Options:
    insert_new_users: bool = True      # False: users first seen after the initial load are ignored
    null_safe_changes: bool = True     # False: NULL <-> value changes are missed
    refresh_static_dims: bool = False  # True: add unseen content ids / device types on every run
    increments: str = "loads"  # or "time": rows of the bronze tables by ingestion time, above the target's mark
    hwm_overlap: _dt.timedelta | None = None  # by time only: start so much below the mark, drop known keys
    daily_refresh: str = "affected_dates"  # or "full": recompute every date on every run
    # "auto": event and rating rows of loads are checked in the run that loads them, tables without load
    # numbers whole; "whole": all rows on every run; "increment": rows of the increment only
    gate: str = "auto"
    # share of an increment's rows from which a user or title is measured as hot and its lookups are
    # salted (one more pass over two columns of the increment); None: left to AQE's skew join
    heavy_share: float | None = None
    stats: dict = field(default_factory=dict)


BRONZE_TABLES = {
    "users": schemas.BRONZE_USERS,
    "content_catalog": schemas.BRONZE_CONTENT,
    "watch_events": schemas.BRONZE_WATCH,
    "ratings_late": schemas.BRONZE_RATINGS,
}
# Buckets of the current user versions, by a hash of the user: a changed user
# rewrites one.  For a dimension of billions, take as many as keep a bucket near
# the size of a file.
USER_BUCKETS = 16
SILVER_TABLES = {
    "dim_user": T.StructType([*schemas.DIM_USER.fields, T.StructField(BUCKET, T.IntegerType())]), "dim_content": schemas.DIM_CONTENT, "dim_time": schemas.DIM_TIME,
    "dim_device": schemas.DIM_DEVICE, "watch_sessions": schemas.WATCH_SESSIONS,
    "ratings": schemas.RATINGS,
}
# Partitioning of the growing tables: silver sessions by the day they were
# processed (the gold increment reads only the days of the loads it takes), the
# fact and the roll-up by event day.
PARTITIONS = {
    # dim_user by the day a version ended: the current versions form the NULL
    # partition, in buckets; an SCD2 run rewrites only the buckets with changes
    # and today's expired slice - never the accumulated history
    "dim_user": ("effective_to", BUCKET),
    "watch_sessions": ("processing_date",),
    "fact_watch_sessions": ("event_date",),
    "daily_user_base": ("date",),
    "daily_user_rolled": ("date",),
}
# Tables that only grow: every row carries the number of the load that brought
# it, so the next layer reads loads, not time stamps.  Those without a day of
# their own are partitioned by the day of the load.
LOGGED = {"watch_events", "ratings_late", "watch_sessions", "ratings", "fact_watch_sessions"}
GOLD_TABLES = {
    "fact_watch_sessions": schemas.FACT_WATCH,
    "daily_engagement": schemas.DAILY_ENGAGEMENT,
    "daily_user_base": schemas.DAILY_USER_BASE,
    "daily_user_rolled": schemas.DAILY_USER_ROLLED,
    "churn_features": schemas.CHURN_FEATURES,
}


def _together(spark: SparkSession, *tasks: Callable[[], object]) -> list:
    """Run independent writes side by side (Spark schedules their jobs); all end
    before an error of one is raised."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
    return [r.result() for r in running]


def create_tables(store: TableStore, tables: dict) -> None:
    store.create_namespace()
    for name, schema in tables.items():
        store.create(name, schema, PARTITIONS.get(name, ()), logged=name in LOGGED)


def _mark(col: str = "source_ingestion_time"):
    return F.max(F.col(col)).alias("mark")


def _hwm(store: TableStore, table: str):
    """Exact mark, aggregated only above the recorded lower bound."""
    return incremental.high_water_mark(store.read(table), floor=store.watermark(table))


def _current_users(store: TableStore) -> DataFrame:
    """Current user versions, read from the NULL ``effective_to`` partition
    only (a partition filter; ``is_current`` holds exactly there)."""
    return scd2.current_rows(store.read("dim_user").filter(F.col("effective_to").isNull()))


def _since(source: DataFrame, hwm, overlap: _dt.timedelta | None = None,
           ts_col: str = "ingestion_time") -> DataFrame:
    """Rows at or after the start of the next increment (a superset of it
    when an overlap is configured); the whole table before the first run."""
    if hwm is None:
        return source
    lower = hwm - overlap if overlap else hwm
    return source.filter(F.col(ts_col) >= ntz_lit(lower))


def _increment(source: DataFrame | Loads, target: TableStore, table: str, name: str, key: str,
               opts: Options) -> tuple[DataFrame, DataFrame, dict | None]:
    """The rows of a bronze table that ``table`` does not hold, those the gate
    and the dimensions look at, and what the next run goes on from.

    By load number the increment is what was committed since, whatever its
    stamps and keys.  Without load numbers it is read by ingestion time: at or
    after the mark, rows with a known key dropped.
    """
    if isinstance(source, Loads) and opts.increments == "loads":
        # a target that holds nothing (new or emptied) is loaded from the start
        after = None if target.is_empty(table) else target.ledger.position(table, name)
        rows = source.since(after).drop(LOAD, LOAD_DATE)
        return rows, rows, {name: source.latest}
    rows = _rows(source)
    hwm = _hwm(target, table)
    overlap = opts.hwm_overlap or _dt.timedelta(0)
    new = incremental.incremental(rows, hwm, "ingestion_time", overlap, target.read(table), key)
    return new, _since(rows, hwm, opts.hwm_overlap), None


def _rows(source: DataFrame | Loads) -> DataFrame:
    return source.whole().drop(LOAD, LOAD_DATE) if isinstance(source, Loads) else source


def _append_sessions(store: TableStore, table: str, df: DataFrame, upto: dict | None, extra: list | None = None) -> dict:
    m = store.append(table, df, metrics=[row_count(), _mark(), *(extra or [])], upto=upto, sole_writer=True)
    if upto is None:
        store.record_watermark(table, m.get("mark"))
    return m


def seed_bronze(layers: Layers, inputs: dict[str, DataFrame]) -> dict[str, bool]:
    """Idempotent seed: each bronze table is loaded only while it is empty."""
    create_tables(layers.bronze, BRONZE_TABLES)
    done = _together(layers.bronze.spark, *[
        lambda n=name, d=df: layers.bronze.append_if_empty(n, d) for name, df in inputs.items()])
    return dict(zip(inputs, done, strict=True))


def run_silver(layers: Layers, as_of: _dt.datetime, opts: Options | None = None,
               bronze_inputs: dict[str, DataFrame | Loads] | None = None) -> dict:
    """Bronze -> silver.  ``bronze_inputs`` replaces bronze tables by other
    sources with the same columns - typically the streaming ingest output,
    ``{"watch_events": ingest.bronze_loads(spark, dir), ...}``.  Rows are taken by
    load number, so any order of arrival, repeated ids and a clock before that of
    an earlier run give what one run over everything gives.  Plain DataFrames
    have no load numbers and are read by ingestion time."""
    opts = opts or Options()
    b, s = layers.bronze, layers.silver
    create_tables(s, SILVER_TABLES)
    out: dict = {}

    source: dict = {name: b.loads(name) if name in LOGGED else b.read(name) for name in BRONZE_TABLES}
    source.update(bronze_inputs or {})
    bronze = {name: _rows(df) for name, df in source.items()}
    new_events, seen_events, upto = _increment(source["watch_events"], s, "watch_sessions", "watch_events",
                                               "event_id", opts)
    new_ratings, seen_ratings, upto_r = _increment(source["ratings_late"], s, "ratings", "ratings_late",
                                                   "rating_id", opts)

    # 1. quality gate over bronze (one pass per table, partial aggregates on
    # every task).  The checks of the event and rating tables look at single
    # rows, so a row is checked in the run that loads it; a failed run does not
    # move the position, so a bad row fails every run.
    def gated(name: str, part: DataFrame, moves: dict | None) -> DataFrame:
        return part if opts.gate == "increment" or opts.gate == "auto" and moves else bronze[name]

    out["dq"] = [r.asDict() for r in quality.assert_passed(quality.run_checks({
        "users": bronze["users"],
        "content_catalog": bronze["content_catalog"],
        "watch_events": gated("watch_events", seen_events, upto),
        "ratings_late": gated("ratings_late", seen_ratings, upto_r),
    }))]

    # 2. the dimensions and the two cleaned tables; the sessions need the catalog
    content, events = bronze["content_catalog"], bronze["watch_events"]

    def users() -> None:
        out["dim_user"] = _refresh_users(s, scd2.prepare_snapshot(bronze["users"]), as_of, opts)

    def devices() -> None:
        if s.is_empty("dim_device"):
            s.append("dim_device", dims.dim_device(events, as_of))
        elif opts.refresh_static_dims:
            s.append("dim_device", dims.dim_device(seen_events, as_of, existing=s.read("dim_device")))

    def days() -> None:
        # only events of the increment can bring a date the dimension lacks
        # (earlier ones were added by earlier runs)
        time_src = events if s.is_empty("dim_time") else seen_events
        s.append("dim_time", dims.dim_time_increment(time_src, s.read("dim_time"), as_of))

    def sessions() -> None:
        if s.is_empty("dim_content"):
            s.append("dim_content", dims.dim_content(content, as_of))
        elif opts.refresh_static_dims:
            s.append("dim_content", dims.dim_content_unseen(content, s.read("dim_content"), as_of))
        hot = heavy_keys(new_events, "content_id", opts.heavy_share) if opts.heavy_share else None
        made = enrich.build_watch_sessions(new_events, s.read("dim_content"), as_of, hot)
        out["watch_sessions"] = _append_sessions(s, "watch_sessions", made, upto,
                                                 [count_if(F.col("is_late_arrival")).alias("late")])

    def ratings() -> None:
        out["ratings"] = _append_sessions(s, "ratings", enrich.build_ratings(new_ratings, as_of), upto_r)

    _together(s.spark, users, devices, days, sessions, ratings)
    opts.stats["silver"] = out
    return out


def _bucketed(users: DataFrame) -> DataFrame:
    """With the bucket of a current version; ended ones have none (-1)."""
    own = F.pmod(F.xxhash64("user_id"), F.lit(USER_BUCKETS)).cast("int")
    return users.withColumn(BUCKET, F.when(F.col("effective_to").isNull(), own).otherwise(-1))


def _refresh_users(s: TableStore, snapshot: DataFrame, as_of: _dt.datetime, opts: Options):
    """Bring dim_user up to the snapshot: the first load, nothing, or the
    buckets of the users that changed.  History never changes.  The largest key
    ever handed out is always on a current row (a version is expired only
    together with the allocation of a larger key), so the current slice gives
    the key base."""
    if s.is_empty("dim_user"):
        s.append("dim_user", _bucketed(scd2.scd2_initial(snapshot, as_of)))
        return "initial"
    current = _current_users(s)
    work = scd2.scd2_work(current, snapshot, insert_new=opts.insert_new_users, null_safe=opts.null_safe_changes)
    stamped = _bucketed(work.withColumn("effective_to", F.lit(None).cast("date")))
    touched = [r[0] for r in stamped.select(BUCKET).distinct().collect()]  # at most USER_BUCKETS numbers
    if not touched:
        return "unchanged"  # the files stay as they are
    max_key = current.agg(F.max("user_key")).first()[0]
    whole = s.spark.table(s.name("dim_user"))
    slice_ = whole.filter(F.col("effective_to").isNull() & F.col(BUCKET).isin(touched))
    kept, expired, new = scd2.scd2_versions(slice_, work, as_of, int(max_key))
    # versions that an earlier run of the same day expired stay
    expired_today = whole.filter(F.col("effective_to") == F.lit(as_of.date())).select(*scd2.DIM_COLS)
    rows = kept.unionByName(expired).unionByName(new).unionByName(expired_today)
    return s.overwrite_partitions("dim_user", _bucketed(rows), reads_self=True, metrics=[row_count()])


def run_gold(layers: Layers, as_of: _dt.datetime, opts: Options | None = None) -> dict:
    """Silver -> gold, by load numbers throughout: the fact takes the silver
    loads it lacks, the tables by day recompute the days of the fact loads they
    lack.  A run that is cut off leaves the positions of what it did not finish."""
    opts = opts or Options()
    s, g = layers.silver, layers.gold
    create_tables(g, GOLD_TABLES)
    out: dict = {}
    dim_user_current = _current_users(s)

    sessions = s.loads("watch_sessions")
    after = None if g.is_empty("fact_watch_sessions") else g.ledger.position("fact_watch_sessions", "watch_sessions")
    if after is not None and after >= sessions.latest:
        out["fact"] = {"rows": 0}
    else:
        taken = sessions.since(after)
        hot = heavy_keys(taken, "user_id", opts.heavy_share) if opts.heavy_share else None
        new = fact_ops.build_fact(taken, dim_user_current, as_of, hot)
        out["fact"] = g.append("fact_watch_sessions", new, metrics=[row_count()], sole_writer=True,
                               upto={"watch_sessions": sessions.latest})
    fact = g.read("fact_watch_sessions")
    loads = g.loads("fact_watch_sessions")
    dim_content = s.read("dim_content")
    upto = {"fact_watch_sessions": loads.latest}

    def affected(table: str, whole: bool = False) -> list | None:
        """Event days with facts the table lacks; None for all days.  Each day
        depends on its own facts only, so both give the same rows."""
        position = g.ledger.position(table, "fact_watch_sessions")
        if whole or opts.daily_refresh == "full" or position is None or g.is_empty(table):
            return None
        new = loads.entries(position)
        return None if any(e["op"] != "append" for e in new) else days_of(new)

    def kpis() -> None:
        # one row per day: the table is small, so days are replaced by replacing it
        days = affected("daily_engagement")
        if days == []:
            out["daily_engagement"] = {"rows": 0}
            return
        if days is None:
            rows = engagement.daily_engagement(fact, as_of)
        else:
            rows = engagement.daily_engagement(fact.filter(among(F.col("event_date"), days)), as_of).unionByName(
                g.read("daily_engagement").filter(~F.coalesce(among(F.col("date"), days), F.lit(False))))
        out["daily_engagement"] = g.replace_all("daily_engagement", rows, reads_self=True, metrics=[row_count()],
                                                upto=upto, sole_writer=True)

    def churn() -> None:
        # the per user-day roll-up; a refreshed catalog can change the genre of
        # old facts, so that mode rebuilds it whole
        days = affected("daily_user_base", whole=opts.refresh_static_dims)
        if days == []:
            out["daily_user_base"] = {"rows": 0}
        elif days is None:
            out["daily_user_base"] = g.replace_all("daily_user_base", features.daily_user_base(fact, dim_content),
                                                   metrics=[row_count()], upto=upto, sole_writer=True)
        else:
            some = features.daily_user_base(fact.filter(among(F.col("event_date"), days)), dim_content)
            out["daily_user_base"] = g.overwrite_partitions("daily_user_base", some, metrics=[row_count()],
                                                            upto=upto, sole_writer=True)
        # rolling sums do not depend on the user's attributes: new facts change
        # those of their own days and of the 30 after, the rest stays as it is
        base = g.read("daily_user_base")
        days = affected("daily_user_rolled", whole=opts.refresh_static_dims)
        if days == []:
            out["daily_user_rolled"] = {"rows": 0}
        elif days is None:
            out["daily_user_rolled"] = g.replace_all("daily_user_rolled", features.with_rolling(base),
                                                     metrics=[row_count()], upto=upto, sole_writer=True)
        else:
            some = features.rolled_of_days(base, features.days_reached(days))
            out["daily_user_rolled"] = g.overwrite_partitions("daily_user_rolled", some, metrics=[row_count()],
                                                              upto=upto, sole_writer=True)
        # current attributes hold for all history and every row carries the
        # stamp of the run: replaced whole, by one join without a window
        rows = features.churn_features_from_rolled(g.read("daily_user_rolled"), dim_user_current, as_of)
        out["churn_features"] = g.replace_all("churn_features", rows, metrics=[row_count()])

    _together(g.spark, kpis, churn)
    opts.stats["gold"] = out
    return out


def run_all(layers: Layers, as_of: _dt.datetime, opts: Options | None = None,
            bronze_inputs: dict[str, DataFrame | Loads] | None = None) -> dict:
    """Silver then gold, as the scheduled refresh does."""
    opts = opts or Options()
    return {"silver": run_silver(layers, as_of, opts, bronze_inputs), "gold": run_gold(layers, as_of, opts)}
