import datetime as dt
import re
import uuid

from pyspark.sql import functions as F

from reelstar.operators import dims, engagement, enrich, fact as fact_ops, features, scd2
from reelstar.plans import layers as L
from reelstar.session import work_dir
from reelstar.sources.fixtures import bind

DAY1, DAY2 = dt.datetime(2024, 2, 4), dt.datetime(2024, 2, 5)


def _counts(layers):
    out = {}
    for store, tables in ((layers.silver, L.SILVER_TABLES), (layers.gold, L.GOLD_TABLES)):
        for name in tables:
            out[name] = store.read(name).count()
    return out


def test_rerun_without_new_data_adds_nothing(spark, sf_dir):
    b = bind(spark, sf_dir)
    layers = L.Layers.under(spark, work_dir(spark, "t-rerun"), prefix=f"rsr{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": b.watch_events, "ratings_late": b.ratings_late})
    L.run_all(layers, DAY1)
    first = _counts(layers)
    assert first["fact_watch_sessions"] == b.watch_events.count()
    # the seed is idempotent and a second refresh finds nothing new
    assert L.seed_bronze(layers, {"users": b.users}) == {"users": False}
    stats = L.run_all(layers, DAY2)
    assert stats["silver"]["watch_sessions"]["rows"] == 0
    assert stats["gold"]["fact"]["rows"] == 0
    assert _counts(layers) == first
    current = layers.silver.read("dim_user").filter("is_current")
    assert current.count() == current.select("user_id").distinct().count()


def _hot_events(b):
    """A third of all events moved onto one user (a hot key)."""
    ev = b.watch_events
    return ev.withColumn("user_id", F.when(F.col("event_id").cast("long") % 3 == 0, F.lit("user_1"))
                         .otherwise(F.col("user_id")))


def _shuffles_without_partial_aggregate(df):
    """Hash exchanges whose child is not a (partial) aggregate."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("Exchange hashpartitioning" in line for line in lines), "plan has no shuffle to check"
    bad = []
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line and i + 1 < len(lines):
            child = lines[i + 1]
            if not re.search(r"(Hash|Sort|ObjectHash)Aggregate", child):
                bad.append(line.strip())
    return bad


def test_hot_user_is_pre_aggregated_and_exact(spark, sf_dir):
    b = bind(spark, sf_dir)
    events = _hot_events(b)
    content = dims.dim_content(b.content_catalog, DAY2)
    users = scd2.current_rows(scd2.scd2_initial(scd2.prepare_snapshot(b.users), DAY1))
    fact = fact_ops.build_fact(enrich.build_watch_sessions(events, content, DAY2), users, DAY2)

    daily = engagement.daily_engagement(fact, DAY2)
    modes = features.preferred_device(fact)
    # every shuffle of fact-derived rows carries partially aggregated rows,
    # so the hot user reaches each exchange as one row per task and key
    assert _shuffles_without_partial_aggregate(daily) == []
    assert _shuffles_without_partial_aggregate(modes) == []

    # exact against a brute-force count on the driver (small fixture)
    pdf = events.select("user_id", F.to_date("event_time").alias("d"), "session_id").toPandas()
    per_day = pdf.groupby("d").agg(users=("user_id", "nunique"), sessions=("session_id", "count"))
    got = {r["date"]: (r["total_users"], r["total_sessions"]) for r in daily.collect()}
    assert got == {d: (int(r.users), int(r.sessions)) for d, r in per_day.iterrows()}

    churn = features.churn_features(fact, users, content, DAY2).filter(F.col("user_id") == "user_1")
    hot = pdf[pdf.user_id == "user_1"]
    assert churn.count() == hot["d"].nunique()
    assert churn.agg(F.sum("sessions_count")).first()[0] == len(hot)


def test_building_a_plan_runs_no_job(spark):
    from reelstar.operators import enrich, fact
    from reelstar.sources.fixtures import bind

    b = bind(spark, "/root/testdata/sf0.001")
    users = b.users.select("user_id", F.lit(1).cast("long").alias("user_key")).withColumn("is_current", F.lit(True))
    content, events = b.content_catalog, b.watch_events  # reading the schemas of the files may run a job
    spark.sparkContext.setJobGroup("plan-only", "no job")
    try:
        fact.build_fact(enrich.build_watch_sessions(events, content, DAY2), users, DAY2)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
