"""Rolling sums recomputed only where new facts reach."""

import datetime as dt
import uuid

from pyspark.sql import functions as F

from reelstar.operators import features, scd2
from reelstar.plans import layers as L
from reelstar.session import work_dir
from reelstar.sources.fixtures import bind

AS_OF = dt.datetime(2024, 2, 5)


def test_days_reached_and_seen():
    d = dt.date(2024, 1, 31)
    assert features.days_reached([d]) == [d + dt.timedelta(days=k) for k in range(31)]
    assert features.days_seen([d]) == [d - dt.timedelta(days=k) for k in range(30, -1, -1)]
    assert features.days_reached([d, None, d])[:2] == [None, d] and len(features.days_reached([d, None])) == 32
    assert features.days_reached([]) == features.days_seen([]) == []
    assert features.days_reached([None]) == [None]


def _rows(df, drop=("ingestion_time",)):
    cols = sorted(c for c in df.columns if c not in drop)
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def _base(spark, rows):
    """(user, day, sessions, hours) as a user-day roll-up."""
    df = spark.createDataFrame([(u, None if d is None else dt.date(2024, 1, 1) + dt.timedelta(days=d), n, h)
                                for u, d, n, h in rows],
                               "user_id string, date date, sessions_count long, total_watch_hours double")
    return df


def test_rolled_days_equal_the_whole_and_the_edges_of_the_frames(spark):
    rows = [(u, d, 1 + (d * 7 + k) % 5, round(0.001 * ((d * 13 + k) % 999), 3))
            for k, u in enumerate(("a", "b", None)) for d in range(0, 120, k + 1)]
    rows += [("a", None, 4, 0.5), ("b", None, None, None)]
    base = _base(spark, rows)
    whole = {(r.user_id, r.date): r for r in features.with_rolling(base).collect()}
    for late in ([dt.date(2024, 2, 10)], [dt.date(2024, 1, 1), None], [dt.date(2024, 4, 29), dt.date(2024, 2, 1)]):
        days = features.days_reached(late)
        got = features.rolled_of_days(base, days).collect()
        assert {(r.user_id, r.date): r for r in got} == {k: r for k, r in whole.items() if k[1] in days}
    # without the new day, rows beyond its reach have the same sums, the last one in reach has not
    late = dt.date(2024, 2, 10)
    before = {(r.user_id, r.date): r for r in features.with_rolling(base.filter(F.col("date") != F.lit(late))).collect()}
    changed = {k[1] for k, r in before.items() if k[0] == "a" and r != whole[k]}
    assert changed <= set(features.days_reached([late])) and max(changed) == late + dt.timedelta(days=30)
    assert features.rolled_of_days(base.limit(0), days).count() == 0


def test_a_late_event_rewrites_its_reach_only(spark, sf_dir):
    b = bind(spark, sf_dir)
    ev = b.watch_events
    third = F.col("event_id").cast("long") % 3
    # a history of half a year: two thirds of the events lie 60 and 150 days later
    ev = ev.withColumn("event_time", F.col("event_time") + F.when(third == 1, F.expr("INTERVAL 60 DAYS")).when(
        third == 2, F.expr("INTERVAL 150 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS")))
    dated = ev.filter(F.col("event_time").isNotNull())
    late_id = dated.filter(third == 0).orderBy("event_time", "event_id").first()["event_id"]
    layers = L.Layers.under(spark, work_dir(spark, "t-reach"), prefix=f"rsr{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": ev.filter(F.col("event_id") != late_id),
                           "ratings_late": b.ratings_late.limit(0)})
    L.run_all(layers, AS_OF)
    g = layers.gold
    table = lambda: g.read("daily_user_rolled")
    files = lambda: {r.f: r.date for r in table().select(
        F.input_file_name().alias("f"), "date").distinct().collect()}
    old, total = files(), table().count()
    layers.bronze.append("watch_events", ev.filter(F.col("event_id") == late_id))
    out = L.run_all(layers, AS_OF + dt.timedelta(days=1))
    day = ev.filter(F.col("event_id") == late_id).select(F.to_date("event_time")).first()[0]
    reach = set(features.days_reached([day]))
    new = files()
    assert {d for f, d in new.items() if f not in old} <= reach
    assert {d for f, d in old.items() if f not in new} <= reach  # all other files are those of before
    assert 0 < out["gold"]["daily_user_rolled"]["rows"] < total / 2
    fact, users = g.read("fact_watch_sessions"), scd2.current_rows(layers.silver.read("dim_user"))
    want = features.churn_features(fact, users, layers.silver.read("dim_content"), AS_OF)
    assert _rows(g.read("churn_features")) == _rows(want)
    assert _rows(table(), ()) == _rows(features.with_rolling(g.read("daily_user_base")), ())
    # every row of the churn table carries the stamp of the last run
    stamps = [r[0] for r in g.read("churn_features").select("ingestion_time").distinct().collect()]
    assert stamps == [AS_OF + dt.timedelta(days=1)]
    # nothing new: nothing of the roll-ups is written
    assert L.run_gold(layers, AS_OF + dt.timedelta(days=2))["daily_user_rolled"] == {"rows": 0}


def test_a_cut_off_refresh_is_made_up_for(spark, sf_dir, monkeypatch):
    """The roll-up written, its rolling sums not: the next run still knows the days."""
    b = bind(spark, sf_dir)
    ev = b.watch_events
    late = F.col("event_id").cast("long") % 10 == 0
    layers = L.Layers.under(spark, work_dir(spark, "t-cut"), prefix=f"rsc{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog, "watch_events": ev.filter(~late),
                           "ratings_late": b.ratings_late.limit(0)})
    L.run_all(layers, AS_OF)
    layers.bronze.append("watch_events", ev.filter(late))

    def fails(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(features, "rolled_of_days", fails)
        try:
            L.run_all(layers, AS_OF)
        except RuntimeError as e:
            assert str(e) == "lost"
        else:
            raise AssertionError("the refresh was to fail")
    L.run_gold(layers, AS_OF)
    g = layers.gold
    want = features.churn_features(g.read("fact_watch_sessions"), scd2.current_rows(layers.silver.read("dim_user")),
                                   layers.silver.read("dim_content"), AS_OF)
    assert _rows(g.read("churn_features")) == _rows(want)
