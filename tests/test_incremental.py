import datetime as dt

from pyspark.sql import functions as F

from reelstar.operators import dims, enrich, incremental
from reelstar.sources.fixtures import bind

AS_OF = dt.datetime(2024, 2, 5)


def test_strict_hwm_and_overlap(spark, sf_dir):
    b = bind(spark, sf_dir)
    ev = b.watch_events
    cut = dt.datetime(2024, 1, 10)
    target = enrich.build_watch_sessions(ev.filter(F.col("ingestion_time") < F.lit(cut)),
                                         dims.dim_content(b.content_catalog, AS_OF), AS_OF).checkpoint()
    hwm = incremental.high_water_mark(target)
    new = incremental.incremental(ev, hwm, "ingestion_time")
    assert new.count() + target.count() == ev.count()
    # a row that committed behind the mark: removed from the target, found again with an overlap
    # (the 5th newest row: strictly behind the mark that the others set)
    late = target.orderBy(F.col("source_ingestion_time").desc()).take(5)[-1]
    late_key = late["event_id"]
    target2 = target.filter(F.col("event_id") != late_key)
    hwm2 = incremental.high_water_mark(target2)
    strict = incremental.incremental(ev, hwm2, "ingestion_time")
    assert strict.filter(F.col("event_id") == late_key).count() == 0
    ov = incremental.incremental(ev, hwm2, "ingestion_time", overlap=hwm2 - late["source_ingestion_time"] + dt.timedelta(seconds=1),
                                 target=target2, key="event_id")
    assert ov.filter(F.col("event_id") == late_key).count() == 1
    assert ov.count() + target2.count() == ev.count()


def test_sliced_build_equals_one_shot(spark, sf_dir):
    b = bind(spark, sf_dir)
    ev, content = b.watch_events, dims.dim_content(b.content_catalog, AS_OF)
    cuts = [dt.datetime(2024, 1, d) for d in (5, 12, 19, 26)] + [dt.datetime(2100, 1, 1)]
    target = None
    for c in cuts:
        hwm = incremental.high_water_mark(target) if target is not None else None
        src = ev.filter(F.col("ingestion_time") < F.lit(c))
        new = enrich.build_watch_sessions(incremental.incremental(src, hwm, "ingestion_time"), content, AS_OF)
        target = new if target is None else target.unionByName(new)
        target = target.checkpoint()
    one = enrich.build_watch_sessions(ev, content, AS_OF)
    assert sorted(map(tuple, target.collect())) == sorted(map(tuple, one.collect()))


def test_sliced_pipeline_gold_equals_one_shot(spark, sf_dir):
    """Gold refreshed over several event slices (affected-day overwrite of the
    KPI table and the user-day roll-up, churn rebuilt from the roll-up) equals
    the one-shot computation over the final fact."""
    import uuid

    from reelstar.operators import engagement, features, scd2
    from reelstar.plans import layers as L
    from reelstar.session import work_dir

    b = bind(spark, sf_dir)
    layers = L.Layers.under(spark, work_dir(spark, "t-sliced"), prefix=f"rss{uuid.uuid4().hex[:8]}")
    cuts = [dt.datetime(2024, 1, d) for d in (8, 15, 22)] + [dt.datetime(2100, 1, 1)]
    prev = None
    for i, c in enumerate(cuts):
        in_slice = F.col("ingestion_time") < F.lit(c)
        if prev is not None:
            in_slice = in_slice & (F.col("ingestion_time") >= F.lit(prev))
        if prev is None:
            L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                                   "watch_events": b.watch_events.filter(in_slice),
                                   "ratings_late": b.ratings_late.filter(in_slice)})
        else:
            layers.bronze.append("watch_events", b.watch_events.filter(in_slice))
            layers.bronze.append("ratings_late", b.ratings_late.filter(in_slice))
        L.run_all(layers, dt.datetime(2024, 2, 1 + i))
        prev = c

    g, s = layers.gold, layers.silver
    fact = g.read("fact_watch_sessions")
    assert fact.count() == b.watch_events.count()
    users = scd2.current_rows(s.read("dim_user"))
    content = s.read("dim_content")

    def rows(df, drop=()):
        cols = sorted(c for c in df.columns if c not in drop)
        return sorted(map(tuple, df.select(*cols).collect()), key=repr)

    assert rows(g.read("daily_user_base")) == rows(features.daily_user_base(fact, content))
    assert rows(g.read("daily_engagement"), ["ingestion_time"]) == \
        rows(engagement.daily_engagement(fact, AS_OF), ["ingestion_time"])
    # dim_time grew from the increments only and still holds every event day once
    days = s.read("dim_time").select("date_key")
    assert days.count() == days.distinct().count() == \
        b.watch_events.select(F.to_date("event_time")).distinct().count()
    assert rows(g.read("churn_features"), ["ingestion_time"]) == \
        rows(features.churn_features(fact, users, content, AS_OF), ["ingestion_time"])


def test_overlap_pipeline_picks_up_rows_committed_behind_the_mark(spark, sf_dir):
    """Rows stamped before a slice's end but committed with the next slice are
    lost by the strict mark and found with an overlap; gold (fact, KPI days,
    user-day roll-up) then equals the one-shot build."""
    import uuid

    from reelstar.operators import engagement, features
    from reelstar.plans import layers as L
    from reelstar.session import work_dir

    b = bind(spark, sf_dir)
    ev = b.watch_events
    cuts = [dt.datetime(2024, 1, d) for d in (10, 20)] + [dt.datetime(2100, 1, 1)]

    def held_back(c):  # stamped in the last 6 h before the cut, committed late
        return (F.col("event_id").cast("long") % 7 == 0) & (F.col("ingestion_time") >= F.lit(c - dt.timedelta(hours=6)))

    def run(opts):
        layers = L.Layers.under(spark, work_dir(spark, "t-overlap"), prefix=f"rso{uuid.uuid4().hex[:8]}")
        prev = None
        for i, c in enumerate(cuts):
            part = F.col("ingestion_time") < F.lit(c)
            if prev is not None:
                part = (part & (F.col("ingestion_time") >= F.lit(prev))) | \
                    ((F.col("ingestion_time") < F.lit(prev)) & held_back(prev))
            if i < len(cuts) - 1:
                part = part & ~(held_back(c) & (F.col("ingestion_time") < F.lit(c)))
            if prev is None:
                L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                                       "watch_events": ev.filter(part), "ratings_late": b.ratings_late.limit(0)})
            else:
                layers.bronze.append("watch_events", ev.filter(part))
            L.run_all(layers, dt.datetime(2024, 2, 1 + i), opts)
            prev = c
        return layers

    strict = run(L.Options(increments="time"))
    assert strict.gold.read("fact_watch_sessions").count() < ev.count()  # the defect the overlap fixes

    layers = run(L.Options(increments="time", hwm_overlap=dt.timedelta(hours=12)))
    g, s = layers.gold, layers.silver
    fact = g.read("fact_watch_sessions")
    assert fact.count() == ev.count() == fact.select("session_id").distinct().count()
    # load numbers find them without an overlap
    assert run(L.Options()).gold.read("fact_watch_sessions").count() == ev.count()
    content = s.read("dim_content")

    def rows(df, drop=()):
        cols = sorted(c for c in df.columns if c not in drop)
        return sorted(map(tuple, df.select(*cols).collect()), key=repr)

    assert rows(g.read("daily_user_base")) == rows(features.daily_user_base(fact, content))
    assert rows(g.read("daily_engagement"), ["ingestion_time"]) == \
        rows(engagement.daily_engagement(fact, AS_OF), ["ingestion_time"])


def test_undated_facts_arriving_later_refresh_their_kpi_group(spark, sf_dir):
    """Events whose event time did not parse (NULL) form their own KPI day;
    when more of them arrive, the affected-day refresh updates that group."""
    import uuid

    from reelstar.operators import engagement, features
    from reelstar.plans import layers as L
    from reelstar.session import work_dir

    b = bind(spark, sf_dir)
    undated = F.col("event_id").cast("long") % 5 == 0
    ev = b.watch_events.withColumn("event_time", F.when(undated, F.lit(None)).otherwise(F.col("event_time")))
    cut = dt.datetime(2024, 1, 15)
    layers = L.Layers.under(spark, work_dir(spark, "t-undated"), prefix=f"rsu{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": ev.filter(F.col("ingestion_time") < F.lit(cut)),
                           "ratings_late": b.ratings_late.limit(0)})
    L.run_all(layers, dt.datetime(2024, 2, 4))
    layers.bronze.append("watch_events", ev.filter(F.col("ingestion_time") >= F.lit(cut)))
    L.run_all(layers, dt.datetime(2024, 2, 5))

    g = layers.gold
    fact = g.read("fact_watch_sessions")
    assert fact.filter(F.col("event_date").isNull()).count() == ev.filter(undated).count() > 0

    def rows(df, drop=()):
        cols = sorted(c for c in df.columns if c not in drop)
        return sorted(map(tuple, df.select(*cols).collect()), key=repr)

    assert rows(g.read("daily_engagement"), ["ingestion_time"]) == \
        rows(engagement.daily_engagement(fact, AS_OF), ["ingestion_time"])
    assert rows(g.read("daily_user_base")) == rows(features.daily_user_base(fact, layers.silver.read("dim_content")))
