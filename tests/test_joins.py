"""Lookups of keys that hold a large share of the rows."""

from pyspark.sql import functions as F

from reelstar.operators.joins import heavy_keys, salted_lookup


def skewed(spark, n=60_000):
    """A third of the rows on one key, a sixth without a key."""
    k = F.col("id")
    key = F.when(k % 3 == 0, "hot").when(k % 6 == 1, F.lit(None)).otherwise(F.concat(F.lit("u"), (k % 5000).cast("string")))
    return spark.range(0, n, 1, 8).select(k.cast("string").alias("event_id"), key.alias("user"))


def test_heavy_keys_are_found(spark):
    rows = skewed(spark)
    assert heavy_keys(rows, "user", 0.05) == ["hot"]
    assert heavy_keys(rows.limit(0), "user") == [] and heavy_keys(rows.select(F.lit(None).cast("string").alias("user")), "user") == []


def test_salted_lookup_equals_the_plain_join_and_spreads_the_hot_key(spark):
    rows = skewed(spark)
    side = spark.range(4000).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id").cast("string")))
                                    .alias("user"), F.col("id").alias("v"))
    side = side.unionByName(side.filter("user IN ('hot', 'u7')").withColumn("v", F.lit(-1).cast("long")))  # repeated keys
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        salted = salted_lookup(rows, side, "user", ["hot"], "event_id")
        plain = rows.join(side, "user", "left")

        def sizes(df):
            found = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
            return sorted(r["count"] for r in found)

        got = sizes(salted)
        assert got[-1] <= 2 * got[len(got) // 2] < sizes(plain)[-1]
        cols = ["event_id", "user", "v"]
        assert sorted(map(tuple, salted.select(cols).collect()), key=repr) == \
            sorted(map(tuple, plain.select(cols).collect()), key=repr)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_refresh_with_measured_hot_keys_gives_the_same_rows(spark, sf_dir):
    import datetime as dt
    import uuid

    from reelstar.plans import layers as L
    from reelstar.session import work_dir
    from reelstar.sources.fixtures import bind

    b = bind(spark, sf_dir)
    hot = F.col("event_id").cast("long") % 3 == 0
    events = b.watch_events.withColumn("user_id", F.when(hot, "user_1").otherwise(F.col("user_id"))) \
        .withColumn("content_id", F.when(hot, "content_1").otherwise(F.col("content_id")))
    facts = []
    for share in (None, 0.1):
        layers = L.Layers.under(spark, work_dir(spark, "t-hot"), prefix=f"rsh{uuid.uuid4().hex[:8]}")
        L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog, "watch_events": events,
                               "ratings_late": b.ratings_late.limit(0)})
        L.run_silver(layers, dt.datetime(2024, 2, 5), L.Options(heavy_share=share))
        L.run_gold(layers, dt.datetime(2024, 2, 5), L.Options(heavy_share=share))
        facts.append(sorted(map(tuple, layers.gold.read("fact_watch_sessions").collect()), key=repr))
    assert facts[0] == facts[1] and len(facts[0]) == events.count()
