import uuid

from pyspark.sql import functions as F

from reelstar.schemas import CONNECTIVITY_TEST, DAILY_ENGAGEMENT
from reelstar.session import work_dir
from reelstar.sources.tables import TableStore, row_count


def _store(spark):
    s = TableStore(spark, f"rs_t_{uuid.uuid4().hex[:8]}", work_dir(spark, "t-store"))
    s.create_namespace()
    return s


def test_ddl_and_insert_values(spark):
    s = _store(spark)
    s.create("connectivity_test", CONNECTIVITY_TEST)
    s.create("connectivity_test", CONNECTIVITY_TEST)  # IF NOT EXISTS
    s.insert_values("connectivity_test", [
        "(1, 'Spark works', TIMESTAMP_NTZ'2024-02-05 00:00:00')",
        "(2, 'storage works', TIMESTAMP_NTZ'2024-02-05 00:00:00')"])
    assert s.read("connectivity_test").count() == 2


def test_insert_select_aligns_columns_by_name(spark):
    s = _store(spark)
    s.create("connectivity_test", CONNECTIVITY_TEST)
    # columns in a different order than the table: the load selects by name
    df = spark.range(3).select(F.lit(None).cast("timestamp_ntz").alias("ts"),
                               F.concat(F.lit("m"), F.col("id").cast("string")).alias("message"), "id")
    s.insert_select("connectivity_test", df)
    got = sorted((r.id, r.message) for r in s.read("connectivity_test").collect())
    assert got == [(0, "m0"), (1, "m1"), (2, "m2")]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("_load_")]


def test_append_if_empty_and_replace(spark):
    s = _store(spark)
    s.create("t", CONNECTIVITY_TEST)
    df = spark.range(5).select(F.col("id"), F.lit("m").alias("message"),
                               F.lit(None).cast("timestamp_ntz").alias("ts"))
    assert s.append_if_empty("t", df) is True
    assert s.append_if_empty("t", df) is False
    assert s.read("t").count() == 5
    m = s.replace_all("t", s.read("t").filter("id < 2"), reads_self=True, metrics=[row_count()])
    assert m["rows"] == 2 and s.read("t").count() == 2
    m = s.append("t", df, metrics=[row_count()])
    assert m["rows"] == 5 and s.read("t").count() == 7


def test_schema_columns_follow_ddl(spark):
    s = _store(spark)
    s.create("daily", DAILY_ENGAGEMENT)
    assert s.read("daily").columns == [f.name for f in DAILY_ENGAGEMENT.fields]


def test_apply_defaults_keeps_explicit_settings(spark):
    from reelstar.session import apply_defaults

    before = spark.conf.get("spark.sql.shuffle.partitions")
    applied = apply_defaults(spark, {"spark.sql.shuffle.partitions": "8000",
                                     "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m"})
    # the test session set shuffle partitions explicitly: kept
    assert "spark.sql.shuffle.partitions" not in applied
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert applied == {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m"}
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_overwrite_modes_do_not_depend_on_the_session_setting(spark):
    from pyspark.sql import types as T

    s = _store(spark)
    schema = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("p", T.IntegerType())])
    s.create("t", schema, ("p",))
    rows = lambda *r: spark.createDataFrame(list(r), schema)
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "dynamic")
        s.append("t", rows((1, 1), (2, 2)))
        s.replace_all("t", rows((3, 3)))           # whole table, even under a dynamic session
        assert sorted(map(tuple, s.read("t").collect())) == [(3, 3)]
        spark.conf.set(key, "static")
        s.append("t", rows((4, 4)))
        s.overwrite_partitions("t", rows((30, 3)))  # only p=3, even under a static session
        assert sorted(map(tuple, s.read("t").collect())) == [(4, 4), (30, 3)]
        assert spark.conf.get(key) == "static"
    finally:
        spark.conf.set(key, before)


def test_watermarks_keep_one_row_per_table(spark):
    import datetime as dt

    s = _store(spark)
    t0 = dt.datetime(2024, 1, 1)
    for d in (3, 1, 5, 5):  # an older mark never replaces a newer one
        s.record_watermark("a", t0 + dt.timedelta(days=d))
    s.record_watermark("b", t0)
    assert s.watermark("a") == t0 + dt.timedelta(days=5)
    assert s.watermark("b") == t0 and s.watermark("c") is None
    assert s.read(s.WATERMARKS).count() == 2
