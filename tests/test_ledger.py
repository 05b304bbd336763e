"""Load numbers, pointer swaps, buckets and declared constraints."""

import datetime as dt
import threading
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelstar.operators import engagement
from reelstar.plans import layers as L
from reelstar.session import work_dir
from reelstar.sources import ledger as ledger_mod
from reelstar.sources.fixtures import bind
from reelstar.sources.ledger import Ledger
from reelstar.sources.tables import BUCKET, TableStore

DAY1, DAY2 = dt.datetime(2024, 2, 4), dt.datetime(2024, 2, 5)
NUMBERS = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("d", T.DateType())])


def store(spark):
    s = TableStore(spark, f"rs_l{uuid.uuid4().hex[:8]}", work_dir(spark, "t-ledger"))
    s.create_namespace()
    return s


def numbers(spark, *n, day="2024-01-01"):
    return spark.createDataFrame([(k, dt.date.fromisoformat(day) if day else None) for k in n], NUMBERS)


def values(df):
    return sorted(r.n for r in df.collect())


def test_a_reader_does_not_pass_an_open_load(spark, monkeypatch):
    led = Ledger(spark, work_dir(spark, "t-led"))
    a, b = led.begin("t"), led.begin("t")
    assert (a, b) == (1, 2)
    led.commit("t", b, {"rows": 1, "upto": {"src": 7}})
    assert led.settled_loads("t") == (0, []) and led.loads("t") == ([2], [1])
    led.commit("t", a, {"rows": 1})
    assert led.settled_loads("t") == (2, [])
    assert led.position("t", "src") == 7 and led.position("t", "other") is None
    c = led.begin("t")
    d = led.begin("t", sole_writer=True)  # nobody else writes: c is dead
    with pytest.raises(OSError):
        led.commit("t", c, {"rows": 1})
    led.commit("t", d, {"rows": 1, "op": "replace"})
    assert led.settled_loads("t") == (4, [3]) and led.last("t")["upto"] == {"src": 7}
    with pytest.raises(FileExistsError):
        led.commit("t", d, {"rows": 1})
    led.begin("t")
    assert led.settled_loads("t") == (4, [3])
    monkeypatch.setattr(ledger_mod, "ABANDONED_S", -1)
    assert led.settled_loads("t") == (5, [3, 5])


def test_increments_are_ranges_of_loads(spark):
    s = store(spark)
    s.create("t", NUMBERS, ("d",), logged=True)
    for n in (1, 2, 2, 3):
        s.append("t", numbers(spark, n, day=f"2024-01-0{n}"))
    s.append("t", numbers(spark, 9, day=None))
    src = s.loads("t")
    assert src.latest == 5 and s.read("t").columns == ["n", "d"]
    assert values(src.since(None)) == [1, 2, 2, 3, 9] and values(src.since(2)) == [2, 3, 9] and values(src.since(5)) == []
    part = src.since(3)
    assert values(part) == [3, 9] and len(part.inputFiles()) == 2  # only the days these loads wrote to
    s.replace_all("t", numbers(spark, 5, 6))
    s.append("t", numbers(spark, 7))
    assert values(s.loads("t").since(5)) == [7]  # what a replace wrote was there before
    assert values(s.loads("t").since(None)) == [5, 6, 7] == values(s.read("t"))


def test_rows_of_a_load_that_died_are_not_read(spark, monkeypatch):
    s = store(spark)
    s.create("t", NUMBERS, logged=True)
    s.append("t", numbers(spark, 1))
    with monkeypatch.context() as m:
        def lost(*_):
            raise RuntimeError("driver lost")
        m.setattr(Ledger, "commit", lost)
        with pytest.raises(RuntimeError):
            s.append("t", numbers(spark, 2))
    assert spark.table(s.name("t")).count() == 2
    assert values(s.read("t")) == [1]
    s.append("t", numbers(spark, 2), sole_writer=True)
    assert values(s.read("t")) == [1, 2] == values(s.loads("t").whole())


def test_refresh_that_dies_after_a_write_loads_once(spark, sf_dir, monkeypatch):
    b = bind(spark, sf_dir)
    layers = L.Layers.under(spark, work_dir(spark, "t-dies"), prefix=f"rsd{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": b.watch_events, "ratings_late": b.ratings_late.limit(0)})
    commit = Ledger.commit
    for table in ("watch_sessions", "fact_watch_sessions", "daily_user_base"):
        with monkeypatch.context() as m:
            def lost(self, name, *rest, table=table):
                if name == table:
                    raise RuntimeError("driver lost")
                commit(self, name, *rest)
            m.setattr(Ledger, "commit", lost)
            with pytest.raises(RuntimeError):
                L.run_all(layers, DAY1)
    L.run_all(layers, DAY1)
    g, fact = layers.gold, layers.gold.read("fact_watch_sessions")
    assert layers.silver.read("watch_sessions").count() == fact.count() == b.watch_events.count()
    assert g.read("daily_engagement").agg(F.sum("total_sessions")).first()[0] == fact.count()
    assert g.read("daily_user_base").agg(F.sum("sessions_count")).first()[0] == fact.count()
    want = engagement.daily_engagement(fact, DAY1)
    assert sorted(map(tuple, g.read("daily_engagement").collect())) == sorted(map(tuple, want.collect()))


def test_a_reader_during_replaces_sees_old_or_new_rows(spark):
    s = store(spark)
    s.create("t", NUMBERS)
    s.replace_all("t", numbers(spark, *range(10)))
    seen, stop, wrong = set(), threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                seen.add(s.read("t").count())
            except Exception as e:
                wrong.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(4):
            s.replace_all("t", numbers(spark, *range(20 if k % 2 == 0 else 10)))
    finally:
        stop.set()
        reader.join()
    assert not wrong and seen <= {10, 20}
    before = s.read("t")
    s.replace_all("t", before.filter("n < 3"))  # reads itself
    assert values(before) == list(range(10)) and values(s.read("t")) == [0, 1, 2]


def test_a_replace_that_dies_before_the_swap_changes_nothing(spark, monkeypatch):
    s = store(spark)
    s.create("t", NUMBERS, ("d",))
    s.append("t", numbers(spark, 1).unionByName(numbers(spark, 2, day="2024-01-02")).unionByName(numbers(spark, 3, day=None)))
    with monkeypatch.context() as m:
        def lost(*_):
            raise RuntimeError("driver lost")
        m.setattr(TableStore, "_location", lost)
        for write in (s.replace_all, s.overwrite_partitions):
            with pytest.raises(RuntimeError):
                write("t", numbers(spark, 8))
    assert values(s.read("t")) == [1, 2, 3]
    s.overwrite_partitions("t", numbers(spark, 20, day="2024-01-02").unionByName(numbers(spark, 30, 31, day=None)).unionByName(
        numbers(spark, 40, day="2024-01-04")))
    assert values(s.read("t")) == [1, 20, 30, 31, 40]
    s.append("t", numbers(spark, 21, day="2024-01-02"))
    assert values(s.read("t").filter("d = DATE'2024-01-02'")) == [20, 21]
    s.replace_all("t", s.read("t").filter("n > 25"))
    assert values(s.read("t")) == [30, 31, 40] and values(s.read("t").filter("d = DATE'2024-01-01'")) == []
    s.replace_all("t", s.read("t").filter("false"))
    assert s.is_empty("t")


def test_one_changed_user_rewrites_one_bucket(spark, sf_dir):
    b = bind(spark, sf_dir)
    layers = L.Layers.under(spark, work_dir(spark, "t-bucket"), prefix=f"rsb{uuid.uuid4().hex[:8]}")
    L.seed_bronze(layers, {"users": b.users, "content_catalog": b.content_catalog,
                           "watch_events": b.watch_events.limit(20), "ratings_late": b.ratings_late.limit(0)})
    L.run_silver(layers, DAY1)
    s = layers.silver

    def files():
        rows = spark.table(s.name("dim_user")).filter("effective_to IS NULL")
        return {k: sorted(rows.filter(F.col(BUCKET) == k).inputFiles()) for k in range(L.USER_BUCKETS)}

    before, user = files(), s.read("dim_user").first()["user_id"]
    changed = F.when(F.col("user_id") == user, "XX").otherwise(F.col("country"))
    layers.bronze.replace_all("users", b.users.withColumn("country", changed))
    L.run_silver(layers, DAY2)
    after = files()
    assert sum(before[k] != after[k] for k in before) == 1
    mine = s.read("dim_user").filter(F.col("user_id") == user).orderBy("user_key").collect()
    assert [r.is_current for r in mine] == [False, True] and mine[1].country == "XX"
    assert mine[1].user_key == s.read("dim_user").agg(F.max("user_key")).first()[0] == b.users.count() + 1


def test_declared_not_null_columns_fail_the_write(spark):
    s = store(spark)
    s.create("t", NUMBERS, logged=True)
    loose = spark.createDataFrame([(1, None), (None, None)], "n long, d date")
    again = TableStore(spark, s.namespace, s.location)  # another run: the catalog knows
    for write in (s.append, s.replace_all, again.append, again.insert_select):
        with pytest.raises(Exception, match="declared NOT NULL"):
            write("t", loose)
    assert s.read("t").count() == 0
    again.append("t", loose.filter("n IS NOT NULL"))
    assert values(s.read("t")) == [1]
