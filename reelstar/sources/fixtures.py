"""Bindings from the driver's parquet tables to the bronze inputs.

The engagement model reads four bronze tables (users, content_catalog,
watch_events, ratings_late).  The test data ships TPC-H-like tables plus an
``events`` stream, so each bronze table is a deterministic projection of a
driver table.  The same rules exist twice: as DataFrame plans (``Bindings``)
and as a SQL ``WITH`` prefix for the DuckDB oracle (``ORACLE_BINDINGS``).

Every binding is a narrow projection over one scan, so Catalyst prunes the
parquet read to the columns used and pushes filters into it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the bindings.
BRONZE_USERS_LOADED = "2024-01-01 00:00:00"      # ingestion_time of the day-1 user snapshot
BRONZE_USERS_V2_LOADED = "2024-02-04 00:00:00"   # ingestion_time of the day-2 user snapshot
BRONZE_CONTENT_LOADED = "2023-12-31 00:00:00"    # ingestion_time of the catalog
EVENT_TYPE_MAP = [("view", "play"), ("click", "pause"), ("error", "stop"), ("purchase", "finish")]
DEVICES_BY_ID_MOD_4 = ["mobile", "desktop", "tablet", "smart_tv"]
LANGUAGES_BY_KEY_MOD_6 = ["EN", "ES", "FR", "DE", "HE", "PT"]


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _case(col: Column, pairs: list[tuple[object, str]], default: Column) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(col == k, v) if expr is None else expr.when(col == k, v)
    return expr.otherwise(default)


@dataclass
class Bindings:
    spark: SparkSession
    sf_dir: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir.rstrip('/')}/{name}.parquet")

    @cached_property
    def watch_events(self) -> DataFrame:
        ev = self.table("events")
        eid = F.col("event_id")
        return ev.select(
            eid.cast("string").alias("event_id"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("user_id"),
            F.concat(F.lit("content_"), F.regexp_extract("props", r"([0-9]+)", 1)).alias("content_id"),
            _case(F.col("event_type"), EVENT_TYPE_MAP, F.col("event_type")).alias("event_type"),
            _case(eid % 4, list(enumerate(DEVICES_BY_ID_MOD_4)), F.lit(None)).alias("device_type"),
            F.concat(F.lit("sess_"), eid.cast("string")).alias("session_id"),
            F.floor(F.col("value") * 20).cast("int").alias("watch_duration_seconds"),
            F.col("ts").alias("event_time"),
            F.timestamp_add("SECOND", ((eid * 7919) % 259200).cast("int"), F.col("ts")).alias("ingestion_time"),
        )

    @cached_property
    def content_catalog(self) -> DataFrame:
        """The whole part table; every tenth title has an id no event refers
        to, so its events are orphans of the catalog."""
        p = self.table("part")
        key = F.col("p_partkey")
        return p.select(
            F.concat(F.when(key % 10 == 3, "unseen_").otherwise("content_"), key.cast("string")).alias("content_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("genre"),
            F.date_add(F.lit("2010-01-01").cast("date"), (key % 3650).cast("int")).cast("string").alias("release_date"),
            F.col("p_size").alias("duration_minutes"),
            _case(key % 6, list(enumerate(LANGUAGES_BY_KEY_MOD_6)), F.lit(None)).alias("language"),
            _ts(BRONZE_CONTENT_LOADED).alias("ingestion_time"),
        )

    def _customers(self) -> DataFrame:
        # nation is the fixed 25-row TPC-H dimension: broadcasting it is bounded.
        nation = F.broadcast(self.table("nation").select("n_nationkey", "n_name"))
        return self.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))

    def _users_from(self, c: DataFrame, country: Column, tier: Column, loaded: str,
                    prefix: Column | None = None) -> DataFrame:
        key = F.col("c_custkey")
        uid = F.concat(F.lit("user_") if prefix is None else prefix, key.cast("string"))
        return c.select(
            uid.alias("user_id"),
            F.concat(uid, F.lit("_name")).alias("username"),
            F.concat(uid, F.lit("@example.com")).alias("email"),
            F.when(key % 17 == 0, F.lit(None)).otherwise((16 + key % 45).cast("int")).cast("int").alias("age"),
            country.alias("country"),
            tier.alias("subscription_tier"),
            F.date_add(F.lit("2023-06-01").cast("date"), ((key * 37) % 240).cast("int")).cast("string").alias("signup_date"),
            _ts(loaded).alias("ingestion_time"),
        )

    @cached_property
    def users(self) -> DataFrame:
        """Day-1 snapshot of every customer; 1 in 29 still has a trial id and
        appears under the user id only on day 2."""
        prefix = F.when(F.col("c_custkey") % 29 == 0, "trial_").otherwise("user_")
        return self._users_from(self._customers(), F.col("n_name"), F.col("c_mktsegment"), BRONZE_USERS_LOADED, prefix)

    @cached_property
    def users_v2(self) -> DataFrame:
        """Day-2 snapshot: tier/country changes, value->NULL changes, new users."""
        key = F.col("c_custkey")
        country = F.when(key % 11 == 0, F.lit("XX")).when(key % 19 == 0, F.lit(None)).otherwise(F.col("n_name"))
        tier = F.when(key % 7 == 0, F.lit("PREMIUM")).otherwise(F.col("c_mktsegment"))
        return self._users_from(self._customers(), country, tier, BRONZE_USERS_V2_LOADED)

    @cached_property
    def ratings_late(self) -> DataFrame:
        o = self.table("orders")
        k = F.col("o_orderkey")
        return o.select(
            k.cast("string").alias("rating_id"),
            F.concat(F.lit("user_"), F.col("o_custkey").cast("string")).alias("user_id"),
            F.concat(F.lit("content_"), (k % 100).cast("string")).alias("content_id"),
            (k % 5 + 1).cast("int").alias("rating_value"),
            F.col("o_orderdate").alias("event_time"),
            F.timestamp_add("SECOND", ((k * 7919) % 259200 - 3600).cast("int"), F.col("o_orderdate")).alias("ingestion_time"),
        )


def bind(spark: SparkSession, sf_dir: str) -> Bindings:
    return Bindings(spark, sf_dir)


# The same bindings as a DuckDB ``WITH`` prefix (views over the driver tables).
ORACLE_BINDINGS = """
watch_events AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         'user_' || CAST(user_id AS VARCHAR) AS user_id,
         'content_' || regexp_extract(props, '([0-9]+)', 1) AS content_id,
         CASE event_type WHEN 'view' THEN 'play' WHEN 'click' THEN 'pause'
              WHEN 'error' THEN 'stop' WHEN 'purchase' THEN 'finish' ELSE event_type END AS event_type,
         CASE event_id % 4 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop'
              WHEN 2 THEN 'tablet' WHEN 3 THEN 'smart_tv' END AS device_type,
         'sess_' || CAST(event_id AS VARCHAR) AS session_id,
         CAST(floor(value * 20) AS INTEGER) AS watch_duration_seconds,
         ts AS event_time,
         ts + to_seconds(CAST((event_id * 7919) % 259200 AS INTEGER)) AS ingestion_time
  FROM events),
content_catalog AS (
  SELECT CASE WHEN p_partkey % 10 = 3 THEN 'unseen_' ELSE 'content_' END || CAST(p_partkey AS VARCHAR) AS content_id, p_name AS title, p_type AS genre,
         CAST(DATE '2010-01-01' + CAST(p_partkey % 3650 AS INTEGER) AS VARCHAR) AS release_date,
         p_size AS duration_minutes,
         CASE p_partkey % 6 WHEN 0 THEN 'EN' WHEN 1 THEN 'ES' WHEN 2 THEN 'FR'
              WHEN 3 THEN 'DE' WHEN 4 THEN 'HE' WHEN 5 THEN 'PT' END AS language,
         TIMESTAMP '2023-12-31 00:00:00' AS ingestion_time
  FROM part),
customers_n AS (
  SELECT c.*, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey),
users AS (
  SELECT uid AS user_id,
         uid || '_name' AS username,
         uid || '@example.com' AS email,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(16 + c_custkey % 45 AS INTEGER) END AS age,
         n_name AS country, c_mktsegment AS subscription_tier,
         CAST(DATE '2023-06-01' + CAST((c_custkey * 37) % 240 AS INTEGER) AS VARCHAR) AS signup_date,
         TIMESTAMP '2024-01-01 00:00:00' AS ingestion_time
  FROM (SELECT *, CASE WHEN c_custkey % 29 = 0 THEN 'trial_' ELSE 'user_' END || CAST(c_custkey AS VARCHAR) AS uid
        FROM customers_n)),
users_v2 AS (
  SELECT 'user_' || CAST(c_custkey AS VARCHAR) AS user_id,
         'user_' || CAST(c_custkey AS VARCHAR) || '_name' AS username,
         'user_' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
         CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(16 + c_custkey % 45 AS INTEGER) END AS age,
         CASE WHEN c_custkey % 11 = 0 THEN 'XX' WHEN c_custkey % 19 = 0 THEN NULL ELSE n_name END AS country,
         CASE WHEN c_custkey % 7 = 0 THEN 'PREMIUM' ELSE c_mktsegment END AS subscription_tier,
         CAST(DATE '2023-06-01' + CAST((c_custkey * 37) % 240 AS INTEGER) AS VARCHAR) AS signup_date,
         TIMESTAMP '2024-02-04 00:00:00' AS ingestion_time
  FROM customers_n),
ratings_late AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS rating_id,
         'user_' || CAST(o_custkey AS VARCHAR) AS user_id,
         'content_' || CAST(o_orderkey % 100 AS VARCHAR) AS content_id,
         CAST(o_orderkey % 5 + 1 AS INTEGER) AS rating_value,
         o_orderdate AS event_time,
         o_orderdate + to_seconds(CAST((o_orderkey * 7919) % 259200 - 3600 AS INTEGER)) AS ingestion_time
  FROM orders)
"""
