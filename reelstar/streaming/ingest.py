"""JSON stream -> bronze ingest (watch events and late ratings).

Source: a Kafka topic (``value`` bytes) or, where the Kafka connector is not
on the classpath, a directory of newline-delimited JSON text files - both give
one ``value`` column and run the same parsing code.

Per micro-batch (``foreachBatch``):

* empty batches are skipped;
* ``from_json`` (PERMISSIVE) parses each value; ``event_time`` text becomes a
  UTC TIMESTAMP_NTZ; the batch is stamped with one ingestion time;
* rows without their key (malformed JSON, NULL key) are kept apart as
  rejects instead of poisoning the bronze table;
* everything is written in **one** pass to ``<out>/batch_id=<n>/accepted=<b>``;
  a micro-batch replayed after a failure finds its committed output or replaces
  what a dead write left: each source record lands exactly once.

:mod:`.bronze_log` reads the batches as a table and compacts them by day.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import as_of_ts, now_utc, parse_event_time
from ..schemas import RATINGS_JSON, WATCH_JSON
from ..sources.files import Files
from .bronze_log import (OFFSET, PARTITION, bronze_loads, compact, offset_gaps, offset_ranges,  # noqa: F401
                         read_bronze, record_offsets)

WATCH = ("watch_events", WATCH_JSON, "event_id")
RATINGS = ("ratings_late", RATINGS_JSON, "rating_id")
DEFAULT_TRIGGER = {"processingTime": "30 seconds"}
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def kafka_source(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "latest", fail_on_data_loss: bool = False,
                 max_offsets_per_trigger: int | None = 5_000_000) -> DataFrame:
    """The topic's ``value`` with partition and offset; a batch takes at most
    ``max_offsets_per_trigger`` records (the first one after a long stop would
    else be all of them)."""
    reader = spark.readStream.format("kafka")
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return (reader
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("failOnDataLoss", str(fail_on_data_loss).lower())
            .load()
            .select("value", F.col("partition").alias(PARTITION), F.col("offset").alias(OFFSET)))


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def parse_json_values(raw: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """``value`` (bytes or text) -> the payload's columns (``d.*``), and the
    partition and offset of a source that has them."""
    place = [c for c in (PARTITION, OFFSET) if c in raw.columns]
    return raw.select(F.from_json(F.col(value_col).cast("string"), schema).alias("d"), *place).select("d.*", *place)


def to_bronze(parsed: DataFrame, ingestion_time) -> DataFrame:
    """Typed event_time plus the ingestion stamp of the batch."""
    return (parsed.withColumn("event_time", parse_event_time("event_time"))
            .withColumn("ingestion_time", as_of_ts(ingestion_time)))


def to_json_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows -> JSON text (``value``); event_time as ISO-8601 with offset and
    full microseconds (plain ``to_json`` keeps only milliseconds)."""
    fields = [F.date_format("event_time", ISO_UTC).alias(c) if c == "event_time" else F.col(c)
              for c in columns]
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


class BatchWriter:
    """``foreachBatch`` sink: one write per micro-batch, idempotent per batch id."""

    def __init__(self, out_dir: str, key: str, clock: Callable[[], _dt.datetime] = now_utc,
                 schema: T.StructType | None = None):
        self.out_dir, self.key, self.clock, self.schema = out_dir.rstrip("/"), key, clock, schema

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        if batch_df.isEmpty():
            return
        target = f"{self.out_dir}/batch_id={batch_id}"
        # a replay brings the same source records: what is committed stays as
        # it is, stamp included, under the eyes of the refreshes that read it
        if Files(batch_df.sparkSession).exists(f"{target}/_SUCCESS"):
            record_offsets(batch_df.sparkSession, self.out_dir, batch_id)
            return
        stamped = to_bronze(batch_df, self.clock())
        stamped = stamped.withColumn("accepted", F.col(self.key).isNotNull())
        # static: what a write that died left behind goes, whatever the
        # session's partition overwrite mode is at that moment
        (stamped.write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("accepted").parquet(target))
        record_offsets(batch_df.sparkSession, self.out_dir, batch_id)


def start_ingest(raw: DataFrame, schema: T.StructType, key: str, out_dir: str, checkpoint: str,
                 trigger: dict | None = None, clock: Callable[[], _dt.datetime] = now_utc,
                 name: str | None = None) -> StreamingQuery:
    parsed = parse_json_values(raw, schema)
    w = (parsed.writeStream.foreachBatch(BatchWriter(out_dir, key, clock))
         .option("checkpointLocation", checkpoint)
         .trigger(**(trigger or DEFAULT_TRIGGER)))
    if name:
        w = w.queryName(name)
    return w.start()


def run_until_any_ends(queries: list[StreamingQuery]) -> None:
    """Block until one of the streams ends, then stop the others; an error of
    the one that ended is raised."""
    import time

    try:
        while queries and all(q.isActive for q in queries):
            time.sleep(0.2)
        for q in queries:
            if not q.isActive:
                q.awaitTermination()
    finally:
        for q in queries:
            if q.isActive:
                q.stop()


def start_bronze_streams(spark: SparkSession, sources: dict[str, DataFrame], out_root: str,
                         checkpoint_root: str, trigger: dict | None = None,
                         clock: Callable[[], _dt.datetime] = now_utc) -> list[StreamingQuery]:
    """Start the watch and ratings ingest queries side by side.

    ``sources`` maps "watch_events" / "ratings_late" to a raw stream with a
    ``value`` column.  Each query has its own checkpoint.  Callers usually
    block in :func:`run_until_any_ends`.
    """
    queries = []
    for name, schema, key in (WATCH, RATINGS):
        if name in sources:
            queries.append(start_ingest(sources[name], schema, key, f"{out_root.rstrip('/')}/{name}",
                                        f"{checkpoint_root.rstrip('/')}/{name}", trigger, clock, name))
    return queries
