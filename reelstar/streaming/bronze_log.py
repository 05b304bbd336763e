"""The batches of a stream as one bronze table that stays small in files.

A stream leaves a folder per micro-batch (``batch_id=<n>``, with a commit
marker).  :func:`compact` rewrites finished batches into one folder per
ingestion day and publishes a new manifest, ``_manifest/<version>.json``: the
last batch it covers and the folders that hold the rows up to there.  A reader
takes the newest manifest and the committed batches after it, so it sees every
row once before, during and after a compaction; a compaction that dies
before its manifest is there changes nothing.  A day's folders are merged into
one when there are more than ``max_parts``, so the files of a day are bounded
whatever the trigger interval.  What a manifest no longer names is deleted with
the next compaction: a reader has until then.

Rows carry the number of their batch as load number (``load_id``): a refresh
opens the folders with batches it has not seen, and no others.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRONZE
from ..sources.files import Files
from ..sources.ledger import LOAD, Loads

#: Where a record stood in its topic; only the raw batches keep it.
PARTITION, OFFSET = "kafka_partition", "kafka_offset"
#: Folders that a day may have before they are merged.
MAX_PARTS = 8
_EMPTY = {"version": 0, "upto": -1, "parts": [], "retired": []}


@dataclass(frozen=True)
class State:
    """What a reader sees: the manifest and the committed batches after it."""

    manifest: dict
    batches: list[int]

    @property
    def latest(self) -> int:
        return max([self.manifest["upto"], *self.batches])


def state(spark: SparkSession, root: str) -> State:
    files = Files(spark)
    # the batches first: one that is compacted meanwhile is in the manifest too
    batches = [int(n[len("batch_id="):]) for n in files.names(root) if n.startswith("batch_id=")]
    found = sorted(n for n in files.names(f"{root}/_manifest") if n.endswith(".json") and n[0].isdigit())
    manifest = json.loads(files.read(f"{root}/_manifest/{found[-1]}")) if found else _EMPTY
    done = [n for n in batches if n > manifest["upto"] and files.exists(f"{root}/batch_id={n}/_SUCCESS")]
    return State(manifest, sorted(done))


def _schema(spark: SparkSession, root: str, seen: State, schema: T.StructType | None) -> T.StructType:
    schema = schema or BRONZE.get(root.rsplit("/", 1)[-1])
    if schema is None:
        some = [p["path"] for p in seen.manifest["parts"][:1]] + [f"{root}/batch_id={n}" for n in seen.batches[:1]]
        if not some:
            raise ValueError(f"no committed batch below {root}; give the schema of the table")
        schema = spark.read.parquet(some[0]).schema
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema
                         if f.name not in ("accepted", LOAD, PARTITION, OFFSET)])


def rows(spark: SparkSession, root: str, seen: State, schema: T.StructType, after: int | None = None) -> DataFrame:
    """The rows of the batches after number ``after`` (all for None), with
    ``load_id`` and ``accepted``."""
    low = -1 if after is None else after
    accepted, load = T.StructField("accepted", T.BooleanType()), T.StructField(LOAD, T.LongType())
    out = None
    parts = [p["path"] for p in seen.manifest["parts"] if p["last"] > low]
    if parts:
        out = spark.read.schema(T.StructType([*schema, load, accepted])).parquet(*parts).filter(F.col(LOAD) > low)
    batches = [f"{root}/batch_id={n}" for n in seen.batches if n > low]
    if batches:
        whole = T.StructType([*schema, T.StructField("batch_id", T.LongType()), accepted])
        raw = spark.read.schema(whole).option("basePath", root).parquet(*batches).withColumnRenamed("batch_id", LOAD)
        out = raw if out is None else out.unionByName(raw)
    return spark.createDataFrame([], T.StructType([*schema, load, accepted])) if out is None else out


def compact(spark: SparkSession, out_dir: str, schema: T.StructType | None = None,
            max_parts: int = MAX_PARTS) -> dict:
    """Rewrite the finished batches below ``out_dir`` into folders by ingestion
    day; returns the manifest that holds afterwards.

    The newest batch stays as it is: a stream that restarts may write it again.
    One compaction of a stream runs at a time; of two, the second fails when it
    publishes.
    """
    root, files = out_dir.rstrip("/"), Files(spark)
    seen = state(spark, root)
    old, ready = seen.manifest, seen.batches[:-1]
    if not ready:
        return old
    schema = _schema(spark, root, seen, schema)
    parts = list(old["parts"])

    def written(df: DataFrame, first: int, last: int) -> list[dict]:
        at = f"{root}/_log/{uuid.uuid4().hex}"
        dated = df.withColumn("ingest_date", F.to_date("ingestion_time"))
        dated.hint("rebalance", "ingest_date").write.partitionBy("ingest_date").parquet(at)
        return [{"day": n.split("=", 1)[1], "path": f"{at}/{n}", "first": first, "last": last}
                for n in files.folders(at) if n.startswith("ingest_date=")]

    new = rows(spark, root, State({**_EMPTY, "upto": old["upto"]}, ready), schema)
    parts += written(new, ready[0], ready[-1])
    retired = [f"{root}/batch_id={n}" for n in ready] + [_offsets_file(root, n) for n in ready]
    ranges = joined_ranges([*old.get("offsets", []), *_recorded(files, root, ready)])
    by_day: dict[str, list[dict]] = {}
    for p in parts:
        by_day.setdefault(p["day"], []).append(p)
    crowded = [p for same in by_day.values() if len(same) > max_parts for p in same]
    for day in dict.fromkeys(p["day"] for p in crowded):
        same = by_day[day]
        whole = T.StructType([*schema, T.StructField(LOAD, T.LongType()), T.StructField("accepted", T.BooleanType())])
        one = spark.read.schema(whole).parquet(*[p["path"] for p in same])
        parts = [p for p in parts if p not in same] + written(
            one, min(p["first"] for p in same), max(p["last"] for p in same))
        retired += [p["path"] for p in same]
    manifest = {"version": old["version"] + 1, "upto": ready[-1], "parts": parts, "retired": retired,
                "offsets": ranges,
                "at": _dt.datetime.now(_dt.timezone.utc).isoformat()}
    files.put(f"{root}/_manifest/{manifest['version']:012d}.json", json.dumps(manifest))
    for path in old["retired"]:
        files.delete(path)
    return manifest


# -- offsets -----------------------------------------------------------------------

def _offsets_file(root: str, batch: int) -> str:
    return f"{root}/_offsets/{batch:019d}.json"


def record_offsets(spark: SparkSession, out_dir: str, batch: int) -> None:
    """Note the offset ranges of a committed batch: per topic partition first
    and last offset and the number of records (rejects too).  Read from the
    batch's own files, once; nothing for sources without offsets."""
    root, files = out_dir.rstrip("/"), Files(spark)
    path = _offsets_file(root, batch)
    if files.exists(path):
        return
    written = spark.read.parquet(f"{root}/batch_id={batch}")
    if OFFSET not in written.columns:
        return
    # one row per topic partition
    found = written.groupBy(F.col(PARTITION).alias("partition")).agg(
        F.min(OFFSET).alias("first"), F.max(OFFSET).alias("last"), F.count(F.lit(1)).alias("rows")).collect()
    files.put(path, json.dumps([{**r.asDict(), "batch": batch} for r in found]))


def _recorded(files: Files, root: str, batches: list[int]) -> list[dict]:
    there = files.names(f"{root}/_offsets")
    return [r for n in batches if f"{n:019d}.json" in there for r in json.loads(files.read(_offsets_file(root, n)))]


def joined_ranges(ranges: list[dict]) -> list[dict]:
    """Ranges that follow each other without a gap become one."""
    out: list[dict] = []
    for r in sorted(ranges, key=lambda r: (r["partition"], r["first"], r["last"])):
        last = out[-1] if out else None
        if last and last["partition"] == r["partition"] and last["last"] + 1 == r["first"]:
            out[-1] = {**last, "last": r["last"], "rows": last["rows"] + r["rows"], "batch": r["batch"]}
        else:
            out.append(dict(r))
    return out


def offset_ranges(spark: SparkSession, out_dir: str) -> list[dict]:
    """The offsets that the stream's batches hold, per topic partition."""
    root = out_dir.rstrip("/")
    seen = state(spark, root)
    return joined_ranges([*seen.manifest.get("offsets", []), *_recorded(Files(spark), root, seen.batches)])


def offset_gaps(ranges: list[dict]) -> list[dict]:
    """Offsets that are missing (``kind`` gap) or came more than once (repeat),
    and ranges with fewer records than offsets (``kind`` sparse: transaction
    marks, compacted topics, or loss)."""
    out, reach = [], {}
    for r in sorted(ranges, key=lambda r: (r["partition"], r["first"], r["last"])):
        p, at = r["partition"], reach.get(r["partition"])
        if at is not None and r["first"] > at + 1:
            out.append({"kind": "gap", "partition": p, "first": at + 1, "last": r["first"] - 1})
        elif at is not None and r["first"] <= at:
            out.append({"kind": "repeat", "partition": p, "first": r["first"], "last": min(at, r["last"])})
        if r["rows"] < r["last"] - r["first"] + 1:
            out.append({"kind": "sparse", "partition": p, "first": r["first"], "last": r["last"]})
        reach[p] = max(r["last"], r["last"] if at is None else at)
    return out


class StreamLoads(Loads):
    """The accepted rows of a stream as a source of increments by batch."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | None = None):
        self._spark, self._root, self._seen = spark, root, state(spark, root)
        self._schema = _schema(spark, root, self._seen, schema)
        self.latest = self._seen.latest

    def whole(self) -> DataFrame:
        return self.since(None)

    def since(self, after: int | None) -> DataFrame:
        found = rows(self._spark, self._root, self._seen, self._schema, after)
        return found.filter("accepted").drop("accepted")


def bronze_loads(spark: SparkSession, out_dir: str, schema: T.StructType | None = None) -> StreamLoads:
    """Committed batches of a stream as an input of ``layers.run_silver``.
    ``schema`` is that of the bronze table; by default the one named by the
    folder, else that of the first batch."""
    return StreamLoads(spark, out_dir.rstrip("/"), schema)


def read_bronze(spark: SparkSession, out_dir: str, rejects: bool = False,
                schema: T.StructType | None = None) -> DataFrame:
    """Accepted (or rejected) rows of every committed batch, compacted or not.

    A batch that is half written is not there yet.  A stream without a committed
    batch has no rows.
    """
    root = out_dir.rstrip("/")
    seen = state(spark, root)
    schema = _schema(spark, root, seen, schema)
    return rows(spark, root, seen, schema).filter(F.col("accepted") == (not rejects)).select(*schema.names)
