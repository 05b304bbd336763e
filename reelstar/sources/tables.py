"""Catalog tables of the three layers.

A :class:`TableStore` is a namespace in the session catalog plus a table
provider.  ``parquet`` is the default (what this environment has);
``iceberg`` / ``delta`` work by configuration where their jars and catalog
are set up - the code only uses catalog SQL and the DataFrame writers.

Appends are ``INSERT INTO``.  A replace never touches the files that readers
see: on a path-based provider the new rows are written to a folder of their own
and the catalog's pointer is moved there - one ``ALTER TABLE ... SET LOCATION``
for a table without partitions, one per partition else.  A reader finds the old
or the new rows, never none, and a write that dies before the pointer moves
changes nothing.  The old files stay until the next replace of the table.

Logged tables (``create(..., logged=True)``) keep a load number on every row;
see :mod:`.ledger`.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import ntz_lit, now_utc
from ..schemas import ddl
from ..session import ensure_checkpoint_dir
from .files import Files
from .ledger import LOAD, LOAD_DATE, Ledger, Loads

V2_PROVIDERS = {"iceberg", "delta"}
#: Partition column of tables that are rewritten bucket by bucket.
BUCKET = "bucket_id"
#: Table property that names the NOT NULL columns.
_REQUIRED = "reelstar.not_null"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class TableStore:
    def __init__(self, spark: SparkSession, namespace: str, location: str | None = None,
                 provider: str = "parquet", catalog: str | None = None):
        self.spark, self.provider = spark, provider
        self.namespace = f"{catalog}.{namespace}" if catalog else namespace
        self.location = location.rstrip("/") if location else None
        self._partitions: dict[str, tuple[str, ...]] = {}
        self._required: dict[str, list[str]] = {}
        self._ledger: Ledger | None = None
        self.files = Files(spark)

    # -- DDL ------------------------------------------------------------------
    def create_namespace(self) -> None:
        loc = f" LOCATION '{self.location}'" if self.location else ""
        self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {self.namespace}{loc}")

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    @property
    def root(self) -> str:
        """The folder of the namespace."""
        if self.location is None:
            said = {r[0]: r[1] for r in self.spark.sql(f"DESCRIBE NAMESPACE {self.namespace}").collect()}
            self.location = said["Location"].rstrip("/")
        return self.location

    @property
    def ledger(self) -> Ledger:
        if self._ledger is None:
            self._ledger = Ledger(self.spark, f"{self.root}/_ledger")
        return self._ledger

    def create(self, table: str, schema: T.StructType, partitioned_by: tuple[str, ...] = (),
               logged: bool = False) -> None:
        """Create the table unless it is there.  A logged table without
        partitions of its own is partitioned by the day of the load."""
        if logged:
            schema = T.StructType([*schema.fields, T.StructField(LOAD, T.LongType())])
            if not partitioned_by:
                schema = T.StructType([*schema.fields, T.StructField(LOAD_DATE, T.DateType())])
                partitioned_by = (LOAD_DATE,)
        keys = ",".join(f.name for f in schema.fields if not f.nullable)
        props = f" TBLPROPERTIES ('{_REQUIRED}'='{keys}'" + (
            ", 'format-version'='2')" if self.provider == "iceberg" else ")")
        self._partitions[table] = tuple(partitioned_by)
        part = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({ddl(schema)}) "
                       f"USING {self.provider}{part}{props}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def partitions(self, table: str) -> tuple[str, ...]:
        """The partition columns (from the catalog for a table of another run)."""
        if table not in self._partitions:
            cols = self.spark.catalog.listColumns(self.name(table))
            self._partitions[table] = tuple(c.name for c in cols if c.isPartition)
        return self._partitions[table]

    def required(self, table: str) -> list[str]:
        """Columns declared NOT NULL.  Path-based providers drop the constraint,
        so it is kept as a table property and checked in every write plan."""
        if table not in self._required:
            props = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
            keys = next((r["value"] for r in props if r["key"] == _REQUIRED), "")
            self._required[table] = [k for k in keys.split(",") if k]
        return self._required[table]

    def _checked(self, table: str, df: DataFrame) -> DataFrame:
        """A row with a NULL where the table declares NOT NULL fails the write."""
        for c in self.required(table):
            broken = F.raise_error(F.lit(f"{self.name(table)}.{c} is declared NOT NULL"))
            df = df.withColumn(c, F.when(F.col(c).isNull(), broken.cast(df.schema[c].dataType)).otherwise(F.col(c)))
        return df

    # -- reads -----------------------------------------------------------------
    def read(self, table: str) -> DataFrame:
        """The table's own columns; of a logged table the rows of committed loads."""
        rows = self.spark.table(self.name(table))
        if LOAD in rows.columns:
            dead = self.ledger.loads(table)[1]
            if dead:
                rows = rows.filter(~F.col(LOAD).isin(dead))
        return rows.drop(LOAD, LOAD_DATE, BUCKET)

    def loads(self, table: str) -> Loads:
        """A logged table as a source of increments by load number."""
        rows = self.spark.table(self.name(table))
        done, dead = self.ledger.settled_loads(table)
        by = self.partitions(table)
        dated = by and rows.schema[by[0]].dataType == T.DateType()
        return Loads(rows, done, lambda after: self.ledger.entries(table, after, done),
                     by[0] if dated else None, dead)

    def is_empty(self, table: str) -> bool:
        return self.read(table).isEmpty()

    # -- writes ----------------------------------------------------------------
    def _dealt(self, table: str, df: DataFrame) -> DataFrame:
        """For a partitioned table, rows dealt by its partition columns, so that a
        day is a few files and not one per input task (AQE splits a large day
        and merges small ones)."""
        by, df = self.partitions(table), self._checked(table, df)
        return df.hint("rebalance", *by) if by else df

    def _write(self, table: str, df: DataFrame, metrics: list | None, write, op: str, upto: dict | None,
               sole_writer: bool) -> dict:
        """Run ``write`` on the table's columns of ``df`` and the observed
        ``metrics``; for a logged table, or where ``upto`` says which loads of
        its sources it holds now, as a load."""
        cols = self.spark.table(self.name(table)).columns
        logged = LOAD in cols
        if not logged and upto is None:
            df, obs = self._observed(self._dealt(table, df.select(*cols)), metrics)
            write(df)
            return obs.get if obs is not None else {}
        load = self.ledger.begin(table, sole_writer)
        days = []
        if logged:
            df = df.drop(LOAD, LOAD_DATE).withColumn(LOAD, F.lit(load).cast("long"))
            if LOAD_DATE in cols:
                df = df.withColumn(LOAD_DATE, F.lit(now_utc().date()))
            by = self.partitions(table)
            day = by[0] if by and df.schema[by[0]].dataType == T.DateType() else None
            if day:
                days = [F.collect_set(F.col(day).cast("string")).alias("__days"),
                        F.max(F.col(day).isNull()).alias("__undated")]
        df, obs = self._observed(self._dealt(table, df.select(*cols)), [*(metrics or []), *days, row_count("__rows")])
        write(df)
        said = obs.get
        entry = {"op": op, "upto": upto, "rows": said["__rows"]}
        if days:
            entry["days"] = sorted(said["__days"] or []) + ([None] if said["__undated"] else [])
        self.ledger.commit(table, load, entry)
        return {k: v for k, v in said.items() if not k.startswith("__")}

    def append(self, table: str, df: DataFrame, metrics: list | None = None, upto: dict | None = None,
               sole_writer: bool = False) -> dict:
        """Append ``df``; ``metrics`` are aggregate Columns observed during the
        write (no second pass over the data).  ``upto``: the last load of each
        source that the table holds afterwards."""
        def write(rows: DataFrame) -> None:
            if self.provider in V2_PROVIDERS:
                rows.writeTo(self.name(table)).append()
            else:
                rows.write.insertInto(self.name(table))

        return self._write(table, df, metrics, write, "append", upto, sole_writer)

    def insert_select(self, table: str, df: DataFrame) -> None:
        """SQL load: ``INSERT INTO <table> SELECT <columns> FROM <view of df>``.

        The same write as :meth:`append`, issued as SQL text (the path of
        scripts that load tables with DDL/DML statements).  The view name is
        unique per call, so concurrent loads never see each other's input.
        """
        def write(rows: DataFrame) -> None:
            view = f"_load_{uuid.uuid4().hex[:12]}"
            rows.createOrReplaceTempView(view)
            try:
                self.spark.sql(f"INSERT INTO {self.name(table)} SELECT {', '.join(rows.columns)} FROM {view}")
            finally:
                self.spark.catalog.dropTempView(view)

        self._write(table, df, None, write, "append", None, False)

    def insert_values(self, table: str, rows_sql: list[str]) -> None:
        """``INSERT INTO <table> VALUES (...), (...)`` for a few literal rows
        (connectivity / smoke checks; data loads use :meth:`insert_select`)."""
        self.spark.sql(f"INSERT INTO {self.name(table)} VALUES {', '.join(rows_sql)}")

    def append_if_empty(self, table: str, df: DataFrame) -> bool:
        """Idempotent load: append only when the target has no row yet."""
        if not self.is_empty(table):
            return False
        self.append(table, df)
        return True

    def replace_all(self, table: str, df: DataFrame, reads_self: bool = False,
                    metrics: list | None = None, upto: dict | None = None, sole_writer: bool = False) -> dict:
        """Replace the whole table (every partition) with ``df``, which may read
        the table.  Readers see the old rows until the pointer moves; an input
        that fails leaves the table as it was."""
        def write(rows: DataFrame) -> None:
            if self.provider in V2_PROVIDERS:
                self._cut(rows, reads_self).writeTo(self.name(table)).overwrite(F.lit(True))
            else:
                self._swap(table, rows, whole=True)

        return self._write(table, df, metrics, write, "replace", upto, sole_writer)

    def overwrite_partitions(self, table: str, df: DataFrame, metrics: list | None = None,
                             reads_self: bool = False, upto: dict | None = None, sole_writer: bool = False) -> dict:
        """Replace only the partitions that ``df`` has rows for; all other
        partitions stay as they are.  ``df`` may read the table."""
        def write(rows: DataFrame) -> None:
            if self.provider in V2_PROVIDERS:
                self._cut(rows, reads_self).writeTo(self.name(table)).overwritePartitions()
            else:
                self._swap(table, rows, whole=False)

        return self._write(table, df, metrics, write, "replace", upto, sole_writer)

    def _cut(self, df: DataFrame, reads_self: bool) -> DataFrame:
        if not reads_self:
            return df
        ensure_checkpoint_dir(self.spark)
        return df.checkpoint(eager=True)

    # -- versions of path-based tables -------------------------------------------
    def _swap(self, table: str, df: DataFrame, whole: bool) -> None:
        """Write ``df`` to a fresh folder, then point the table (or each of the
        partitions written; with ``whole`` the others are dropped) to it."""
        by = self.partitions(table)
        version = f"{self.root}/_versions/{table}/{uuid.uuid4().hex}"
        name, sql = self.name(table), self.spark.sql
        writer = df.write.partitionBy(*by) if by else df.write
        writer.format(self.provider).save(version)
        if not by:
            retired = [self._location(name)]
            sql(f"ALTER TABLE {name} SET LOCATION '{version}'")
        else:
            known = {r[0] for r in sql(f"SHOW PARTITIONS {name}").collect()}
            made = self._folders(version, len(by))
            moved = [p for p in made if p in known]
            gone = sorted(known - set(made)) if whole else []
            retired = [self._location(f"{name} PARTITION ({self._spec(table, p)})") for p in [*moved, *gone]]
            fresh = [p for p in made if p not in known]
            if fresh:
                sql(f"ALTER TABLE {name} ADD " + " ".join(
                    f"PARTITION ({self._spec(table, p)}) LOCATION '{version}/{p}'" for p in fresh))
            for p in moved:
                sql(f"ALTER TABLE {name} PARTITION ({self._spec(table, p)}) SET LOCATION '{version}/{p}'")
            if gone:
                sql(f"ALTER TABLE {name} DROP " + ", ".join(f"PARTITION ({self._spec(table, p)})" for p in gone))
        self._retire(table, version, retired)

    def _location(self, what: str) -> str:
        """Where the catalog says a table or partition lies."""
        return next(r[1] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {what}").collect() if r[0] == "Location")

    def _folders(self, path: str, depth: int, below: str = "") -> list[str]:
        """Partition folders ``depth`` levels below ``path``, relative to it."""
        if not depth:
            return [below]
        names = self.files.folders(f"{path}/{below}" if below else path)
        return [p for n in names if "=" in n for p in self._folders(path, depth - 1, f"{below}/{n}" if below else n)]

    def _spec(self, table: str, folder: str) -> str:
        """``d=2024-01-01/k=3`` as a partition specification."""
        schema = self.spark.table(self.name(table)).schema
        out = []
        for col, value in (part.split("=", 1) for part in folder.split("/")):
            kind = schema[col].dataType
            quoted = "'" + unquote(value).replace("'", "\\'") + "'"
            out.append(f"{col}=" + ("NULL" if value == _NULL_PARTITION else f"DATE{quoted}"
                                    if kind == T.DateType() else quoted if kind == T.StringType() else value))
        return ", ".join(out)

    def _retire(self, table: str, version: str, paths: list[str]) -> None:
        """Delete the files that the table's previous replace left behind, and
        note those this one leaves: a reader has until the next replace."""
        folder = version.rsplit("/", 1)[0]
        for note in self.files.names(folder):
            if note.endswith(".retired"):
                for path in json.loads(self.files.read(f"{folder}/{note}")):
                    self.files.delete(path)
                self.files.delete(f"{folder}/{note}")
        self.files.put(f"{version}.retired", json.dumps(paths))

    # -- high-water marks ------------------------------------------------------
    WATERMARKS = "_watermarks"

    def record_watermark(self, table: str, value) -> None:
        """Remember a lower bound of the table's high-water mark.

        The marks table is partitioned by table name and each record replaces
        that table's partition with one row (the larger of the old and the new
        mark), so it stays one small file per table however many runs there
        are.  A mark is only ever a lower bound: a lost or older one costs
        time, never correctness.
        """
        if value is None:
            return
        if not self.exists(self.WATERMARKS):
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(self.WATERMARKS)} "
                           f"(mark TIMESTAMP_NTZ, table_name STRING) USING {self.provider} "
                           f"PARTITIONED BY (table_name)")
        old = self.watermark(table)
        if old is not None and old >= value:
            return
        row = self.spark.range(1).select(ntz_lit(value).alias("mark"),
                                         F.lit(table).alias("table_name"))
        self.overwrite_partitions(self.WATERMARKS, row)

    def clear_watermark(self, table: str) -> None:
        """Forget the table's mark: its next refresh starts from nothing."""
        if self.exists(self.WATERMARKS):
            row = self.spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("mark"),
                                             F.lit(table).alias("table_name"))
            self.overwrite_partitions(self.WATERMARKS, row)

    def watermark(self, table: str):
        """Recorded mark for ``table`` (None when nothing recorded); a
        partition-pruned read of one row, only ever used as a lower bound
        (see ``incremental.high_water_mark``)."""
        if not self.exists(self.WATERMARKS):
            return None
        return (self.read(self.WATERMARKS).filter(F.col("table_name") == table)
                .agg(F.max("mark")).first()[0])

    @staticmethod
    def _observed(df: DataFrame, metrics: list | None):
        if not metrics:
            return df, None
        obs = Observation()
        return df.observe(obs, *metrics), obs


def row_count(name: str = "rows") -> F.Column:
    return F.count(F.lit(1)).alias(name)
