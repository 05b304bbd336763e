"""Slowly changing dimension, type 2, for users.

The snapshot is joined once with the narrow current rows to find the *work*: the
snapshot rows that make a new version.  The work is written down (it is what
changed, not the dimension), and everything else follows from it by joins of
the current rows with its ids; no ids pass through the driver:

* current row, snapshot unchanged or absent  -> kept as is
* current row, a tracked attribute changed   -> expired (effective_to = as_of
  date, is_current = false, re-stamped) **and** a new current version built
  from the snapshot (effective_from = as_of date)
* no current row, snapshot present           -> new current version
  (only with ``insert_new``)
* historical (non-current) rows pass through untouched.

New versions get dense keys above the existing maximum (see ``keys``).
Versions are half-open ``[effective_from, effective_to)``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import INITIAL_EFFECTIVE_FROM, age_band, as_of_date, as_of_ts
from ..schemas import DIM_USER
from ..session import ensure_checkpoint_dir
from .keys import allocate_keys

TRACKED = ("subscription_tier", "country")
SNAPSHOT_COLS = ["user_id", "username", "email", "age", "age_band", "country",
                 "subscription_tier", "signup_date"]
DIM_COLS = [f.name for f in DIM_USER.fields]


def prepare_snapshot(users: DataFrame) -> DataFrame:
    """Bronze user snapshot with its age band."""
    return users.withColumn("age_band", age_band("age")).select(*SNAPSHOT_COLS)


def _version(df: DataFrame, effective_from: Column, as_of) -> DataFrame:
    return df.select(
        *SNAPSHOT_COLS,
        effective_from.alias("effective_from"),
        F.lit(None).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
        as_of_ts(as_of).alias("ingestion_time"),
    )


def scd2_initial(snapshot: DataFrame, as_of: _dt.datetime | str,
                 effective_from: str = INITIAL_EFFECTIVE_FROM) -> DataFrame:
    """First load: every user gets one current version and a key 1..n."""
    versions = _version(snapshot, F.lit(effective_from).cast("date"), as_of)
    return allocate_keys(versions, ["user_id"], "user_key", base=0).select(*DIM_COLS)


def _differs(new: Column, old: Column, null_safe: bool) -> Column:
    return ~new.eqNullSafe(old) if null_safe else (new != old)


def _changed(tracked, null_safe: bool) -> Column:
    cond = None
    for c in tracked:
        d = _differs(F.col(f"n.{c}"), F.col(f"o.{c}"), null_safe)
        cond = d if cond is None else (cond | d)
    # a NULL comparison (NULL-unsafe mode) means "not changed"
    return F.coalesce(cond, F.lit(False))


def scd2_changes(snapshot: DataFrame, current: DataFrame, tracked=TRACKED,
                 null_safe: bool = True) -> DataFrame:
    """Users whose tracked attributes differ between current row and snapshot."""
    j = snapshot.alias("n").join(current.alias("o"), "user_id", "inner")
    cols = [F.col("user_id")]
    for c in tracked:
        cols += [F.col(f"o.{c}").alias(f"old_{c}"), F.col(f"n.{c}").alias(f"new_{c}")]
    return j.filter(_changed(tracked, null_safe)).select(*cols)


def scd2_work(current: DataFrame, snapshot: DataFrame, tracked=TRACKED, insert_new: bool = True,
              null_safe: bool = True) -> DataFrame:
    """Snapshot rows that make a new version - of a changed user, or (with
    ``insert_new``) an unknown one - settled by a reliable checkpoint."""
    known = current.select(F.col("user_id").alias("__known"), *tracked)
    j = snapshot.alias("n").join(known.alias("o"), F.col("n.user_id") == F.col("o.__known"), "left")
    is_known = F.col("o.__known").isNotNull()
    changed = is_known & _changed(tracked, null_safe)
    work = j.filter(changed | ~is_known if insert_new else changed)
    ensure_checkpoint_dir(snapshot.sparkSession)
    return work.select(*[F.col(f"n.{c}") for c in SNAPSHOT_COLS]).checkpoint(eager=True)


def scd2_versions(current: DataFrame, work: DataFrame, as_of: _dt.datetime | str,
                  max_key: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """From current rows and the work on them: the rows that stay, the expired
    versions, and the new ones (keys above ``max_key``)."""
    today = as_of_date(as_of)
    current, ids = current.select(*DIM_COLS), work.select("user_id")
    kept = current.join(ids, "user_id", "left_anti").select(*DIM_COLS)
    stamps = {"effective_to": today, "is_current": F.lit(False), "ingestion_time": as_of_ts(as_of)}
    expired = current.join(ids, "user_id", "left_semi").select(
        *[stamps.get(c, F.col(c)).alias(c) for c in DIM_COLS])
    new = allocate_keys(_version(work, today, as_of), ["user_id"], "user_key", base=max_key).select(*DIM_COLS)
    return kept, expired, new


def scd2_apply(dim: DataFrame, snapshot: DataFrame, as_of: _dt.datetime | str,
               tracked=TRACKED, insert_new: bool = True, null_safe: bool = True,
               max_key: int | None = None) -> DataFrame:
    """Full next state of the dimension after applying ``snapshot``."""
    dim = dim.select(*DIM_COLS)
    current = current_rows(dim)
    if max_key is None:
        # one scalar to the driver: the largest key handed out so far
        max_key = dim.agg(F.max("user_key")).first()[0] or 0
    work = scd2_work(current, snapshot, tracked, insert_new, null_safe)
    kept, expired, new = scd2_versions(current, work, as_of, int(max_key))
    history = dim.filter(~F.col("is_current"))
    return history.unionByName(kept).unionByName(expired).unionByName(new)


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current"))
