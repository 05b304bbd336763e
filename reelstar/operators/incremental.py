"""High-water-mark incremental scans.

The mark is the largest *source* ingestion time already loaded into the
target.  It reaches the scan as a literal, so Parquet row-group statistics
(and Iceberg/Delta file statistics) skip everything at or below it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ntz_lit


def high_water_mark(target: DataFrame, ts_col: str = "source_ingestion_time", floor=None):
    """max(ts_col) of the target, or None when the target is empty.

    ``floor`` is a bound recorded by an earlier run.  Only rows at or above it
    are aggregated - a literal filter that Parquet row-group statistics turn
    into skipping all older files - so the cost follows the newest data, not
    the table size.  It is never trusted by itself: a target that holds
    nothing at or above it (truncated or rebuilt since) is aggregated whole.
    """
    if floor is not None:
        found = target.filter(F.col(ts_col) >= ntz_lit(floor)).agg(F.max(F.col(ts_col))).first()[0]
        if found is not None:
            return found
    return target.agg(F.max(F.col(ts_col))).first()[0]


def incremental(source: DataFrame, hwm, ts_col: str = "ingestion_time",
                overlap: _dt.timedelta | None = None, target: DataFrame | None = None,
                key: str | None = None, target_ts_col: str = "source_ingestion_time") -> DataFrame:
    """Source rows newer than ``hwm``.

    ``overlap = None`` is the strict ``ts > hwm`` scan.  With an overlap the
    scan starts at ``hwm - overlap``, that instant included, and drops rows
    whose ``key`` is already in the target's same slice (anti join on both
    bounded slices), so a row that committed behind the mark, or at it after
    the last run, is still picked up exactly once.  An overlap of zero covers
    the second case alone.  Rows without a time belong to every slice, so they
    too are loaded once.  A NULL key counts as one key.
    """
    if hwm is None:
        return source
    if overlap is None:
        return source.filter(F.col(ts_col) > ntz_lit(hwm))
    lower = hwm - overlap

    def recent(col: str):
        return (F.col(col) >= ntz_lit(lower)) | F.col(col).isNull()

    slice_new = source.filter(recent(ts_col))
    if target is None or key is None:
        raise ValueError("overlap needs the target and a key to de-duplicate")
    seen = target.filter(recent(target_ts_col)).select(F.col(key).alias("__seen"))
    return slice_new.join(seen, F.col(key).eqNullSafe(F.col("__seen")), "left_anti")
