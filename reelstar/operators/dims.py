"""Conformed content, time and device dimensions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_of_ts, date_attributes, device_category
from ..schemas import DIM_CONTENT, DIM_DEVICE, DIM_TIME
from .joins import broadcast_if_bounded


def dim_content(content: DataFrame, as_of: _dt.datetime | str) -> DataFrame:
    """Catalog snapshot stamped with the load time."""
    cols = [f.name for f in DIM_CONTENT.fields if f.name != "ingestion_time"]
    return content.select(*cols, as_of_ts(as_of).alias("ingestion_time"))


def dim_content_unseen(content: DataFrame, existing: DataFrame, as_of) -> DataFrame:
    """Refresh mode: catalog rows whose content_id is not yet in the dimension."""
    return dim_content(content.join(existing.select("content_id"), "content_id", "left_anti"), as_of)


def event_dates(events: DataFrame, ts_col: str = "event_time") -> DataFrame:
    # distinct runs as a partial aggregate on every task first: only the
    # distinct dates of each task are shuffled
    # (an event without a parsable time has no calendar day: no dimension row)
    return events.select(F.to_date(F.col(ts_col)).alias("date_key")).filter("date_key IS NOT NULL").distinct()


def dim_time_increment(events: DataFrame, existing: DataFrame | None, as_of) -> DataFrame:
    """Calendar rows for event dates not yet in ``existing`` (left anti)."""
    dates = event_dates(events)
    if existing is not None:
        # dim_time holds one row per calendar day: bounded by the date range
        dates = dates.join(broadcast_if_bounded(existing.select("date_key")), "date_key", "left_anti")
    attrs = date_attributes("date_key")
    return dates.select("date_key", *[v.alias(k) for k, v in attrs.items()],
                        as_of_ts(as_of).alias("ingestion_time")).select(*[f.name for f in DIM_TIME.fields])


def dim_device(events: DataFrame, as_of, existing: DataFrame | None = None) -> DataFrame:
    """Distinct device types, NULL excluded, with their category (unseen ones
    only when ``existing`` is given)."""
    devices = events.select("device_type").filter("device_type IS NOT NULL").distinct()
    if existing is not None:
        devices = devices.join(broadcast_if_bounded(existing.select("device_type")), "device_type", "left_anti")
    return devices.select(
        "device_type", device_category("device_type").alias("device_category"),
        as_of_ts(as_of).alias("ingestion_time"),
    ).select(*[f.name for f in DIM_DEVICE.fields])
