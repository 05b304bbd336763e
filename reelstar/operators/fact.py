"""Gold star-schema fact."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import as_of_ts
from .joins import salted_lookup


def build_fact(sessions: DataFrame, dim_user_current: DataFrame,
               as_of: _dt.datetime | str, hot_users: list | None = None) -> DataFrame:
    """Sessions with the surrogate key of the user's current version.

    The key is bound at load time and never restated; an unknown user gets a
    NULL key.  ``event_id`` identifies the row.  How the join runs is left to
    the planner: byte statistics decide on a broadcast, else a sort-merge join
    whose skewed (hot-user) partitions AQE splits; the users given as hot are
    salted, which needs no AQE.
    """
    keys = dim_user_current.select("user_id", "user_key")
    return salted_lookup(sessions, keys, "user_id", hot_users or [], "event_id").select(
        "session_id", "user_key", "user_id", "content_id", "event_type", "device_type",
        "watch_duration_seconds", "completion_percent", "is_late_arrival",
        F.to_date("event_time").alias("event_date"), "event_time",
        as_of_ts(as_of).alias("ingestion_time"),
        F.col("ingestion_time").alias("source_ingestion_time"), "event_id",
    )
