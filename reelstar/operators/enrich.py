"""Silver builders: cleaned watch sessions and ratings."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (as_of_date, as_of_ts, completion_percent, delay_seconds,
                                is_late_arrival, is_within_48h)
from ..schemas import RATINGS, WATCH_SESSIONS
from .joins import salted_lookup


def late_arrival(events: DataFrame) -> DataFrame:
    """Per event: whole-second delay and the late flag (300 s < d < 48 h)."""
    return events.select(
        "event_id",
        delay_seconds("ingestion_time", "event_time").alias("delay_seconds"),
        is_late_arrival("ingestion_time", "event_time").alias("is_late_arrival"),
    )


def with_duration(events: DataFrame, dim_content: DataFrame, hot_titles: list | None = None) -> DataFrame:
    """Left join of the title duration (the planner picks the join from byte
    statistics; AQE splits a hot title, or the titles given are salted)."""
    durations = dim_content.select("content_id", "duration_minutes")
    return salted_lookup(events, durations, "content_id", hot_titles or [], "event_id")


def build_watch_sessions(new_events: DataFrame, dim_content: DataFrame,
                         as_of: _dt.datetime | str, hot_titles: list | None = None) -> DataFrame:
    e = with_duration(new_events, dim_content, hot_titles)
    return e.select(
        "session_id", "user_id", "content_id", "event_type", "device_type",
        "watch_duration_seconds",
        completion_percent("watch_duration_seconds", "duration_minutes").alias("completion_percent"),
        "event_time",
        as_of_ts(as_of).alias("ingestion_time"),
        is_late_arrival("ingestion_time", "event_time").alias("is_late_arrival"),
        as_of_date(as_of).alias("processing_date"),
        "event_id",
        F.col("ingestion_time").alias("source_ingestion_time"),
    ).select(*[f.name for f in WATCH_SESSIONS.fields])


def build_ratings(new_ratings: DataFrame, as_of: _dt.datetime | str) -> DataFrame:
    return new_ratings.select(
        "rating_id", "user_id", "content_id", "rating_value", "event_time",
        as_of_ts(as_of).alias("ingestion_time"),
        is_within_48h("ingestion_time", "event_time").alias("is_within_48h"),
        F.col("ingestion_time").alias("source_ingestion_time"),
    ).select(*[f.name for f in RATINGS.fields])
