"""Daily engagement KPIs (one row per event date, full replace).

Plan shape: one partial aggregate per task keyed by (event_date, user_id)
(the distinct-user count), a shuffle on that pair - so even a date holding a
third of all events spreads over as many tasks as it has users - then a tiny
final shuffle on event_date.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import count_if, exact_avg_rounded
from ..functions.scalar import EVENT_TYPES, as_of_ts, ratio_percent
from ..schemas import DAILY_ENGAGEMENT
from .joins import broadcast_if_bounded


def daily_engagement(fact: DataFrame, as_of: _dt.datetime | str) -> DataFrame:
    et = F.col("event_type")
    daily = fact.groupBy("event_date").agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count("session_id").alias("total_sessions"),
        F.round(F.sum("watch_duration_seconds") / 3600, 2).alias("total_watch_hours"),
        F.round(F.avg("watch_duration_seconds") / 60, 2).alias("avg_watch_time_minutes"),
        exact_avg_rounded("completion_percent", 2, 2).alias("avg_completion_rate"),
        count_if(et == "play").alias("total_play_events"),
        count_if(et == "finish").alias("total_finish_events"),
    )
    return daily.select(
        F.col("event_date").alias("date"), "total_users", "total_sessions", "total_watch_hours",
        "avg_watch_time_minutes", "avg_completion_rate", "total_play_events", "total_finish_events",
        ratio_percent("total_finish_events", "total_sessions").alias("finish_rate"),
        as_of_ts(as_of).alias("ingestion_time"),
    ).select(*[f.name for f in DAILY_ENGAGEMENT.fields])


def facts_of_affected_days(fact: DataFrame, new_rows: DataFrame) -> DataFrame:
    """All fact rows of the event days that ``new_rows`` touch.

    The distinct days of a batch are few (one row per calendar day), so they
    are broadcast once that bound is checked; on a fact partitioned by
    event_date the semi join then becomes a partition filter (dynamic
    partition pruning).
    """
    days = new_rows.select("event_date").distinct()
    dated = fact.join(broadcast_if_bounded(days), "event_date", "left_semi")
    # facts without a parsable event time form their own (NULL) day in the
    # KPIs; that one partition is always recomputed (a static partition
    # filter - a null-safe join would lose the dynamic pruning above)
    undated = fact.filter(F.col("event_date").isNull())
    return dated.unionByName(undated)


def event_mix(fact: DataFrame) -> DataFrame:
    """Per date: sessions and the count of each event type (+ other types)."""
    et = F.col("event_type")
    aggs = [F.count("session_id").alias("total_sessions")]
    aggs += [count_if(et == t).alias(f"{t}_events") for t in EVENT_TYPES]
    aggs.append(count_if(~et.isin(*EVENT_TYPES) | et.isNull()).alias("other_events"))
    return fact.groupBy(F.col("event_date").alias("date")).agg(*aggs)


def distinct_users(fact: DataFrame) -> DataFrame:
    """Per date: exact distinct users and distinct titles."""
    return fact.groupBy(F.col("event_date").alias("date")).agg(
        F.count_distinct("user_id").alias("total_users"),
        F.count_distinct("content_id").alias("total_titles"),
    )


def top_days(daily: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` earliest days of the KPI table (a top-k: sort + limit)."""
    return daily.orderBy("date").limit(n)
