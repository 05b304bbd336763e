"""Per-user daily churn features.

Everything is aggregated to the (user_id, event_date) grain **before** any
data is arranged per user:

* the three per-day aggregates (base measures, device mode, genre mode) use
  partial aggregation on every task, so a user or a day holding a third of
  all events is reduced to one row per task before the shuffle;
* their outputs are all hash-partitioned on (user_id, event_date), so the two
  joins between them add no exchange;
* user attributes are joined on ``user_id`` after aggregation, and the
  rolling windows (``partitionBy("user_id")``) reuse that partitioning - a
  window partition holds one row per active day of one user, bounded by the
  calendar, not by the user's event count.

The user's attributes are those of the current dimension row (one per user).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aggregates import count_if, exact_avg_rounded, exact_sum, mode_of
from ..functions.scalar import as_of_ts, churn_label, days_since, ratio_percent
from ..schemas import CHURN_FEATURES, DAILY_USER_BASE
from ..sources.ledger import among

DAY_KEYS = ["user_id", "event_date"]
USER_ATTRS = ["age_band", "subscription_tier", "country", "signup_date"]
ROLLED = ["sessions_7d", "watch_hours_7d", "watch_time_30d"]
LOOKBACK_DAYS = 30  # of the longest frame


def mode_per_group(df: DataFrame, keys: list[str], value: str, out: str,
                   weight_of: str = "session_id") -> DataFrame:
    """Most frequent ``value`` per group, counted as count(weight_of).

    Two aggregates: counts per (keys, value), then the mode per keys with a
    deterministic tie-break (largest value wins; NULL is lowest).
    """
    counts = df.groupBy(*keys, value).agg(F.count(weight_of).alias("__n"))
    return counts.groupBy(*keys).agg(mode_of(value, "__n").alias(out))


def preferred_device(fact: DataFrame) -> DataFrame:
    return mode_per_group(fact, DAY_KEYS, "device_type", "preferred_device")


def with_genre(fact: DataFrame, dim_content: DataFrame) -> DataFrame:
    return fact.join(dim_content.select("content_id", "genre"), "content_id", "left")


def favorite_genre(fact: DataFrame, dim_content: DataFrame) -> DataFrame:
    return mode_per_group(with_genre(fact, dim_content), DAY_KEYS, "genre", "favorite_genre")


def daily_measures(fact: DataFrame) -> DataFrame:
    et = F.col("event_type")
    return fact.groupBy(*DAY_KEYS).agg(
        F.count("session_id").alias("sessions_count"),
        F.round(F.sum("watch_duration_seconds") / 3600, 3).alias("total_watch_hours"),
        exact_avg_rounded("completion_percent", 2, 2).alias("avg_completion_rate"),
        count_if(et == "play").alias("play_count"),
        count_if(et == "pause").alias("pause_count"),
        count_if(et == "stop").alias("stop_count"),
        count_if(et == "finish").alias("finish_count"),
        F.count_distinct("content_id").alias("unique_content_watched"),
        count_if(F.col("is_late_arrival")).alias("late_arrival_count"),
    )


def daily_user_base(fact: DataFrame, dim_content: DataFrame) -> DataFrame:
    """Per user and event day: measures and both modes, without attributes.

    Depends only on the fact rows of that (user, day), so a refresh can
    recompute just the days that received new facts.
    """
    f = fact.select("user_id", "event_date", "session_id", "content_id", "device_type",
                    "event_type", "watch_duration_seconds", "completion_percent", "is_late_arrival")
    per_day = (daily_measures(f)
               .join(preferred_device(f), DAY_KEYS, "left")
               .join(favorite_genre(f, dim_content), DAY_KEYS, "left"))
    return per_day.select(F.col("event_date").alias("date"), *[
        c for c in DAILY_USER_BASE.fieldNames() if c != "date"])


def with_user_attrs(base: DataFrame, dim_user_current: DataFrame) -> DataFrame:
    """Attach the user's current attributes and the derived day measures
    (rolling sums that ``base`` has already stay)."""
    attrs = dim_user_current.select("user_id", *USER_ATTRS)
    d = base.join(attrs, "user_id", "left")
    return d.select(
        "date", "user_id", *USER_ATTRS,
        "preferred_device", "favorite_genre", "sessions_count", "total_watch_hours",
        "avg_completion_rate", "play_count", "pause_count", "stop_count", "finish_count",
        "unique_content_watched", "late_arrival_count",
        ratio_percent("finish_count", "sessions_count").alias("finish_rate"),
        days_since("date", "signup_date").alias("days_since_signup"),
        *[c for c in ROLLED if c in base.columns],
    )


def daily_user(fact: DataFrame, dim_user_current: DataFrame, dim_content: DataFrame) -> DataFrame:
    """Base features per user and day, with the user's current attributes."""
    return with_user_attrs(daily_user_base(fact, dim_content), dim_user_current)


def rolling_sum(key: str, day: str, col: str, days: int, scale: int | None = None) -> Column:
    """Sum of ``col`` over the inclusive day frame [day - days, day] per key.

    Ordered by ``unix_date`` so the RANGE frame counts calendar days.  With a
    ``scale`` the values are summed exactly as decimals and rounded.
    """
    w = Window.partitionBy(key).orderBy(F.unix_date(F.col(day))).rangeBetween(-days, 0)
    if scale is None:
        return F.sum(col).over(w)
    return F.round(exact_sum(col, scale).over(w), scale).cast("double")


def with_rolling(daily: DataFrame) -> DataFrame:
    return daily.select(
        "*",
        rolling_sum("user_id", "date", "sessions_count", 7).alias("sessions_7d"),
        rolling_sum("user_id", "date", "total_watch_hours", 7, scale=3).alias("watch_hours_7d"),
        rolling_sum("user_id", "date", "total_watch_hours", 30, scale=3).alias("watch_time_30d"),
    )


def days_reached(days: Iterable[_dt.date | None]) -> list[_dt.date | None]:
    """The days whose frames hold one of ``days``.  Rows without a day see each
    other only."""
    return _spread(days, range(LOOKBACK_DAYS + 1))


def days_seen(days: Iterable[_dt.date | None]) -> list[_dt.date | None]:
    """The days that the frames of ``days`` hold."""
    return _spread(days, range(-LOOKBACK_DAYS, 1))


def _spread(days: Iterable[_dt.date | None], by: range) -> list[_dt.date | None]:
    given = set(days)
    dated = {d + _dt.timedelta(days=k) for d in given if d is not None for k in by}
    return [None] * (None in given) + sorted(dated)


def rolled_of_days(base: DataFrame, days: list[_dt.date | None]) -> DataFrame:
    """``with_rolling`` of the rows of ``days`` alone: reads these days and the
    30 before each (static filters, partitions where ``base`` has them by day),
    however long the history is."""
    near = base.filter(among(F.col("date"), days_seen(days)))
    return with_rolling(near).filter(among(F.col("date"), days))


def churn_from_daily(daily: DataFrame, as_of: _dt.datetime | str) -> DataFrame:
    return _labelled(with_rolling(daily), as_of)


def _labelled(d: DataFrame, as_of: _dt.datetime | str) -> DataFrame:
    return d.select(
        "*",
        churn_label("finish_rate", "sessions_count", "days_since_signup").alias("churn_label"),
        as_of_ts(as_of).alias("ingestion_time"),
    ).select(*[f.name for f in CHURN_FEATURES.fields])


def churn_features(fact: DataFrame, dim_user_current: DataFrame, dim_content: DataFrame,
                   as_of: _dt.datetime | str) -> DataFrame:
    return churn_from_daily(daily_user(fact, dim_user_current, dim_content), as_of)


def churn_features_from_rolled(rolled: DataFrame, dim_user_current: DataFrame,
                               as_of: _dt.datetime | str) -> DataFrame:
    """Churn features from the stored user-days with their rolling sums: no
    window left, only the join with the current attributes."""
    return _labelled(with_user_attrs(rolled, dim_user_current), as_of)
