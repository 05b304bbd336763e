"""Column expressions (all JVM-side, codegen friendly; no Python UDFs).

Every business rule of the engagement model lives here as a function from
Columns to a Column, so the table builders stay plain DataFrame plans.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the engagement model (must equal the original rules).
# Age bands: age < 25 -> "18-24", < 35 -> "25-34", < 45 -> "35-44",
#            < 55 -> "45-54", otherwise (including NULL age) -> "55+".
AGE_BANDS = [(25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54")]
AGE_BAND_ELSE = "55+"
# Device categories: smart_tv -> TV, desktop -> Computer, mobile -> Mobile,
#                    anything else (including NULL) -> Tablet.
DEVICE_CATEGORIES = [("smart_tv", "TV"), ("desktop", "Computer"), ("mobile", "Mobile")]
DEVICE_CATEGORY_ELSE = "Tablet"
# Late arrival: 300 s < ingestion delay < 172800 s (both strict).
LATE_MIN_SECONDS = 300
LATE_MAX_SECONDS = 172800
# Ratings are "within 48 h" when the delay is below 172800 s (no lower bound).
WITHIN_48H_SECONDS = 172800
# Unknown content duration falls back to a 60-minute (3600 s) title.
FALLBACK_DURATION_SECONDS = 3600
# Churn rule: finish_rate < 10, or sessions_count <= 1 and days_since_signup > 30.
CHURN_FINISH_RATE_BELOW = 10
CHURN_MAX_SESSIONS = 1
CHURN_MIN_DAYS_SINCE_SIGNUP = 30
# First version of every user in the initial SCD2 load starts on this day.
INITIAL_EFFECTIVE_FROM = "2020-01-01"
# Event types counted by the KPI tables.
EVENT_TYPES = ["play", "pause", "stop", "finish"]
# ---------------------------------------------------------------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def age_band(age: Column | str) -> Column:
    a = _c(age)
    expr = None
    for upper, label in AGE_BANDS:
        expr = F.when(a < upper, label) if expr is None else expr.when(a < upper, label)
    return expr.otherwise(AGE_BAND_ELSE)


def device_category(device_type: Column | str) -> Column:
    d = _c(device_type)
    expr = None
    for value, label in DEVICE_CATEGORIES:
        expr = F.when(d == value, label) if expr is None else expr.when(d == value, label)
    return expr.otherwise(DEVICE_CATEGORY_ELSE)


def epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds of a UTC wall-clock TIMESTAMP_NTZ, floored.

    Equals ``CAST(ts AS BIGINT)`` of the matching UTC instant, but does not
    depend on the session time zone.
    """
    us = F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _c(ts))
    # floor(us / 1e6) in integer arithmetic (exact for pre-1970 values too)
    return ((us - F.pmod(us, F.lit(1_000_000))) / F.lit(1_000_000)).cast("long")


def delay_seconds(ingestion_time: Column | str, event_time: Column | str) -> Column:
    """Whole-second ingestion delay: floor(ingest) - floor(event)."""
    return epoch_seconds(ingestion_time) - epoch_seconds(event_time)


def is_late_arrival(ingestion_time: Column | str, event_time: Column | str) -> Column:
    d = delay_seconds(ingestion_time, event_time)
    return (d > LATE_MIN_SECONDS) & (d < LATE_MAX_SECONDS)


def is_within_48h(ingestion_time: Column | str, event_time: Column | str) -> Column:
    return delay_seconds(ingestion_time, event_time) < WITHIN_48H_SECONDS


def completion_percent(watch_seconds: Column | str, duration_minutes: Column | str) -> Column:
    """round(sec / (minutes*60) * 100, 2); unknown duration -> 60 minutes.

    Not capped at 100.  A zero duration gives NULL (``try_divide``) instead
    of failing the job under ANSI mode.
    """
    sec, mins = _c(watch_seconds), _c(duration_minutes)
    known = F.round(F.try_divide(sec, mins * 60) * 100, 2)
    fallback = F.round(sec / F.lit(FALLBACK_DURATION_SECONDS) * 100, 2)
    return F.when(mins.isNotNull(), known).otherwise(fallback)


def churn_label(finish_rate: Column | str, sessions_count: Column | str,
                days_since_signup: Column | str) -> Column:
    return (
        F.when(_c(finish_rate) < CHURN_FINISH_RATE_BELOW, 1)
        .when((_c(sessions_count) <= CHURN_MAX_SESSIONS)
              & (_c(days_since_signup) > CHURN_MIN_DAYS_SINCE_SIGNUP), 1)
        .otherwise(0)
        .cast("int")
    )


def ratio_percent(part: Column | str, whole: Column | str, scale: int = 2) -> Column:
    """round(part / whole * 100, scale); NULL when whole is 0."""
    return F.round(F.try_divide(_c(part), _c(whole)) * 100, scale)


def parse_event_time(text: Column | str) -> Column:
    """ISO-8601 text (with offset) -> UTC wall-clock TIMESTAMP_NTZ.

    Malformed text gives NULL (``try_to_timestamp``), never a failed batch.
    """
    # the instant's microseconds, counted from the epoch on the UTC wall clock:
    # the session's local time, ambiguous when clocks go back, takes no part
    micros = F.unix_micros(F.try_to_timestamp(_c(text)))
    return F.timestamp_add("MICROSECOND", micros, F.expr(_EPOCH_NTZ))


def ntz_lit(value: _dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal of a UTC wall-clock datetime.

    Built from ISO text: ``F.lit(datetime)`` goes through the Python
    process's local zone and the session zone, so a driver whose OS zone
    differs from the session would shift every mark and stamp.  An aware
    datetime is first converted to UTC.
    """
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def as_of_ts(as_of: _dt.datetime | str) -> Column:
    """The injected clock as a TIMESTAMP_NTZ literal (one clock per run)."""
    return ntz_lit(as_of)


def as_of_date(as_of: _dt.datetime | str) -> Column:
    return F.to_date(as_of_ts(as_of))


def now_utc() -> _dt.datetime:
    """Default clock for production runs: captured once on the driver."""
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def date_attributes(date_key: Column | str) -> dict[str, Column]:
    """Calendar attributes of dim_time (day_of_week: Sunday = 1; ISO week)."""
    d = _c(date_key)
    return {
        "year": F.year(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "month": F.month(d).cast("int"),
        "day": F.dayofmonth(d).cast("int"),
        "day_of_week": F.dayofweek(d).cast("int"),
        "week_of_year": F.weekofyear(d).cast("int"),
    }


def days_since(later: Column | str, earlier_text: Column | str) -> Column:
    """datediff(later, to_date(text)); unparsable text gives NULL."""
    return F.datediff(_c(later), F.try_to_date(_c(earlier_text))).cast("int")
