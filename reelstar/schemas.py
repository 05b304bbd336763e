"""Explicit schemas of every layer (nothing is inferred).

Timestamps are ``TIMESTAMP_NTZ`` holding UTC wall-clock time, so no result
depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()
DATE, TS = T.DateType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    out = []
    for f in fields:
        name, dtype = f[0], f[1]
        nullable = f[2] if len(f) > 2 else True
        out.append(T.StructField(name, dtype, nullable))
    return T.StructType(out)


# --- stream payloads (JSON values of the two topics) ------------------------
WATCH_JSON = _struct(
    ("event_id", S), ("user_id", S), ("content_id", S), ("event_type", S),
    ("device_type", S), ("session_id", S), ("watch_duration_seconds", I),
    ("event_time", S),
)
RATINGS_JSON = _struct(
    ("rating_id", S), ("user_id", S), ("content_id", S), ("rating_value", I),
    ("event_time", S),
)

# --- bronze ------------------------------------------------------------------
BRONZE_USERS = _struct(
    ("user_id", S, False), ("username", S), ("email", S), ("age", I), ("country", S),
    ("subscription_tier", S), ("signup_date", S), ("ingestion_time", TS),
)
BRONZE_CONTENT = _struct(
    ("content_id", S, False), ("title", S), ("genre", S), ("release_date", S),
    ("duration_minutes", I), ("language", S), ("ingestion_time", TS),
)
BRONZE_WATCH = _struct(
    ("event_id", S), ("user_id", S), ("content_id", S), ("event_type", S),
    ("device_type", S), ("session_id", S), ("watch_duration_seconds", I),
    ("event_time", TS), ("ingestion_time", TS),
)
BRONZE_RATINGS = _struct(
    ("rating_id", S), ("user_id", S), ("content_id", S), ("rating_value", I),
    ("event_time", TS), ("ingestion_time", TS),
)

# --- silver --------------------------------------------------------------------
DIM_USER = _struct(
    ("user_key", L), ("user_id", S, False), ("username", S), ("email", S), ("age", I),
    ("age_band", S), ("country", S), ("subscription_tier", S), ("signup_date", S),
    ("effective_from", DATE, False), ("effective_to", DATE), ("is_current", B, False),
    ("ingestion_time", TS),
)
DIM_CONTENT = BRONZE_CONTENT
DIM_TIME = _struct(
    ("date_key", DATE, False), ("year", I), ("quarter", I), ("month", I), ("day", I),
    ("day_of_week", I), ("week_of_year", I), ("ingestion_time", TS),
)
DIM_DEVICE = _struct(("device_type", S, False), ("device_category", S), ("ingestion_time", TS))

# watch_sessions keeps event_id and the bronze ingestion time next to the
# re-stamped processing time so the next incremental run can use a
# high-water mark on the *source* clock.
WATCH_SESSIONS = _struct(
    ("session_id", S), ("user_id", S), ("content_id", S), ("event_type", S),
    ("device_type", S), ("watch_duration_seconds", I), ("completion_percent", D),
    ("event_time", TS), ("ingestion_time", TS), ("is_late_arrival", B),
    ("processing_date", DATE), ("event_id", S), ("source_ingestion_time", TS),
)
RATINGS = _struct(
    ("rating_id", S), ("user_id", S), ("content_id", S), ("rating_value", I),
    ("event_time", TS), ("ingestion_time", TS), ("is_within_48h", B),
    ("source_ingestion_time", TS),
)

# --- gold ----------------------------------------------------------------------
FACT_WATCH = _struct(
    ("session_id", S), ("user_key", L), ("user_id", S), ("content_id", S),
    ("event_type", S), ("device_type", S), ("watch_duration_seconds", I),
    ("completion_percent", D), ("is_late_arrival", B), ("event_date", DATE),
    ("event_time", TS), ("ingestion_time", TS), ("source_ingestion_time", TS), ("event_id", S),
)
DAILY_ENGAGEMENT = _struct(
    ("date", DATE), ("total_users", L), ("total_sessions", L), ("total_watch_hours", D),
    ("avg_watch_time_minutes", D), ("avg_completion_rate", D), ("total_play_events", L),
    ("total_finish_events", L), ("finish_rate", D), ("ingestion_time", TS),
)
CHURN_FEATURES = _struct(
    ("date", DATE), ("user_id", S), ("age_band", S), ("subscription_tier", S),
    ("country", S), ("days_since_signup", I), ("sessions_count", L),
    ("total_watch_hours", D), ("watch_time_30d", D), ("avg_completion_rate", D),
    ("finish_rate", D), ("play_count", L), ("pause_count", L), ("stop_count", L),
    ("finish_count", L), ("unique_content_watched", L), ("sessions_7d", L),
    ("watch_hours_7d", D), ("favorite_genre", S), ("preferred_device", S),
    ("late_arrival_count", L), ("churn_label", I), ("ingestion_time", TS),
)

# Per user and event day, before the user's attributes are attached: the
# roll-up the churn features are rebuilt from (one row per active user-day).
DAILY_USER_BASE = _struct(
    ("date", DATE), ("user_id", S), ("preferred_device", S), ("favorite_genre", S),
    ("sessions_count", L), ("total_watch_hours", D), ("avg_completion_rate", D),
    ("play_count", L), ("pause_count", L), ("stop_count", L), ("finish_count", L),
    ("unique_content_watched", L), ("late_arrival_count", L),
)
# The same with the rolling sums of the user up to the day.
DAILY_USER_ROLLED = T.StructType([
    *DAILY_USER_BASE.fields, *_struct(("sessions_7d", L), ("watch_hours_7d", D), ("watch_time_30d", D)).fields])

CONNECTIVITY_TEST = _struct(("id", L), ("message", S), ("ts", TS))

# Expected bronze schemas used by the schema-validation check of the DQ gate.
BRONZE = {
    "users": BRONZE_USERS,
    "content_catalog": BRONZE_CONTENT,
    "watch_events": BRONZE_WATCH,
    "ratings_late": BRONZE_RATINGS,
}


def ddl(schema: T.StructType) -> str:
    """Column list for ``CREATE TABLE`` (keeps NOT NULL)."""
    cols = []
    for f in schema.fields:
        cols.append(f"{f.name} {f.dataType.simpleString().upper()}" + ("" if f.nullable else " NOT NULL"))
    return ", ".join(cols)
