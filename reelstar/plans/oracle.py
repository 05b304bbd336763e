"""Independent SQL (DuckDB dialect) for every registered query.

Each statement is ``WITH <bindings>, <shared CTEs> <query>`` over the driver
tables.  Recipes that make two engines agree bit for bit:

* ``round(double, n)`` in Spark is HALF_UP on the shortest decimal text of
  the double, so the oracle rounds ``CAST(CAST(x AS VARCHAR) AS DECIMAL)``;
* averages of 2-decimal values are exact: HALF_UP in integer hundredths;
* sums of rounded values are decimal sums on both sides;
* the mode's tie-break is "largest value, NULL lowest";
* ``dayofweek`` is Sunday = 1 (DuckDB counts from 0), sums are cast back to
  BIGINT, date differences to INTEGER.
"""

from __future__ import annotations

from ..sources.fixtures import ORACLE_BINDINGS

AS_OF = "TIMESTAMP '2024-02-05 00:00:00'"
AS_OF_DATE = "DATE '2024-02-05'"
DAY1 = "TIMESTAMP '2024-02-04 00:00:00'"
PREVIOUS_RUN = "TIMESTAMP '2024-01-20 00:00:00'"


def r(x: str, n: int) -> str:
    """Spark's HALF_UP rounding of a double."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {n}) AS DOUBLE)"


def avg2(col: str) -> str:
    """round(avg(col), 2) of 2-decimal values, exactly (HALF_UP)."""
    s = f"CAST(sum(CAST({col} AS DECIMAL(18,2))) * 100 AS BIGINT)"
    n = f"count({col})"
    return (f"CASE WHEN {n} = 0 THEN NULL ELSE "
            f"sign({s}) * ((2 * abs({s}) + {n}) // (2 * {n})) / 100 END")


def pct(part: str, whole: str, n: int = 2) -> str:
    return f"CASE WHEN ({whole}) = 0 THEN NULL ELSE {r(f'({part}) / ({whole}) * 100', n)} END"


def secs(ts: str) -> str:
    return f"CAST(floor(epoch_us({ts}) / 1000000) AS BIGINT)"


AGE_BAND = ("CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44' "
            "WHEN age < 55 THEN '45-54' ELSE '55+' END")
DIM_USER_COLS = ("user_key, user_id, username, email, age, age_band, country, subscription_tier, "
                 "signup_date, effective_from, effective_to, is_current, ingestion_time")
SNAP_COLS = "user_id, username, email, age, age_band, country, subscription_tier, signup_date"

SHARED = f"""
watch_sec AS (
  SELECT w.*, {secs('w.ingestion_time')} - {secs('w.event_time')} AS delay_s FROM watch_events w),
sessions_o AS (
  SELECT w.session_id, w.user_id, w.content_id, w.event_type, w.device_type, w.watch_duration_seconds,
         CASE WHEN c.duration_minutes IS NOT NULL
              THEN CASE WHEN c.duration_minutes = 0 THEN NULL
                        ELSE {r('w.watch_duration_seconds / (c.duration_minutes * 60) * 100', 2)} END
              ELSE {r('w.watch_duration_seconds / 3600 * 100', 2)} END AS completion_percent,
         w.event_time, {AS_OF} AS ingestion_time,
         (w.delay_s > 300 AND w.delay_s < 172800) AS is_late_arrival,
         {AS_OF_DATE} AS processing_date, w.event_id, w.ingestion_time AS source_ingestion_time
  FROM watch_sec w LEFT JOIN content_catalog c ON w.content_id = c.content_id),
users_banded AS (
  SELECT user_id, username, email, age, {AGE_BAND} AS age_band, country, subscription_tier, signup_date
  FROM users),
v2_banded AS (
  SELECT user_id, username, email, age, {AGE_BAND} AS age_band, country, subscription_tier, signup_date
  FROM users_v2),
dim_user_init AS (
  SELECT CAST(row_number() OVER (ORDER BY user_id) AS BIGINT) AS user_key, {SNAP_COLS},
         DATE '2020-01-01' AS effective_from, CAST(NULL AS DATE) AS effective_to, TRUE AS is_current,
         {DAY1} AS ingestion_time
  FROM users_banded),
changed_o AS (
  SELECT n.user_id, o.subscription_tier AS old_subscription_tier, n.subscription_tier AS new_subscription_tier,
         o.country AS old_country, n.country AS new_country
  FROM v2_banded n JOIN dim_user_init o ON n.user_id = o.user_id
  WHERE n.subscription_tier IS DISTINCT FROM o.subscription_tier OR n.country IS DISTINCT FROM o.country),
applied_o AS (
  SELECT {DIM_USER_COLS} FROM dim_user_init WHERE user_id NOT IN (SELECT user_id FROM changed_o)
  UNION ALL
  SELECT user_key, {SNAP_COLS}, effective_from, {AS_OF_DATE} AS effective_to, FALSE AS is_current,
         {AS_OF} AS ingestion_time
  FROM dim_user_init WHERE user_id IN (SELECT user_id FROM changed_o)
  UNION ALL
  SELECT CAST((SELECT max(user_key) FROM dim_user_init) + row_number() OVER (ORDER BY user_id) AS BIGINT),
         {SNAP_COLS}, {AS_OF_DATE}, CAST(NULL AS DATE), TRUE, {AS_OF}
  FROM v2_banded
  WHERE user_id IN (SELECT user_id FROM changed_o) OR user_id NOT IN (SELECT user_id FROM dim_user_init)),
fact_o AS (
  SELECT s.session_id, d.user_key, s.user_id, s.content_id, s.event_type, s.device_type,
         s.watch_duration_seconds, s.completion_percent, s.is_late_arrival,
         CAST(s.event_time AS DATE) AS event_date, s.event_time, {AS_OF} AS ingestion_time,
         s.ingestion_time AS source_ingestion_time
  FROM sessions_o s LEFT JOIN dim_user_init d ON s.user_id = d.user_id)
"""


def daily_sql(fact: str, stamp: str = AS_OF, where: str = "TRUE") -> str:
    return f"""
SELECT event_date AS date, total_users, total_sessions, total_watch_hours, avg_watch_time_minutes,
       avg_completion_rate, total_play_events, total_finish_events,
       {pct('total_finish_events', 'total_sessions')} AS finish_rate, {stamp} AS ingestion_time
FROM (
  SELECT event_date,
         CAST(count(DISTINCT user_id) AS BIGINT) AS total_users,
         CAST(count(session_id) AS BIGINT) AS total_sessions,
         {r('sum(watch_duration_seconds) / 3600', 2)} AS total_watch_hours,
         {r('avg(watch_duration_seconds) / 60', 2)} AS avg_watch_time_minutes,
         {avg2('completion_percent')} AS avg_completion_rate,
         CAST(count(CASE WHEN event_type = 'play' THEN 1 END) AS BIGINT) AS total_play_events,
         CAST(count(CASE WHEN event_type = 'finish' THEN 1 END) AS BIGINT) AS total_finish_events
  FROM {fact} WHERE {where} GROUP BY event_date) t"""


def mode_cte(name: str, src: str, value: str, out: str) -> str:
    return f"""
{name}_n AS (SELECT user_id, event_date, {value} AS v, count(session_id) AS n FROM {src} GROUP BY 1, 2, 3),
{name} AS (
  SELECT user_id, event_date, v AS {out} FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_date ORDER BY n DESC, v DESC NULLS LAST) AS rn
    FROM {name}_n) WHERE rn = 1)"""


def daily_user_ctes(fact: str, users: str) -> str:
    """CTEs ``du`` (daily_user), ``roll`` (with rolling sums) over ``fact``."""
    return f"""
fact_g AS (SELECT f.*, c.genre FROM {fact} f LEFT JOIN content_catalog c ON f.content_id = c.content_id),
{mode_cte('dev', fact, 'device_type', 'preferred_device')},
{mode_cte('gen', 'fact_g', 'genre', 'favorite_genre')},
base AS (
  SELECT user_id, event_date,
         CAST(count(session_id) AS BIGINT) AS sessions_count,
         {r('sum(watch_duration_seconds) / 3600', 3)} AS total_watch_hours,
         {avg2('completion_percent')} AS avg_completion_rate,
         CAST(count(CASE WHEN event_type = 'play' THEN 1 END) AS BIGINT) AS play_count,
         CAST(count(CASE WHEN event_type = 'pause' THEN 1 END) AS BIGINT) AS pause_count,
         CAST(count(CASE WHEN event_type = 'stop' THEN 1 END) AS BIGINT) AS stop_count,
         CAST(count(CASE WHEN event_type = 'finish' THEN 1 END) AS BIGINT) AS finish_count,
         CAST(count(DISTINCT content_id) AS BIGINT) AS unique_content_watched,
         CAST(count(CASE WHEN is_late_arrival THEN 1 END) AS BIGINT) AS late_arrival_count
  FROM {fact} GROUP BY user_id, event_date),
du AS (
  SELECT b.event_date AS date, b.user_id, u.age_band, u.subscription_tier, u.country, u.signup_date,
         dv.preferred_device, g.favorite_genre, b.sessions_count, b.total_watch_hours,
         b.avg_completion_rate, b.play_count, b.pause_count, b.stop_count, b.finish_count,
         b.unique_content_watched, b.late_arrival_count,
         {pct('b.finish_count', 'b.sessions_count')} AS finish_rate,
         CAST(b.event_date - TRY_CAST(u.signup_date AS DATE) AS INTEGER) AS days_since_signup
  FROM base b
  LEFT JOIN dev dv ON b.user_id = dv.user_id AND b.event_date = dv.event_date
  LEFT JOIN gen g ON b.user_id = g.user_id AND b.event_date = g.event_date
  LEFT JOIN {users} u ON b.user_id = u.user_id),
roll AS (
  SELECT du.* EXCLUDE (dn),
         CAST(sum(sessions_count) OVER w7 AS BIGINT) AS sessions_7d,
         CAST(round(sum(CAST(total_watch_hours AS DECIMAL(18,3))) OVER w7, 3) AS DOUBLE) AS watch_hours_7d,
         CAST(round(sum(CAST(total_watch_hours AS DECIMAL(18,3))) OVER w30, 3) AS DOUBLE) AS watch_time_30d,
         CASE WHEN finish_rate < 10 THEN 1
              WHEN sessions_count <= 1 AND days_since_signup > 30 THEN 1 ELSE 0 END AS churn_label
  FROM (SELECT *, date_diff('day', DATE '1970-01-01', date) AS dn FROM du) du
  WINDOW w7 AS (PARTITION BY user_id ORDER BY dn RANGE BETWEEN 7 PRECEDING AND CURRENT ROW),
         w30 AS (PARTITION BY user_id ORDER BY dn RANGE BETWEEN 30 PRECEDING AND CURRENT ROW))"""


CHURN_COLS = ("date, user_id, age_band, subscription_tier, country, days_since_signup, sessions_count, "
              "total_watch_hours, watch_time_30d, avg_completion_rate, finish_rate, play_count, pause_count, "
              "stop_count, finish_count, unique_content_watched, sessions_7d, watch_hours_7d, favorite_genre, "
              "preferred_device, late_arrival_count, CAST(churn_label AS INTEGER) AS churn_label")

WATCH_OUT = ("event_id, user_id, content_id, event_type, device_type, session_id, watch_duration_seconds, "
             "event_time")
RATINGS_OUT = "rating_id, user_id, content_id, rating_value, event_time"

DQ = """
SELECT table_name, check_name, CAST(total_rows AS BIGINT) AS total_rows,
       CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM (
  SELECT 'users' AS table_name, 'not_null:user_id' AS check_name, count(*) AS total_rows,
         count(*) FILTER (WHERE user_id IS NULL) AS violations FROM users
  UNION ALL
  SELECT 'users', 'unique:user_id', count(*), count(*) - count(DISTINCT user_id)
         - CASE WHEN count(*) FILTER (WHERE user_id IS NULL) > 0 THEN 1 ELSE 0 END FROM users
  UNION ALL SELECT 'users', 'schema', 8, 0
  UNION ALL
  SELECT 'content_catalog', 'not_null:content_id', count(*),
         count(*) FILTER (WHERE content_id IS NULL) FROM content_catalog
  UNION ALL
  SELECT 'content_catalog', 'unique:content_id', count(*), count(*) - count(DISTINCT content_id)
         - CASE WHEN count(*) FILTER (WHERE content_id IS NULL) > 0 THEN 1 ELSE 0 END FROM content_catalog
  UNION ALL SELECT 'content_catalog', 'schema', 7, 0
  UNION ALL
  SELECT 'watch_events', 'not_null:event_id', count(*), count(*) FILTER (WHERE event_id IS NULL)
  FROM watch_events
  UNION ALL SELECT 'watch_events', 'schema', 9, 0
  UNION ALL
  SELECT 'ratings_late', 'not_null:rating_id', count(*), count(*) FILTER (WHERE rating_id IS NULL)
  FROM ratings_late
  UNION ALL SELECT 'ratings_late', 'schema', 6, 0) t"""

DIM_TIME = f"""
SELECT d AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       {AS_OF} AS ingestion_time
FROM (SELECT DISTINCT CAST(event_time AS DATE) AS d FROM watch_events) t"""

HWM = f"(SELECT max(ingestion_time) FROM watch_events WHERE ingestion_time < {PREVIOUS_RUN})"

BODIES: dict[str, str] = {
    "json_parse_watch": f"SELECT {WATCH_OUT}, {AS_OF} AS ingestion_time FROM watch_events",
    "json_parse_ratings": f"SELECT {RATINGS_OUT}, {AS_OF} AS ingestion_time FROM ratings_late",
    "stream_watch_ingest": f"SELECT {WATCH_OUT}, {AS_OF} AS ingestion_time FROM watch_events",
    "stream_compacted": f"SELECT {WATCH_OUT}, {AS_OF} AS ingestion_time FROM watch_events",
    "stream_ratings_ingest": f"SELECT {RATINGS_OUT}, {AS_OF} AS ingestion_time FROM ratings_late",
    "append_if_empty": "SELECT * FROM content_catalog",
    "ddl_insert_select": "SELECT * FROM watch_events",
    "dq_report": DQ,
    "age_band": "SELECT user_id, age, age_band FROM users_banded",
    "scd2_initial": f"SELECT {DIM_USER_COLS} FROM dim_user_init",
    "scd2_changes": "SELECT * FROM changed_o",
    "scd2_apply": f"SELECT {DIM_USER_COLS} FROM applied_o",
    "scd2_current": f"SELECT {DIM_USER_COLS} FROM applied_o WHERE is_current",
    "dim_content": ("SELECT content_id, title, genre, release_date, duration_minutes, language, "
                    f"{AS_OF} AS ingestion_time FROM content_catalog"),
    "dim_time_full": DIM_TIME,
    "dim_time_incremental": DIM_TIME + (" WHERE d NOT IN (SELECT DISTINCT CAST(event_time AS DATE) "
                                        "FROM watch_events WHERE event_time < TIMESTAMP '2024-01-15 00:00:00')"),
    "dim_device": ("SELECT device_type, CASE WHEN device_type = 'smart_tv' THEN 'TV' "
                   "WHEN device_type = 'desktop' THEN 'Computer' WHEN device_type = 'mobile' THEN 'Mobile' "
                   f"ELSE 'Tablet' END AS device_category, {AS_OF} AS ingestion_time "
                   "FROM (SELECT DISTINCT device_type FROM watch_events) t"),
    "hwm": f"SELECT {HWM} AS hwm",
    "incremental_scan": f"SELECT * FROM watch_events WHERE ingestion_time > {HWM}",
    "late_arrival": ("SELECT event_id, delay_s AS delay_seconds, "
                     "(delay_s > 300 AND delay_s < 172800) AS is_late_arrival FROM watch_sec"),
    "completion_percent": ("SELECT s.event_id, s.watch_duration_seconds, c.duration_minutes, s.completion_percent "
                           "FROM sessions_o s LEFT JOIN content_catalog c ON s.content_id = c.content_id"),
    "watch_sessions": "SELECT * FROM sessions_o",
    "ratings_48h": (f"SELECT rating_id, user_id, content_id, rating_value, event_time, {AS_OF} AS ingestion_time, "
                    f"({secs('ingestion_time')} - {secs('event_time')}) < 172800 AS is_within_48h, "
                    "ingestion_time AS source_ingestion_time FROM ratings_late"),
    "fact_watch_sessions": "SELECT * FROM fact_o",
    "daily_engagement": daily_sql("fact_o"),
    # however the runs were cut or repeated, the KPIs are those of all events
    "same_clock_rerun": daily_sql("fact_o"),
    "reload_after_truncate": daily_sql("fact_o"),
    "event_mix": """
SELECT event_date AS date, CAST(count(session_id) AS BIGINT) AS total_sessions,
       CAST(count(CASE WHEN event_type = 'play' THEN 1 END) AS BIGINT) AS play_events,
       CAST(count(CASE WHEN event_type = 'pause' THEN 1 END) AS BIGINT) AS pause_events,
       CAST(count(CASE WHEN event_type = 'stop' THEN 1 END) AS BIGINT) AS stop_events,
       CAST(count(CASE WHEN event_type = 'finish' THEN 1 END) AS BIGINT) AS finish_events,
       CAST(count(CASE WHEN event_type IS NULL OR event_type NOT IN ('play', 'pause', 'stop', 'finish')
                  THEN 1 END) AS BIGINT) AS other_events
FROM fact_o GROUP BY event_date""",
    "distinct_users": ("SELECT event_date AS date, CAST(count(DISTINCT user_id) AS BIGINT) AS total_users, "
                       "CAST(count(DISTINCT content_id) AS BIGINT) AS total_titles FROM fact_o GROUP BY event_date"),
    "top_days": f"SELECT * FROM ({daily_sql('fact_o')}) d ORDER BY date LIMIT 5",
    "replace_all": daily_sql("fact_o", AS_OF, "event_date >= DATE '2024-01-03'"),
    # day 2 recomputes (and re-stamps) only the event days that received new facts
    "two_day_daily": daily_sql(
        "fact_o",
        f"CASE WHEN event_date IN (SELECT DISTINCT CAST(event_time AS DATE) FROM watch_events "
        f"WHERE ingestion_time >= {PREVIOUS_RUN}) THEN {AS_OF} ELSE {DAY1} END"),
}

# two-day run: rows ingested before PREVIOUS_RUN were loaded on day 1 (stamped
# DAY1, key of the initial user version), the rest on day 2 (stamped AS_OF,
# key of the version current after the SCD2 apply)
_EARLY = f"s.source_ingestion_time < {PREVIOUS_RUN}"
BODIES["pipeline_end_to_end"] = f"""
SELECT s.session_id, CASE WHEN {_EARLY} THEN d1.user_key ELSE d2.user_key END AS user_key,
       s.user_id, s.content_id, s.event_type, s.device_type, s.watch_duration_seconds,
       s.completion_percent, s.is_late_arrival, CAST(s.event_time AS DATE) AS event_date, s.event_time,
       CASE WHEN {_EARLY} THEN {DAY1} ELSE {AS_OF} END AS ingestion_time,
       CASE WHEN {_EARLY} THEN {DAY1} ELSE {AS_OF} END AS source_ingestion_time
FROM sessions_o s
LEFT JOIN dim_user_init d1 ON s.user_id = d1.user_id
LEFT JOIN (SELECT user_id, user_key FROM applied_o WHERE is_current) d2 ON s.user_id = d2.user_id"""

# every event once, and one in seven twice more, one and two days later
def _again(days: int) -> str:
    delay = f"(w.delay_s + {days} * 86400)"
    return (f"SELECT f.* REPLACE (({delay} > 300 AND {delay} < 172800) AS is_late_arrival) FROM fact_o f "
            "JOIN watch_sec w ON f.session_id = w.session_id WHERE CAST(w.event_id AS BIGINT) % 7 = 0")


FACT_AGAIN = f"fact_again AS (SELECT * FROM fact_o UNION ALL {_again(1)} UNION ALL {_again(2)})"

_DU_USERS_D1 = "dim_user_init"
FEATURE_BODIES: dict[str, tuple[str, str]] = {
    "preferred_device": (_DU_USERS_D1, "SELECT * FROM dev"),
    "favorite_genre": (_DU_USERS_D1, "SELECT * FROM gen"),
    "daily_user": (_DU_USERS_D1, "SELECT * FROM du"),
    "rolling_7d": (_DU_USERS_D1, "SELECT date, user_id, sessions_count, sessions_7d, watch_hours_7d FROM roll"),
    "rolling_30d": (_DU_USERS_D1, "SELECT date, user_id, total_watch_hours, watch_time_30d FROM roll"),
    "churn_label": (_DU_USERS_D1, ("SELECT date, user_id, finish_rate, sessions_count, days_since_signup, "
                                   "CAST(churn_label AS INTEGER) AS churn_label FROM roll")),
    "churn_features": (_DU_USERS_D1, f"SELECT {CHURN_COLS}, {AS_OF} AS ingestion_time FROM roll"),
    "two_day_churn": ("v2_banded", f"SELECT {CHURN_COLS}, {AS_OF} AS ingestion_time FROM roll"),
}


def oracle_sql() -> dict[str, str]:
    out = {k: f"WITH {ORACLE_BINDINGS.strip()},\n{SHARED.strip()}\n{body}" for k, body in BODIES.items()}
    for k, (users, body) in FEATURE_BODIES.items():
        out[k] = (f"WITH {ORACLE_BINDINGS.strip()},\n{SHARED.strip()},\n"
                  f"{daily_user_ctes('fact_o', users).strip()}\n{body}")
    again = f"WITH {ORACLE_BINDINGS.strip()},\n{SHARED.strip()},\n{FACT_AGAIN}"
    out["repeated_ids_in_increments"] = f"{again} SELECT * EXCLUDE (ingestion_time) FROM ({daily_sql('fact_again')})"
    out["backfill_churn"] = f"{again},\n{daily_user_ctes('fact_again', _DU_USERS_D1).strip()}\nSELECT {CHURN_COLS} FROM roll"
    return out
