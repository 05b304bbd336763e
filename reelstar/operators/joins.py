"""Join helpers: a checked broadcast, and lookups of keys that hold a large share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension lookup side is broadcast only when it is proven to hold at most
# this many rows.  The projections broadcast here are 2-3 narrow columns
# (~50-100 bytes a row), so the bound keeps a broadcast below ~200 MB.
DEFAULT_BROADCAST_MAX_ROWS = 2_000_000


def has_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    A plain distributed count: every task counts its rows and only one
    number per task reaches the final aggregate.  (``limit(n + 1).count()``
    would instead move up to n + 1 rows from *every* partition into a single
    task before counting - the whole side, for a large one.)
    """
    return df.count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast only for a side proven small; otherwise leave the
    choice to the planner (sort-merge join, AQE may still switch at runtime
    from measured shuffle sizes and split skewed partitions)."""
    return F.broadcast(df) if has_at_most(df, max_rows) else df


def heavy_keys(df: DataFrame, key: str, share: float = 0.01, tracked: int = 1000) -> list:
    """Values of ``key`` that hold at least ``share`` of the rows.

    A top-k sketch per task, merged: at most ``tracked`` counters a task, and
    ``1 / share`` values come back.  Counts are estimates; they decide how a join
    is dealt, never its result.  NULL is no value here.
    """
    k = min(tracked, int(1 / share) + 1)
    found = df.agg(F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {k}, {tracked})").alias("top")).first()
    return [r["item"] for r in found["top"] or []
            if r["item"] is not None and r["count"] >= share * found["n"]] if found["n"] else []


def salted_lookup(rows: DataFrame, side: DataFrame, key: str, hot: list, salt_by: str,
                  salts: int | None = None) -> DataFrame:
    """``rows`` left-joined with ``side`` on ``key``, the same as a plain join.

    Rows of the ``hot`` keys, and of the NULL key, are dealt over ``salts`` parts
    by a hash of ``salt_by``; the side's rows of the hot keys (no others) are
    repeated for each part.  Every key else is joined as usual.  By default there
    are eight parts for each shuffle partition, so that they even out.
    """
    if not hot:
        return rows.join(side, key, "left")
    salts = salts or 8 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")
    salted = rows.withColumn("__salt", F.when(F.col(key).isin(hot) | F.col(key).isNull(), spread).otherwise(0))
    parts = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return salted.join(side.withColumn("__salt", F.explode(parts)), [key, "__salt"], "left").drop("__salt")
