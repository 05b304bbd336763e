"""Dense, deterministic surrogate keys without a single-partition window.

``row_number() OVER (ORDER BY k)`` would pull every row into one task.  Here
the rows are range-partitioned and sorted on the key columns, the layout is
fixed by a reliable checkpoint (range bounds are sampled, so the counting pass
and the numbering pass must see the same partitions), per-partition counts
give each partition its offset, and every row gets
``base + offset(partition) + position in partition + 1``.  The only data that
leaves the executors is one count per partition.

Result equals ``base + row_number() OVER (ORDER BY k)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position


def allocate_keys(df: DataFrame, order_cols: list[str], key_col: str, base: int = 0) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    laid_out = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols).checkpoint(eager=True)
    with_pos = laid_out.select(
        "*",
        F.spark_partition_id().alias("__pid"),
        F.monotonically_increasing_id().alias("__mid"),
    )
    counts = with_pos.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # One row per partition: the running total over them is bounded by the
    # partition count, never by the data size.
    offsets = counts.select(
        "__pid",
        (F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("__n"))
        .alias("__offset"),
    )
    pos = F.col("__mid") - F.shiftleft(F.col("__pid").cast("long"), _POS_BITS)
    keyed = with_pos.join(F.broadcast(offsets), "__pid").withColumn(
        key_col, (F.lit(base).cast("long") + F.col("__offset") + pos + 1).cast("long")
    )
    return keyed.drop("__pid", "__mid", "__offset")
