"""Data-quality gate over the bronze tables.

One aggregation pass per table computes every count the checks need
(row count, NULL keys, distinct keys); the schema check compares the
table's schema with the expected one and needs no data pass at all.  The
report is a small DataFrame ``(table_name, check_name, total_rows,
violations, passed)``; :func:`assert_passed` turns failures into an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.aggregates import count_if
from ..schemas import BRONZE

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("violations", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])


@dataclass(frozen=True)
class Checks:
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()


# Primary keys of the bronze tables: NULL checks on every key, duplicate
# checks on the user and content keys.
DEFAULT_CHECKS: dict[str, Checks] = {
    "users": Checks(not_null=("user_id",), unique=("user_id",)),
    "content_catalog": Checks(not_null=("content_id",), unique=("content_id",)),
    "watch_events": Checks(not_null=("event_id",)),
    "ratings_late": Checks(not_null=("rating_id",)),
}


class DataQualityError(RuntimeError):
    pass


def schema_violations(actual: T.StructType, expected: T.StructType) -> int:
    """Expected columns that are missing or carry another type."""
    have = {f.name: f.dataType for f in actual.fields}
    return sum(1 for f in expected.fields if have.get(f.name) != f.dataType)


def table_report(name: str, df: DataFrame, checks: Checks,
                 expected: T.StructType | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("__total")]
    for c in checks.not_null:
        aggs.append(count_if(F.col(c).isNull()).alias(f"__null_{c}"))
    for c in checks.unique:
        aggs.append(F.count_distinct(F.col(c)).alias(f"__ndv_{c}"))
        if c not in checks.not_null:
            aggs.append(count_if(F.col(c).isNull()).alias(f"__null_{c}"))
    one = df.agg(*aggs)
    total = F.col("__total")
    rows = []
    for c in checks.not_null:
        rows.append((f"not_null:{c}", total, F.col(f"__null_{c}")))
    for c in checks.unique:
        # distinct() counts NULL as one value of its own
        distinct = F.col(f"__ndv_{c}") + F.when(F.col(f"__null_{c}") > 0, 1).otherwise(0)
        rows.append((f"unique:{c}", total, total - distinct))
    if expected is not None:
        v = schema_violations(df.schema, expected)
        rows.append(("schema", F.lit(len(expected.fields)).cast("long"), F.lit(v).cast("long")))
    structs = [
        F.struct(F.lit(name).alias("table_name"), F.lit(check).alias("check_name"),
                 tot.cast("long").alias("total_rows"), viol.cast("long").alias("violations"))
        for check, tot, viol in rows
    ]
    return (one.select(F.explode(F.array(*structs)).alias("r")).select("r.*")
            .withColumn("passed", F.col("violations") == 0))


def run_checks(tables: dict[str, DataFrame], checks: dict[str, Checks] | None = None,
               expected: dict[str, T.StructType] | None = None) -> DataFrame:
    checks = DEFAULT_CHECKS if checks is None else checks
    expected = BRONZE if expected is None else expected
    out = None
    for name, df in tables.items():
        rep = table_report(name, df, checks.get(name, Checks()), expected.get(name))
        out = rep if out is None else out.unionByName(rep)
    if out is None:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], REPORT_SCHEMA)
    return out


def assert_passed(report: DataFrame) -> list:
    """Raise :class:`DataQualityError` if any check failed.

    The report has one row per check, so collecting it is bounded.
    """
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        msg = "; ".join(f"{r['table_name']}.{r['check_name']}: {r['violations']} of {r['total_rows']}"
                        for r in failed)
        raise DataQualityError(f"data quality gate failed: {msg}")
    return rows
