"""Writing audit results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockaudit.sources.marks import mark, newest_mark

VIOLATION = "key STRING, detail STRING, check_id STRING"
REPORT = "check_id STRING, n BIGINT"


def write_audit_outputs(found: DataFrame, path: str) -> DataFrame:
    """Store violations (one folder per check) and the number per check as one run; returns the numbers, read back.

    Rows are rebalanced by check before writing: small checks share a task, and a check that holds most
    violations is split over many. The report counts what was stored, so the checks run once. A run is seen by
    ``read_audit_outputs`` once both are there; the runs before it stay.
    """
    spark = found.sparkSession
    last = newest_mark(spark, f"{path}/published")
    run = last.number + 1 if last else 0
    violations = f"{path}/violations/run={run}"
    found.hint("rebalance", "check_id").write.mode("overwrite").partitionBy("check_id").parquet(violations)
    counts = spark.read.schema(VIOLATION).parquet(violations).groupBy("check_id").agg(F.count(F.lit(1)).alias("n"))
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/report/run={run}")
    mark(spark, f"{path}/published", run)
    return read_audit_outputs(spark, path, run)[0]


def read_audit_outputs(spark: SparkSession, path: str, run: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The report and the violations of a published run, the newest unless one is named."""
    last = newest_mark(spark, f"{path}/published", run)
    if last is None or (run is not None and last.number != run):
        raise ValueError(f"no published run {'' if run is None else run} in {path}")
    return (spark.read.schema(REPORT).parquet(f"{path}/report/run={last.number}"),
            spark.read.schema(VIOLATION).parquet(f"{path}/violations/run={last.number}"))
