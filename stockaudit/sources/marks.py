"""Commit marks: a folder with a file of one row for each finished state of a table.

A file appears whole or not at all. Whoever writes first stores the data where no mark points yet and then sets the
mark; whoever reads follows the newest mark, and so never sees half of a write. There is one writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

MARK = "number BIGINT, version BIGINT"


def mark(spark: SparkSession, folder: str, number: int, version: int = -1) -> None:
    """State ``number`` is complete; ``version`` names what it builds on."""
    row = spark.range(0, 1, 1, 1).select(F.lit(number).cast("bigint").alias("number"), F.lit(version).cast("bigint").alias("version"))
    row.write.mode("append").parquet(folder)


def newest_mark(spark: SparkSession, folder: str, upto: int | None = None) -> Row | None:
    """The newest (number, version), or the newest that isn't beyond ``upto``; None if there is none."""
    marks = read_if_there(spark, folder, MARK)
    if marks is None:
        return None
    marks = marks if upto is None else marks.filter(F.col("number") <= upto)
    return marks.agg(F.max(F.struct("number", "version")).alias("newest")).first()["newest"]


def read_if_there(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """The Parquet files below ``folder``, or None as long as nothing has been written there."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
