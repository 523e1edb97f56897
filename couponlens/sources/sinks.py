"""Report and feature-table sinks (S4, S5), and plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType([
    T.StructField("key", T.StringType(), True),
    T.StructField("series", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
])


def long_form(report: DataFrame, key: str | None) -> DataFrame:
    """``(key, series, value)``: each other column is a series; ``key`` None means a report of one row, keyed ``all``.

    Keys are written as text and values as doubles, so that reports keyed by
    days, rates or weekdays, counting or giving shares, have one schema.
    """
    name = F.lit("all") if key is None else F.col(key).cast("string")
    series = [c for c in report.columns if c != key]
    return (report.select(name.alias("key"), *[F.col(c).cast("double").alias(c) for c in series])
            .unpivot("key", series, "series", "value"))


def write_report(df: DataFrame, path: str, key: str | None) -> None:
    """A report (a few rows per key) in long form, as parquet."""
    write_table(long_form(df, key), path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, REPORT_SCHEMA)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written table; the schema is given, so an empty one reads back too."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_features(df: DataFrame, path: str) -> None:
    """The feature table, one folder per receipt day.

    Rebalanced by day before the write (see ``receipts.write_receipts``):
    few folders per task, and AQE splits a hot day across tasks.
    """
    (df.hint("rebalance", "date_received")
       .write.mode("overwrite").partitionBy("date_received").parquet(path))


def read_features(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_table(spark, path, schema)
