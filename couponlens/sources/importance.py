"""Importance table source and sink (S2, S3): headerless ``feature,importance`` CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType(), False),
    T.StructField("importance", T.DoubleType(), False),
])


def read_importance(spark: SparkSession, path: str) -> DataFrame:
    """Read the importance CSV with a fixed schema (no header, no inference)."""
    return spark.read.schema(IMPORTANCE_SCHEMA).option("header", "false").csv(path)


def write_importance(df: DataFrame, path: str) -> None:
    """S3: write importance sorted by score, descending, as one headerless file.

    One file is right here: the table has one row per model feature (56),
    a bound that does not grow with the data.
    """
    (df.orderBy(F.desc("importance"), F.asc("feature")).coalesce(1)
       .write.mode("overwrite").option("header", "false").csv(path))
