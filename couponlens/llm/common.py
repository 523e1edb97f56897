"""Helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.plans.stage import new_folder

#: Name of the row number that operators add to the columns they select.
ROW = "__row"
#: Row numbers that are broadcast at most: 8 MB.
BROADCAST_ROWS = 1 << 20
#: A word: a run of characters other than the space and the ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the session's shared folder and read back.

    Cuts the lineage: what a lost executor held is read again, not computed
    again, and several consumers see the same rows. The folder goes when the
    application ends.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spare_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as it takes to differ from all columns of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, name: str = ROW) -> DataFrame:
    """``df`` with a unique row number, so that repeated rows stay apart.

    The number follows the partitions of ``df``. Reading the same files
    twice gives the same numbers; anything less stable (a shuffle, a
    streaming source) has to be stored first.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def whole_text(col: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def without(df: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``df`` (a table as read from files) whose row number is not in ``dropped``; its columns may have any name.

    Up to ``BROADCAST_ROWS`` dropped numbers go to the rows; beyond that both
    sides are shuffled.
    """
    row = spare_name(df, ROW)
    gone = stored(dropped.select(F.col(ROW).alias(row)), "dropped")
    few = gone.count() <= BROADCAST_ROWS
    return numbered(df, row).join(F.broadcast(gone) if few else gone, row, "left_anti").drop(row)
