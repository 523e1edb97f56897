"""Rank, count and first/last operators over partitions (W1..W4).

None of these runs a window over raw receipts: a partition key that holds
a third of all rows would put that third into one task. Rows are first
aggregated to ``(keys, value) -> t`` (partial aggregation absorbs hot
keys); the window then runs over distinct values per key only, which is
bounded by the value domain (31 days, 11 distances, a few dozen rates),
and the result is joined back. Average-tie rank from the counts:

    asc  = (rows of the key with a smaller value) + (t + 1) / 2
         = cum - (t - 1) / 2,   cum = running sum of t in value order
    desc = n + 1 - asc,         n   = non-NULL rows of the key

NULL values rank NULL and are not counted in ``n``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def frames(keys: Sequence[str], value: str) -> tuple[Window, Window, Window]:
    """Frames over ``keys`` ordered by ``value``: (up to the row, its peers, whole).

    All three share partitioning and order, so every expression over them is
    evaluated by one Window operator after one sort.
    """
    ordered = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    return (ordered.rangeBetween(Window.unboundedPreceding, Window.currentRow),
            ordered.rangeBetween(Window.currentRow, Window.currentRow),
            ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))


def rank_columns(keys: Sequence[str], value: str, t: str = "t") -> tuple[Column, Column]:
    """(asc, desc) average-tie ranks of ``value`` within ``keys`` on grouped rows.

    The input holds counts ``t`` per distinct ``(keys, value, ...)``: extra
    grouping columns are allowed, the RANGE frames sum every row whose value
    is at most (``upto``) or equal to (``peers``) the current one.
    """
    v = F.col(value)
    counted = F.when(v.isNotNull(), F.col(t))
    upto, peers, whole = frames(keys, value)
    cum = F.sum(counted).over(upto)
    tied = F.sum(counted).over(peers)
    n = F.sum(counted).over(whole)
    asc = F.when(v.isNotNull(), cum - (tied - 1) / 2.0)
    desc = F.when(v.isNotNull(), n + 1 - asc)
    return asc, desc


def join_back(rows: DataFrame, table: DataFrame, keys: Sequence[str], cols: Sequence[str],
              nullable: Sequence[str] = ()) -> DataFrame:
    """Left-join per-key columns onto rows; ``nullable`` keys match NULL to NULL.

    ``table`` is unique on ``keys``, so no row is duplicated or lost. AQE
    broadcasts it when its measured size is under the threshold, otherwise
    sort-merge joins and splits skewed partitions of ``rows``.
    """
    renamed = table.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *cols)
    cond = [rows[k].eqNullSafe(renamed[f"__k_{k}"]) if k in nullable else rows[k] == renamed[f"__k_{k}"]
            for k in keys]
    return rows.join(renamed, cond, "left").drop(*[f"__k_{k}" for k in keys])


def avg_rank(rows: DataFrame, keys: Sequence[str], value: str, asc: bool = False,
             name: str | None = None) -> DataFrame:
    """Average-tie rank of ``value`` inside ``keys``, desc or asc."""
    name = name or ("avg_rank_asc" if asc else "avg_rank_desc")
    g = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("t"))
    r_asc, r_desc = rank_columns(keys, value)
    g = g.select(*keys, value, (r_asc if asc else r_desc).alias(name))
    return join_back(rows, g, [*keys, value], [name])


def partition_count(rows: DataFrame, keys: Sequence[str], name: str = "partition_count") -> DataFrame:
    """Number of rows sharing the key, on every row."""
    g = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return join_back(rows, g, keys, [name], nullable=keys)


def first_last_flag(rows: DataFrame, keys: Sequence[str], value: str,
                    first: str = "is_first", last: str = "is_last") -> DataFrame:
    """1 when the row's value is the minimum / maximum of its key (ties all 1)."""
    g = rows.groupBy(*keys).agg(F.min(value).alias("__lo"), F.max(value).alias("__hi"))
    out = join_back(rows, g, keys, ["__lo", "__hi"], nullable=keys)
    return (out.withColumn(first, (F.col(value) == F.col("__lo")).cast("int"))
               .withColumn(last, (F.col(value) == F.col("__hi")).cast("int"))
               .drop("__lo", "__hi"))
