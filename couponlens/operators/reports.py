"""Campaign reports (Q1..Q11, J3): one row per key, key and value together.

Every report is an additive count over a few dimensions of the label
window, so each one accepts *weighted rows*: raw receipts (weight 1) or
the report cube, the window counted once per combination of report
dimensions (``report_cube``). The cube's size is bounded by the value
domains (days x distances x rates x 2 x 2 x 2), not by the data, so one
scan of the window feeds every report. Aggregation is partial + final:
a hot day or rate costs one partial row per task. Shares are computed on
aggregated rows only (W5).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from couponlens.functions import coupons as C

LABEL = "label_rule"
WEIGHT = "weight"
DIMENSIONS = ["date_received", "distance", "discount", "is_manjian", "label_rule", "label_redeemed"]


def report_cube(lw: DataFrame) -> DataFrame:
    """Label-window receipts counted per combination of report dimensions."""
    return lw.groupBy(*DIMENSIONS).agg(F.count(F.lit(1)).alias(WEIGHT))


def _weighted(df: DataFrame) -> DataFrame:
    return df if WEIGHT in df.columns else df.withColumn(WEIGHT, F.lit(1).cast("long"))


def _n() -> F.Column:
    return F.sum(WEIGHT).cast("long")


def _positives(label: str) -> F.Column:
    return F.sum(F.col(WEIGHT) * F.col(label)).cast("long")


def _counts(df: DataFrame, key, label: str = LABEL) -> DataFrame:
    return _weighted(df).groupBy(key).agg(_n().alias("received"), _positives(label).alias("redeemed"))


def daily_receipts(lw: DataFrame) -> DataFrame:
    """Q1: receipts per day."""
    return _weighted(lw).groupBy("date_received").agg(_n().alias("received"))


def peak_receipt_day(lw: DataFrame) -> DataFrame:
    """Q2: the day(s) with the most receipts; ties are all kept.

    The daily table is joined on equality with its own one-row maximum.
    """
    daily = daily_receipts(lw)
    top = daily.agg(F.max("received").alias("received"))
    return daily.join(top, "received").select("date_received", "received")


def receipts_by_distance(lw: DataFrame) -> DataFrame:
    """Q3: receipts per distance; receipts without a distance are left out."""
    return _weighted(with_distance(lw)).groupBy("distance").agg(_n().alias("received"))


def redeem_rate_by_distance(lw: DataFrame, label: str = LABEL) -> DataFrame:
    """Q4: received, redeemed and their ratio per distance."""
    return (_counts(with_distance(lw), "distance", label)
            .withColumn("rate", C.ratio("redeemed", "received")))


def received_redeemed_by_rate(lw: DataFrame, label: str = LABEL) -> DataFrame:
    """Q5: received and redeemed per discount rate, in one aggregate."""
    return _counts(lw, "discount", label)


def received_redeemed_by_weekday(lw: DataFrame, label: str = LABEL) -> DataFrame:
    """Q6: received and redeemed per ISO weekday."""
    return _counts(lw, C.weekday("date_received").alias("weekday"), label)


def redeemed_by_weekday(lw: DataFrame, label: str = "label_redeemed") -> DataFrame:
    """T12 example: the redemption ratio per ISO weekday."""
    return (_counts(lw, C.weekday("date_received").alias("weekday"), label)
            .withColumn("rate", C.ratio("redeemed", "received")))


def share_of_total(counts: DataFrame, n: str) -> DataFrame:
    """Each row's share of the column total.

    The window has no partition key, so it must only ever see aggregated
    rows (a handful of keys), never receipts.
    """
    return counts.withColumn("share", F.col(n) / F.sum(n).over(Window.partitionBy()))


def coupon_type_share(lw: DataFrame) -> DataFrame:
    """Q7: share of full-reduction and direct-rate coupons among receipts."""
    counts = _weighted(lw).groupBy("is_manjian").agg(_n().alias("received"))
    return share_of_total(counts, "received")


def redeemed_type_share(lw: DataFrame, label: str = LABEL) -> DataFrame:
    """Q8: the same share among positives."""
    counts = (_weighted(lw).where(F.col(label) == 1).groupBy("is_manjian")
              .agg(_n().alias("redeemed")))
    return share_of_total(counts, "redeemed")


def label_share(lw: DataFrame, label: str = LABEL) -> DataFrame:
    """Q9: share of positives and negatives, keyed by the label value."""
    counts = _weighted(lw).groupBy(F.col(label).alias("label")).agg(_n().alias("n"))
    return share_of_total(counts, "n")


def report_long(report: DataFrame, key: str, series: list[str]) -> DataFrame:
    """Q10: a multi-series report as ``(key, series, value)`` rows."""
    return (report.select(F.col(key).alias("key"), *[F.col(s).cast("long").alias(s) for s in series])
            .unpivot("key", series, "series", "value"))


def missing_distance(lw: DataFrame, label: str = LABEL) -> DataFrame:
    """Q11: receipts and positives that have no distance."""
    zero = F.lit(0).cast("long")
    return _weighted(lw).where(F.col("distance").isNull()).agg(
        F.coalesce(_n(), zero).alias("received"), F.coalesce(_positives(label), zero).alias("redeemed"))


def left_join_zero_filled(lw: DataFrame, key: str, label: str = LABEL) -> DataFrame:
    """Per-key receipts left-joined to per-key positives, 0-filled.

    Both sides are aggregated before the join, so the join sees one row per
    key on each side.
    """
    w = _weighted(lw)
    rec = w.groupBy(key).agg(_n().alias("received"))
    red = w.where(F.col(label) == 1).groupBy(key).agg(_n().alias("redeemed"))
    return (rec.join(red, key, "left")
            .select(key, "received", C.zero_fill("redeemed").alias("redeemed")))


def received_left_join_redeemed(lw: DataFrame, label: str = LABEL) -> DataFrame:
    """Per-rate receipts left-joined to per-rate positives; must equal Q5."""
    return left_join_zero_filled(lw, "discount", label)


def with_distance(lw: DataFrame) -> DataFrame:
    """Drop receipts without a distance before grouping by it."""
    return lw.where(F.col("distance").isNotNull())


def sort_by_key(report: DataFrame, key: str) -> DataFrame:
    """O1: a report in axis order (presentation; a range shuffle of few rows)."""
    return report.orderBy(F.col(key).asc_nulls_last())
