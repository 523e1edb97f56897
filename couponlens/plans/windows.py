"""Splitting receipts at the cutoff (T9, T10) and labelling them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.functions import coupons as C
from couponlens.plans.params import SCORING, Windows


def label_window(p: DataFrame, w: Windows = SCORING) -> DataFrame:
    """Receipts received inside the label window, with both labels.

    On a table stored by date the range reaches the scan as a partition
    filter, so only the window's folders are read.
    """
    inside = (F.col("date_received") >= F.lit(w.l_start)) & (F.col("date_received") <= F.lit(w.l_end))
    return p.where(inside).withColumns({
        "label_rule": C.label_rule("discount", w.rule_cut),
        "label_redeemed": C.label_redeemed("date_received", "date_used", w.redeem_days),
    })


def history_window(p: DataFrame, w: Windows = SCORING) -> DataFrame:
    """Receipts received before the cutoff.

    A redemption is visible only if it happened before the cutoff too:
    ``date_used`` is masked otherwise, so nothing of the label window leaks.
    ``used`` = redeemed before the cutoff; ``rec_used`` = also within
    ``redeem_days`` of receipt.
    """
    cutoff = F.lit(w.cutoff)
    seen = F.when(F.col("date_used") < cutoff, F.col("date_used"))
    lag = F.datediff(seen, F.col("date_received"))
    return (p.where(F.col("date_received") < cutoff)
             .withColumn("date_used", seen)
             .withColumns({
                 "used": F.col("date_used").isNotNull().cast("int"),
                 "rec_used": (F.col("date_used").isNotNull() & (lag <= w.redeem_days)).cast("int"),
             }))
