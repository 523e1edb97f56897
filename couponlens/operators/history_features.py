"""History features (`u_h_`, `m_h_`, `c_h_`, `um_h_`) over receipts before the cutoff.

One pre-aggregate per ``(user, merchant)`` pair carries every sum the
user, merchant and pair features need; user and merchant features are
roll-ups of it, so distinct merchant counts are plain counts of pairs (no
``Expand`` of the history rows). Coupon features are one more aggregate.
The three consumers of the pair sums keep different columns, so Catalyst
cannot share one exchange between them: callers that need more than one
pass a stored copy (``plans.stage``) to read history once. Several cutoffs
can share one aggregation: ``pair_sums_at`` and ``coupon_sums_at`` carry a
struct of sums for each. Pairs are nearly as many as receipts, so a task's
hash table grows with the sums of a pair; the queries aggregate one cutoff
at a time.
All are partial + final hash aggregations, so a hot user or merchant
costs one partial row per task.

Means are ratios of exact integer sums (the discount in basis points), so
they do not depend on row order; the mean of per-merchant means is
rounded to 6 decimals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.functions import coupons as C
from couponlens.plans.params import Windows


def _n() -> F.Column:
    return F.count(F.lit(1))


def _pair_sums(inside: F.Column, used: F.Column, rec_used: F.Column) -> dict[str, F.Column]:
    """Sums of the receipts that are ``inside`` a history, of which some are ``used`` and ``rec_used`` in it."""
    lag, bp, distance = C.redeem_lag(), C.discount_bp("discount"), F.col("distance")
    used, rec_used = inside & used, inside & rec_used
    within = lambda condition, c: F.when(condition, c)
    return {
        "n": F.count(within(inside, 1)),
        "used": F.count(within(used, 1)),
        "rec_used": F.count(within(rec_used, 1)),
        "dist_sum": F.sum(within(inside, distance)).cast("long"),
        "dist_n": F.count(within(inside, distance)),
        "lag_sum": F.sum(within(used, lag)).cast("long"),
        "bp_sum": F.sum(within(used, bp)).cast("long"),
        "bp_n": F.count(within(used, bp)),
        "udist_sum": F.sum(within(used, distance)).cast("long"),
        "udist_n": F.count(within(used, distance)),
    }


def pair_sums(hist: DataFrame) -> DataFrame:
    sums = _pair_sums(F.lit(True), F.col("used") == 1, F.col("rec_used") == 1)
    return hist.groupBy("user_id", "merchant_id").agg(*[c.alias(n) for n, c in sums.items()])


def _at(w: Windows) -> tuple[F.Column, F.Column, F.Column]:
    """Of parsed receipts: whether one is in the history of ``w``, redeemed in it, and redeemed in time (as T10 has it)."""
    inside = F.col("date_received") < F.lit(w.cutoff)
    used = F.coalesce(F.col("date_used") < F.lit(w.cutoff), F.lit(False))
    return inside, used, used & (C.redeem_lag() <= w.redeem_days)


def _sums_at(p: DataFrame, keys: list[str], windows: Sequence[Windows], sums) -> DataFrame:
    """One aggregation of the receipts before the latest cutoff: a struct of sums for each of ``windows``, in order."""
    each = [sums(*_at(w)) for w in windows]
    rows = p.where(F.col("date_received") < F.lit(max(w.cutoff for w in windows)))
    out = rows.groupBy(*keys).agg(*[c.alias(f"{n}_{i}") for i, one in enumerate(each) for n, c in one.items()])
    return out.select(*keys, *[F.struct(*[F.col(f"{n}_{i}").alias(n) for n in one]).alias(f"at_{i}") for i, one in enumerate(each)])


def pair_sums_at(p: DataFrame, windows: Sequence[Windows]) -> DataFrame:
    """``pair_sums`` of the histories of several windows of parsed receipts at once; stored, each is read by ``of_window``."""
    return _sums_at(p, ["user_id", "merchant_id"], windows, _pair_sums)


def coupon_sums_at(p: DataFrame, windows: Sequence[Windows]) -> DataFrame:
    """``coupon_sums`` of the histories of several windows of parsed receipts at once."""
    return _sums_at(p, ["coupon_id"], windows, lambda inside, used, _: {"n": F.count(F.when(inside, 1)), "used": F.count(F.when(inside & used, 1))})


def of_window(sums: DataFrame, i: int) -> DataFrame:
    """The sums of the ``i``-th window: keys with a receipt in its history only. A scan reads that window's columns alone."""
    keys = [c for c in sums.columns if not c.startswith("at_")]
    return sums.where(F.col(f"at_{i}.n") > 0).select(*keys, f"at_{i}.*")


def pair_features(sums: DataFrame) -> DataFrame:
    return sums.select(
        "user_id", "merchant_id",
        C.ratio("dist_sum", "dist_n").alias("um_h_user_merchant_mean_distance"),
        F.col("used").alias("um_h_user_merchant_used"),
        C.ratio("used", "n").alias("um_h_user_merchant_used_rate"),
        F.col("rec_used").alias("um_h_user_merchant_rec_used"),
        C.ratio("rec_used", "n").alias("um_h_user_merchant_rec_used_rate"),
    )


def user_features(sums: DataFrame) -> DataFrame:
    g = sums.groupBy("user_id").agg(
        F.sum("n").alias("total"), F.sum("used").alias("used"),
        _n().alias("merchants"),
        F.count(F.when(F.col("used") > 0, 1)).alias("used_merchants"),
        F.sum("lag_sum").alias("lag_sum"),
        F.sum("bp_sum").alias("bp_sum"), F.sum("bp_n").alias("bp_n"),
        F.sum("udist_sum").alias("udist_sum"), F.sum("udist_n").alias("udist_n"),
        F.round(F.avg(C.ratio("udist_sum", "udist_n")), 6).alias("mean_of_means"),
    )
    return g.select(
        "user_id",
        F.col("total").alias("u_h_total_coupon"),
        F.col("used").alias("u_h_used"),
        (F.col("total") - F.col("used")).alias("u_h_not_use"),
        C.ratio("used", "total").alias("u_h_rate_used"),
        F.col("merchants").alias("u_h_howmuch_merchant"),
        F.col("used_merchants").alias("u_h_used_howmuch_merchant"),
        C.ratio("used_merchants", "merchants").alias("u_h_rate_used_howmuch_merchant"),
        C.ratio("lag_sum", "used").alias("u_h_timedelta_rec_use"),
        (C.ratio("bp_sum", "bp_n") / 10000).alias("u_h_used_average_discount"),
        C.ratio("udist_sum", "udist_n").alias("u_h_used_average_distance"),
        F.col("mean_of_means").alias("u_h_used_mean_distance"),
    )


def merchant_features(sums: DataFrame) -> DataFrame:
    g = sums.groupBy("merchant_id").agg(
        F.sum("n").alias("total"), F.sum("used").alias("used"), F.sum("rec_used").alias("rec_used"))
    return g.select(
        "merchant_id",
        F.col("total").alias("m_h_total_coupon"),
        F.col("rec_used").alias("m_h_rec_used"),
        C.ratio("used", "total").alias("m_h_rate_used"),
    )


def coupon_sums(hist: DataFrame) -> DataFrame:
    return hist.groupBy("coupon_id").agg(_n().alias("n"), F.sum("used").cast("long").alias("used"))


def coupon_features(sums: DataFrame) -> DataFrame:
    return sums.select(
        "coupon_id",
        F.col("n").alias("c_h_total_coupon"),
        F.col("used").alias("c_h_used"),
        (F.col("n") - F.col("used")).alias("c_h_not_use"),
        C.ratio("used", "n").alias("c_h_rate_used"),
    )


# entity -> (key columns, feature columns). Counts are 0-filled after the
# join to the label window; rates and means stay NULL without history.
ENTITIES = {
    "u": (["user_id"], ["u_h_total_coupon", "u_h_used", "u_h_not_use", "u_h_rate_used", "u_h_howmuch_merchant",
                        "u_h_used_howmuch_merchant", "u_h_rate_used_howmuch_merchant", "u_h_timedelta_rec_use",
                        "u_h_used_average_discount", "u_h_used_average_distance", "u_h_used_mean_distance"]),
    "m": (["merchant_id"], ["m_h_total_coupon", "m_h_rec_used", "m_h_rate_used"]),
    "c": (["coupon_id"], ["c_h_total_coupon", "c_h_used", "c_h_not_use", "c_h_rate_used"]),
    "um": (["user_id", "merchant_id"], ["um_h_user_merchant_mean_distance", "um_h_user_merchant_used",
                                        "um_h_user_merchant_used_rate", "um_h_user_merchant_rec_used",
                                        "um_h_user_merchant_rec_used_rate"]),
}
COUNTS = {"u_h_total_coupon", "u_h_used", "u_h_not_use", "u_h_howmuch_merchant", "u_h_used_howmuch_merchant",
          "m_h_total_coupon", "m_h_rec_used", "c_h_total_coupon", "c_h_used", "c_h_not_use",
          "um_h_user_merchant_used", "um_h_user_merchant_rec_used"}
FEATURE_ENTITY = {f: e for e, (_, fs) in ENTITIES.items() for f in fs}
HISTORY_FEATURES = [f for _, fs in ENTITIES.values() for f in fs]


def entity_table(hist: DataFrame, entity: str, sums: DataFrame | None = None) -> DataFrame:
    """History features of one entity. ``sums``: a stored ``pair_sums(hist)``."""
    if entity == "c":
        return coupon_features(coupon_sums(hist))
    sums = pair_sums(hist) if sums is None else sums
    return {"u": user_features, "m": merchant_features, "um": pair_features}[entity](sums)


def history_feature(hist: DataFrame, name: str, sums: DataFrame | None = None) -> DataFrame:
    """One feature per history entity: ``(entity keys..., name)``."""
    keys, _ = ENTITIES[FEATURE_ENTITY[name]]
    return entity_table(hist, FEATURE_ENTITY[name], sums).select(*keys, name)
