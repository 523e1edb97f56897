"""Coupon redemption analytics on Spark.

Receipts of coupons (who received which coupon from which merchant, when,
and when it was redeemed) go in; campaign reports, 56 leakage-safe
features per receipt and a boosted-tree redemption model come out. Every
step is a DataFrame plan or a spark.ml estimator.
"""

from couponlens.session import build_session, shared_dir
from couponlens.plans.params import SCORING, TRAINING, Windows

__all__ = ["build_session", "shared_dir", "Windows", "SCORING", "TRAINING"]
