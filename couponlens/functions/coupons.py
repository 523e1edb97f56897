"""Scalar column functions on receipts (T1..T8, T12, T13).

All of them are built-in expressions, so they stay inside whole-stage
codegen. Parsing uses ``try_`` forms: under ANSI mode (Spark 4 default) a
malformed rate or distance becomes NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: The two forms of a rate: spend x, get y off (whole numbers), and a fraction.
FULL_REDUCTION = r"^[0-9]+:[0-9]+$"
DIRECT = r"^[0-9]*\.?[0-9]+$"


def is_manjian(rate="discount_rate") -> Column:
    """1 for a full-reduction coupon (``"x:y"``: spend x, get y off), 0 for a direct rate, else NULL."""
    r = _col(rate)
    return F.when(r.rlike(FULL_REDUCTION), 1).when(r.rlike(DIRECT), 0)


def discount(rate="discount_rate") -> Column:
    """The rate as a fraction, 4 decimals. ``"x:y"`` -> ``1 - y/x``; NULL for any other form."""
    r = _col(rate)
    parts = F.split(r, ":")
    spend = F.try_element_at(parts, F.lit(1)).try_cast("double")
    off = F.try_element_at(parts, F.lit(2)).try_cast("double")
    value = F.when(r.rlike(FULL_REDUCTION), F.lit(1.0) - ratio(off, spend)).when(r.rlike(DIRECT), r.try_cast("double"))
    return F.round(value, 4)


def discount_bp(disc="discount") -> Column:
    """Discount in integer basis points: averages of it do not depend on row order."""
    return F.round(_col(disc) * 10000).cast("int")


def price_before(rate="discount_rate") -> Column:
    """The spend threshold x of ``"x:y"``; NULL for a direct rate and any other form."""
    r = _col(rate)
    return F.when(r.rlike(FULL_REDUCTION), F.try_element_at(F.split(r, ":"), F.lit(1)).try_cast("int"))


def distance(col="distance") -> Column:
    """T4: distance class 0..10 as a nullable int."""
    return _col(col).try_cast("int")


def redeem_lag(received="date_received", used="date_used") -> Column:
    """Days from receipt to redemption; NULL when not redeemed."""
    return F.datediff(_col(used), _col(received))


def label_redeemed(received="date_received", used="date_used", days: int = 15) -> Column:
    """T5: 1 when redeemed within ``days`` of receipt, else 0."""
    lag = redeem_lag(received, used)
    return F.when(lag.isNotNull() & (lag <= days), 1).otherwise(0)


def label_rule(disc="discount", cut: float = 0.8) -> Column:
    """The rule the published label follows, ``discount <= cut``."""
    return (_col(disc) <= F.lit(cut)).cast("int")


def weekday(d="date_received") -> Column:
    """ISO weekday, 1 = Monday .. 7 = Sunday."""
    return (F.weekday(_col(d)) + 1).cast("int")


def ratio(n, d) -> Column:
    """N / d as a double; NULL when d is 0 or NULL."""
    n, d = _col(n), _col(d)
    return F.when(d != 0, n.cast("double") / d.cast("double"))


def zero_fill(c) -> Column:
    """0 for a count that a left join left NULL."""
    return F.coalesce(_col(c), F.lit(0))
