"""Named queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query starts from the receipt table derived from the test tables at
``sf_dir``, so its work grows with the tables. Tables that several queries
share are written once per application to the session's shared folder
(``plans.stage``): the receipts (by day), the report cube, the pair-level and
coupon-level history at each cutoff, the packed merchant and coupon rows,
and the scoring and training feature tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from couponlens.functions import coupons as C
from couponlens.operators import features as FW
from couponlens.operators import history_features as HF
from couponlens.operators import label_features as LF
from couponlens.operators import model as M
from couponlens.operators import ranks as R
from couponlens.operators import reports as Q
from couponlens.plans.params import SCORING, TRAINING, Windows
from couponlens.plans.stage import new_folder, staged
from couponlens.plans.windows import history_window, label_window
from couponlens.sources import importance as SI
from couponlens.sources import receipts as S
from couponlens.sources import sinks as SK

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

LW_KEYS = ["user_id", "merchant_id", "coupon_id", "date_received"]


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


def parsed_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.parsed(S.receipts(spark, sf_dir))


def lw(spark: SparkSession, sf_dir: str, w: Windows = SCORING) -> DataFrame:
    return label_window(parsed_receipts(spark, sf_dir), w)


def hist(spark: SparkSession, sf_dir: str, w: Windows = SCORING) -> DataFrame:
    return history_window(parsed_receipts(spark, sf_dir), w)


def cube(spark: SparkSession, sf_dir: str, w: Windows = SCORING) -> DataFrame:
    """The label window counted per report dimensions, built once per application.

    Its size is bounded by the value domains, so every report reads a few
    thousand rows instead of scanning the window again.
    """
    return staged(spark, S.fixture_key(spark, "cube", sf_dir, w), lambda: Q.report_cube(lw(spark, sf_dir, w)))


def _at(spark: SparkSession, sf_dir: str, name: str, build, w: Windows) -> DataFrame:
    """Sums of the history at the cutoff of ``w``, built once per application.

    One cutoff a table: both at once double the sums that a task holds for
    each of its pairs, and a query of one window needs only its own.
    """
    made = staged(spark, S.fixture_key(spark, name, sf_dir, w), lambda: build(parsed_receipts(spark, sf_dir), [w]))
    return HF.of_window(made, 0)


def sums(spark: SparkSession, sf_dir: str, w: Windows = SCORING) -> DataFrame:
    """Pair-level history sums at the cutoff of ``w``."""
    return _at(spark, sf_dir, "pairsums", HF.pair_sums_at, w)


def coupon_sums(spark: SparkSession, sf_dir: str, w: Windows = SCORING) -> DataFrame:
    """Coupon-level history sums at the cutoff of ``w``."""
    return _at(spark, sf_dir, "couponsums", HF.coupon_sums_at, w)


def packed(spark: SparkSession, sf_dir: str, w: Windows = SCORING) -> dict[str, DataFrame]:
    """Packed merchant and coupon rows of a window, built once per application."""
    made = FW.packed_tables(lw(spark, sf_dir, w), sums(spark, sf_dir, w), coupon_sums(spark, sf_dir, w))
    return {e: staged(spark, S.fixture_key(spark, f"packed-{e}", sf_dir, w), lambda t=t: t) for e, t in made.items()}


# ---- S1, T1..T13 -------------------------------------------------------------
@query("receipts")
def _receipts(spark, sf_dir):
    return S.fixture_receipts(spark, sf_dir)


def _per_receipt(name: str, out: str, expr):
    """``expr`` is a factory: Columns need an active session, imports do not."""
    @query(name)
    def fn(spark, sf_dir):
        return parsed_receipts(spark, sf_dir).select(*LW_KEYS, expr().alias(out))
    return fn


_per_receipt("coupon_type", "is_manjian", C.is_manjian)
_per_receipt("discount_value", "discount", C.discount)
_per_receipt("price_before", "price_before", C.price_before)
_per_receipt("distance_clean", "distance", C.distance)
_per_receipt("label_redeemed", "label_redeemed", lambda: C.label_redeemed(days=SCORING.redeem_days))
_per_receipt("label_rule", "label_rule", lambda: C.label_rule(C.discount(), SCORING.rule_cut))
_per_receipt("weekday", "weekday", C.weekday)
_per_receipt("redeem_lag", "redeem_lag", C.redeem_lag)

_LW_COLS = ["user_id", "merchant_id", "coupon_id", "discount_rate", "distance", "date_received", "date_used",
            "discount", "is_manjian", "price_before"]


@query("label_window")
def _label_window(spark, sf_dir):
    return lw(spark, sf_dir).select(*_LW_COLS, "label_rule", "label_redeemed")


@query("history_window")
def _history_window(spark, sf_dir):
    return hist(spark, sf_dir).select(*_LW_COLS, "used", "rec_used")


@query("with_distance")
def _with_distance(spark, sf_dir):
    return Q.with_distance(lw(spark, sf_dir)).select(*_LW_COLS, "label_rule", "label_redeemed")


@query("ratio")
def _ratio(spark, sf_dir):
    return Q.redeemed_by_weekday(cube(spark, sf_dir), "label_redeemed")


@query("zero_fill")
def _zero_fill(spark, sf_dir):
    return Q.left_join_zero_filled(cube(spark, sf_dir), "date_received", "label_redeemed")


# ---- Q1..Q11, J3, O1 ---------------------------------------------------------
def _report(name: str, fn):
    @query(name)
    def run(spark, sf_dir):
        return fn(cube(spark, sf_dir))
    return run


_report("daily_receipts", Q.daily_receipts)
_report("peak_receipt_day", Q.peak_receipt_day)
_report("receipts_by_distance", Q.receipts_by_distance)
_report("redeem_rate_by_distance", Q.redeem_rate_by_distance)
_report("received_redeemed_by_rate", Q.received_redeemed_by_rate)
_report("received_redeemed_by_weekday", Q.received_redeemed_by_weekday)
_report("coupon_type_share", Q.coupon_type_share)
_report("redeemed_type_share", Q.redeemed_type_share)
_report("label_share", Q.label_share)
_report("missing_distance", Q.missing_distance)
_report("received_left_join_redeemed", Q.received_left_join_redeemed)


@query("report_long")
def _report_long(spark, sf_dir):
    return Q.report_long(Q.received_redeemed_by_weekday(cube(spark, sf_dir)), "weekday", ["received", "redeemed"])


@query("sort_by_key")
def _sort_by_key(spark, sf_dir):
    return Q.sort_by_key(Q.daily_receipts(cube(spark, sf_dir)), "date_received")


# ---- W1..W5 ------------------------------------------------------------------

@query("avg_rank_desc")
def _avg_rank_desc(spark, sf_dir):
    return R.avg_rank(lw(spark, sf_dir).select(*LW_KEYS, "distance"), ["merchant_id"], "distance", asc=False)


@query("avg_rank_asc")
def _avg_rank_asc(spark, sf_dir):
    return R.avg_rank(lw(spark, sf_dir).select(*LW_KEYS, "distance"), ["merchant_id"], "distance", asc=True)


@query("partition_count")
def _partition_count(spark, sf_dir):
    return R.partition_count(lw(spark, sf_dir).select(*LW_KEYS), ["user_id", "coupon_id"])


@query("first_last_flag")
def _first_last_flag(spark, sf_dir):
    return R.first_last_flag(lw(spark, sf_dir).select(*LW_KEYS), ["user_id"], "date_received")


@query("share_of_total")
def _share_of_total(spark, sf_dir):
    counts = cube(spark, sf_dir).groupBy("is_manjian").agg(F.sum("weight").cast("long").alias("received"))
    return Q.share_of_total(counts, "received")


# ---- F01..F57, J1, J2, J4 ----------------------------------------------------
def _label_feature(name: str):
    @query(f"f_{name}")
    def fn(spark, sf_dir):
        return LF.label_feature(lw(spark, sf_dir), name)
    return fn


def _history_feature(name: str):
    @query(f"f_{name}")
    def fn(spark, sf_dir):
        return HF.history_feature(hist(spark, sf_dir), name, sums(spark, sf_dir))
    return fn


for _name in FW.FEATURES:
    (_label_feature if _name in LF.LABEL_FEATURES else _history_feature)(_name)
QUERIES["f_distance"] = QUERIES["f_Distance"]


@query("features_wide")
def _features_wide(spark, sf_dir):
    """F57, written once per application: scoring and the sink read the stored table."""
    return staged(spark, S.fixture_key(spark, "features", sf_dir, SCORING),
                  lambda: FW.features_wide(lw(spark, sf_dir), hist(spark, sf_dir), sums=sums(spark, sf_dir), packed=packed(spark, sf_dir)))


@query("features_entity_join")
def _features_entity_join(spark, sf_dir):
    return FW.entity_join(lw(spark, sf_dir), hist(spark, sf_dir), sums(spark, sf_dir), coupon_sums(spark, sf_dir))


@query("features_pair_join")
def _features_pair_join(spark, sf_dir):
    return FW.pair_join(lw(spark, sf_dir), hist(spark, sf_dir), sums(spark, sf_dir))


@query("kinds_join_back")
def _kinds_join_back(spark, sf_dir):
    return FW.kinds_join_back(lw(spark, sf_dir))


# ---- M1..M7, O2, S2..S5 ------------------------------------------------------

def _train(spark, sf_dir):
    """M1, written once per application; the fit reads the stored table."""
    return staged(spark, S.fixture_key(spark, "trainset", sf_dir, TRAINING), lambda: M.train_set(
        lw(spark, sf_dir, TRAINING), hist(spark, sf_dir, TRAINING), sums(spark, sf_dir, TRAINING), packed(spark, sf_dir, TRAINING)))


def _model(spark, sf_dir):
    return M.fitted(spark, S.fixture_key(spark, "model", sf_dir), _train(spark, sf_dir))


def _scratch(spark, what: str) -> str:
    return new_folder(spark, what)


@query("train_set")
def _train_set(spark, sf_dir):
    return _train(spark, sf_dir)


@query("assemble")
def _assemble(spark, sf_dir):
    """M2: the assembled vector, read back as one double per feature."""
    return M.assembled_columns(_train(spark, sf_dir))


def _filled(spark, sf_dir):
    """Input of M6, O2, S2 and S3 as queries: values per feature of the scoring table, which SQL can state too.

    The model's split counts take the same way in ``campaign.run``.
    """
    return M.filled_importance(_features_wide(spark, sf_dir))


@query("fit_trees")
def _fit_trees(spark, sf_dir):
    _, path = _model(spark, sf_dir)
    return M.tree_summary(spark, path)


@query("importance_splits")
def _importance_splits(spark, sf_dir):
    _, path = _model(spark, sf_dir)
    return M.importance_splits(spark, path)


@query("importance_gain")
def _importance_gain(spark, sf_dir):
    model, _ = _model(spark, sf_dir)
    return M.importance_gain(spark, model)


@query("importance_by_family")
def _importance_by_family(spark, sf_dir):
    return M.importance_by_family(_filled(spark, sf_dir))


@query("sort_by_importance")
def _sort_by_importance(spark, sf_dir):
    return M.sort_by_importance(_filled(spark, sf_dir))


@query("score")
def _score(spark, sf_dir):
    model, _ = _model(spark, sf_dir)
    return M.score(model, _features_wide(spark, sf_dir))


@query("importance_csv")
def _importance_csv(spark, sf_dir):
    path = _scratch(spark, "importance")
    SI.write_importance(_filled(spark, sf_dir), path)
    return SI.read_importance(spark, path)


@query("importance_sink")
def _importance_sink(spark, sf_dir):
    """S3 as written: the text lines of the CSV file."""
    path = _scratch(spark, "importance")
    SI.write_importance(_filled(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("report_sink")
def _report_sink(spark, sf_dir):
    path = _scratch(spark, "report")
    SK.write_report(Q.received_redeemed_by_weekday(cube(spark, sf_dir)), path, "weekday")
    return SK.read_report(spark, path)


@query("features_sink")
def _features_sink(spark, sf_dir):
    path = _scratch(spark, "features")
    wide = _features_wide(spark, sf_dir)
    SK.write_features(wide, path)
    return SK.read_features(spark, path, wide.schema).select(*FW.KEYS, *FW.FEATURES)
