"""Hot keys: a user holding over a third of all rows, many identical copies,
a hot merchant and a hot day. Results must equal the SQL oracle exactly."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from check_oracle import compare
from couponlens.operators import features as FW
from couponlens.operators import history_features as HF
from couponlens.operators import label_features as L
from couponlens.operators import reports as Q
from couponlens.plans.oracle import features_over
from couponlens.plans.params import SCORING, TRAINING, Windows
from couponlens.plans.windows import history_window, label_window
from couponlens.sources import receipts as S

from conftest import SMALL


def _skewed(spark):
    base = S.fixture_receipts(spark, SMALL)
    ids = spark.range(4000)
    # 2500 identical copies of one July receipt of user 7, and 1500 more
    # receipts of user 7 at merchant 3 spread over days, rates, distances.
    copies = ids.where("id < 2500").select(
        F.lit(7).cast("long").alias("user_id"), F.lit(3).cast("long").alias("merchant_id"),
        F.lit(61).cast("long").alias("coupon_id"), F.lit("30:5").alias("discount_rate"),
        F.lit(2).alias("distance"), F.lit("2016-07-09").cast("date").alias("date_received"),
        F.lit(None).cast("date").alias("date_used"))
    spread = ids.where("id >= 2500").select(
        F.lit(7).cast("long").alias("user_id"), F.lit(3).cast("long").alias("merchant_id"),
        (F.col("id") % 20 + 60).alias("coupon_id"),
        F.element_at(F.array(*[F.lit(r) for r in S.FIXTURE_RATES]), (F.col("id") % 11 + 1).cast("int"))
        .alias("discount_rate"),
        F.when(F.col("id") % 5 != 0, (F.col("id") % 11).cast("int")).alias("distance"),
        F.date_add(F.lit("2016-05-01").cast("date"), (F.col("id") % 92).cast("int")).alias("date_received"),
        F.when(F.col("id") % 3 == 0, F.date_add(F.lit("2016-05-01").cast("date"), (F.col("id") % 92 + F.col("id") % 20).cast("int")))
        .alias("date_used"))
    return base.unionByName(copies).unionByName(spread)


def test_hot_keys_match_oracle(spark):
    rec = _skewed(spark)
    hot = rec.where("user_id = 7").count()
    assert hot * 3 > rec.count()
    p = S.parsed(rec)
    got = FW.features_wide(label_window(p), history_window(p))
    con = duckdb.connect()
    con.register("receipts_in", rec.toArrow())
    ok, msg = compare(got, con, features_over("receipts_in"))
    assert ok, msg


def test_hot_keys_reports(spark):
    rec = _skewed(spark)
    lw = label_window(S.parsed(rec))
    daily = {r.date_received.isoformat(): r.received for r in Q.daily_receipts(lw).collect()}
    peak = Q.peak_receipt_day(lw).collect()
    assert [(r.date_received.isoformat(), r.received) for r in peak] == [("2016-07-09", daily["2016-07-09"])]
    assert sum(daily.values()) == lw.count()


def test_hot_key_join_back_is_split_by_aqe(spark):
    """One (user, day, distance, rate) key holds most of the window; AQE's
    skew join splits its partition in the join back (thresholds lowered so
    the effect shows at test size; broadcast off so the join is sort-merge)."""
    s2 = spark.newSession()
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}.items():
        s2.conf.set(k, v)
    hot = s2.range(30000).select(
        F.lit(7).cast("long").alias("user_id"), (F.col("id") % 97).alias("merchant_id"),
        F.abs(F.xxhash64("id")).alias("coupon_id"), F.lit("30:5").alias("discount_rate"),
        F.lit(2).alias("distance"), F.lit("2016-07-09").cast("date").alias("date_received"),
        F.lit(None).cast("date").alias("date_used"))
    rec = S.fixture_receipts(s2, SMALL).unionByName(hot)
    p = S.parsed(rec)
    lw = label_window(p)
    out = FW.features_wide(lw, history_window(p))
    assert out.count() == lw.count() == 834 + 30000
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true) [user_id" in plan


def test_hot_merchant_is_split_by_aqe(spark, tmp_path):
    """One merchant holds most of the window; its packed row is one of a stored table, and AQE splits its receipts in that join."""
    s2 = spark.newSession()
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.coalescePartitions.enabled": "false",  # a megabyte would be one map task, which cannot be split
                 "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                 "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}.items():
        s2.conf.set(k, v)
    hot = s2.range(30000).select(
        F.col("id").alias("user_id"), F.lit(3).cast("long").alias("merchant_id"),
        F.abs(F.xxhash64("id")).alias("coupon_id"), F.lit("30:5").alias("discount_rate"),
        (F.col("id") % 11).cast("int").alias("distance"), F.lit("2016-07-09").cast("date").alias("date_received"),
        F.lit(None).cast("date").alias("date_used"))
    p = S.parsed(S.fixture_receipts(s2, SMALL).unionByName(hot))
    lw, hist = label_window(p), history_window(p)
    packed = {}
    for e, t in FW.packed_tables(lw, HF.pair_sums(hist), HF.coupon_sums(hist)).items():
        t.write.parquet(str(tmp_path / e))
        packed[e] = s2.read.parquet(str(tmp_path / e))
    out = FW.features_wide(lw, hist, packed=packed)
    assert out.count() == lw.count() == 834 + 30000
    of_day = {r.d for r in out.where("merchant_id = 3 AND date_received = date'2016-07-09'").select((F.col("m_l_howmuch_coupon_today") >= 30000).alias("d")).distinct().collect()}
    assert of_day == {True}
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortMergeJoin(skew=true) [merchant_id" in plan


def test_packed_row_is_bounded_by_values(spark):
    """The hot merchant's row holds a map entry per day, distance and rate, not per combination or receipt."""
    lw = label_window(S.parsed(_skewed(spark)))
    row = L.packed(lw, "merchant_id", kinds=True).where("merchant_id = 3").first()
    seen = lw.where("merchant_id = 3").agg(F.count("*").alias("n"), F.countDistinct("date_received").alias("d"), F.countDistinct("distance").alias("x"),
                                           F.countDistinct("discount").alias("r"), F.countDistinct("coupon_id").alias("k")).first()
    assert (row.total, len(row.days), len(row.distances), len(row.rates), row.kinds) == (seen.n, seen.d, seen.x, seen.r, seen.k)


def test_both_cutoffs_in_one_aggregation(spark):
    """Sums of several windows at once are those of each window's own history."""
    p = S.parsed(_skewed(spark))
    windows = [SCORING, TRAINING, Windows(l_start=dt.date(2015, 1, 1), l_end=dt.date(2015, 1, 2))]
    pairs, coupons = HF.pair_sums_at(p, windows), HF.coupon_sums_at(p, windows)
    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    for i, w in enumerate(windows):
        hist = history_window(p, w)
        assert rows(HF.of_window(pairs, i)) == rows(HF.pair_sums(hist)) and rows(HF.of_window(coupons, i)) == rows(HF.coupon_sums(hist))
    assert HF.of_window(pairs, 2).count() == 0 < HF.of_window(pairs, 1).count() < HF.of_window(pairs, 0).count()
