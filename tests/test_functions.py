"""T1..T8, T12, T13 on hand-made rows (FIXTURES.md section 5)."""

import datetime as dt


from couponlens.functions import coupons as C


def _one(spark, rate):
    df = spark.createDataFrame([(rate,)], "discount_rate string")
    return df.select(C.discount().alias("d"), C.is_manjian().alias("m"), C.price_before().alias("p")).first()


def test_direct_rate(spark):
    r = _one(spark, "0.95")
    assert (r.d, r.m, r.p) == (0.95, 0, None)


def test_full_reduction(spark):
    r = _one(spark, "150:20")
    assert (r.d, r.m, r.p) == (0.8667, 1, 150)


def test_malformed_rate_is_null(spark):
    for rate in ("abc", "1:2:3", "12.5:5", "5:", ":5", "-1:2", "", " 0.9", "0.9.1", None):
        r = _one(spark, rate)
        assert (r.d, r.m, r.p) == (None, None, None), rate


def test_rule_label_boundary(spark):
    df = spark.createDataFrame([("50:10",), ("30:5",)], "discount_rate string")
    got = [r.l for r in df.select(C.label_rule(C.discount(), 0.8).alias("l")).collect()]
    assert got == [1, 0]


def test_weekday_is_iso(spark):
    df = spark.createDataFrame([(dt.date(2016, 7, 1),), (dt.date(2016, 7, 3),), (dt.date(2016, 7, 4),)], "d date")
    assert [r.w for r in df.select(C.weekday("d").alias("w")).collect()] == [5, 7, 1]


def test_redeemed_label_and_lag(spark):
    rows = [(dt.date(2016, 3, 1), dt.date(2016, 3, 16)), (dt.date(2016, 3, 1), dt.date(2016, 3, 17)),
            (dt.date(2016, 3, 1), None)]
    df = spark.createDataFrame(rows, "date_received date, date_used date")
    got = [(r.l, r.g) for r in df.select(C.label_redeemed(days=15).alias("l"), C.redeem_lag().alias("g")).collect()]
    assert got == [(1, 15), (0, 16), (0, None)]


def test_ratio_and_zero_fill(spark):
    df = spark.createDataFrame([(1, 4), (0, 0), (None, 3)], "n long, d long")
    got = df.select(C.ratio("n", "d").alias("r"), C.zero_fill("n").alias("z")).collect()
    assert [(r.r, r.z) for r in got] == [(0.25, 1), (None, 0), (None, 0)]


def test_distance_clean(spark):
    df = spark.createDataFrame([("3",), ("null",), (None,)], "distance string")
    assert [r.x for r in df.select(C.distance().alias("x")).collect()] == [3, None, None]
