"""History features on hand-made receipts (FIXTURES.md section 5) and leakage."""

from couponlens.operators import features as FW
from couponlens.operators import history_features as H
from couponlens.plans.params import SCORING
from couponlens.plans.windows import history_window, label_window
from couponlens.sources.receipts import parsed

from conftest import receipts_df

ROWS = [
    # user 1, merchant 10: redeemed after the cutoff -> not used in history
    (1, 10, 100, "0.9", 2, "2016-06-30", "2016-07-02"),
    # user 2, merchant 10: late (18 days) and exact (15 days) redemptions
    (2, 10, 100, "0.9", 2, "2016-03-01", "2016-03-19"),
    (2, 10, 100, "0.9", 2, "2016-03-01", "2016-03-16"),
    # user 3: two merchants; A: three redemptions at distance 1; B: one at 5
    (3, 20, 200, "30:5", 1, "2016-04-01", "2016-04-02"),
    (3, 20, 200, "30:5", 1, "2016-04-02", "2016-04-03"),
    (3, 20, 200, "30:5", 1, "2016-04-03", "2016-04-04"),
    (3, 30, 300, "30:5", 5, "2016-04-01", "2016-04-02"),
    # label window receipts; user 4 only appears in July
    (1, 10, 100, "0.9", 2, "2016-07-05", None),
    (4, 10, 100, "0.9", None, "2016-07-06", None),
    (3, 20, 200, "30:5", 1, "2016-07-07", None),
]


def _frames(spark):
    p = parsed(receipts_df(spark, ROWS))
    return label_window(p, SCORING), history_window(p, SCORING)


def test_redemption_after_cutoff_is_invisible(spark):
    _, h = _frames(spark)
    r = h.where("user_id = 1").first()
    assert (r.used, r.rec_used, r.date_used) == (0, 0, None)


def test_late_and_exact_redemptions(spark):
    _, h = _frames(spark)
    got = sorted((r.date_used.day, r.used, r.rec_used) for r in h.where("user_id = 2").collect())
    assert got == [(16, 1, 1), (19, 1, 0)]


def test_two_merchants_average_and_mean(spark):
    _, h = _frames(spark)
    u = {r.user_id: r for r in H.user_features(H.pair_sums(h)).collect()}[3]
    assert u.u_h_used_average_distance == 2.0
    assert u.u_h_used_mean_distance == 3.0
    assert u.u_h_howmuch_merchant == 2 and u.u_h_used_howmuch_merchant == 2


def test_used_plus_not_use_is_total(spark):
    _, h = _frames(spark)
    for r in H.user_features(H.pair_sums(h)).collect():
        assert r.u_h_used + r.u_h_not_use == r.u_h_total_coupon
        assert 0.0 <= r.u_h_rate_used <= 1.0
    for r in H.coupon_features(H.coupon_sums(h)).collect():
        assert r.c_h_used + r.c_h_not_use == r.c_h_total_coupon


def test_no_history_user_gets_zero_counts_and_null_rates(spark):
    lw, h = _frames(spark)
    wide = FW.features_wide(lw, h)
    r = wide.where("user_id = 4").first()
    assert r.u_h_total_coupon == 0 and r.u_h_used == 0 and r.um_h_user_merchant_used == 0
    assert r.u_h_rate_used is None and r.u_h_used_mean_distance is None
    assert r.Distance is None and r.u_l_distance_rank is None
    assert wide.count() == lw.count() == 3


def test_history_ignores_label_window_changes(spark):
    lw, h = _frames(spark)
    extra = ROWS + [(3, 20, 200, "30:5", 1, "2016-07-08", "2016-07-09")] * 5
    p2 = parsed(receipts_df(spark, extra))
    h2 = history_window(p2, SCORING)
    a = sorted(map(tuple, H.user_features(H.pair_sums(h)).collect()))
    b = sorted(map(tuple, H.user_features(H.pair_sums(h2)).collect()))
    assert a == b


def test_a_stored_pair_holds_one_cutoff(spark):
    """A task's hash table of pairs grows with their sums: the stored table has those of one cutoff, and none twice."""
    from couponlens.plans import registry as R
    from couponlens.plans.params import SCORING, TRAINING

    from conftest import SMALL
    for w in (SCORING, TRAINING):
        sums = R.sums(spark, SMALL, w)
        assert len(sums.columns) == 2 + 10
        want = H.pair_sums(R.hist(spark, SMALL, w))
        assert sorted(map(tuple, sums.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
