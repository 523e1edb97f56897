"""A full run from a CSV of receipts equals the registered queries."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from couponlens import __main__ as M
from couponlens.plans import campaign
from couponlens.plans import registry as R
from couponlens.plans.params import SCORING, TRAINING, Windows
from couponlens.session import shared_dir
from couponlens.sources import receipts as S
from couponlens.sources import sinks as SK

from conftest import SMALL


def test_campaign_from_compact_csv(spark):
    base = shared_dir(spark)
    rec = S.fixture_receipts(spark, SMALL)
    # Written the way such exports often are: compact dates, the text "null".
    text = rec.select(
        *[F.col(c).cast("string") for c in ("user_id", "merchant_id", "coupon_id", "discount_rate")],
        F.coalesce(F.col("distance").cast("string"), F.lit("null")).alias("distance"),
        F.date_format("date_received", "yyyyMMdd").alias("date_received"),
        F.coalesce(F.date_format("date_used", "yyyyMMdd"), F.lit("null")).alias("date_used"))
    text.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{base}/csv-in")
    back = S.read_receipts_csv(spark, f"{base}/csv-in", date_format="yyyyMMdd")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rec.collect()), key=str)

    paths = campaign.run(spark, back, f"{base}/campaign")
    for name, (_, key) in campaign.REPORTS.items():
        got = sorted(map(tuple, SK.read_report(spark, paths[name]).collect()), key=str)
        want = sorted(map(tuple, SK.long_form(R.QUERIES[name](spark, SMALL), key).collect()), key=str)
        assert got == want, name
    wide = spark.read.parquet(paths["scoring"]).select(*R.QUERIES["features_wide"](spark, SMALL).columns)
    assert sorted(map(tuple, wide.collect()), key=str) == \
        sorted(map(tuple, R.QUERIES["features_wide"](spark, SMALL).collect()), key=str)
    lines = spark.read.text(paths["importance"]).collect()
    assert len(lines) == 56
    assert spark.read.parquet(paths["scores"]).count() == 834


def test_a_year_later(spark):
    """2017 receipts with 2017 windows give the July 2016 campaign, shifted by 52 weeks (weekdays stay)."""
    base, days = shared_dir(spark), 364
    rec = S.fixture_receipts(spark, SMALL)
    later = rec.withColumns({c: F.date_add(c, days) for c in ("date_received", "date_used")})
    S.write_receipts(later, f"{base}/receipts-2017")
    shift = lambda d: str(d + dt.timedelta(days=days))
    w = [shift(d) for d in (SCORING.l_start, SCORING.l_end, TRAINING.l_start, TRAINING.l_end)]
    a = M.arguments([f"{base}/receipts-2017", f"{base}/out-2017", "--l-start", w[0], "--l-end", w[1], "--train-start", w[2],
                     "--train-end", w[3], "--label", "label_redeemed", "--no-model"])
    assert S.is_stored(spark, a.receipts)
    got = campaign.run(spark, a.receipts, a.out, M.campaign_of(a))
    want = campaign.run(spark, rec, f"{base}/out-2016", campaign.Campaign(label="label_redeemed", fit_model=False))
    assert got["receipts"] == a.receipts  # stored by day already: not written again
    for name, (_, key) in campaign.REPORTS.items():
        old = SK.read_report(spark, want[name])
        if key == "date_received":
            old = old.withColumn("key", F.date_add(F.col("key").cast("date"), days).cast("string"))
        assert sorted(map(tuple, SK.read_report(spark, got[name]).collect()), key=str) == sorted(map(tuple, old.collect()), key=str), name
    new = spark.read.parquet(got["scoring"]).withColumn("date_received", F.date_sub("date_received", days))
    assert sorted(map(str, new.collect())) == sorted(map(str, spark.read.parquet(want["scoring"]).select(*new.columns).collect()))


def test_an_empty_window_is_refused_before_anything_is_written(spark, tmp_path):
    rec = S.fixture_receipts(spark, SMALL)
    c = campaign.Campaign(scoring=Windows(dt.date(2031, 1, 1), dt.date(2031, 1, 31)))
    with pytest.raises(ValueError, match="scoring window"):
        campaign.run(spark, rec, str(tmp_path / "out"), c)
    assert not (tmp_path / "out").exists()
    with pytest.raises(ValueError, match="label"):
        campaign.run(spark, rec, str(tmp_path / "out"), campaign.Campaign(label="other"))
