"""Sources and sinks: fixed schemas and round trips (S1..S5)."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from couponlens.session import shared_dir
from couponlens.sources import importance as SI
from couponlens.sources import receipts as S
from couponlens.sources import sinks as SK

from conftest import MEDIUM, SMALL, receipts_df


def test_fixture_receipts_schema_and_rows(spark):
    df = S.fixture_receipts(spark, SMALL)
    assert [f.name for f in df.schema.fields] == S.RECEIPT_COLUMNS
    assert df.count() == 6000


def test_staged_receipts_prune_by_day(spark):
    from pyspark.sql import functions as F
    df = S.receipts(spark, SMALL).where(F.col("date_received") >= F.lit("2016-07-01").cast("date"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_received" in plan
    assert df.count() == 834


def test_importance_round_trip(spark, tmp_path):
    rows = [("a", 3.0), ("b", 10.0), ("c", 3.0)]
    df = spark.createDataFrame(rows, SI.IMPORTANCE_SCHEMA)
    path = f"{shared_dir(spark)}/imp-test"
    SI.write_importance(df, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == ["b,10.0", "a,3.0", "c,3.0"]
    back = SI.read_importance(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_receipts_csv(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("user_id,merchant_id,coupon_id,discount_rate,distance,date_received,date_used\n"
                 "1,2,3,150:20,null,2016-07-01,\n4,5,6,0.9,3,2016-07-02,2016-07-05\n")
    df = S.read_receipts_csv(spark, str(p))
    rows = sorted(df.collect())
    assert rows[0].distance is None and rows[0].date_used is None
    assert rows[1].distance == 3 and str(rows[1].date_used) == "2016-07-05"


BAD_LINES = ["1,2,3,0.9,4,01/07/2016,", "x9,2,3,0.9,4,2016-07-01,", "1,2,3,1:2:3,4,2016-07-01,", "1,2,3,12.5:5,4,2016-07-01,",
             "1,2,3,0.9,near,2016-07-01,", "1,2,3,0.9,4,2016-07-01,soon", "1,2,3,0.9,4", "1,2,3,0.9,4,2016-07-01,,7", "1,2,3,,4,2016-07-01,"]
REASONS = ["date_received", "user_id", "discount_rate", "discount_rate", "distance", "date_used", "columns", "columns", "discount_rate"]


def test_csv_rows_that_do_not_parse_are_never_passed_on(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("\n".join([",".join(S.RECEIPT_COLUMNS), "1,2,3,150:20,null,2016-07-01,null", *BAD_LINES]) + "\n")
    with pytest.raises(ValueError, match="9 of 10 receipts"):
        S.read_receipts_csv(spark, str(p))
    with pytest.raises(ValueError):
        S.read_receipts_csv(spark, str(p), max_rejected=0.89)
    out = str(tmp_path / "rejected")
    good = S.read_receipts_csv(spark, str(p), max_rejected=0.9, rejected_path=out)
    assert [r.coupon_id for r in good.collect()] == [3] and good.columns == S.RECEIPT_COLUMNS
    assert sorted(r.reason for r in spark.read.parquet(out).collect()) == sorted(REASONS)


def test_replaced_tables_are_read_anew(spark, tmp_path):
    """The same folder first holds the smallest tables, then ten times as many rows."""
    from couponlens.plans import registry as R
    for source, rows in ((SMALL, 6000), (MEDIUM, 60000)):
        for t in S.FIXTURE_TABLES:
            shutil.copyfile(f"{source}/{t}.parquet", tmp_path / f"{t}.parquet")
        assert R.QUERIES["coupon_type"](spark, str(tmp_path)).count() == rows
        assert R.QUERIES["receipts"](spark, str(tmp_path)).count() == rows


def test_report_and_feature_sinks(spark):
    base = shared_dir(spark)
    df = receipts_df(spark, [(1, 2, 3, "0.9", 1, "2016-07-01", None), (1, 2, 3, "0.9", 1, "2016-07-02", None)])
    counts = df.groupBy("date_received").count()
    SK.write_report(counts, f"{base}/rep", "date_received")
    assert sorted(map(tuple, SK.read_report(spark, f"{base}/rep").collect())) == [
        ("2016-07-01", "count", 1.0), ("2016-07-02", "count", 1.0)]
    SK.write_report(df.groupBy().count(), f"{base}/rep-one", None)
    assert list(map(tuple, SK.read_report(spark, f"{base}/rep-one").collect())) == [("all", "count", 2.0)]
    SK.write_features(df.limit(0), f"{base}/feat-none")
    assert SK.read_features(spark, f"{base}/feat-none", df.schema).count() == 0
    SK.write_features(df, f"{base}/feat")
    assert SK.read_features(spark, f"{base}/feat", df.schema).columns == df.columns
    local = base.removeprefix("file:")
    days = sorted(d for d in os.listdir(f"{local}/feat") if d.startswith("date_received="))
    assert days == ["date_received=2016-07-01", "date_received=2016-07-02"]


def test_dates_do_not_depend_on_session_settings(spark):
    from pyspark.sql import types as T
    other = spark.newSession()
    other.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    other.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    other.conf.set("spark.sql.ansi.enabled", "false")
    assert isinstance(S.table(other, SMALL, "orders").schema["o_orderdate"].dataType, T.TimestampType)
    a = S.fixture_receipts(spark, SMALL).groupBy("date_received", "date_used").count().collect()
    b = S.fixture_receipts(other, SMALL).groupBy("date_received", "date_used").count().collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_staged_fixture_shuffles_no_derived_column_and_bounds_its_files(spark):
    """Coupon and rate are added after the shuffle by day, and no file of a hot day holds more rows than a task may aggregate."""
    rows = S.fixture_rows(spark, SMALL)
    assert not {"coupon_id", "discount_rate"} & set(rows.columns)
    path = tempfile.mkdtemp(prefix="couponlens-rows-")
    S.write_receipts(rows, path, S.with_coupons, 10)
    got = S.read_receipts(spark, path)
    assert got.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 10
    assert got.exceptAll(S.fixture_receipts(spark, SMALL)).isEmpty() and got.count() == S.fixture_receipts(spark, SMALL).count()
    assert S.FIXTURE_FILE_ROWS <= 1 << 17
