"""Plan shape: the properties that matter at scale, checked on the physical plan."""

from couponlens.operators import features as FW
from couponlens.plans import registry as R

from conftest import SMALL


def _feature_build(spark):
    """The plan that builds F57 (the query itself returns the stored result)."""
    return FW.features_wide(R.lw(spark, SMALL), R.hist(spark, SMALL), sums=R.sums(spark, SMALL), coupons=R.coupon_sums(spark, SMALL))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _tree(plan: str):
    """(depth, node text) per line of a plan string."""
    out = []
    for line in plan.splitlines():
        stripped = line.lstrip(" :|+-")
        if stripped:
            out.append((len(line) - len(stripped), stripped))
    return out


def test_no_window_over_raw_receipts(spark):
    """Every Window in the feature plan runs on aggregated rows, never on a scan."""
    plan = _tree(_plan(_feature_build(spark)))
    windows = 0
    for i, (depth, node) in enumerate(plan):
        if not node.startswith("Window "):
            continue
        windows += 1
        for d, below in plan[i + 1:]:
            if d <= depth:
                break
            if below.startswith(("HashAggregate", "ObjectHashAggregate", "SortAggregate")):
                break
            assert not below.startswith(("FileScan", "Scan ")), f"window over a scan: {node[:80]}"
    assert windows >= 4  # three of the user, one of user and coupon; merchants and coupons are packed rows


def test_reports_aggregate_before_shuffle(spark):
    from couponlens.operators import reports as Q
    build = _plan(Q.report_cube(R.lw(spark, SMALL)))
    assert "partial_count" in build and "PartitionFilters: [isnotnull(date_received" in build
    plan = _plan(R.QUERIES["received_redeemed_by_weekday"](spark, SMALL))
    # It reads the stored cube (its weight column), not the receipts.
    assert "partial_sum" in plan and "weight:bigint" in plan and "discount_rate" not in plan


def test_label_window_is_pruned_and_projected(spark):
    from couponlens.operators import reports as Q
    plan = _plan(Q.daily_receipts(R.lw(spark, SMALL)))
    assert "PartitionFilters: [isnotnull(date_received" in plan
    assert "ReadSchema: struct<>" in plan or "ReadSchema: struct<discount_rate" in plan


def test_no_python_udf_in_feature_plan(spark):
    plan = _plan(_feature_build(spark))
    assert "Window" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
