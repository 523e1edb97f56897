"""One run over a receipts table: every report, the feature tables, the
model and its importance table, written under one output folder.

This is what the published outputs were: the chart data (Q1..Q9 and Q11 in
the long form of Q10) and the importance CSV. Everything is built from
the operators; nothing is collected.
"""

from __future__ import annotations

import inspect
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from couponlens.operators import features as FW
from couponlens.operators import history_features as HF
from couponlens.operators import model as M
from couponlens.operators import reports as Q
from couponlens.plans.params import SCORING, TRAINING, Windows
from couponlens.plans.windows import history_window, label_window
from couponlens.sources import importance as SI
from couponlens.sources import sinks as SK
from couponlens.sources.receipts import parsed, read_receipts, write_receipts

#: Report -> (operator, key column; None where the report is one row).
REPORTS = {
    "daily_receipts": (Q.daily_receipts, "date_received"),
    "peak_receipt_day": (Q.peak_receipt_day, "date_received"),
    "receipts_by_distance": (Q.receipts_by_distance, "distance"),
    "redeem_rate_by_distance": (Q.redeem_rate_by_distance, "distance"),
    "received_redeemed_by_rate": (Q.received_redeemed_by_rate, "discount"),
    "received_redeemed_by_weekday": (Q.received_redeemed_by_weekday, "weekday"),
    "coupon_type_share": (Q.coupon_type_share, "is_manjian"),
    "redeemed_type_share": (Q.redeemed_type_share, "is_manjian"),
    "label_share": (Q.label_share, "label"),
    "missing_distance": (Q.missing_distance, None),
}


@dataclass(frozen=True)
class Campaign:
    """``label`` is the label of the reports: ``label_rule`` (T6) or ``label_redeemed`` (T5)."""

    scoring: Windows = SCORING
    training: Windows = TRAINING
    label: str = Q.LABEL
    params: M.TreeParams = M.TreeParams()
    fit_model: bool = True


def run(spark: SparkSession, receipts: DataFrame | str, out: str, c: Campaign = Campaign()) -> dict[str, str]:
    """Write all outputs under ``out``; returns output name -> path.

    ``receipts`` is a DataFrame, or the path of a table that is stored by
    day already, which is read as it is and not written again. A label
    window without receipts is an error, raised before anything is written.
    """
    out = out.rstrip("/")
    paths: dict[str, str] = {}
    if c.label not in ("label_rule", "label_redeemed"):
        raise ValueError(f"label must be label_rule or label_redeemed, not {c.label!r}")
    given = read_receipts(spark, receipts) if isinstance(receipts, str) else receipts
    for name, w in (("scoring", c.scoring), *((("training", c.training),) if c.fit_model else ())):
        if label_window(parsed(given), w).isEmpty():
            raise ValueError(f"no receipt falls into the {name} window, {w.l_start} to {w.l_end}")

    # Receipts once, by day: every later step prunes days and reads columns.
    if isinstance(receipts, str):
        paths["receipts"] = receipts
    else:
        paths["receipts"] = f"{out}/receipts"
        write_receipts(receipts, paths["receipts"])
    p = parsed(read_receipts(spark, paths["receipts"]))

    lw, hist = label_window(p, c.scoring), history_window(p, c.scoring)
    counts = Q.report_cube(lw)
    SK.write_table(counts, f"{out}/reports/_cube")
    cube = SK.read_table(spark, f"{out}/reports/_cube", counts.schema)
    for name, (fn, key) in REPORTS.items():
        paths[name] = f"{out}/reports/{name}"
        labelled = {"label": c.label} if "label" in inspect.signature(fn).parameters else {}
        SK.write_report(fn(cube, **labelled), paths[name], key)

    def kept(table: DataFrame, name: str) -> DataFrame:
        SK.write_table(table, f"{out}/features/_{name}")
        return SK.read_table(spark, f"{out}/features/_{name}", table.schema)

    # History is aggregated once for the cutoffs of both windows.
    windows = [c.scoring, c.training] if c.fit_model else [c.scoring]
    pairs, coupons = kept(HF.pair_sums_at(p, windows), "pairsums"), kept(HF.coupon_sums_at(p, windows), "couponsums")

    def features(w: Windows, label_window_rows: DataFrame, history_rows: DataFrame, name: str,
                 carry: tuple[str, ...] = ()) -> DataFrame:
        sums = HF.of_window(pairs, windows.index(w))
        packed = FW.packed_tables(label_window_rows, sums, HF.of_window(coupons, windows.index(w)))
        packed = {e: kept(t, f"packed_{e}_{name}") for e, t in packed.items()}
        paths[name] = f"{out}/features/{name}"
        wide = FW.features_wide(label_window_rows, history_rows, carry=carry, sums=sums, packed=packed)
        SK.write_features(wide, paths[name])
        return SK.read_features(spark, paths[name], wide.schema)

    scoring = features(c.scoring, lw, hist, "scoring")
    if not c.fit_model:
        return paths
    train = features(c.training, label_window(p, c.training), history_window(p, c.training), "training",
                     carry=("label_redeemed",)).withColumnRenamed("label_redeemed", "label")
    model = M.fit(train, c.params)
    paths["model"] = f"{out}/model"
    model.write().overwrite().save(paths["model"])
    paths["importance"] = f"{out}/importance"
    SI.write_importance(M.importance_splits(spark, paths["model"]), paths["importance"])
    paths["scores"] = f"{out}/scores"
    SK.write_table(M.score(model, scoring), paths["scores"])
    return paths
