"""Command line: ``python -m couponlens RECEIPTS OUT [options]``.

RECEIPTS is a parquet table (or CSV with ``--csv``) with the receipt
columns in schema order; OUT receives reports, features, model,
importance CSV and scores, and the CSV rows that do not parse. A parquet
table in ``date_received=`` folders is used as it is. Run it with
spark-submit on a cluster; set ``spark.checkpoint.dir`` to a shared folder
there. Partition settings follow the size of the input.
"""

from __future__ import annotations

import argparse
import datetime as dt

from couponlens.operators.reports import LABEL
from couponlens.plans import campaign
from couponlens.plans.params import SCORING, TRAINING, Windows
from couponlens.session import apply_scale, build_session, shared_dir
from couponlens.sources.receipts import RECEIPT_SCHEMA, is_stored, read_receipts_csv


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    day = dt.date.fromisoformat
    ap = argparse.ArgumentParser(prog="couponlens")
    ap.add_argument("receipts")
    ap.add_argument("out")
    ap.add_argument("--csv", action="store_true", help="receipts are CSV with a header row")
    ap.add_argument("--date-format", default="yyyy-MM-dd", help="Spark datetime pattern of CSV dates")
    ap.add_argument("--max-rejected", type=float, default=0.0, help="share of CSV rows that may fail to parse")
    ap.add_argument("--l-start", type=day, default=SCORING.l_start, help="first day of the label window")
    ap.add_argument("--l-end", type=day, default=SCORING.l_end, help="last day of the label window")
    ap.add_argument("--train-start", type=day, default=TRAINING.l_start, help="first day of the training window")
    ap.add_argument("--train-end", type=day, default=TRAINING.l_end, help="last day of the training window")
    ap.add_argument("--redeem-days", type=int, default=SCORING.redeem_days, help="days within which a redemption counts")
    ap.add_argument("--rule-cut", type=float, default=SCORING.rule_cut, help="rate up to which the rule label is 1")
    ap.add_argument("--label", choices=["label_rule", "label_redeemed"], default=LABEL, help="label of the reports")
    ap.add_argument("--no-model", action="store_true", help="reports and features only")
    return ap.parse_args(argv)


def campaign_of(a: argparse.Namespace) -> campaign.Campaign:
    window = lambda start, end: Windows(start, end, a.redeem_days, a.rule_cut)
    return campaign.Campaign(scoring=window(a.l_start, a.l_end), training=window(a.train_start, a.train_end),
                             label=a.label, fit_model=not a.no_model)


def main(argv: list[str] | None = None) -> None:
    a = arguments(argv)
    spark = build_session()
    shared_dir(spark)
    apply_scale(spark, a.receipts)
    if a.csv:
        rec = read_receipts_csv(spark, a.receipts, date_format=a.date_format, max_rejected=a.max_rejected,
                                rejected_path=f"{a.out.rstrip('/')}/rejected")
    elif is_stored(spark, a.receipts):
        rec = a.receipts
    else:
        rec = spark.read.schema(RECEIPT_SCHEMA).parquet(a.receipts)
    for name, path in campaign.run(spark, rec, a.out, campaign_of(a)).items():
        print(f"{name}\t{path}")


if __name__ == "__main__":
    main()
