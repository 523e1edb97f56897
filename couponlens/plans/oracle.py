"""DuckDB SQL for each registered query: the independent correctness oracle.

code). The test tables are registered as views by the caller. Casts follow
BIGINT, so both are cast to match Spark's types; ``2.0e0`` keeps arithmetic
in DOUBLE.
"""

from __future__ import annotations

from couponlens.operators.feature_names import FEATURE_NAMES
from couponlens.plans.params import SCORING, TRAINING, Windows

# Fixed values of the fixture mapping (FIXTURES.md section 2).
_RATE_CASE = """CASE (l.l_suppkey * 20 + l.l_partkey % 20) % 11
      WHEN 0 THEN '10:5' WHEN 1 THEN '30:5' WHEN 2 THEN '20:5' WHEN 3 THEN '100:10'
      WHEN 4 THEN '150:20' WHEN 5 THEN '50:10' WHEN 6 THEN '30:1' WHEN 7 THEN '0.95'
      WHEN 8 THEN '0.9' WHEN 9 THEN '0.8' WHEN 10 THEN '15:10' END"""

RECEIPTS = f"""receipts AS (
  SELECT o.o_custkey AS user_id,
    l.l_suppkey AS merchant_id,
    l.l_suppkey * 20 + l.l_partkey % 20 AS coupon_id,
    {_RATE_CASE} AS discount_rate,
    CAST(CASE WHEN l.l_linenumber <> 7 THEN least(abs(c.c_nationkey - s.s_nationkey), 10) END AS INTEGER) AS distance,
    CAST(DATE '2016-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) % 213 AS INTEGER) AS DATE) AS date_received,
    CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN
      CAST(DATE '2016-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(o.o_orderdate AS DATE)) % 213 AS INTEGER)
           + CAST(CAST(l.l_quantity AS INTEGER) % 20 AS INTEGER) AS DATE) END AS date_used
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
)"""

PARSED = """parsed AS (
  SELECT *,
    round(CASE WHEN contains(discount_rate, ':')
      THEN 1.0e0 - TRY_CAST(string_split(discount_rate, ':')[2] AS DOUBLE) / TRY_CAST(string_split(discount_rate, ':')[1] AS DOUBLE)
      ELSE TRY_CAST(discount_rate AS DOUBLE) END, 4) AS discount,
    CAST(contains(discount_rate, ':') AS INTEGER) AS is_manjian,
    CASE WHEN contains(discount_rate, ':') THEN TRY_CAST(string_split(discount_rate, ':')[1] AS INTEGER) END AS price_before
  FROM receipts
)"""


def _lw(w: Windows, name: str = "lw") -> str:
    return f"""{name} AS (
  SELECT *,
    CAST(discount <= {w.rule_cut} AS INTEGER) AS label_rule,
    CASE WHEN date_used IS NOT NULL AND date_diff('day', date_received, date_used) <= {w.redeem_days} THEN 1 ELSE 0 END AS label_redeemed
  FROM parsed
  WHERE date_received BETWEEN DATE '{w.l_start}' AND DATE '{w.l_end}'
)"""


def _hist(w: Windows, name: str = "hist") -> str:
    return f"""{name} AS (
  SELECT user_id, merchant_id, coupon_id, discount_rate, distance, date_received,
    CASE WHEN date_used < DATE '{w.cutoff}' THEN date_used END AS date_used,
    discount, is_manjian, price_before,
    CAST(date_used IS NOT NULL AND date_used < DATE '{w.cutoff}' AS INTEGER) AS used,
    CAST(date_used IS NOT NULL AND date_used < DATE '{w.cutoff}'
         AND date_diff('day', date_received, date_used) <= {w.redeem_days} AS INTEGER) AS rec_used
  FROM parsed
  WHERE date_received < DATE '{w.cutoff}'
)"""


def with_base(body: str, w: Windows = SCORING) -> str:
    """``body`` preceded by the receipt, parse, label-window and history CTEs."""
    return f"WITH {RECEIPTS},\n{PARSED},\n{_lw(w)},\n{_hist(w)}\n{body}"


LW_KEYS = "user_id, merchant_id, coupon_id, date_received"


def _t(expr: str, alias: str, source: str = "parsed") -> str:
    return with_base(f"SELECT {LW_KEYS}, {expr} AS {alias} FROM {source}")


ORACLE: dict[str, str] = {}

# ---- S1, T1..T13 -------------------------------------------------------------
ORACLE["receipts"] = with_base(
    "SELECT user_id, merchant_id, coupon_id, discount_rate, distance, date_received, date_used FROM receipts")
ORACLE["coupon_type"] = _t("is_manjian", "is_manjian")
ORACLE["discount_value"] = _t("discount", "discount")
ORACLE["price_before"] = _t("price_before", "price_before")
ORACLE["distance_clean"] = _t("distance", "distance")
ORACLE["label_redeemed"] = _t(
    f"CASE WHEN date_used IS NOT NULL AND date_diff('day', date_received, date_used) <= {SCORING.redeem_days} THEN 1 ELSE 0 END",
    "label_redeemed")
ORACLE["label_rule"] = _t(f"CAST(discount <= {SCORING.rule_cut} AS INTEGER)", "label_rule")
ORACLE["weekday"] = _t("CAST(isodow(date_received) AS INTEGER)", "weekday")
ORACLE["redeem_lag"] = _t("CAST(date_diff('day', date_received, date_used) AS INTEGER)", "redeem_lag")
ORACLE["label_window"] = with_base(
    "SELECT user_id, merchant_id, coupon_id, discount_rate, distance, date_received, date_used, "
    "discount, is_manjian, price_before, label_rule, label_redeemed FROM lw")
ORACLE["history_window"] = with_base(
    "SELECT user_id, merchant_id, coupon_id, discount_rate, distance, date_received, date_used, "
    "discount, is_manjian, price_before, used, rec_used FROM hist")
ORACLE["with_distance"] = with_base(
    "SELECT user_id, merchant_id, coupon_id, discount_rate, distance, date_received, date_used, "
    "discount, is_manjian, price_before, label_rule, label_redeemed FROM lw WHERE distance IS NOT NULL")
ORACLE["ratio"] = with_base(
    "SELECT CAST(isodow(date_received) AS INTEGER) AS weekday, count(*) AS received, "
    "CAST(sum(label_redeemed) AS BIGINT) AS redeemed, "
    "CAST(sum(label_redeemed) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate FROM lw GROUP BY 1")
ORACLE["zero_fill"] = with_base(
    "SELECT d.date_received, d.received, COALESCE(r.redeemed, 0) AS redeemed FROM "
    "(SELECT date_received, count(*) AS received FROM lw GROUP BY 1) d LEFT JOIN "
    "(SELECT date_received, count(*) AS redeemed FROM lw WHERE label_redeemed = 1 GROUP BY 1) r "
    "ON d.date_received = r.date_received")

# ---- Q1..Q11, J3, O1 ---------------------------------------------------------
ORACLE["daily_receipts"] = with_base("SELECT date_received, count(*) AS received FROM lw GROUP BY date_received")
ORACLE["peak_receipt_day"] = with_base(
    "SELECT date_received, received FROM (SELECT date_received, count(*) AS received FROM lw GROUP BY 1) d "
    "WHERE received = (SELECT max(received) FROM (SELECT count(*) AS received FROM lw GROUP BY date_received))")
ORACLE["receipts_by_distance"] = with_base(
    "SELECT distance, count(*) AS received FROM lw WHERE distance IS NOT NULL GROUP BY distance")
ORACLE["redeem_rate_by_distance"] = with_base(
    "SELECT distance, count(*) AS received, CAST(sum(label_rule) AS BIGINT) AS redeemed, "
    "CAST(sum(label_rule) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS rate "
    "FROM lw WHERE distance IS NOT NULL GROUP BY distance")
ORACLE["received_redeemed_by_rate"] = with_base(
    "SELECT discount, count(*) AS received, CAST(sum(label_rule) AS BIGINT) AS redeemed FROM lw GROUP BY discount")
ORACLE["received_redeemed_by_weekday"] = with_base(
    "SELECT CAST(isodow(date_received) AS INTEGER) AS weekday, count(*) AS received, "
    "CAST(sum(label_rule) AS BIGINT) AS redeemed FROM lw GROUP BY 1")
ORACLE["coupon_type_share"] = with_base(
    "SELECT is_manjian, count(*) AS received, "
    "CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM lw GROUP BY is_manjian")
ORACLE["redeemed_type_share"] = with_base(
    "SELECT is_manjian, count(*) AS redeemed, "
    "CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share "
    "FROM lw WHERE label_rule = 1 GROUP BY is_manjian")
ORACLE["label_share"] = with_base(
    "SELECT label_rule AS label, count(*) AS n, "
    "CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share FROM lw GROUP BY label_rule")
ORACLE["report_long"] = with_base(
    "SELECT weekday AS key, series, value FROM ("
    "SELECT CAST(isodow(date_received) AS INTEGER) AS weekday, count(*) AS received, "
    "CAST(sum(label_rule) AS BIGINT) AS redeemed FROM lw GROUP BY 1) "
    "UNPIVOT (value FOR series IN (received, redeemed))")
ORACLE["missing_distance"] = with_base(
    "SELECT count(*) AS received, CAST(COALESCE(sum(label_rule), 0) AS BIGINT) AS redeemed "
    "FROM lw WHERE distance IS NULL")
ORACLE["received_left_join_redeemed"] = with_base(
    "SELECT a.discount, a.received, COALESCE(b.redeemed, 0) AS redeemed FROM "
    "(SELECT discount, count(*) AS received FROM lw GROUP BY discount) a LEFT JOIN "
    "(SELECT discount, count(*) AS redeemed FROM lw WHERE label_rule = 1 GROUP BY discount) b "
    "ON a.discount = b.discount")
ORACLE["sort_by_key"] = with_base(
    "SELECT date_received, count(*) AS received FROM lw GROUP BY date_received ORDER BY date_received")

# ---- W1..W5 ------------------------------------------------------------------
ORACLE["avg_rank_desc"] = with_base(
    f"SELECT {LW_KEYS}, distance, CASE WHEN distance IS NOT NULL THEN "
    "rank() OVER (PARTITION BY merchant_id ORDER BY distance DESC NULLS LAST) "
    "+ (count(*) OVER (PARTITION BY merchant_id, distance) - 1) / 2.0e0 END AS avg_rank_desc FROM lw")
ORACLE["avg_rank_asc"] = with_base(
    f"SELECT {LW_KEYS}, distance, CASE WHEN distance IS NOT NULL THEN "
    "rank() OVER (PARTITION BY merchant_id ORDER BY distance ASC NULLS LAST) "
    "+ (count(*) OVER (PARTITION BY merchant_id, distance) - 1) / 2.0e0 END AS avg_rank_asc FROM lw")
ORACLE["partition_count"] = with_base(
    f"SELECT {LW_KEYS}, count(*) OVER (PARTITION BY user_id, coupon_id) AS partition_count FROM lw")
ORACLE["first_last_flag"] = with_base(
    f"SELECT {LW_KEYS}, "
    "CAST(date_received = min(date_received) OVER (PARTITION BY user_id) AS INTEGER) AS is_first, "
    "CAST(date_received = max(date_received) OVER (PARTITION BY user_id) AS INTEGER) AS is_last FROM lw")
ORACLE["share_of_total"] = ORACLE["coupon_type_share"]


# ---- features ----------------------------------------------------------------
def _rank_sql(key: str, v: str, desc_name: str, asc_name: str) -> str:
    tie = f"(count(*) OVER (PARTITION BY {key}, {v}) - 1) / 2.0e0"
    return (f"CASE WHEN {v} IS NOT NULL THEN rank() OVER (PARTITION BY {key} ORDER BY {v} DESC NULLS LAST) + {tie} END AS {desc_name},\n"
            f"    CASE WHEN {v} IS NOT NULL THEN rank() OVER (PARTITION BY {key} ORDER BY {v} ASC NULLS LAST) + {tie} END AS {asc_name}")


def _ranks_sql(key: str, names: list[tuple[str, str, str]]) -> str:
    """``names``: (ranked column, descending feature, ascending feature)."""
    return ",\n    ".join(_rank_sql(key, f"r.{v}", d, a) for v, d, a in names)


_U_RANKS = [("date_received", "u_l_date_received_rank", "u_l_date_received_rank_ascend"),
            ("distance", "u_l_distance_rank", "u_l_distance_rank_ascend"),
            ("discount", "u_l_discount_rate_rank", "u_l_discount_rate_rank_ascend")]
_M_RANKS = [("date_received", "m_l_date_received_rank", "m_l_date_received_rank_ascend"),
            ("distance", "m_l_distance_rank", "m_l_distance_rank_ascend"),
            ("discount", "m_l_discount_rate_rank", "m_l_discount_rate_rank_ascend")]
_C_RANKS = [("date_received", "c_l_date_received_rank", "c_l_date_received_rank_ascend"),
            ("distance", "c_l_distance_rank", "c_l_distance_rank_ascend"),
            ("discount", "c_l_discount_rate_rank", "c_l_discount_rate_rank_ascend")]


def label_features_cte(src: str = "lw", name: str = "lf") -> str:
    return f"""{name} AS (
  SELECT r.user_id, r.merchant_id, r.coupon_id, r.date_received,
    r.discount, r.price_before, r.distance AS Distance, r.is_manjian, r.label_redeemed,
    count(*) OVER (PARTITION BY r.user_id) AS u_l_total_coupon,
    count(*) OVER (PARTITION BY r.user_id, r.coupon_id) AS u_l_this_coupon,
    count(*) OVER (PARTITION BY r.user_id, r.date_received) AS u_l_today_coupon,
    count(*) OVER (PARTITION BY r.user_id, r.coupon_id, r.date_received) AS u_l_today_this_coupon,
    CAST(r.date_received = min(r.date_received) OVER (PARTITION BY r.user_id) AS INTEGER) AS u_l_if_is_first_received,
    CAST(r.date_received = max(r.date_received) OVER (PARTITION BY r.user_id) AS INTEGER) AS u_l_if_is_last_received,
    {_ranks_sql("r.user_id", _U_RANKS)},
    count(*) OVER (PARTITION BY r.merchant_id) AS m_l_howmuch_coupon,
    count(*) OVER (PARTITION BY r.merchant_id, r.date_received) AS m_l_howmuch_coupon_today,
    k.kinds AS m_l_howmuch_kindof_coupon,
    kd.kinds AS m_l_howmuch_kindof_coupon_today,
    {_ranks_sql("r.merchant_id", _M_RANKS)},
    count(*) OVER (PARTITION BY r.coupon_id) AS c_l_total_received,
    {_ranks_sql("r.coupon_id", _C_RANKS)}
  FROM {src} r
  LEFT JOIN (SELECT merchant_id, count(DISTINCT coupon_id) AS kinds FROM {src} GROUP BY merchant_id) k
    ON r.merchant_id = k.merchant_id
  LEFT JOIN (SELECT merchant_id, date_received, count(DISTINCT coupon_id) AS kinds FROM {src}
             GROUP BY merchant_id, date_received) kd
    ON r.merchant_id = kd.merchant_id AND r.date_received = kd.date_received
)"""


def history_ctes(src: str = "hist") -> str:
    ratio = "CAST(sum({n}) AS DOUBLE) / CAST(count(*) AS DOUBLE)"
    return f"""mh AS (
  SELECT merchant_id, count(*) AS m_h_total_coupon, CAST(sum(rec_used) AS BIGINT) AS m_h_rec_used,
    {ratio.format(n="used")} AS m_h_rate_used
  FROM {src} GROUP BY merchant_id
),
ch AS (
  SELECT coupon_id, count(*) AS c_h_total_coupon, CAST(sum(used) AS BIGINT) AS c_h_used,
    CAST(sum(1 - used) AS BIGINT) AS c_h_not_use, {ratio.format(n="used")} AS c_h_rate_used
  FROM {src} GROUP BY coupon_id
),
umd AS (
  SELECT user_id, merchant_id, avg(distance) AS d FROM {src} WHERE used = 1 GROUP BY user_id, merchant_id
),
uh AS (
  SELECT a.*, b.u_h_used_mean_distance FROM (
    SELECT user_id, count(*) AS u_h_total_coupon, CAST(sum(used) AS BIGINT) AS u_h_used,
      CAST(sum(1 - used) AS BIGINT) AS u_h_not_use, {ratio.format(n="used")} AS u_h_rate_used,
      count(DISTINCT merchant_id) AS u_h_howmuch_merchant,
      count(DISTINCT CASE WHEN used = 1 THEN merchant_id END) AS u_h_used_howmuch_merchant,
      CAST(count(DISTINCT CASE WHEN used = 1 THEN merchant_id END) AS DOUBLE)
        / CAST(count(DISTINCT merchant_id) AS DOUBLE) AS u_h_rate_used_howmuch_merchant,
      avg(CASE WHEN used = 1 THEN date_diff('day', date_received, date_used) END) AS u_h_timedelta_rec_use,
      avg(CASE WHEN used = 1 THEN CAST(round(discount * 10000) AS INTEGER) END) / 10000 AS u_h_used_average_discount,
      avg(CASE WHEN used = 1 THEN distance END) AS u_h_used_average_distance
    FROM {src} GROUP BY user_id) a
  LEFT JOIN (SELECT user_id, round(avg(d), 6) AS u_h_used_mean_distance FROM umd GROUP BY user_id) b
    ON a.user_id = b.user_id
),
umh AS (
  SELECT user_id, merchant_id, avg(distance) AS um_h_user_merchant_mean_distance,
    CAST(sum(used) AS BIGINT) AS um_h_user_merchant_used,
    {ratio.format(n="used")} AS um_h_user_merchant_used_rate,
    CAST(sum(rec_used) AS BIGINT) AS um_h_user_merchant_rec_used,
    {ratio.format(n="rec_used")} AS um_h_user_merchant_rec_used_rate
  FROM {src} GROUP BY user_id, merchant_id
)"""


_H_ENTITY = {
    "uh": ("user_id", ["u_h_total_coupon", "u_h_used", "u_h_not_use", "u_h_rate_used", "u_h_howmuch_merchant",
                       "u_h_used_howmuch_merchant", "u_h_rate_used_howmuch_merchant", "u_h_timedelta_rec_use",
                       "u_h_used_average_discount", "u_h_used_average_distance", "u_h_used_mean_distance"]),
    "mh": ("merchant_id", ["m_h_total_coupon", "m_h_rec_used", "m_h_rate_used"]),
    "ch": ("coupon_id", ["c_h_total_coupon", "c_h_used", "c_h_not_use", "c_h_rate_used"]),
    "umh": ("user_id, merchant_id", ["um_h_user_merchant_mean_distance", "um_h_user_merchant_used",
                                     "um_h_user_merchant_used_rate", "um_h_user_merchant_rec_used",
                                     "um_h_user_merchant_rec_used_rate"]),
}
_H_COUNTS = {"u_h_total_coupon", "u_h_used", "u_h_not_use", "u_h_howmuch_merchant", "u_h_used_howmuch_merchant",
             "m_h_total_coupon", "m_h_rec_used", "c_h_total_coupon", "c_h_used", "c_h_not_use",
             "um_h_user_merchant_used", "um_h_user_merchant_rec_used"}
_L_FEATURES = ["discount", "price_before", "Distance", "is_manjian",
               "u_l_total_coupon", "u_l_this_coupon", "u_l_today_coupon", "u_l_today_this_coupon",
               "u_l_if_is_first_received", "u_l_if_is_last_received",
               *[n for _, d, a in _U_RANKS for n in (d, a)],
               "m_l_howmuch_coupon", "m_l_howmuch_coupon_today", "m_l_howmuch_kindof_coupon",
               "m_l_howmuch_kindof_coupon_today",
               *[n for _, d, a in _M_RANKS for n in (d, a)],
               "c_l_total_received",
               *[n for _, d, a in _C_RANKS for n in (d, a)]]
_ALL_H = [f for _, fs in _H_ENTITY.values() for f in fs]


def wide_select(lf: str = "lf", label: bool = False) -> str:
    hcols = ",\n  ".join(f"COALESCE({f}, 0) AS {f}" if f in _H_COUNTS else f for f in _ALL_H)
    return f"""SELECT f.user_id, f.merchant_id, f.coupon_id, f.date_received,
  {", ".join("f." + c for c in _L_FEATURES)},
  {hcols}{", f.label_redeemed AS label" if label else ""}
FROM {lf} f
LEFT JOIN uh ON f.user_id = uh.user_id
LEFT JOIN mh ON f.merchant_id = mh.merchant_id
LEFT JOIN ch ON f.coupon_id = ch.coupon_id
LEFT JOIN umh ON f.user_id = umh.user_id AND f.merchant_id = umh.merchant_id"""


def _features_base(body: str, w: Windows = SCORING) -> str:
    return (f"WITH {RECEIPTS},\n{PARSED},\n{_lw(w)},\n{_hist(w)},\n"
            f"{label_features_cte()},\n{history_ctes()}\n{body}")


for _f in _L_FEATURES:
    ORACLE[f"f_{_f}"] = _features_base(f"SELECT {LW_KEYS}, {_f} FROM lf")
for _tbl, (_k, _fs) in _H_ENTITY.items():
    for _f in _fs:
        ORACLE[f"f_{_f}"] = _features_base(f"SELECT {_k}, {_f} FROM {_tbl}")
ORACLE["f_distance"] = ORACLE["f_Distance"]
ORACLE["features_wide"] = _features_base(wide_select())
ORACLE["features_entity_join"] = _features_base(
    f"SELECT l.user_id, l.merchant_id, l.coupon_id, l.date_received, "
    + ", ".join(f"COALESCE({f}, 0) AS {f}" if f in _H_COUNTS else f
                for t in ("uh", "mh", "ch") for f in _H_ENTITY[t][1])
    + " FROM lw l LEFT JOIN uh ON l.user_id = uh.user_id LEFT JOIN mh ON l.merchant_id = mh.merchant_id "
      "LEFT JOIN ch ON l.coupon_id = ch.coupon_id")
ORACLE["features_pair_join"] = _features_base(
    f"SELECT l.user_id, l.merchant_id, l.coupon_id, l.date_received, "
    + ", ".join(f"COALESCE({f}, 0) AS {f}" if f in _H_COUNTS else f for f in _H_ENTITY["umh"][1])
    + " FROM lw l LEFT JOIN umh ON l.user_id = umh.user_id AND l.merchant_id = umh.merchant_id")
ORACLE["kinds_join_back"] = _features_base(
    f"SELECT {LW_KEYS}, m_l_howmuch_kindof_coupon, m_l_howmuch_kindof_coupon_today FROM lf")

# ---- M1, S4, S5 (the rest of section 2.8 has no SQL form) --------------------
ORACLE["train_set"] = _features_base(wide_select(label=True), TRAINING)
ORACLE["report_sink"] = (
    "SELECT CAST(weekday AS VARCHAR) AS key, series, CAST(value AS DOUBLE) AS value FROM ("
    f"{ORACLE['received_redeemed_by_weekday']}) UNPIVOT (value FOR series IN (received, redeemed))")
ORACLE["features_sink"] = ORACLE["features_wide"]


# ---- M2, M6, O2, S2, S3: over tables that SQL can state -----------------------
ORACLE["assemble"] = (
    f"SELECT {LW_KEYS}, " + ", ".join(f"COALESCE(CAST({f} AS DOUBLE), -1.0) AS {f}" for f in FEATURE_NAMES)
    + f", label FROM ({ORACLE['train_set']})")
_FILLED = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST(count({f}) AS DOUBLE) AS importance FROM wide" for f in FEATURE_NAMES)
_FILLED = f"WITH wide AS ({ORACLE['features_wide']}), filled AS ({_FILLED}) "
ORACLE["sort_by_importance"] = ORACLE["importance_csv"] = f"{_FILLED} SELECT feature, importance FROM filled"
ORACLE["importance_sink"] = f"{_FILLED} SELECT feature || ',' || CAST(importance AS VARCHAR) AS line FROM filled"
ORACLE["importance_by_family"] = (
    f"{_FILLED} SELECT COALESCE(NULLIF(regexp_extract(feature, '^(um_h|u_h|m_h|c_h|u_l|m_l|c_l)_', 1), ''), 'raw') AS family, "
    "count(*) AS features, sum(importance) AS importance FROM filled GROUP BY 1")


def features_over(receipts_view: str, w: Windows = SCORING) -> str:
    """F57 over any receipts table (a view with the receipt schema), for tests."""
    return (f"WITH receipts AS (SELECT * FROM {receipts_view}),\n{PARSED},\n{_lw(w)},\n{_hist(w)},\n"
            f"{label_features_cte()},\n{history_ctes()}\n{wide_select()}")
