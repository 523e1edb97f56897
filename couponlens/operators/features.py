"""The 56-feature table (F57) and the joins that build it.

History tables are attached to the label-window entity tables before
those go back to the receipts: a table keyed ``(user, date, distance,
discount)`` is no larger than the window itself, so the user history
rides on it instead of costing one more join of the full window. A merchant
or a coupon, which has many receipts, is one packed row instead, with its
ranks as maps. The receipts then see four left joins, each on a key that is
unique in the right side, so the row count is preserved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.functions import coupons as C
from couponlens.operators import history_features as H
from couponlens.operators import label_features as L
from couponlens.operators.ranks import join_back

from couponlens.operators.feature_names import FEATURE_NAMES

KEYS = L.KEYS
FEATURES = FEATURE_NAMES
# Every published name is built by exactly one operator.
assert sorted(FEATURES) == sorted([*L.LABEL_FEATURES, *H.HISTORY_FEATURES])


def _with_history(table: DataFrame, hist_table: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(hist_table, keys, "left")


def entity_join(lw: DataFrame, hist: DataFrame, sums: DataFrame | None = None, coupons: DataFrame | None = None) -> DataFrame:
    """User, merchant and coupon history on each label-window receipt."""
    rows = lw.select(*KEYS)
    sums = H.pair_sums(hist) if sums is None else sums
    for e, table in (("u", H.user_features(sums)), ("m", H.merchant_features(sums)),
                     ("c", H.coupon_features(H.coupon_sums(hist) if coupons is None else coupons))):
        keys, cols = H.ENTITIES[e]
        rows = join_back(rows, table, keys, cols)
    return _fill_counts(rows)


def pair_join(lw: DataFrame, hist: DataFrame, sums: DataFrame | None = None) -> DataFrame:
    """User x merchant history on each label-window receipt."""
    keys, cols = H.ENTITIES["um"]
    sums = H.pair_sums(hist) if sums is None else sums
    rows = join_back(lw.select(*KEYS), H.pair_features(sums), keys, cols)
    return _fill_counts(rows)


def kinds_join_back(lw: DataFrame) -> DataFrame:
    """Distinct-coupon counts of the merchant (overall and that day) on each receipt."""
    return L.kinds_join_back(lw, list(L.KINDS))


def _fill_counts(df: DataFrame) -> DataFrame:
    return df.withColumns({c: C.zero_fill(c) for c in df.columns if c in H.COUNTS})


def packed_tables(lw: DataFrame, sums: DataFrame, coupons: DataFrame) -> dict[str, DataFrame]:
    """One packed row per merchant (``m``) and per coupon (``c``) of the window, with its history features.

    Stored, each is the small side of a join on its key alone, and AQE can split a hot key's receipts.
    """
    return {"m": _with_history(L.packed(lw, "merchant_id", kinds=True), H.merchant_features(sums), ["merchant_id"]),
            "c": _with_history(L.packed(lw, "coupon_id"), H.coupon_features(coupons), ["coupon_id"])}


def _join_packed(rows: DataFrame, table: DataFrame, entity: str) -> DataFrame:
    """The features of a packed table on each receipt."""
    (key,), hist_cols = H.ENTITIES[entity]
    packed = [c for c in table.columns if c != key and c not in hist_cols]
    side = table.select(F.col(key).alias(f"__k_{key}"), F.struct(*packed).alias("packed"), *hist_cols)
    joined = rows.join(side, rows[key] == side[f"__k_{key}"], "left")
    return joined.withColumns(L.unpacked(entity)).drop(f"__k_{key}", "packed")


def features_wide(lw: DataFrame, hist: DataFrame, carry: tuple[str, ...] = (), sums: DataFrame | None = None,
                  coupons: DataFrame | None = None, packed: dict[str, DataFrame] | None = None) -> DataFrame:
    """all 56 features on every label-window receipt, one row in, one row out.

    ``carry`` names extra receipt columns to keep (labels, for training);
    ``sums`` is a stored ``pair_sums(hist)``, ``coupons`` a stored
    ``coupon_sums(hist)``, so that history is aggregated once, and
    ``packed`` the stored ``packed_tables``.
    """
    sums = H.pair_sums(hist) if sums is None else sums
    if packed is None:
        packed = packed_tables(lw, sums, H.coupon_sums(hist) if coupons is None else coupons)
    tu = _with_history(L.user_table(lw), H.user_features(sums), ["user_id"])
    tuc = _with_history(L.user_coupon_table(lw), H.pair_features(sums), ["user_id", "merchant_id"])

    rows = lw.select(*KEYS, "distance", "discount", "price_before", "is_manjian", *carry)
    # The user join comes first: its left side is a plain shuffle of the window, which AQE can split at a hot user.
    rows = join_back(rows, tu, L.TABLES["u"][1].keys, [*L.TABLES["u"][1].columns, *H.ENTITIES["u"][1]], L.NULLABLE)
    for entity in ("m", "c"):
        rows = _join_packed(rows, packed[entity], entity)
    rows = join_back(rows, tuc, L.TABLES["uc"][1].keys, [*L.TABLES["uc"][1].columns, *H.ENTITIES["um"][1]])
    out = rows.withColumnRenamed("distance", "Distance")
    return _fill_counts(out).select(*KEYS, *FEATURES, *carry)
