"""Label-window features (`u_l_`, `m_l_`, `c_l_`) and the four raw ones.

Each entity table is built from grouped rows, never from a window over raw
receipts (see ``ranks``):

* ``u``, ``m``, ``c``: counts per ``(entity, date_received, distance,
  discount)``. All ranks, per-entity and per-day counts and first/last
  flags of the entity are windows over these grouped rows, partitioned by
  the entity; one partition holds at most days x distances x rates rows,
  however many receipts the entity has.
* ``uc``: counts per ``(user, merchant, coupon, date_received)`` for the
  "this coupon" counts.
* merchant coupon kinds: distinct ``(merchant, date, coupon)`` first, then
  counted (no distinct window aggregate exists; this is J4).
* ``packed``: one row per merchant or coupon with maps from value to rank,
  which the whole feature table (F57) joins by that key alone.

The other tables are joined back to the receipts on their full grain,
NULL-safe on distance and discount.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from couponlens.operators.ranks import frames, join_back, rank_columns

KEYS = ["user_id", "merchant_id", "coupon_id", "date_received"]
GRAIN = ["date_received", "distance", "discount"]
NULLABLE = ["distance", "discount"]

# Rank features of each entity: feature -> (ranked column, ascending).
RANKS = {
    "u": {
        "u_l_date_received_rank": ("date_received", False),
        "u_l_date_received_rank_ascend": ("date_received", True),
        "u_l_distance_rank": ("distance", False),
        "u_l_distance_rank_ascend": ("distance", True),
        "u_l_discount_rate_rank": ("discount", False),
        "u_l_discount_rate_rank_ascend": ("discount", True),
    },
    "m": {
        "m_l_date_received_rank": ("date_received", False),
        "m_l_date_received_rank_ascend": ("date_received", True),
        "m_l_distance_rank": ("distance", False),
        "m_l_distance_rank_ascend": ("distance", True),
        "m_l_discount_rate_rank": ("discount", False),
        "m_l_discount_rate_rank_ascend": ("discount", True),
    },
    "c": {
        "c_l_date_received_rank": ("date_received", False),
        "c_l_date_received_rank_ascend": ("date_received", True),
        "c_l_distance_rank": ("distance", False),
        "c_l_distance_rank_ascend": ("distance", True),
        "c_l_discount_rate_rank": ("discount", False),
        "c_l_discount_rate_rank_ascend": ("discount", True),
    },
}

# Raw features: output name -> source column.
RAW = {"discount": "discount", "price_before": "price_before", "Distance": "distance", "is_manjian": "is_manjian"}


@dataclass(frozen=True)
class Table:
    keys: list[str]
    nullable: list[str]
    columns: list[str]


def _grouped(lw: DataFrame, entity: list[str]) -> DataFrame:
    return lw.groupBy(*entity, *GRAIN).agg(F.count(F.lit(1)).alias("t"))


def _rank_features(entity: list[str], ranks: dict[str, tuple[str, bool]]) -> dict[str, Column]:
    by_value = {v: rank_columns(entity, v) for v, _ in ranks.values()}
    return {name: by_value[v][0 if asc else 1] for name, (v, asc) in ranks.items()}


def _by_day(entity: list[str]) -> tuple[Column, Column, Window]:
    """Receipts of the entity, of the entity that day, and the whole-entity frame.

    Built on the same frames as the date rank, so they add no sort.
    """
    _, peers, whole = frames(entity, "date_received")
    return F.sum("t").over(whole), F.sum("t").over(peers), whole


def user_table(lw: DataFrame) -> DataFrame:
    u = ["user_id"]
    total, today, whole = _by_day(u)
    day = F.col("date_received")
    cols = {
        "u_l_total_coupon": total,
        "u_l_today_coupon": today,
        "u_l_if_is_first_received": (day == F.min(day).over(whole)).cast("int"),
        "u_l_if_is_last_received": (day == F.max(day).over(whole)).cast("int"),
        **_rank_features(u, RANKS["u"]),
    }
    return _grouped(lw, u).select(*u, *GRAIN, *[c.alias(n) for n, c in cols.items()])


def merchant_kinds(lw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J4 inputs: distinct coupons per merchant and per merchant-day."""
    triples = lw.select("merchant_id", "date_received", "coupon_id").distinct()
    per_day = triples.groupBy("merchant_id", "date_received").agg(
        F.count(F.lit(1)).alias("m_l_howmuch_kindof_coupon_today"))
    overall = (triples.select("merchant_id", "coupon_id").distinct().groupBy("merchant_id")
               .agg(F.count(F.lit(1)).alias("m_l_howmuch_kindof_coupon")))
    return overall, per_day


#: Features that count kinds -> the keys they are counted by.
KINDS = {"m_l_howmuch_kindof_coupon": ["merchant_id"], "m_l_howmuch_kindof_coupon_today": ["merchant_id", "date_received"]}


def kinds_join_back(lw: DataFrame, names: list[str]) -> DataFrame:
    """The named kind counts on each label-window receipt."""
    rows = lw.select(*KEYS)
    for (name, keys), counts in zip(KINDS.items(), merchant_kinds(lw)):
        if name in names:
            rows = join_back(rows, counts, keys, [name])
    return rows


def merchant_table(lw: DataFrame) -> DataFrame:
    m = ["merchant_id"]
    total, today, _ = _by_day(m)
    cols = {
        "m_l_howmuch_coupon": total,
        "m_l_howmuch_coupon_today": today,
        **_rank_features(m, RANKS["m"]),
    }
    t = _grouped(lw, m).select(*m, *GRAIN, *[c.alias(n) for n, c in cols.items()])
    overall, per_day = merchant_kinds(lw)
    return t.join(overall, "merchant_id", "left").join(per_day, ["merchant_id", "date_received"], "left")


def coupon_table(lw: DataFrame) -> DataFrame:
    c = ["coupon_id"]
    total, _, _ = _by_day(c)
    cols = {"c_l_total_received": total, **_rank_features(c, RANKS["c"])}
    return _grouped(lw, c).select(*c, *GRAIN, *[col.alias(n) for n, col in cols.items()])


def user_coupon_table(lw: DataFrame) -> DataFrame:
    g = lw.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("t"))
    return g.select(*KEYS,
                    F.sum("t").over(Window.partitionBy("user_id", "coupon_id")).alias("u_l_this_coupon"),
                    F.col("t").alias("u_l_today_this_coupon"))


#: Ranked column -> kind of a packed row's map, and the key a value has there.
PACKED = {"date_received": "days", "distance": "distances", "discount": "rates"}


def _number(value: str) -> Column:
    """A ranked value as a number: a day as its days since 1970, a distance or rate as it is (exactly)."""
    return (F.unix_date(value) if value == "date_received" else F.col(value)).cast("double")


def packed(lw: DataFrame, key: str, kinds: bool = False) -> DataFrame:
    """One row per ``key``: its receipts, and maps from day, distance and rate to (asc, desc, t, kinds).

    A row holds the values its key has (days + distances + rates at most),
    however many receipts that is, where a table on the whole grain holds
    their combinations. ``asc`` and ``desc`` are average-tie ranks, ``t``
    counts receipts. ``kinds`` counts distinct coupons, in all and by day.
    Both are counted per (key, value) first, so that a hot key is as many
    rows as a task has values of it.
    """
    marks = F.array(*[F.struct(F.lit(kind).alias("kind"), _number(value).alias("value")) for value, kind in PACKED.items()])
    rows = lw.select(key, F.explode(marks).alias("m"))
    if kinds:
        days = lw.groupBy(key, "coupon_id").agg(F.collect_set(_number("date_received")).alias("days"))
        mark = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
        rows = rows.unionByName(days.select(key, F.explode(F.concat(
            F.transform("days", lambda d: mark("kinds_of_day", d)), F.array(mark("kinds", F.lit(0.0))))).alias("m")))
    counts = rows.where("m.value IS NOT NULL").groupBy(key, "m.kind", "m.value").agg(F.count(F.lit(1)).alias("t"))
    named = [*PACKED.values(), *(["kinds_of_day", "kinds"] if kinds else [])]
    lists = counts.groupBy(key).agg(*[F.sort_array(F.collect_list(F.when(F.col("kind") == k, F.struct("value", "t")))).alias(k) for k in named])
    total = lambda values: F.aggregate(values, F.lit(0).cast("long"), lambda n, x: n + x["t"])

    def ranked(kind: str) -> Column:
        n = total(F.col(kind))

        def entry(x: Column, i: Column) -> Column:
            asc = total(F.slice(kind, 1, i + 1)) - (x["t"] - 1) / F.lit(2.0)
            of_day = F.try_element_at(F.map_from_entries("kinds_of_day"), x["value"]) if kinds and kind == "days" else F.lit(None).cast("long")
            return F.struct(x["value"].alias("key"), F.struct(asc.alias("asc"), (n + 1 - asc).alias("desc"), x["t"].alias("t"), of_day.alias("kinds")).alias("value"))

        return F.map_from_entries(F.transform(kind, entry)).alias(kind)

    return lists.select(key, total(F.col("days")).alias("total"), *[ranked(k) for k in PACKED.values()],
                        (F.get("kinds", F.lit(0))["t"] if kinds else F.lit(None).cast("long")).alias("kinds"))


def unpacked(prefix: str, row: str = "packed") -> dict[str, Column]:
    """Features of the receipts of a packed table's keys, by the receipt's own day, distance and rate; ``row``: the packed row."""
    at = {value: F.try_element_at(F.col(f"{row}.{kind}"), _number(value)) for value, kind in PACKED.items()}
    ranks = {name: at[value]["asc" if asc else "desc"] for name, (value, asc) in RANKS[prefix].items()}
    if prefix == "c":
        return {"c_l_total_received": F.col(f"{row}.total"), **ranks}
    return {"m_l_howmuch_coupon": F.col(f"{row}.total"), "m_l_howmuch_coupon_today": at["date_received"]["t"],
            "m_l_howmuch_kindof_coupon": F.col(f"{row}.kinds"), "m_l_howmuch_kindof_coupon_today": at["date_received"]["kinds"], **ranks}


_U = ["u_l_total_coupon", "u_l_today_coupon", "u_l_if_is_first_received", "u_l_if_is_last_received", *RANKS["u"]]
_M = ["m_l_howmuch_coupon", "m_l_howmuch_coupon_today", "m_l_howmuch_kindof_coupon",
      "m_l_howmuch_kindof_coupon_today", *RANKS["m"]]
_C = ["c_l_total_received", *RANKS["c"]]
_UC = ["u_l_this_coupon", "u_l_today_this_coupon"]

TABLES = {
    "u": (user_table, Table(["user_id", *GRAIN], NULLABLE, _U)),
    "m": (merchant_table, Table(["merchant_id", *GRAIN], NULLABLE, _M)),
    "c": (coupon_table, Table(["coupon_id", *GRAIN], NULLABLE, _C)),
    "uc": (user_coupon_table, Table(KEYS, [], _UC)),
}
FEATURE_TABLE = {f: name for name, (_, spec) in TABLES.items() for f in spec.columns}
LABEL_FEATURES = list(RAW) + [f for _, spec in TABLES.values() for f in spec.columns]


def label_feature(lw: DataFrame, name: str) -> DataFrame:
    """One feature on every label-window receipt: ``(KEYS..., name)``."""
    if name in RAW:
        return lw.select(*KEYS, F.col(RAW[name]).alias(name))
    if name in KINDS:
        return kinds_join_back(lw, [name])
    build, spec = TABLES[FEATURE_TABLE[name]]
    rows = lw.select(*KEYS, "distance", "discount")
    return join_back(rows, build(lw), spec.keys, [name], spec.nullable).select(*KEYS, name)
