"""Receipt source (S1): fixed schema, fixture derivation, staged table.

A receipt is one coupon received by one user from one merchant on one day,
with the day it was redeemed if it was. Real deployments read a stored
receipts table (:func:`read_receipts`, :func:`read_receipts_csv`); the test
tables carry no coupons, so :func:`fixture_receipts` derives them from the
TPC-H-like tables by the mapping of FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from couponlens.functions import coupons as C
from couponlens.plans.stage import source_state, staged
from couponlens.session import hadoop_path

RECEIPT_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType(), False),
    T.StructField("merchant_id", T.LongType(), False),
    T.StructField("coupon_id", T.LongType(), False),
    T.StructField("discount_rate", T.StringType(), False),
    T.StructField("distance", T.IntegerType(), True),
    T.StructField("date_received", T.DateType(), False),
    T.StructField("date_used", T.DateType(), True),
])
RECEIPT_COLUMNS = [f.name for f in RECEIPT_SCHEMA.fields]

# Fixed values of the fixture mapping (FIXTURES.md section 2): the rate of a
# coupon is chosen by coupon_id % 11, in this order.
FIXTURE_RATES = ["10:5", "30:5", "20:5", "100:10", "150:20", "50:10", "30:1", "0.95", "0.9", "0.8", "15:10"]
FIXTURE_COUPONS_PER_MERCHANT = 20
FIXTURE_DAY_ZERO = "1995-01-01"    # order dates are counted from here ...
FIXTURE_FOLD_START = "2016-01-01"  # ... and folded onto 213 days from here
FIXTURE_FOLD_DAYS = 213
FIXTURE_MAX_DISTANCE = 10
FIXTURE_NO_DISTANCE_LINE = 7
FIXTURE_MAX_DELAY = 20
#: Rows of a file of the staged fixture. A receipt takes some 12 bytes there, so a scan split of 128 MB would
#: hold millions of them, and so would the hash table that a task aggregates them in; Spark counts a file as 4 MB at
#: least when it fills a split, which bounds both.
FIXTURE_FILE_ROWS = 1 << 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixture_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x orders x customer x supplier: the receipts, with the number ``kind`` of the merchant's coupon for coupon and rate.

    Plain inner equi-joins; AQE picks broadcast (supplier, customer, when
    measured small) or sort-merge joins, splitting skewed join partitions.
    One row out per lineitem row. What a table says about a receipt is
    worked out before its join, so that the shuffles carry a few small
    numbers in place of its columns.
    """
    redeemed = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_suppkey", (F.col("l_partkey") % FIXTURE_COUPONS_PER_MERCHANT).alias("kind"),
        (F.col("l_linenumber") != FIXTURE_NO_DISTANCE_LINE).alias("has_distance"),
        F.when(redeemed, (F.col("l_quantity").cast("int") % FIXTURE_MAX_DELAY).cast("int")).alias("delay"))
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    cu = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    # The order date is stored as a wall-clock timestamp. Read as
    # TIMESTAMP_NTZ its date needs no zone; read as TIMESTAMP (a session
    # without NTZ inference) the stored micros are taken as UTC days, so the
    # date never depends on the session time zone.
    if isinstance(od.schema["o_orderdate"].dataType, T.TimestampType):
        order_day = F.date_from_unix_date(F.floor(F.unix_micros("o_orderdate") / 86_400_000_000).cast("int"))
    else:
        order_day = F.to_date("o_orderdate")
    received = F.date_add(
        F.lit(FIXTURE_FOLD_START).cast("date"),
        (F.datediff(order_day, F.lit(FIXTURE_DAY_ZERO).cast("date")) % FIXTURE_FOLD_DAYS).cast("int"))
    od = od.select("o_orderkey", "o_custkey", received.alias("date_received"))
    orders = od.join(cu, od.o_custkey == cu.c_custkey)
    rows = li.join(orders, li.l_orderkey == orders.o_orderkey).join(su, li.l_suppkey == su.s_suppkey)
    dist = F.when(F.col("has_distance"),
                  F.least(F.abs(F.col("c_nationkey") - F.col("s_nationkey")), F.lit(FIXTURE_MAX_DISTANCE)))
    return rows.select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_suppkey").alias("merchant_id"),
        "kind",
        dist.cast("int").alias("distance"),
        "date_received",
        F.date_add("date_received", F.col("delay")).alias("date_used"))


def with_coupons(rows: DataFrame) -> DataFrame:
    """Receipts of ``fixture_rows``: the coupon and its rate follow from the merchant and the coupon's number."""
    coupon = F.col("merchant_id") * FIXTURE_COUPONS_PER_MERCHANT + F.col("kind")
    rates = F.array(*[F.lit(r) for r in FIXTURE_RATES])
    rate = F.element_at(rates, (F.col("coupon_id") % len(FIXTURE_RATES) + 1).cast("int"))
    return rows.withColumn("coupon_id", coupon).withColumn("discount_rate", rate).select(*RECEIPT_COLUMNS)


def fixture_receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 from the test tables, one row per lineitem row."""
    return with_coupons(fixture_rows(spark, sf_dir))


def read_receipts(spark: SparkSession, path: str) -> DataFrame:
    """Read a stored receipts table (parquet, partitioned by date_received)."""
    return spark.read.schema(RECEIPT_SCHEMA).parquet(path).select(*RECEIPT_COLUMNS)


#: Texts that stand for no value in a nullable column.
ABSENT = ["", "null", "NULL"]


def parse_receipts_csv(spark: SparkSession, path: str, header: bool = True, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Every CSV line: the receipt columns, ``reason`` (NULL for a sound row) and ``line`` (the fields as read).

    Columns are taken by position in schema order; ``date_format`` is a
    Spark datetime pattern, e.g. ``yyyyMMdd``. Only ``distance`` and
    ``date_used`` may be absent (empty or ``null``). The reason names the
    first column that does not parse, or ``columns`` for a line with too few
    or too many.
    """
    raw = T.StructType([*[T.StructField(f.name, T.StringType(), True) for f in RECEIPT_SCHEMA.fields],
                        T.StructField("_corrupt", T.StringType(), True)])
    df = (spark.read.schema(raw).option("header", str(header).lower()).option("columnNameOfCorruptRecord", "_corrupt").csv(path))
    day = lambda c: F.to_date(F.try_to_timestamp(c, F.lit(date_format)))
    value = {**{c: F.col(c).try_cast("long") for c in ("user_id", "merchant_id", "coupon_id")},
             "discount_rate": F.when(C.discount("discount_rate").isNotNull(), F.col("discount_rate")),
             "distance": C.distance("distance"), "date_received": day("date_received"), "date_used": day("date_used")}
    optional = ("distance", "date_used")
    reason = F.when(F.col("_corrupt").isNotNull(), F.lit("columns"))
    for c, parsed_value in value.items():
        bad = parsed_value.isNull()
        if c in optional:
            bad = bad & F.col(c).isNotNull() & ~F.trim(c).isin(ABSENT)
        reason = reason.when(bad, F.lit(c))
    line = F.coalesce("_corrupt", F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in RECEIPT_COLUMNS]))
    return df.select(*[v.alias(c) for c, v in value.items()], reason.alias("reason"), line.alias("line"))


def read_receipts_csv(spark: SparkSession, path: str, header: bool = True, date_format: str = "yyyy-MM-dd",
                      max_rejected: float = 0.0, rejected_path: str | None = None) -> DataFrame:
    """Read receipts from CSV with the fixed schema; no inference pass.

    Rows that do not parse (``parse_receipts_csv``) are never passed on: they
    are counted, written to ``rejected_path`` with their reason if one is
    given, and their share must not exceed ``max_rejected``, else this
    raises. One extra pass over the file does the counting.
    """
    rows = parse_receipts_csv(spark, path, header, date_format)
    counts = {r.reason: r["count"] for r in rows.groupBy("reason").count().collect()}  # one row per reason
    total, bad = sum(counts.values()), {k: n for k, n in counts.items() if k is not None}
    if bad and rejected_path:
        rows.where("reason IS NOT NULL").select("reason", "line").write.mode("overwrite").parquet(rejected_path)
    if sum(bad.values()) > max_rejected * total:
        raise ValueError(f"{sum(bad.values())} of {total} receipts in {path} do not parse, by column: {dict(sorted(bad.items()))}")
    return rows.where("reason IS NULL").select(*RECEIPT_COLUMNS)


def write_receipts(df: DataFrame, path: str, finish=lambda rows: rows, file_rows: int = 0) -> None:
    """Store receipts partitioned by day; ``finish`` adds columns that need not be shuffled, ``file_rows`` bounds a file (0: does not).

    The REBALANCE hint shuffles by day, so each task writes few day folders
    and the file count stays near the task count; AQE then splits any
    partition above the advisory size by map-output ranges. That splits a
    hot day even when its rows are identical copies of one key, which range
    or hash partitioning on any column cannot do.
    """
    (finish(df.hint("rebalance", "date_received"))
     .write.mode("overwrite").option("maxRecordsPerFile", file_rows).partitionBy("date_received").parquet(path))


#: Tables that the fixture receipts are derived from.
FIXTURE_TABLES = ("lineitem", "orders", "customer", "supplier")


def fixture_key(spark: SparkSession, name: str, sf_dir: str, *more) -> tuple:
    """Memo key of a table derived from the fixture tables as they are now."""
    sf_dir = sf_dir.rstrip("/")
    return (name, sf_dir, source_state(spark, [f"{sf_dir}/{t}.parquet" for t in FIXTURE_TABLES]), *more)


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a receipts table already stored by day."""
    p, fs = hadoop_path(spark, path)
    return any(f.isDirectory() and f.getPath().getName().startswith("date_received=") for f in fs.listStatus(p))


def receipts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The receipt table for ``sf_dir``, derived once per application.

    The derivation is written to the session's shared folder and read back,
    which cuts the join lineage (an executor lost later re-reads files, it
    does not redo the joins) and lets date filters prune day folders.
    """
    return staged(spark, fixture_key(spark, "receipts", sf_dir), lambda: fixture_rows(spark, sf_dir),
                  lambda rows, path: write_receipts(rows, path, with_coupons, FIXTURE_FILE_ROWS), read_receipts)


def parsed(rec: DataFrame) -> DataFrame:
    """P: receipts plus the parsed columns T1..T4."""
    return rec.select(
        *RECEIPT_COLUMNS,
        C.discount("discount_rate").alias("discount"),
        C.is_manjian("discount_rate").alias("is_manjian"),
        C.price_before("discount_rate").alias("price_before"))
