"""Exact duplicates by a tree merge of sorted digest runs (DataFrame functions only).

Every input partition is a run of digests. Runs meet in binomial rounds: in
a round, ``fan_in`` neighbouring runs become one (by default as many as give
``ROUNDS`` rounds in all), equal digests are merged and the best identifier is
kept, so a group of copies is one row per run long before the last round,
whatever its size. A run is never held by one task: its digests are dealt by
(run, digest), sorted by Spark's sort-based aggregate and merged there; the
first round's map side is the local run.

A digest is verified by carrying three facts of the text, SHA-256 (as bytes,
written in hex at the end), byte length and an independent 64-bit hash; texts
count as equal only if all three agree, at every level.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import ROW, numbered, stored, whole_text, without

DIGEST = ["text_digest", "text_bytes", "text_check"]
#: Rounds of the tree; unique digests are shuffled again in each.
ROUNDS = 3
#: Fewest runs that become one in a round.
LEAST_FAN_IN = 8


def run_count(docs: DataFrame) -> int:
    """Runs at the leaves of the tree: the shuffle partitions, rounded up to a power of two."""
    return 1 << math.ceil(math.log2(max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))))


def fan_in_of(runs: int) -> int:
    """Neighbouring runs that become one in a round, a power of two, for at most ``ROUNDS`` rounds."""
    return max(LEAST_FAN_IN, 1 << math.ceil(math.log2(runs) / ROUNDS))


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row number, id, verified digest and run number of every row; stored."""
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("t")))
    return stored(rows.select(
        ROW, "doc_id", F.unhex(F.sha2("t", 256)).alias("text_digest"), F.octet_length("t").cast("long").alias("text_bytes"),
        F.xxhash64("t").alias("text_check"), (F.spark_partition_id() % run_count(docs)).alias("run"),
    ), "digests")


def merge_runs(rows: DataFrame, runs: int, fan_in: int, keep: str = "largest") -> DataFrame:
    """One row per digest, ``best`` (id, row number) and ``group_size``, after log_fan_in(runs) rounds."""
    if keep not in ("largest", "smallest"):
        raise ValueError(f"keep must be largest or smallest, not {keep!r}")
    # A null id never wins against another id; among rows of one id the first (last) row stays.
    pick = F.max if keep == "largest" else F.min
    best = F.struct(F.col("doc_id").isNotNull().alias("known") if keep == "largest" else F.col("doc_id").isNull().alias("unknown"), "doc_id", ROW)
    level = rows.select("run", *DIGEST, best.alias("best"), F.lit(1).cast("long").alias("group_size"))
    while True:
        level = (level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
                 .groupBy("run", *DIGEST).agg(pick("best").alias("best"), F.sum("group_size").alias("group_size")))
        runs = -(-runs // fan_in)
        if runs <= 1:
            return level.drop("run")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     fan_in: int | None = None, keep: str = "largest") -> DataFrame:
    """One row per input row: row number, doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. Of equal texts the
    row with the largest (``keep='smallest'``: smallest) id stays; a null id
    loses to any other, and of rows with one id exactly one stays. Texts are
    read whole at any length, and only their digests are shuffled. An empty
    table gives no rows; other columns are not read.
    """
    if fan_in is not None and fan_in < 2:
        raise ValueError(f"fan_in must be at least 2, not {fan_in}")
    rows, runs = digests(docs, id_col, text_col), run_count(docs)
    groups = merge_runs(rows, runs, fan_in or fan_in_of(runs), keep).where("group_size > 1")
    # Only groups of two and more are joined back; AQE splits the partition of a hot digest.
    return rows.join(groups, DIGEST, "left").select(
        ROW, "doc_id",
        F.when(F.col("best").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("best").isNull() | (F.col(f"best.{ROW}") == F.col(ROW))).alias("kept"),
        F.lower(F.hex("text_digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` (read from files) that stay, all columns as they were."""
    return without(docs, exact_duplicates(docs, keep=keep).where(~F.col("kept")))
