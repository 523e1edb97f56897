"""Mixing sources to target weights (DataFrame functions only).

Targets: each source's weighted share of the whole, capped at ``most`` times
its size, the excess shared again by weight (water filling). A source gives
whole passes over its documents and, for the rest, a prefix of a last pass.

Documents fall into ``BLOCKS`` blocks of their source by a keyed hash of
their id, and each pass has its own permutation of the blocks. The number of
blocks a source gives is its quota. A splitting tree deals the quotas to the
output shards: at each node as many as half of all sources' blocks are drawn
without replacement to go left, which makes the counts by source
multivariate hypergeometric, until a node is one shard. Each source then
fills its shards' quotas with its blocks in a permutation; a shard thus holds
disjoint permuted blocks. Its rows are shuffled by a keyed hash.

Windows see one source's blocks (at most ``BLOCKS`` a pass), one range of
hashes of a node's blocks, or the ranges themselves, never all blocks of all
sources or all documents of a source. Only documents of the one block of each
source that the target cuts are ordered among themselves, and those cell by
cell; rows of one id have cells of their own. The targets are computed by one
task over the list of sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from couponlens.llm.common import ROW, WORD, numbered, spare_name, stored, whole_text

BLOCKS = 1024
#: A node's blocks are ranked by ranges of their hashes, 2^HASH_BITS of them.
HASH_BITS = 12
WEIGHTS = (5, 2, 1)
SEED = 20240607


def _hash(seed: int, *cols: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *cols)


def sized(docs: DataFrame, seed: int, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Row number, id, source key ``s`` (never null), words, block and cell of every row; stored."""
    source = F.col(source_col).cast("string")
    rows = numbered(docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")).alias("s"), source.alias("source"),
        whole_text(text_col).alias("t")))
    key = _hash(seed, F.col("doc_id").cast("string"))
    return stored(rows.select(
        ROW, "doc_id", "s", "source", F.regexp_count("t", F.lit(WORD)).cast("long").alias("size"), key.alias("key"),
        F.pmod(key, F.lit(BLOCKS)).cast("int").alias("block"), F.pmod(_hash(seed + 1, "doc_id", ROW), F.lit(BLOCKS)).cast("int").alias("cell"),
    ), "sized")


def targets(sources: DataFrame, weights: tuple = WEIGHTS, total: float = 1.5, most: float = 2.0) -> DataFrame:
    """(s, source, source_size) -> target added. One row per source: a list of the mix, small however large the corpus."""
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    everything, by_room = W.partitionBy(), W.orderBy("room", "source")
    before = by_room.rowsBetween(W.unboundedPreceding, -1)
    earlier = lambda col: F.coalesce(F.sum(col).over(before), F.lit(0.0))
    rated = (sources.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
             .withColumn("room", F.col("cap") / F.col("weight"))
             .withColumn("whole", total * F.sum("source_size").over(everything))
             .withColumn("all_weights", F.sum("weight").over(everything)))
    level = (F.col("whole") - earlier("cap")) / (F.col("all_weights") - earlier("weight"))
    capped = rated.withColumn("capped", F.col("room") < level)
    full = lambda col: F.coalesce(F.sum(F.when(F.col("capped"), F.col(col))).over(everything), F.lit(0.0))
    rate = F.coalesce((F.col("whole") - full("cap")) / F.nullif(F.col("all_weights") - full("weight"), F.lit(0.0)), F.lit(0.0))
    return capped.withColumn("target", F.when(F.col("capped"), F.col("cap")).otherwise(F.least("cap", F.col("weight") * rate))
                             ).select("s", "source", "source_size", "target")


def split(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """(s, shard, n): how many of each source's quota of blocks (s, quota) each of 2^levels shards gets.

    At a node the blocks of all sources, told apart by number only, go left or
    right as a random half of them does: their keyed hashes are ranked, by
    ``1 << HASH_BITS`` ranges of hashes first and then within a range, so no
    task meets a node's blocks. The counts by source are multivariate hypergeometric.
    """
    out = quotas.where("quota > 0").select("s", F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"))).alias("draw"), F.lit(0).alias("shard"))
    for level in range(levels):
        out = out.withColumn("u", _hash(seed + 100 + level, "s", "draw"))
        out = stored(out.withColumn("part", F.shiftright("u", 64 - HASH_BITS)), "drawn")
        node = W.partitionBy("shard")
        parts = out.groupBy("shard", "part").agg(F.count("*").alias("n"))
        parts = parts.select("shard", "part", (F.sum("n").over(node.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(node).alias("whole"))
        # An odd node's extra block goes left or right by a coin of its own.
        left = F.floor((F.col("whole") + F.pmod(_hash(seed + 200 + level, "shard"), F.lit(2))) / 2)
        rank = F.col("before") + F.row_number().over(W.partitionBy("shard", "part").orderBy("u", "s", "draw"))
        out = out.join(parts, ["shard", "part"]).select("s", "draw", (F.col("shard") * 2 + F.when(rank > left, 1).otherwise(0)).alias("shard"))
    return out.groupBy("s", "shard").agg(F.count("*").alias("n"))


def dealt(drawn: DataFrame, levels: int, seed: int) -> DataFrame:
    """(s, block, pass, shard) of the drawn blocks (s, block, pass): each source's blocks, in an order of their own, fill its shards' quotas."""
    quotas = split(drawn.groupBy("s").agg(F.count("*").alias("quota")), levels, seed)
    until = F.sum("n").over(W.partitionBy("s").orderBy("shard"))
    # At most 2^levels entries a source.
    ends = quotas.select("s", F.struct(until.alias("until"), "shard").alias("e")).groupBy("s").agg(F.array_sort(F.collect_list("e")).alias("ends"))
    place = F.row_number().over(W.partitionBy("s").orderBy(_hash(seed + 300, "s", "block", "pass"), "pass", "block"))
    return drawn.withColumn("place", place).join(ends, "s").select(
        "s", "block", "pass", F.get(F.filter("ends", lambda e: e["until"] >= F.col("place")), F.lit(0))["shard"].alias("shard"))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, total: float = 1.5, most: float = 2.0, levels: int = 4,
        seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: row number, doc_id, size, source_size, target, taken, passes, shards.

    ``size`` counts the words of the whole text (null: none), ``taken`` the
    words the mix takes, repeats counted; each source's taken words are its
    target, rounded. ``passes`` counts the copies, the last of which may be
    cut (one document per source), ``shards`` holds the shard of each copy.
    A null source is a source of its own, the last. A source without words
    has target 0. Repeated rows are documents of their own. Rows with one
    id share a block, not a cell; ties are broken by the row. Texts are read whole at any length. An empty table gives no
    rows; other columns are not read. Reruns with one seed agree.
    """
    rows = sized(docs, seed, id_col, source_col, text_col)
    sources = targets(rows.groupBy("s", "source").agg(F.sum("size").alias("source_size")), weights, total, most)
    goal = F.round("target").cast("long")
    passes = F.coalesce(F.floor(goal / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)).cast("long")
    sources = stored(sources.withColumn("whole_passes", passes)
                     .withColumn("rest", goal - passes * F.col("source_size")).drop("source"), "sources")

    # The last pass: words of the blocks before each one, in its permutation, and the blocks that are drawn.
    blocks = rows.groupBy("s", "block").agg(F.sum("size").alias("words")).join(sources, "s")
    each = blocks.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole_passes"))))
    each = each.withColumn("place", _hash(seed, "pass", "s", "block"))
    order = W.partitionBy("s", "pass").orderBy("place", "block")
    each = each.withColumn("before", F.sum("words").over(order) - F.col("words"))
    drawn = each.where((F.col("pass") < F.col("whole_passes")) | (F.col("before") < F.col("rest")))
    drawn = stored(drawn.select("s", "block", "pass"), "blocks")
    shards = (dealt(drawn, levels, seed).groupBy("s", "block")
              .agg(F.array_sort(F.collect_list(F.struct("pass", "shard"))).alias("drawn")))  # whole_passes + 1 at most
    last = each.where(F.col("pass") == F.col("whole_passes")).select(
        "s", "block", "source_size", "target", "whole_passes", "words", (F.col("rest") - F.col("before")).alias("room"))
    blocks = stored(last.join(shards, ["s", "block"], "left"), "blocks")
    placed = rows.drop("source").join(blocks, ["s", "block"])

    # The block that the target cuts: its cells, then the documents of each cell, one after the other.
    is_cut = (F.col("room") > 0) & (F.col("room") < F.col("words"))
    cut = placed.where(is_cut)
    cells = cut.groupBy("s", "cell").agg(F.sum("size").alias("cell_words"))
    cells = cells.withColumn("earlier", F.sum("cell_words").over(W.partitionBy("s").orderBy("cell")) - F.col("cell_words")).drop("cell_words")
    ordered = W.partitionBy("s", "cell").orderBy("key", "doc_id", ROW)
    cut = cut.join(cells, ["s", "cell"]).withColumn("room", F.col("room") - F.col("earlier") - F.sum("size").over(ordered) + F.col("size"))
    extra = F.greatest(F.lit(0).cast("long"), F.least("size", "room"))
    keep = [ROW, "doc_id", "size", "source_size", "target", "whole_passes", "drawn"]
    both = (placed.where(~is_cut).withColumn("extra", F.when(F.col("room") >= F.col("words"), F.col("size")).otherwise(F.lit(0).cast("long"))).select(*keep, "extra")
            .unionByName(cut.withColumn("extra", extra).select(*keep, "extra")))
    copies = F.when(F.col("size") > 0, F.col("whole_passes") + (F.col("extra") > 0).cast("long")).otherwise(F.lit(0).cast("long"))
    return both.select(
        ROW, "doc_id", "size", "source_size", "target", (F.col("whole_passes") * F.col("size") + F.col("extra")).alias("taken"),
        copies.alias("passes"), F.slice(F.coalesce(F.transform("drawn", lambda d: d["shard"]), F.array().cast("array<int>")), F.lit(1), copies.cast("int")).alias("shards"))


def mixed(docs: DataFrame, weights: tuple = WEIGHTS, total: float = 1.5, most: float = 2.0, levels: int = 4, seed: int = SEED) -> DataFrame:
    """The rows of ``docs`` (read from files) as often as the mix takes them, shard by shard, shuffled within each.

    A document of which the mix takes a part goes whole if that is half of
    it or more, and else not. All columns as they were.
    """
    plan = mix(docs, weights, total, most, levels, seed)
    part = F.col("taken") - F.floor(F.col("taken") / F.col("size")) * F.col("size")
    whole = F.floor(F.col("taken") / F.col("size")) + F.when(2 * part >= F.col("size"), 1).otherwise(0)
    whole = whole.cast("int")
    row, shard = spare_name(docs, ROW), spare_name(docs, "__shard")
    copies = plan.where("taken > 0").select(F.col(ROW).alias(row), F.explode(F.slice("shards", F.lit(1), whole)).alias(shard))
    return (numbered(docs, row).join(copies, row)
            .sortWithinPartitions(shard, _hash(seed + 1, shard, row)).drop(row, shard))
