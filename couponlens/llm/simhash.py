"""Near duplicates by SimHash and covering locality-sensitive hashing.

Fingerprints within ``radius`` differing bits are found without a miss: bit
i gets the vector m(i) = 1 + i mod (2^(radius+1) - 1) of F_2^(radius+1), and
table v (each non-zero vector) keeps the bits with <m(i), v> = 1. The vectors
of at most ``radius`` differing bits span less than the whole space, so some
v is orthogonal to all of them: that table's mask hides every difference and
the pair shares a bucket. 31 tables of about 33 kept bits for radius 4.

Equal fingerprints are one node, so exact copies cost nothing further. A
bucket gives a spanning forest of its links, not all its pairs, and is cut
into blocks of ``BLOCK`` nodes, so that no bucket, however large, meets in one
task. First each block is a group of its own: a node is in one block a table,
and since a table deals nodes in its own way, the near copies of one text
become one component. Then, in buckets of several blocks, only nodes outside
the bucket's largest component meet the other blocks; a bucket within one
component has nothing to add. No link between components is lost, and the
work follows the nodes, not the square of a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import ROW, numbered, stored, whole_text, without
from couponlens.llm.components import components

BITS = 64
SEED = 42
#: Nodes of a bucket that are compared in one group (a pair of blocks).
BLOCK = 1024
#: Shingles hashed at a time, which bounds the memory a very long text takes.
CHUNK = 1 << 16


def fingerprint(data: bytes, shingle: int = 4) -> int:
    """Unsigned SimHash of a UTF-8 text: a bit is set if it is in over half of the shingle hashes."""
    words = data.lower().split()  # bytes: A-Z only, and exactly the six ASCII spaces
    if not words:
        return 0
    joined, width = b" ".join(words), min(shingle, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1]
    ends = ends[width - 1:]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())
        hashes = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """Row number, doc_id and fingerprint (as a signed long) of every row; stored."""

    @F.pandas_udf("long")
    def simhash(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="uint64").astype("int64")

    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).cast("binary").alias("t")))
    return stored(rows.select(ROW, "doc_id", simhash("t").alias("fp")), "fingerprints")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """One mask for each non-zero vector of F_2^(radius+1), as signed longs."""
    top = (1 << (radius + 1)) - 1
    masks = [sum(1 << i for i in range(bits) if bin((1 + i % top) & v).count("1") % 2) for v in range(1, top + 1)]
    return [m - (1 << bits) if m >> (bits - 1) else m for m in masks]


def spanning_forest(values: np.ndarray, radius: int) -> list[tuple[int, np.ndarray]]:
    """Links between ``values`` (unsigned) that connect whatever links of ``radius`` bits connect."""
    links, left = [], np.arange(len(values))
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= radius
            if near.any():
                hit, left = left[near], left[~near]
                links.append((at, hit))
                todo.extend(hit)
    return links


def _forests(radius: int):
    """mapInArrow function over rows (group, fp, root) sorted by group; a group may span batches.

    Gives the links (a, b) of each group's spanning forest whose ends have different roots.
    """

    def solve(groups: np.ndarray, fps: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
        cuts = [0, *(np.flatnonzero(groups[1:] != groups[:-1]) + 1), len(groups)]
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for lo, hi in zip(cuts, cuts[1:]):
            part, root = fps[lo:hi], roots[lo:hi]
            for at, hit in spanning_forest(part.view(np.uint64), radius):
                hit = hit[root[hit] != root[at]]
                a.append(np.full(len(hit), part[at]))
                b.append(part[hit])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            ended = np.flatnonzero(held[0] != held[0][-1])
            if len(ended):
                cut = ended[-1] + 1
                yield solve(*(x[:cut] for x in held))
                held = [x[cut:] for x in held]
        if held is not None:
            yield solve(*held)

    return run


def _grouped_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links (a, b), a < b, of the groups of rows (g, fp, root)."""
    found = rows.repartition("g").sortWithinPartitions("g", "fp").mapInArrow(_forests(radius), "a long, b long")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def roots(nodes: DataFrame, radius: int = 4, block: int = BLOCK) -> DataFrame:
    """(node, root) for every one of the distinct ``fp`` that has another within ``radius`` bits; the root is the component's smallest."""
    masks = covering_masks(radius)
    # Each node becomes a row per table, so nodes are spread over all shuffle partitions first;
    # by a hash of their own, else Spark would take the (merged) partitions they come in.
    spread = nodes.repartition(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("fp"))
    keyed = spread.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("short").alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("k"))
        for t, m in enumerate(masks)])).alias("x")).select("fp", "x.t", "x.k")
    buckets = stored(keyed.groupBy("t", "k").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                     .where("n > 1"), "buckets")
    pairs = buckets.where("n = 2").select("a", "b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    larger = buckets.where("n > 2").select("t", "k", F.ceil(F.col("n") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("fp", "t"), F.col("blocks"))
    # Should two groups' hashes meet, more values are compared; links are by distance all the same.
    inside = keyed.join(larger, ["t", "k"]).select(F.xxhash64("t", "k", own).alias("g"), "fp", F.col("fp").alias("root"))
    found = components(pairs.unionByName(_grouped_links(inside, radius)).distinct())

    crowded = larger.where("blocks > 1")
    if crowded.isEmpty():
        return found
    members = stored(keyed.join(crowded, ["t", "k"]).join(found.withColumnRenamed("node", "fp"), "fp", "left")
                     .select("t", "k", "blocks", "fp", F.coalesce("root", "fp").alias("root")), "members")
    sizes = members.groupBy("t", "k", "root").agg(F.count("*").alias("n"))
    split = stored(sizes.groupBy("t", "k").agg(F.max_by("root", F.struct("n", "root")).alias("main"), (F.sum("n") - F.max("n")).alias("others"))
                   .where("others > 0").select("t", "k", "main", F.ceil(F.col("others") / block).alias("other_blocks")), "split")
    todo = members.join(split, ["t", "k"])
    among = F.pmod(F.xxhash64("fp", "t"), F.col("other_blocks"))
    zero = F.lit(0).cast("long")
    # A node outside the largest component meets every block; every node meets the blocks of those outside.
    outside = todo.where("root != main").select("t", "k", "fp", "root", among.alias("i"), F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("j"))
    all_of = todo.select("t", "k", "fp", "root", F.explode(F.sequence(zero, F.col("other_blocks") - 1)).alias("i"), own.alias("j"))
    across = outside.unionByName(all_of).select(F.xxhash64("t", "k", "i", "j").alias("g"), "fp", "root")
    stars = found.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    return components(stars.unionByName(_grouped_links(across, radius)).distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, radius: int = 4) -> DataFrame:
    """Row number, doc_id, fingerprint (16 hex digits), component_id and root (a fingerprint of the component) of every row.

    Rows link when their fingerprints differ in at most ``radius`` bits; the
    component is the smallest doc_id reachable. A null text counts as empty;
    a text without words has fingerprint zero and links like any other. A row
    with a null id takes part, but its id is never the smallest unless no
    other is there. An empty table gives no rows; other columns are not read.
    """
    rows = fingerprints(docs, id_col, text_col, shingle)
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    # Both are stored, so that the join below shuffles both sides and AQE can split a component of any size.
    placed = stored(nodes.join(roots(nodes.select("fp"), radius).withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed")
    least = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    return rows.join(placed.select("fp", "root").join(least, "root"), "fp").select(
        ROW, "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "root")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4) -> DataFrame:
    """One row of each component of ``docs`` (read from files): that of the smallest id; all columns as they were."""
    rows = stored(near_duplicates(docs, shingle=shingle, radius=radius).select(ROW, "doc_id", "root"), "components")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", ROW)).alias("first"))
    return without(docs, rows.join(first.select(F.col(f"first.{ROW}").alias(ROW)), ROW, "left_anti"))
