"""Approximate nearest neighbours by shifted space-filling curves.

Every distinct vector is projected by ``CURVES`` random rotations to ``DIMS``
dimensions, shifted, cut into cells, and placed on the Hilbert curve of each.
The cells are ``1 << FINE_BITS`` to an axis, so vectors that are nearly equal
have an order of their own on each curve.
Spark range-partitions and sorts the curves; positions along them are cut
into windows. A query meets its own window and both neighbours on every
curve, the short lists of all curves merge, and the merged list is reranked by
the exact cosine of the original vectors.

The window grows with the table: ``WINDOW`` vectors up to ``WINDOW_AT``
classes and from there with their number to the power ``GROWTH``, which keeps
recall on vectors without any structure (``window_for``). Beyond
``LARGEST_BLOCK`` vectors, or ``BLOCK_BYTES``, a window is cut into blocks, and a query meets as
many blocks either side as make up a window.

Identical vectors are one class with its smallest ids, so a vector that is
common to any share of the rows is placed, compared and shuffled once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from couponlens.llm.common import stored

CURVES, DIMS, CELL_BITS, WINDOW, SHORTLIST, SEED = 32, 16, 3, 384, 32, 7
WINDOW_AT, GROWTH, LARGEST_BLOCK = 50_000, 0.85, 65_536
#: Bytes of a block's vectors in double precision, and lengths of vectors that are answered, each among its own.
BLOCK_BYTES, LENGTHS = 1 << 26, 16
#: Bits of an axis that a curve's key holds: a cell is 4e-7 standard deviations wide, about what float32 tells apart.
FINE_BITS = 24
#: Scores of a block that are held at once.
SCORES = 1 << 23
#: Half the width of the grid, in standard deviations of a projected unit vector.
REACH = 3.5


def hilbert_words(cells: np.ndarray, bits: int, per_word: int) -> list[np.ndarray]:
    """Positions along the Hilbert curve of integer points (points, dims), ``per_word`` bits of each axis to a number, highest first.

    Walks from the highest bit down, undoing each sub-cube's reflection and
    exchange of axes, then reads the Gray code off the interleaved bits.
    """
    x = np.ascontiguousarray(cells.T)
    for level in range(bits - 1, 0, -1):
        low = x.dtype.type((1 << level) - 1)
        for axis in x:
            high = -((axis >> level) & 1)  # all bits or none
            swapped = (x[0] ^ axis) & low & ~high
            x[0] ^= (high & low) | swapped
            axis ^= swapped
    words, parity = [], np.zeros(x.shape[1], x.dtype)
    for n, level in enumerate(range(bits - 1, -1, -1)):
        if n % per_word == 0:
            words.append(np.zeros(x.shape[1], np.int64))
        for axis in x:
            parity ^= (axis >> level) & 1
            words[-1] <<= 1
            words[-1] |= parity
    return words


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions along the Hilbert curve of integer points (points, dims), dims x bits at most 63."""
    return hilbert_words(cells.astype(np.int64), bits, bits)[0]


def curve_keys(unit: np.ndarray, curves: int = CURVES, dims: int = DIMS, bits: int = CELL_BITS, seed: int = SEED) -> Iterator[np.ndarray]:
    """Keys of unit vectors along each curve, as byte strings of one length in the curve's order.

    Rotation and shift of a curve depend on the seed and its number alone. The
    first ``bits`` of each axis are cells of the whole grid, the others cut them further.
    """
    width = unit.shape[1]
    dims, cell, fine = min(dims, width), 2 * REACH / (1 << bits), 1 << (FINE_BITS - bits)
    for curve in range(curves):
        rng = np.random.default_rng([seed, curve])
        axes = np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dims]
        at = (unit @ axes * np.sqrt(width) + REACH) / cell + rng.random(dims) - 0.5
        words = hilbert_words(np.clip(np.floor(at * fine), 0, (1 << FINE_BITS) - 1).astype(np.int32), FINE_BITS, CELL_BITS)
        # A word has at most 48 bits: the lower six of its bytes.
        yield np.ascontiguousarray(np.stack(words, axis=1).astype(">i8").view(np.uint8).reshape(len(unit), -1, 8)[:, :, 2:]).reshape(len(unit), -1)


def window_for(classes: int) -> int:
    """Vectors of a window for a table of so many distinct vectors."""
    return max(WINDOW, math.ceil(WINDOW * (classes / WINDOW_AT) ** GROWTH))


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows of length one; by their largest component first, so that no square of a tiny or huge one is lost."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def valid_vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part: finite, not zero, with an id."""
    v = F.col(vec_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def scaled(v: Column) -> Column:
    """A vector in double precision, times a power of two (exactly) that brings its largest component near one."""
    wide = F.transform(v, lambda x: x.cast("double"))
    largest = F.array_max(F.transform(wide, lambda x: F.abs(x)))
    exponent = F.greatest(F.least(F.floor(F.log2(largest)), F.lit(1000)), F.lit(-1000))
    return F.transform(wide, lambda x: x * F.pow(F.lit(2.0), -exponent))


def place(classes: DataFrame, curves: int, window: int, dims: int) -> DataFrame:
    """(curve, block, cls, asked) of every class on every curve; a block is ``window`` successive positions."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                m = unit_rows(_matrix(batch.column(2)))
                for curve, key in enumerate(curve_keys(m, curves, dims)):
                    ends = np.arange(len(key) + 1, dtype=np.int32) * key.shape[1]
                    key = pa.Array.from_buffers(pa.binary(), len(key), [None, pa.py_buffer(ends), pa.py_buffer(key)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(key), curve, np.int32)), key, batch.column(0), batch.column(1)],
                        ["curve", "key", "cls", "asked"])

    keyed = stored(classes.select("cls", "asked", "v").mapInArrow(keys, "curve int, key binary, cls long, asked boolean"), "curves")
    # The row number holds the partition above bit 33 and the place in it below.
    # Vectors that even the key does not tell apart have another order on each curve.
    along = ["curve", "key", F.xxhash64("curve", "cls")]
    order = stored(keyed.repartitionByRange(*along).sortWithinPartitions(*along)
                   .select("curve", "cls", "asked", F.monotonically_increasing_id().alias("at")), "ordered")
    part, inside = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = order.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # one row per partition
    first = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("first"))
    return order.withColumn("part", part).join(first, "part").select(
        "curve", F.floor((F.col("first") + inside) / window).alias("block"), "cls", "asked")


def _compare(shortlist: int):
    """mapInArrow function over rows (group, is_query, cls, unit float32 bytes) sorted by group."""

    def solve(asks: np.ndarray, cls: np.ndarray, units: np.ndarray) -> Iterator[pa.RecordBatch]:
        asking, c = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not len(asking) or not len(c):
            return
        units = units.astype(np.float64)
        half = (units * units).sum(axis=1) / 2
        take, step = min(shortlist, len(c)), max(1, SCORES // len(c))
        for q in (asking[i:i + step] for i in range(0, len(asking), step)):
            # Half the squared distance, which tells near vectors apart where the cosine is 1 but for rounding.
            score = units[q] @ units[c].T - half[q][:, None] - half[c][None, :]
            score[cls[q][:, None] == cls[c][None, :]] = -np.inf
            best = np.argpartition(-score, take - 1, axis=1)[:, :take]
            s = np.take_along_axis(score, best, axis=1).ravel()
            found = np.isfinite(s)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(cls[q], take)[found]), pa.array(cls[c][best].ravel()[found]),
                                              pa.array(s[found])], ["q", "c", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(),
                   np.frombuffer(b"".join(batch.column(3).to_pylist()), np.float32).reshape(batch.num_rows, -1)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            cuts = np.flatnonzero(held[0][1:] != held[0][:-1]) + 1
            for a, b in zip([0, *cuts[:-1]], cuts):
                yield from solve(*(x[a:b] for x in held[1:]))
            if len(cuts):
                held = [x[cuts[-1]:] for x in held]
        if held is not None:
            yield from solve(*held[1:])

    return run


def nearest(rows: DataFrame, every: int, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", curves: int = CURVES,
            window: int | None = None, dims: int = DIMS, shortlist: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row whose id is divisible by ``every``.

    Nearness is the cosine of the original vectors in double precision, of
    vectors of any magnitude; ties go to the smaller vec_id; the query's own
    id is no candidate. Null or zero vectors, vectors with null or non-finite
    components, and rows without an id take no part. Vectors meet those of
    their own length; more than ``LENGTHS`` lengths are an error. A row
    repeated with its id counts once. With fewer than ``k`` candidates all
    are returned; an empty table gives no rows; other columns are not read.
    Without ``window`` and ``shortlist`` they follow from the number of
    distinct vectors and from ``k``.
    """
    vectors = valid_vectors(rows, id_col, vec_col)
    lengths = [r.n for r in vectors.select(F.size("v").alias("n")).distinct().orderBy("n").limit(LENGTHS + 1).collect()]
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} lengths")
    found = None
    for n in lengths or [0]:
        some = _nearest(vectors.where(F.size("v") == n), n, every, k, curves, window, dims, shortlist or max(SHORTLIST, 2 * (k + 1)))
        found = some if found is None else found.unionByName(some)
    return found


def _nearest(vectors: DataFrame, length: int, every: int, k: int, curves: int, window: int | None, dims: int, shortlist: int) -> DataFrame:
    """``nearest`` of (vec_id, v) with vectors of one length."""
    # Rank limits are applied before the shuffle too, so a hot vector sends k + 1 ids from each task.
    lowest = vectors.withColumn("r", F.dense_rank().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    classes = stored(lowest.groupBy("v").agg(F.array_sort(F.collect_set("vec_id")).alias("ids"))
                     .select(F.element_at("ids", 1).alias("cls"), "ids", "v"), "classes")
    queries = stored(vectors.where(F.col("vec_id") % every == 0).distinct().join(classes.select("v", "cls"), "v")
                     .select(F.col("vec_id").alias("query_id"), "cls"), "queries")
    asked = queries.select("cls").distinct().withColumn("hit", F.lit(True))
    flagged = classes.join(asked, "cls", "left").select("cls", F.coalesce("hit", F.lit(False)).alias("asked"), "v")

    @F.pandas_udf("binary")
    def unit32(v):
        m = np.array(v.tolist(), np.float64).reshape(len(v), -1)
        return type(v)([x.tobytes() for x in unit_rows(m).astype(np.float32)])

    window = window or window_for(classes.count())
    block = max(1, min(window, LARGEST_BLOCK, BLOCK_BYTES // (8 * max(1, length))))
    reach = math.ceil(window / block)
    placed = place(flagged, curves, block, dims).join(classes.select("cls", unit32("v").alias("unit")), "cls")
    members = placed.select("curve", "block", F.lit(False).alias("ask"), "cls", "unit")
    asks = placed.where("asked").select("curve", F.explode(F.sequence(F.col("block") - reach, F.col("block") + reach)).alias("block"),
                                        F.lit(True).alias("ask"), "cls", "unit")
    # Rows of two groups whose hashes meet are compared as well, which harms nothing.
    groups = members.unionByName(asks).select(F.xxhash64("curve", "block").alias("g"), "ask", "cls", "unit").repartition("g").sortWithinPartitions("g")
    found = groups.mapInArrow(_compare(min(shortlist, max(16, k + 1))), "q long, c long, near double").groupBy("q", "c").agg(F.max("near").alias("near"))
    own = asked.select(F.col("cls").alias("q"), F.col("cls").alias("c"))
    short = (found.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("near"), "c")))
             .where(F.col("r") <= shortlist).select("q", "c").unionByName(own))

    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    cosine = dot("qv", "v") / (F.sqrt(dot("qv", "qv")) * F.sqrt(dot("v", "v")))
    scored = (short.join(classes.select(F.col("cls").alias("q"), scaled(F.col("v")).alias("qv")), "q")
              .join(classes.select(F.col("cls").alias("c"), scaled(F.col("v")).alias("v"), "ids"), "c").select("q", cosine.alias("score"), F.explode("ids").alias("vec_id")))
    best = (scored.withColumn("r", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
            .groupBy(F.col("q").alias("cls")).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id", "score"))).alias("near")))
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return (queries.join(best, "cls").select("query_id", F.posexplode(others).alias("i", "x"))
            .select("query_id", (F.col("i") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"))
