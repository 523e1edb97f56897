"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds blocks of documents of one signature width. An entry of a
document is a (term, level): a term that occurs ``tf`` times is entered at
every level of ``LEVELS`` up to ``tf``, at ``PROBES`` bits each. A block is
stored by slices, one bitmap of its documents per signature bit. The levels
that all probes of a term confirm can only be too high, so that the weighted
sum over an item's terms, each with the largest frequency its level allows
and the document's own length, is an upper bound of the score.

A search asks the blocks twice. First they give each item's documents of the
largest bounds; their exact scores set a threshold, the smallest score that
can still be among the ``k`` best. Then every document whose bound reaches
the threshold is scored exactly from its whole text: only documents that are
provably not among the best are left out.

Items are answered in blocks of ``ITEMS``, so the terms, weights and
thresholds that a task or the driver holds are bounded by that, not by the
number of items or documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from couponlens.llm.common import ROW, numbered, stored, whole_text

BITS, PROBES, SEED = 16, 6, 11
#: Term frequencies that are levels: powers of two, and half as much again.
LEVELS = np.array(sorted({1 << i for i in range(40)} | {3 << i for i in range(39)}), np.int64)
#: Documents of a block, and bits of one (a longer document has a block of its own).
BLOCK_ROWS, BLOCK_BITS = 1024, 1 << 24
#: Documents, or bytes of text, that a task indexes at once; entries it keeps back to fill blocks; words whose counts it keeps.
BATCH_ROWS, BATCH_BYTES, HELD_ENTRIES, HELD_TERMS = 512, 1 << 21, 1 << 21, 150_000
#: Items that are answered at once.
ITEMS = 1024
#: Rows of (document, items) up to which they are broadcast to the texts; beyond, texts and rows are shuffled.
BROADCAST_ROWS = 200_000
#: Letters A-Z become small, all other ASCII but digits and letters a space; bytes of other characters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text, in order: runs of digits, letters and all that is not ASCII, A-Z lower-cased."""
    return text.translate(FOLD).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def share(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What a term of weight one adds, in millionths, in a document of relative length ``length`` (75 and more)."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * length)


def _entries(hashes: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Hash of each (term, level)."""
    h = hashes + levels.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _probes(entries: np.ndarray, width: int) -> Iterator[np.ndarray]:
    step = (entries >> np.uint64(32)) | np.uint64(1)
    for i in range(PROBES):
        yield ((entries + np.uint64(i) * step) % np.uint64(width)).astype(np.int64)


class _Numbers(dict):
    """Terms numbered in the order they come; ``hashes`` and ``df`` go by number."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def _widths(entries: np.ndarray) -> np.ndarray:
    """Signature width: the next power of two, or three quarters of it, of at least ``BITS`` bits an entry."""
    wanted = np.maximum(64, BITS * entries)
    whole = 1 << np.ceil(np.log2(wanted)).astype(np.int64)
    return np.where(3 * whole // 4 >= wanted, 3 * whole // 4, whole)


class _Indexer:
    """Blocks of the documents of one task."""

    SCHEMA = f"width int, {ROW}s binary, lengths binary, slices binary, term binary, df long"

    def __init__(self):
        self.numbers, self.hashes, self.df = _Numbers(), np.empty(0, np.uint64), np.empty(0, np.int64)
        self.held: dict[int, list] = {}
        self.entries = 0

    def add(self, rows: list[int], texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        ids = [np.fromiter(map(self.numbers.__getitem__, terms_of(t)), np.int64) for t in texts]
        lengths = np.array([len(x) for x in ids], np.int64)
        new = list(self.numbers)[len(self.hashes):]
        self.hashes = np.concatenate([self.hashes, np.array([xxhash.xxh64_intdigest(t, SEED) for t in new], np.uint64)])
        self.df = np.concatenate([self.df, np.zeros(len(new), np.int64)])
        doc = np.repeat(np.arange(len(rows)), lengths)
        pairs, tf = np.unique((doc << 32) | np.concatenate([np.empty(0, np.int64), *ids]), return_counts=True)
        doc, term = pairs >> 32, pairs & 0xFFFFFFFF
        self.df += np.bincount(term, minlength=len(self.df))
        levels = np.searchsorted(LEVELS, tf, side="right")
        first = np.cumsum(levels) - levels
        entries = _entries(np.repeat(self.hashes[term], levels), np.arange(levels.sum()) - np.repeat(first, levels))
        owner = np.repeat(doc, levels)
        widths, rows = _widths(np.bincount(doc, levels, len(rows)).astype(np.int64)), np.array(rows, np.int64)
        of_entry = widths[owner]
        for width in np.unique(widths[lengths > 0]).tolist():
            mine = np.flatnonzero((widths == width) & (lengths > 0))
            some, most = of_entry == width, max(1, min(BLOCK_ROWS, BLOCK_BITS // width))
            place = np.empty(len(rows), np.int64)
            place[mine] = np.arange(len(mine))
            yield from self._parts(width, rows[mine], lengths[mine], place[owner[some]], entries[some], most)
        if len(self.numbers) > HELD_TERMS:
            yield from self.flush_terms()
        if self.entries > HELD_ENTRIES:
            yield from self.flush_blocks()

    def _parts(self, width, rows, lengths, owner, entries, most) -> Iterator[pa.RecordBatch]:
        """Adds documents of one width to what is held of it, and gives the blocks that are full."""
        now = self.held.pop(width, [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)])
        self.entries -= len(now[3])
        now = [np.concatenate([now[0], rows]), np.concatenate([now[1], lengths]),
               np.concatenate([now[2], owner + len(now[0])]), np.concatenate([now[3], entries])]
        while len(now[0]) >= most:
            inside = now[2] < most
            yield self._block(width, now[0][:most], now[1][:most], now[2][inside], now[3][inside])
            now = [now[0][most:], now[1][most:], now[2][~inside] - most, now[3][~inside]]
        self.held[width] = now
        self.entries += len(now[3])

    @staticmethod
    def _block(width, rows, lengths, owner, entries) -> pa.RecordBatch:
        bits = np.zeros((width, len(rows)), bool)
        for at in _probes(entries, width):
            bits[at, owner] = True
        values = [[width], [rows.tobytes()], [lengths.tobytes()], [np.packbits(bits, axis=1).tobytes()], [None], [None]]
        return _Indexer._batch(values)

    @staticmethod
    def _batch(values) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)],
                                          ["width", f"{ROW}s", "lengths", "slices", "term", "df"])

    def flush_blocks(self) -> Iterator[pa.RecordBatch]:
        for width, now in self.held.items():
            if len(now[0]):
                yield self._block(width, *now)
        self.held, self.entries = {}, 0

    def flush_terms(self) -> Iterator[pa.RecordBatch]:
        if self.numbers:
            none = [None] * len(self.numbers)
            yield self._batch([none, none, none, none, list(self.numbers), self.df])
        self.numbers, self.hashes, self.df = _Numbers(), np.empty(0, np.uint64), np.empty(0, np.int64)


def _index_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made = _Indexer()
    for batch in batches:
        rows, texts, size = [], [], 0
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py()
            rows.append(row)
            texts.append(text)
            size += len(text)
            if size > BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield from made.add(rows, texts)
                rows, texts, size = [], [], 0
        if rows:
            yield from made.add(rows, texts)
    yield from made.flush_blocks()
    yield from made.flush_terms()


@dataclass
class Index:
    """``blocks`` of signatures, ``terms`` (term, df), the documents with a term and all their terms with repeats."""

    blocks: DataFrame
    terms: DataFrame
    documents: int
    length: int


def index(docs: DataFrame, text_col: str = "text") -> Index:
    """Index of every row of ``docs`` (read from files) over its whole text; a null text or one without a term is in no block.

    A document of any length is in one block, whose width follows its terms.
    """
    rows = numbered(docs.select(whole_text(text_col).cast("binary").alias("t"))).select(ROW, "t")
    made = stored(rows.mapInArrow(_index_partition, _Indexer.SCHEMA), "signatures")

    @F.pandas_udf("documents long, length long")
    def sizes(lengths: pd.Series) -> pd.DataFrame:
        all_of = [np.frombuffer(x, np.int64) for x in lengths]
        return pd.DataFrame({"documents": [len(x) for x in all_of], "length": [int(x.sum()) for x in all_of]})

    blocks = made.where("width IS NOT NULL").select("width", f"{ROW}s", "lengths", "slices")
    terms = stored(made.where("width IS NULL").groupBy("term").agg(F.sum("df").alias("df")), "terms")
    total = blocks.select(sizes("lengths").alias("s")).agg(F.sum("s.documents"), F.sum("s.length")).first()
    return Index(blocks, terms, total[0] or 0, total[1] or 0)


@dataclass
class Asked:
    """A block of items: their numbers, the terms of all, and (items, terms) weights times occurrences."""

    items: np.ndarray
    terms: list[bytes]
    hashes: np.ndarray
    weights: np.ndarray
    documents: int
    length: int

    def relative_length(self, n):
        return 75 + 25 * n * self.documents // self.length

    def bounds(self, width: int, lengths: np.ndarray, slices: np.ndarray) -> np.ndarray:
        """(items, documents of a block) upper bounds of the scores."""
        slices = slices.reshape(width, -1)
        out = np.zeros((len(self.items), len(lengths)))
        m = self.relative_length(lengths)
        # Terms are taken in parts, so that the products held at once stay small.
        for at in range(0, len(self.terms), 4096):
            active = np.arange(at, min(at + 4096, len(self.terms)))
            level = np.zeros((len(active), len(lengths)), np.int8)
            seen, first = np.full((len(active), slices.shape[1]), 255, np.uint8), active[0]
            for n in range(len(LEVELS)):
                entries = _entries(self.hashes[active], np.full(len(active), n))
                for place in _probes(entries, width):
                    seen &= slices[place]
                hit = seen.any(axis=1)
                active, seen = active[hit], seen[hit]
                if not len(active):
                    break
                level[active - first] += np.unpackbits(seen, axis=1, count=len(lengths)).astype(np.int8)
            t, d = np.nonzero(level)
            if len(t):
                used, t = np.unique(t, return_inverse=True)
                adds = np.zeros((len(used), len(lengths)))
                adds[t, d] = share(LEVELS[np.minimum(level[used[t], d], len(LEVELS) - 1)] - 1, m[d])
                out += self.weights[:, first + used] @ adds
        return out


def asked(index: Index, items: list[tuple[int, bytes]]) -> Asked:
    """The weights of a block of items (number, UTF-8 text); the terms of the block alone go through the driver."""
    spark = index.terms.sparkSession
    counts = [Counter(terms_of(text)) for _, text in items]
    terms = sorted(set().union(*counts))
    wanted = spark.createDataFrame([(t,) for t in terms], "term binary") if terms else index.terms.limit(0).select("term")
    df = {bytes(r.term): r.df for r in index.terms.join(F.broadcast(wanted), "term").collect()}
    terms = [t for t in terms if t in df]  # a term of no document adds nothing
    place = {t: i for i, t in enumerate(terms)}
    weights = np.zeros((len(items), len(terms)))
    for i, c in enumerate(counts):
        for t, n in c.items():
            if t in place:
                weights[i, place[t]] = n * weight(index.documents, df[t])
    hashes = np.array([xxhash.xxh64_intdigest(t, SEED) for t in terms], np.uint64)
    return Asked(np.array([n for n, _ in items], np.int64), terms, hashes, weights, index.documents, index.length)


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            width, rows, lengths, slices = (batch.column(c)[i].as_py() for c in range(4))
            yield width, np.frombuffer(rows, np.int64), np.frombuffer(lengths, np.int64), np.frombuffer(slices, np.uint8)


def _pairs(items: np.ndarray, rows: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(items), pa.array(rows), pa.array(bounds)], ["item", ROW, "bound"])


def _leading(ask: Asked, k: int) -> Callable:
    """mapInArrow function over blocks: the ``k`` documents of each item with the largest bounds in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((len(ask.items), 0))
        at = np.zeros(best.shape, np.int64)
        for width, rows, lengths, slices in _blocks_of(batches):
            best = np.concatenate([best, ask.bounds(width, lengths, slices)], axis=1)
            at = np.concatenate([at, np.broadcast_to(rows, (len(ask.items), len(rows)))], axis=1)
            if best.shape[1] > k:
                top = np.argpartition(-best, k - 1, axis=1)[:, :k]
                best, at = np.take_along_axis(best, top, axis=1), np.take_along_axis(at, top, axis=1)
        i, j = np.nonzero(best)
        yield _pairs(ask.items[i], at[i, j], best[i, j])

    return run


def _reaching(ask: Asked, least: np.ndarray) -> Callable:
    """mapInArrow function over blocks: every document whose bound is at least the item's ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for width, rows, lengths, slices in _blocks_of(batches):
            bounds = ask.bounds(width, lengths, slices)
            # Bounds are whole numbers, exact below 2^53; beyond, the slack covers rounding.
            i, j = np.nonzero(bounds * (1 + 1e-12) >= least[:, None])
            yield _pairs(ask.items[i], rows[j], bounds[i, j])

    return run


def _scores(docs: DataFrame, pairs: DataFrame, ask: Asked, id_col: str, text_col: str) -> DataFrame:
    """(item, row, doc_id, score) of the pairs (item, row), from the whole texts; a text is read once for all its items."""
    by_row = stored(pairs.groupBy(ROW).agg(F.collect_list("item").alias("items")), "candidates")  # at most ITEMS items
    few = by_row.count() <= BROADCAST_ROWS
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).cast("binary").alias("t")))
    place = {t: i for i, t in enumerate(ask.terms)}
    number = {int(n): i for i, n in enumerate(ask.items)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, doc, text, items in zip(*(batch.column(i) for i in range(4))):
                terms = terms_of(text.as_py())
                counts = [(place[t], n) for t, n in Counter(terms).items() if t in place]
                tf = share(np.array([n for _, n in counts], np.int64), np.int64(ask.relative_length(len(terms))))
                at = [p for p, _ in counts]
                # Whole numbers: Python's, so that no sum can pass 64 bits unnoticed.
                for item in items.as_py():
                    w = ask.weights[number[item], at]
                    out.append((item, row.as_py(), doc.as_py(), sum(int(a) * int(b) for a, b in zip(w, tf) if a)))
            names = ["item", ROW, "doc_id", "score"]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in range(4)], names)

    joined = rows.join(F.broadcast(by_row) if few else by_row, ROW).select(ROW, F.col("doc_id").cast("long"), "t", "items")
    return joined.mapInArrow(score, f"item long, {ROW} long, doc_id long, score long")


def _search_block(docs: DataFrame, index: Index, ask: Asked, k: int, id_col: str, text_col: str) -> DataFrame:
    """(item, rank, doc_id, score) of a block of items."""
    if not len(ask.terms):
        return docs.sparkSession.createDataFrame([], "item long, rank int, doc_id long, score long")
    top = W.partitionBy("item").orderBy(F.desc("bound"), ROW)
    lead = index.blocks.mapInArrow(_leading(ask, k), f"item long, {ROW} long, bound double")
    lead = lead.withColumn("r", F.row_number().over(top)).where(F.col("r") <= k)
    scored = _scores(docs, lead.select("item", ROW), ask, id_col, text_col)
    # At most k numbers an item of the block: the k-th best score so far, or 1 where there are fewer.
    found = scored.where("score > 0").groupBy("item").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).collect()
    kth = {r.item: r.s[k - 1] for r in found if len(r.s) >= k}
    least = np.array([kth.get(int(n), 1) for n in ask.items], float)
    reach = index.blocks.mapInArrow(_reaching(ask, least), f"item long, {ROW} long, bound double")
    scored = _scores(docs, reach.select("item", ROW), ask, id_col, text_col).where("score > 0")
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), ROW)
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``k`` highest-scoring rows of ``docs`` (both read from files) with a score above 0.

    Equal scores go by ascending doc_id, a null id last, then by row. Every
    row of either table counts for itself, repeated ones too. A null or empty
    text has no terms: such a document is found by no item, such an item
    finds nothing. Texts of any length are read whole; an empty table gives
    no rows; other columns are not read, whatever their names.
    """
    made = index(docs, text_col)
    asks = stored(numbered(items.select(F.col(item_id).alias("item_id"), whole_text(item_text).cast("binary").alias("t"))), "items")
    # Items are numbered by partition: each range of numbers is a block.
    ranges = [(r.a, r.b) for r in asks.groupBy(F.floor(F.col(ROW) / ITEMS)).agg(F.min(ROW).alias("a"), F.max(ROW).alias("b")).collect()]
    out = None
    for a, b in sorted(ranges):
        block = [(r[ROW], bytes(r.t)) for r in asks.where(F.col(ROW).between(a, b)).orderBy(ROW).select(ROW, "t").collect()]
        found = stored(_search_block(docs, made, asked(made, block), k, id_col, text_col), "ranked")
        out = found if out is None else out.unionByName(found)
    if out is None or not made.documents:
        return items.select(F.col(item_id).alias("item_id"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"),
                            F.lit(0).cast("long").alias("score")).limit(0)
    return out.join(asks.select(F.col(ROW).alias("item"), "item_id"), "item").select("item_id", "rank", "doc_id", "score")
