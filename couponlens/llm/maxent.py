"""Language-model scores by a hashed maximum-entropy model with nested word classes.

The vocabulary's ``HEAD`` most frequent words, the end of a text and one
symbol for all other words are the leaves of a tree of classes: first word
classes, found by k-means of the frequent words that stand near a word, then
classes of at most ``WAYS`` members, frequent words higher up. The
probability of a word is the product of the softmaxes down its path. A
class's scores are its members' log frequencies plus one weight row for each
feature of the history: the word before, the one before that (a skip), and
the classes of the last three, each hashed with the class to one of ``ROWS``
rows. That holds for the first ``LEVELS`` classes of a path; the small classes
of rare words below go by frequency alone. With all weights zero the model is the smoothed unigram that it is
compared with; a word outside the tree is the other-word symbol times its own
smoothed share of it, so that all words, and one for unknown ones, sum to 1.

Training takes every token of the training texts once, in ``ROUNDS`` rounds
over a part of the texts each. In a round every task goes through its texts
in small batches, by gradient steps from the round's weights, and gives the
change and the uses of every row; Spark takes the mean change by use, slice
of rows by slice, and it is added to the weights. A task has at least
``TASK_TOKENS`` tokens, so that what it gives stays small beside its texts.

The counts of all words are a table. The driver and the tasks hold the tree
and the weights, both bounded by ``HEAD`` and ``ROWS``; counts of the other
words reach the texts by a join.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import ROW, numbered, stored, whole_text

#: Words in the tree, how often they occur at least, and how long they are at most.
HEAD, LEAST, LONGEST = 1 << 17, 3, 128
WAYS, FEATURES, ROWS, ROUNDS, LEVELS = 16, 3, 1 << 16, 3, 3
#: Step of a weight, and the squares that every row begins with: the larger, the less a few uses move a row.
RATE, FIRM = 0.4, 4.0
#: Tokens of a gradient step, tokens scored at once, bytes of text whose words a task keeps, rows of a slice, tokens of a task of a round.
STEP, SCORED, HELD_BYTES, SLICE, TASK_TOKENS = 16384, 16384, 1 << 23, 1 << 10, 500_000
#: Word classes, and the frequent words they are told by, within so many places either side.
CLASSES, ANCHORS, NEAR, NEAR_CODES = 12, 32, 2, 1 << 22
#: Stands for the end of a text in the table of counts; words are never empty.
END = b""
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased: runs of all but the space and the ASCII control spaces."""
    return text.translate(LOWER).split()


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 5, is 1 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 1, F.lit(False))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size, texts = Counter(), 0, 0

    def rows() -> pa.RecordBatch:
        held[END] = texts
        columns = [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in batches:
        for text in batch.column(0):
            text = text.as_py()
            held.update(words_of(text))
            texts, size = texts + 1, size + len(text)
            if size > HELD_BYTES:
                yield rows()
                held, size, texts = Counter(), 0, 0
    if texts:
        yield rows()


@dataclass
class Tree:
    """Nested classes: leaf ``i`` is ``words[i]``, the last one all other words. Paths are padded to the longest with -1."""

    words: list[bytes]
    weights: np.ndarray
    nodes: np.ndarray
    branches: np.ndarray
    bias: np.ndarray
    #: Log share of each leaf below the classes that go by the history.
    below: np.ndarray

    @property
    def other(self) -> int:
        return len(self.words)


def merged(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes (a level a column, -1 below a leaf's last) and members on the way to each leaf, and the classes' log shares.

    The lightest ``WAYS`` are merged until one class, number 0, is left.
    """
    leaves = len(weights)
    heap = [(w, i) for i, w in enumerate(weights.tolist())]
    heapq.heapify(heap)
    # The first merge takes as many as make all others full; a class of one leaf needs no merge.
    take = (leaves - 2) % (WAYS - 1) + 2 if leaves > 1 else 1
    made = 1 if leaves == 1 else -(-(leaves - take) // (WAYS - 1)) + 1
    above, member = np.full(leaves + made, -1), np.zeros(leaves + made, np.int8)
    bias = np.full((made, WAYS), -np.inf, np.float32)
    for node in range(made - 1, -1, -1):
        members = [heapq.heappop(heap) for _ in range(take)]
        children, total = [child for _, child in members], math.fsum(w for w, _ in members)
        above[children], member[children], take = node, np.arange(take), WAYS
        bias[node, :len(members)] = np.log([w / total for w, _ in members])
        heapq.heappush(heap, (total, leaves + node))
    up, members, at = [], [], np.arange(leaves)
    while (above[at] >= 0).any():
        up.append(above[at])
        members.append(member[at])
        at = np.where(above[at] >= 0, leaves + above[at], at)
    up, members = np.array(up).T, np.array(members).T
    # From the leaf upwards so far: turned round, each from its own last class.
    depth = (up >= 0).sum(axis=1, keepdims=True)
    level = np.arange(up.shape[1])
    place = np.maximum(depth - 1 - level, 0)
    inside = level < depth
    return (np.where(inside, np.take_along_axis(up, place, axis=1), -1),
            np.where(inside, np.take_along_axis(members, place, axis=1), 0), bias)


def tree_of(words: list[bytes], weights: list[float], classes: np.ndarray) -> Tree:
    """Leaves with these weights (one more than words: that of all others), first by their class (below ``WAYS``), then by weight."""
    w = np.array(weights)
    used = np.unique(classes)
    root = np.full((1, WAYS), -np.inf, np.float32)
    root[0, :len(used)] = np.log([w[classes == c].sum() / w.sum() for c in used])
    parts = [merged(w[classes == c]) for c in used]
    depth = 1 + max(nodes.shape[1] for nodes, _, _ in parts)
    nodes, branches, bias = np.full((len(w), depth), -1, np.int32), np.zeros((len(w), depth), np.int8), [root]
    nodes[:, 0] = 0
    for branch, (c, (below, members, more)) in enumerate(zip(used, parts)):
        leaves = np.flatnonzero(classes == c)
        branches[leaves, 0] = branch
        nodes[leaves, 1:1 + below.shape[1]] = np.where(below >= 0, below + sum(map(len, bias)), -1)
        branches[leaves, 1:1 + below.shape[1]] = members
        bias.append(more)
    bias, deep = np.concatenate(bias), nodes[:, LEVELS:]
    below = np.where(deep >= 0, bias[deep, branches[:, LEVELS:]], 0).sum(axis=1)
    return Tree(words, w, nodes, branches, bias, below)


def word_classes(near: np.ndarray, weights: np.ndarray, k: int = CLASSES) -> np.ndarray:
    """Class of each word, by weighted k-means of what is near it: (words, anchors) counts. Words of no anchor go by all words' mean."""
    total = near.sum(axis=0)
    if not total.sum() or len(near) <= k:
        return np.arange(len(near)) % k
    x = np.sqrt((near + 5 * total / total.sum()) / (near.sum(axis=1, keepdims=True) + 5))
    # Centres: the most frequent word, then ever the one that is farthest from all, by the frequent ones.
    often = np.argsort(-weights, kind="stable")[:2000]
    centres = x[often[:1]]
    for _ in range(k - 1):
        gap = np.min([((x[often] - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres = np.concatenate([centres, x[often[np.argmax(gap * np.sqrt(weights[often]))]][None]])
    for _ in range(12):
        found = np.argmax(x @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)
        for c in range(k):
            if (found == c).any():
                centres[c] = np.average(x[found == c], axis=0, weights=weights[found == c])
    return found


def _before(ids: np.ndarray, begins: np.ndarray, lag: int, none: int) -> np.ndarray:
    """The value ``lag`` places before each token of its text, ``none`` where the text has none."""
    place = np.arange(len(ids))
    since = place - np.maximum.accumulate(np.where(begins, place, 0))
    return np.where(since >= lag, np.roll(ids, lag), none).astype(np.int64)


def histories(tree: Tree, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """(tokens, FEATURES) hashes of the features of each token's history; ``begins`` marks first tokens of texts."""
    one, two = (_before(ids, begins, lag, -1).view(np.uint64) for lag in (1, 2))
    classes = tree.branches[ids, 0]
    gram = sum(_before(classes, begins, lag, WAYS) << (5 * (lag - 1)) for lag in (1, 2, 3)).astype(np.uint64)
    out = np.stack([(one + np.uint64(3)) * np.uint64(0x9E3779B97F4A7C15), (two + np.uint64(7)) * np.uint64(0xC2B2AE3D27D4EB4F),
                    (gram + np.uint64(11)) * np.uint64(0x94D049BB133111EB)], axis=1)
    return out ^ (out >> np.uint64(29))


def _rows_at(history: np.ndarray, nodes: np.ndarray, size: int) -> np.ndarray:
    """Weight row of each feature at each token's class."""
    h = (history ^ (nodes.astype(np.uint64) + np.uint64(1))[:, None] * np.uint64(0xD6E8FEB86659FD93)) * np.uint64(0xFF51AFD7ED558CCD)
    return (h >> np.uint64(65 - size.bit_length())).astype(np.uint16)


def _levels(tree: Tree, weights: np.ndarray, ids: np.ndarray, history: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """For each of the first ``LEVELS`` levels of the tree: tokens that have it, weight rows, member taken, and probabilities of all members."""
    for level in range(min(LEVELS, tree.nodes.shape[1])):
        at = np.flatnonzero(tree.nodes[ids, level] >= 0)
        nodes = tree.nodes[ids[at], level]
        rows = _rows_at(history[at], nodes, len(weights))
        z = tree.bias.take(nodes, axis=0)
        for feature in range(rows.shape[1]):
            z += weights.take(rows[:, feature], axis=0)
        share = np.exp(z)  # weights are a few units, so no sum of them runs over
        share /= (share @ np.ones(WAYS, np.float32))[:, None]
        yield at, rows, tree.branches[ids[at], level], share


def log_probabilities(tree: Tree, weights: np.ndarray, ids: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Natural log probability of each token's leaf."""
    out = tree.below[ids].astype(float)
    history = histories(tree, ids, begins)
    for lo in range(0, len(ids), SCORED):
        part = slice(lo, lo + SCORED)
        for at, _, taken, share in _levels(tree, weights, ids[part], history[part]):
            out[lo + at] += np.log(share[np.arange(len(at)), taken])
    return out


def train(tree: Tree, weights: np.ndarray, squares: np.ndarray, uses: np.ndarray, ids: np.ndarray, begins: np.ndarray) -> None:
    """Gradient steps over successive tokens; changes ``weights``, the gradients' ``squares`` and the rows' ``uses``."""
    history = histories(tree, ids, begins)
    for lo in range(0, len(ids), STEP):
        part = slice(lo, lo + STEP)
        for at, rows, taken, error in _levels(tree, weights, ids[part], history[part]):
            if not len(at):
                continue
            error[np.arange(len(at)), taken] -= 1
            flat = rows.ravel()
            order = np.argsort(flat, kind="stable")
            row = flat[order]
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            row = row[first]
            slope = np.add.reduceat(error.take(order // rows.shape[1], axis=0), first, axis=0)
            squares[row] += (slope * slope) @ np.ones(WAYS, np.float32)
            weights[row] -= slope * (RATE / np.sqrt(squares[row]))[:, None]
            uses[row] += np.diff(np.append(first, len(flat)))


@dataclass
class Model:
    tree: Tree
    weights: np.ndarray
    counts: DataFrame
    tokens: int
    distinct: int
    #: Smoothed occurrences of all words outside the tree, unknown ones with them.
    others: float


def encoded(docs: DataFrame, head: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """Row number, doc_id, held_out, leaves of the text's tokens (places in ``head``) and its words outside it, of every row; stored."""
    number = {w: i for i, w in enumerate(head)}
    other, end = len(head), number[END]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                part = batch.slice(lo, 512)
                ids, rest = [], []
                for text in part.column(3):
                    words = words_of(text.as_py())
                    found = [number.get(w, other) for w in words]
                    rest.append([w for w, i in zip(words, found) if i == other])
                    found.append(end)
                    ids.append(np.array(found, np.int32).tobytes())
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(ids, pa.binary()), pa.array(rest, pa.list_(pa.binary()))],
                                                 [ROW, "doc_id", "held_out", "ids", "others"])

    rows = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), whole_text(text_col).cast("binary").alias("t")))
    return stored(rows.select(ROW, "doc_id", "held_out", "t").mapInArrow(
        run, f"{ROW} long, doc_id long, held_out boolean, ids binary, others array<binary>"), "tokens")


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """Leaves of successive texts of a batch and marks of their first tokens, some 2^18 tokens at a time, and the rows they are of."""
    held, size, lo = [], 0, 0
    for i, ids in enumerate(batch.column(column)):
        held.append(np.frombuffer(ids.as_py(), np.int32))
        size += len(held[-1])
        if size > 1 << 18 or i == batch.num_rows - 1:
            begins = np.zeros(size, bool)
            begins[np.cumsum([0, *map(len, held[:-1])])] = True  # a text has its end at least
            yield np.concatenate(held), begins, lo, i + 1
            held, size, lo = [], 0, i + 1


def _near(leaves: int) -> Callable:
    """mapInArrow function over texts (ids): how often leaves stand near the first ``ANCHORS`` ones, as slices of (place, count)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, codes = np.zeros(leaves * ANCHORS, np.int32), []

        def add() -> None:
            np.add(total, np.bincount(np.concatenate([np.empty(0, np.int64), *codes]), minlength=len(total)), out=total, casting="unsafe")
            codes.clear()

        for batch in batches:
            for ids, begins, _, _ in _texts(batch, 0):
                for lag in range(1, NEAR + 1):
                    before = _before(ids, begins, lag, leaves)
                    for word, anchor in ((ids, before), (before, ids)):
                        hit = np.flatnonzero(anchor < ANCHORS)
                        hit = hit[word[hit] < leaves]
                        codes.append(word[hit].astype(np.int64) * ANCHORS + anchor[hit])
                if sum(map(len, codes)) > NEAR_CODES:
                    add()
        add()
        at = np.flatnonzero(total)
        cuts = np.searchsorted(at, np.arange(0, len(total) + SLICE * ANCHORS, SLICE * ANCHORS))
        some = [i for i in range(len(cuts) - 1) if cuts[i] < cuts[i + 1]]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()),
                                          pa.array([(at[cuts[i]:cuts[i + 1]] - i * SLICE * ANCHORS).astype(np.uint16).tobytes() for i in some], pa.binary()),
                                          pa.array([total[at[cuts[i]:cuts[i + 1]]].tobytes() for i in some], pa.binary())], ["slice", "at", "n"])

    return run


def _sum_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of rows (slice, at, n), by slice in order, as single-precision numbers."""
    now, total = None, np.zeros(SLICE * ANCHORS)

    def done() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total.astype(np.float32).tobytes()], pa.binary())], ["slice", "near"])
        total[:] = 0
        return out

    for batch in batches:
        for part, at, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if part != now and now is not None:
                yield done()
            now = part
            total[np.frombuffer(at, np.uint16)] += np.frombuffer(n, np.int32)
    if now is not None:
        yield done()


def _round(tree: Tree, start: np.ndarray) -> Callable:
    """mapInArrow function over texts (ids): what their tokens change, as slices of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, squares, uses = start.copy(), np.full(len(start), FIRM, np.float32), np.zeros(len(start), np.float32)
        for batch in batches:
            for ids, begins, _, _ in _texts(batch, 0):
                train(tree, weights, squares, uses, ids, begins)
        weights = (weights - start).astype(np.float16)
        some = [i for i in range(0, len(start), SLICE) if uses[i:i + SLICE].any()]
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([task] * len(some), pa.int32()),
                                          pa.array([weights[i:i + SLICE].tobytes() for i in some], pa.binary()),
                                          pa.array([uses[i:i + SLICE].tobytes() for i in some], pa.binary())], ["slice", "task", "change", "uses"])

    return run


def _mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (slice, task, change, uses) in order: the mean change by use of each slice."""
    now, change, uses = None, None, None

    def done() -> pa.RecordBatch:
        mean = (change / np.maximum(uses, 1)[:, None]).astype(np.float32)
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([mean.tobytes()], pa.binary())], ["slice", "mean"])

    for batch in batches:
        for part, _, c, u in zip(*(batch.column(i) for i in range(4))):
            if part.as_py() != now:
                if now is not None:
                    yield done()
                now, change, uses = part.as_py(), 0.0, 0.0
            weight = np.frombuffer(u.as_py(), np.float32).astype(float)
            uses = uses + weight
            change = change + np.frombuffer(c.as_py(), np.float16).astype(float).reshape(-1, WAYS) * weight[:, None]
    if now is not None:
        yield done()


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame]:
    """A model of the texts that are not held out, and all rows as tokens (``encoded``)."""
    texts = docs.where(~held_out(id_col)).select(whole_text(text_col).cast("binary").alias("t"))
    counts = stored(texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c")), "counts")
    tokens, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = counts.where((F.col("c") >= LEAST) & (F.octet_length("word") <= LONGEST) & (F.octet_length("word") > 0))
    head = [(bytes(r.word), r.c) for r in frequent.orderBy(F.desc("c"), "word").limit(HEAD).collect()]
    ends = counts.where(F.col("word") == F.lit(END)).select("c").first()
    head.append((END, ends.c if ends else 0))
    known = len(head) - (ends is None)
    others = tokens - sum(c for _, c in head) + 0.5 * (distinct - known + 1)
    words, leaf_weights = [w for w, _ in head], [c + 0.5 for _, c in head] + [others]
    rows = encoded(docs, words, id_col, text_col)
    taught = rows.where(~F.col("held_out"))
    tasks = lambda parts: max(1, int(tokens) // (TASK_TOKENS * parts))
    near = np.zeros((len(words), ANCHORS), np.float32)  # without the end, which is near no word
    parts = taught.select("ids").coalesce(tasks(1)).mapInArrow(_near(len(words) - 1), "slice int, at binary, n binary")
    parts = parts.repartition("slice").sortWithinPartitions("slice").mapInArrow(_sum_near, "slice int, near binary")
    for r in parts.collect():  # HEAD x ANCHORS numbers
        some = near[r.slice * SLICE:(r.slice + 1) * SLICE]
        some[:] = np.frombuffer(bytes(r.near), np.float32).reshape(-1, ANCHORS)[:len(some)]
    classes = word_classes(near[:-1], np.array(leaf_weights[:-2]))
    tree = tree_of(words, leaf_weights, np.append(classes, [CLASSES, CLASSES]))
    weights = np.zeros((ROWS, WAYS), np.float32)
    for n in range(ROUNDS if tokens else 0):
        part = taught.where(F.pmod(F.xxhash64(ROW), F.lit(ROUNDS)) == n).select("ids").coalesce(tasks(ROUNDS))
        changes = part.mapInArrow(_round(tree, weights), "slice int, task int, change binary, uses binary")
        means = changes.repartition("slice").sortWithinPartitions("slice", "task").mapInArrow(_mean, "slice int, mean binary")
        weights = weights.copy()
        for r in means.collect():  # the model's rows: at most ROWS x WAYS numbers
            weights[r.slice:r.slice + SLICE] += np.frombuffer(bytes(r.mean), np.float32).reshape(-1, WAYS)
    return Model(tree, weights, counts, tokens, distinct, others), rows


def score(model: Model, rows: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of rows as ``encoded`` gives them."""
    tree, weights = model.tree, model.weights
    whole = model.tokens + 0.5 * (model.distinct + 1)
    base = np.log10(tree.weights / whole)
    base[tree.other] = 0.0  # those words' own counts come by the join
    known = tree.weights > 0.75

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [np.zeros(batch.num_rows) for _ in range(5)]
            for ids, begins, lo, hi in _texts(batch, 3):
                first = np.flatnonzero(begins)
                logs = log_probabilities(tree, weights, ids, begins) / math.log(10)
                is_other = ids == tree.other
                for o, values in zip(out, (np.ones(len(ids)), known[ids] & ~is_other, is_other, base[ids], logs)):
                    o[lo:hi] = np.add.reduceat(values.astype(float), first)
            columns = [pa.array(o.astype(np.int64)) for o in out[:3]] + [pa.array(o) for o in out[3:]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], [ROW, "doc_id", "held_out", "tokens", "known", "n_others", "base", "logs"])

    scored = rows.select(ROW, "doc_id", "held_out", "ids").mapInArrow(
        run, f"{ROW} long, doc_id long, held_out boolean, tokens long, known long, n_others long, base double, logs double")
    # A row's repeated words meet their count once.
    asked = rows.select(ROW, F.explode("others").alias("word")).groupBy("word", ROW).agg(F.count("*").alias("n"))
    told = asked.join(model.counts, "word", "left").groupBy(ROW).agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("own"), F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("met"))
    own = F.coalesce("own", F.lit(0.0))
    return scored.join(told, ROW, "left").select(
        "doc_id", "held_out", F.col("tokens").alias("n_tokens"), (F.col("known") + F.coalesce("met", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + own - F.col("n_others") * math.log10(whole)).alias("base_score"),
        (F.col("logs") + own - F.col("n_others") * math.log10(model.others)).alias("score"))


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (read from files).

    The model learns from the rows that are not held out. Scores are log10
    probabilities of the whole text, its end included; ``base_score`` is that of the
    smoothed unigram. A null or empty text is its end alone; a null id is not
    held out; repeated rows count, and are scored, each for themselves. With
    nothing to learn from all words are unknown. An empty table gives no
    rows; other columns are not read. A text of any length is scored whole.
    """
    model, rows = learn(docs, id_col, text_col)
    return score(model, rows)
