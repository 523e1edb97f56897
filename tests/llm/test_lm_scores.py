"""Language-model scores: counts and the unigram against plain ones, the model as a distribution, its gradient, held-out texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from couponlens.llm import maxent

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_words(text):
    import re
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))


def plain_base(rows):
    """(doc_id, held_out, n_tokens, n_known, N, base score) of each row."""
    out = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    c = Counter(w for held, (_, t) in zip(out, rows) if not held for w in [*plain_words(t), None])
    n, v = c.total(), len(c)
    for held, (d, t) in zip(out, rows):
        tokens = [*plain_words(t), None]
        yield d, held, len(tokens), sum(c[w] > 0 for w in tokens), n, sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)


def awkward():
    rng = np.random.default_rng(1)
    words = [f"w{int(i)}" for i in rng.zipf(1.3, 4000) % 700] + ["Über", "über", "日本語", "\x00", "a\x1fb", " x", "W1"] * 20
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 40)))) for i in range(300)]
    rows += [(301, None), (302, ""), (303, " \t\r\n"), (None, rows[5][1]), (304, "w1 " * 50_000), (305, "x" * 100_000), (306, "x" * 100_000 + " w1")]
    return rows + [rows[7]] * 9 + [(400 + i, rows[8][1]) for i in range(50)]


def table(spark, path, rows):
    spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "doc_id long, text string, c int, word string, score double").repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("head", [1 << 17, 20])
def test_counts_and_unigram_are_the_plain_ones(spark, tmp_path, monkeypatch, head):
    monkeypatch.setattr(maxent, "HEAD", head)
    rows = awkward()
    found = maxent.scores(table(spark, str(tmp_path / "d"), rows)).collect()
    by = lambda r: (r[0] is None, r[0] or 0)
    wanted = sorted(plain_base(rows), key=by)
    assert len(found) == len(rows)
    for r, w in zip(sorted(found, key=by), wanted):
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:5] and math.isclose(r.base_score, w[5], rel_tol=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def a_tree(leaves, rng, classes=5):
    words = [f"w{i}".encode() for i in range(leaves - 2)] + [maxent.END]
    return maxent.tree_of(words, list(rng.integers(1, 200, leaves) + 0.5), rng.integers(0, classes, leaves))


@pytest.mark.parametrize("leaves", [2, 3, 16, 17, 40, 700])
def test_probabilities_sum_to_one(leaves):
    """Over all next words, after any history and with any weights; with none they are the weights' shares."""
    rng = np.random.default_rng(leaves)
    tree = a_tree(leaves, rng)
    weights = rng.normal(size=(maxent.ROWS, maxent.WAYS)).astype(np.float32)
    for history in ([], [0], [1, 0], [0, 1, 1, 0]):
        ids = np.array([[*history, i] for i in range(leaves)], np.int32).ravel()
        begins = np.arange(len(ids)) % (len(history) + 1) == 0
        last = np.arange(leaves) * (len(history) + 1) + len(history)
        assert math.isclose(np.exp(maxent.log_probabilities(tree, weights, ids, begins)[last]).sum(), 1, rel_tol=1e-4)
        plain = np.exp(maxent.log_probabilities(tree, np.zeros_like(weights), ids, begins)[last])
        assert np.allclose(plain, tree.weights / tree.weights.sum(), rtol=1e-4)


def test_steps_follow_the_gradient(monkeypatch):
    """With one step and no scaling, weights move against the numeric gradient of the text's log loss."""
    rng = np.random.default_rng(2)
    tree, rows = a_tree(60, rng), maxent.ROWS  # so many that classes share hardly any
    ids = rng.integers(0, 60, 200).astype(np.int32)
    begins = rng.random(200) < 0.1
    begins[0] = True
    start = (0.3 * rng.normal(size=(rows, maxent.WAYS))).astype(np.float32)
    firm = 1e12
    monkeypatch.setattr(maxent, "RATE", math.sqrt(firm))
    moved = start.copy()
    uses = np.zeros(rows, np.float32)
    maxent.train(tree, moved, np.full(rows, firm, np.float32), uses, ids, begins)
    assert (moved[uses == 0] == start[uses == 0]).all() and uses.sum() == maxent.FEATURES * (tree.nodes[ids, :maxent.LEVELS] >= 0).sum()
    often = np.argsort(-uses)[:25]
    for row, way in zip(often, rng.integers(0, maxent.WAYS, 25)):
        losses = []
        for shift in (0.01, -0.01):
            w = start.astype(np.float64)
            w[row, way] += shift
            losses.append(-maxent.log_probabilities(tree, w.astype(np.float32), ids, begins).sum())
        assert abs((losses[0] - losses[1]) / 0.02 - (start - moved)[row, way]) < 0.05


def test_history_ends_at_the_text():
    tree = a_tree(50, np.random.default_rng(3))
    texts = [np.random.default_rng(i).integers(0, 50, n).astype(np.int32) for i, n in enumerate([1, 7, 2, 30, 1, 3])]
    begins = np.concatenate([np.arange(len(t)) == 0 for t in texts])
    weights = np.random.default_rng(4).normal(size=(maxent.ROWS, maxent.WAYS)).astype(np.float32)
    alone = np.concatenate([maxent.log_probabilities(tree, weights, t, np.arange(len(t)) == 0) for t in texts])
    assert np.allclose(maxent.log_probabilities(tree, weights, np.concatenate(texts), begins), alone, atol=1e-5)


def test_word_classes_tell_company():
    """Words that stand near other anchors are other classes."""
    near = np.kron(np.eye(3), np.full((20, 4), 9)) + np.random.default_rng(5).integers(0, 2, (60, 12))
    found = maxent.word_classes(near, np.ones(60), 3)
    assert len(set(found[:20])) == len(set(found[20:40])) == len(set(found[40:])) == 1 and len(set(found)) == 3


def test_held_out_texts_are_better_told(spark):
    """Of the given documents, nearly every held-out text is likelier than by the unigram, and a second run agrees."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = maxent.scores(docs).where("held_out").orderBy("doc_id").collect()
    assert sum(r.score for r in found) > 0.97 * sum(r.base_score for r in found)
    assert np.mean([r.score > r.base_score for r in found if r.n_tokens > 20]) > 0.9
    again = maxent.scores(docs).where("held_out").orderBy("doc_id").collect()
    assert all(math.isclose(a.score, b.score, rel_tol=1e-6) for a, b in zip(found, again))


def test_scores_of_little(spark, tmp_path):
    docs = table(spark, str(tmp_path / "d"), [(1, "a b"), (2, None)])
    assert maxent.scores(docs.limit(0)).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    alone = maxent.scores(table(spark, str(tmp_path / "h"), [(held, "a b")])).collect()
    assert [(r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in alone] == [(True, 3, 0, 0)] and math.isfinite(alone[0].score)
    assert docs.select(F.col("doc_id")).count() == 2
