"""Ranked lexical search against a plain score of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from couponlens.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_terms(text):
    return TERM.findall((text or "").translate(UPPER))


@settings(max_examples=300, deadline=None)
@given(st.text())
def test_terms(text):
    text = text.encode("utf-8", "ignore").decode()
    assert [t.decode() for t in lexical.terms_of(text.encode())] == plain_terms(text)


def plain_search(docs, items, k):
    """Counter of (item_id, rank, doc_id, score)."""
    counts = [(d, Counter(plain_terms(t))) for d, t in docs]
    counts = [(d, c, c.total()) for d, c in counts if c]
    n_docs, length = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = Counter()
    for item, text in items:
        scored = []
        for place, (doc, c, n) in enumerate(counts):
            m = 75 + 25 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                        for t in plain_terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc is None, doc or 0, place, doc))
        out.update((item, rank, doc, -score) for rank, (score, _, _, _, doc) in enumerate(sorted(scored)[:k], 1))
    return out


WORDS = [f"w{i}" for i in range(60)] + ["Ä", "ä", "日本", "a", "A", "x_y", "naïve", "\u0085"]


def awkward(rng):
    docs = [(i, " ".join(rng.choice(WORDS, rng.integers(1, 60) ** 2 // 40 + 1))) for i in range(400)]
    docs += [(500, None), (501, ""), (502, "--- ..."), (None, docs[3][1]), (503, "w1 " * 30_000), (504, " ".join(f"long{i}" for i in range(40_000)) + " w2")]
    docs += [docs[7]] * 5 + [(600 + i, docs[9][1]) for i in range(40)]
    items = [(i, " ".join(rng.choice(WORDS, rng.integers(1, 12)))) for i in range(30)]
    return docs, items + [(50, None), (51, ""), (52, "absent words"), (None, "w1 w2"), items[0], (53, "long7 w2 w2 w2")]


def tables(spark, path, docs, items):
    spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, item int, rank string").repartition(3).write.parquet(f"{path}/d")
    spark.createDataFrame([(*i, 1, "x") for i in items], "item_id long, text string, score int, t string").coalesce(2).write.parquet(f"{path}/i")
    return spark.read.parquet(f"{path}/d"), spark.read.parquet(f"{path}/i")


def got(found):
    return Counter(map(tuple, found.select("item_id", "rank", "doc_id", "score").collect()))


@pytest.mark.parametrize("small", [False, True])
def test_search_is_the_plain_ranking(spark, tmp_path, monkeypatch, small):
    if small:  # several blocks of items, blocks of documents cut, texts joined by a shuffle
        for name, value in (("ITEMS", 7), ("BLOCK_ROWS", 10), ("BLOCK_BITS", 1 << 14), ("BROADCAST_ROWS", 0), ("BATCH_ROWS", 30), ("HELD_TERMS", 50)):
            monkeypatch.setattr(lexical, name, value)
    docs, items = awkward(np.random.default_rng(3))
    d, i = tables(spark, tmp_path, docs, items)
    assert got(lexical.search(d, i, k=8)) == plain_search(docs, items, 8)


def test_search_of_empty_tables(spark, tmp_path):
    docs, items = [(1, "a b"), (2, None)], [(1, "a"), (2, None)]
    d, i = tables(spark, tmp_path, docs, items)
    assert got(lexical.search(d, i)) == plain_search(docs, items, 20) and len(plain_search(docs, items, 20)) == 1
    for empty in (lexical.search(d.limit(0), i), lexical.search(d, i.limit(0)), lexical.search(d.where("doc_id = 2"), i)):
        assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_are_never_below_the_score(spark, tmp_path):
    """Of every document, also where narrow signatures confirm many absent terms."""
    docs, items = awkward(np.random.default_rng(5))
    d, i = tables(spark, tmp_path, docs, items)
    made = lexical.index(d)
    assert made.documents == sum(bool(plain_terms(t)) for _, t in docs) and made.length == sum(len(plain_terms(t)) for _, t in docs)
    ask = lexical.asked(made, [(n, (t or "").encode()) for n, (_, t) in enumerate(items)])
    texts = {r["__row"]: plain_terms(r.t) for r in lexical.numbered(d.select(lexical.whole_text("text").alias("t"))).collect()}
    met = []
    for block in made.blocks.collect():
        rows, lengths = np.frombuffer(block["__rows"], np.int64), np.frombuffer(block.lengths, np.int64)
        bounds = ask.bounds(block.width, lengths, np.frombuffer(block.slices, np.uint8))
        for j, row in enumerate(rows.tolist()):
            c = Counter(texts[row])
            assert lengths[j] == c.total()
            tf = lexical.share(np.array([c[t.decode()] for t in ask.terms]), ask.relative_length(int(lengths[j])))
            exact = ask.weights @ tf
            assert (bounds[:, j] >= exact).all()
            met.append((bounds[:, j] > 2 * exact + 1).mean())
        assert block.slices is not None
    assert len(met) == made.documents and np.mean(met) < 0.2
