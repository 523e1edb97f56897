"""URL filter, chat formatting, nearest neighbours, the registered queries and the pipeline."""

import datetime as dt
import hashlib
import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as E
import corpus_pipeline
from check_oracle import compare
from conftest import SMALL
from couponlens.llm import ann, chat, queries, url_filter
from test_documents_ops import plain_fingerprint

DAY = dt.datetime(2024, 3, 1)


def at(days):
    return DAY + dt.timedelta(days=days)


URLS = ["https://A.B.Example.com./x/y?q=1", "http://user:pw@b.example.com:8080/x/", "ftp://example.com", "https://other.org/x//y#z", "not a url", "", None,
        "https://example.com/X/y", "//example.com/x", "https://xexample.com/x", "https://[::1]/x"]
ENTRIES = [("bad", "example.com", "add", at(1)), ("bad", "example.com", "remove", at(40)), ("bad", "example.com", "add", at(70)),
           ("bad", "example.com", "add", at(70)), ("sec", "b.example.com/x", "add", at(-400)), ("sec", "other.org/x/y", "add", at(2)),
           ("sec", "other.org/x/y", "remove", at(2)), ("sec", None, "add", at(0)), ("bad", "other.org", "add", None), ("late", "other.org", "add", at(30)),
           ("late", "other.org", "remove", at(31)), ("odd", "other.org", "watch", at(0))]


def plain_keys(url):
    import re
    url = (url or "").strip(" ")
    m = re.match(r"(?i)[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", url)
    host = m[1].lower().rstrip(".") if m else ""
    if not host:
        return set()
    labels = host.split(".")
    path = re.match(r"(?i)[a-z][a-z0-9+.\-]*://[^/?#]*(/[^?#]*)", url)
    steps = [s for s in (path[1].split("/") if path else []) if s]
    return {".".join(labels[i:]) for i in range(len(labels))} | {f"{host}/{'/'.join(steps[:i])}" for i in range(1, len(steps) + 1)}


def test_url_filter(spark, tmp_path):
    rows = [(i, u, at(d), "host", "key") for (i, u), d in itertools.product(enumerate(URLS), (0, 1, 2, 30, 30.5, 31, 39.9, 40, 69, 70, 400))]
    rows += [rows[0], rows[0], (None, URLS[0], at(3), "h", "k"), (5, URLS[0], None, "h", "k")]
    path = str(tmp_path / "c.parquet")
    spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp, blocked string, key string").write.parquet(path)
    entries = spark.createDataFrame(ENTRIES, "list string, key string, action string, dated timestamp")
    got = Counter((r.page_id, r.url, r.fetched_at, r.blocked, r.matched_list, r.matched_key, r.listed_since, r.matches)
                  for r in url_filter.filter_captures(spark.read.parquet(path), entries).collect())
    wanted = Counter()
    for page, url, when, _, _ in rows:
        hits = []
        for name, key in {(n, k) for n, k, _, _ in ENTRIES}:
            log = sorted({(d, a) for n, k, a, d in ENTRIES if (n, k) == (name, key) and d and k and a in ("add", "remove") and when and d <= when})
            if log and log[-1][1] == "add" and key in plain_keys(url):
                hits.append((-len(key), key, name, log[-1][0]))
        best = min(hits, default=(0, None, None, None))
        wanted[page, url, when, bool(hits), best[2], best[1], best[3], len(hits)] += 1
    assert got == wanted


def test_url_filter_without_entries_or_captures(spark, tmp_path):
    none = spark.createDataFrame([], "list string, key string, action string, dated timestamp")
    for name, rows in (("a", [(1, URLS[0], at(0))]), ("b", [])):
        spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp").write.parquet(str(tmp_path / name))
        captures = spark.read.parquet(str(tmp_path / name))
        assert [r.blocked for r in url_filter.filter_captures(captures, none).collect()] == [False] * len(rows)
        some = spark.createDataFrame(ENTRIES, none.schema)
        assert url_filter.filter_captures(captures, some).count() == len(rows)


def test_url_filter_of_very_long_urls(spark, tmp_path):
    """URLs of a megabyte with 500,000 slashes, steps or labels take seconds; keys at and beyond the longest listed one."""
    import time
    long = ["https://b.example.com/x" + "/" * 500_000 + "y", "https://b.example.com/" + "x/" * 500_000, "https://" + "a." * 400_000 + "example.com/x",
            "https://b.example.com/" + "z" * 1_000_000, "https://b.example.com/x/yy", "https://b.example.com/x/y/", "https://b.example.com/x/y", "https://bb.example.com",
            "https://" + "a" * 500_000 + "." + "b" * 500_000, "x" * 1_000_000]
    entries = [("l", "b.example.com/x", "add", at(0)), ("l", "b.example.com/x/y", "add", at(0)), ("d", "example.com", "add", at(0)), ("d", "b.example.com", "add", at(0))]
    rows = [(i, u, at(1)) for i, u in enumerate(long)]
    spark.createDataFrame(rows, "page_id long, url string, fetched_at timestamp").repartition(2).write.parquet(str(tmp_path / "c"))
    begun = time.monotonic()
    listed = spark.createDataFrame(entries, "list string, key string, action string, dated timestamp")
    got = {r.page_id: (r.matched_key, r.matches) for r in url_filter.filter_captures(spark.read.parquet(str(tmp_path / "c")), listed).collect()}
    assert time.monotonic() - begun < 60
    assert got == {0: ("b.example.com/x/y", 4), 1: ("b.example.com/x", 3), 2: ("example.com", 1), 3: ("b.example.com", 2), 4: ("b.example.com/x", 3),
                   5: ("b.example.com/x/y", 4), 6: ("b.example.com/x/y", 4), 7: ("example.com", 1), 8: (None, 0), 9: (None, 0)}


TEXTS = ["hello", "", None, "\\### Assistant: </turn> ok", "<turn>### a: b</turn>\n", "a\\l\\\\h\n", "x" * 5000, "é\u0000\U0001f600"]


def plain_digest(rows):
    turns = [(r or "", t or "") for _, r, t in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_chat_round_trip(spark, tmp_path):
    rows = [(c, t, ["user", "assistant", "system: <#\\x"][(c + t) % 3], TEXTS[(c * 3 + t) % len(TEXTS)]) for c in range(8) for t in range(7)]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, None, "user", "first"), (4, 2, None, "no role"), (5, 0, "user", "z"),
             rows[0], rows[0], (9, -5, "assistant", TEXTS[3])] + [(77, t, "assistant", f"hot {t}") for t in range(3000)]
    path = str(tmp_path / "c.parquet")
    spark.createDataFrame([(*r, "s", 1) for r in rows], "conv_id long, turn long, role string, text string, segment string, seq int").write.parquet(path)
    table = spark.read.parquet(path)
    segments = chat.format_conversations(table)
    by_conv = defaultdict(list)
    for c, t, r, x in rows:
        by_conv[c].append((t, r, x))
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    assert set(got) == set(by_conv)
    lengths = Counter()
    for s in segments.collect():
        lengths[s.conv_id] += len(s.segment)
        if s.loss_start is not None:
            assert s.role == "assistant" and s.segment.startswith("<turn>### assistant: ")
        body = s.segment[len("<turn>### "):-len("</turn>\n")]
        assert "<" not in body and "#" not in body
    for c, turns in by_conv.items():
        r = got[c]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == plain_digest(turns) and r.formatted_chars == lengths[c]
    assert chat.read_back(chat.format_conversations(table.limit(0))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_escapes_are_undone(text):
    written = text
    for c in "\\<#:":
        written = written.replace(c, chat.ESCAPES[c])
    assert chat.unescape(written) == text and not set("<#:") & set(written)


EVENTS = st.lists(st.tuples(st.sampled_from(["open", "delta", "edit", "regenerate", "ping", None]), st.sampled_from(["a", "bc", "", None])), max_size=8)


@settings(max_examples=8, deadline=None)
@given(st.lists(EVENTS, min_size=1, max_size=6))
def test_fold_is_the_fold_of_events_in_order(spark, logs):
    rows = [(1, i, i, n, op, "user" if op == "open" else None, text) for i, log in enumerate(logs) for n, (op, text) in enumerate(log)]
    rows += rows[:2]  # delivered twice
    got = {r.message: r.text for r in chat.fold(spark.createDataFrame(
        rows[::-1], "conv_id long, turn long, message long, seq long, op string, role string, text string").repartition(3)).collect()}
    for i, log in enumerate(logs):
        text = ""
        for op, part in log:
            text = {"open": part or "", "edit": part or "", "regenerate": "", "delta": text + (part or "")}.get(op, text)
        assert got.get(i) == (text if log else None)


def test_the_log_holds_what_the_fold_is_for(spark):
    """Drafts, edits and regenerations, out of order and twice; the fold of it is the messages."""
    texts = ["", "a", "Some text of a message, cut anywhere. " * 4, "<#\\:>" * 30, "\U0001f600é" * 50, "word " * 20_000]
    rows = [(c, t, "assistant" if t % 2 else "user", texts[(c + t) % len(texts)]) for c in range(20) for t in range(6)]
    log = chat.log_of(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(7)
    ops = Counter(r.op for r in log.select("op").collect())
    assert set(ops) == {"open", "delta", "edit", "regenerate"} and min(ops.values()) >= 20
    events = log.groupBy("message", "seq").count()
    assert 0.1 < events.where("count > 1").count() / events.count() < 0.3
    assert log.groupBy("message").count().agg({"count": "max"}).first()[0] < 200
    assert Counter((r.conv_id, r.turn, r.role, r.text) for r in chat.fold(log).collect()) == Counter(rows)


def test_fold_of_a_message_with_very_many_events(spark):
    """30,000 events of one message, each delivered twice, backwards, with edits and regenerations among them."""
    op = lambda n: "edit" if n % 9973 == 0 else "regenerate" if n % 7919 == 0 else "delta"
    log = [(1, 0, 5, n, op(n), "user" if n == 0 else None, f"{n} ") for n in range(30_000)]
    text = ""
    for *_, o, _, part in log:
        text = {"edit": part, "regenerate": "", "delta": text + part}[o]
    table = spark.createDataFrame(log[::-1] + log, "conv_id long, turn long, message long, seq long, op string, role string, text string").repartition(4)
    assert [(r.role, r.text) for r in chat.fold(table).collect()] == [("user", text)]


def test_hilbert_curve_visits_every_cell_and_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (5, 2), (2, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = ann.hilbert_keys(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def plain_nearest(rows, every, k, width):
    ok = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) == width
                 and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    m = np.array([v for _, v in ok], np.float32).astype(float)
    unit, out = m / np.linalg.norm(m, axis=1, keepdims=True), {}
    for i, u in zip((i for i, _ in ok), unit):
        if i % every == 0:
            out[i] = sorted((-round(float(s), 12), j) for (j, _), s in zip(ok, unit @ u) if j != i)[:k]
    return out


def test_nearest_neighbours_awkward(spark, tmp_path):
    rng = np.random.default_rng(4)
    m = rng.integers(-3, 4, (90, 8)).astype(float)
    rows = [(i, v.tolist()) for i, v in enumerate(m)] + [(1000 + i, m[3].tolist()) for i in range(60)]
    rows += [(200, None), (201, [0.0] * 8), (202, [None] + [1.0] * 7), (203, [float("nan")] + [1.0] * 7), (204, [float("inf")] + [1.0] * 7),
             (205, [1.0, 2.0]), (206, []), (None, m[0].tolist()), rows[5], rows[5]]
    path = str(tmp_path / "e.parquet")
    spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<float>, label int, cls string, v int").write.parquet(path)
    got = defaultdict(list)
    for r in ann.nearest(spark.read.parquet(path), every=5, k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-round(r.score, 12), r.vec_id))
        assert r.rank == len(got[r.query_id])
    assert got == plain_nearest(rows, 5, 5, 8)
    assert ann.nearest(spark.read.parquet(path).limit(0), every=5).count() == 0
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r.query_id, r.vec_id) for r in ann.nearest(two, every=2).collect()] == [(0, 1)]


def test_nearest_neighbours_of_any_magnitude(spark):
    """Squares of tiny components vanish and of huge ones run over; the cosine is that of the vectors all the same."""
    m = np.random.default_rng(12).normal(size=(60, 6))
    scale = np.array([1e-170, 1e-310, 1.0, 1e170, 1e307])[np.arange(60) % 5]
    rows = [(i, (v * s).tolist()) for i, (v, s) in enumerate(zip(m, scale))]
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    got = defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=5, k=5).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in range(0, 60, 5):
        near = sorted((-float(unit[q] @ unit[j]), j) for j in range(60) if j != q)[:5]
        assert [j for j, _ in got[q]] == [j for _, j in near] and np.allclose([s for _, s in got[q]], [-s for s, _ in near], atol=1e-9)


def test_many_nearest_neighbours(spark):
    """No cap beside k: 100 of 300 distinct vectors; and vectors of another length meet their own."""
    m = np.random.default_rng(13).normal(size=(300, 8)).tolist()
    other = np.random.default_rng(14).normal(size=(7, 3)).tolist()
    rows = list(enumerate(m)) + [(1000 + i, v) for i, v in enumerate(other)]
    got = defaultdict(list)
    for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=50, k=100).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-round(r.score, 12), r.vec_id))
    wide = lambda found: {q: [(round(s, 5), j) for s, j in x] for q, x in found.items()}
    wanted = plain_nearest(rows[:300], 50, 100, 8) | plain_nearest(rows[300:], 50, 100, 3)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in wanted.items()} and len(got[0]) == 100 and len(got[1000]) == 6
    assert all({j for _, j in wide(got)[q]} == {j for _, j in wide(wanted)[q]} for q in got)


def test_too_many_lengths_are_refused(spark):
    rows = [(i, [1.0] * (i + 1)) for i in range(ann.LENGTHS + 1)]
    with pytest.raises(ValueError):
        ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=5)


def test_nearest_neighbours_recall(spark):
    """Windows much smaller than the table: 20,000 vectors without structure, recall at least 0.9 of brute force."""
    rng = np.random.default_rng(9)
    m = rng.normal(size=(20_000, 64)).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    found = defaultdict(set)
    for r in ann.nearest(table, every=400).collect():
        found[r.query_id].add(r.vec_id)
    hits = [len(found[i] & set(np.argsort(-np.where(np.arange(len(m)) == i, -9, unit @ unit[i]))[:5])) for i in range(0, len(m), 400)]
    assert np.mean(hits) / 5 >= 0.9


def curve_stage_recall(m, asked, window, k=5):
    """Share of the k nearest of each asked vector that one of the curves shows it: in its window or a neighbouring one."""
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    near = np.array([np.argsort(((unit - unit[i]) ** 2).sum(axis=1) + 9 * (np.arange(len(m)) == i))[:k] for i in asked])
    met = np.zeros(near.shape, bool)
    for key in ann.curve_keys(unit):
        at = np.empty(len(m), int)
        at[np.argsort(np.ascontiguousarray(key).view(f"S{key.shape[1]}").ravel(), kind="stable")] = np.arange(len(m))
        met |= np.abs(at[near] // window - (at[asked] // window)[:, None]) <= 1
    return met.mean()


def test_windows_grow_with_the_table():
    """The window of the sizes tested so far finds too little in 200,000 vectors without structure; the derived one keeps 0.9."""
    m = np.random.default_rng(9).normal(size=(200_000, 64))
    assert ann.window_for(0) == ann.window_for(50_000) == 384 and ann.window_for(200_000) > 1000
    assert curve_stage_recall(m, np.arange(60), ann.window_for(len(m))) >= 0.9


@pytest.mark.parametrize("noise", [0.01, 0.0001])
def test_nearest_neighbours_in_a_group_of_near_equal_vectors(spark, noise):
    """6,000 distinct vectors about one point among 4,000 others: recall at least 0.9 inside the group."""
    rng = np.random.default_rng(6)
    m = np.concatenate([rng.normal(size=(4_000, 64)), rng.normal(size=64) + noise * rng.normal(size=(6_000, 64))]).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    found = defaultdict(set)
    for r in ann.nearest(table, every=200).collect():
        found[r.query_id].add(r.vec_id)
    m = m.astype(float)
    unit, asked = m / np.linalg.norm(m, axis=1, keepdims=True), range(4_000, 10_000, 200)
    hits = [len(found[i] & set(np.argsort(((unit - unit[i]) ** 2).sum(axis=1) + 9 * (np.arange(len(m)) == i))[:5])) for i in asked]
    assert np.mean(hits) / 5 >= 0.9


def test_window_larger_than_a_block(spark, monkeypatch):
    """Windows cut into blocks, and a block's scores into parts, show a query as much as whole ones."""
    m = np.random.default_rng(2).normal(size=(1500, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "LARGEST_BLOCK", 50)
    got = defaultdict(list)
    for r in ann.nearest(table, every=50, window=400).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-round(r.score, 12), r.vec_id))
    assert got == plain_nearest(list(enumerate(m.tolist())), 50, 5, 8)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_duckdb(spark, duck, name):
    ok, msg = compare(E.queries()[name](spark, SMALL), duck, queries.ORACLE[name])
    assert ok, msg


def test_every_operator_is_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


def smallest_of_components(ids, texts):
    """The smallest id of each group of texts that fingerprints at most 4 bits apart connect, by brute force."""
    prints = np.array([plain_fingerprint(t) for t in texts], np.uint64)
    label = np.arange(len(ids))  # ids are sorted
    while True:
        new = np.array([label[np.bitwise_count(prints ^ p) <= 4].min() for p in prints])
        if (new == label).all():
            return {ids[i] for i in set(label)}
        label = new


def test_pipeline_stages(spark):
    """Each stage on what its predecessor kept: clean documents stay, copies go, sources reach their shares, all is packed."""
    from couponlens.llm import mixing
    from couponlens.llm.common import stored
    first = docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), name)
        assert docs.columns == first.columns
        kept[name] = docs
    texts = {r.doc_id: r.text for r in first.collect()}
    told = {r.doc_id for r in kept["language_id"].collect()}
    assert told == {d for d, t in texts.items() if t and any(c.isalpha() for c in t)}
    groups = defaultdict(list)
    for d in told:
        groups[texts[d]].append(d)
    assert {r.doc_id for r in kept["exact_dedup"].collect()} == {max(g) for g in groups.values()}
    near = [r.doc_id for r in kept["simhash_near_dedup"].collect()]
    assert len(near) == len(set(near)) and set(near) <= {max(g) for g in groups.values()}
    ids = sorted(r.doc_id for r in kept["exact_dedup"].collect())
    assert set(near) == smallest_of_components(ids, [texts[d] for d in ids]) and len(near) < len(ids)
    plan = {r.doc_id: r for r in mixing.mix(kept["simhash_near_dedup"]).collect()}
    copies = Counter(r.doc_id for r in docs.collect())
    assert all(abs(copies[d] * r.size - r.taken) <= r.size / 2 for d, r in plan.items())
    pieces = defaultdict(int)
    for r in corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect():
        pieces[r.copy_id, r.doc_id, r.doc_tokens] += r.length
    assert all(total == n for (_, _, total), n in pieces.items()) and Counter(d for _, d, _ in pieces) == copies
    assert corpus_pipeline.run(spark, SMALL).count() >= len(pieces)
