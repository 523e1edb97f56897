"""Phrase collocations against a plain count of every phrase."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from couponlens.llm import collocations

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_collocations(rows, least, longest, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for i in range(len(words)):
                f[lang].update(tuple(words[i:i + k]) for k in range(1, min(longest, len(words) - i) + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        hidden = {q for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1)
                  if len(q := p[i:j]) < len(p) and 100 * a >= 100 * candidates[q]}
        scored = []
        for p in candidates.keys() - hidden:
            a = candidates[p]
            score, _, left, right = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), left, right))
        out |= {(lang, rank, phrase.decode(), -a, left, right, n[lang], -score) for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1)}
    return out


def awkward():
    rng = np.random.default_rng(8)
    words = ["the", "The", "of", "und", "ä", "日本", "a\x01b", "a", "\x00", "x-y", "naïve", "z"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "!?", "\x0b", " ", " "]
    rows = [("".join(w + e for w, e in zip(rng.choice(words, n), rng.choice(ends, n))), ["en", "de", None, "und", "x\ny"][i % 5]) for i, n in enumerate(rng.integers(0, 60, 300))]
    rows += [(None, "en"), ("", None), ("...", "en"), ("Hot Phrase of copied text", "en")]
    rows += [("one copied passage of the text that goes on", "en")] * 300 + [("spam " * 20_000, "en"), ("spam spam", "nl"), ("w " * 5 + "v", "de")]
    return rows


def table(spark, path, rows):
    spark.createDataFrame([(*r, i, "x", 1) for i, r in enumerate(rows)], "text string, lang string, doc_id long, phrase string, n int").repartition(5).write.parquet(path)
    return spark.read.parquet(path)


def got(found):
    rows = [tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("longest, group, held", [(5, 500_000, 1 << 23), (5, 5, 50), (2, 5, 50), (4, 40, 2000)])
def test_collocations_are_the_plain_ones(spark, tmp_path, monkeypatch, longest, group, held):
    """Also where prefixes are extended to the last word and texts are cut between pieces."""
    monkeypatch.setattr(collocations, "HELD_BYTES", held)
    rows = awkward()
    docs = table(spark, str(tmp_path / "d"), rows)
    wanted = plain_collocations(rows, 6, longest, 30)
    assert got(collocations.collocations(docs, least=6, longest=longest, top=30, group=group)) == wanted and len(wanted) > 60


def test_full_bitmaps_change_nothing(spark, tmp_path, monkeypatch):
    """With bitmaps of a few bits nearly all words and pairs seem frequent."""
    monkeypatch.setattr(collocations, "WORD_BITS", 16)
    monkeypatch.setattr(collocations, "PAIR_BITS", 16)
    monkeypatch.setattr(collocations, "bit_of", lambda key, bits: 5)
    monkeypatch.setattr(collocations, "_bitmap", lambda keys, bits: np.full(1 << (bits - 3), 255, np.uint8))
    rows = awkward()
    assert got(collocations.collocations(table(spark, str(tmp_path / "d"), rows), least=6)) == plain_collocations(rows, 6, 5, 2000)


def test_no_groups_hold_more_than_their_budget(spark, tmp_path):
    rows = [("spam " * 500, "en")] + [(f"to be or not to be {i % 50} {i % 7}", "en") for i in range(2000)]
    suffixes = Counter()
    for text, _ in rows:
        w = text.split()
        suffixes.update(tuple(w[i:i + 5]) for i in range(len(w) - 1))
    table_of = lambda c: spark.createDataFrame([("en", "".join(x + "\n" for x in p), n) for p, n in c.items()], "lang string, phrase string, n long")
    pairs = Counter()
    for p, n in suffixes.items():
        pairs[p[:2]] += n
    grouped, heavy = collocations.prefix_groups(table_of(suffixes), table_of(pairs), 5, 400)
    assert {p for _, p in heavy} == {''.join(w + '\n' for w in p) for p in [('spam',) * 2, ('spam',) * 3, ('spam',) * 4, ('to', 'be'), ('be', 'or'), ('or', 'not'), ('not', 'to'), ('to', 'be', 'or'), ('be', 'or', 'not'), ('or', 'not', 'to'), ('not', 'to', 'be'), ('to', 'be', 'or', 'not'), ('be', 'or', 'not', 'to'), ('or', 'not', 'to', 'be')]}
    assert grouped.agg({"n": "sum"}).first()[0] == sum(suffixes.values())
    # What a group takes of one prefix fits the budget; only equal suffixes, one row each, may pass it.
    rows_of = Counter(r.g for r in grouped.groupBy("g", "phrase").count().collect())
    assert max(rows_of.values()) <= 400


def test_collocations_of_empty_tables(spark, tmp_path):
    docs = table(spark, str(tmp_path / "d"), [(None, None), ("", "en"), ("a b", "en")])
    for some in (docs, docs.limit(0)):
        found = collocations.collocations(some)
        assert found.count() == 0 and found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_rare_triples_of_frequent_pairs_begin_no_suffixes(spark, tmp_path, monkeypatch):
    """Suffix rows follow from frequent phrases, not from all that frequent pairs can be put together to."""
    made = {}

    def stored(df, name, keep=collocations.stored):
        made[name] = keep(df, name)
        return made[name]

    monkeypatch.setattr(collocations, "stored", stored)
    rng = np.random.default_rng(3)
    rows = [(" ".join(rng.choice([f"w{i}" for i in range(15)], 100)), "en") for _ in range(80)] + [("a passage of six words here", "en")] * 25
    found = got(collocations.collocations(table(spark, str(tmp_path / "d"), rows), least=20))
    assert found == plain_collocations(rows, 20, 5, 2000) and len(found) > 200
    suffixes = {r.phrase for r in made["suffixes"].collect()}
    assert suffixes == {"a\npassage\nof\nsix\nwords\n", "passage\nof\nsix\nwords\nhere\n", "of\nsix\nwords\nhere\n"}


def test_words_have_one_hash_in_spark_and_in_tasks(spark, monkeypatch):
    words = ["the", "ä", "日本", "a\x01b", "\x00", "x" * 100, ""]
    table_of = spark.createDataFrame([("x\ny", w + "\n", i) for i, w in enumerate(words)], "lang string, phrase string, n long")
    hashes = [r.h for r in table_of.orderBy("n").select(collocations._hash("0\n").alias("h")).collect()]
    assert hashes == collocations._word_hashes("0\n", "x\ny", [w.encode() for w in words]).view(np.int64).tolist()
    assert collocations._salt(table_of, 3) == "0\n"
    # Words 1 and 5 have the same hash at first, which matters if either is frequent.
    first = F.when(F.col("n") == 5, F.lit(1)).otherwise(F.col("n")).cast("long")
    monkeypatch.setattr(collocations, "_hash", lambda salt, keep=collocations._hash: first if salt == "0\n" else keep(salt))
    assert [collocations._salt(table_of, least) for least in (5, 6)] == ["1\n", "0\n"]


def test_triples_of_very_many_words(monkeypatch):
    """The same counts where three numbers of words do not fit into one code."""
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["the", "of", "rare", "a", "z"], 200)) + ", end of" for _ in range(3)]
    known = np.sort(collocations._word_hashes("", "en", [b"the", b"of", b"a", b"z"]))
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 3), pa.array([t.encode() for t in texts])], ["lang", "t"])
    count = lambda: {(r["pair"], r["third"]): r["n"] for b in collocations._count_triples(known, "", 5)(iter([batch])) for r in b.to_pylist()}
    plain = count()
    ids = dict(zip(["the", "of", "a", "z"], collocations._ids(known, np.append(known[:1], collocations._word_hashes("", "en", [b"the", b"of", b"a", b"z"])))[1:].tolist()))
    wanted = Counter()
    for text in texts:
        for piece in text.split(","):
            w = [ids.get(x, 0) for x in piece.split()] + [0]
            wanted.update(((w[i] << 32 | w[i + 1], w[i + 2]) for i in range(len(w) - 2) if w[i] and w[i + 1]))
    assert plain == wanted
    monkeypatch.setattr(collocations, "CODE_WORDS", 2)
    assert count() == plain
