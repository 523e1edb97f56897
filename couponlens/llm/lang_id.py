"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a fixed public byte-level vocabulary. Each language
has a probability for every piece; a word (a space and a lower-cased run of
letters) has the probability that a forward pass sums over all its
segmentations into pieces, and a text that of its words. A word of any length
is summed whole: the pass goes through it in stretches, carrying the
probabilities of its last beginnings, rescaled, from one to the next. The piece
probabilities are learned by EM over all labelled texts: Spark counts the
words of every language, and each round a forward-backward pass over those
counts gives the expected use of every piece, which Spark sums.

Only the learned table, (languages x pieces) numbers, reaches the driver; its
size is fixed by the vocabulary and ``MOST_LANGUAGES``.
"""

from __future__ import annotations

import base64
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import spare_name, stored

VOCABULARY = "byte_bpe_50k.tiktoken"
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
SPACE = re.compile(r"\s")
#: Languages that a model may have; learning from more labels is refused.
MOST_LANGUAGES = 256
#: Bytes after which the probabilities of a word's beginnings are rescaled.
RESCALED = 16
#: Beginnings of a word that are held at once; a multiple of ``RESCALED``.
STRETCH = 4096
#: Bytes of words, and their probabilities, that are gone through at once.
BYTES, CELLS = 1 << 19, 5 << 19
#: Words whose scores a task keeps; beyond it the memory starts anew, results stay the same.
KEPT_WORDS = 200_000
#: Documents after which a task looks at how many words it keeps.
DOCUMENTS = 2000
#: Words of a language, or bytes of them, that a task gathers before it goes through them at once.
HELD_WORDS, HELD_BYTES = 100_000, 1 << 24
#: Characters of a text that are split into words at once, up to the next white space.
SLICE = 1 << 20
#: Share of the probability that every piece has alike.
SMOOTHING = 0.01
EM_ROUNDS = 2


def words(text: str) -> Iterator[list[str]]:
    """The lower-cased letter runs of a text, a slice of it at a time."""
    at = 0
    while at < len(text):
        space = SPACE.search(text, at + SLICE)
        end = space.start() if space else len(text)
        yield LETTERS.findall(text[at:end].lower())
        at = end


def in_bytes(word: str) -> bytes:
    return b" " + word.encode("utf-8", "replace")


class Pieces:
    """The vocabulary, looked up by hashes of byte strings."""

    STEP = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, path: str | None = None):
        with open(path or public_tokenizers.path(VOCABULARY), "rb") as lines:
            pieces = [base64.b64decode(x.split()[0]) for x in lines if x.strip()]
        hashes = np.array([self.hash_of(p) for p in pieces], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.count, self.longest = hashes[order], len(pieces), max(map(len, pieces))
        # Every beginning of a piece, and the piece that it is itself, if any (else -1).
        begun = {self.hash_of(p[:n]): -1 for p in pieces for n in range(1, len(p))}
        begun |= {int(h): i for i, h in enumerate(self.hashes)}
        self.begun = np.array(sorted(begun), np.uint64)
        self.ended = np.array([begun[int(h)] for h in self.begun], np.int64)

    @classmethod
    def hash_of(cls, piece: bytes) -> int:
        h = 1
        for byte in piece:
            h = (h * int(cls.STEP) + byte + 1) % (1 << 64)
        return h

    def spans(self, data: np.ndarray, starts: int) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(length, rows, pieces, edges) of the pieces in ``data`` (a string a row) that start in its first columns.

        ``rows[edges[s]:edges[s + 1]]`` have a piece of that length at column
        ``s``. A row drops out of a start as soon as no piece goes on like it.
        """
        out, flat, n = [], np.ascontiguousarray(data.T).ravel(), len(data)
        at, h = np.arange(min(starts, data.shape[1]) * n), np.uint64(1)
        for length in range(1, self.longest + 1):
            ahead = (length - 1) * n
            fit = np.searchsorted(at, flat.size - ahead)
            at, h = at[:fit], h if length == 1 else h[:fit]
            h = h * self.STEP + flat[at + ahead] + np.uint64(1)
            place = np.minimum(np.searchsorted(self.begun, h), len(self.begun) - 1)
            known = self.begun[place] == h
            at, h, ids = at[known], h[known], self.ended[place[known]]
            if not len(at):
                break
            whole = ids >= 0
            found = at[whole]
            out.append((length, found % n, ids[whole], np.searchsorted(found, np.arange(starts + 1) * n)))
        return out


def by_length(strings: list[bytes], languages: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions, lengths, byte matrix) of strings of like lengths, ascending; shorter ones are filled up with spaces.

    What stands after a string's end takes no part in its probability.
    """
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    # Up to 32 bytes each length is by itself, from there on each eighth of a power of two.
    eighth = 1 << np.maximum(np.log2(np.maximum(lengths, 1)).astype(np.int64) - 3, 0)
    band = np.where(lengths <= 32, lengths, -(-lengths // eighth) * eighth)
    order = np.lexsort((lengths, band))
    for same in np.split(order, np.flatnonzero(np.diff(band[order])) + 1):
        width = int(lengths[same[-1]])
        columns = min(width, STRETCH)
        rows = max(1, min(20_000, BYTES // width, CELLS // (columns * languages)))
        for some in (same[i:i + rows] for i in range(0, len(same), rows)):
            data = b"".join(strings[i].ljust(width) for i in some)
            yield some, lengths[some], np.frombuffer(data, np.uint8).reshape(-1, width)


class Lattice:
    """Segmentations of a few strings, gone through a stretch of beginnings at a time.

    Probabilities are scaled by string and language; a log scale holds what
    was divided out.
    """

    def __init__(self, data: np.ndarray, lengths: np.ndarray, pieces: Pieces, by_piece: np.ndarray):
        self.data, self.lengths, self.pieces, self.by_piece = data, lengths, pieces, by_piece
        self.reach = min(pieces.longest, data.shape[1])

    def stretches(self) -> list[int]:
        return list(range(0, self.data.shape[1] + 1, STRETCH))

    def ends(self, first: int, size: int) -> np.ndarray:
        """Edges, by beginning of the stretch, of the strings (ascending in length) that end there."""
        return np.searchsorted(self.lengths, np.arange(first, first + size + 1))

    def spans(self, first: int) -> tuple[int, list]:
        size = min(STRETCH, self.data.shape[1] + 1 - first)
        return size, self.pieces.spans(self.data[:, first:first + size + self.reach].astype(np.uint64), size)

    def alphas(self, size: int, spans: list, carried: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Probabilities of a stretch's beginnings and what follows, and the log scale of each ``RESCALED`` of them."""
        alpha = np.zeros((size + self.reach, *carried.shape[1:]))
        alpha[:self.reach] = carried
        scales = []
        for start in range(size):
            if start % RESCALED == 0:
                if start:
                    scale = scale + rescale(alpha[start:start + self.reach])
                scales.append(scale)
            for length, rows, ids, edges in spans:
                a, b = edges[start], edges[start + 1]
                if a < b:
                    some = rows[a:b]
                    alpha[start + length][some] += alpha[start][some] * self.by_piece[ids[a:b]]
        return alpha, scales

    def start(self) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(self.data), self.by_piece.shape[1])
        carried = np.zeros((self.reach, *shape))
        carried[0] = 1
        return carried, np.zeros(shape)

    def forward(self, keep: bool = False) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(strings, languages) log probabilities, and, if kept, what each stretch was begun with."""
        out, begun = np.zeros((len(self.data), self.by_piece.shape[1])), []
        carried, scale = self.start()
        for first in self.stretches():
            if keep:
                begun.append((carried, scale))
            size, spans = self.spans(first)
            alpha, scales = self.alphas(size, spans, carried, scale)
            edges = self.ends(first, size)
            for at in np.flatnonzero(np.diff(edges)):
                ended = slice(edges[at], edges[at + 1])
                out[ended] = np.log(alpha[at, ended]) + scales[at // RESCALED][ended]
            carried = alpha[size:].copy()
            scale = scales[-1] + rescale(carried)
        return out, begun

    def uses(self, counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece in ``counts`` copies of the strings; one language.

        The probabilities of what follows a beginning are kept as logarithms:
        over a long piece they may differ by more than a double holds.
        """
        uses = np.zeros(self.pieces.count)
        total, begun = self.forward(keep=True)
        n = len(self.data)
        with np.errstate(divide="ignore"):
            log_p = np.log(self.by_piece[:, 0])
        carried = np.full((self.reach, n), -np.inf)
        for first in reversed(self.stretches()):
            size, spans = self.spans(first)
            alpha, scales = self.alphas(size, spans, *begun.pop())
            with np.errstate(divide="ignore"):
                alpha = np.log(alpha[:size, :, 0])
            beta = np.concatenate([np.full((size, n), -np.inf), carried])
            edges = self.ends(first, size)
            for at in np.flatnonzero(np.diff(edges)):
                beta[at, edges[at]:edges[at + 1]] = 0
            logs = [log_p[ids] for _, _, ids, _ in spans]
            for start in reversed(range(size)):
                on = []
                for (length, rows, _, edges), log in zip(spans, logs):
                    a, b = edges[start], edges[start + 1]
                    if a < b:
                        some = rows[a:b]
                        log[a:b] += beta[start + length][some]
                        on.append((some, log[a:b]))
                largest = beta[start].copy()  # of a string that ends here 0, else nothing yet
                for some, log in on:
                    largest[some] = np.maximum(largest[some], log)
                base = np.where(largest == -np.inf, 0, largest)
                inside = np.exp(beta[start] - base)
                before = alpha[start] + scales[start // RESCALED][:, 0] - total[:, 0] + base
                for some, log in on:
                    log -= base[some]
                    inside[some] += np.exp(log)
                    log += before[some]
                with np.errstate(divide="ignore"):
                    beta[start] = base + np.log(inside)
            for (_, rows, ids, _), log in zip(spans, logs):
                uses += np.bincount(ids, np.exp(log) * counts[rows], minlength=self.pieces.count)
            carried = beta[:self.reach]
        return uses


def rescale(window: np.ndarray) -> np.ndarray:
    """Divides the window by its largest values, in place; their logarithms (0 where all is zero)."""
    largest = window.max(axis=0)
    largest[largest == 0] = 1
    window /= largest
    return np.log(largest)


@dataclass
class Model:
    """Piece probabilities by language: ``p`` is (languages, pieces + 1), the last column zero."""

    languages: list[str]
    p: np.ndarray
    pieces: Pieces


def log_probabilities(strings: list[str], pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """(words, languages) log probabilities; a string without a letter scores nothing."""
    out, by_piece = np.zeros((len(strings), len(p))), np.ascontiguousarray(p.T)
    for at, lengths, data in by_length([in_bytes(x) for x in strings], len(p)):
        out[at] = Lattice(data, lengths, pieces, by_piece).forward()[0]
    return out


def expected_uses(strings: list[bytes], counts: np.ndarray, pieces: Pieces, p: np.ndarray) -> np.ndarray:
    """Expected number of uses of each piece in ``counts`` copies of the strings (one language; p: (1, pieces + 1))."""
    uses, by_piece = np.zeros(pieces.count), np.ascontiguousarray(p.T)
    for at, lengths, data in by_length(strings, 1):
        uses += Lattice(data, lengths, pieces, by_piece).uses(counts[at])
    return uses


def word_counts(labelled: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """(lang, word, n) over all labelled texts; stored."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def rows() -> pa.RecordBatch:
            columns = [pa.array([lang for lang, c in held.items() for _ in c], pa.string()),
                       pa.array([w for c in held.values() for w in c], pa.string()),
                       pa.array([n for c in held.values() for n in c.values()], pa.int64())]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(at, DOCUMENTS)
                for lang, text in zip(part.column(0), part.column(1)):
                    for some in words(text.as_py()):
                        held[lang.as_py()].update(some)
                if sum(map(len, held.values())) > KEPT_WORDS:
                    yield rows()
        if held:
            yield rows()

    lines = labelled.select(F.col(lang_col).cast("string"), F.col(text_col).cast("string")).dropna()
    return stored(lines.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", path: str | None = None,
          rounds: int = EM_ROUNDS) -> Model:
    """Piece probabilities of every language with a labelled letter; rows with null text or label teach nothing.

    More than ``MOST_LANGUAGES`` labels with a letter are an error.
    """
    pieces = Pieces(path)
    counts = word_counts(labelled, text_col, lang_col)
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages in column {lang_col}")
    model = Model(languages, np.full((len(languages), pieces.count + 1), 1 / pieces.count), pieces)
    model.p[:, -1] = 0
    for _ in range(rounds if languages else 0):
        learned = model.p

        def uses(batches: Iterator[pa.RecordBatch], p: np.ndarray = learned) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(languages), pieces.count))
            held: dict[str, tuple[list, list]] = {lang: ([], []) for lang in languages}
            size: Counter = Counter()

            def add(words: int, size_of: int) -> None:
                for i, lang in enumerate(languages):
                    strings, weights = held[lang]
                    if len(strings) > words or size[lang] > size_of:
                        total[i] += expected_uses(strings, np.array(weights, float), pieces, p[i:i + 1])
                        held[lang], size[lang] = ([], []), 0

            for batch in batches:
                for lang, word, n in zip(*(column.to_pylist() for column in batch.columns)):
                    data = in_bytes(word)
                    held[lang][0].append(data)
                    held[lang][1].append(n)
                    size[lang] += len(data)
                add(HELD_WORDS, HELD_BYTES)
            add(0, 0)
            lang, piece = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(piece), pa.array(total[lang, piece])], ["lang", "piece", "uses"])

        summed = counts.mapInArrow(uses, "lang long, piece long, uses double").groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).toPandas()
        table = np.zeros((len(languages), pieces.count))
        table[summed["lang"], summed["piece"]] = summed["uses"].round(3)  # the sum's order may vary in the last digits
        model.p = np.zeros_like(model.p)
        model.p[:, :-1] = (1 - SMOOTHING) * table / np.maximum(table.sum(axis=1, keepdims=True), 1e-9) + SMOOTHING / pieces.count
    return model


def predictor(model: Model):
    """pandas UDF text -> struct(lang_pred, score)."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known: dict[str, int] = {}
        scores = np.zeros((1 << 16, len(model.languages)))

        def answer(texts: pd.Series) -> list[tuple[str, float]]:
            nonlocal scores
            if len(known) > KEPT_WORDS:
                known.clear()
            new: dict[str, int] = {}
            found: list[list[np.ndarray]] = []
            for text in texts:
                found.append([])
                for some in words(text) if isinstance(text, str) else ():
                    for word in some:
                        if word not in known:
                            known[word] = new[word] = len(known)
                    found[-1].append(np.fromiter(map(known.__getitem__, some), np.int32, len(some)))
            if new and model.languages:
                while len(scores) < len(known):
                    scores = np.concatenate([scores, np.zeros_like(scores)])
                at, strings = list(new.values()), list(new)
                scores[at] = log_probabilities(strings, model.pieces, model.p)
            answers = []
            for text, ids in zip(texts, found):
                letters = any(map(len, ids)) and any(c.isalpha() for c in text)
                if not letters or not model.languages:
                    answers.append((UNKNOWN, 0.0))
                    continue
                total = sum(scores[some].sum(axis=0) for some in ids)
                best = int(total.argmax())
                answers.append((model.languages[best], float(1 / np.exp(total - total[best]).sum())))
            return answers

        for texts in batches:
            answers = [x for at in range(0, len(texts), DOCUMENTS) for x in answer(texts.iloc[at:at + DOCUMENTS])]
            yield pd.DataFrame(answers, columns=["lang_pred", "score"])

    return predict


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def learn_from_documents(docs: DataFrame, path: str | None = None) -> Model:
    return learn(docs.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2).select("text", "lang"), path=path)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred and score (posterior of the prediction, equal priors) of every row.

    ``und`` with score 0 where the text is null or has no letter, or where
    nothing was learned. A very long text is read whole, a very long word
    summed whole, in memory of a few times its size. Equal scores go to the first language by code
    point. Repeated rows are answered alike; other columns are not read.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), predictor(model)(F.col(text_col).cast("string")).alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def drop_unidentified(docs: DataFrame, model: Model, least_score: float = 0.0) -> DataFrame:
    """The rows whose language is told with at least ``least_score``; all columns as they were.

    By default all but the ``und`` ones stay: a clean document of a word or
    two may well score low.
    """
    name = spare_name(docs, "__lang")
    told = docs.withColumn(name, predictor(model)(F.col("text").cast("string")))
    return told.where((F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least_score)).drop(name)
