"""Phrase collocations by vertically partitioned, depth-truncated suffix trees.

A language's text is a set of pieces (runs of words between punctuation).
Every word begins a suffix, cut at the end of its piece and at ``longest``
words. Spark counts the vertical prefixes of one, two and three words: first
the words, then, in one pass, the triples of frequent words, whose sums are
the pairs. What is longer is counted in subtrees: suffixes of four words and
more are partitioned by their first words; a prefix whose suffixes are more
than a group may hold is extended by a word, until it fits or is ``longest``
words long. Prefixes are dealt to groups, and each group, by itself, sorts its
suffixes and walks them once: that is its subtree, whose node totals are the
counts of the phrases.

A suffix is cut before its first triple that occurs less often than ``least``
times in all, since no phrase across it can be a candidate. Triples are
counted by the numbers of their words, each the place of the word's hash among
those of the frequent words (8 bytes a word, which tasks know; a hash that two
words share is looked for, and another taken). Suffixes are cut by bitmaps
of a fixed size, bit = hash; a clash there keeps a suffix longer than need
be, it never cuts one. Equal suffixes of a task are one row with a count,
and those of one text that is copied any number of times are few.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from couponlens.llm.common import stored, whole_text

#: Ends every word of a key; pieces end at it, so no word holds it.
END = "\n"
#: Bits of the bitmaps of frequent words and triples (two pairs each): 2 and 8 MB, whatever the corpus.
WORD_BITS, PAIR_BITS = 24, 26
#: Seed of Spark's xxhash64.
SEED = 42
#: Three numbers below it fit into 63 bits.
CODE_WORDS = 1 << 21
#: Bits of a part of a bitmap, as Spark makes it.
PART_BITS = 15
#: Bytes of text that a task goes through at once.
HELD_BYTES = 1 << 24
#: Suffixes of a group; more where the table would have over ``MOST_GROUPS`` of them.
GROUP, MOST_GROUPS = 500_000, 100_000
#: Parts a language's candidates are ranked in first.
RANK_PARTS = 64
#: Letters A-Z become small, ``. , ; : ! ?`` and line ends a full stop, the tabulator a space.
FOLD = bytes(46 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text with A-Z lower-cased; a full stop, which is no word, stands between pieces."""
    return text.translate(FOLD).replace(b".", b" . ").split()


def bit_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def _word_hashes(salt: str, lang: str, words: list[bytes]) -> np.ndarray:
    """Hashes of a language's words, as ``_hash`` has them."""
    head = f"{salt}{lang}\n".encode()
    return np.fromiter((xxhash.xxh64_intdigest(head + w + b"\n", SEED) for w in words), np.uint64, len(words))


def _hash(salt: str) -> Column:
    """Hash of a word (lang, phrase)."""
    return F.xxhash64(F.concat(F.lit(salt), "lang", F.lit("\n"), "phrase"))


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return mixed ^ (mixed >> np.uint64(32))


def _triple_hashes(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """A hash of each triple, mixed from those of its words."""
    return _mixed(_mixed(first, second), third)


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _slices(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between pieces (a piece is never cut)."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > HELD_BYTES:
            ends = [x for x in (text.find(c, at + HELD_BYTES) for c in (b".", b",", b"\n")) if x >= 0]
            end = min(ends, default=end - 1) + 1
        yield text[at:end]
        at = end


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(lang, words, numbers) of successive texts (lang, text): word numbers in text order, 0 between pieces."""
    held: dict[str, list[bytes]] = {}
    size = 0

    def done() -> Iterator[tuple[str, list[bytes], np.ndarray]]:
        for lang, texts in held.items():
            numbers = _Numbers({b".": 0})
            found = [np.fromiter(map(numbers.__getitem__, words_of(t)), np.int64) for t in texts]
            gap = np.zeros(1, np.int64)
            yield lang, list(numbers), np.concatenate([gap, *(x for f in found for x in (f, gap))])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            for part in _slices(text.as_py()):
                held.setdefault(lang.as_py(), []).append(part)
                size += len(part)
                if size > HELD_BYTES:
                    yield from done()
                    size = 0
    yield from done()


def _batch(lang: str, keys: list[bytes], counts: np.ndarray) -> pa.RecordBatch:
    text = pa.array(keys, pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), text, pa.array(counts, pa.int64())], ["lang", "phrase", "n"])


def _flags(bitmap: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    at = np.empty(len(hashes), np.int64)
    at[:] = bit_of(hashes, bits)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _frequent_words(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    good = _flags(bitmap, WORD_BITS, hashes)
    good[0] = False
    return good


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, words, numbers in _chunks(batches):
        counts = np.bincount(numbers, minlength=len(words))
        if len(words) > 1:
            yield _batch(lang, [w + b"\n" for w in words[1:]], counts[1:])


def _ids(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Numbers of words from 1, their places among the sorted hashes of the frequent ones; 0 for others and between pieces."""
    at = np.searchsorted(known, hashes)
    found = np.append(known, np.uint64(0))[at] == hashes
    found[0] = False
    return np.where(found & (at < len(known)), at + 1, 0)


def _count_triples(known: np.ndarray, salt: str, longest: int) -> Callable:
    """mapInArrow function over texts (lang, text): pairs of frequent words and their next words, and how often they occur.

    ``pair`` is the number of the first word x 2^32 + that of the second,
    ``third`` the number of the next word, 0 if that is not frequent or there is none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _chunks(batches):
            ids = _ids(known, _word_hashes(salt, lang, words))
            # The chunk's own numbers of frequent words are small: three of them make one code.
            good = np.flatnonzero(ids)
            size = len(good) + 1
            own = np.zeros(len(words), np.int64)
            own[good] = np.arange(1, size)
            ids = np.append(0, ids[good])
            text = np.append(own[numbers], 0)
            at = np.flatnonzero((text[:-2] > 0) & (text[1:-1] > 0))
            if not len(at):
                continue
            pair, third = text[at] * size + text[at + 1], text[at + 2] if longest > 2 else 0
            if size < CODE_WORDS:
                codes, n = np.unique(pair * size + third, return_counts=True)
                pair, third = np.divmod(codes, size)
            else:
                pairs, which = np.unique(pair, return_inverse=True)
                codes, n = np.unique(which * size + third, return_counts=True)
                which, third = np.divmod(codes, size)
                pair = pairs[which]
            pair = ids[pair // size] << 32 | ids[pair % size]
            yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(ids[third]), pa.array(n, pa.int64())], ["pair", "third", "n"])

    return run


def _suffixes(frequent: np.ndarray, triples: np.ndarray, salt: str, longest: int) -> Callable:
    """mapInArrow function over texts (lang, text): distinct suffixes of four words and more, and how often they occur."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, numbers in _chunks(batches):
            hashes = _word_hashes(salt, lang, words)
            good = _frequent_words(frequent, hashes)[numbers]
            at = np.flatnonzero(good[:-2] & good[1:-1] & good[2:])
            at = at[_flags(triples, PAIR_BITS, _triple_hashes(*(hashes[numbers[at + i]] for i in range(3))))]
            goes_on = np.zeros(len(numbers) + longest, bool)
            goes_on[at] = True
            at = at[goes_on[at + 1]]
            length = np.full(len(at), 4)
            for step in range(2, longest - 2):
                length += (length == step + 2) & goes_on[at + step]
            # Words of a suffix as numbers of the words that are in any, 0 beyond its end.
            padded = np.concatenate([numbers, np.zeros(longest, np.int64)])
            columns = [np.where(length > i, padded[at + i], 0) for i in range(longest)]
            order = np.lexsort(columns[::-1])
            columns = [c[order] for c in columns]
            first = np.ones(len(at), bool)
            first[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            begin = np.flatnonzero(first)
            ends = [w + b"\n" for w in words]
            ends[0] = b""
            rows = zip(*(c[begin].tolist() for c in columns))
            if len(begin):
                yield _batch(lang, [b"".join([ends[i] for i in row]) for row in rows], np.diff([*begin, len(at)]))

    return run


def _subtrees(least: int, heavy: set[tuple[str, str]]) -> Callable:
    """mapInArrow function over a group's suffixes (group, lang, phrase, n) in order: node totals (lang, phrase, n) of two words and more.

    Nodes of less than ``least`` are left out, but for the ``heavy`` prefixes,
    which other groups have parts of. Holds one path of the tree, whatever the group holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[str] = []
        totals: list[int] = []
        now, out = None, []

        def close(depth: int) -> None:
            """Nodes deeper than ``depth`` words are complete; their totals go to their parents."""
            while len(path) > depth:
                total = totals.pop()
                if len(path) > 1:
                    phrase = END.join(path) + END
                    if total >= least or (now[1], phrase) in heavy:
                        out.append((now[1], phrase, total))
                path.pop()
                if totals:
                    totals[-1] += total

        for batch in batches:
            for group, lang, phrase, n in zip(*(batch.column(i).to_pylist() for i in range(4))):
                words = phrase.split(END)[:-1]
                same = 0
                if now == (group, lang):
                    while same < min(len(words), len(path)) and words[same] == path[same]:
                        same += 1
                close(same)
                now = group, lang
                path += words[same:]
                totals += [0] * (len(words) - same)
                totals[-1] += n
            columns = list(zip(*out)) or [(), (), ()]
            out.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "phrase", "n"])
        close(0)
        columns = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "phrase", "n"])

    return run


def _bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """The leading ``bits`` of hashes ``h``, set in 2^(bits - 3) bytes; Spark makes its parts."""
    placed = hashes.select(F.shiftrightunsigned("h", 64 - bits).alias("at"))
    # Spark's parts begin with bit 0 in part 1.
    parts = placed.groupBy(F.floor(F.col("at") / (1 << PART_BITS)).alias("part")).agg(
        F.bitmap_construct_agg(F.col("at") % (1 << PART_BITS)).alias("bits"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in parts.toLocalIterator():
        made = np.frombuffer(bytes(r.bits), np.uint8)
        out[r.part << (PART_BITS - 3):][:len(made)] = made
    return out


def _first(words: int) -> Column:
    return F.concat(F.substring_index("phrase", END, words), F.lit(END))


def _length(phrase: str = "phrase") -> Column:
    return F.regexp_count(phrase, F.lit(END))


def prefix_groups(suffixes: DataFrame, pairs: DataFrame, longest: int, group: int) -> tuple[DataFrame, set[tuple[str, str]]]:
    """Suffixes (lang, phrase, n) with the number ``g`` of their vertical prefix's group, and the prefixes that were extended.

    A prefix is two words; while more than ``group`` suffixes begin with it,
    it is extended by a word. The extended prefixes are a list of at most
    ``MOST_GROUPS`` a length, since each holds more than a group.
    """
    total = pairs.agg(F.sum("n")).first()[0] or 0
    group = max(group, -(-total // MOST_GROUPS))
    groups = -(-total // group) + 1
    extended: set[tuple[str, str]] = set()
    key, heavy = _first(2), pairs.where(F.col("n") > group).select("lang", "phrase")
    for depth in range(3, longest + 1):
        heavy = stored(heavy, "heavy")
        found = heavy.collect()  # at most MOST_GROUPS
        if not found:
            break
        extended |= {(r.lang, r.phrase) for r in found}
        listed = F.broadcast(heavy.select("lang", F.col("phrase").alias("head"), F.lit(True).alias("over")))
        suffixes = suffixes.withColumn("head", key).join(listed, ["lang", "head"], "left")
        longer = F.col("over") & (_length() >= depth)
        # A suffix that ends with its heavy prefix stays with the other short ones of it: a leaf of its own.
        key = F.when(longer, _first(depth)).otherwise(F.col("head"))
        suffixes = suffixes.withColumn("key", key).drop("head", "over")
        key = F.col("key")
        heavy = (suffixes.where(_length("key") == depth).groupBy("lang", "key").agg(F.sum("n").alias("n"))
                 .where(F.col("n") > group).select("lang", F.col("key").alias("phrase")))
    return suffixes.select("lang", "phrase", "n", F.pmod(F.xxhash64("lang", key), F.lit(groups)).alias("g")), extended


def _salt(words: DataFrame, least: int) -> str:
    """What begins the hashed words, so that no frequent word shares its hash with any other."""
    for i in count():
        same = words.groupBy(_hash(f"{i}\n").alias("h")).agg(F.count("*").alias("words"), F.max("n").alias("most"))
        if same.where((F.col("words") > 1) & (F.col("most") >= least)).isEmpty():
            return f"{i}\n"


def frequent_triples(counted: DataFrame, least: int) -> DataFrame:
    """Stored (pair, third, n) of ``least`` occurrences and more from rows (pair, third, n); pairs have -1 for a third word."""
    dealt = counted.repartition("pair").groupBy("pair", "third").agg(F.sum("n").alias("n"))
    pairs = dealt.groupBy("pair").agg(F.sum("n").alias("n")).select("pair", F.lit(-1).cast("long").alias("third"), "n")
    # One shuffle serves both; a condition on ``third`` before it is stored would go below and make it two.
    return stored(dealt.unionByName(pairs).where(F.col("n") >= least), "triples").where("third != 0")


def _hash_of(known: np.ndarray) -> Callable:
    """Hashes of triples (pair, third)."""

    @F.pandas_udf("long")
    def hashed(pair, third):
        pair, third = pair.to_numpy(), third.to_numpy()
        out = _triple_hashes(*(known[i - 1] for i in (pair >> 32, pair & 0xFFFFFFFF, third)))
        return pd.Series(out.view(np.int64))

    return hashed


def _phrases(triples: DataFrame, frequent: DataFrame, known: np.ndarray) -> DataFrame:
    """(lang, phrase, n) of pairs and triples (pair, third, n) of words' numbers."""

    @F.pandas_udf("long")
    def numbered(h):
        return pd.Series(np.searchsorted(known, h.to_numpy().view(np.uint64)) + 1)

    named = stored(frequent.select("lang", "phrase", numbered("h").alias("id")), "named")
    word = lambda i: named.select(F.col("id").alias(f"id{i}"), F.col("phrase").alias(f"w{i}"))
    found = triples.select(F.shiftright("pair", 32).alias("id1"), F.expr("pair & 4294967295").alias("id2"), F.col("third").alias("id3"), "n")
    found = found.join(named.select("lang", F.col("id").alias("id1"), F.col("phrase").alias("w1")), "id1").join(word(2), "id2").join(word(3), "id3", "left")
    return found.select("lang", F.concat("w1", "w2", F.coalesce("w3", F.lit(""))).alias("phrase"), "n")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5,
                  group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """Stored tables (lang, n) of all word occurrences and (lang, phrase, n) of words and phrases of ``least`` occurrences and more.

    In ``phrase`` every word is followed by ``END``.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), whole_text(text_col).cast("binary").alias("t"))
    schema = "lang string, phrase string, n long"
    summed = lambda df: df.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    words = stored(summed(texts.mapInArrow(_count_words, schema)), "words")
    sizes = stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    salt = _salt(words, least)
    frequent = stored(words.where(F.col("n") >= least).withColumn("h", _hash(salt)), "frequent")
    known = np.sort(np.asarray(frequent.select("h").toArrow().column(0)).view(np.uint64))
    triples = frequent_triples(texts.mapInArrow(_count_triples(known, salt, longest), "pair long, third long, n long"), least)
    counts = frequent.select("lang", "phrase", "n").unionByName(_phrases(triples, frequent, known))
    if longest > 3:
        word_bits = _bitmap(frequent.select("h"), WORD_BITS)
        triple_bits = _bitmap(triples.where("third > 0").select(_hash_of(known)("pair", "third").alias("h")), PAIR_BITS)
        suffixes = stored(texts.mapInArrow(_suffixes(word_bits, triple_bits, salt, longest), schema), "suffixes")
        pairs = stored(summed(suffixes.select("lang", _first(2).alias("phrase"), "n")), "pairs")
        grouped, heavy = prefix_groups(suffixes, pairs, longest, group)
        grouped = grouped.groupBy("g", "lang", "phrase").agg(F.sum("n").alias("n"))
        walked = (grouped.repartition("g").sortWithinPartitions("g", "lang", "phrase").select("g", "lang", "phrase", "n")
                  .mapInArrow(_subtrees(least, heavy), schema))
        # A node above the extended prefixes is in several groups: its parts meet here.
        counts = counts.unionByName(summed(walked.where(_length() > 3)).where(F.col("n") >= least))
    return sizes, stored(counts, "counts")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = 100, longest: int = 5,
                 top: int = 2000, group: int = GROUP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` phrases of 2 to ``longest`` words.

    ``a`` is how often the phrase occurs, ``n`` counts the language's words.
    Of its cuts in two, occurring ``l`` and ``r`` times, the one of the lowest
    score floor(1000 a n / (l r)) counts, the first of equals. A phrase
    within a longer candidate that occurs as often is left out. Ranks go by
    score, ``a`` (both descending) and phrase in byte order.

    A null text is empty, a null language is ``und``; repeated rows count
    each for themselves; texts are read whole at any length (a piece, the text between two
    punctuation marks, is held by its task). An empty table, or one without
    a frequent phrase, gives no rows; other columns are not read.
    """
    sizes, counts = phrase_counts(docs, text_col, lang_col, least, longest, group)
    joined = lambda a: F.concat(F.array_join(a, END), F.lit(END))
    words = F.split("phrase", END)  # and an empty last one
    phrases = counts.where(_length() > 1)
    # One word more at either end is enough to look at: what occurs as often in a longer phrase does in those between.
    both = F.array(joined(F.slice(words, 1, F.size(words) - 2)), joined(F.slice(words, 2, F.size(words) - 2)))
    wider = phrases.where(_length() > 2).select("lang", "n", F.explode(both).alias("phrase"))
    wider = wider.groupBy("lang", "phrase").agg(F.max("n").alias("within"))
    kept = phrases.withColumnRenamed("n", "a").join(wider, ["lang", "phrase"], "left").where("within IS NULL OR within < a").drop("within")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), _length() - 1)).alias("k"), words.alias("w"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.slice("w", F.lit(1), F.col("k"))).alias("left"),
                       joined(F.slice("w", F.col("k") + 1, F.size("w") - 1 - F.col("k"))).alias("right"))
    part = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(sizes, "lang")
    whole = lambda c: F.col(c).cast("decimal(18,0)")
    cuts = cuts.withColumn("above", F.lit(1000).cast("decimal(4,0)") * whole("a") * F.col("n").cast("decimal(16,0)"))
    cuts = cuts.withColumn("below", whole("l") * whole("r")).withColumn("score", F.expr("above div below").cast("long"))
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    plain = best.select("lang", F.array_join(F.slice(words, 1, F.size(words) - 1), " ").alias("phrase"),
                        "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # A hot language: the best of its parts first, then the best of those.
    some = plain.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    some = some.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
