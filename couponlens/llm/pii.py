"""Personal data replaced by keyed, type-consistent surrogates.

Three steps. Spans are detected in every text and stored. Their distinct
entities, (kind, canonical form), get a surrogate from a keyed hash of the
entity: digits become digits, letters become letters of the same script and
case, separators stay, phone numbers keep their country, card and account
numbers their right check digits, names gender and script. A given name has one gender wherever it occurs,
from the titles it follows and the lists of names. Surrogates are checked against each other and
against all real entities; where two meet, or a surrogate is a real entity,
the smallest entity keeps it and the others draw again, until none meet, so
distinct entities stay distinct and one entity has one surrogate everywhere.
Last, the surrogates are written into the texts in each span's own format.

A name is split into given name and surname, so that "Mr John Doe" and "Mr
Doe" go on sharing a surname; an address of mail into local part and domain.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import string
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from couponlens.llm.common import ROW, numbered, stored

# Titles and the gender they tell (m, f, or n for either), and given names by script and gender.
TITLES = {"Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "господин": "m", "Господин": "m", "κύριος": "m", "Κύριος": "m",
          "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "госпожа": "f", "Госпожа": "f", "κυρία": "f", "Κυρία": "f",
          "Dr": "n", "Prof": "n", "Professor": "n"}
GIVEN = {("LATIN", "m"): ["Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Simon", "Victor"],
         ("LATIN", "f"): ["Alice", "Berta", "Clara", "Diana", "Emma", "Flora", "Helena", "Irene", "Julia", "Laura", "Marta", "Olivia", "Paula", "Sofia", "Vera"],
         ("CYRILLIC", "m"): ["Андрей", "Борис", "Виктор", "Дмитрий", "Иван", "Павел"],
         ("CYRILLIC", "f"): ["Анна", "Вера", "Дарья", "Ирина", "Мария", "Ольга"],
         ("GREEK", "m"): ["Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
         ("GREEK", "f"): ["Άννα", "Ελένη", "Ιωάννα", "Μαρία", "Σοφία"],
         ("ARMENIAN", "m"): ["Արամ", "Տիգրան", "Հայկ", "Դավիթ"], ("ARMENIAN", "f"): ["Անի", "Նարե", "Մարիամ", "Լիլիթ"],
         ("GEORGIAN", "m"): ["გიორგი", "დავით", "ლევან"], ("GEORGIAN", "f"): ["ნინო", "მარიამ", "თამარ"],
         ("HEBREW", "m"): ["דוד", "יוסף", "משה"], ("HEBREW", "f"): ["רחל", "מרים", "נועה"],
         ("ARABIC", "m"): ["محمد", "احمد", "خالد"], ("ARABIC", "f"): ["فاطمة", "مريم", "ليلى"],
         ("CJK", "m"): ["伟", "强", "军", "建国"], ("CJK", "f"): ["芳", "娜", "丽", "秀英"],
         ("HANGUL", "m"): ["민준", "서준", "지훈"], ("HANGUL", "f"): ["서연", "지우", "수빈"],
         ("HIRAGANA", "m"): ["たろう", "けんじ"], ("HIRAGANA", "f"): ["はなこ", "さくら"],
         ("KATAKANA", "m"): ["タロウ", "ケンジ"], ("KATAKANA", "f"): ["ハナコ", "サクラ"]}
SYLLABLES = {"LATIN": ("bdfgklmnprstv", "aeiou"), "CYRILLIC": ("бвгдзклмнпрст", "аеиоу"), "GREEK": ("βγδκλμνπρστ", "αειο"),
             "ARMENIAN": ("բգդկլմնպրստ", "աեիո"), "GEORGIAN": ("ბგდკლმნპრსტ", "აეიო"), "HEBREW": ("בגדלמנפרשת", "אוי"), "ARABIC": ("بتدرسكلمن", "اوي"),
             "CJK": ("王李张刘陈杨赵黄周吴", "明华文平安林海云山"), "HANGUL": ("김박최정강조윤장임한", "가나다라마사아자하"),
             "HIRAGANA": ("かさたなはまらわ", "あいうえお"), "KATAKANA": ("カサタナハマラワ", "アイウエオ")}
ALPHABETS = {"LATIN": string.ascii_lowercase, "CYRILLIC": "абвгдежзиклмнопрстуфхцчшэюя", "GREEK": "αβγδεζηθικλμνξοπρστυφχψω",
             "ARMENIAN": "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցփքօֆ", "GEORGIAN": "აბგდევზთიკლმნოპჟრსტუფქღყშჩცძწჭხჯჰ", "HEBREW": "אבגדהוזחטיכלמנסעפצקרשת",
             "ARABIC": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "CJK": "一人大小中上下天水火木金土山石田日月星云雨风花草林海江河东西南北春夏秋冬", "HANGUL": "가나다라마바사아자차카타파하고노도로모보소오조",
             "HIRAGANA": "あいうえおかきくけこさしすせそたちつてとなにぬねの", "KATAKANA": "アイウエオカキクケコサシスセソタチツテトナニヌネノ"}

BLANK = "\0"
OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
# In the order in which they claim text. Digits are ASCII digits. A pattern goes through a run of characters once:
# that of mail takes every whole run that could be a local part, and those without a domain are passed over.
PATTERNS = [(kind, re.compile(pattern)) for kind, pattern in [
    ("email", r"(?P<local>[\w.+%-]++)(?:@(?P<domain>[^\W_][\w-]*(?:\.[\w-]*[^\W_])+))?"),
    ("secret", r"\bAKIA(?P<secret>[A-Z0-9]{16})\b"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b[\"']?\s*[=:]\s*[\"']?)(?P<secret>[^\s\"',;]{4,})"),
    ("ip", rf"(?<![\w.])(?P<ip>(?:{OCTET}\.){{3}}{OCTET})(?![\w]|\.[0-9])"),
    ("iban", r"\b(?P<iban>[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)\b"),
    ("card", r"(?<![\w-])(?P<card>[0-9](?:[ -]?[0-9]){12,18})(?![\w-])"),
    ("ssn", r"(?<![\w-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])"),
    ("phone", r"(?<![\w+])(?P<phone>\+1[ .-]?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4})(?!\w)"),
    ("name", rf"\b(?P<title>{'|'.join(sorted(TITLES, key=len, reverse=True))})\b\.?(?=[^\S\n])"),
]]
# The part of a name after a title or another part, on the same line; an initial's full stop goes with it.
PART = re.compile(rf"[^\S\n]+(?P<part>{NAME})(?P<dot>\.(?=[^\S\n]+\w))?")
WORD = re.compile(NAME)
POSSESSIVE = re.compile(r"['’]s$")
# Particles that stand before a surname and stay as they are.
PARTICLES = {"van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "du", "des", "la", "le", "el", "al", "bin", "ibn", "ter", "ten", "zu", "zur", "y"}
# Country codes of phone numbers of one and two digits; all others have three.
SHORT_CODES = {"1", "7", *("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())}
#: Every entity has one of these characters, or its text one of these parts of titles and keys.
HINT_CHARACTERS = "[0-9@=:]"
HINT_PARTS = ["Mr", "Ms", "Mis", "Mme", "Madame", "Monsieur", "Herr", "Frau", "Señor", "Sr", "Dr", "Prof", "осподин", "оспожа", "ύριος", "υρία", "AKIA"]


def hinted(text: str) -> Column:
    """Whether a text may hold an entity; plain searches, many times faster than the patterns. Null: false."""
    hint = F.col(text).rlike(HINT_CHARACTERS)
    for part in HINT_PARTS:
        hint = hint | F.contains(F.col(text), F.lit(part))
    return F.coalesce(hint, F.lit(False))


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def iban_rest(text: str) -> int:
    """Remainder of an account number, its letters as numbers from 10, by 97."""
    return int("".join(str(int(c, 36)) for c in text)) % 97


def script(text: str) -> str:
    for c in text:
        if c.isalpha():
            name = unicodedata.name(c, "LATIN").split()[0]
            return name if name in ALPHABETS else "LATIN"
    return "LATIN"


def detect(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of each entity part, in order and without overlap."""
    found, whole = [], text
    for kind, pattern in PATTERNS:
        taken = []
        for m in pattern.finditer(text):
            if kind == "name":
                parts = _name_parts(text, m)
            elif kind == "email":
                parts = m["domain"] and [(*m.span("local"), "local", m["local"].casefold()), (*m.span("domain"), "domain", m["domain"].casefold())]
            elif kind == "card" and not luhn(re.sub(r"[^0-9]", "", m["card"])):
                parts = []  # some other number: an order, a book
            elif kind in ("card", "ssn", "phone"):
                parts = [(*m.span(kind), kind, ("+" if m[kind][0] == "+" else "") + re.sub(r"[^0-9]", "", m[kind]))]
            elif kind == "iban":
                parts = [(*m.span(kind), kind, m[kind].replace(" ", ""))]
            else:
                parts = [(*m.span(kind), kind, m[kind])]
            if parts:
                taken.append((m.start(), max(m.end(), parts[-1][1])))
                found += parts
        if taken:  # what one pattern has claimed the next ones cannot reach
            ends = [0, *(b for _, b in taken)]
            text = "".join(text[end:a] + BLANK * (b - a) for end, (a, b) in zip(ends, taken)) + text[ends[-1]:]
    names = {(surface, e): k for (a, b, k, e) in found if k.startswith(("surname", "given")) for surface in [whole[a:b]] if b - a > 2}
    if names:  # the same names without a title, elsewhere in the text
        known = {surface: (k, e) for (surface, e), k in sorted(names.items(), key=lambda x: (x[1].startswith("given"), x[0]))}
        for m in WORD.finditer(text):
            surface = POSSESSIVE.sub("", m[0])
            if surface in known:
                found.append((m.start(), m.start() + len(surface), *known[surface]))
    return sorted(found)


def _begins_name(letter: str) -> bool:
    """A capital, or a letter of a script that does not begin names with one (Georgian has capitals, but not there)."""
    return letter.isupper() or letter == letter.swapcase() or script(letter) == "GEORGIAN"


def _name_parts(text: str, m: re.Match) -> list[tuple[int, int, str, str]]:
    """Given names and surname after a title; particles and initials stay, and no other title is taken for a name."""
    words, at, capital = [], m.end(), None
    while part := PART.match(text, at):
        word = part["part"]
        own = POSSESSIVE.sub("", word)
        particle = own in PARTICLES
        if own in TITLES or (capital is not False and not particle and not _begins_name(own[0])):
            break
        if not particle:
            if capital is None:
                capital = own[0].isupper()
            # A word that cannot show whether it begins a name is one only after a part of its own kind, and the second at most.
            if own[0].isupper() != capital or not _begins_name(own[0]) or not capital and len(words) == 2:
                break
        start = part.start("part")
        if not particle and not (len(own) == 1 and own.isupper() and part["dot"]):
            words.append((start, start + len(own), own))
        at = part.end()
        if own != word:
            break
    gender = TITLES[m["title"]]
    return [(a, b, f"given-{gender}:{script(w)}" if i < len(words) - 1 else f"surname:{script(w)}", w.casefold()) for i, (a, b, w) in enumerate(words)]


class Draw:
    """An endless stream of numbers from a keyed hash."""

    def __init__(self, key: bytes, *what: object):
        self.key, self.what, self.block, self.pool = key, "\x1f".join(map(str, what)).encode("utf-8", "surrogatepass"), 0, b""

    def __call__(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool = hmac.new(self.key, self.block.to_bytes(4, "big") + self.what, hashlib.sha256).digest()
            self.block += 1
        number, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return number % n


def _like(text: str, draw: Draw) -> str:
    """Digits for digits, letters of the same script and case for letters; hexadecimal strings stay so."""
    hexadecimal, out = re.fullmatch(r"(?=.*[0-9])(?:[0-9a-f]{8,}|[0-9A-F]{8,})", text), []
    for c in text:
        if c in string.digits:
            out.append(str(draw(10)))
        elif c.isalpha():
            alphabet = "abcdef" if hexadecimal else ALPHABETS[script(c)]
            new = alphabet[draw(len(alphabet))]
            out.append(new.upper() if c.isupper() else new)
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, entity: str, key: bytes, attempt: int = 0) -> str:
    """Canonical surrogate of an entity; every eighth attempt is a character longer, so some attempt is free."""
    draw, longer = Draw(key, kind, entity, attempt), attempt // 8
    base, _, letters = kind.partition(":")
    if base == "surname":
        consonants, vowels = SYLLABLES[letters]
        return "".join(consonants[draw(len(consonants))] + vowels[draw(len(vowels))] for _ in range(3 + draw(2) + longer))
    if base.startswith("given"):
        gender = base[-1]
        names = GIVEN[letters, gender] if gender != "n" else GIVEN[letters, "m"] + GIVEN[letters, "f"]
        tail = "" if attempt == 0 else "".join(SYLLABLES[letters][i % 2][draw(len(SYLLABLES[letters][i % 2]))] for i in range(2 + attempt // 4))
        name = names[draw(len(names))].casefold()
        return name + ("-" + tail if tail else "")
    if kind == "ip":
        octets = entity.split(".")
        # A private range may be full of real addresses: later attempts draw from the next larger one.
        ranges = [["192", "168"], ["10"], []]
        own = next(i for i, head in enumerate(ranges) if octets[:len(head)] == head)
        head = ranges[min(own + longer, 2)]
        return ".".join(head + [str((1 if i == 0 else 0) + draw(223 if i == 0 else 256)) for i in range(len(head), 4)])
    if kind == "domain":
        labels = entity.split(".")
        return ".".join([_like(x, draw) + _like("a" * (longer * (i == 0)), draw) for i, x in enumerate(labels[:-1])] + labels[-1:])
    if kind == "card":
        body = entity[0] + _like(entity[1:-1] + "0" * longer, draw)
        right = next(str(d) for d in range(10) if luhn(body + str(d)))
        return body + (right if luhn(entity) else str((int(right) + 1 + draw(9)) % 10))
    if kind == "phone":
        head = 0
        if entity.startswith("+"):  # the country stays
            head = 2 if entity[1:2] in SHORT_CODES else 3 if entity[1:3] in SHORT_CODES else 4
        return entity[:head] + _like(entity[head:] + "0" * longer, draw)
    if kind == "iban":
        body = _like(entity[4:] + "0" * longer, draw)
        right = f"{98 - iban_rest(body + entity[:2] + '00'):02}"
        return entity[:2] + (right if iban_rest(entity[4:] + entity[:4]) == 1 else _like(entity[2:4], draw)) + body
    if not any(c in string.digits or c.isalpha() for c in entity):
        return entity + _like("a" * (longer + 1), draw)
    return _like(entity + "a" * longer, draw)


def in_format(surface: str, new: str) -> str:
    """A canonical surrogate with the case of the span's letters and its separators."""
    if len(new) == len(surface):
        return "".join(c.upper() if s.isupper() else c for s, c in zip(surface, new))
    if surface.isupper() and any(c.isalpha() for c in surface):
        new = new.upper()
    elif surface[:1].isupper() and surface[1:].islower():
        new = new[:1].upper() + new[1:]
    if not re.fullmatch(r"[+]?[0-9A-Z()\s.-]+", surface) or "." in new:
        return new
    rest = iter(new.lstrip("+"))
    return "".join([next(rest, c) if c.isalnum() else c for c in surface]) + "".join(rest)


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, start, end, kind, entity, surface) of every entity part of every text; stored."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [ROW, "start", "end", "kind", "entity", "surface"]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string()]
        for batch in batches:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                out += [(row, a, b, kind, entity, text[a:b]) for a, b, kind, entity in detect(text)]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kinds[i]) for i in range(6)], names)

    texts = numbered(docs.select(F.col(text_col).cast("string").alias("t"))).where(hinted("t")).select(ROW, "t")
    return stored(texts.mapInArrow(find, f"{ROW} long, start int, end int, kind string, entity string, surface string"), "spans")


def settled(entities: DataFrame) -> DataFrame:
    """(kind, entity, settled) of distinct (kind, entity): given names with the one gender that their name has under all titles.

    That of its gendered titles; where there are none, or of both genders, that
    of the list of names it is in; neutral if neither tells.
    """
    name = F.concat_ws(":", F.substring_index("kind", ":", -1), "entity")
    listed = {g: {f"{letters}:{n.casefold()}" for (letters, gender), names in GIVEN.items() if gender == g for n in names} for g in "mf"}
    titled = {g: F.max(F.col("kind").startswith(f"given-{g}:")).over(W.partitionBy(name)) for g in "mf"}
    known = {g: name.isin(*sorted(listed[g] - listed[h])) for g, h in ("mf", "fm")}
    told = entities.where(F.col("kind").startswith("given-")).select("kind", "entity", titled["m"].alias("m"), titled["f"].alias("f"))
    gender = (F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f")
              .when(known["m"], "m").when(known["f"], "f").otherwise("n"))
    names = told.select("kind", "entity", F.concat(F.lit("given-"), gender, F.lit(":"), F.substring_index("kind", ":", -1)).alias("settled"))
    return names.unionByName(entities.where(~F.col("kind").startswith("given-")).select("kind", "entity", F.col("kind").alias("settled")))


def surrogates(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, entity, surrogate) of distinct (kind, entity), without collisions; stored."""

    @F.pandas_udf("string")
    def draw(kinds: pd.Series, names: pd.Series, attempts: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, e, key, a) for k, e, a in zip(kinds, names, attempts)], dtype=object)

    given = stored(entities.withColumn("attempt", F.lit(0)).withColumn("surrogate", draw("kind", "entity", "attempt")), "surrogates")
    group = F.when(F.col("kind").startswith("given"), F.regexp_replace("kind", "^given-.", "given")).otherwise(F.col("kind"))
    while True:
        # A given name of either gender is one space of names; all other kinds are spaces of their own.
        marked = given.withColumn("space", group)
        first = marked.groupBy("space", "surrogate").agg(F.min(F.struct("entity", "kind")).alias("first"), F.count("*").alias("n"))
        met = marked.join(first.where("n > 1").drop("n"), ["space", "surrogate"]).where("first.entity != entity OR first.kind != kind").select("kind", "entity")
        real = marked.select("space", F.col("entity").alias("surrogate")).distinct()
        real = marked.join(real, ["space", "surrogate"], "left_semi").select("kind", "entity")
        again = stored(met.unionByName(real).distinct().withColumn("again", F.lit(1)), "again")
        if again.isEmpty():
            return given.select("kind", "entity", "surrogate")
        moved = given.join(again, ["kind", "entity"]).drop("again").withColumn("attempt", F.col("attempt") + 1)
        moved = moved.withColumn("surrogate", draw("kind", "entity", "attempt"))
        given = stored(given.join(again, ["kind", "entity"], "left_anti").unionByName(moved), "surrogates")


def replace(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with surrogates, entities (number of replaced parts), kinds, one row per input row.

    A text without entities, an empty or a null one stays as it is, with 0
    and no kinds. Repeated rows are treated alike, a null id stays null; an
    empty table gives no rows; other columns are not read.
    """
    found = spans(docs, id_col, text_col)
    entities = stored(settled(found.select("kind", "entity").distinct()), "entities")
    drawn = surrogates(entities.select(F.col("settled").alias("kind"), "entity").distinct(), key)
    given = entities.join(drawn.withColumnRenamed("kind", "settled"), ["settled", "entity"]).drop("settled")

    @F.pandas_udf("string")
    def formatted(surfaces: pd.Series, news: pd.Series) -> pd.Series:
        return pd.Series([in_format(s, n) for s, n in zip(surfaces, news)], dtype=object)

    @F.pandas_udf("string")
    def written(texts: pd.Series, edits: pd.Series) -> pd.Series:
        out = []
        for text, changes in zip(texts, edits):
            at, made = 0, []
            for change in changes:
                made += [text[at:change["start"]], change["new"]]
                at = change["end"]
            out.append("".join(made) + text[at:])
        return pd.Series(out, dtype=object)

    edits = (found.join(given, ["kind", "entity"]).withColumn("new", formatted("surface", "surrogate"))
             .groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("start", "end", "new"))).alias("edits"),
                               F.array_sort(F.collect_set(F.regexp_extract("kind", "^[a-z]+", 0))).alias("kinds")))
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    none = [F.lit(0).alias("entities"), F.array().cast("array<string>").alias("kinds")]
    # Only texts with a hint are moved to their edits; the rest, most of a corpus, pass straight through.
    plain = rows.where(~hinted("text")).select("doc_id", "text", *none)
    moved = rows.where(hinted("text")).join(edits, ROW, "left")
    clean = moved.where("edits IS NULL").select("doc_id", "text", *none)
    changed = moved.where("edits IS NOT NULL").select("doc_id", written("text", "edits").alias("text"), F.size("edits").alias("entities"), "kinds")
    return plain.unionByName(clean).unionByName(changed)
