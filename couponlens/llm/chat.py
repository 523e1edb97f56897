"""Chat formatting from event logs.

A log holds, per message of a conversation, events in the order of ``seq``:
``open`` (starts it, with its role), ``delta`` (streamed text), ``edit``
(replaces the text so far) and ``regenerate`` (empties it; deltas follow).
Messages are folded each for itself: the text is that of the last event that
resets it and all deltas after it, in order, so a conversation of any length
is folded by many tasks. Each message is rendered to one segment of its
conversation; a conversation's output is its segments, in order.

Template: ``<turn>### role: text</turn>`` and a newline. Inside roles and
texts the backslash, ``<``, ``#`` (in roles also ``:``) are written ``\\\\``,
``\\l``, ``\\h`` and ``\\c``, so that no control string can occur in a text and
every text can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import ROW, numbered

RESETS = ("open", "edit", "regenerate")
OPEN, MIDDLE, CLOSE = "<turn>### ", ": ", "</turn>\n"
ESCAPES = {"\\": "\\\\", "<": "\\l", "#": "\\h", ":": "\\c"}
SEGMENT = re.compile(re.escape(OPEN) + r"([^:]*)" + re.escape(MIDDLE) + r"(.*)" + re.escape(CLOSE), re.DOTALL)


def _cut(text: Column, size: Column) -> Column:
    """The pieces of ``size`` characters that a text is streamed in."""
    last = F.floor((F.length(text) - 1) / size).cast("int")
    return F.when(F.length(text) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(text, i * size + 1, size)))


def log_of(rows: DataFrame) -> DataFrame:
    """An event log that whole messages (conv_id, turn, role, text) could come from, by rules on a hash of the message.

    A message is opened and streamed in deltas of 7 to 67 characters, of a
    64th of the text if that is more. One in four comes just so; one in four
    is a draft first, in two deltas, that is thrown away by a regeneration;
    one in four begins with a wrong delta, is edited to its first half and
    streams the rest; and one in four is streamed, edited to something else,
    regenerated, streamed in part and edited to the whole. The log arrives
    backwards, and one event in five twice.
    """
    each = numbered(rows.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))).withColumnRenamed(ROW, "message")
    event = lambda op, text: F.struct(F.lit(op).alias("op"), text.alias("text"))
    hashed, text, draft = F.col("hashed"), F.col("text"), F.lit("A draft </turn> ### to be thrown away: ")
    size = F.greatest(F.lit(7) + F.pmod(hashed, F.lit(61)), F.ceil(F.length("text") / 64)).cast("int")
    half = F.floor(F.length("text") / 2).cast("int")
    first, rest = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length("text"))
    deltas = lambda t: F.transform(_cut(t, F.col("size")), lambda x: event("delta", x))
    none, opened = F.lit(""), event("open", F.lit(""))
    way = F.pmod(F.shiftright(hashed, 8), F.lit(4))
    told = (F.when(way == 0, deltas(text))
            .when(way == 1, F.concat(F.array(event("delta", draft), event("delta", F.reverse(first)), event("regenerate", none)), deltas(text)))
            .when(way == 2, F.concat(F.array(event("delta", draft), event("edit", first)), deltas(rest)))
            .otherwise(F.concat(deltas(first), F.array(event("edit", draft), event("regenerate", none)), deltas(rest), F.array(event("edit", text)))))
    named = each.withColumn("hashed", F.xxhash64("conv_id", "turn", "role", "text")).withColumn("size", size)
    events = named.select("conv_id", "turn", "message", "role", "hashed", F.concat(F.array(opened), told).alias("told"))
    numbers = F.transform("told", lambda e, i: F.struct(i.cast("long").alias("seq"), e["op"].alias("op"), e["text"].alias("text")))
    twice = F.filter(numbers, lambda e: F.pmod(F.xxhash64(e["seq"], F.col("hashed")), F.lit(5)) == 0)
    return events.select("conv_id", "turn", "message", "role", F.explode(F.concat(F.reverse(numbers), twice)).alias("e")).select(
        "conv_id", "turn", "message", "e.seq", "e.op", F.when(F.col("e.op") == "open", F.col("role")).alias("role"), "e.text")


def fold(log: DataFrame) -> DataFrame:
    """Final messages (conv_id, turn, message, role, text) of a log (conv_id, turn, message, seq, op, role, text).

    ``message`` tells messages of a conversation apart, ``turn`` orders them;
    each is folded by itself, so that a conversation may have any number. A
    message's events are sorted in one row: its whole history, with what it
    was before, has to fit a task.
    The role is that of the first event that has one. Repeated events (same
    seq, op and text) count once, null texts as empty, other ops not at all.
    """
    event = F.struct("seq", F.coalesce("op", F.lit("")).alias("op"), F.coalesce("text", F.lit("")).alias("text"), "role")
    messages = log.groupBy("conv_id", "turn", "message").agg(F.array_sort(F.collect_list(event)).alias("events"))
    # Repeated events are neighbours now.
    messages = messages.withColumn("events", F.filter("events", lambda e, i: ~e.eqNullSafe(F.get("events", i - 1))))
    # Index of the last reset; 0 when there is none, so that all deltas count.
    reset = F.array_max(F.transform("events", lambda e, i: F.when(e["op"].isin(*RESETS), i).otherwise(0)))
    said = F.filter(F.slice("events", F.col("reset") + 1, F.size("events")), lambda e: e["op"].isin("delta", *RESETS))
    texts = F.transform(said, lambda e: F.when(e["op"] == "regenerate", F.lit("")).otherwise(e["text"]))
    role = F.element_at(F.concat(F.filter(F.transform("events", lambda e: e["role"]), lambda r: r.isNotNull()), F.array(F.lit(""))), 1)
    return messages.withColumn("reset", reset).select("conv_id", "turn", "message", role.alias("role"), F.array_join(texts, "").alias("text"))


def _escape(col: str, chars: str) -> Column:
    out = F.col(col)
    for c in chars:
        out = F.replace(out, F.lit(c), F.lit(ESCAPES[c]))
    return out


def unescape(text: str) -> str:
    back = {v[1]: k for k, v in ESCAPES.items()}
    return re.sub(r"\\(.)", lambda m: back[m[1]], text)


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """Segments: conv_id, turn, role, message, segment, loss_start, loss_end.

    The loss mask of a segment is its text, [loss_start, loss_end) in code
    points of the segment, where the role is ``trained``, else null.
    Segments of a conversation follow each other by turn (null first), then
    role, text and message.
    """
    head = F.concat(F.lit(OPEN), _escape("role", "\\<#:"), F.lit(MIDDLE))
    body = _escape("text", "\\<#")
    mine = F.col("role") == trained
    return (messages.withColumn("head", head).withColumn("body", body).select(
        "conv_id", "turn", "role", "message", F.concat("head", "body", F.lit(CLOSE)).alias("segment"),
        F.when(mine, F.length("head")).alias("loss_start"), F.when(mine, F.length("head") + F.length("body")).alias("loss_end")))


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, read from the segments alone.

    Segments stream past in order and only digests are held, however long a
    conversation is (its digest has one order, so one task makes it).
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []

        def row() -> list:
            return [now[0], now[1], now[2].hexdigest(), now[3], now[4].hexdigest(), now[5]]

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for conv, segment, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(row())
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = map(unescape, SEGMENT.fullmatch(segment).groups())
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    loss = unescape(segment[start:end])
                    now[3] += len(loss)
                    now[4].update(loss.encode("utf-8", "surrogatepass"))
                now[5] += len(segment)
            yield flush()
        if now is not None:
            done.append(row())
            yield flush()

    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "segment", "message"]
    return (segments.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "segment", "loss_start", "loss_end")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Segments of whole-message rows (conv_id, turn, role, text), by way of the event log.

    Every row is a message, repeated rows and rows of one turn too. Null
    texts and roles count as empty; rows with a null conv_id make up one
    conversation. A text of any length is one message, held whole by a task. An empty table gives no rows; other columns are not read.
    """
    return render(fold(log_of(rows)))
