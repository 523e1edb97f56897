"""Bounded-space online packing of tokenised documents into sequences.

Each partition reads its documents once and keeps ``windows`` open windows.
A piece goes into the window whose free room fits it best. When none fits,
the fullest window is filled to the brim with the head of the piece and
emitted, and the rest of the piece goes on. What is still open at the end of
a partition is merged: windows are poured together, full ones emitted, and
at most one unfilled window is left. Leftovers of up to ``fan_in`` partitions
are then merged by a task, and so on until one unfilled window is left in
all; it alone is padded. No task holds more than the open windows or
``fan_in`` leftovers, and documents are never shuffled.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from couponlens.llm.common import ROW, numbered, stored

VOCABULARY = "byte_bpe_50k"
SEPARATOR = 0
#: Bits of a sequence id below the round (8 bits) and the partition (24 bits).
LOCAL_BITS = 31
#: Leftover pieces carry their tokens; those of emitted sequences do so on demand.
SCHEMA = ("__row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, done boolean, ids binary")


def encoder(path: str | None = None) -> Callable[[str], np.ndarray]:
    """Text -> token ids (uint32) of the byte-level vocabulary at ``path`` (.json, with its ranks beside it).

    The rank file holds the same vocabulary for a faster library. Texts in
    which it could differ, those that spell a special token, and texts it
    refuses are encoded by the .json file's own library.
    """
    import base64

    import tiktoken
    import tokenizers

    path = path or public_tokenizers.path(f"{VOCABULARY}.json")
    exact = tokenizers.Tokenizer.from_file(path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    with open(f"{path.removesuffix('.json')}.tiktoken", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if not any(s in text for s in special):
            try:
                return np.asarray(fast.encode_to_numpy(text), "<u4")
            except (ValueError, RuntimeError):
                pass
        return np.array(exact.encode(text, add_special_tokens=False).ids, "<u4")

    return encode


class Windows:
    """The open windows of a task and what it has emitted. A piece: (row, doc_id, start, ids, doc_tokens)."""

    def __init__(self, capacity: int, count: int, first_id: int):
        self.capacity, self.count, self.next_id = capacity, count, first_id
        self.open: list[tuple[int, list]] = []  # (free room, pieces)
        self.emitted: list[tuple] = []

    def emit(self, pieces: list, done: bool = True) -> None:
        offset = 0
        for row, doc, start, ids, total in pieces:
            self.emitted.append((row, doc, start, ids, total, self.next_id, offset, done))
            offset += len(ids)
        self.next_id += 1

    def add(self, piece: tuple) -> None:
        row, doc, start, ids, total = piece
        while len(ids) >= self.capacity:
            self.emit([(row, doc, start, ids[:self.capacity], total)])
            start, ids = start + self.capacity, ids[self.capacity:]
        if not len(ids):
            return
        fits = [(room, i) for i, (room, _) in enumerate(self.open) if room >= len(ids)]
        if fits:
            room, i = min(fits)
            pieces = self.open.pop(i)[1]
        elif len(self.open) < self.count:
            room, pieces = self.capacity, []
        else:
            i = min(range(len(self.open)), key=lambda i: self.open[i][0])
            room, pieces = self.open.pop(i)
            self.emit([*pieces, (row, doc, start, ids[:room], total)])
            return self.add((row, doc, start + room, ids[room:], total))
        pieces.append((row, doc, start, ids, total))
        if room == len(ids):
            self.emit(pieces)
        else:
            self.open.append((room - len(ids), pieces))

    def merge(self) -> None:
        """Pour the open windows together; one unfilled at most stays, emitted as not done."""
        rest = [piece for _, pieces in sorted(self.open, key=lambda w: w[0]) for piece in pieces]
        self.open, self.count = [], 1
        for piece in rest:
            self.add(piece)
        for _, pieces in self.open:
            self.emit(pieces, done=False)
        self.open = []

    def drain(self, with_ids: bool) -> pa.RecordBatch:
        rows, self.emitted = self.emitted, []
        data = [r[3].astype("<u4", copy=False).tobytes() for r in rows]
        columns = [
            pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()),
            pa.array([len(r[3]) for r in rows], pa.int64()), pa.array([zlib.crc32(d) for d in data], pa.int64()),
            pa.array([r[4] for r in rows], pa.int64()), pa.array([r[5] for r in rows], pa.int64()), pa.array([r[6] for r in rows], pa.int64()),
            pa.array([r[7] for r in rows], pa.bool_()),
            pa.array([d if with_ids or not r[7] else None for r, d in zip(rows, data)], pa.binary())]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays(columns, names)


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, windows: int = 32,
         fan_in: int = 256, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces: row number, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids, if asked for).

    A document is its ids and then id 0, so a null or empty text is one id.
    Every row of ``docs`` is packed, rows with the same id each for itself
    (``__row`` tells them apart), null ids too. A text of any length is
    encoded whole by its task, which holds its ids. An empty table gives no
    rows; other columns are not read.
    """
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    def first_id(level: int) -> int:
        return (level << 55) | (TaskContext.get().partitionId() << LOCAL_BITS)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held = encoder(path), Windows(capacity, windows, first_id(0))
        for batch in batches:
            for row, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                ids = np.append(encode(text.as_py() or ""), np.uint32(SEPARATOR)).astype("<u4")
                held.add((row, doc, 0, ids, len(ids)))
                if len(held.emitted) >= 5000:
                    yield held.drain(with_ids)
        held.merge()
        yield held.drain(with_ids)

    def leftovers(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = Windows(capacity, 1, first_id(level))
            for batch in batches:
                for r in batch.to_pylist():
                    held.add((r[ROW], r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"]))
            held.merge()
            yield held.drain(with_ids)
        return run

    rows = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))).select(ROW, "doc_id", "t")
    packed = stored(rows.mapInArrow(documents, SCHEMA), "packed")
    finished, level = [packed.where("done")], 1
    left = packed.where("NOT done")
    while (waiting := left.agg(F.countDistinct("sequence_id")).first()[0]) > 1:
        # Sequences, a piece each or a few, dealt to tasks of fan_in; sorted, so that a repeated task does the same.
        tasks = -(-waiting // fan_in)
        group = F.pmod(F.col("sequence_id").bitwiseAND((1 << 55) - 1) / (1 << LOCAL_BITS), F.lit(tasks)).cast("int")
        dealt = left.withColumn("g", group).repartition(tasks, "g").sortWithinPartitions("g", "sequence_id", "offset").drop("g")
        packed = stored(dealt.mapInArrow(leftovers(level), SCHEMA), "packed")
        finished, left, level = [*finished, packed.where("done")], packed.where("NOT done"), level + 1
    out = left
    for more in finished:
        out = out.unionByName(more)
    return out.drop("done", *([] if with_ids else ["ids"]))
