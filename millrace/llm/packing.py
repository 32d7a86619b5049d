"""Packing of token ids into training windows by best-fit decreasing.

A document is its ids and an end id. Documents longer than a window are first cut into full windows
and a rest. Pieces of one round, longest first, go to the open window with the least room that
still takes them; a segment tree over the room left finds it. A round holds a bounded number of ids,
open windows stay open for the next round, and every task packs what it has read, so nothing is
shuffled and a task that runs again packs the same rows again.

Empty and NULL texts are the end id alone. NULL ids, repeated ids and repeated rows are packed like
any other row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import pieces
from millrace.llm.encoding import encoder

WINDOW = 4096
ROUND_TOKENS = 4_000_000
READ_BYTES = 4_000_000
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


class OpenWindows:
    """Open windows by the room they have left: a segment tree with a leaf per number of ids."""

    def __init__(self, window: int):
        self.window = window
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.having = [[] for _ in range(window + 1)]

    def _change(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def open(self, room: int, name: int) -> None:
        if room:
            self.having[room].append(name)
            self._change(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``length``, taken out, and its room."""
        node = length + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._change(room, -1)
        return self.having[room].pop(), room


class Packer:
    def __init__(self, window: int, first: int = 0):
        self.window = window
        self.open = OpenWindows(window)
        self.next = first

    def place(self, lengths: list[int]) -> list[tuple[int, int]]:
        """(window, offset) of each piece, longest first, ties in the order given."""
        places = [(0, 0)] * len(lengths)
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            found = self.open.take(lengths[i])
            if found is None:
                found = self.next, self.window
                self.next += 1
            name, room = found
            places[i] = name, self.window - room
            self.open.open(room - lengths[i], name)
        return places


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    window: int = WINDOW,
    end_id: int = 2,
    round_tokens: int = ROUND_TOKENS,
) -> DataFrame:
    """One row per piece: its document, ``start`` and ``length`` in the document's ids, the ``ids``
    themselves (little-endian 32-bit), ``doc_tokens`` of the whole document, and its place, ``offset``
    in window ``sequence_id``. Offsets of a window have no gaps."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        end = end_id.to_bytes(4, "little")
        packer = Packer(window, TaskContext.get().partitionId() << 32)
        rows, held = [], 0
        for batch in pieces(batches, READ_BYTES):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    length = min(window, total - start)
                    rows.append((doc_id, start, length, ids[4 * start : 4 * (start + length)], total))
                held += total
                if held >= round_tokens:
                    yield placed(packer, rows)
                    rows, held = [], 0
        if rows:
            yield placed(packer, rows)

    return docs.select("doc_id", "text").mapInArrow(pack, SCHEMA)


def placed(packer: Packer, rows: list[tuple]) -> pa.RecordBatch:
    places = packer.place([row[2] for row in rows])
    columns = [*zip(*rows), *zip(*places)]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def sequence_lengths(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """Ids of each window and its length with padding: ``window``, or no padding at all where the
    ids already number a power of two."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"))
    whole = F.col("n_tokens").bitwiseAND(F.col("n_tokens") - 1) == 0
    return used.withColumn(
        "padded_length", F.when(whole, F.col("n_tokens")).otherwise(F.lit(window)).cast("bigint")
    )
