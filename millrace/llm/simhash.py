"""SimHash near-duplicates: 64-bit fingerprints that differ in few bits, and their classes.

Fingerprints are indexed by byte position. Two that differ in at most two bits share at least six of
their eight bytes, each in its place: the guaranteed minimum. The inverted index therefore has an entry
for each choice of six positions and their bytes. What meets in an entry has reached the minimum
count, and only two bytes are left to tell its members apart, so an entry holds 65,536 fingerprints at
the most, whatever the input. Candidates are verified by their differing bits. An entry passes on a
star for each of its linked classes instead of all pairs, which keeps the classes as they are.

Equal fingerprints are one before the index, so copies cost nothing. NULL and empty texts have
fingerprint 0 and are linked like any other. A NULL ``doc_id`` belongs to its class, and a class of
such rows alone has a NULL id. Rows that repeat are in the class once each. An empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import KEY, keyed, pieces, rows_of
from millrace.llm.components import components
from millrace.scratch import materialize

SHINGLE = 3
SEED = 42
DISTANCE = 2
READ_BYTES = 4_000_000
SMALL = 48
# The two byte positions that an entry leaves out, and the mask of the six that it holds.
ENTRIES = [
    (pair, ~sum(0xFF << (8 * p) for p in pair) & 0xFFFF_FFFF_FFFF_FFFF)
    for pair in combinations(range(8), 2)
]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """XXH64 of the word shingles of a text, repeats included; of all words if they are fewer."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= shingle:
        return [xxh64_intdigest(joined, SEED)]
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    ends = [s - 1 for s in starts[shingle:]] + [len(joined)]
    return [xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends)]


def fingerprint(hashes: list[int]) -> int:
    """Bits that are set in more than half of the hashes."""
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 65_536):
        some = np.array(hashes[first : first + 65_536], ">u8")
        bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``_text_hash`` and ``fp``, the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            fps = [signed(fingerprint(shingle_hashes(t, shingle))) for t in batch.column("text").to_pylist()]
            columns = [batch.column(c) for c in KEY]
            yield pa.record_batch([*columns, pa.array(fps, pa.int64())], names=[*KEY, "fp"])

    return keyed(docs).mapInArrow(run, "doc_id bigint, _text_hash bigint, fp bigint")


def linked(values: list[int]) -> list[tuple[int, int]]:
    """Stars over the classes of fingerprints of one entry that differ in at most two bits."""
    if len(values) <= SMALL:
        links = [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= DISTANCE]
        return [(signed(a), signed(b)) for a, b in links]
    return _by_flips(values)


def _by_flips(values: list[int]) -> list[tuple[int, int]]:
    """The same over a longer entry: every member looks for those that one or two flipped bits of
    the two open bytes lead to, 136 probes each; the smallest label spreads until none changes."""
    fps = np.unique(np.array(values, np.uint64))
    differ = int(np.bitwise_or.reduce(fps ^ fps[0]))
    bits = [1 << i for i in range(64) if differ >> i & 1]
    flips = [*bits, *(a | b for a, b in combinations(bits, 2))]
    sides = []
    for flip in flips:
        partner = fps ^ np.uint64(flip)
        at = np.minimum(np.searchsorted(fps, partner), len(fps) - 1)
        here = np.flatnonzero(fps[at] == partner)
        sides.append((here, at[here]))
    label = np.arange(len(fps))
    while True:
        before = label.copy()
        for here, there in sides:
            label[here] = np.minimum(label[here], label[there])
        label = label[label]
        if (label == before).all():
            break
    return [(signed(int(fps[i])), signed(int(fps[j]))) for i, j in enumerate(label) if i != j]


def links(distinct: DataFrame) -> DataFrame:
    """Links between fingerprints (column ``fp``, each once), as ``a`` and ``b``."""
    entries = F.array(*[F.col("fp").bitwiseAND(F.lit(signed(mask))) for _, mask in ENTRIES])
    index = distinct.select("fp", F.posexplode(entries).alias("_entry", "_bytes"))
    lists = index.groupBy("_entry", "_bytes").agg(F.collect_list("fp").alias("fps"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for fps in batch.column("fps").to_pylist() for x in linked([f % (1 << 64) for f in fps])]
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    met = lists.filter(F.size("fps") > 1).select("fps")
    return met.mapInArrow(verify, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``_text_hash``, ``fp``, ``component_id`` (the smallest id of the document's class)
    and ``class_fp`` (the smallest fingerprint of the class), for every row."""
    marked = materialize(fingerprints(docs, shingle), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("class_fp")
    )
    least = rooted.groupBy("class_fp").agg(F.min("_least").alias("component_id"))
    classes = rooted.join(least, "class_fp").select("fp", "class_fp", "component_id")
    return marked.join(classes, "fp").select(*KEY, "fp", "component_id", "class_fp")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The columns of KEY of one document of each class: that of the smallest id, NULL last, then of the
    smallest hash of the text."""
    order = F.struct(F.col("doc_id").isNull(), *KEY)
    first = near_duplicates(docs, shingle).groupBy("class_fp").agg(F.min(order).alias("_first"))
    return first.select("_first.doc_id", "_first._text_hash")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The row of ``first_of_each`` of each class, with all its columns; any of rows that repeat."""
    return rows_of(docs, first_of_each(docs, shingle))
