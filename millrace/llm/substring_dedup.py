"""Substring dedup: words in windows of a fixed length that the corpus holds earlier.

Documents are parsed relative to what stands before them, as in relative Lempel-Ziv coding. A text
is cut into phrases: runs of windows that share their least 5-word hash, so that a passage is cut alike
wherever it stands. Phrases are looked up in blocks of an index, first in the block of the
documents read together, then in the blocks of the whole corpus, which are ranges of the phrases'
anchors. A phrase that stands in its block already continues a factor, greedily: neighbours
that do are one factor. Where a factor ends, the first phrase of its own kind may share only some
windows with others of its anchor; those are checked window by window. A factor is at
least one window long, and all words it covers go.

Phrases and windows are compared by two independent 64-bit hashes, an anchor and the sequence, or
two hashes of the sequence. Phrases met in the same block are settled there, so that a passage that a
third of all documents share is one row per block in the shuffle, and windows are combined
before theirs.

"Earlier" is by ``doc_id``, then by the hash of the text, then by start. NULL ids come first. Rows
that repeat are one document: all get what the first gets. NULL and empty texts have no words. An empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import KEY, keyed, of_documents, pieces
from millrace.scratch import materialize

WINDOW = 20
GRAM = 5
READ_BYTES = 6_000_000
KEPT_WORDS = 300_000
# Odd multipliers of the two sequence hashes, and those of the mixing step (fixed values of SplitMix64).
FACTORS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
INVERSE = np.uint64(pow(int(FACTORS[1]), -1, 1 << 64))
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
# Kinds of spans: known to its block; first of its kind there; first, with windows that may repeat inside.
KNOWN, FIRST, INSIDE = 0, 1, 2


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """XXH3 of the words met, a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh3_64_intdigest

        if len(self) >= KEPT_WORDS:
            self.clear()
        value = self[word] = xxh3_64_intdigest(word)
        return value


_words = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))


def window_hashes(x: np.ndarray, length: int, factor: np.uint64) -> np.ndarray:
    """Polynomial hash of each run of ``length`` words, by doubling."""
    total, done = None, 0
    part, width = x, 1
    powers = {0: np.uint64(1)}
    value = np.uint64(1)
    with np.errstate(over="ignore"):
        for i in range(1, length + 1):
            value = value * factor
            powers[i] = value
        while True:
            if length & width:
                if total is None:
                    total, done = part, width
                else:
                    n = min(len(total), len(part) - done)
                    total = total[:n] + powers[done] * part[done : done + n]
                    done += width
            if 2 * width > length:
                return total
            part = part[: len(part) - width] + powers[width] * part[width:]
            width *= 2


def least_of(x: np.ndarray, length: int) -> np.ndarray:
    """Least value of each run of ``length``, by doubling."""
    width = 1
    while 2 * width <= length:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = length - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def phrases(words: np.ndarray, owner: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """First window, number of windows, anchor, sequence hash and kind of every phrase of some
    documents in one row of words; ``owner`` tells the document of each word."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none, none.view(np.uint64), none.view(np.uint64), none
    gram = min(GRAM, window)
    grams = mixed(window_hashes(words, gram, FACTORS[0]))
    anchors = least_of(grams, window - gram + 1)
    whole = owner[: len(anchors)] == owner[window - 1 :]
    starts_new = np.ones(len(anchors), bool)
    starts_new[1:] = (anchors[1:] != anchors[:-1]) | ~whole[:-1]
    first = np.flatnonzero(starts_new & whole)
    # A phrase ends at the next start or at the last whole window of its document.
    edges = np.flatnonzero(starts_new | ~whole)
    following = np.append(edges, len(anchors))[np.searchsorted(edges, first) + 1]
    count = following - first
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(len(words) + 1, FACTORS[1], np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(words) * powers[:-1])])
        # A sum holds the powers of its place; they are taken out again.
        back = np.cumprod(np.full(len(words) + 1, INVERSE, np.uint64)) * FACTORS[1]
        sequence = (sums[first + count + window - 1] - sums[first]) * back[first]
        sequence = mixed(sequence + count.astype(np.uint64))
    # Two equal windows of one phrase hold its anchor twice, at most one phrase length apart.
    twice = [grams[:-d][grams[:-d] == grams[d:]] for d in range(1, window - gram + 2) if d < len(grams)]
    kind = np.where(np.isin(anchors[first], np.concatenate([grams[:0], *twice])), INSIDE, FIRST)
    return first, count, anchors[first], sequence, kind


def parsed(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """Phrases of the documents of a block: the first of each kind as they are, and the factors that
    phrases known to the block make up."""
    rows = sorted(
        zip(batch.column("doc_id").to_pylist(), batch.column("_text_hash").to_pylist(), batch.column("text").to_pylist()),
        key=lambda r: (r[0] is not None, r[0] or 0, r[1]),
    )
    # Repeated rows are one document.
    rows = [row for i, row in enumerate(rows) if i == 0 or row[:2] != rows[i - 1][:2]]
    split = [(row[2] or "").encode().split() for row in rows]
    sizes = np.array([len(x) for x in split], np.int64)
    words = np.concatenate([np.zeros(0, np.uint64), *map(word_hashes, split)])
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(rows)), sizes)
    first, count, anchor, sequence, kind = phrases(words, owner, window)
    order = np.lexsort((first, sequence, anchor))
    same = np.zeros(len(first), bool)
    a, s = anchor[order], sequence[order]
    same[order[1:]] = (a[1:] == a[:-1]) & (s[1:] == s[:-1])
    # Neighbours that are known are one factor.
    joined = np.zeros(len(first), bool)
    joined[1:] = same[1:] & same[:-1] & (first[1:] == first[:-1] + count[:-1])
    heads = np.flatnonzero(~joined)
    length = np.add.reduceat(count, heads) if len(heads) else count
    first, anchor, sequence, same, kind = (x[heads] for x in (first, anchor, sequence, same, kind))
    doc = owner[first] if len(first) else first
    start = first - base[doc] if len(first) else first
    spread = mixed(doc.astype(np.uint64) * FACTORS[0] + start.astype(np.uint64))
    anchor = np.where(same, spread, anchor)
    ids = pa.array([rows[d][0] for d in doc], pa.int64())
    hashes = pa.array([rows[d][1] for d in doc], pa.int64())
    kind = np.where(same, KNOWN, kind).astype(np.int32)
    return pa.record_batch(
        [
            ids, hashes, pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)),
            pa.array(kind), pa.array(anchor.view(np.int64)), pa.array(sequence.view(np.int64)),
        ],
        names=[*KEY, "start", "windows", "kind", "anchor", "sequence"],
    )


SPAN = "doc_id bigint, _text_hash bigint, start int, windows int, kind int"


def factors(docs: DataFrame, window: int) -> DataFrame:
    """Spans of windows: those that are known (``kind`` 0), and phrases that are the first of their
    kind but share their anchor with others (``kind`` 1)."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            yield parsed(batch, window)

    found = keyed(docs).mapInArrow(parse, f"{SPAN}, anchor bigint, sequence bigint")
    order = ["anchor", "sequence", *KEY, "start"]
    dealt = found.repartition("anchor").sortWithinPartitions(*order)
    # Equal rows have equal rank, so a row that the table repeats is not its own repeat.
    alike = W.partitionBy("anchor", "sequence").orderBy(*KEY, "start")
    block = W.partitionBy("anchor")
    ranked = dealt.withColumns(
        {
            "_nth": F.rank().over(alike),
            "_others": F.min("sequence").over(block) != F.max("sequence").over(block),
        }
    )
    known = (F.col("kind") == KNOWN) | (F.col("_nth") > 1)
    return ranked.filter(known | F.col("_others") | (F.col("kind") == INSIDE)).select(
        *KEY, "start", "windows", F.when(known, KNOWN).otherwise(FIRST).alias("kind")
    )


def checked(texts: DataFrame, open_spans: DataFrame, window: int) -> DataFrame:
    """Windows of open phrases that stand earlier in the corpus, as spans of one document each."""

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            yield hashed(batch, window)

    schema = "doc_id bigint, _text_hash bigint, start int, _known boolean, _one bigint, _two bigint"
    met = of_documents(texts, open_spans).mapInArrow(hashes, schema)
    order = ["_one", "_two", *KEY, "start"]
    alike = W.partitionBy("_one", "_two").orderBy(*KEY, "start")
    dealt = met.repartition("_one", "_two").sortWithinPartitions(*order)
    later = dealt.withColumn("_nth", F.rank().over(alike)).filter(F.col("_known") | (F.col("_nth") > 1))
    return later.select(*KEY, "start", F.lit(1).alias("windows"))


def hashed(batch: pa.RecordBatch, window: int) -> pa.RecordBatch:
    """The windows of open phrases of a block. Those that stand earlier in the block are ``_known``
    and get hashes of their own, so that the shuffle brings each window together once per block."""
    rows = list(zip(*(batch.column(c).to_pylist() for c in (*KEY, "text", "spans"))))
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    rows = [row for i, row in enumerate(rows) if i == 0 or row[:2] != rows[i - 1][:2]]
    starts, ones, twos = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    for _, _, text, spans in rows:
        words = word_hashes((text or "").encode().split())
        at = np.unique(np.concatenate([np.arange(s["start"], s["start"] + s["windows"]) for s in spans]))
        starts.append(at)
        ones.append(window_hashes(words, window, FACTORS[0])[at])
        twos.append(window_hashes(mixed(words), window, FACTORS[1])[at])
    owner = np.repeat(np.arange(len(rows)), [len(at) for at in starts[1:]])
    start, one, two = (np.concatenate(x) for x in (starts, ones, twos))
    order = np.lexsort((np.arange(len(one)), two, one))
    known = np.zeros(len(one), bool)
    known[order[1:]] = (one[order[1:]] == one[order[:-1]]) & (two[order[1:]] == two[order[:-1]])
    own = mixed(owner.astype(np.uint64) * FACTORS[0] + start.astype(np.uint64))
    one = np.where(known, own, one)
    return pa.record_batch(
        [
            pa.array([rows[i][0] for i in owner], pa.int64()), pa.array([rows[i][1] for i in owner], pa.int64()),
            pa.array(start.astype(np.int32)), pa.array(known), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
        ],
        names=[*KEY, "start", "_known", "_one", "_two"],
    )


def by_document(spans: DataFrame) -> DataFrame:
    """A row per document with all its ``spans``."""
    return spans.groupBy(*KEY).agg(F.collect_list(F.struct("start", "windows")).alias("spans"))


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``text`` of the words that stay, joined by a space, ``n_words`` and ``n_removed``
    for every row."""
    found = materialize(factors(docs, window), "factors")
    texts = keyed(docs).repartition(*KEY)
    windows = checked(texts, by_document(found.filter(F.col("kind") == FIRST)), window)
    known = found.filter(F.col("kind") == KNOWN).select(*KEY, "start", "windows")
    spans = by_document(known.unionAll(windows))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            kept, sizes, removed = [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                words = (text or "").encode().split()
                sizes.append(len(words))
                if gone:
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, [s["start"] for s in gone], 1)
                    np.add.at(change, [s["start"] + s["windows"] + window - 1 for s in gone], -1)
                    stays = np.flatnonzero(np.cumsum(change)[:-1] == 0)
                    removed.append(len(words) - len(stays))
                    words = [words[i] for i in stays]
                else:
                    removed.append(0)
                kept.append(b" ".join(words).decode())
            yield pa.record_batch(
                [
                    batch.column("doc_id"), pa.array(kept, pa.string()),
                    pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                ],
                names=["doc_id", "text", "n_words", "n_removed"],
            )

    schema = "doc_id bigint, text string, n_words bigint, n_removed bigint"
    return of_documents(texts, spans, "left").mapInArrow(keep, schema)
