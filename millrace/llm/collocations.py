"""Collocations: phrases whose words stand together more often than chance would have it, by language.

Texts are in lower case (A-Z) and cut at punctuation and line breaks into pieces, which phrases do not
cross. Pieces are parsed prefix-free: wherever a hash of ``longest - 1`` consecutive words is a
trigger, one chunk ends with these words and the next one begins with them. Equal passages are so cut
into equal chunks. A block of text becomes a dictionary of its distinct chunks with their frequencies in the
parse. Phrases are counted inside distinct chunks, times the frequency of the chunk. A phrase
that starts in the overlap of two chunks belongs to the second one, and so counts once; one that
starts before it ends inside the first chunk.

A phrase cannot be more frequent than the word pairs in it. So word pairs are counted first, by hash
and one row a block, and each block is told which of its pairs are frequent anywhere. Then only phrases whose pairs
all are frequent are counted by their words, so hashes decide nothing but what is looked at. A pair has one row a block
at the most, however frequent it is. Blocks are rows of a table in the shared folder, compressed.

NULL texts are empty, a NULL language is ``und``. Repeated rows count as often as they stand there, and so do rows
with equal or NULL ids. Empty tables and texts give no rows; columns other than the text and the
language are ignored. A task holds one block of ``BLOCK_BYTES``, or one longer text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import pieces, text_of
from millrace.scratch import materialize

LONGEST = 5
MIN_COUNT = 100
TOP = 2_000
# Percent of a phrase's occurrences that lie in one longer candidate, from which on it is dropped.
ABSORBED = 100
# One window in so many is a trigger; no chunk has more words than MOST.
TRIGGERS, MOST = 16, 256
BLOCK_BYTES = 16_000_000
READ_BYTES = 4_000_000
EMITTED = 100_000
# Keys that a task gathers before it passes them on, block by block.
HELD = 2_000_000
# Signs that end a piece (fixed values), as a line break each.
BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\x0d", b"\n" * 9)
BLOCKS = "block bigint, lang string, chunks binary, counts binary, n_inner bigint"
COUNTS = "lang string, words int, phrase string, n bigint"


def chunks_of(words: list[bytes], overlap: int) -> list[tuple[bytes, bool]]:
    """The chunks of a piece and whether another one follows, which begins with the last ``overlap``
    words."""
    if len(words) <= 2 * overlap:
        return [(b" ".join(words), False)]
    found, begin = [], 0
    for at in range(1, len(words) - overlap + 1):
        if at - begin == MOST or zlib.crc32(b" ".join(words[at : at + overlap])) % TRIGGERS == 0:
            found.append((b" ".join(words[begin : at + overlap]), True))
            begin = at
    found.append((b" ".join(words[begin:]), False))
    return found


def add_chunks(text: bytes, overlap: int, inner: Counter, last: Counter) -> None:
    for piece in text.lower().translate(BREAKS).split(b"\n"):
        words = piece.split()
        if words:
            for chunk, followed in chunks_of(words, overlap):
                (inner if followed else last)[chunk] += 1


def blocks_of(docs: DataFrame, longest: int, block_bytes: int) -> DataFrame:
    """A row per block and language: its distinct chunks, first those that another one follows."""

    def packed(dictionaries: dict[str, tuple[Counter, Counter]], first: int) -> Iterator[pa.RecordBatch]:
        for block, (lang, (inner, last)) in enumerate(dictionaries.items(), first):
            if not inner and not last:
                continue
            lines = b"\n".join([*inner, *last])
            counts = np.array([*inner.values(), *last.values()], "<i8").tobytes()
            sizes = len(lines).to_bytes(8, "little"), len(counts).to_bytes(8, "little")
            row = [[block], [lang]] + [
                [size + pa.compress(data, codec="zstd", asbytes=True)] for size, data in zip(sizes, (lines, counts))
            ]
            kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip([*row, [len(inner)]], kinds)]
            yield pa.record_batch(columns, names=["block", "lang", "chunks", "counts", "n_inner"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, dictionaries = TaskContext.get().partitionId() << 32, 0, {}
        for batch in pieces(batches, READ_BYTES):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                inner, last = dictionaries.setdefault(lang, (Counter(), Counter()))
                data = text.encode()
                add_chunks(data, longest - 1, inner, last)
                held += len(data)
                if held >= block_bytes:
                    yield from packed(dictionaries, block)
                    block, held, dictionaries = block + len(dictionaries), 0, {}
        yield from packed(dictionaries, block)

    return materialize(docs.mapInArrow(run, BLOCKS), "chunks")


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _unpacked(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, codec="zstd", asbytes=True) if size else b""


class Block:
    """The chunks of a block, end to end: a number for each word, where the chunk of each word ends,
    how often it stands in the parse, and whether phrases that start there belong to the chunk."""

    def __init__(self, lang: str, chunks: bytes, counts: bytes, n_inner: int, overlap: int):
        numbers, lengths, codes = _Numbers(), [], []
        lines = _unpacked(chunks).split(b"\n")
        for line in lines:
            words = line.split(b" ")
            lengths.append(len(words))
            codes.extend(map(numbers.__getitem__, words))
        self.lang = lang
        self.codes = np.array(codes, np.int64)
        self.words = list(numbers)
        lengths = np.array(lengths, np.int64)
        ends = np.cumsum(lengths)
        self.ends = np.repeat(ends, lengths)
        self.times = np.repeat(np.frombuffer(_unpacked(counts), "<i8"), lengths)
        owned_to = ends - np.where(np.arange(len(lengths)) < n_inner, overlap, 0)
        self.owned = np.arange(len(codes)) < np.repeat(owned_to, lengths)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """For each word whether one follows it, and a hash of both and of the language."""
        from xxhash import xxh64_intdigest

        hashes = np.array([xxh64_intdigest(word) for word in self.words], np.uint64)[self.codes]
        follows = np.arange(1, len(hashes) + 1) < self.ends
        keys = hashes * np.uint64(0x9E3779B97F4A7C15) + np.uint64(xxh64_intdigest(self.lang.encode()))
        keys ^= keys >> np.uint64(29)
        keys[:-1] += hashes[1:]
        keys *= np.uint64(0xBF58476D1CE4E5B9)
        keys ^= keys >> np.uint64(32)
        return follows, keys.view(np.int64)

    def counted(self, frequent: np.ndarray, longest: int) -> Iterator[tuple[int, list[str], np.ndarray]]:
        """Number of words, phrases and counts: of all single words, and of the phrases of which all
        pairs have a hash in ``frequent``. No words stand for the total."""
        size, texts = len(self.codes), [word.decode() for word in self.words]
        yield 0, [""], np.array([self.times[self.owned].sum()])
        yield 1, texts, np.bincount(self.codes[self.owned], self.times[self.owned], len(texts)).astype(np.int64)
        follows, keys = self.pairs()
        here = follows & np.isin(keys, frequent)
        codes = self.codes
        for length in range(2, longest + 1):
            # Phrases of this length, by those one shorter that start here and at the next word.
            places = np.flatnonzero(here)
            if not len(places):
                return
            _, first, inverse = np.unique(codes[places] * size + codes[places + 1], return_index=True, return_inverse=True)
            times = np.where(self.owned[places], self.times[places], 0)
            counts = np.zeros(len(first), np.int64)
            np.add.at(counts, inverse, times)
            some = np.flatnonzero(counts)
            starts = places[first[some]]
            columns = [self.codes[starts + k].tolist() for k in range(length)]
            yield length, [" ".join([texts[c] for c in row]) for row in zip(*columns)], counts[some]
            codes = np.full(size, -1, np.int64)
            codes[places] = inverse
            here = here & np.append(here[1:], False)


def _blocks(batch: pa.RecordBatch | pa.Table, overlap: int) -> Iterator[tuple[int, Block]]:
    for row in batch.to_pylist():
        yield row.pop("block"), Block(**row, overlap=overlap)


def frequent_pairs(blocks: DataFrame, min_count: int, longest: int) -> DataFrame:
    """``block`` and ``keys``: hashes of pairs that stand there ``min_count`` times or more in all blocks
    together, for every block that holds them; a block may have several lists."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block in _blocks(batch, longest - 1):
                follows, keys = block.pairs()
                mine = follows & block.owned
                found, inverse = np.unique(keys[mine], return_inverse=True)
                times = np.zeros(len(found), np.int64)
                np.add.at(times, inverse, block.times[mine])
                for at in range(0, len(found), EMITTED):
                    some = slice(at, at + EMITTED)
                    columns = [found[some], np.full(len(found[some]), number), times[some]]
                    yield pa.record_batch([pa.array(c) for c in columns], names=["key", "block", "n"])

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by key; a key may go on in the next batch, with a row for each block it is in.
        rest, found, held = np.zeros((3, 0), np.int64), [], 0
        for batch in batches:
            rows = np.concatenate([rest, np.stack([batch.column(c).to_numpy() for c in ("key", "block", "n")])], axis=1)
            whole = int(np.searchsorted(rows[0], rows[0][-1])) if rows.shape[1] else 0
            found.append(enough(rows[:, :whole]))
            held += found[-1].shape[1]
            if held >= HELD:
                yield from by_block(np.concatenate(found, axis=1))
                found, held = [], 0
            rest = rows[:, whole:]
        yield from by_block(np.concatenate([*found, enough(rest)], axis=1))

    def enough(rows: np.ndarray) -> np.ndarray:
        """Keys and blocks of the keys that occur often enough in all their rows."""
        starts = np.flatnonzero(np.append(True, rows[0][1:] != rows[0][:-1])) if rows.shape[1] else np.zeros(0, np.int64)
        sums = np.add.reduceat(rows[2], starts) if rows.shape[1] else starts
        kept = np.repeat(sums >= min_count, np.diff(np.append(starts, rows.shape[1])))
        return rows[:2, kept]

    def by_block(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if rows.shape[1]:
            order = np.argsort(rows[1], kind="stable")
            numbers, starts = np.unique(rows[1][order], return_index=True)
            offsets = pa.array(np.append(starts, rows.shape[1]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(rows[0][order]))
            yield pa.record_batch([pa.array(numbers), lists], names=["block", "keys"])

    keys = blocks.mapInArrow(hashed, "key bigint, block bigint, n bigint")
    return keys.repartition("key").sortWithinPartitions("key").mapInArrow(frequent, "block bigint, keys array<bigint>")


def phrase_counts(
    docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``lang``, ``words`` (their number), ``phrase`` and ``n`` of all phrases of up to ``longest`` words that
    occur ``min_count`` times or more in a language, and of all words of the language, as 0 words."""
    texts = docs.select(text_of().alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    blocks = blocks_of(texts, longest, block_bytes)

    def run(block: pa.Table, frequent: pa.Table) -> pa.Table:
        keys = frequent.column("keys").combine_chunks().flatten().to_numpy()
        tables = [pa.table({name: pa.array([], kind) for name, kind in schema.items()})]
        for _, one in _blocks(block, longest - 1):
            for length, phrases, counts in one.counted(keys, longest):
                size = len(phrases)
                columns = [[one.lang] * size, np.full(size, length, np.int32), phrases, counts]
                tables.append(pa.table({n: pa.array(c, k) for (n, k), c in zip(schema.items(), columns)}))
        return pa.concat_tables(tables)

    schema = {"lang": pa.string(), "words": pa.int32(), "phrase": pa.string(), "n": pa.int64()}
    pairs = frequent_pairs(blocks, min_count, longest)
    counted = blocks.groupBy("block").cogroup(pairs.groupBy("block")).applyInArrow(run, COUNTS)
    total = counted.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))
    return total.filter((F.col("n") >= min_count) | (F.col("words") == 0))


def exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), with up to 38 digits in between."""
    wide = lambda c: c.cast("decimal(18,0)")
    over = F.lit(1000).cast("decimal(4,0)") * (wide(a) * wide(n))
    return F.call_function("div", over, wide(left) * wide(right))


def collocations(
    docs: DataFrame,
    min_count: int = MIN_COUNT,
    longest: int = LONGEST,
    top: int = TOP,
    absorbed: int = ABSORBED,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, its count ``a``, the counts ``l`` and
    ``r`` of the parts at its weakest cut, ``n`` words in the language, ``score``."""
    counts = materialize(phrase_counts(docs, min_count, longest, block_bytes), "phrases")
    candidates = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("n").alias("a"))
    split = F.split("phrase", " ")
    part = lambda first, size: F.array_join(F.slice(split, first, size), " ")
    k = F.col("_k")
    cuts = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("_k")).select(
        "lang", "phrase", "a", "_k", part(F.lit(1), k).alias("_left"), part(k + 1, F.col("words") - k).alias("_right")
    )
    of = lambda name, count: counts.filter("words >= 1").select(
        "lang", F.col("phrase").alias(name), F.col("n").alias(count)
    )
    # A table of its own, whose size says whether it is broadcast.
    totals = materialize(counts.filter("words = 0").select("lang", F.col("n").alias("_total")), "totals")
    scored = cuts.join(of("_left", "l"), ["lang", "_left"]).join(of("_right", "r"), ["lang", "_right"]).join(totals, "lang")
    score = exact_score(F.col("a"), F.col("_total"), F.col("l"), F.col("r"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "_k", "l", "r", F.col("_total").alias("n"))).alias("_cut")
    )
    # What lies inside each longer candidate.
    sizes = F.sequence(F.lit(2), F.col("words") - 1)
    inside = F.transform(sizes, lambda size: F.transform(
        F.sequence(F.lit(1), F.col("words") - size + 1), lambda first: part(first, size)
    ))
    within = candidates.filter("words > 2").select("lang", "a", F.explode(F.array_distinct(F.flatten(inside))).alias("phrase"))
    most = within.groupBy("lang", "phrase").agg(F.max("a").alias("_within"))
    kept = weakest.join(most, ["lang", "phrase"], "left").filter(
        F.col("_within").isNull() | (100 * F.col("_within") < absorbed * F.col("a"))
    )
    order = W.partitionBy("lang").orderBy(F.desc("_cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "_cut.l", "_cut.r", "_cut.n", "_cut.score"
    )
