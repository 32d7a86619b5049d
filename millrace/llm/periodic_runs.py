"""Periodic runs: stretches of words that repeat themselves with a period, as in text stuck in a loop.

Each document is searched with an enhanced suffix array over its words: suffix array, inverse and
common prefix lengths (LCP). An LCP interval of depth ``q`` holds the suffixes that share ``q`` words; if
suffixes ``i`` and ``i + q`` both lie in it, a square of period ``q`` starts at ``i``. For each interval the
suffixes of all children but the largest look for ``i + q`` and ``i - q`` in the inverse array, so a word is
looked up once a doubling of its interval at the most. Squares whose next word breaks the
period (branching ones) are rotated to the left as far as the period holds, which gives the run; squares
of a multiple of its period end in the same place and are left out. No tree is built: intervals are three
arrays from one pass over the LCP values.

A run of ``min_words`` words or more repeats half of that number of words, so documents whose suffixes
are told apart by fewer have none and need no array. The documents of a slice of a batch share one array, in
which suffixes of different documents never meet.

NULL, empty and blank texts have no words and no runs. Every row gives one row, repeated rows and NULL
ids too; an empty table gives none; columns other than ``doc_id`` and ``text`` are ignored. Nothing is
shuffled. A task holds one slice of ``READ_BYTES`` of text, or one longer text, at some 150 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.common import pieces

MIN_WORDS = 12
READ_BYTES = 4_000_000
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
# Words compared at once when a square is rotated.
STEP = 256


def coded(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """Words of each text, a number for each word of all texts, and where each text starts."""
    words = [(text or "").encode().split() for text in texts]
    numbers: dict[bytes, int] = {}
    flat = [numbers.setdefault(word, len(numbers)) for some in words for word in some]
    starts = np.concatenate([[0], np.cumsum([len(some) for some in words], dtype=np.int64)])
    return words, np.array(flat, np.int64), starts


def _dense(keys: np.ndarray) -> tuple[np.ndarray, int]:
    order = np.argsort(keys, kind="stable")
    steps = np.empty(len(keys), np.int64)
    steps[:1] = 0
    steps[1:] = keys[order[1:]] != keys[order[:-1]]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(steps)
    return ranks, int(steps.sum()) + 1


def ranked(codes: np.ndarray, starts: np.ndarray, words: int | None = None) -> list[np.ndarray]:
    """Ranks of all suffixes by document and their first 1, 2, 4 and so on words, until ``words`` or
    until all differ. A suffix that ends early ranks first."""
    size = len(codes)
    document = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    ends = starts[1:][document]
    ranks, distinct = _dense(document * (int(codes.max()) + 1) + codes)
    levels, width = [ranks], 1
    while distinct < size and (words is None or width < words):
        following = np.zeros(size, np.int64)
        here = np.flatnonzero(np.arange(size) + width < ends)
        following[here] = ranks[here + width] + 1
        ranks, distinct = _dense(ranks * (size + 1) + following)
        levels.append(ranks)
        width *= 2
    return levels


def lcp_of(levels: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in ``order``; 0 for the first."""
    one, other = order[:-1], order[1:]
    shared = np.zeros(len(one), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        # The place behind the last word equals none.
        ranks = np.append(levels[level], -1)
        shared += (ranks[one + shared] == ranks[other + shared]) << level
    return np.concatenate([[0], shared])


def lcp_intervals(lcp: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Depth, first and last place of every LCP interval of a depth of 1 or more, and the interval in
    which each place starts a child (-1: none)."""
    depths, firsts, lasts, owner = [], [], [], [-1] * len(lcp)
    open_ = []  # intervals that are not closed, from the outermost
    for place, depth in enumerate([*lcp[1:], 0], 1):
        first = place - 1
        while open_ and depths[open_[-1]] > depth:
            closed = open_.pop()
            lasts[closed] = place - 1
            first = firsts[closed]
        if depth:
            if not open_ or depths[open_[-1]] < depth:
                open_.append(len(depths))
                depths.append(depth)
                firsts.append(first)
                lasts.append(-1)
            owner[place] = open_[-1]
    return tuple(np.array(x, np.int64) for x in (depths, firsts, lasts, owner))


def _smaller_children(firsts: np.ndarray, lasts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all children of all intervals but the largest child of each, with their interval."""
    inner = np.flatnonzero(owner >= 0)
    interval = np.concatenate([owner[inner], np.arange(len(firsts))])
    first = np.concatenate([inner, firsts])
    order = np.lexsort((first, interval))
    interval, first = interval[order], first[order]
    last_child = np.append(interval[1:] != interval[:-1], True)
    sizes = np.where(last_child, lasts[interval] + 1, np.append(first[1:], 0)) - first
    by_size = np.lexsort((sizes, interval))
    largest = by_size[np.append(interval[by_size][1:] != interval[by_size][:-1], True)]
    small = np.ones(len(first), bool)
    small[largest] = False
    interval, first, sizes = interval[small], first[small], sizes[small]
    before = np.cumsum(sizes) - sizes
    places = np.arange(int(sizes.sum())) + np.repeat(first - before, sizes)
    return places, np.repeat(interval, sizes)


def branching_squares(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Rows (period, start) of all squares whose next word breaks the period."""
    levels = ranked(codes, starts)
    inverse = levels[-1]
    order = np.empty(len(codes), np.int64)
    order[inverse] = np.arange(len(codes))
    depths, firsts, lasts, owner = lcp_intervals(lcp_of(levels, order).tolist())
    places, interval = _smaller_children(firsts, lasts, owner)
    suffix, depth = order[places], depths[interval]
    squares = []
    for other, start in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
        inside = np.flatnonzero((other >= 0) & (other < len(codes)))
        rank, of = inverse[other[inside]], interval[inside]
        here = inside[(firsts[of] <= rank) & (rank <= lasts[of])]
        squares.append(np.stack([depth[here], start[here]], axis=1))
    found = np.unique(np.concatenate(squares), axis=0)
    if not len(found):
        return found
    period, start = found[:, 0], found[:, 1]
    end = start + 2 * period
    document = np.searchsorted(starts, start, "right") - 1
    last = end == starts[1:][document]
    breaks = last | (codes[np.minimum(end, len(codes) - 1)] != codes[end - period])
    return found[breaks]


def _rotated(codes: np.ndarray, period: int, start: int, least: int) -> int:
    """How far to the left, down to ``least``, the period of a square goes on."""
    step = STEP
    while start > least:
        low = max(least, start - step)
        differ = np.flatnonzero(codes[low:start] != codes[low + period : start + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        start, step = low, 2 * step
    return start


def runs_of(codes: np.ndarray, starts: np.ndarray, min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each document, by start and period; ``starts`` are the places of
    the documents in ``codes`` and the end of the last one."""
    runs = [[] for _ in starts[1:]]
    if not len(codes):
        return runs
    # Periods in ascending order: a square of a multiple of a period finds the run it belongs to.
    ending: dict[int, list[tuple[int, int]]] = {}
    for period, start in branching_squares(codes, starts).tolist():
        end = start + 2 * period
        known = ending.setdefault(end, [])
        if any(first <= start and period % q == 0 for first, q in known):
            continue
        document = int(np.searchsorted(starts, start, "right")) - 1
        least = int(starts[document])
        first = _rotated(codes, period, start, least)
        known.append((first, period))
        if end - first >= min_words:
            runs[document].append((first - least, end - first, period))
    return [sorted(some, key=lambda run: (run[0], run[2])) for some in runs]


def _runs(codes: np.ndarray, starts: np.ndarray, min_words: int) -> list[list[tuple[int, int, int]]]:
    """``runs_of``, without the documents that repeat too little to have any."""
    found = [[] for _ in starts[1:]]
    if not len(codes):
        return found
    enough = 1
    while 4 * enough <= min_words:
        enough *= 2
    ranks = ranked(codes, starts, enough)[-1]
    repeated = np.bincount(ranks)[ranks] > 1
    repeats = np.concatenate([[0], np.cumsum(repeated)])
    some = np.flatnonzero(repeats[starts[1:]] > repeats[starts[:-1]])
    if len(some):
        parts = [codes[starts[d] : starts[d + 1]] for d in some]
        places = np.concatenate([[0], np.cumsum([len(part) for part in parts])])
        for document, runs in zip(some, runs_of(np.concatenate(parts), places, min_words)):
            found[document] = runs
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without what any run holds after its first period."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    kept = np.flatnonzero(np.cumsum(gone)[:-1] == 0)
    return b" ".join([words[i] for i in kept])


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id``, ``text`` without the repetitions (the words that stay, with one space between them),
    ``n_words`` of the whole text, and its ``runs``, by start and period."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in pieces(batches, READ_BYTES):
            words, codes, starts = coded(batch.column("text").to_pylist())
            runs = _runs(codes, starts, min_words)
            texts = [collapsed(some, of).decode() for some, of in zip(words, runs)]
            named = [[{"start": s, "length": n, "period": q} for s, n, q in of] for of in runs]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(np.diff(starts)), pa.array(named, kind)],
                names=["doc_id", "text", "n_words", "runs"],
            )

    rows = docs.select("doc_id", "text")
    doc_id = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {doc_id}, text string, n_words bigint, runs {RUNS}")
