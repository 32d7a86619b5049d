"""Token counts that follow edits.

A document is cut in front of white space into leaves of some hundred characters; pre-tokens never
cross one. A segment tree over the leaves holds characters and ids of each subtree. An edit
finds its leaves by the characters; leaves that edits touch side by side, and the leaf before them where the edited text
no longer begins with white space, are one run, which is encoded once, however many edits it has. Then the sums above
follow. All else keeps its count. Text without white space, of any length, is one leaf.

Texts that are NULL count as empty: one leaf without ids. Edits are taken in order of ``start`` and
``end``; they name code points of the text before any edit. One that begins before the last one ended,
ends before it begins or lies outside the text is left out. NULL edits and NULL replacements are none and "". Rows are
edited on their own, so ids may be NULL or repeat; other columns pass through where names do not
clash with ``tree``, ``n_tokens`` or ``n_encoded``, which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import SPACE, bound, pieces, sums_before, text_of
from millrace.llm.encoding import encoder

LEAF = 256
READ_BYTES = 4_000_000
TREE = "struct<chars:array<int>,tokens:array<int>>"
BREAK = re.compile(SPACE)


def leaves(text: str, size: int) -> list[str]:
    """The text in pieces of at least ``size`` characters, all but the first beginning with white
    space."""
    found, start = [], 0
    while True:
        cut = BREAK.search(text, start + size)
        if cut is None:
            return [*found, text[start:]]
        found.append(text[start : cut.start()])
        start = cut.start()


class Tree:
    """Sums of characters and of ids over the leaves; node 1 is the root, ``size`` the first leaf."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.size = len(chars) // 2

    @classmethod
    def over(cls, chars: list[int], tokens: list[int]) -> Tree:
        size = 1 << (len(chars) - 1).bit_length()
        sums = np.zeros((2, 2 * size), np.int32)
        sums[:, size : size + len(chars)] = chars, tokens
        level = size
        while level > 1:
            sums[:, level // 2 : level] = sums[:, level : 2 * level : 2] + sums[:, level + 1 : 2 * level : 2]
            level //= 2
        return cls(sums[0], sums[1])

    def leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and the leaf's first character. The last leaf with
        characters holds the end of the text."""
        node, first = 1, 0
        position = min(position, max(int(self.chars[1]) - 1, 0))
        while node < self.size:
            node *= 2
            if position >= first + self.chars[node]:
                first += int(self.chars[node])
                node += 1
        return node - self.size, first

    def put(self, leaf: int, chars: int, tokens: int) -> None:
        node = leaf + self.size
        by = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += by[0]
            self.tokens[node] += by[1]
            node //= 2


def with_trees(docs: DataFrame, vocabulary: str, leaf: int = LEAF) -> DataFrame:
    """Rows with the ``tree`` of their text and ``n_tokens``, its root."""
    docs = docs.drop("tree", "n_tokens")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in pieces(batches, READ_BYTES):
            trees = []
            for text in batch.column("text").to_pylist():
                cut = leaves(text or "", leaf)
                trees.append(Tree.over([len(x) for x in cut], [len(encode(x)) // 4 for x in cut]))
            yield with_columns(batch, {"tree": tree_column(trees), "n_tokens": roots(trees)})

    return docs.mapInArrow(build, f"{fields}, tree {TREE}, n_tokens bigint")


def apply_edits(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Rows with a ``tree`` and ``edits`` (an array of start, end, replacement), edited: ``text``,
    ``tree`` and ``n_tokens`` are those after the edits, ``n_encoded`` the characters encoded for
    them."""
    docs = docs.drop("n_encoded")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in pieces(batches, READ_BYTES):
            texts, trees, encoded = [], [], []
            tree = batch.column("tree")
            chars, tokens = tree.field("chars"), tree.field("tokens")
            for row, (text, edits) in enumerate(
                zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist())
            ):
                held = Tree(*(np.array(x[row].values.to_numpy(), np.int32) for x in (chars, tokens)))
                text, n = edited(text, held, edits, encode) if edits else (text, 0)
                texts.append(text)
                trees.append(held)
                encoded.append(n)
            yield with_columns(
                batch,
                {
                    "text": pa.array(texts, pa.string()),
                    "tree": tree_column(trees),
                    "n_tokens": roots(trees),
                    "n_encoded": pa.array(encoded, pa.int64()),
                },
            )

    return docs.mapInArrow(change, f"{fields}, n_encoded bigint")


def edited(text: str | None, tree: Tree, edits: list[dict], encode) -> tuple[str, int]:
    """The text after the edits, whose tree follows, and the number of characters encoded."""
    text = text or ""
    taken, last = [], 0
    usable = [e for e in edits if e and e["start"] is not None and e["end"] is not None]
    for edit in sorted(usable, key=lambda e: (e["start"], e["end"], e["replacement"] or "")):
        if last <= edit["start"] <= edit["end"] <= len(text):
            taken.append(edit)
            last = edit["end"]
    # Runs of leaves with their text after the edits: neighbours that edits touch are one run, and so is a leaf
    # before one that no longer begins with white space. Positions are those before any edit, which the tree knows.
    bounds = np.concatenate([[0], np.cumsum(tree.chars[tree.size :])])
    runs: list[tuple[int, int, str]] = []
    at = 0
    while at < len(taken):
        low, first = tree.leaf_at(taken[at]["start"])
        high, here, parts = low, first, []
        while at < len(taken) and (not parts or tree.leaf_at(taken[at]["start"])[0] <= high):
            edit = taken[at]
            parts += [text[here : edit["start"]], edit["replacement"] or ""]
            here = edit["end"]
            high = max(high, tree.leaf_at(max(edit["start"], edit["end"] - 1))[0])
            at += 1
        region = "".join([*parts, text[here : int(bounds[high + 1])]])
        while low and not BREAK.match(region):
            if runs and runs[-1][1] == low - 1:
                low, _, before = runs.pop()
                region = before + region
            else:
                low -= 1
                region = text[int(bounds[low]) : int(bounds[low + 1])] + region
        runs.append((low, high, region))
    pieces_, here = [], 0
    for low, high, region in runs:
        pieces_ += [text[here : int(bounds[low])], region]
        here = int(bounds[high + 1])
        tree.put(low, len(region), len(encode(region)) // 4)
        for leaf in range(low + 1, high + 1):
            tree.put(leaf, 0, 0)
    return "".join([*pieces_, text[here:]]), sum(len(region) for *_, region in runs)


def tree_column(trees: list[Tree]) -> pa.Array:
    ends = np.cumsum([0, *[len(t.chars) for t in trees]]).astype(np.int32)
    lists = [
        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([getattr(t, f) for t in trees])))
        for f in ("chars", "tokens")
    ]
    return pa.StructArray.from_arrays(lists, ["chars", "tokens"])


def roots(trees: list[Tree]) -> pa.Array:
    return pa.array([int(t.tokens[1]) for t in trees], pa.int64())


def with_columns(batch: pa.RecordBatch, new: dict[str, pa.Array]) -> pa.RecordBatch:
    columns = {name: batch.column(name) for name in batch.schema.names} | new
    return pa.record_batch(list(columns.values()), names=list(columns))


def replacements(pattern: str, new: str, text: Column | None = None) -> Column:
    """Edits that put ``new`` in place of every match of a Java regular expression."""
    text = text_of() if text is None else text
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found")
    )
    return bound(parts, lambda held: _edits(held["gaps"], held["found"], new))


def _edits(between: Column, found: Column, new: str) -> Column:
    gaps = F.slice(between, F.lit(1), F.size(found))
    lengths = F.zip_with(gaps, found, lambda gap, hit: F.length(gap) + F.length(hit))
    each = F.arrays_zip(gaps.alias("gap"), found.alias("hit"), sums_before(lengths).alias("at"))

    def edit(x: Column) -> Column:
        start = x["at"] + F.length(x["gap"])
        return F.struct(start.alias("start"), (start + F.length(x["hit"])).alias("end"), F.lit(new).alias("replacement"))

    return F.transform(each, edit).cast("array<struct<start:int,end:int,replacement:string>>")
