"""What the operators of this folder share.

A *document* is a row with ``doc_id`` and ``text``; other columns are not looked at. Two rows are the
same document if both values agree (NULL equals NULL), so rows that repeat get the same verdict and
count once, and rows that share an id but not a text are told apart. ``keyed`` adds the
hash of the text that does so, and ``of_documents`` joins by both.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ASCII white space, as a character class and as the characters themselves. bytes.split() of Python
# splits at just these.
SPACE = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

KEY = ["doc_id", "_text_hash"]


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``_text_hash`` and ``text``, NULL texts as they are."""
    return docs.select("doc_id", F.xxhash64("text").alias("_text_hash"), "text")


def carried(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and all other columns as one, ``_carried``, so that no name among them can meet
    a name that an operator uses. ``returned`` puts them back."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(*others).alias("_carried") if others else F.lit(None).alias("_carried"))


def returned(rows: DataFrame, columns: list[str], *added: str) -> DataFrame:
    """Rows of ``carried`` with the columns of the documents, in their order, and those that were ``added``."""
    return rows.select(
        *[F.col(c) if c in ("doc_id", "text") else F.col(f"_carried.`{c}`").alias(c) for c in columns], *added
    )


# KEY without NULL, for joins and groups that then need no second shuffle.
PLAIN_KEY = ["_no_id", "_id", "_text_hash"]


def plainly_keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {"_no_id": F.col("doc_id").isNull(), "_id": F.coalesce("doc_id", F.lit(0)), "_text_hash": F.xxhash64("text")}
    )


def named_plainly(keys: DataFrame) -> DataFrame:
    """The columns of KEY as those of ``PLAIN_KEY``."""
    return keys.select(F.col("doc_id").isNull().alias("_no_id"), F.coalesce("doc_id", F.lit(0)).alias("_id"), "_text_hash")


def rows_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs``, with all its columns, for each document in ``kept`` (columns of KEY, once each); any of rows
    that repeat. All rows pass one shuffle, whatever the size of ``kept``."""
    rows = plainly_keyed(carried(docs)).hint("merge")
    return returned(rows.join(named_plainly(kept), PLAIN_KEY, "left_semi").dropDuplicates(PLAIN_KEY), docs.columns)


def matched(left: DataFrame, right: DataFrame, names: list[str], how: str = "inner") -> DataFrame:
    """Join on columns that both sides have, NULL equal to NULL; they come out once, from the left."""
    right = right.withColumnsRenamed({name: f"_right_{name}" for name in names})
    on = [F.col(name).eqNullSafe(F.col(f"_right_{name}")) for name in names]
    return left.join(right, on, how).drop(*[f"_right_{name}" for name in names])


def of_documents(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """``left`` with what ``right``, one row per document, says about each of its rows."""
    return matched(left, right, KEY, how)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(value: Column) -> Column:
    """A-Z in lower case, all else as it is. ``lower`` does the same on texts of ASCII alone, which
    are those with as many bytes as characters, and is faster."""
    plain = F.octet_length(value) == F.char_length(value)
    return F.when(plain, F.lower(value)).otherwise(F.translate(value, UPPER, LOWER))


def words_of(value: Column) -> Column:
    """Words between ASCII white space, as an array, empty for a text without any."""
    trimmed = F.btrim(value, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE + "+", -1)
    )


def bound(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)``, with the value computed once, however often and wherever ``make`` names it: an expression inside
    a function over array elements is computed anew for every element."""
    return F.get(F.transform(F.array(value), make), F.lit(0))


def sums_before(lengths: Column, step: int = 256) -> Column:
    """For each of an array of integers the sum of those before it.

    Sums are made in runs of ``step`` and the runs then put together, because an array that grows one by one is copied
    one by one: a text with 50,000 matches takes 200 steps of each kind, not 50,000."""
    return bound(lengths, lambda held: _sums_before(held, step))


def _sums_before(lengths: Column, step: int) -> Column:
    none = F.array().cast("array<int>")
    start = F.struct(F.lit(0).alias("at"), none.alias("sums"))

    def one_more(done: Column, length: Column) -> Column:
        return F.struct((done["at"] + length).alias("at"), F.concat(done["sums"], F.array(done["at"])).alias("sums"))

    def one_run(done: Column, run: Column) -> Column:
        moved = F.transform(run["sums"], lambda s: s + done["at"])
        return F.struct((done["at"] + run["at"]).alias("at"), F.concat(done["sums"], moved).alias("sums"))

    last = F.floor((F.size(lengths) - 1) / step).cast("int")
    runs = F.transform(F.sequence(F.lit(0), last), lambda k: F.aggregate(F.slice(lengths, k * step + 1, F.lit(step)), start, one_more))
    return F.when(F.size(lengths) > 0, F.aggregate(runs, start, one_run, lambda done: done["sums"])).otherwise(none)


def pieces(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``size`` bytes of text, at least one row each, so that what a
    task holds depends neither on the rows of a batch nor on the length of their texts."""
    for batch in batches:
        texts = batch.column(column)
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        first, held = 0, 0
        for row, length in enumerate(lengths):
            if held and held + length > size:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += length
        if first < len(lengths):
            yield batch.slice(first)
