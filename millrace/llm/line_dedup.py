"""Line dedup: which lines of a corpus repeat, as one compressed bitmap per document.

A line's key is the line without ASCII white space at its ends, A-Z in lower case. Keys travel as two
independent 64-bit hashes. The hashed lines are range-partitioned by hash, document and position and
sorted, so that a frequent line is divided over as many ranges as its rows fill. A stream over each
range keeps the first position of a line in each document; the documents of a line are then counted
with partial sums, one row per line and range. What goes on is positions, never text.

A keep bitmap is run-length encoded: the kept runs of line numbers as (``first``, ``lines``). NULL and
empty texts are one empty line. Keys shorter than ``min_chars`` never repeat. A NULL ``doc_id`` is an id
like any other; rows with the same id and text are one document, those with the same id and another
text are two, and repeated rows get equal bitmaps. An empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import KEY, SPACES, ascii_lower, bound, carried, keyed, of_documents, returned, text_of

HASHES = ["_h1", "_h2"]


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def hashed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """A row per line: document, position, and the two hashes of the line's key."""
    keys = F.transform(lines_of(text_of()), line_key)
    rows = keyed(docs).select(*KEY, F.posexplode(keys).alias("_line", "_key"))
    return rows.filter(F.char_length("_key") >= min_chars).select(
        *KEY, "_line", F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2")
    )


def repeated_lines(docs: DataFrame, min_docs: int, keep_first: bool, min_chars: int) -> DataFrame:
    """``_lines``, the sorted numbers of the lines that go, for documents that lose any."""
    ranged = (
        hashed_lines(docs, min_chars)
        .repartitionByRange(*HASHES, *KEY)
        .sortWithinPartitions(*HASHES, *KEY, "_line")
    )
    in_document = W.partitionBy(*HASHES, *KEY).orderBy("_line")
    firsts = ranged.withColumn("_nth", F.row_number().over(in_document)).filter("_nth = 1")
    found = [F.count("*").alias("_docs")]
    if keep_first:
        found.append(F.min(F.struct(*KEY, "_line")).alias("_first"))
    frequent = firsts.groupBy(*HASHES).agg(*found).filter(F.col("_docs") >= min_docs)
    going = ranged.join(frequent.drop("_docs"), HASHES)
    if keep_first:
        here = F.struct(*KEY, "_line")
        going = going.filter(~here.eqNullSafe(F.col("_first")))
    return going.groupBy(*KEY).agg(F.sort_array(F.collect_set("_line")).alias("_lines"))


def line_bitmaps(
    docs: DataFrame, min_docs: int = 2, keep_first: bool = True, min_chars: int = 1
) -> DataFrame:
    """Keep bitmaps: ``doc_id``, ``_text_hash``, ``n_lines``, ``n_dropped``, ``keep``.

    A line goes if its key stands in ``min_docs`` documents or more, everywhere or, with
    ``keep_first``, everywhere but in the first place by document and position.
    """
    gone = repeated_lines(docs, min_docs, keep_first, min_chars)
    sizes = keyed(docs).select(*KEY, F.size(lines_of(text_of())).alias("n_lines")).distinct()
    lines = F.coalesce("_lines", F.array().cast("array<int>"))
    gaps = F.zip_with(
        F.concat(F.array(F.lit(-1)), lines),
        F.concat(lines, F.array("n_lines")),
        lambda last, following: F.struct(
            (last + 1).alias("first"), (following - last - 1).alias("lines")
        ),
    )
    return of_documents(sizes, gone, "left").select(
        *KEY,
        F.col("n_lines").cast("bigint").alias("n_lines"),
        F.size(lines).cast("bigint").alias("n_dropped"),
        F.filter(gaps, lambda run: run["lines"] > 0).alias("keep"),
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Rows of ``docs`` with ``text`` made of the kept lines, and ``_bitmap``, their bitmap, in place of a
    column of that name. Rows that lose no line keep their text as it is, NULL included."""
    packed = bitmaps.select(*KEY, F.struct("n_lines", "n_dropped", "keep").alias("_bitmap"))
    columns = [c for c in docs.columns if c != "_bitmap"]
    rows = carried(docs).withColumn("_text_hash", F.xxhash64("text"))

    def of_runs(lines: Column) -> Column:
        kept = F.transform("_bitmap.keep", lambda run: F.slice(lines, run["first"] + 1, run["lines"]))
        return F.array_join(F.flatten(kept), "\n")

    # The text is split once, not once a run.
    left = bound(lines_of(text_of()), of_runs)
    text = F.when(F.col("_bitmap.n_dropped") == 0, F.col("text")).otherwise(left)
    kept = of_documents(rows, packed).withColumn("text", text)
    return returned(kept, columns, "_bitmap")
