"""A training corpus from ``documents``, stage by stage.

Every stage works on all rows the one before it kept. A stage returns the columns of its input, the
last one the pieces of documents in training windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import carried, returned
from millrace.llm.decontamination import without_leaks
from millrace.llm.encoding import vocabulary
from millrace.llm.language import fit, predict
from millrace.llm.line_dedup import apply_bitmaps, line_bitmaps
from millrace.llm.near_copies import one_of_near
from millrace.llm.packing import pack_documents
from millrace.llm.simhash import first_of_each
from millrace.scratch import materialize
from millrace.tables import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that centroids of the labelled documents know."""
    found = predict(carried(docs), fit(docs), "_language")
    return returned(found.filter(~F.col("_language.rejected")), docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in ten documents or more, but for the first place of each
    line: of ten copies of a text the first one keeps it. ``n_chars`` follows."""
    kept = apply_bitmaps(carried(docs), line_bitmaps(docs, min_docs=10, keep_first=True))
    kept = returned(kept, docs.columns)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, by fingerprint, and of those one of each class
    of near copies, by the shingles they share."""
    return one_of_near(docs, materialize(first_of_each(docs), "first"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in windows of 4,096 ids."""
    return pack_documents(docs, vocabulary())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)


#: Language ID fits centroids, near-dedup hashes bits of words and packing encodes; SQL expresses none.
ORACLE_SQL = None
