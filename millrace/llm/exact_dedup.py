"""Exact dedup: a stream that remembers every text it has met, and the check of its hits.

Documents stream in from Parquet files. Keyed state, in RocksDB on disk and never expired, holds for each digest of
a text how many rows had it, the stable id of the row that stays, and where its content is: file and row. So
files that arrive later are compared with all before them, at a state of some hundred bytes a distinct text.
Equal digests are combined before the shuffle, so a text that a third of all rows share is one row a task.

A digest is no proof. Rows whose digest other rows share are compared, byte by byte, with the content of the row
that stays, found by its locator; where a digest stands for different texts, its rows
are grouped by the texts themselves. Rows that are alone with their digest are not compared.

NULL counts as the empty text. Of equal texts the row with the largest ``doc_id`` stays; NULL is the least id; of rows
with equal ids the one that is last by file and row stays, so of repeated rows exactly one. An empty table gives no
rows; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import text_of
from millrace.scratch import materialize
from millrace.session import SHUFFLE_PARTITIONS
from millrace.streaming.run import finish, read_state, to_state

FILES_PER_TRIGGER = 10_000

Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    """SHA-256, 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def _located(rows: DataFrame, digest: Digest) -> DataFrame:
    """Rows with ``digest`` and ``row``: the id, and the file and row that hold the content."""
    place = rows.metadataColumn("_metadata")
    row = F.struct("doc_id", place["file_path"].alias("file"), place["row_index"].alias("at"))
    return rows.select(digest(text_of()).alias("digest"), row.alias("row"), text_of().alias("text"))


def remember(
    spark: SparkSession, path: str, checkpoint: str, digest: Digest = sha256, files: int = FILES_PER_TRIGGER
) -> DataFrame:
    """Take in the files below ``path`` that ``checkpoint`` has not met, ``files`` at a time; what is known
    then: ``digest``, ``n`` rows and ``keep``, the row that stays."""
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    # A session of its own, so that the settings of the stream are not those of the caller.
    own = spark.newSession()
    own.conf.set(SHUFFLE_PARTITIONS, spark.conf.get(SHUFFLE_PARTITIONS))
    # A store of some rows takes their room on disk, not 4 MB.
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # As a pattern, which may name a file; a plain path of a stream has to be a folder.
    folder, name = path.rstrip("/")[:-1], path.rstrip("/")[-1:]
    stream = own.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{folder}[{name}]")
    met = _located(stream, digest).groupBy("digest").agg(F.count("*").alias("n"), F.max("row").alias("keep"))
    finish(to_state(met, checkpoint))
    return read_state(spark, checkpoint).withColumnsRenamed({"count": "n", "max": "keep"})


def settled(rows: DataFrame, known: DataFrame) -> DataFrame:
    """What is known of each of ``rows`` (``digest``, ``row``, ``text``), after a look at the bytes of
    those that share a digest: ``row``, ``digest``, ``keep`` and ``n``."""
    shared = F.col("n") > 1
    met = rows.join(known, "digest").select("digest", "row", "keep", "n", F.when(shared, F.col("text")).alias("text"))
    met = materialize(met, "met")
    hits = met.filter(shared)
    stays = F.col("row") == F.col("keep")
    content = hits.filter(stays).select("digest", F.col("text").alias("_kept"))
    checked = hits.join(content, "digest").select("digest", "row", "keep", "n", (F.col("text") == F.col("_kept")).alias("_same"))
    checked = materialize(checked, "checked")
    columns = ["row", "digest", "keep", "n"]
    alone = met.filter(F.col("n") == 1).select(*columns)
    collided = materialize(checked.filter(~F.col("_same")).select("digest").distinct(), "collided")
    if collided.isEmpty():
        return alone.unionAll(checked.select(*columns))
    sound = checked.join(collided, "digest", "left_anti").select(*columns)
    mixed = hits.join(collided, "digest", "left_semi").select("row", "digest", "text")
    texts = mixed.groupBy("digest", "text").agg(F.max("row").alias("keep"), F.count("*").alias("n"))
    return alone.unionAll(sound).unionAll(mixed.join(texts, ["digest", "text"]).select(*columns))


def exact_duplicates(spark: SparkSession, path: str, checkpoint: str, digest: Digest = sha256) -> DataFrame:
    """For every row of the Parquet files below ``path``: ``doc_id``, ``keep_id`` of the row that stays in
    its place, ``group_size``, ``kept``, and ``digest``. Started again with the same ``checkpoint``, it reads
    only new files for the state."""
    known = remember(spark, path, checkpoint, digest)
    schema = spark.read.parquet(path).select("doc_id", "text").schema
    found = settled(_located(spark.read.schema(schema).parquet(path), digest), known)
    return found.select(
        "row.doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep")).alias("kept"),
        "digest",
    )
