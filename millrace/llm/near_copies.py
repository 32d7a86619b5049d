"""Near copies: texts whose sets of word shingles have a Jaccard index of ``SHARE`` or more.

MinHash bands propose, shingle sets decide. A text has ``BANDS`` keys of ``ROWS`` least hashes each; a pair at
the share shares none of them with a probability of (1 - 0.8 ^ 4) ^ 24 = 3e-6. In ``SINGLE`` first rounds a
document meets the smallest member, by id, of one of its buckets, and leaves all buckets that it shares with a member it is
near to, which stands for it there. Then members of a bucket are
compared with its smallest members: one in the first round, four times as many in each further
one, until all have been a leader or have met one that they are near to. So a large group of near copies costs about one
comparison a member and round, not one a pair or bucket, and of the smallest documents of all classes no two that share
a bucket are near copies: a smallest document never leaves a bucket for another.

Texts that are alike but for white space at word bounds and case have equal sets. Texts without words
are in no bucket. NULL ids come last. Rows that repeat are one document; other columns are kept as they are, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import KEY, PLAIN_KEY, keyed, pieces, plainly_keyed, rows_of
from millrace.llm.components import components
from millrace.llm.simhash import READ_BYTES, shingle_hashes
from millrace.scratch import materialize, scratch_path

SHINGLE = 5
SHARE = 0.8
BANDS, ROWS = 24, 4
SINGLE = 2
STEP = 4_096
NODE = "struct<none: boolean, id: bigint, hash: bigint>"
_DRAWN = np.random.default_rng(11).integers(0, 1 << 64, (2, BANDS * ROWS), np.uint64)
FLIPS, FACTORS = _DRAWN[0], _DRAWN[1] | np.uint64(1)


def bands(hashes: np.ndarray) -> list[int]:
    """The keys of a set of shingle hashes, signed; the number of the band is part of each."""
    from xxhash import xxh64_intdigest

    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for first in range(0, len(hashes), STEP):
        some = (hashes[first : first + STEP, None] ^ FLIPS) * FACTORS
        np.minimum(least, (some ^ (some >> np.uint64(32))).min(axis=0), out=least)
    keys = [xxh64_intdigest(row.tobytes(), band) for band, row in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def _node() -> Column:
    """A document as one value without NULL, so that nodes compare and join like numbers."""
    fields = {"none": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0)).cast("bigint"), "hash": F.col("_text_hash")}
    return F.struct(*[value.alias(name) for name, value in fields.items()]).alias("_node")


def _marked(docs: DataFrame) -> DataFrame:
    """``_node`` and ``_bands`` of texts that have any words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            sets = [np.unique(np.array(shingle_hashes(t, SHINGLE), np.uint64)) for t in batch.column("text").to_pylist()]
            keys = pa.array([bands(s) if len(s) else [] for s in sets], pa.list_(pa.int64()))
            yield pa.record_batch([batch.column("_node"), keys], names=["_node", "_bands"])

    rows = keyed(docs).select(_node(), "text")
    return rows.mapInArrow(run, f"_node {NODE}, _bands array<bigint>")


def _shingles(rows: DataFrame) -> DataFrame:
    """``_node``, ``_n`` and ``_set``, the sorted hashes of the shingles, of rows with ``_node`` and ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, READ_BYTES):
            sets = [
                np.unique(np.array(shingle_hashes(t, SHINGLE), np.uint64)).view(np.int64)
                for t in batch.column("text").to_pylist()
            ]
            columns = [batch.column("_node"), pa.array([len(s) for s in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["_node", "_n", "_set"])

    return rows.mapInArrow(run, f"_node {NODE}, _n bigint, _set array<bigint>")


def _near(share: float) -> Column:
    """Whether the two sets of a pair are near copies. As a condition of a join it leaves no row for pairs that are not."""
    both = F.size(F.array_intersect("_set", "_lead_set"))
    sizes = F.least("_n", "_lead_n") >= share * F.greatest("_n", "_lead_n") - 1e-9
    return (F.col("_lead") < F.col("_node")) & sizes & (both * (1 + share) >= share * (F.col("_n") + F.col("_lead_n")) - 1e-9)


def _as_leads(rows: DataFrame) -> DataFrame:
    return rows.withColumnsRenamed({"_node": "_lead", "_n": "_lead_n", "_set": "_lead_set"})


def _shared(buckets: DataFrame) -> DataFrame:
    """Rows of buckets that have more than one."""
    many = buckets.groupBy("_bucket").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    return buckets.join(many.select("_bucket"), "_bucket", "left_semi")


def _met_by_one(left: DataFrame, turn: int) -> DataFrame:
    """``_node`` and ``_lead``: the smallest member of one bucket of each document, another one each turn. Documents with the
    same buckets choose the same one."""
    rank = F.struct(F.xxhash64("_bucket", F.lit(turn)).alias("_rank"), "_bucket")
    chosen = left.groupBy("_node").agg(F.min(rank)["_bucket"].alias("_bucket"))
    leads = left.groupBy("_bucket").agg(F.min("_node").alias("_lead"))
    return chosen.join(leads, "_bucket").filter(F.col("_lead") < F.col("_node")).select("_node", "_lead")


def _without_shared(left: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of buckets without the documents in ``found``, once each, where their lead is a member too."""
    buckets = left.groupBy("_node").agg(F.collect_list("_bucket").alias("_buckets"))
    theirs = buckets.select(F.col("_node").alias("_lead"), F.col("_buckets").alias("_lead_buckets"))
    both = buckets.join(found, "_node", "left").join(theirs, "_lead", "left")
    stay = F.when(F.col("_lead").isNull(), F.col("_buckets")).otherwise(F.array_except("_buckets", "_lead_buckets"))
    return both.select("_node", F.explode(stay).alias("_bucket"))


def near_copies(docs: DataFrame, among: DataFrame | None = None, share: float = SHARE) -> DataFrame:
    """Verified links ``a`` and ``b`` over the nodes of the documents in ``among`` (columns of KEY, once each), by default all.

    Bands are made where the texts are; only those of texts that share a bucket are asked for again, once, for
    their shingles. What the rounds move are nodes and shingle hashes. Members of a bucket that are near to none of its
    leaders are compared in the join itself, so that no row is written for them; there are as many of these comparisons as pairs.
    """
    marked = _marked(docs)
    if among is not None:
        marked = marked.join(among.select(_node()), "_node", "left_semi")
    marked = materialize(marked.dropDuplicates(["_node"]), "bands")
    left = materialize(_shared(marked.select("_node", F.explode("_bands").alias("_bucket"))), "buckets")
    candidates = materialize(left.select("_node").distinct(), "candidates")
    names = {"_no_id": "none", "_id": "id", "_text_hash": "hash"}
    asked = candidates.select(*[F.col(f"_node.{field}").alias(name) for name, field in names.items()])
    texts = plainly_keyed(docs.select("doc_id", "text")).hint("merge").join(asked, PLAIN_KEY, "left_semi").dropDuplicates(PLAIN_KEY)
    shingles = materialize(_shingles(texts.select(_node(), "text")), "shingles")
    found_links, leaders = scratch_path(docs.sparkSession, "near"), 1
    links = lambda found: found.select(F.col("_node").alias("a"), F.col("_lead").alias("b")).write.mode("append").parquet(found_links)
    for turn in range(SINGLE):
        met = materialize(_met_by_one(left, turn), "met")
        if turn and met.isEmpty():
            break
        met = met.join(shingles, "_node").join(_as_leads(shingles), "_lead")
        found = materialize(met.filter(_near(share)).select("_node", "_lead"), "found")
        links(found)
        left = materialize(_shared(materialize(_without_shared(left, found), "buckets")), "buckets")
    nth = W.partitionBy("_bucket").orderBy("_node")
    while not left.isEmpty():
        leads = left.withColumn("_nth", F.row_number().over(nth)).filter(F.col("_nth") <= leaders)
        leads = materialize(leads.select("_bucket", "_node"), "leads")
        theirs = _as_leads(leads.join(shingles, "_node")).withColumnRenamed("_bucket", "_lead_bucket")
        met = left.join(shingles, "_node").join(theirs, (F.col("_bucket") == F.col("_lead_bucket")) & _near(share))
        found = materialize(met.select("_bucket", "_node", "_lead"), "found")
        links(found.select("_node", "_lead").distinct())
        settled = found.select("_bucket", "_node").unionAll(leads).distinct()
        left = materialize(_shared(left.join(settled, ["_bucket", "_node"], "left_anti")), "buckets")
        leaders *= 4
    return docs.sparkSession.read.schema(f"a {NODE}, b {NODE}").parquet(found_links)


def one_of_near(docs: DataFrame, among: DataFrame | None = None, share: float = SHARE) -> DataFrame:
    """The row with the smallest id of each class of near copies, with all its columns; any of rows that repeat.

    ``among`` names the documents to choose from (columns of KEY, once each); others are left out. By default
    all are."""
    if among is None:
        among = keyed(docs).select(*KEY).distinct()
    among = materialize(among, "among")
    gone = components(near_copies(docs, among, share)).select(F.col("node").alias("_node"))
    kept = among.withColumn("_node", _node()).join(gone, "_node", "left_anti").select(*KEY)
    return rows_of(docs, kept)
