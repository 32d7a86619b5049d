"""Token ids as ORC files, and back.

Documents are range-partitioned and sorted by id, encoded, and written with integer run-length
encoded id lists, a row index and a Bloom filter on ``doc_id``. A stripe can be read alone, and a
read of some ids skips files by their range, and row groups by index and Bloom filter. ``start`` of a
document, the ids of all documents before it, is its place within its file plus the ids of the files
before, which are one number a file.

Empty and NULL texts are the end id alone. A NULL ``doc_id`` comes first. Rows that share an id stand
in the order of the hash of their texts; repeated rows stand side by side, in any order, since they are equal. An
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import KEY, keyed, pieces
from millrace.llm.encoding import encoder
from millrace.scratch import materialize

READ_BYTES = 4_000_000
SCHEMA = "doc_id bigint, part int, start_in_part bigint, n_tokens bigint, ids array<int>"
# Options of the ORC writer: names and values are fixed by the format.
ORC = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(32 << 20),
    "compression": "zstd",
}


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 1) -> None:
    """Write the ids of every document, in ascending order of ids, as ORC files under ``path``."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        end = end_id.to_bytes(4, "little")
        part, before = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, READ_BYTES):
            ids = [words.encode(text) + end for text in batch.column("text").to_pylist()]
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            ends = np.cumsum(lengths)
            offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
            values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(len(ids), part, np.int32)),
                    pa.array(before + ends - lengths),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                names=["doc_id", "part", "start_in_part", "n_tokens", "ids"],
            )
            before += int(ends[-1])

    ordered = keyed(docs).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    encoded = ordered.select("doc_id", "text").mapInArrow(encode, SCHEMA)
    encoded.write.options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids`` of every document in the files. Filters on ``doc_id`` reach the
    files, and columns that are not used are not read. Where each file starts is a table of its own, so that its size
    is known when the join with all documents is planned: they stay where they are if it is small."""
    rows = spark.read.schema(SCHEMA).orc(path)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    bases = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    bases = materialize(bases, "bases")
    start = (F.col("_base") + F.col("start_in_part")).alias("start")
    return rows.join(bases, "part").select("doc_id", start, "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """Rows with ``ids_crc32``, of the ids as little-endian 32-bit numbers, instead of the ids."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            bounds = ids.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
            columns = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
            yield pa.record_batch(
                [*columns, pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(sums, schema)
