"""Token ids in ORC files, in ascending order of document ids.

Each file holds one range of rows, by id and then by a hash of the text, so an id that very
many rows share (or have none) lies in as many files as it needs. Integer columns are run-length encoded
by the format; its row index and Bloom filter on ``doc_id`` let a reader skip
stripes and row groups, and stripes are read in parallel. The place of a
document's first id in the whole corpus is its place within its file plus the
sum of the files before: one row per file, not one per document, is put in order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridecast.llm.text import pieces_of
from stridecast.llm.tokens import encoder
from stridecast.scratch import written

FILE_SCHEMA = "doc_id bigint, file_key bigint, start_in_file bigint, n_tokens bigint, ids array<int>"


def _encode_sorted(path: str, spaces: bool, end_id: int):
    def run(batches):
        # Ranges are numbered in order, and each is written to a file by one task.
        ids_of, key, before = encoder(path, spaces).encode, TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in pieces_of(batch, "text"):
                ids = ids_of(part.column("text"))
                counts = np.array([len(x) + 1 for x in ids], np.int64)
                ends = np.cumsum(counts)
                flat = np.full(int(ends[-1]), end_id, np.int32)
                for x, end in zip(ids, ends, strict=True):
                    flat[end - 1 - len(x) : end - 1] = x
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array(np.full(len(ids), key, np.int64)),
                        pa.array(before + ends - counts),
                        pa.array(counts),
                        pa.ListArray.from_arrays(np.concatenate([[0], ends]).astype(np.int32), flat),
                    ],
                    ["doc_id", "file_key", "start_in_file", "n_tokens", "ids"],
                )
                before += int(ends[-1])

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    spaces: bool = False,
    end_id: int = 1,
    stripe_bytes: int = 32 << 20,
    rows_per_index: int = 1000,
) -> None:
    """Encode ``text`` of every row, append ``end_id``, write ORC files sorted by ``doc_id``.

    Null and empty texts hold ``end_id`` alone. Rows without an id come first. Rows
    that repeat an id stay, in the order of a hash of their texts. Other columns are not
    read. An empty table gives an empty table.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # The last key only lets copies of one row fall on both sides of a boundary.
    rows = rows.withColumn("_hash", F.xxhash64("text")).withColumn("_copy", F.monotonically_increasing_id())
    order = (F.col("doc_id").asc_nulls_first(), F.col("_hash"), F.col("_copy"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_copy")
    (
        ordered.mapInArrow(_encode_sorted(tokenizer, spaces, end_id), FILE_SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", rows_per_index)
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", 0.01)
        .orc(folder)
    )


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids; filters on ``doc_id`` reach the files' indexes."""
    rows = spark.read.schema(FILE_SCHEMA).orc(folder)
    sums = rows.groupBy("file_key").agg(F.sum("n_tokens").alias("in_file"))
    # One row per file: the only global order that is needed.
    before = Window.orderBy("file_key").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("file_key", F.coalesce(F.sum("in_file").over(before), F.lit(0)).alias("before"))
    # A row of 16 bytes for each file, written: its true size lets it be broadcast up to the session's threshold.
    return rows.join(written(first, "file-starts"), "file_key").select(
        "doc_id", (F.col("start_in_file") + F.col("before")).alias("start"), "n_tokens", "ids"
    )


def _crc(batches):
    for batch in batches:
        lists = batch.column("ids")
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(np.concatenate([[0], np.diff(lists.offsets.to_numpy())]))
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        kept = [batch.column(c) for c in ("doc_id", "start", "n_tokens")]
        yield pa.record_batch([*kept, pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def with_crc(tokens: DataFrame) -> DataFrame:
    """The ids replaced by the CRC-32 of their little-endian unsigned 32-bit form."""
    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(
        _crc, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
