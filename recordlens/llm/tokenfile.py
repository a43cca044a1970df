"""Token-id files: frequency-ranked ids, byte-aligned variable-length coding.

An id is replaced by its rank among all ids of the corpus (most frequent first)
and stored in 1 to 4 bytes.  Lengths are kept apart from the data: one control
byte holds the lengths of four ids.  A reader looks the four lengths up in a
256-row table and gathers the bytes with numpy, without a loop over ids.

A file set is a folder with two Parquet tables written by Spark:

* ``shards``: rows (doc_id, shard, seq, local_start, n_tokens, crc, control, data),
  in ascending document order within and over the shards; ``local_start`` counts
  the ids before the document in its shard.
* ``ranks``: (rank, id), the code table, bounded by the vocabulary.

Nulls: a null text is empty and yields the end id alone; null ids sort first.
Repeated rows are all written, equal ids in the order of their content.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from recordlens.llm.common import batches, bounded_batches, shared_path, stage
from recordlens.llm.encode import encoder

END_ID = 0
#: Ids coded or decoded in one numpy step: bounds memory.
PORTION_IDS = 1 << 18

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)


def _slots(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of each id among the slots, slots up to the end of each document); a document fills whole groups of four."""
    groups = (n + 3) // 4 * 4
    ends = np.cumsum(groups)
    return np.arange(int(n.sum())) + np.repeat(ends - groups - (np.cumsum(n) - n), n), ends


def pack(ranks: np.ndarray, n: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """(control bytes, data bytes) of each document; ``ranks`` (below 2**32) of documents of ``n`` ids, end to end."""
    r = np.ascontiguousarray(ranks, dtype="<u4")
    size = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    at, ends = _slots(n)
    slots = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    slots[at] = size - 1
    four = slots.reshape(-1, 4)
    control = (four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6).tobytes()
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < size[:, None]].tobytes()
    until = np.append(0, np.cumsum(size, dtype=np.int64))[np.append(0, np.cumsum(n))].tolist()
    cuts = [0, *(ends // 4).tolist()]
    return [control[a:b] for a, b in zip(cuts, cuts[1:])], [data[a:b] for a, b in zip(until, until[1:])]


def unpack(control: list[bytes], data: list[bytes], n: np.ndarray) -> np.ndarray:
    """The ranks of ``pack``, end to end."""
    size = _LENGTHS[np.frombuffer(b"".join(control), dtype=np.uint8)].ravel()[_slots(n)[0]]
    out = np.zeros((len(size), 4), dtype=np.uint8)
    out[np.arange(4, dtype=np.uint8) < size[:, None]] = np.frombuffer(b"".join(data), dtype=np.uint8)
    return out.view("<u4").ravel()


def _portions(n: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``PORTION_IDS`` ids, at least one document each."""
    start, ids = 0, 0
    for k, own in enumerate(n):
        if ids and ids + own > PORTION_IDS:
            yield start, k
            start, ids = k, 0
        ids += own
    if start < len(n):
        yield start, len(n)


def encode_ids(documents: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids): ids of the whole text and the end id, little-endian, in the vocabulary's width."""
    bounded_batches(documents.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, spaces=True)
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        for b in batches(rows):
            ids = enc.encode([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([i.tobytes() + end for i in ids], pa.binary())], names=["doc_id", "ids"])

    own = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, StructType([StructField("doc_id", own.schema[0].dataType), StructField("ids", BinaryType())]))


def count_ids(encoded: DataFrame, width: str, vocabulary: int) -> DataFrame:
    """(id, n): how often each id occurs; one row per id and task is shuffled."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, dtype=np.int64)
        for b in batches(rows):
            for ids in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(ids, dtype=width), minlength=vocabulary) if len(ids) > 1 << 16 else 0
            small = [i for i in b.column(0).to_pylist() if len(i) <= 1 << 16]
            total += np.bincount(np.frombuffer(b"".join(small), dtype=width), minlength=vocabulary)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], names=["id", "n"])

    return encoded.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(documents: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                      end_id: int = END_ID) -> str:
    """Write the file set to ``path``; returns ``path``.

    Texts are encoded once (staged in the shared folder) and counted; the ids,
    not the texts, are then range-partitioned by document id and coded in place.
    """
    spark = documents.sparkSession
    enc = encoder(tokenizer, spaces=True)
    width, vocabulary = enc.dtype.str, max(enc.tokenizer.get_vocab_size(), end_id + 1)
    encoded = stage(encode_ids(documents, id_col, text_col, tokenizer, end_id), "ids", "zstd")
    counts = np.zeros(vocabulary, dtype=np.int64)
    for row in count_ids(encoded, width, vocabulary).toLocalIterator():     # at most one row per id
        counts[row["id"]] = row["n"]
    ids = np.argsort(-counts, kind="stable")
    ids = ids[: max(int((counts > 0).sum()), 1)]
    rank = np.zeros(vocabulary, dtype=np.uint32)
    rank[ids] = np.arange(len(ids), dtype=np.uint32)
    spark.createDataFrame(pa.table({"rank": np.arange(len(ids), dtype=np.int64), "id": ids.astype(np.int64)}).to_pandas()
                          ).coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(rank)
    # A repeated id is spread by its content too, so that equal ids need not meet in one task.
    # The ranges are drawn from the staged rows, before any coding.
    placed = encoded.withColumn("content", F.xxhash64("ids")).repartitionByRange("doc_id", "content").sortWithinPartitions("doc_id", "content")

    def code(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        table, shard, start, seq = shared.value, TaskContext.get().partitionId(), 0, 0
        table_width = np.dtype(width).itemsize
        for b in batches(rows):
            out, raws = [], b.column(1).to_pylist()
            sizes = [len(raw) // table_width for raw in raws]
            for k, end in _portions(sizes):
                own, n = np.frombuffer(b"".join(raws[k:end]), dtype=width), np.array(sizes[k:end])
                wide, cuts = memoryview(own.astype("<u4").tobytes()), np.append(0, np.cumsum(n) * 4).tolist()
                crc = [zlib.crc32(wide[a:z]) for a, z in zip(cuts, cuts[1:])]
                out += zip((start + np.cumsum(n) - n).tolist(), sizes[k:end], crc, *pack(table[own], n))
                start += int(n.sum())
            before, n, crc, control, data = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(out), shard), pa.int64()), pa.array(np.arange(seq, seq + len(out)), pa.int64()),
                 *(pa.array(c, pa.int64()) for c in (before, n, crc)), pa.array(control, pa.binary()), pa.array(data, pa.binary())],
                names=["doc_id", "shard", "seq", "local_start", "n_tokens", "crc", "control", "data"])
            seq += len(out)

    placed.mapInArrow(code, StructType([encoded.schema["doc_id"], *StructType.fromDDL(
        "shard bigint, seq bigint, local_start bigint, n_tokens bigint, crc bigint, control binary, data binary")])).write.parquet(f"{path}/shards")
    return path


def shard_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(shard, offset): ids before each shard; one row per shard, read from the counts only."""
    sums = spark.read.parquet(f"{path}/shards").groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    return sums.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)),
                                           F.lit(0)).cast("bigint").alias("offset"))


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of a file set; ids as little-endian unsigned 32-bit integers."""
    bounded_batches(spark)
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()
    shared = spark.sparkContext.broadcast(ranks["id"].to_numpy(dtype="<u4"))
    rows = spark.read.parquet(f"{path}/shards").join(F.broadcast(shard_offsets(spark, path)), "shard")
    rows = rows.select("doc_id", (F.col("local_start") + F.col("offset")).alias("start"), "n_tokens", "control", "data")

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        for b in batches(parts):
            out, sizes = [], b.column(2).to_pylist()
            control, data = b.column(3).to_pylist(), b.column(4).to_pylist()
            for k, end in _portions(sizes):
                n = np.array(sizes[k:end])
                flat, cuts = ids[unpack(control[k:end], data[k:end], n)].tobytes(), np.append(0, np.cumsum(n) * 4).tolist()
                out += [flat[a:z] for a, z in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], names=["doc_id", "start", "ids"])

    return rows.mapInArrow(decode, StructType([rows.schema["doc_id"], StructField("start", LongType()), StructField("ids", BinaryType())]))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    return read_token_files(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def new_path(spark: SparkSession) -> str:
    return shared_path(spark, "tokens")
