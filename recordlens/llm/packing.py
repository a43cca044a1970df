"""Packing by power-of-two decomposition.

A document of n ids is cut into pieces whose lengths are the binary digits of n
(the top digit as often as needed at the longest length).  Pieces of one length
form a bucket, and every piece is a sequence of its own: no sequence crosses
documents and no sequence needs padding, as all lengths are powers of two.

A sequence id holds its bucket, shard (input partition) and place in the shard's
bucket, so ids order the pieces bucket by bucket and need no count over the
corpus: nothing is shuffled, and a task that is run again gives the same ids.

Nulls: a null text is empty (its end id alone is packed).  Repeated rows are
packed one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from recordlens.llm.common import batches, bounded_batches
from recordlens.llm.encode import encoder

MAX_LENGTH = 2048
END_ID = 1


def pieces_of(n: int, longest: int = MAX_LENGTH) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids, longest first; ``longest`` is a power of two."""
    out = [(i * longest, longest) for i in range(n // longest)]
    start, rest = n - n % longest, n % longest
    while rest:
        size = 1 << rest.bit_length() - 1
        out.append((start, size))
        start, rest = start + size, rest - size
    return out


def pack(documents: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
         longest: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (binary, little-endian unsigned 32 bit),
    doc_tokens, sequence_id, offset (0: a sequence is one piece), bucket (log2 of the length)."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    bounded_batches(documents.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, seen = TaskContext.get().partitionId(), [0] * 32
        enc = encoder(tokenizer, spaces=False)
        for b in batches(rows):
            row, start, length, total, sequence, bucket_of, ids = [], [], [], [], [], [], []
            for k, own in enumerate(enc.encode([t or "" for t in b.column(1).to_pylist()])):
                own = np.append(own, end_id).astype("<u4")
                for at, size in pieces_of(len(own), longest):
                    row.append(k)
                    start.append(at)
                    length.append(size)
                    total.append(len(own))
                    bucket = size.bit_length() - 1
                    bucket_of.append(bucket)
                    sequence.append(bucket << 58 | shard << 32 | seen[bucket])
                    seen[bucket] += 1
                    ids.append(own[at:at + size].tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary()), pa.array(total, pa.int64()),
                 pa.array(sequence, pa.int64()), pa.array([0] * len(row), pa.int64()), pa.array(bucket_of, pa.int32())],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "bucket"])

    own = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = StructType([
        own.schema["doc_id"], StructField("start", LongType()), StructField("length", LongType()), StructField("ids", BinaryType()),
        StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()), StructField("offset", LongType()),
        StructField("bucket", IntegerType())])
    return own.mapInArrow(run, schema)


def digest(packed: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids instead of the ids."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket")
