"""Shared helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from recordlens.session import ensure_checkpoint_dir

#: Rows of one Arrow batch handed to Python: bounds a worker's memory however
#: many rows a partition has (texts are whole, so one row is the smallest unit).
BATCH_ROWS = 1000

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20
    for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder; ``sf_dir`` may be any URI Spark can read."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small enough for long texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write to the shared folder as Parquet and read it back.

    Later steps read the files, so a lost executor costs re-reading them and
    never the work above; all consumers see the same rows.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_columns(schema: StructType, ddl: str) -> StructType:
    """``schema`` plus the columns of a DDL string (same names are replaced)."""
    extra = StructType.fromDDL(ddl)
    names = {f.name.lower() for f in extra}
    return StructType([f for f in schema if f.name.lower() not in names] + list(extra))


def utf8(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def alnum_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of ASCII letters, digits and any non-ASCII characters."""
    return text.translate(_WORD_BYTES).split() if text else []


def space_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space (space, tab to carriage return)."""
    return text.split() if text else []


def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Skip empty batches."""
    return (b for b in rows if b.num_rows)
