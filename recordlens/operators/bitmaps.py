"""Mergeable exact distinct counts: sets of patent numbers as containers of bits.

A set is cut into buckets of 32,768 numbers.  A bucket with few members is a sorted list of their places, a fuller
one a bitmap of 4 KB; so the many inventors with a handful of patents stay small, and countries and large companies
cost one bit a patent.  Containers of the same key and bucket merge by union alone, in any order and any number of
times: that makes counts that can be added up over batches, and rolled up from inventors to countries, without the
pairs they came from.

A frame of containers has the columns ``key``, ``bucket``, ``few`` (array of places or null) and ``bits`` (bitmap or
null); exactly one of the two is set.  A null key is a key of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.plans.rank import number_sorted_keys
from recordlens.session import materialize

#: Members up to which a container is a list (4 bytes each, against 4,096 of a bitmap).
FEW = 512


def patent_numbers(ids: DataFrame, after: int = 0) -> DataFrame:
    """(patent_id, number): dense numbers from ``after + 1`` for the distinct non-null ids."""
    distinct = ids.select("patent_id").where(F.col("patent_id").isNotNull()).distinct()
    numbered = number_sorted_keys(distinct, [("patent_id", True)], "number", dtype="bigint")
    return numbered.select("patent_id", (F.col("number") + F.lit(after)).alias("number"))


def bitmap(places: Iterable[np.ndarray], maps: Iterable[bytes] = ()) -> bytes:
    """The bitmap of all places and of the members of other bitmaps."""
    flags = np.zeros(32_768, bool)
    for p in places:
        flags[p] = True
    bits = np.packbits(flags, bitorder="little")
    for m in maps:
        bits[:len(m)] |= np.frombuffer(m, np.uint8)
    return bits.tobytes()


def _filled(grouped: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (key, bucket, few, all_bits): one bitmap of each row."""
    for b in grouped:
        key, bucket, few, maps = b.columns
        bits = [bitmap([f.values.to_numpy()], m.as_py()) for f, m in zip(few, maps)]
        yield pa.RecordBatch.from_arrays([key, bucket, pa.nulls(len(bits), pa.list_(pa.int32())), pa.array(bits, pa.binary())], names=["key", "bucket", "few", "bits"])


def _split(grouped: DataFrame) -> DataFrame:
    """Containers from (key, bucket, few, all_bits): long lists and bitmaps become one bitmap, short lists stay."""
    grouped = materialize(grouped)
    dense = (F.size("few") > FEW) | (F.size("all_bits") > 0)
    short = grouped.where(~dense).select("key", "bucket", F.array_sort("few").alias("few"), F.lit(None).cast("binary").alias("bits"))
    # Filled in place: taken apart again, the places would be shuffled and sorted one by one.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in short.schema])
    full = grouped.where(dense).select("key", "bucket", "few", "all_bits").mapInArrow(_filled, schema)
    return short.unionByName(full)


def containers(pairs: DataFrame) -> DataFrame:
    """Containers of the distinct (key, number) pairs."""
    placed = pairs.select("key", F.bitmap_bucket_number("number").alias("bucket"), F.bitmap_bit_position("number").cast("int").alias("place"))
    # A group has at most 32,768 places, whatever the key holds.
    return _split(placed.groupBy("key", "bucket").agg(F.collect_set("place").alias("few"), F.array().cast("array<binary>").alias("all_bits")))


def merge(parts: DataFrame) -> DataFrame:
    """Containers of which each (key, bucket) has one, from containers of several batches."""
    grouped = parts.groupBy("key", "bucket").agg(
        F.array_distinct(F.flatten(F.collect_list("few"))).alias("few"), F.collect_list("bits").alias("all_bits"))
    return _split(grouped)


def counts(merged: DataFrame, count_col: str = "patent_count") -> DataFrame:
    """(key, count): members per key, as its buckets do not overlap."""
    size = F.when(F.col("bits").isNotNull(), F.bitmap_count("bits")).otherwise(F.size("few").cast("bigint"))
    return merged.groupBy("key").agg(F.sum(size).alias(count_col))


def rollup(parts: DataFrame, groups: DataFrame) -> DataFrame:
    """Containers per group: ``groups`` maps (key, group); keys without a group drop out, a null group is a group.

    Works on unmerged containers too, as a union does not mind repeats.  Coarse groups are dense, so all become bitmaps.
    """
    mapped = parts.join(groups.select("key", "group"), "key").drop("key")
    places = (mapped.where("few is not null").select("group", "bucket", F.explode("few").alias("place"))
              .groupBy("group", "bucket").agg(F.bitmap_construct_agg("place").alias("bits")))
    bits = mapped.where("bits is not null").select("group", "bucket", "bits")
    full = places.unionByName(bits).groupBy("group", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return full.select(F.col("group").alias("key"), "bucket", F.lit(None).cast("array<int>").alias("few"), "bits")


def numbered_pairs(relationships: DataFrame, numbers: DataFrame, key: str) -> DataFrame:
    """(key, number) of the links of one entity column."""
    pairs = relationships.select(F.col(key).alias("key"), "patent_id").distinct()
    return pairs.join(numbers, "patent_id").select("key", "number")
