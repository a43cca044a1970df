"""Layout along a space-filling curve: one sort that lets a filter on any of several columns skip row groups.

Each column's values are ranked by the share of rows below them, so that every bit of a rank halves the rows
however the values are spread.  The bits of the ranks are interleaved into one sort key; rows that are near in
all columns lie near in the files, and the least and greatest values that Parquet keeps per row group are narrow
for every column, not for the first only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordlens.plans.rank import global_running_sum

BITS = 10


def value_ranks(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """(column, rank): per distinct value a number below ``2 ** bits`` by the share of rows that lie below it."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    summed = global_running_sum(counts, [(column, True)], "_n", "_upto", "_place")
    total = df.agg(F.count(F.lit(1)).alias("_total"))  # one row
    middle = (F.col("_upto") - F.col("_n") / 2) / F.col("_total")
    return summed.crossJoin(F.broadcast(total)).select(column, F.floor(middle * (1 << bits)).cast("bigint").alias("rank"))


def interleave(ranks: list[Column], bits: int = BITS) -> Column:
    """One number from the bits of several, the highest bits of all first."""
    if len(ranks) * bits > 63:
        raise ValueError("too many bits for one sort key")
    key = F.lit(0).cast("bigint")
    for b in range(bits):
        for i, rank in enumerate(ranks):
            bit = F.shiftright(rank, b).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(bit, b * len(ranks) + (len(ranks) - 1 - i)))
    return key


def with_curve_key(df: DataFrame, columns: list[str], key: str = "_curve", bits: int = BITS) -> DataFrame:
    """``df`` with its place on the curve through ``columns`` (nulls rank first)."""
    names = [f"_rank{i}" for i in range(len(columns))]
    out = df
    for column, name in zip(columns, names):
        # One row per distinct value; the engine broadcasts it only where it measures it small.
        ranks = value_ranks(df, column, bits).select(F.col(column).alias(f"{name}_of"), F.col("rank").alias(name))
        out = out.join(ranks, F.col(column).eqNullSafe(F.col(f"{name}_of"))).drop(f"{name}_of")
    return out.withColumn(key, interleave([F.col(n) for n in names], bits)).drop(*names)


def save_along_curve(df: DataFrame, columns: list[str], path: str, files: int, row_group_bytes: int = 32 << 20, bits: int = BITS) -> str:
    """Write ``df`` as Parquet in the order of the curve, ranges of it in ``files`` files."""
    placed = with_curve_key(df, columns, bits=bits)
    (placed.repartitionByRange(files, "_curve").sortWithinPartitions("_curve").drop("_curve")
     .write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path))
    return path
