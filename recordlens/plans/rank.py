"""Global ranking without funnelling every row through one task.

``Window.orderBy(...)`` with no ``partitionBy`` moves the whole input to a
single partition.  For a ranking over an entity table (millions of rows at
scale) we instead:

1. reduce the input to its distinct order keys (a partial aggregate, so a
   key shared by a third of all rows costs one row per map task);
2. range-partition the distinct keys, sort inside each partition and number
   them with ``monotonically_increasing_id`` (partition id in the high bits,
   in-partition position in the low 33 bits);
3. checkpoint that numbering to the shared checkpoint folder, so a lost
   executor cannot renumber it on recompute;
4. count keys per partition (one row per partition), turn the counts into
   start offsets with a window over that tiny frame, and broadcast it - the
   size bound is the partition count, not the data;
5. join the ranks back to the rows on the order keys (null-safe).  A hot
   key is handled by AQE's skew-join split of the large side.

Dense rank over the original rows equals the row number over the distinct
keys, so the same plan serves ``dense_rank`` and, on unique keys,
``row_number``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlens.session import materialize

_LOW_BITS = (1 << 33) - 1


def _sort_col(name: str, ascending: bool) -> Column:
    c = F.col(name)
    # Spark's default: ASC puts nulls first, DESC puts nulls last.
    return c.asc_nulls_first() if ascending else c.desc_nulls_last()


def number_sorted_keys(keys: DataFrame, order: list[tuple[str, bool]], rank_col: str,
                       num_partitions: int | None = None, dtype: str = "int") -> DataFrame:
    """Attach a 1-based position to rows of ``keys`` (unique on ``order``)."""
    spark = keys.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [_sort_col(c, asc) for c, asc in order]
    tagged = materialize(
        keys.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_rl_mid", F.monotonically_increasing_id())
    )
    tagged = (tagged.withColumn("_rl_pid", F.shiftright("_rl_mid", 33))
              .withColumn("_rl_pos", F.col("_rl_mid").bitwiseAND(F.lit(_LOW_BITS))))
    offsets = (
        tagged.groupBy("_rl_pid").agg(F.count(F.lit(1)).alias("_rl_n"))
        .withColumn("_rl_start",
                    F.coalesce(F.sum("_rl_n").over(
                        Window.orderBy("_rl_pid").rowsBetween(Window.unboundedPreceding, -1)),
                        F.lit(0)))
        .select("_rl_pid", "_rl_start")
    )
    # One row per partition: bounded by the partition count.
    ranked = tagged.join(F.broadcast(offsets), "_rl_pid")
    return ranked.select(
        *[c for c in keys.columns],
        (F.col("_rl_start") + F.col("_rl_pos") + 1).cast(dtype).alias(rank_col),
    )


def global_dense_rank(df: DataFrame, order: list[tuple[str, bool]], rank_col: str,
                      num_partitions: int | None = None) -> DataFrame:
    """``DENSE_RANK() OVER (ORDER BY order...)`` computed in parallel."""
    key_cols = [c for c, _ in order]
    # The input is read twice (keys, join-back): freeze it once instead of
    # running its upstream aggregation twice.
    df = materialize(df)
    keys = df.select(*key_cols).distinct()
    ranked_keys = number_sorted_keys(keys, order, rank_col, num_partitions)
    cond = None
    rk = ranked_keys.alias("_rk")
    base = df.alias("_base")
    for c in key_cols:
        term = F.col(f"_base.{c}").eqNullSafe(F.col(f"_rk.{c}"))
        cond = term if cond is None else cond & term
    return base.join(rk, cond).select("_base.*", F.col(f"_rk.{rank_col}"))


def global_running_sum(df: DataFrame, order: list[tuple[str, bool]], value_col: str,
                       sum_col: str, pos_col: str, num_partitions: int | None = None) -> DataFrame:
    """Running total of ``value_col`` and 1-based position along a global order.

    Same shape as :func:`number_sorted_keys`: range partition, local
    numbering, checkpoint, then per-partition totals (one row per partition)
    turned into start offsets and broadcast.  The in-partition running sum
    is a window partitioned by the range-partition id, i.e. evenly sized.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [_sort_col(c, asc) for c, asc in order]
    tagged = materialize(
        df.repartitionByRange(n, *sort_cols)
        .sortWithinPartitions(*sort_cols)
        .withColumn("_rl_mid", F.monotonically_increasing_id())
    )
    tagged = (tagged.withColumn("_rl_pid", F.shiftright("_rl_mid", 33))
              .withColumn("_rl_pos", F.col("_rl_mid").bitwiseAND(F.lit(_LOW_BITS))))
    before = Window.orderBy("_rl_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy("_rl_pid")
        .agg(F.sum(value_col).alias("_rl_psum"), F.count(F.lit(1)).alias("_rl_n"))
        .select("_rl_pid",
                F.coalesce(F.sum("_rl_psum").over(before), F.lit(0)).alias("_rl_sum0"),
                F.coalesce(F.sum("_rl_n").over(before), F.lit(0)).alias("_rl_n0"))
    )
    local = Window.partitionBy("_rl_pid").orderBy("_rl_pos") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = (tagged.withColumn("_rl_local", F.sum(value_col).over(local))
           .join(F.broadcast(offsets), "_rl_pid"))
    return out.select(
        *df.columns,
        (F.col("_rl_sum0") + F.col("_rl_local")).alias(sum_col),
        (F.col("_rl_n0") + F.col("_rl_pos") + 1).cast("int").alias(pos_col),
    )
