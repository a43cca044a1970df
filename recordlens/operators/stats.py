"""Concentration, Pareto, trend and distribution statistics.

Rounding follows the source of each statistic: SQL-derived shares use
``round`` (half away from zero), the pandas-derived ones use ``bround``
(half to even).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.plans.rank import global_running_sum
from recordlens.session import materialize


def _numeric(df: DataFrame, value_col: str) -> DataFrame:
    """Coerce the value column to a number; unparsable or null -> 0."""
    dtype = df.schema[value_col].dataType
    if isinstance(dtype, (T.IntegralType, T.FractionalType, T.DecimalType)):
        return df.withColumn(value_col, F.coalesce(F.col(value_col), F.lit(0)))
    return df.withColumn(value_col, F.coalesce(F.col(value_col).try_cast("double"), F.lit(0.0)))


def add_cumulative_share(frame: DataFrame, value_col: str, label_col: str,
                         tiebreak: list[str] | None = None, bounded: bool = False) -> DataFrame:
    """Pareto table: share_pct, cum_share_pct (sum of rounded shares), rank.

    Order: value descending, then label ascending (nulls first), then
    ``tiebreak`` columns.  A total <= 0 gives zero shares (rank still set).
    The running sum is computed over range partitions: no frame, however
    large, passes through one task.  ``bounded`` says that the frame is a cut
    list (a top 20, say): then one ordered window does all.
    """
    order = [(value_col, False), (label_col, True)] + [(c, True) for c in (tiebreak or [])]
    keep = [c for c in frame.columns if c not in ("share_pct", "cum_share_pct", "rank")]
    if bounded:
        by = Window.orderBy(*[F.col(c).asc_nulls_first() if up else F.col(c).desc_nulls_last() for c, up in order])
        df = _numeric(frame, value_col).withColumn("_total", F.sum(value_col).over(Window.partitionBy()).cast("double"))
        share = F.when(F.col("_total") > 0, F.bround(F.col(value_col) / F.col("_total") * 100, 2)).otherwise(F.lit(0.0))
        df = df.withColumn("share_pct", share).withColumn("rank", F.row_number().over(by)).withColumn(
            "_cum", F.sum("share_pct").over(by.rowsBetween(Window.unboundedPreceding, 0)))
        return df.select(*keep, "share_pct", F.when(F.col("_total") > 0, F.bround("_cum", 2)).otherwise(F.lit(0.0)).alias("cum_share_pct"), "rank")
    # Frozen once, so that the total and the running sum read the same rows
    # without recomputing the upstream aggregation.
    df = materialize(_numeric(frame, value_col))
    total = df.agg(F.sum(value_col).cast("double").alias("_total"))
    df = df.crossJoin(F.broadcast(total))  # one row: proven size
    share = F.when(F.col("_total") > 0,
                   F.bround(F.col(value_col) / F.col("_total") * 100, 2)).otherwise(F.lit(0.0))
    out = global_running_sum(df.withColumn("share_pct", share), order, "share_pct", "_cum", "rank")
    cum = F.when(F.col("_total") > 0, F.bround(F.col("_cum"), 2)).otherwise(F.lit(0.0))
    return out.select(*keep, "share_pct", cum.alias("cum_share_pct"), "rank")


def summarize_concentration(frame: DataFrame, value_col: str) -> DataFrame:
    """One row: total, top1/3/5 share %, HHI and base-2 entropy of shares.

    Totals, HHI and entropy are plain aggregates (partial aggregation, any
    size); the top-5 values come from a distributed top-k.  All zeros when
    the frame is empty or sums to <= 0.
    """
    df = _numeric(frame, value_col).select(F.col(value_col).cast("double").alias("v"))
    # One aggregate pass: HHI = sum(v^2)/T^2 and entropy = log2(T) - sum(v*log2 v)/T
    # need only sums, so the total does not have to be known first.
    sums = df.agg(F.coalesce(F.sum("v"), F.lit(0.0)).alias("total"),
                  F.sum(F.col("v") * F.col("v")).alias("_s2"),
                  F.sum(F.when(F.col("v") > 0, F.col("v") * F.log2("v"))).alias("_svl"))
    top = df.orderBy(F.col("v").desc()).limit(5) \
        .withColumn("_i", F.row_number().over(Window.orderBy(F.col("v").desc())))
    tops = top.agg(*[F.coalesce(F.sum(F.when(F.col("_i") <= k, F.col("v"))), F.lit(0.0)).alias(f"_top{k}")
                     for k in (1, 3, 5)])
    row = sums.crossJoin(F.broadcast(tops))
    pos = F.col("total") > 0
    t = F.col("total")

    def pct(c: str):
        return F.when(pos, F.bround(F.col(c) / t * 100, 2)).otherwise(F.lit(0.0))

    hhi = F.coalesce(F.col("_s2"), F.lit(0.0)) / (t * t)
    ent = F.log2(t) - F.coalesce(F.col("_svl"), F.lit(0.0)) / t
    return row.select(
        F.when(pos, t).otherwise(F.lit(0.0)).alias("total"),
        pct("_top1").alias("top1_pct"), pct("_top3").alias("top3_pct"), pct("_top5").alias("top5_pct"),
        F.when(pos, F.bround(hhi, 4)).otherwise(F.lit(0.0)).alias("hhi"),
        F.when(pos, F.bround(F.greatest(ent, F.lit(0.0)), 3)).otherwise(F.lit(0.0)).alias("entropy"),
    )


def trend_rolling(per_year: DataFrame, window: int = 3) -> DataFrame:
    """Rolling mean of the yearly count over ``window`` rows (at least one).

    The input is one row per year, so the single ordered window is bounded
    by the number of distinct years.
    """
    w = Window.orderBy(F.col("year").asc_nulls_last()).rowsBetween(-(window - 1), Window.currentRow)
    return per_year.select("year", "patent_count",
                           F.avg("patent_count").over(w).alias("rolling_3yr"))


def trend_yoy(per_year: DataFrame) -> DataFrame:
    """Change of the last year on the previous row, in % (null if not defined)."""
    w = Window.orderBy(F.col("year").asc_nulls_last())
    wd = Window.orderBy(F.col("year").desc_nulls_first())
    df = (per_year.withColumn("_prev", F.lag("patent_count").over(w))
          .withColumn("_rn", F.row_number().over(wd)))
    last = df.where(F.col("_rn") == 1)
    prev = F.col("_prev").cast("double")
    yoy = F.when(prev > 0, F.bround((F.col("patent_count") - prev) / prev * 100, 2))
    return last.select(F.col("year").alias("latest_year"),
                       F.col("patent_count").alias("latest_count"),
                       F.col("_prev").alias("previous_count"), yoy.alias("yoy_pct"))


def trend_series(per_year: DataFrame) -> DataFrame:
    """Yearly series for charting: numeric year, rows without a year dropped."""
    return (per_year.select(F.col("year").cast("string").try_cast("int").alias("year"), "patent_count")
            .where(F.col("year").isNotNull()).orderBy("year"))


def histogram(frame: DataFrame, value_col: str, bins: int | None = None) -> DataFrame:
    """Equal-width histogram of a numeric column; bins = min(20, max(5, n // 2)).

    One aggregate pass gives n, min and max; bucket ids are then computed per
    row and counted with a partial aggregate.  Only non-empty bins are output.
    """
    v = F.col(value_col).cast("double")
    stats = frame.agg(F.count(v).alias("_n"), F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    if bins is None:
        nb = F.least(F.lit(20), F.greatest(F.lit(5), F.floor(F.col("_n") / 2)))
    else:
        nb = F.lit(bins)
    stats = stats.select("_lo", "_hi", nb.cast("int").alias("_bins"))
    width = (F.col("_hi") - F.col("_lo")) / F.col("_bins")
    j = frame.where(v.isNotNull()).select(v.alias("_v")).crossJoin(F.broadcast(stats))
    idx = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / width), F.col("_bins") - 1)).cast("int")
    b = j.withColumn("bin", idx)
    return (b.groupBy("bin", "_lo", "_hi", "_bins").agg(F.count(F.lit(1)).alias("count"))
            .select("bin",
                    (F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / F.col("_bins"))
                    .alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / F.col("_bins"))
                    .alias("bin_end"),
                    "count")
            .orderBy("bin"))
