"""Pages of a large sorted result without sorting it again: a range-sorted table and its directory.

``build`` sorts the rows once by range into parts of about ``rows_per_part`` rows and keeps a directory of one
row per part: its rows, the rows before it, and its first and last key.  Page N then needs only the parts that
hold its rows, and a key needs one part; nothing else is opened.  The directory grows with the parts, not the rows.

Rows with equal keys lie in one part; their order is by ``tiebreak``, which should make the order total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_PART = 100_000


class PagedTable:
    """The pages stored under ``path``, in ascending order of ``key`` (nulls first) and ``tiebreak``."""

    def __init__(self, spark: SparkSession, path: str, key: str, tiebreak: tuple[str, ...] = ()):
        self.spark, self.path, self.order = spark, path.rstrip("/"), [key, *tiebreak]

    def build(self, rows: DataFrame, rows_per_part: int = ROWS_PER_PART) -> PagedTable:
        """Sort and store the rows with their directory."""
        from recordlens.session import materialize
        by = [F.col(c).asc_nulls_first() for c in self.order]
        rows = materialize(rows)          # counted, sampled for the ranges, and written
        parts = max(1, -(-rows.count() // rows_per_part))
        sorted_rows = rows.repartitionByRange(parts, by[0]).sortWithinPartitions(*by).withColumn("part", F.spark_partition_id())
        sorted_rows.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/rows")
        rows.limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")
        found = self._rows().groupBy("part").agg(
            F.count(F.lit(1)).alias("rows"), F.min(self.order[0]).alias("first_key"), F.max(self.order[0]).alias("last_key"))
        # One row per part.
        before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        found.withColumn("before", before).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/directory")
        return self

    def _rows(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        return self.spark.read.schema(T.StructType([*schema, T.StructField("part", T.IntegerType())])).parquet(f"{self.path}/rows")

    def directory(self) -> DataFrame:
        """(part, rows, first_key, last_key, before)."""
        return self.spark.read.parquet(f"{self.path}/directory")

    def count(self) -> int:
        return self.directory().agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def _of(self, parts: list[int]) -> DataFrame:
        return self._rows().where(F.col("part").isin(parts)).drop("part")

    def slice(self, start: int, size: int) -> DataFrame:
        """``size`` rows from the 0-based row ``start`` on, in order."""
        met = self.directory().where((F.col("before") < start + size) & (F.col("before") + F.col("rows") > start)).orderBy("part").collect()
        rows = self._of([r["part"] for r in met])
        skip = start - met[0]["before"] if met else 0
        return rows.orderBy(*[F.col(c).asc_nulls_first() for c in self.order]).offset(skip).limit(size)

    def page(self, number: int, size: int = 100) -> DataFrame:
        """Page ``number`` (1-based), in order."""
        return self.slice((max(int(number), 1) - 1) * size, size)

    def after(self, last, size: int = 100) -> DataFrame:
        """The ``size`` rows after the key ``last``: the part that holds it and those that follow, until they are enough."""
        key = self.order[0]
        later = self.directory().where(F.col("last_key") > F.lit(last)).orderBy("part")
        # Parts are taken until those wholly after the key hold enough rows.
        enough = F.coalesce(F.sum(F.when(F.col("first_key") > F.lit(last), F.col("rows")).otherwise(0)).over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) >= size
        parts = [r["part"] for r in later.withColumn("enough", enough).where(~F.col("enough")).collect()]
        return self._of(parts).where(F.col(key) > F.lit(last)).orderBy(*[F.col(c).asc_nulls_first() for c in self.order]).limit(size)
