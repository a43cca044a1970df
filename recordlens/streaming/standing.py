"""Standing results: new links update the counts of inventors, companies, countries and years.

Each micro-batch leaves only what it adds: numbers of patents not seen before, containers of its own
(inventor, patent) and (company, patent) pairs, and its rows per year.  Results are the union of the
batches (see ``operators.bitmaps``), so nothing is recounted, and a pair that comes again changes nothing.

A batch is written under its id and then committed by one small file; what is not committed is never read.
A batch that is repeated after a failure overwrites its own files, one that was committed is skipped, so a
restart cannot count anything twice.  ``compact`` folds all committed batches into one set of containers.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.cache import file_exists
from recordlens.operators import bitmaps
from recordlens.streaming.ingest import stream_files

ENTITIES = {"inventor": "inventor_id", "company": "company_id"}
_CONTAINERS = "key string, bucket bigint, few array<int>, bits binary, entity string, batch bigint"
_NUMBERS = "patent_id string, number bigint, batch bigint"
_LINKS = "patent_id string, inventor_id string, company_id string"
_YEARS = "year int, patent_count bigint, batch bigint"
_COMMITS = "batch bigint, patents bigint, compacted boolean"


class StandingCounts:
    """The counts kept under ``base``, a folder all executors share."""

    def __init__(self, spark: SparkSession, base: str, compact_every: int = 16):
        self.spark, self.base, self.compact_every = spark, base.rstrip("/"), compact_every

    # -- files ---------------------------------------------------------------
    def _read(self, name: str, ddl: str) -> DataFrame:
        path = f"{self.base}/{name}"
        if not file_exists(self.spark, path):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).parquet(path)

    def _write(self, df: DataFrame, name: str, batch: int, *parts: str) -> None:
        """The rows of one batch, in its own folder."""
        path = f"{self.base}/{name}/batch={batch}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*parts) if parts else writer).parquet(path)

    def _committed(self, kind: str = "commits") -> list:
        """One row per committed batch."""
        return sorted(self._read(kind, _COMMITS).collect(), key=lambda r: r["batch"])

    def _commit(self, kind: str, batch: int, patents: int, compacted: bool = False) -> None:
        row = self.spark.createDataFrame([(patents, compacted)], "patents bigint, compacted boolean")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/{kind}/batch={batch}")

    # -- updates ---------------------------------------------------------------
    def add_links(self, batch: int, relationships: DataFrame) -> bool:
        """Take the (patent_id, inventor_id, company_id) rows of a batch; false if it was taken before."""
        done = self._committed()
        if any(r["batch"] == batch for r in done):
            return False
        links = relationships.select(*(F.col(c).cast("string").alias(c) for c in ("patent_id", *ENTITIES.values()))).distinct()
        # Read three times below: written once, so that the batch's own joins run once.
        self._write(links, "links", batch)
        links = self._read(f"links/batch={batch}", _LINKS)
        known = self._of("numbers", _NUMBERS, done)
        after = max((r["patents"] for r in done), default=0)
        fresh = links.join(known, "patent_id", "left_anti")
        self._write(bitmaps.patent_numbers(fresh, after), "numbers", batch)
        own = self.spark.read.schema("patent_id string, number bigint").parquet(f"{self.base}/numbers/batch={batch}")
        patents = own.agg(F.max("number")).first()[0] or after
        numbers = known.select("patent_id", "number").unionByName(own)
        parts = None
        for entity, key in ENTITIES.items():
            part = bitmaps.containers(bitmaps.numbered_pairs(links, numbers, key)).withColumn("entity", F.lit(entity))
            parts = part if parts is None else parts.unionByName(part)
        self._write(parts, "containers", batch, "entity")
        self._commit("commits", batch, patents)
        if self.compact_every and len(done) % self.compact_every == self.compact_every - 1:
            self.compact()
        return True

    def add_patents(self, batch: int, patents: DataFrame) -> bool:
        """Take the patent rows of a batch into the counts per year; false if it was taken before."""
        if any(r["batch"] == batch for r in self._committed("year_commits")):
            return False
        years = patents.groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("patent_count"))
        self._write(years, "years", batch)
        self._commit("year_commits", batch, 0)
        return True

    def compact(self) -> None:
        """Fold the containers of all committed batches into one, which replaces them from then on."""
        done = self._committed()
        if not done:
            return
        last = done[-1]["batch"]
        parts = None
        for entity in ENTITIES:
            part = bitmaps.merge(self.containers(entity)).withColumn("entity", F.lit(entity))
            parts = part if parts is None else parts.unionByName(part)
        self._write(parts, "compacted", last, "entity")
        self._commit("commits", last, done[-1]["patents"], compacted=True)

    # -- results ---------------------------------------------------------------
    def _of(self, name: str, ddl: str, commits: list) -> DataFrame:
        return self._read(name, ddl).where(F.col("batch").isin([r["batch"] for r in commits]))

    def containers(self, entity: str) -> DataFrame:
        """All committed containers of an entity: the last compacted ones and those of the batches after it."""
        done = self._committed()
        base = max((r["batch"] for r in done if r["compacted"]), default=None)
        later = [r for r in done if base is None or r["batch"] > base]
        found = self._of("containers", _CONTAINERS, later)
        if base is not None:
            found = found.unionByName(self._read("compacted", _CONTAINERS).where(F.col("batch") == base))
        return found.where(F.col("entity") == entity).select("key", "bucket", "few", "bits")

    def total_patents(self) -> int:
        """Linked patents: the numbers are dense."""
        return max((r["patents"] for r in self._committed()), default=0)

    def _counts(self, entity: str) -> DataFrame:
        return bitmaps.counts(bitmaps.merge(self.containers(entity))).withColumnRenamed("key", ENTITIES[entity])

    def top_inventors(self, inventors: DataFrame) -> DataFrame:
        found = inventors.select("inventor_id", "name", "country").join(self._counts("inventor"), "inventor_id")
        return found.orderBy(F.col("patent_count").desc(), F.col("name").asc())

    def top_companies(self, companies: DataFrame) -> DataFrame:
        found = companies.select("company_id", "name").join(self._counts("company"), "company_id")
        return found.orderBy(F.col("patent_count").desc(), F.col("name").asc())

    def top_countries(self, inventors: DataFrame) -> DataFrame:
        """Countries by rolling the inventors' containers up."""
        groups = inventors.select(F.col("inventor_id").alias("key"), F.col("country").alias("group"))
        found = bitmaps.counts(bitmaps.rollup(self.containers("inventor"), groups)).withColumnRenamed("key", "country")
        return found.orderBy(F.col("patent_count").desc(), F.col("country").asc())

    def country_share(self, inventors: DataFrame) -> DataFrame:
        share = F.round(F.col("patent_count").cast("double") / F.nullif(F.lit(self.total_patents()), F.lit(0)) * 100, 2)
        return self.top_countries(inventors).select("country", "patent_count", share.alias("patent_share_pct"))

    def patents_per_year(self) -> DataFrame:
        found = self._of("years", _YEARS, self._committed("year_commits"))
        return found.groupBy("year").agg(F.sum("patent_count").alias("patent_count")).orderBy(F.col("year").asc())


def run_standing(spark: SparkSession, source_dir: str, schema: T.StructType, apply: Callable[[int, DataFrame], object], checkpoint_path: str,
                 transform: Callable[[DataFrame], DataFrame] = lambda df: df, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> None:
    """Stream the files of a folder into standing results: ``apply`` takes (batch id, rows); returns when all are taken."""
    stream = transform(stream_files(spark, source_dir, schema, fmt, max_files_per_trigger=max_files_per_trigger))
    query = (stream.writeStream.foreachBatch(lambda rows, batch: apply(batch, rows) and None).option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
