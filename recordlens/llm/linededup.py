"""Line deduplication over levelled sorted runs of line hashes, with built-in functions only.

1. Each document becomes one narrow row: a content key and the 128-bit hash of every line's key
   (the line stripped at both ends, A-Z lower-cased).  These rows are written once, in batches.
2. ``LineRuns`` takes the batches one after the other.  A batch is reduced to (hash, documents),
   merge-anti-joined with the standing runs (a key that is already frequent needs no more
   counting) and written as a sorted run of level 0.  ``fanout`` runs of a level are compacted into
   one run of the next.  Runs are bucketed and sorted by the hash, so neither the anti-joins nor
   the compactions shuffle them again; only the batch itself is shuffled, after a partial count.
3. The frequent keys are joined with the line hashes, which gives the line numbers to drop per
   document; only then do texts move, once.

A very frequent line is one row per task in step 2.  In step 3 its rows are many on one side only,
which the skew-join rule splits.

Nulls: a null or empty text is one empty line; empty keys are never dropped.  Each row of the table
counts as a document, whatever its id: repeated rows count each and keep their rows, and a null id
is an id like any other.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.llm.common import shared_path, stage, with_columns

MIN_DOCUMENTS = 10
BATCHES = 6
FANOUT = 2
#: Hashes do not compress, and a codec would hold native buffers for each of the many small files.
PLAIN = "uncompressed"

_STRIP = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space, with A-Z lower-cased."""
    # lower() touches no other letter of an ASCII line, and is much the faster.
    low = F.when(F.length(line) == F.octet_length(line), F.lower(line)).otherwise(F.translate(line, _UPPER, _LOWER))
    return F.btrim(low, F.lit(_STRIP))


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def _hash(salt: str, *columns: Column) -> Column:
    return F.xxhash64(F.lit(salt), *columns)


def hashed_lines(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(r1, r2, lines): per row its content key and per line the hash of its key, null for an empty key."""
    def hashed(line: Column) -> Column:
        return F.transform(F.array(line_key(line)), lambda k: F.when(
            k != "", F.struct(_hash("a", k).alias("h1"), _hash("b", k).alias("h2"))))[0]

    own = documents.select(F.col(id_col).alias("doc_id"), _text(text_col).alias("text"))
    return own.select(_hash("a", F.col("doc_id"), F.col("text")).alias("r1"), _hash("b", F.col("doc_id"), F.col("text")).alias("r2"),
                      F.transform(F.split("text", "\n"), hashed).alias("lines"))


class LineRuns:
    """Levelled sorted runs of (h1, h2, n): ``n`` documents hold the key, counted until it is frequent.

    A run is a table bucketed and sorted by the hash; its files lie in the shared folder and its name
    in the session's catalog until ``close``.
    """

    def __init__(self, spark: SparkSession, min_documents: int = MIN_DOCUMENTS, fanout: int = FANOUT, buckets: int | None = None):
        self.spark = spark
        self.min_documents, self.fanout = min_documents, max(2, fanout)
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self._names: list[str] = []

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (counts.write.format("parquet").option("path", shared_path(self.spark, "linerun")).option("compression", PLAIN)
         .bucketBy(self.buckets, *_HASH).sortBy(*_HASH).saveAsTable(name))
        self._names.append(name)
        return name

    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def _merged(self, names: list[str]) -> DataFrame:
        """Runs merged by their hash; two runs meet bucket by bucket, without a shuffle."""
        merged = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).withColumnRenamed("n", "more")
            merged = (merged.join(other.hint("merge"), _HASH, "full")
                      .select(*_HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n")))
        return merged

    def add(self, keys: DataFrame) -> None:
        """Take a batch with one row (h1, h2) per document and distinct key."""
        fresh = keys.groupBy(*_HASH).agg(F.count(F.lit(1)).alias("n"))
        for name in self.runs():
            known = self.spark.table(name).where(F.col("n") >= self.min_documents).select(*_HASH)
            fresh = fresh.join(known.hint("merge"), _HASH, "left_anti")
        self._push(0, self._write(fresh))

    def _push(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            names, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._write(self._merged(names)))

    def frequent(self) -> DataFrame:
        """(h1, h2) of the keys that at least ``min_documents`` documents hold, written and read again."""
        if not self.runs():
            return self.spark.createDataFrame([], "h1 bigint, h2 bigint")
        return stage(self._merged(self.runs()).where(F.col("n") >= self.min_documents).select(*_HASH), "frequent-lines", PLAIN)

    def close(self) -> None:
        for name in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_dedup(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_documents: int = MIN_DOCUMENTS,
               batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_text): every row without the lines whose key ``min_documents`` rows hold."""
    spark = documents.sparkSession
    path = shared_path(spark, "line-hashes")
    hashed = hashed_lines(documents, id_col, text_col)
    # A batch is a set of input partitions; which rows it holds does not change the result.
    hashed.withColumn("batch", F.pmod(F.spark_partition_id(), F.lit(batches))).write.option("compression", PLAIN).partitionBy("batch").parquet(path)
    marked = spark.read.schema(with_columns(hashed.schema, "batch int")).parquet(path)
    runs = LineRuns(spark, min_documents, fanout)
    try:
        for batch in range(batches):
            own = marked.where(F.col("batch") == batch).select(F.explode(F.array_distinct("lines")).alias("line"))
            runs.add(own.where("line is not null").select("line.h1", "line.h2"))
        frequent = runs.frequent()
    finally:
        runs.close()
    at = (marked.select("r1", "r2", F.posexplode("lines").alias("at", "line")).where("line is not null")
          .select("r1", "r2", "at", "line.h1", "line.h2").join(frequent, _HASH))
    drops = at.groupBy("r1", "r2").agg(F.collect_set("at").alias("drops"))

    def without(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drops"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    own = documents.select(F.col(id_col).alias("doc_id"), _text(text_col).alias("text"))
    own = own.withColumns({"r1": _hash("a", F.col("doc_id"), F.col("text")), "r2": _hash("b", F.col("doc_id"), F.col("text"))})
    found = own.join(drops, ["r1", "r2"], "left")
    lines = F.array(F.split("text", "\n"))  # one element: the lines are split once a row
    return found.select(
        "doc_id",
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.transform(lines, without)[0]).alias("kept_text"))


def digest(deduped: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256)."""
    return deduped.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
