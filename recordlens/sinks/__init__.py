"""Writers: CSV exports, Parquet tables, JSON summary, staging, swap writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: A quote inside a cell is doubled, as standard readers expect.
CSV_OPTIONS = {"header": "true", "emptyValue": "", "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with one header line per part file (empty result: header-only file)."""
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)
    return path


def save_tables(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                partition_by: dict[str, list[str]] | None = None,
                row_counts: dict[str, int] | None = None) -> dict[str, str]:
    """Write each table under ``out_dir/<name>``; Parquet keeps explicit schemas.

    ``partition_by`` (e.g. {"patents": ["year"]}) lays a table out for
    partition pruning of year filters.  With ``row_counts`` the number of
    rows written per table is observed during the write itself (no second
    pass to verify the load).
    """
    from pyspark.sql import Observation
    out = {}
    for name, df in tables.items():
        obs = None
        if row_counts is not None:
            obs = Observation(f"rows_{name}")
            df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        path = f"{out_dir.rstrip('/')}/{name}"
        w = df.write.mode("overwrite")
        if partition_by and name in partition_by:
            # Rows of one value are brought together first (large values are split
            # at run time), else every task writes a file per value.
            w = df.hint("rebalance", *partition_by[name]).write.mode("overwrite").partitionBy(*partition_by[name])
        if fmt == "csv":
            w.options(**CSV_OPTIONS).csv(path)
        else:
            w.format(fmt).save(path)
        if obs is not None:
            row_counts[name] = obs.get["rows"]
        out[name] = path
    return out


def save_bucketed(tables: dict[str, DataFrame], keys: dict[str, str], num_buckets: int,
                  database: str | None = None) -> dict[str, str]:
    """Write catalog tables bucketed (and sorted) on their join key.

    Two tables bucketed on the same key with the same bucket count join
    without a shuffle on either side, e.g. relationships and inventors on
    ``inventor_id`` for the inventor and country queries.  Needs a catalog
    (Hive metastore on a cluster; the session catalog locally).
    """
    out = {}
    for name, df in tables.items():
        table = f"{database}.{name}" if database else name
        key = keys[name]
        (df.write.mode("overwrite").format("parquet")
         .bucketBy(num_buckets, key).sortBy(key).saveAsTable(table))
        out[name] = table
    return out


def export_results(results: dict[str, DataFrame], exports_dir: str) -> dict[str, str]:
    """One CSV directory per named result."""
    return {name: write_csv(df, f"{exports_dir.rstrip('/')}/{name}") for name, df in results.items()}


def write_json_document(df: DataFrame, path: str) -> str:
    """One JSON document per row (nulls kept as null, never NaN)."""
    doc = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    doc.write.mode("overwrite").text(path)
    return path


def overwrite_in_place(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Replace the files at ``path``, which ``df`` may have been read from.

    The result is written whole beside the old files, then swapped in by
    renames: a failure while writing leaves the old files as they were, and
    one between the renames leaves them under ``<path>.old``.
    """
    new, old = f"{path.rstrip('/')}.new", f"{path.rstrip('/')}.old"
    df.write.mode("overwrite").format(fmt).save(new)
    jvm = df.sparkSession._jvm
    at = {p: jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, old)}
    fs = at[path].getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    if fs.exists(at[old]):
        fs.delete(at[old], True)
    if fs.exists(at[path]) and not fs.rename(at[path], at[old]) or not fs.rename(at[new], at[path]):
        raise OSError(f"could not swap {new} into {path}")
    fs.delete(at[old], True)
    return path


def _published(spark, path: str) -> list[str]:
    """Names of the committed versions of a published table, oldest first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_versions")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def publish(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """A new version of the table at ``path``, which ``df`` may have been read from.

    The rows go to a folder of their own.  Creating one empty file, whose name holds the version's number and
    folder, commits them: no rename, so it is as safe on an object store as on a file system.  Readers of the old
    version go on undisturbed; a write that fails is never seen.
    """
    import uuid
    spark, base = df.sparkSession, path.rstrip("/")
    data = f"data-{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{base}/{data}")
    last = _published(spark, base)
    number = int(last[-1].split("__")[0]) + 1 if last else 1
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/_versions/{number:012d}__{data}")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).create(at, False).close()
    return f"{base}/{data}"


def read_published(spark, path: str, fmt: str = "parquet") -> DataFrame:
    """The newest committed version of a published table."""
    versions = _published(spark, path)
    if not versions:
        raise FileNotFoundError(f"nothing has been published at {path}")
    return spark.read.format(fmt).load(f"{path.rstrip('/')}/{versions[-1].split('__')[1]}")


def drop_old_versions(spark, path: str, keep: int = 2) -> list[str]:
    """Delete all but the newest ``keep`` versions (their commit first); returns the folders that went."""
    gone = []
    for name in _published(spark, path)[:-max(keep, 1)]:
        for part in (f"_versions/{name}", name.split("__")[1]):
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{part}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        gone.append(name.split("__")[1])
    return gone
