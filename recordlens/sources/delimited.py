"""Raw delimited files (TSV/CSV/TXT) as all-string DataFrames.

Rules kept from the original loader:

* every column is read as text (no type inference);
* header names are trimmed, unquoted and lower-cased;
* rows with more fields than the header are skipped, short rows are kept
  and padded with nulls;
* only an empty cell is null; ``legacy_na=True`` also nulls the NA tokens a
  pandas reader would (so a Namibia code ``NA`` survives by default).

Quotes inside a quoted cell are doubled, as spreadsheet and pandas writers do.

Ragged-row detection needs the parser to see the whole row, so rows are
parsed in full with a corrupt-record column; the filter then counts the
fields of each rejected row.  A file is read as splittable lines when none of
its lines has an odd number of quotes, which proves that no quoted cell spans
lines; else its byte ranges are cut into records first (``sources.ranges``),
so a large file with line breaks in its cells is still read by many tasks.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.functions.text import normalize_header
from recordlens.sources.ranges import numbered_records

CORRUPT = "_corrupt_record"

# The cell texts a pandas reader treats as missing by default.
PANDAS_NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

#: Header reads that run at the same time.
HEADER_JOBS = 16

SUPPORTED_SUFFIXES = (".csv", ".tsv", ".txt")


def detect_separator(path: str) -> str:
    """Tab for .tsv/.txt, comma otherwise."""
    return "\t" if path.lower().endswith((".tsv", ".txt")) else ","


def path_is_missing(exc: AnalysisException) -> bool:
    """Whether an error says that the path does not exist (and nothing else)."""
    return exc.getCondition() == "PATH_NOT_FOUND"


def read_header(spark: SparkSession, path: str, sep: str | None = None, as_is: bool = False) -> list[str]:
    """Header names of one file, normalised unless ``as_is`` (reads only the first line)."""
    sep = sep or detect_separator(path)
    cols = spark.read.option("header", True).option("sep", sep).option("inferSchema", False) \
        .option("escape", '"').csv(path).columns
    return cols if as_is else [normalize_header(c) for c in cols]


def cells_span_lines(spark: SparkSession, paths: list[str]) -> bool:
    """Whether a quoted cell may hold a line break: some line has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(paths).where(quotes % 2 == 1).isEmpty()


def _field_count(line, sep: str):
    # Remove quoted sections, then count separators outside quotes.
    unquoted = F.regexp_replace(line, r'"[^"]*"', "")
    sep_re = "\\t" if sep == "\t" else "\\" + sep if sep in ".|*+?()[]{}^$\\" else sep
    return F.size(F.split(F.regexp_replace(unquoted, r"[\r\n]+$", ""), sep_re))


def read_delimited(spark: SparkSession, path: str | list[str], sep: str | None = None,
                   columns: list[str] | None = None, legacy_na: bool = False,
                   multiline: bool | None = None, with_source_file: bool = False, row_order: bool = False,
                   among: list[str] | None = None, header: list[str] | None = None) -> DataFrame:
    """All-string read of files sharing one header; overlong rows dropped.

    ``columns`` selects a subset after the ragged-row filter (never before,
    so pruning cannot hide an overlong row).  ``multiline`` says whether cells
    may hold line breaks; by default the files are asked (one pass over them)
    and then read in ranges, while ``True`` parses each file whole in one task.
    ``row_order`` adds a number that follows the sorted file paths and the
    lines within each file, for operators whose pick depends on file order;
    ``among`` lists all files to be numbered together, if this read takes some.
    ``header`` names the columns; by default they have the normalised names.
    """
    paths = [path] if isinstance(path, str) else list(path)
    sep = sep or detect_separator(paths[0])
    header = header or read_header(spark, paths[0], sep)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header]
                          + [T.StructField(CORRUPT, T.StringType())])
    if row_order or multiline is None and cells_span_lines(spark, paths):
        raw = _read_ranges(spark, paths, sep, schema, row_order, with_source_file, among)
        return _finished(raw, header, sep, legacy_na, columns, ("row_order",) if row_order else ())
    multiline = bool(multiline)
    reader = (spark.read.schema(schema).option("header", True).option("sep", sep)
              .option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("multiLine", multiline).option("enforceSchema", True))
    if not multiline:
        # Splittable read: every row must still be parsed in full, or column
        # pruning would hide overlong rows from the ragged-row filter.
        reader = reader.option("columnPruning", False)
    raw = reader.csv(paths)
    if with_source_file:
        raw = raw.withColumn("source_file", F.col("_metadata.file_name"))
    return _finished(raw, header, sep, legacy_na, columns)


def _read_ranges(spark: SparkSession, paths: list[str], sep: str, schema: T.StructType, row_order: bool,
                 with_source_file: bool, among: list[str] | None = None) -> DataFrame:
    """The parsed records of quoted files, read range by range."""
    found = numbered_records(spark, paths, sep, among)
    options = {"sep": sep, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "multiLine": "true"}
    # Every record is parsed in full, or overlong ones would go unnoticed where columns are pruned.
    ddl = ", ".join("`" + f.name.replace("`", "``") + "` string" for f in schema)
    raw = found.select(F.from_csv("record", ddl, {**options, "columnPruning": "false"}).alias("r"), "file", "row_order")
    extra = ([F.regexp_extract("file", r"([^/]*)$", 1).alias("source_file")] if with_source_file else []) + ([F.col("row_order")] if row_order else [])
    return raw.select("r.*", *extra)


def _finished(raw: DataFrame, header: list[str], sep: str, legacy_na: bool, columns: list[str] | None,
              also: tuple[str, ...] = ()) -> DataFrame:
    """Overlong rows dropped, missing cells nulled, the asked columns."""
    keep = F.col(CORRUPT).isNull() | (_field_count(F.col(CORRUPT), sep) <= len(header))
    df = raw.where(keep).drop(CORRUPT)
    if legacy_na:
        df = df.select(*[F.when(F.col(c).isin(PANDAS_NA_TOKENS), F.lit(None).cast("string"))
                         .otherwise(F.col(c)).alias(c) if c in header else F.col(c) for c in df.columns])
    if columns is not None:
        df = df.select(*columns, *also)
    return df


def preview_delimited(spark: SparkSession, path: str | list[str], rows: int, **kwargs) -> DataFrame:
    """The first ``rows`` rows of a raw file (negative: none), for debugging only.

    The row cap of the original loader; no build takes it, so it cannot end
    up in the clean tables.
    """
    return read_delimited(spark, path, **kwargs).limit(max(int(rows), 0))


def list_raw_files(spark: SparkSession, raw_dir: str,
                   suffixes: tuple[str, ...] = SUPPORTED_SUFFIXES) -> list[str]:
    """Sorted paths of supported raw files in a directory (metadata only)."""
    glob = "*.{" + ",".join(s.lstrip(".") for s in suffixes) + "}"
    try:
        listing = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
                   .option("recursiveFileLookup", False).load(raw_dir).select("path", "length"))
        rows = listing.collect()  # one row per file: bounded by the file count
    except AnalysisException as exc:
        if path_is_missing(exc):
            return []
        raise
    return sorted(r["path"] for r in rows if r["path"].lower().endswith(suffixes))


def read_raw_files(spark: SparkSession, paths: list[str], legacy_na: bool = False,
                   with_source_file: bool = True, row_order: bool = False) -> list[DataFrame]:
    """One all-string frame per distinct (separator, header) layout, with the header's own names.

    Files sharing a layout are read by a single scan (one plan node however
    many monthly dumps there are); headers differ between layouts, so each
    layout is mapped on its own before the union.  ``row_order`` numbers the rows
    of all layouts together, by file and line.
    """
    layouts: dict[tuple[str, tuple[str, ...]], list[str]] = {}
    # Each header is a small job of its own; several run at a time.
    with ThreadPool(HEADER_JOBS) as pool:
        headers = pool.map(lambda p: tuple(read_header(spark, p, detect_separator(p), as_is=True)), paths)
    for p, header in zip(paths, headers):
        sep = detect_separator(p)
        if not header:                      # an empty file adds nothing
            continue
        layouts.setdefault((sep, header), []).append(p)
    return [read_delimited(spark, group, sep=sep, legacy_na=legacy_na, with_source_file=with_source_file, row_order=row_order, among=paths,
                           header=list(header))
            for (sep, header), group in layouts.items()]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ingest_to_parquet(spark: SparkSession, path: str | list[str], out_path: str, **kwargs) -> DataFrame:
    """Parse raw text once into Parquet and return the Parquet-backed frame."""
    read_delimited(spark, path, **kwargs).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


#: CSV written by this library or by pandas: doubled quotes, line breaks inside quotes.
CLEAN_CSV = {"header": "true", "mode": "PERMISSIVE", "escape": '"', "multiLine": "true"}


def read_clean_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """A clean table with its declared schema (CSV with header, or Parquet)."""
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    return spark.read.schema(schema).options(**CLEAN_CSV).csv(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  fmt: str = "csv") -> DataFrame:
    """Read an export; a missing path gives an empty frame (with ``schema`` if given)."""
    try:
        reader = spark.read.options(**(CLEAN_CSV if fmt == "csv" else {}))
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.format(fmt).load(path)
        df.schema  # resolve now so a missing path raises here
        return df
    except AnalysisException as exc:
        if path_is_missing(exc):
            return spark.createDataFrame([], schema or T.StructType([]))
        raise


def read_json_report(spark: SparkSession, path: str) -> DataFrame:
    """A (multi-line) JSON report document; missing -> empty frame."""
    try:
        df = spark.read.option("multiLine", True).json(path)
        df.schema
        return df
    except AnalysisException as exc:
        if path_is_missing(exc):
            return spark.createDataFrame([], T.StructType([]))
        raise
