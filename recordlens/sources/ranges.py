"""Quoted text files read range by range, with line numbers.

A quoted cell may hold line breaks, so the reader of a byte range does not know whether it starts inside
a cell.  Three steps answer that without handing a whole file to one task:

1. Every range (the part of a file that one Spark split covers) is scanned for both answers: does it end
   inside a cell if it starts outside, and if it starts inside?  One row per range leaves this scan.
2. These rows are composed along each file: a range whose two answers agree sets the state, one whose
   answers swap turns it, any other hands it on.  Line counts are summed the same way, so each range
   knows its true start state and the number of its first line.
3. Each range cuts its lines into records from its true state.  A record that runs over a border is
   left as fragments, which are put together by file and place.

The composed rows (one per range, far smaller than the ranges) are sent to all tasks of step 3.  The
ranges of the steps must be the same; the number of ranges is pinned for the session, and a range without
a state raises.

Lines end in ``\\n`` or ``\\r\\n``.  A cell that is never closed runs to the end of its file, as for any reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlens.session import materialize

#: Bits of ``row_order`` below the number of the file.
LINE_BITS = 40

_RANGE = "file string, start bigint, lines bigint, from_outside boolean, from_inside boolean, first_text bigint"
_RECORD = "file string, line bigint, record string"
_FRAGMENT = "file string, start bigint, opens boolean, line bigint, record string"


def ends_inside(line: bytes, inside: bool, sep: bytes) -> bool:
    """Whether a line leaves a quoted cell open, given whether it starts inside one.

    A quote opens a cell only as its first character; inside, a doubled quote is text and any other
    ends the quoted part, after which the cell runs to the next separator.
    """
    at = 0
    while True:
        if not inside:
            if not line.startswith(b'"', at):
                at = line.find(sep + b'"', at) + len(sep)
                if at < len(sep):
                    return False
            at += 1
        k = line.find(b'"', at)
        while k >= 0 and line.startswith(b'"', k + 1):
            k = line.find(b'"', k + 2)
        if k < 0:
            return True
        k = line.find(sep, k + 1)
        if k < 0:
            return False
        at, inside = k + len(sep), False


def text_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, start, value): the lines of text files with the file and the first byte of the range they are read in."""
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")


def _runs(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows cut where the range (first two columns) changes: ((file, start), batch)."""
    for b in rows:
        files, starts = b.column(0), b.column(1).to_numpy(zero_copy_only=False)
        at = 0
        while at < b.num_rows:
            # The rows of a range are contiguous, so the last row decides for most batches.
            key = (files[at].as_py(), int(starts[at]))
            end = b.num_rows
            if int(starts[-1]) != key[1] or files[-1].as_py() != key[0]:
                end = at + 1
                while end < b.num_rows and int(starts[end]) == key[1] and files[end].as_py() == key[0]:
                    end += 1
            yield key, b.slice(at, end - at)
            at = end


def _bytes(column: pa.Array) -> list[bytes]:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def _scan(sep: bytes):
    """mapInArrow over (file, start, value): one row per range."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, lines, outside, inside, text = None, 0, False, True, None

        def told():
            return pa.RecordBatch.from_pylist([dict(file=now[0], start=now[1], lines=lines, from_outside=outside, from_inside=inside, first_text=text)],
                                              schema=pa.schema([("file", pa.string()), ("start", pa.int64()), ("lines", pa.int64()),
                                                                ("from_outside", pa.bool_()), ("from_inside", pa.bool_()), ("first_text", pa.int64())]))

        for key, b in _runs(rows):
            if key != now:
                if now is not None:
                    yield told()
                now, lines, outside, inside, text = key, 0, False, True, None
            value = b.column(2)
            if text is None:
                k = next((k for k, x in enumerate(_bytes(value)) if x.rstrip(b"\r")), None)
                text = None if k is None else lines + k
            for line in _bytes(value.filter(pc.match_substring(value, '"'))):
                outside, inside = ends_inside(line, outside, sep), ends_inside(line, inside, sep)
            lines += b.num_rows
        if now is not None:
            yield told()
    return run


def range_states(lines: DataFrame, sep: str) -> DataFrame:
    """(file, start, inside, ends_inside, first_line, header): the true start state and first line number of every range.

    ``header`` is the number of the file's first line with text.
    """
    told = materialize(lines.mapInArrow(_scan(sep.encode()), _RANGE))
    # One row per range: a window over a file's ranges is small however large the file is.
    order = Window.partitionBy("file").orderBy("start")
    upto, before = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.col("from_outside") == F.col("from_inside")
    swaps = (F.col("from_outside") & ~F.col("from_inside")).cast("int")
    turned = told.withColumn("turns", F.sum(swaps).over(upto))
    last = turned.withColumns({
        "set_to": F.last(F.when(sets, F.col("from_outside")), ignorenulls=True).over(before),
        "set_at": F.coalesce(F.last(F.when(sets, F.col("turns")), ignorenulls=True).over(before), F.lit(0)),
        "so_far": F.coalesce(F.lag("turns").over(order), F.lit(0)),
        "first_line": F.coalesce(F.sum("lines").over(before), F.lit(0))})
    inside = F.coalesce("set_to", F.lit(False)) != ((F.col("so_far") - F.col("set_at")) % 2 == 1)
    known = last.withColumn("inside", inside)
    return materialize(known.select(
        "file", "start", "inside", F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("ends_inside"), "first_line",
        F.min(F.col("first_line") + F.col("first_text")).over(Window.partitionBy("file")).alias("header")))


def _cut(sep: bytes, fragments: bool):
    """mapInArrow over (file, start, value, inside, first_line): whole records, or the fragments at the borders."""
    names = ["file", "start", "opens", "line", "record"] if fragments else ["file", "line", "record"]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string()] if fragments else [pa.string(), pa.int64(), pa.string()]

    def batch(columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()).cast(k) if n == "record" else pa.array(c, k)
                                           for c, k, n in zip(columns, kinds, names)], names=names)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, line, head, open_lines, since = None, 0, None, None, 0   # head: lines before the first record begins

        def left():
            if fragments and now is not None:
                found = [(now[0], now[1], False, line, b"\n".join(head))] if head is not None else []
                found += [(now[0], now[1], True, since, b"\n".join(open_lines))] if open_lines is not None else []
                if found:
                    yield batch(zip(*found))

        for key, b in _runs(rows):
            if key != now:
                yield from left()
                if b.column(3)[0].as_py() is None:
                    raise RuntimeError(f"the ranges of {key[0]} changed while it was read; read it again")
                now, line, open_lines = key, b.column(4)[0].as_py(), None
                head = [] if b.column(3)[0].as_py() else None
                done = head is None
            value = b.column(2)
            if done and open_lines is None and not pc.any(pc.match_substring(value, '"')).as_py():
                if not fragments:
                    yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string()), pa.array(range(line, line + b.num_rows), pa.int64()),
                                                      value.cast(pa.string())], names=names)
                line += b.num_rows
                continue
            out = []
            for text in _bytes(value):
                if not done:
                    head.append(text)
                    done = not ends_inside(text, True, sep)
                elif open_lines is not None:
                    open_lines.append(text)
                    if not ends_inside(text, True, sep):
                        out.append((now[0], since, b"\n".join(open_lines)))
                        open_lines = None
                elif ends_inside(text, False, sep):
                    since, open_lines = line, [text]
                else:
                    out.append((now[0], line, text))
                line += 1
            if out and not fragments:
                yield batch(zip(*out))
        yield from left()
    return run


def records(lines: DataFrame, states: DataFrame, sep: str) -> DataFrame:
    """(file, line, record): whole records with the number of their first line; blank lines and headers are left out."""
    known = lines.join(F.broadcast(states.withColumnsRenamed({"file": "f", "start": "s"})),
                       (F.col("file") == F.col("f")) & (F.col("start") == F.col("s")), "left")
    columns = ["file", "start", "value", "inside", "first_line"]
    whole = known.select(*columns).mapInArrow(_cut(sep.encode(), False), _RECORD)
    cut = known.where(F.col("inside") | F.col("ends_inside") | F.col("inside").isNull())
    pieces = cut.select(*columns).mapInArrow(_cut(sep.encode(), True), _FRAGMENT)
    # At most two fragments a range; a fragment belongs to the last one before it that opens a record.
    placed = pieces.withColumn("of", F.last(F.when(F.col("opens"), F.col("start")), ignorenulls=True).over(
        Window.partitionBy("file").orderBy("start", "opens").rowsBetween(Window.unboundedPreceding, 0)))
    joined = placed.groupBy("file", "of").agg(
        F.array_sort(F.collect_list(F.struct("start", "opens", "record"))).alias("parts"), F.min_by("line", F.struct("start", ~F.col("opens"))).alias("line"))
    stitched = joined.select("file", "line", F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    header = states.groupBy("file").agg(F.min("header").alias("header")).withColumnRenamed("file", "f")
    both = whole.unionByName(stitched).join(F.broadcast(header), F.col("file") == F.col("f"))
    clean = both.select("file", "line", F.regexp_replace("record", r"\r\z", "").alias("record"), "header")
    return clean.where((F.col("line") > F.col("header")) & (F.col("record") != "")).drop("header")


def numbered_records(spark: SparkSession, paths: list[str], sep: str, among: list[str] | None = None) -> DataFrame:
    """(file, row_order, record): records of all files; ``row_order`` follows the sorted file paths and the lines within.

    ``among`` names the files that the paths are numbered with, if they are read in several groups.
    """
    lines = text_lines(spark, paths)
    # The list of files names local ones with three slashes, the column that tells a row's file with one.
    files = sorted(re.sub("^file:/+", "file:/", f) for f in spark.read.text(among or paths).inputFiles())
    rank = spark.createDataFrame([(f, k) for k, f in enumerate(files)], "file string, rank bigint")  # one row per file
    found = records(lines, range_states(lines, sep), sep).join(F.broadcast(rank), "file", "left")
    unknown = F.raise_error(F.concat(F.lit("not among the numbered files: "), F.col("file"))).cast("bigint")
    return found.select("file", (F.shiftleft(F.coalesce("rank", unknown), LINE_BITS) + F.col("line")).alias("row_order"), "record")
