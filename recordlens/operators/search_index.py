"""Regular-expression search by trigram postings: read the rows that may match, verify those.

Every row with an id has a number, its place among the rows as written; a posting list says which rows hold three
consecutive characters (ASCII letters in small), as containers of row numbers (see ``operators.bitmaps``).  From a pattern the trigrams that any match must contain
are derived; their lists are intersected, alternatives united, and the rows left are verified by the engine's own
``rlike``.  The rows are stored in buckets of 32,768 numbers, and only buckets with a candidate are read.

A pattern that names no three consecutive characters, or whose syntax is not known for certain to mean the same
here and in the engine, is answered by a scan.  Rows without an id are always candidates.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from re import _constants as rc
from re import _parser as rp

from recordlens.operators import bitmaps as bm
from recordlens.session import materialize

GRAM = 3
#: Lists intersected for one alternative: the shortest ones.
LISTS = 4
#: Alternatives followed; a pattern with more is scanned.
ALTERNATIVES = 16
#: Bytes of text of which a task gathers the postings at once (arrays of some 60 times that, for one bucket).
GATHERED = 1 << 22
#: Containers of candidates up to which they are broadcast (8 MB).
BROADCAST = 2048
_CONTAINER = "key string, bucket bigint, few array<int>, bits binary"


def folded(text: str) -> str:
    """ASCII letters in small: what a case-insensitive match takes for equal."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def grams_of(text: str) -> set[str]:
    return {text[k:k + GRAM] for k in range(len(text) - GRAM + 1)}


def _both(a: list[set], b: list[set]) -> list[set]:
    """Alternatives of a sequence: one of each part."""
    out = [x | y for x in a for y in b]
    return out if len(out) <= ALTERNATIVES else (a if len(a) <= len(b) else b)


def _needed(items) -> list[set]:
    """Alternatives of a parsed sequence, each the trigrams that it needs; an empty set needs none."""
    out, run = [set()], ""

    def closed(found: list[set], text: str) -> list[set]:
        return _both(found, [grams_of(text)])

    for op, value in items:
        if op is rc.LITERAL:
            run += folded(chr(value))
            continue
        if op is rc.AT:                       # anchors take no characters, but the parts beside them still touch
            continue
        if op is rc.SUBPATTERN and len(value[3]) and all(o is rc.LITERAL for o, _ in value[3]) and not value[1] and not value[2]:
            run += "".join(folded(chr(v)) for _, v in value[3])
            continue
        out, run = closed(out, run), ""
        if op is rc.SUBPATTERN and not value[1] and not value[2]:
            out = _both(out, _needed(value[3]))
        elif op is rc.BRANCH:
            parts = [x for branch in value[1] for x in _needed(branch)]
            out = _both(out, parts if len(parts) <= ALTERNATIVES else [set()])
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT) and value[0] >= 1:
            out = _both(out, _needed(value[2]))
    return closed(out, run)


def required_grams(pattern: str) -> list[set[str]] | None:
    """Alternatives of trigrams, one of which every match contains whole; None if nothing is known.

    Only syntax that means the same in both engines is followed: no escapes but of signs and of the common
    classes, no inline flags, no class operations.
    """
    if re.search(r"\\[^\W_bBdDsSwW]|\\$|\(\?(?!:)|\[[^\]]*(\[|&&)|\[\^?\]", pattern):
        return None
    try:
        found = _needed(rp.parse(pattern))
    except (re.error, RecursionError, OverflowError):
        return None
    return found if all(found) else None


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the folded texts (null: none) one after another, and how many each has."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = memoryview(texts.buffers()[2] or b"")[at[0]:at[-1]].tobytes().lower()
    points = np.frombuffer(raw.decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = at - at[0]
    if len(points) < len(raw):
        at = np.append(0, np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80))[at]
    return points, np.diff(at)


def _postings(bucket: int, places: np.ndarray, columns: list[pa.Array]) -> Iterator[pa.RecordBatch]:
    """The containers of some rows of one bucket."""
    found = [_code_points(c) for c in columns]
    points, text = np.concatenate([p for p, _ in found]), np.repeat(np.arange(len(places) * len(columns)), np.concatenate([n for _, n in found]))
    whole = np.flatnonzero(text[2:] == text[:-2])                   # where a trigram of one text begins
    if not len(whole):
        return
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    letters = np.flatnonzero(seen)
    rank = np.zeros(0x110000, np.int64)
    rank[letters] = np.arange(len(letters))
    coded, k = rank[points], len(letters)
    gram = (coded[whole] * k + coded[whole + 1]) * k + coded[whole + 2]
    names = None
    if k >= 1 << 16:                                                # with the place it would not fit 63 bits
        names, gram = np.unique(gram, return_inverse=True)
    pairs = (gram << 15) | np.tile(places, len(columns))[text[whole]]
    pairs.sort()
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
    gram, place = pairs >> 15, (pairs & 32_767).astype(np.int32)
    starts = np.flatnonzero(np.append(True, gram[1:] != gram[:-1]))
    sizes, gram = np.diff(np.append(starts, len(gram))), gram[starts]
    if names is not None:
        gram = names[gram]
    spelled = letters[np.stack([gram // (k * k), gram // k % k, gram % k], 1)].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    keys = np.array([spelled[i:i + GRAM] for i in range(0, len(spelled), GRAM)], object)

    few = sizes <= bm.FEW
    lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(sizes[few])).astype(np.int32), place[np.repeat(few, sizes)])
    bits = pa.array([bm.bitmap([place[a:a + n]]) for a, n in zip(starts[~few], sizes[~few])], pa.binary())
    for of, short, full in ((keys[few], lists, pa.nulls(few.sum(), pa.binary())), (keys[~few], pa.nulls((~few).sum(), pa.list_(pa.int32())), bits)):
        if len(of):
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.string()), pa.array(np.full(len(of), bucket), pa.int64()), short, full],
                                             names=["key", "bucket", "few", "bits"])


def _batch_postings(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (number, texts...): the containers of the rows, gathered while they are of one bucket."""
    held, size, of = [], 0, None

    def gathered() -> Iterator[pa.RecordBatch]:
        if held:
            places, *columns = (pa.chunked_array(c).combine_chunks() for c in zip(*held))
            yield from _postings(of, (places.to_numpy() - 1) % 32_768, columns)

    for b in rows:
        numbers = b.column(0).to_numpy()
        buckets = (numbers - 1) // 32_768 + 1
        texts = [c.cast(pa.large_binary()) for c in b.columns[1:]]
        weight = np.sum([pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False) for c in texts], 0)
        parts = np.cumsum(weight) // GATHERED
        cuts = np.flatnonzero((buckets[1:] != buckets[:-1]) | (parts[1:] != parts[:-1])) + 1
        for start, end in zip([0, *cuts], [*cuts, len(numbers)]):
            if start == end:
                continue
            if held and (buckets[start] != of or size + weight[start:end].sum() > GATHERED):
                yield from gathered()
                held, size = [], 0
            of = int(buckets[start])
            held.append([c.slice(start, end - start) for c in (b.column(0), *texts)])
            size += int(weight[start:end].sum())
    yield from gathered()


class SearchIndex:
    """Rows and their postings under ``path``."""

    def __init__(self, spark: SparkSession, path: str, id_col: str, text_cols: tuple[str, ...]):
        self.spark, self.path, self.id_col, self.text_cols = spark, path.rstrip("/"), id_col, tuple(text_cols)

    def build(self, rows: DataFrame) -> SearchIndex:
        # Numbered as they are written, without moving a row: a bucket's rows follow each other in one task.
        placed = rows.withColumn("__place", F.monotonically_increasing_id())
        placed = placed.withColumn("__number", F.when(F.col(self.id_col).isNotNull(), F.col("__place") + 1)).drop("__place")
        placed = placed.withColumn("__bucket", F.bitmap_bucket_number("__number"))
        placed.write.mode("overwrite").partitionBy("__bucket").parquet(f"{self.path}/rows")
        placed.drop("__bucket").limit(0).write.mode("overwrite").parquet(f"{self.path}/schema")
        texts = self._rows().where("__number is not null").select("__number", *[F.col(c).cast("string").alias(c) for c in self.text_cols])
        merged = bm.merge(texts.mapInArrow(_batch_postings, _CONTAINER))
        # Sorted by trigram, so that a search reads few row groups.
        merged.repartitionByRange("key").sortWithinPartitions("key", "bucket").write.mode("overwrite").parquet(f"{self.path}/postings")
        return self

    def _rows(self) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/schema").schema
        return self.spark.read.schema(T.StructType([*schema, T.StructField("__bucket", T.LongType())])).parquet(f"{self.path}/rows")

    def candidates(self, pattern: str) -> DataFrame | None:
        """(bucket, bits): numbers of the rows that may match; None if the pattern needs a scan."""
        alternatives = required_grams(pattern)
        if alternatives is None:
            return None
        wanted = sorted(set().union(*alternatives))
        lists = self.spark.read.schema(_CONTAINER).parquet(f"{self.path}/postings").where(F.col("key").isin(wanted))
        sizes = {r["key"]: r["patent_count"] for r in bm.counts(lists).collect()}       # one row per trigram of the pattern
        uses = [sorted(a, key=sizes.__getitem__)[:LISTS] for a in alternatives if all(g in sizes for g in a)]
        bits = self._bits(lists.where(F.col("key").isin(sorted({g for u in uses for g in u}))))
        found = None
        for use in uses:
            met = bits.where(F.col("key").isin(use)).groupBy("bucket").agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n"))
            met = met.where(F.col("n") == len(use)).select("bucket", "bits")
            found = met if found is None else found.unionByName(met)
        if found is None:
            return self.spark.createDataFrame([], "bucket bigint, bits binary")
        united = found.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return materialize(united.where(F.bitmap_count("bits") > 0))

    @staticmethod
    def _bits(lists: DataFrame) -> DataFrame:
        """(key, bucket, bits) of containers of either kind."""
        few = (lists.where("few is not null").select("key", "bucket", F.explode("few").alias("place"))
               .groupBy("key", "bucket").agg(F.bitmap_construct_agg("place").alias("bits")))
        return materialize(few.unionByName(lists.where("bits is not null").select("key", "bucket", "bits")))

    def candidate_rows(self, pattern: str) -> DataFrame:
        """The rows that must be verified."""
        met = self.candidates(pattern)
        every = self._rows()
        if met is None:
            return every.drop("__number", "__bucket")
        buckets = [r["bucket"] for r in met.select("bucket").collect()]                 # one per 32,768 rows at most
        rows = every.where(F.col("__bucket").isin(buckets))
        if len(buckets) <= BROADCAST:
            met = F.broadcast(met)
        place = F.bitmap_bit_position("__number").cast("int")
        byte = F.conv(F.hex(F.substring("bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.bit_get(byte, F.pmod(place, F.lit(8))) == 1
        kept = rows.join(met.withColumnRenamed("bucket", "__of"), F.col("__bucket") == F.col("__of")).where(hit).drop("__of", "bits")
        return kept.unionByName(every.where("__bucket is null")).drop("__number", "__bucket")

    def search(self, pattern: str) -> DataFrame:
        """Rows of which some text matches the case-insensitive pattern."""
        hit = F.lit(False)
        for c in self.text_cols:
            hit = hit | F.coalesce(F.col(c).rlike("(?i)" + pattern), F.lit(False))
        return self.candidate_rows(pattern).where(hit)
