"""Interaction audit of document filters; the duplicate filter runs on radix tries over whole texts.

1. Where the documents are read, each task judges the four text filters and inserts the whole texts
   into a compressed trie that holds the smallest id at the terminal of a text.  Rows that lose
   against a smaller id are duplicates already and leave as narrow rows; of each distinct text one
   row goes on.  A task's trie is emptied at ``LOCAL_BYTES`` of text.
2. Those rows are range-partitioned by adaptive text prefixes: a prefix of 8 characters, eight times
   longer as long as its texts hold more than a share of all bytes (a prefix is the whole text in the
   end).  A key depends on the text alone, so equal texts meet; within a partition the tries are built
   one key after the other, and traversed for the flags.
3. A row's failed filters are a bit mask.  Masks are counted per part, and all orders of the filters
   are computed from these counts: at most 32 per part, however many documents there are.

A group of copies sends one row per task to step 2, whatever its size.  Heavy prefixes are sent to all
tasks: each holds more than 1 / (8 * partitions) of the bytes, so there are fewer than 8 * partitions of
them per length.

Nulls: a null text is empty, a null part the empty string.  A row without an id is never a duplicate, and
has no label.  Rows with the same id do not flag each other and count each.  A document counts as good or
toxic if any of its label rows says so.  An empty table gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from recordlens.llm.common import batches, bounded_batches, stage, utf8

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
#: Text held by one task's trie before it is emptied.
LOCAL_BYTES = 32 << 20
#: Text in one outgoing batch.
BATCH_BYTES = 8 << 20
FIRST_PREFIX = 8
PREFIX_FACTOR = 8
#: Keys per partition that the adaptive prefixes aim at.
KEYS_PER_PARTITION = 8

_UPPER = bytes(range(0x41, 0x5B))
_CONTINUATION = bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class Limits:
    """Thresholds of the text filters A to D."""

    min_words: int = 200
    min_distinct_percent: int = 50
    max_upper_percent: int = 3
    symbols: bytes = b"#$%&*|"


def text_mask(text: bytes, limits: Limits = Limits()) -> int:
    """Bits of the failed filters A to D."""
    words = text.split()
    points = len(text.translate(None, _CONTINUATION))
    upper = len(text) - len(text.translate(None, _UPPER))
    failed = (len(words) < limits.min_words,
              100 * len(set(words)) < limits.min_distinct_percent * len(words),
              100 * upper > limits.max_upper_percent * points,
              len(text.translate(None, limits.symbols)) < len(text))
    return sum(1 << k for k, f in enumerate(failed) if f)


class Node:
    """Node of a compressed trie; ``held`` is the smallest id of a text that ends here, with its rows."""

    __slots__ = ("edge", "kids", "held")

    def __init__(self, edge: bytes):
        self.edge, self.kids, self.held = edge, {}, None


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Trie:
    """Compressed trie over whole texts with the smallest id at each terminal."""

    def __init__(self):
        self.root = Node(b"")

    def find(self, text: bytes) -> Node:
        """The terminal of ``text``, made if it is new."""
        node, at = self.root, 0
        while at < len(text):
            kid = node.kids.get(text[at])
            if kid is None:
                kid = node.kids[text[at]] = Node(text[at:])
                return kid
            if not text.startswith(kid.edge, at):
                cut = _shared(kid.edge, text[at:at + len(kid.edge)])
                upper = node.kids[text[at]] = Node(kid.edge[:cut])
                kid.edge = kid.edge[cut:]
                upper.kids[kid.edge[0]] = kid
                kid = upper
            node, at = kid, at + len(kid.edge)
        return node

    def terminals(self) -> Iterator[tuple[bytes, tuple]]:
        """(text, held) of every text."""
        stack = [(self.root, b"")]
        while stack:
            node, text = stack.pop()
            if node.held is not None:
                yield text, node.held
            stack += [(kid, text + kid.edge) for kid in node.kids.values()]


def offer(node: Node, key, part: str, mask: int, n: int) -> list[tuple]:
    """Put rows (id, part, mask, n) at their terminal; returns the rows that lose against a smaller id."""
    if node.held is None or key < node.held[0]:
        lost, node.held = node.held, (key, mask, {part: n})
        return [] if lost is None else [(lost[0], p, mask, k) for p, k in lost[2].items()]
    if key > node.held[0]:
        return [(key, part, mask, n)]
    node.held[2][part] = node.held[2].get(part, 0) + n
    return []


class _Out:
    """Rows (doc_id, part, mask, n, text) cut into batches of bounded bytes."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, key, part, mask, n, text=None):
        self.rows.append((key, part, mask, n, text))
        self.bytes += 64 + (len(text) if text else 0)

    def full(self) -> bool:
        return self.bytes >= BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(self.schema)
        arrays = [pa.array(c, pa.binary()).cast(f.type) if f.name == "text" else pa.array(c, f.type) for c, f in zip(columns, self.schema)]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _marked(limits: Limits):
    """mapInArrow over (doc_id, part, text): judged rows, with the text where it must still be compared."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, out = Trie(), 0, None
        for b in batches(rows):
            out = out or _Out(pa.schema([("doc_id", b.schema.field(0).type), ("part", pa.string()), ("mask", pa.int32()),
                                         ("n", pa.int64()), ("text", pa.string())]))
            for key, part, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), utf8(b.column(2))):
                if key is None:
                    out.add(None, part, text_mask(text, limits), 1)
                    continue
                node = trie.find(text)
                if node.held is None:
                    held += len(text)
                mask = text_mask(text, limits) if node.held is None else node.held[1]
                for k, p, m, n in offer(node, key, part, mask, 1):
                    out.add(k, p, m | DUPLICATE, n)
                if held >= LOCAL_BYTES:
                    yield from _emptied(trie, out)
                    trie, held = Trie(), 0
                if out.full():
                    yield out.take()
        if out:
            yield from _emptied(trie, out)
            yield out.take()
    return run


def _emptied(trie: Trie, out: _Out) -> Iterator[pa.RecordBatch]:
    for text, (key, mask, parts) in trie.terminals():
        for part, n in parts.items():
            out.add(key, part, mask, n, text)
            if out.full():
                yield out.take()


def _tries(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (key, doc_id, part, mask, n, text) sorted by key: the rows without their texts, duplicates flagged."""
    trie, now, out = Trie(), None, None
    for b in batches(rows):
        out = out or _Out(pa.schema([("doc_id", b.schema.field(1).type), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64())]))
        columns = [utf8(b.column(0)), *(b.column(k).to_pylist() for k in range(1, 5)), utf8(b.column(5))]
        for prefix, key, part, mask, n, text in zip(*columns):
            if prefix != now:
                yield from _flagged(trie, out)
                trie, now = Trie(), prefix
            for k, p, m, c in offer(trie.find(text), key, part, mask, n):
                out.rows.append((k, p, m | DUPLICATE, c))
        if len(out.rows) >= 1 << 14:
            yield out.take()
    if out:
        yield from _flagged(trie, out)
        yield out.take()


def _flagged(trie: Trie, out: _Out) -> Iterator[pa.RecordBatch]:
    for _, (key, mask, parts) in trie.terminals():
        out.rows += [(key, part, mask, n) for part, n in parts.items()]
        if len(out.rows) >= 1 << 14:
            yield out.take()


def prefix_keyed(texts: DataFrame, partitions: int) -> DataFrame:
    """``texts`` with ``key``: the shortest prefix of the ladder 8, 64, 512, ... whose texts hold at most a share of all bytes."""
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    longest = texts.agg(F.max(F.length("text"))).first()[0] or 0
    limit = total / (KEYS_PER_PARTITION * partitions)
    ladder = [FIRST_PREFIX]
    while ladder[-1] < longest:
        ladder.append(ladder[-1] * PREFIX_FACTOR)

    def start(length: Column | int) -> Column:
        return F.xxhash64(F.substring(F.col("text"), F.lit(1), length if isinstance(length, Column) else F.lit(length)))

    size = F.octet_length("text").cast("bigint").alias("size")
    steps = texts.select("text", size, F.explode(F.filter(F.lit(ladder), lambda k: k < F.length("text"))).alias("length"))
    heavy = (steps.select("length", start(F.col("length")).alias("start"), "size").groupBy("length", "start").agg(F.sum("size").alias("size"))
             .where(F.col("size") > limit).select("length", "start").collect())  # fewer than KEYS_PER_PARTITION * partitions per length
    keyed, depth = texts, F.lit(FIRST_PREFIX)
    for length in sorted({r["length"] for r in heavy}):
        name = f"__heavy{length}"
        own = texts.sparkSession.createDataFrame([(r["start"],) for r in heavy if r["length"] == length], f"{name} bigint")
        keyed = keyed.join(F.broadcast(own), (start(length) == F.col(name)) & (F.length("text") > length), "left")
        depth = F.when(F.col(name).isNotNull(), F.lit(length * PREFIX_FACTOR)).otherwise(depth)
    return keyed.select(F.substring(F.col("text"), F.lit(1), depth).alias("key"), *texts.columns)


def masks(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang",
          limits: Limits = Limits(), partitions: int | None = None) -> DataFrame:
    """(doc_id, part, mask, n): failed filters of every row, ``n`` rows at a time (over 1 only where an id repeats)."""
    spark = documents.sparkSession
    bounded_batches(spark)
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                           F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    narrow = StructType([own.schema[0], StructField("part", StringType()), StructField("mask", IntegerType()), StructField("n", LongType())])
    marked = stage(own.mapInArrow(_marked(limits), StructType([*narrow, StructField("text", StringType())])), "audit", "zstd")
    dealt = prefix_keyed(marked.where("text is not null"), partitions).repartitionByRange(partitions, "key").sortWithinPartitions("key")
    return marked.where("text is null").drop("text").unionByName(dealt.mapInArrow(_tries, narrow))


def _plan(filters: str) -> list[tuple]:
    """(k, order, step, bit, before, through) of every step of every order."""
    rows = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << filters.index(letter)
            rows.append((len(rows), "".join(order), step, bit, before, before | bit))
            before |= bit
    return rows


def interactions(found: DataFrame, labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Per part, order and step: documents kept, removed, redundant, failing this filter only, and lost labels."""
    spark = found.sparkSession
    named = labels.select(F.col(id_col).alias("__id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    named = named.where("__id is not null").groupBy("__id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    count = lambda which: F.sum(F.when(which, F.col("n")).otherwise(0))
    cells = (found.join(named, F.col("doc_id") == F.col("__id"), "left").groupBy("part", "mask")
             .agg(F.sum("n").alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic")))
    plan = spark.createDataFrame(_plan(FILTERS), "k int, filter_order string, step int, bit int, before int, through int")
    steps = cells.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(len(_plan(FILTERS)) - 1)))).join(F.broadcast(plan), "k")
    fails, earlier = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    now = fails & ~earlier
    total = lambda which, value="n": F.sum(F.when(which, F.col(value)).otherwise(0)).cast("bigint")
    counted = steps.groupBy("part", "filter_order", "step", "bit").agg(
        total(F.col("mask").bitwiseAND(F.col("through")) == 0).alias("kept"), total(now).alias("removed"),
        total(fails & earlier).alias("redundant"), total(F.col("mask") == F.col("bit")).alias("unique_fails"),
        total(now, "good").alias("good_lost"), total(now, "toxic").alias("toxic_lost"))
    # A window holds the 120 orders of one part and filter.
    return counted.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit")).cast("bigint")).drop("bit")


def audit(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """All orders of the five filters over ``documents``, per part."""
    return interactions(masks(documents, id_col=id_col, **options), labels, id_col=id_col)
