"""SimHash near-duplicates found with BK-trees over the fingerprints.

1. Each text gets a 64-bit SimHash of its word shingles (whole text, XXH64).
2. Distinct fingerprints are dealt to shards: the 64 bits are cut into
   ``radius + 2`` blocks, and every pair of blocks keys one shard.  Two
   fingerprints within ``radius`` bits agree in at least two whole blocks, so
   they meet in at least one shard.
3. A BK-tree is built per shard (children keyed by their integer distance to the
   parent) and every fingerprint of the shard is looked up in it, following only
   the edges within the radius.  Shards over ``shard_rows`` fingerprints are cut
   into pieces of that size at most, and each pair of pieces is one cell: a tree
   over the one, queries from the other.  No task holds more than one cell's tree.
4. A cell returns one link per fingerprint (to the least one it is joined to),
   not all pairs; connected components follow by star contraction.

The trees travel to their queries by a shuffle, not by a driver broadcast: the
driver never sees fingerprints, links or components.

Nulls: a null or empty text has fingerprint zero and is linked like any other.
Null ids get a component like others (the smallest non-null id, null if none).
Repeated rows each keep their row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from recordlens.llm.common import batches, bounded_batches, stage, utf8

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
SHARD_ROWS = 4096
#: (query, node) pairs looked at in one numpy step: bounds memory.
FRONTIER = 1 << 20


def fingerprint(text: bytes | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Bit k is 1 if it is set in over half of the shingle hashes; no word: 0."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) <= shingle_words:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        first = np.append(0, ends[:-shingle_words]).tolist()
        last = (ends[shingle_words - 1:] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], seed) for a, b in zip(first, last)]
    values = np.array(hashes, dtype=np.uint64)
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(values), 1 << 16):
        part = values[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * votes > len(values)).tolist())


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(documents: DataFrame, id_col: str, text_col: str, shingle_words: int = SHINGLE_WORDS,
                 seed: int = SEED) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit integer."""
    bounded_batches(documents.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            fps = [_signed(fingerprint(t, shingle_words, seed)) for t in utf8(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    own = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, StructType([StructField("doc_id", own.schema[0].dataType), StructField("fp", LongType())]))


def block_masks(radius: int) -> list[int]:
    """Masks of all pairs of the ``radius + 2`` bit blocks."""
    n = radius + 2
    edge = [64 * k // n for k in range(n + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edge, edge[1:])]
    return [x | y for x, y in combinations(block, 2)]


class Forest:
    """BK-trees over runs of fingerprints, all built and searched level by level.

    ``run[i]`` names the tree of ``fp[i]``.  The children of a node are stored
    together, ordered by their distance to it.
    """

    def __init__(self, fp: np.ndarray, run: np.ndarray):
        n = len(fp)
        self.fp = fp
        names, root = np.unique(run, return_index=True)
        self.roots = dict(zip(names.tolist(), root.tolist()))
        parent, edge = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
        at = root[np.searchsorted(names, run)]
        live = np.flatnonzero(at != np.arange(n))
        while len(live):
            far = np.bitwise_count(fp[live] ^ fp[at[live]]).astype(np.int64)
            slot = at[live] * 65 + far
            _, first, back = np.unique(slot, return_index=True, return_inverse=True)
            child = live[first]                       # the first to come to a free slot becomes the child
            parent[child], edge[child] = at[live][first], far[first]
            at[live] = child[back]
            live = live[at[live] != live]
        own = np.flatnonzero(parent >= 0)
        slot = parent[own] * 65 + edge[own]
        order = np.argsort(slot, kind="stable")
        self.slot, self.child = slot[order], own[order]

    def within(self, query: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query index, node index) of all pairs within the radius, in pieces."""
        stack = [(np.arange(len(query)), root)]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(q[half:], node[half:]), (q[:half], node[:half])]
                continue
            far = np.bitwise_count(query[q] ^ self.fp[node]).astype(np.int64)
            near = far <= radius
            if near.any():
                yield q[near], node[near]
            low = np.searchsorted(self.slot, node * 65 + np.maximum(far - radius, 1))
            high = np.searchsorted(self.slot, node * 65 + np.minimum(far + radius, 64), "right")
            count = high - low
            if count.sum():
                q = np.repeat(q, count)
                at = np.arange(len(q)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
                stack.append((q, self.child[at]))


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the classes of a[i] and b[i] the smaller of their labels, until all agree."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            shorter = label[label]
            if np.array_equal(shorter, label):
                break
            label[:] = shorter


def cell_links(cell: np.ndarray, fp: np.ndarray, tree: np.ndarray, query: np.ndarray, radius: int):
    """Links of whole cells: (fingerprint, a smaller one it is joined to).

    ``tree`` and ``query`` flag the rows that are in the cell's tree and that are looked up.
    """
    size = np.bincount(cell)
    want = size[cell] > 1
    cell, fp, tree, query = cell[want], fp[want], tree[want], query[want]
    if not len(fp) or not tree.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((fp, cell))
    cell, fp, tree, query = cell[order], fp[order], tree[order], query[order]
    bits = fp.view(np.uint64)
    nodes = np.flatnonzero(tree)
    forest = Forest(bits[nodes], cell[nodes])
    asks = np.flatnonzero(query)
    root = np.array([forest.roots.get(c, -1) for c in cell[asks].tolist()], dtype=np.int64)
    asks, root = asks[root >= 0], root[root >= 0]
    label = np.arange(len(fp))
    for q, node in forest.within(bits[asks], root, radius):
        _join(label, asks[q], nodes[node])
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked], fp[label[linked]]


def _cells(radius: int):
    """mapInArrow over rows sorted by cell; cells may run over several batches."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def links(parts):
            mask, value, a, b, fp, shard = (np.concatenate(c) for c in zip(*parts))
            new = np.ones(len(fp), dtype=bool)
            new[1:] = (mask[1:] != mask[:-1]) | (value[1:] != value[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            return cell_links(np.cumsum(new) - 1, fp, shard == a, shard == b, radius)

        def batch(found):
            return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["u", "v"])

        for batch_in in batches(rows):
            cols = [c.to_numpy(zero_copy_only=False) for c in batch_in.columns]
            last = [cols[0][-1], cols[1][-1], cols[2][-1], cols[3][-1]]
            tail = np.ones(len(cols[0]), dtype=bool)
            for c, x in zip(cols, last):
                tail &= c == x
            cut = int(np.argmin(tail[::-1])) if not tail.all() else len(tail)
            whole = len(tail) - cut
            if whole:
                yield batch(links([*held, [c[:whole] for c in cols]]))
                held = []
            held.append([c[whole:] for c in cols])
        if held:
            yield batch(links(held))
    return run


def near_links(distinct: DataFrame, radius: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(u, v) with v < u: links that join exactly the fingerprints chained within ``radius``."""
    masks = [_signed(m) for m in block_masks(radius)]
    keyed = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "value"))
    full = (keyed.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select("mask", "value", F.ceil(F.col("n") / F.lit(shard_rows)).cast("int").alias("pieces")))
    dealt = (keyed.join(full, ["mask", "value"])
             .withColumn("shard", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
             .select("mask", "value", F.least("shard", "other").alias("a"), F.greatest("shard", "other").alias("b"), "fp", "shard"))
    cell = ["mask", "value", "a", "b"]
    placed = dealt.repartition(*cell).sortWithinPartitions(*cell)
    return placed.mapInArrow(_cells(radius), "u bigint, v bigint").distinct()


def components(links: DataFrame, name: str = "links") -> DataFrame:
    """(node, root): for every linked node the smallest node it is connected to.

    Large-star and small-star contraction; each round is written to the shared
    folder.  The work per round is two aggregations and joins on the node.
    """
    edges = stage(links, name)
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
                 .select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).where("u <> v").distinct())
        edges = stage(small, name)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(now)


def near_duplicates(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED,
                    shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``documents``."""
    marked = stage(fingerprints(documents, id_col, text_col, shingle_words, seed), "fingerprints")
    distinct = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = components(near_links(distinct.select("fp"), max_bits, shard_rows))
    rooted = distinct.join(classes, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(lowest, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents without near-duplicates, with their own columns: of each component one row stays.

    That is the row of the smallest id; rows without an id come after all others, and rows of one id are told
    apart by a hash of their text.  Of identical rows one stays.
    """
    key = ["__a", "__b"]
    keyed = documents.withColumns({k: F.xxhash64(F.lit(k), F.col(id_col), F.col(text_col)) for k in key})
    row = F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"), *key)
    own = keyed.select(row.alias("__row"), F.col(text_col).alias("__text"))
    found = stage(near_duplicates(own, id_col="__row", text_col="__text", **options), "components")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    dropped = found.where(~stays).select("doc_id.__a", "doc_id.__b").distinct()
    left = keyed.join(dropped, key, "left_anti")
    repeated = stage(found.where(stays).groupBy("doc_id.__a", "doc_id.__b").count().where("count > 1").select(*key), "repeated")
    if repeated.isEmpty():
        return left.drop(*key)
    once = left.join(repeated, key, "left_semi").dropDuplicates(key)
    return left.join(repeated, key, "left_anti").unionByName(once).drop(*key)
