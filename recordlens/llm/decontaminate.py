"""Benchmark decontamination with suffix arrays over the training text.

Documents are handled in shards (Arrow batches).  Each shard's words become a
sorted array of suffixes; every suffix of every benchmark item is looked up in
it by binary search, which gives the training positions that start with the
same words.  Matches are then extended to the longest verbatim passage.

* Suffixes that cannot match (their first words start no benchmark window) are
  left out of the array; a word that no item contains ends every match, so such
  words need no identity of their own.
* Benchmark items are taken in blocks of at most ``block_words`` words, each
  broadcast on its own: the bound holds for any benchmark size.  With several
  blocks the running hits are written to the shared folder between blocks.
* Every document row is judged by itself: no shuffle, whatever the skew.

Nulls: a null text has no words; an item without words is skipped, one with a null
id hits like any other but is neither counted nor named.  Repeated document rows are judged one by one.  An empty benchmark
contaminates nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from recordlens.llm.common import alnum_words, batches, bounded_batches, stage, utf8

WINDOW = 10
BLOCK_WORDS = 2_000_000

RESULT = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
          "longest_match bigint, longest_start bigint, longest_item string")
_STATE = "__hit binary, __items array<string>, __len bigint, __at bigint, __with string"


@dataclass
class Block:
    """Windows of a set of benchmark items, by word number (0 is no word)."""

    window: int
    number: dict[bytes, int]
    words: np.ndarray            # all item words, items separated by 0
    keys: np.ndarray             # distinct windows as fixed-width big-endian byte strings
    high: np.ndarray             # the same, short windows padded upwards
    lengths: np.ndarray          # words of each distinct window
    suffix_of: np.ndarray        # CSR: suffixes (positions in ``words``) of each window
    suffix_at: np.ndarray
    items: list[str | None]      # an item without an id hits, but is not named
    item_of: np.ndarray          # item index of each position in ``words``
    heads: list[np.ndarray]      # sorted codes of first 1, 2, 3 words of the windows


def _code(words: np.ndarray, at: np.ndarray, n: int, base: int) -> np.ndarray:
    code = words[at].astype(np.uint64)
    for k in range(1, n):
        code = code * np.uint64(base) + words[at + k].astype(np.uint64)
    return code


def _keys(words: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    table = words[at[:, None] + np.arange(window)].astype(">u4")
    return np.ascontiguousarray(table).view(f"S{4 * window}").ravel()


def build_block(items: list[tuple[str, list[bytes]]], window: int) -> Block:
    number: dict[bytes, int] = {}
    flat, item_of, starts, lengths = [], [], [], []
    for k, (_, words) in enumerate(items):
        size = min(window, len(words))
        for i in range(len(words) - size + 1):
            starts.append(len(flat) + i)
            lengths.append(size)
        flat += [number.setdefault(w, len(number) + 1) for w in words] + [0]
        item_of += [k] * (len(words) + 1)
    words = np.array(flat + [0] * window, dtype=np.int64)
    at, size = np.array(starts, dtype=np.int64), np.array(lengths, dtype=np.int64)
    table = words[at[:, None] + np.arange(window)] * (np.arange(window) < size[:, None])
    low = np.ascontiguousarray(table.astype(">u4"))
    names, first, back = np.unique(low.view(f"S{4 * window}").ravel(), return_index=True, return_inverse=True)
    high = low.copy()
    high[np.arange(window) >= size[:, None]] = 0xFFFFFFFF
    order = np.argsort(back, kind="stable")
    base = len(number) + 1
    heads = []
    for n in (1, 2, 3):
        own = at[size >= 3] if n == 3 else at[size == n]
        heads.append(np.unique(_code(words, own, n, base)))
    return Block(window, number, words, names, high.view(f"S{4 * window}").ravel()[first], size[first], at[order],
                 np.append(0, np.cumsum(np.bincount(back, minlength=len(names)))), [i for i, _ in items],
                 np.array(item_of + [0] * window, dtype=np.int64), heads)


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts [2, 3]: owner 0 0 1 1 1 and rank 0 1 0 1 2."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


def search(shard: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of the windows: (position in the shard, window index).

    ``shard`` holds word numbers and ends with ``window`` zeros.
    """
    base, n = len(block.number) + 1, len(shard) - block.window
    at = np.flatnonzero(shard[:n])
    keep = np.zeros(len(at), dtype=bool)
    for size, heads in enumerate(block.heads, 1):
        if len(heads):
            keep |= _among(_code(shard, at, size, base), heads)
    at = at[keep]
    keys = _keys(shard, at, block.window)
    order = np.argsort(keys, kind="stable")
    at, keys = at[order], keys[order]                       # the shard's suffix array
    first = np.searchsorted(keys, block.keys, "left")
    last = np.searchsorted(keys, block.high, "right")
    found = np.flatnonzero(last > first)
    owner, rank = _spread((last - first)[found])
    return at[first[found][owner] + rank], found[owner]


def _longest(shard: np.ndarray, at: np.ndarray, which: np.ndarray, block: Block):
    """(occurrence, suffix position, words in common) for every suffix of the window."""
    owner, rank = _spread(block.suffix_at[which + 1] - block.suffix_at[which])
    suffix = block.suffix_of[block.suffix_at[which][owner] + rank]
    length = block.lengths[which][owner].copy()
    live = np.arange(len(owner))
    while len(live):
        a, b = at[owner[live]] + length[live], suffix[live] + length[live]
        same = (shard[a] == block.words[b]) & (shard[a] != 0)
        live = live[same]
        length[live] += 1
    return owner, suffix, length


def _judge(texts: list[bytes | None], block: Block):
    """Per text: word count, hit mask, item names, longest match (length, start, item)."""
    words = [alnum_words(t) for t in texts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    starts = np.append(0, np.cumsum(sizes + 1))
    get, flat = block.number.get, []
    for w in words:
        flat += [get(x, 0) for x in w]
        flat.append(0)
    shard = np.array(flat + [0] * block.window, dtype=np.int64)
    at, which = search(shard, block) if len(block.keys) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    change = np.bincount(at, minlength=len(shard) + 1) - np.bincount(at + block.lengths[which], minlength=len(shard) + 1)
    hit = np.cumsum(change) > 0
    doc = np.searchsorted(starts, at, "right") - 1
    best: dict[int, tuple[int, int, int]] = {}
    items: dict[int, set[int]] = {}
    if len(at):
        owner, suffix, length = _longest(shard, at, which, block)
        pair = np.unique(doc[owner] * len(block.items) + block.item_of[suffix])
        for p in pair.tolist():
            items.setdefault(p // len(block.items), set()).add(p % len(block.items))
        order = np.lexsort((block.item_of[suffix], at[owner], -length, doc[owner]))
        order = order[np.unique(doc[owner][order], return_index=True)[1]]
        for i in order.tolist():
            d = int(doc[owner[i]])
            best[d] = (int(length[i]), int(at[owner[i]] - starts[d]), int(block.item_of[suffix[i]]))
    return sizes, [hit[starts[d]:starts[d] + n] for d, n in enumerate(sizes.tolist())], items, best


def _step(text: str, shared, keep: list[str], fields, final: bool):
    """A mapInArrow function: judge the rows against one block."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = shared.value
        for b in batches(rows):
            sizes, hits, items, best = _judge(utf8(b.column(text)), block)
            old = {n: b.column(n).to_pylist() for n in ("__hit", "__items", "__len", "__at", "__with") if n in b.schema.names}
            out = []
            for d, n in enumerate(sizes.tolist()):
                mask, names = hits[d], {block.items[i] for i in items.get(d, ())} - {None}
                length, at, item = best.get(d, (0, None, None))
                item = None if item is None else block.items[item]
                if old:
                    mask = mask | np.unpackbits(np.frombuffer(old["__hit"][d], dtype=np.uint8), count=n).astype(bool)
                    names |= set(old["__items"][d])
                    if old["__len"][d] >= length:
                        length, at, item = old["__len"][d], old["__at"][d], old["__with"][d]
                if final:
                    names = sorted(names)
                    n_hit = int(mask.sum())
                    out.append((n, n_hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(),
                                n_hit > 0, length, at, item))
                else:
                    out.append((np.packbits(mask).tobytes(), sorted(names), length, at, item))
            new = [pa.array(list(c), type=f.type) for c, f in zip(zip(*out), fields)]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in keep] + new, names=[*keep, *(f.name for f in fields)])
    return run


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[Block]:
    items, size = [], 0
    named = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    for row in named.toLocalIterator():
        words = alnum_words(row["t"].encode() if row["t"] else b"")
        if not words:
            continue
        if items and size + len(words) > block_words:
            yield build_block(items, window)
            items, size = [], 0
        items.append((row["i"], words))
        size += len(words)
    yield build_block(items, window)


def decontaminate(documents: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``documents`` plus the columns of ``RESULT`` (a clashing input column is replaced).

    A word is hit if it lies in an occurrence of a window of ``window``
    consecutive item words (a shorter item is one window).  ``longest_match`` is
    the length in words of the longest verbatim passage that contains a window,
    ``longest_start`` its word offset, ``longest_item`` its item; ties go to the
    earliest place, then the earlier item.
    """
    spark = documents.sparkSession
    bounded_batches(spark)
    from pyspark.sql.pandas.types import to_arrow_schema
    df, block = documents, None

    def apply(df: DataFrame, block: Block, final: bool) -> DataFrame:
        ddl = RESULT if final else _STATE
        drop = {f.name for f in StructType.fromDDL(ddl)} | ({f.name for f in StructType.fromDDL(_STATE)} if final else set())
        keep = [f for f in df.schema if f.name.lower() not in drop]
        schema = StructType([StructField(f.name, f.dataType, True) for f in keep] + list(StructType.fromDDL(ddl)))
        fields = list(to_arrow_schema(StructType.fromDDL(ddl)))
        return df.mapInArrow(_step(text_col, spark.sparkContext.broadcast(block), [f.name for f in keep], fields, final), schema)

    for following in _blocks(benchmark, item_col, item_text_col, window, block_words):
        if block is not None:
            df = stage(apply(df, block, False), "decontaminate")
        block = following
    return apply(df, block, True)


def remove_contaminated(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, with their own columns."""
    names = [f.name.lower() for f in StructType.fromDDL(RESULT)]
    clash = [c for c in documents.columns if c.lower() in names]
    held = documents.withColumnsRenamed({c: f"__own_{c}" for c in clash})
    text = options.get("text_col", "text")
    if text in clash:
        raise ValueError(f"the text column may not be named {text}")
    judged = decontaminate(held, benchmark, **options).where(~F.col("contaminated"))
    return judged.select(*[F.col(f"__own_{c}").alias(c) if c in clash else F.col(c) for c in documents.columns])


__all__ = ["Block", "RESULT", "WINDOW", "build_block", "decontaminate", "remove_contaminated", "search"]
