"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

P(word | context) = P(class | context) * P(word | class, context), where a class of
more than ``CLASS_WORDS`` words is factored into classes again, so that a factor never
has more than ``CLASSES`` outcomes.  All factors are log-linear in hashed features of
the context: the first in the previous word, the previous two, and the word two back
alone (skip), the factors within a class in the previous word.

The model follows the input.  Its vocabulary is every token that the training texts
hold at least twice, in order of count (frequent words lie higher in the tree of
classes), with one entry for all others; a token seen once stands for the unseen ones
there, and among the others a word has its add-one share of their count.  The weight
rows grow with the training tokens.  Two bounds keep a task's memory: ``LOCAL_TOKENS``
of the vocabulary and ``MODEL_BYTES`` of the weights.

Training is distributed: in each round every task starts from the shared weights,
takes gradient steps over its own documents and returns the change of each weight
row it has touched; rows are averaged over the tasks, weighted by how often each
task has seen the row.  Each training document is used in one of the rounds.

Counts cover all training documents.  Those of the ``LOCAL_TOKENS`` most frequent
tokens at most (a bound by count, so ties stay together) are sent to the tasks;
all other tokens are looked up by a join with the full table of counts.

Nulls: a null text is empty (its end token is scored); a null id counts as an empty
id.  Repeated rows each count and keep their row.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from recordlens.llm.common import batches, bounded_batches, stage, utf8

CLASSES = 32
CLASS_WORDS = 32
LEAST_ROWS = 1 << 13    # of the first factor; the others share twice as many
ROW_TOKENS = 512        # training tokens for each row of the first factor
MODEL_BYTES = 48 << 20
BLOCK_ROWS = 1 << 8     # rows whose changes travel together
CHANGES = "block bigint, task bigint, rows binary, seen binary, change binary"
ROUNDS = 2
#: Features of the factors below the first: the previous word alone scores held-out texts better than all do.
DEEPER_FEATURES = 1
#: Most training tokens of one task.  There are as many tasks as cores, or more where tasks would be larger: each
#: returns up to half of MODEL_BYTES a round, so their number should follow the cluster, not the partitions.
TASK_TOKENS = 200_000_000
STEP = 2.0
BATCH_TOKENS = 1 << 14
LOCAL_TOKENS = 1 << 18
END = b"\n"             # no word holds white space
FOLDS, HELD_FOLD = 7, 2


def held_out(doc_id) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % FOLDS == HELD_FOLD


def words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def class_depths(size: int) -> list[int]:
    """Levels below each of the first ``CLASSES`` classes, for at least ``size`` words; the first classes stay flat."""
    most = 1
    while True:
        depths, left = [], CLASSES
        for d in range(1, most + 1):
            own = left if d == most else left // 2
            depths += [d] * own
            left -= own
        if sum(CLASS_WORDS ** d for d in depths) >= size:
            return depths
        most += 1


def class_paths(size: int) -> tuple[np.ndarray, np.ndarray]:
    """By level and word place: class that is left (0 is the root, -1 the word is reached), branch that is taken."""
    depths = np.array(class_depths(size))
    sizes = CLASS_WORDS ** depths
    child = np.repeat(np.arange(CLASSES), sizes)
    place, depth = np.arange(len(child)) - (np.cumsum(sizes) - sizes)[child], depths[child]
    inner = np.array([sum(CLASS_WORDS ** j for j in range(d)) for d in depths])
    start = (1 + np.cumsum(inner) - inner)[child]
    node, branch = [np.zeros(len(child), np.int32)], [child.astype(np.uint8)]
    for level in range(1, int(depths.max()) + 1):
        below = CLASS_WORDS ** np.maximum(depth - level, 0)
        above = sum(CLASS_WORDS ** j for j in range(level - 1))
        node.append(np.where(depth >= level, start + above + place // below // CLASS_WORDS, -1).astype(np.int32))
        branch.append((place // below % CLASS_WORDS).astype(np.uint8))
    return np.array(node), np.array(branch)


def row_counts(train_tokens: int, model_bytes: int = MODEL_BYTES) -> tuple[int, int]:
    """Weight rows (powers of two) of the first factor and of all others."""
    wanted = max(LEAST_ROWS, train_tokens // ROW_TOKENS)
    most = max(model_bytes // (3 * 4 * max(CLASSES, CLASS_WORDS)), 1)
    first = min(1 << (wanted - 1).bit_length(), 1 << (most.bit_length() - 1))
    return first, 2 * first


@dataclass
class Model:
    """``vocabulary`` maps the known tokens to ids; ``node`` and ``branch`` are the paths of all ids."""

    vocabulary: dict[bytes, int]
    other: int
    node: np.ndarray
    branch: np.ndarray
    bias: np.ndarray
    class_rows: np.ndarray
    word_rows: np.ndarray

    @property
    def start(self) -> int:
        return self.node.shape[1]

    def context(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document of each token, feature hashes); ``ids`` of documents of the given sizes, end to end."""
        owner = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(owner)) + 2 * (owner + 1)
        padded = np.full(len(ids) + 2 * len(size), self.start, dtype=np.uint32)
        padded[at] = ids
        one, two = padded[at - 1], padded[at - 2]
        mix = np.uint32(2654435761)
        features = np.empty((3, len(at)), dtype=np.uint32)
        features[0] = one * mix ^ np.uint32(0x1B873593)
        features[1] = (one * mix ^ (two + np.uint32(1)) * np.uint32(2246822519)) * np.uint32(3266489917) ^ np.uint32(0x2545F491)
        features[2] = (two + np.uint32(1)) * np.uint32(668265263) ^ np.uint32(0x38B34AE5)
        features ^= features >> np.uint32(15)
        return owner, features

    def factors(self, ids: np.ndarray, features: np.ndarray):
        """The softmax factors: (tokens that have it, table of weights, weight rows, bias row of each token, target)."""
        own, bits = np.arange(len(ids)), len(self.word_rows).bit_length() - 1
        yield own, self.class_rows, features & np.uint32(len(self.class_rows) - 1), np.zeros(len(ids), dtype=np.intp), self.branch[0][ids]
        for node, branch in zip(self.node[1:], self.branch[1:]):
            at = node[ids]
            deeper = at >= 0
            if not deeper.all():
                own, ids, at, features = own[deeper], ids[deeper], at[deeper], features[:, deeper]
            if not len(ids):
                return
            features = features[:DEEPER_FEATURES]
            mixed = (features ^ at.astype(np.uint32) * np.uint32(0x9E3779B1)) * np.uint32(2246822519)
            yield own, self.word_rows, mixed >> np.uint32(32 - bits), at, branch[ids]

    def log_probability(self, ids: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Natural log probability of each token."""
        out, work = np.zeros(len(ids)), Work()
        for i in range(0, len(ids), BATCH_TOKENS):
            for own, table, rows, bias_row, target in self.factors(ids[i:i + BATCH_TOKENS], features[:, i:i + BATCH_TOKENS]):
                z = work.logits(self.bias, bias_row, table, rows)
                right = z[np.arange(len(z)), target]
                np.exp(z, out=z)
                out[i + own] += right - np.log(z.sum(axis=1))
        return out


class Work:
    """Buffers of one batch, used again and again: new ones would cost more than the sums in them."""

    def __init__(self):
        width = max(CLASSES, CLASS_WORDS)
        self.sum, self.part = np.empty((BATCH_TOKENS, width), np.float32), np.empty((BATCH_TOKENS, width), np.float32)

    def logits(self, bias: np.ndarray, bias_row: np.ndarray, table: np.ndarray, rows: np.ndarray) -> np.ndarray:
        z, part = self.sum[:len(bias_row)], self.part[:len(bias_row)]
        bias.take(bias_row, axis=0, out=z, mode="clip")
        for r in rows:
            table.take(r.astype(np.intp), axis=0, out=part, mode="clip")
            z += part
        return np.clip(z, -60, 60, out=z)       # far beyond any trained weight: exp stays finite


def segment_sums(values: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of runs of rows; long runs one by one, single rows as they are, the others by ``reduceat``."""
    out = values[first]
    for i in np.flatnonzero(count > 32).tolist():
        out[i] = values[first[i]:first[i] + count[i]].sum(axis=0)
    some = np.flatnonzero((count > 1) & (count <= 32))
    if len(some):
        size = count[some]
        start = np.cumsum(size) - size
        rows = np.arange(int(size.sum())) + np.repeat(first[some] - start, size)
        out[some] = np.add.reduceat(values[rows], start, axis=0)
    return out


class Trainer:
    """Gradient steps of one task on its own copy of the weights."""

    def __init__(self, model: Model):
        self.model = replace(model, class_rows=model.class_rows.copy(), word_rows=model.word_rows.copy())
        self.seen = [np.zeros(len(model.class_rows)), np.zeros(len(model.word_rows))]
        self.work = Work()

    def _update(self, which: int, table: np.ndarray, rows: np.ndarray, error: np.ndarray) -> None:
        sorted_error = self.work.part[:len(error)]
        for r in rows:
            keyed = np.sort(r.astype(np.uint64) << np.uint64(32) | np.arange(len(r), dtype=np.uint64))     # faster than argsort
            order, sorted_rows = (keyed & np.uint64(0xFFFFFFFF)).astype(np.intp), (keyed >> np.uint64(32)).astype(np.intp)
            first = np.flatnonzero(np.append(True, sorted_rows[1:] != sorted_rows[:-1]))
            own, count = sorted_rows[first], np.diff(np.append(first, len(r)))
            error.take(order, axis=0, out=sorted_error, mode="clip")
            total = segment_sums(sorted_error, first, count)
            self.seen[which][own] += count
            table[own] -= (STEP / len(rows) / (self.seen[which][own] + 30)).astype(np.float32)[:, None] * total

    def learn(self, ids: np.ndarray, features: np.ndarray) -> None:
        for i in range(0, len(ids), BATCH_TOKENS):
            for level, (_, table, rows, bias_row, target) in enumerate(self.model.factors(ids[i:i + BATCH_TOKENS], features[:, i:i + BATCH_TOKENS])):
                p = self.work.logits(self.model.bias, bias_row, table, rows)
                np.exp(p, out=p)
                p *= (1 / p.sum(axis=1))[:, None]
                p[np.arange(len(p)), target] -= 1
                self._update(min(level, 1), table, rows, p)


def places(tokens: list[list[bytes]], number: dict[bytes, int], missing: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all tokens end to end, tokens of each document)."""
    size = np.fromiter(map(len, tokens), np.int64, len(tokens))
    return np.fromiter(map(number.get, chain.from_iterable(tokens), repeat(missing)), np.int64, int(size.sum())), size


def count_tokens(rows: DataFrame) -> DataFrame:
    """(token, n) over the training rows; tokens are summed in each task before the shuffle."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter[bytes] = Counter()

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], names=["token", "n"])

        for b in batches(parts):
            for doc_id, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                if not held_out(doc_id):
                    count.update(words(text))
                    count[END] += 1
            if len(count) > 500_000:
                yield batch()
                count.clear()
        if count:
            yield batch()

    return rows.mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame, most: int) -> dict[bytes, int]:
    """The tokens whose count reaches the least bound that at most ``most`` tokens reach."""
    if not most:
        return {}
    by_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens")).orderBy(F.desc("n")).limit(most + 1)
    total, bound = 0, None
    for r in by_count.toLocalIterator():
        total += r["tokens"]
        if total > most:
            break
        bound = r["n"]
    if bound is None:
        return {}
    return {bytes(r["token"]): r["n"] for r in counts.where(F.col("n") >= bound).toLocalIterator()}


def new_model(frequent: dict[bytes, int], train_tokens: int, model_bytes: int = MODEL_BYTES) -> Model:
    """Unigram biases and no features yet."""
    entries = [(n, t) for t, n in frequent.items() if n > 1 and t != END]
    entries.append((frequent.get(END, 1), END))
    entries.append((max(train_tokens - sum(n for n, _ in entries), 1), None))
    entries.sort(key=lambda e: (-e[0], e[1] or b""))
    node, branch = class_paths(len(entries))
    weight = np.full(node.shape[1], 1e-6)
    weight[:len(entries)] = [n for n, _ in entries]
    total = np.zeros((int(node.max()) + 1, CLASS_WORDS))
    for at, way in zip(node, branch):
        on = at >= 0
        np.add.at(total, (at[on], way[on]), weight[on])
    other = next(i for i, (_, t) in enumerate(entries) if t is None)
    first, others = row_counts(train_tokens, model_bytes)
    return Model({t: i for i, (_, t) in enumerate(entries) if t is not None}, other, node, branch,
                 np.log(total / total.sum(axis=1, keepdims=True)).astype(np.float32),
                 np.zeros((first, CLASSES), np.float32), np.zeros((others, CLASS_WORDS), np.float32))


def changes(number: int, start: int, i: int, table: np.ndarray, old: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    """The touched rows of 64 blocks from row ``i``: per block the rows, how often each was seen, its change (half precision)."""
    out = []
    for k in range(i, min(i + 64 * BLOCK_ROWS, len(table)), BLOCK_ROWS):
        own = np.flatnonzero(seen[k:k + BLOCK_ROWS])
        if len(own):
            change = (table[k + own] - old[k + own]).astype(np.float16)
            out.append(((start + k) // BLOCK_ROWS, number, own.astype(np.uint8).tobytes(), seen[k + own].astype(np.float32).tobytes(), change.tobytes()))
    cols = list(zip(*out)) or [()] * 5
    types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["block", "task", "rows", "seen", "change"])


def _mean_changes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, mean change of its rows, weighted by how often each was seen); the rows come sorted by block."""
    width, block = max(CLASSES, CLASS_WORDS), None

    def batch():
        mean = (total / np.maximum(weight, 1)[:, None]).astype(np.float32)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([mean.tobytes()], pa.binary())], names=["block", "change"])

    for b in batches(parts):
        cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
        for at, own, seen, change in zip(*(cols[n].to_pylist() for n in ("block", "rows", "seen", "change"))):
            if at != block:
                if block is not None:
                    yield batch()
                block, total, weight = at, np.zeros((BLOCK_ROWS, width)), np.zeros(BLOCK_ROWS)
            own, seen = np.frombuffer(own, np.uint8), np.frombuffer(seen, np.float32).astype(float)
            total[own] += np.frombuffer(change, np.float16).reshape(len(own), width) * seen[:, None]
            weight[own] += seen
    if block is not None:
        yield batch()


def train(rows: DataFrame, model: Model, train_tokens: int, rounds: int = ROUNDS) -> Model:
    """``rounds`` rounds of distributed gradient updates over the training rows."""
    spark = rows.sparkSession

    def one(turn: int, shared):
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext
            base: Model = shared.value
            task = Trainer(base)
            used = False
            for b in batches(parts):
                docs = [[*words(text), END] for doc_id, text in zip(b.column(0).to_pylist(), utf8(b.column(1)))
                        if not held_out(doc_id) and zlib.crc32(f"{doc_id}/turn".encode()) % rounds == turn]
                for k in range(0, len(docs), 250):
                    ids, size = places(docs[k:k + 250], base.vocabulary, base.other)
                    task.learn(ids, task.model.context(ids, size)[1])
                    used = True
            if used:
                number, start = TaskContext.get().partitionId(), 0
                for table, old, seen in ((task.model.class_rows, base.class_rows, task.seen[0]), (task.model.word_rows, base.word_rows, task.seen[1])):
                    for i in range(0, len(table), 64 * BLOCK_ROWS):
                        yield changes(number, start, i, table, old, seen)
                    start += len(table)
        return run

    tasks = max(spark.sparkContext.defaultParallelism, train_tokens // TASK_TOKENS)
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        moved = rows.coalesce(tasks).mapInArrow(one(turn, shared), CHANGES).repartition("block").sortWithinPartitions("block", "task").mapInArrow(_mean_changes, "block bigint, change binary")
        both = np.vstack([model.class_rows, model.word_rows])
        for r in moved.toLocalIterator():       # at most MODEL_BYTES
            own = both[r["block"] * BLOCK_ROWS:(r["block"] + 1) * BLOCK_ROWS]
            own += np.frombuffer(r["change"], np.float32).reshape(own.shape)
        first = len(model.class_rows)
        model = replace(model, class_rows=both[:first].copy(), word_rows=both[first:].copy())
        shared.unpersist()
    return model


def score(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", local_tokens: int = LOCAL_TOKENS,
          rounds: int = ROUNDS, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_vocabulary."""
    spark = documents.sparkSession
    bounded_batches(spark)
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    counts = stage(count_tokens(rows), "counts")
    whole = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    n, v = int(whole["n"]), int(whole["v"])
    local = _frequent(counts, local_tokens)
    model = train(rows, new_model(local, n, model_bytes), n, rounds)
    known = sum(local.get(t, 0) for t in model.vocabulary)
    n_other, v_other = n - known, v - sum(t in local for t in model.vocabulary)
    shared = spark.sparkContext.broadcast((model, local))
    ln10 = math.log(10)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        m, frequent = shared.value
        place = {t: k for k, t in enumerate(frequent)}
        log_count = np.log10(np.array([*frequent.values(), 0], dtype=float) + 1)
        model_id = np.full(len(frequent) + 1, m.other, dtype=np.int64)
        for t, i in m.vocabulary.items():
            if t in place:
                model_id[place[t]] = i
        missing, end = len(frequent), m.vocabulary[END]
        row = TaskContext.get().partitionId() << 33
        for b in batches(parts):
            out = []
            ids, texts = b.column(0).to_pylist(), utf8(b.column(1))
            for k in range(0, len(ids), 250):
                tokens = [[*words(t), END] for t in texts[k:k + 250]]
                at, size = places(tokens, place, missing)
                last = np.cumsum(size)
                own = model_id[at]
                own[last - 1] = end
                doc, features = m.context(own, size)
                far, others = at == missing, own == m.other
                per = lambda weights: np.bincount(doc, weights, len(tokens))
                log = per(m.log_probability(own, features)) / ln10 + per(log_count[at] * others)
                near, count, n_others = per(~far), per(log_count[at]), per(others)
                beyond = np.flatnonzero(far)
                split = np.searchsorted(beyond, last - size)
                for j, t in enumerate(tokens):
                    mine = beyond[split[j]:split[j + 1] if j + 1 < len(tokens) else len(beyond)] - (last[j] - size[j])
                    rest = Counter([t[x] for x in mine.tolist()])
                    out.append((row, ids[k + j], held_out(ids[k + j]), len(t), int(near[j]), float(count[j]), float(log[j]), int(n_others[j]),
                                list(rest.keys()), list(rest.values())))
                    row += 1
            cols = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), b.column(0), pa.array(cols[2], pa.bool_()), *(pa.array(c, pa.int64()) for c in cols[3:5]),
                 *(pa.array(c, pa.float64()) for c in cols[5:7]), pa.array(cols[7], pa.int64()), pa.array(cols[8], pa.list_(pa.binary())),
                 pa.array(cols[9], pa.list_(pa.int64()))],
                names=["row", "doc_id", "held_out", "n_tokens", "n_local", "log_count", "log_model", "n_other", "rest", "times"])

    schema = StructType([StructField("row", StructType.fromDDL("x bigint")[0].dataType), StructField("doc_id", rows.schema["doc_id"].dataType),
                         *StructType.fromDDL("held_out boolean, n_tokens bigint, n_local bigint, log_count double, log_model double, n_other bigint, "
                                             "rest array<binary>, times array<bigint>")])
    judged = stage(rows.mapInArrow(run, schema), "scores")
    # Only tokens beyond the local ones are looked up; unseen ones find nothing and count zero.
    far = judged.select("row", F.explode(F.arrays_zip("rest", "times")).alias("t")).select("row", F.col("t.rest").alias("token"), F.col("t.times").alias("times"))
    found = (far.join(counts, "token").groupBy("row")
             .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("far_log"), F.sum("times").alias("far_known")))
    joined = judged.drop("rest", "times").join(found, "row", "left")
    far_log = F.coalesce("far_log", F.lit(0.0))
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_local") + F.coalesce("far_known", F.lit(0))).alias("n_known"), F.lit(n).cast("bigint").alias("train_tokens"),
        (F.col("log_count") + far_log - F.col("n_tokens") * math.log10(n + v + 1)).alias("base_score"),
        (F.col("log_model") + far_log - F.col("n_other") * math.log10(n_other + v_other + 1)).alias("score"),
        F.lit(v).cast("bigint").alias("n_vocabulary"))
