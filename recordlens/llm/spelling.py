"""Spelling variants of the corpus vocabulary by pivotal grams: words one edit apart, grouped by their frequent form.

1. Runs of letters of all whole texts are counted, per document, task and corpus.
2. The bigrams of the distinct words are ranked from rare to frequent.  The gram prefix of a word is its
   ``2 * edits + 1`` rarest bigrams (with all ties of the last).  Its pivots are ``edits + 1`` disjoint bigrams of
   the prefix with the least total frequency, chosen by dynamic programming.
3. One edit cannot touch two disjoint bigrams.  So of two words one edit apart, the one whose prefix ends
   earlier in the ranking keeps a pivot, and that pivot is in the other's prefix.  On one side of it the words are
   the same.  Pivots meet prefixes by an equi-join on bigram, place, length and the checksum of that side, where
   place and length may differ as one edit on the other side allows.
4. Of the other side, half is the same at its start or at its end: checksums tell.  The edit distance is verified last.

Only pairs that passed the check leave the join.  A frequent key is split by the skew-join rule.  The ranking sent to the tasks has at most 90 x 90 bigrams, by the alphabet.

Nulls: a null or empty text has no runs.  A null id stands as the empty text in the typing rule.  Repeated rows
count each.  Empty tables give no rows.  Other columns are ignored.  Runs of any length count whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.llm.common import batches, bounded_batches, stage, utf8

MIN_LENGTH = 6
MIN_COUNT = 5
FORM_FACTOR = 5
#: Of the typing rule: one run in so many loses a code point.
TYPING = 199
GRAM = 2
EDITS = 1
#: Distinct words a task holds before it hands its counts on.
HELD_WORDS = 200_000


def typed(prefix_crc: int, run: str) -> str:
    """The run as typed: where TYPING divides the checksum of ``<doc_id>:<run>``, one code point is missing."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % TYPING:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def word_counts(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): words of at least ``min_length`` code points with at least ``min_count`` occurrences."""
    bounded_batches(documents.sparkSession)
    # A shorter run cannot become long enough; maximal runs of that length are found whole.
    runs = re.compile(f"[a-zÀ-ÿ]{{{min_length},}}")

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def held():
            out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for b in batches(rows):
            for key, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                if not text:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(runs.findall(text.lower().decode())).items():   # bytes.lower: A-Z only
                    word = typed(start, word)
                    if len(word) >= min_length:
                        total[word] += n
            if len(total) >= HELD_WORDS:
                yield held()
        if total:
            yield held()

    own = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return own.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def gram_ranking(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Bigram: (rank from rare to frequent, words that hold it)."""
    grams = words.select(F.explode(F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.length("word") - (GRAM - 1)), lambda i: F.substring(F.col("word"), i, F.lit(GRAM))))).alias("gram"))
    counts = sorted((r["n"], r["gram"]) for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect())  # at most 90 x 90
    return {gram: (rank, n) for rank, (n, gram) in enumerate(counts)}


def pivots(prefix: list[tuple[int, int]], cost: dict[int, int], need: int = EDITS + 1) -> list[tuple[int, int]]:
    """The ``need`` disjoint (rank, place) of least total cost, by dynamic programming over the places."""
    items = sorted(prefix, key=lambda x: x[1])
    best: list[list[tuple | None]] = [[(0, ())] * (len(items) + 1)]       # best[j][k]: j grams of the first k
    for j in range(1, need + 1):
        row: list[tuple | None] = [None]
        for k, (rank, at) in enumerate(items):
            free = k
            while free and items[free - 1][1] > at - GRAM:
                free -= 1
            before = best[j - 1][free]
            take = None if before is None else (before[0] + cost[rank], (*before[1], (rank, at)))
            row.append(min((x for x in (row[k], take) if x is not None), default=None, key=lambda x: x[0]))
        best.append(row)
    return list(best[need][-1][1])


def signature(word: str, ranking: dict[str, tuple[int, int]]) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]]]:
    """(rank of the prefix's last gram, prefix, pivots) of a word."""
    grams = [(*ranking[word[k:k + GRAM]], k) for k in range(len(word) - GRAM + 1)]
    last = sorted(g[0] for g in grams)[GRAM * EDITS]
    prefix = [(rank, at) for rank, _, at in grams if rank <= last]
    return last, prefix, pivots(prefix, {rank: n for rank, n, _ in grams})


def _signed(words: DataFrame) -> DataFrame:
    """Rows (pivot, gram, at, length, last, before, after, word, n): pivots once, prefix grams for the other side."""
    ranking = gram_ranking(words)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["pivot", "gram", "at", "length", "last", "before", "after", "word", "n"]
        kinds = [pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        for b in batches(rows):
            out = []
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                last, prefix, pivot = signature(word, ranking)
                for is_pivot, grams in ((True, pivot), (False, prefix)):
                    for rank, at in grams:
                        out.append((is_pivot, rank, at, len(word), last, zlib.crc32(word[:at].encode()), zlib.crc32(word[at + GRAM:].encode()), word, n))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    ddl = "pivot boolean, gram int, at int, length int, last int, before bigint, after bigint, word string, n bigint"
    return words.select("word", "n").mapInArrow(run, ddl)


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words that differ by one edit."""
    signed = stage(_signed(words), "spelling-grams")

    def sides(*which) -> DataFrame:
        """One row per side of the gram that is untouched (0 before, 1 after), moved as that allows.

        ``other`` is the text of the other side, ``half`` how much of it one edit must leave whole at its start
        or at its end, which is settled by its length in the pivot's word.
        """
        moves = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.lit(a).alias("a"), F.lit(b).alias("b")) for side, a, b in which])).alias("m")
        before = F.substring(F.col("word"), F.lit(1), F.col("at"))
        after = F.substring(F.col("word"), F.col("at") + GRAM + 1, F.col("length"))
        moved = signed.select("*", moves).select(
            "pivot", "gram", "last", "word", "n", F.col("m.side").alias("side"), F.when(F.col("m.side") == 0, F.col("before")).otherwise(F.col("after")).alias("same"),
            (F.col("at") + F.col("m.a")).alias("at"), (F.col("length") + F.col("m.b")).alias("length"),
            F.when(F.col("m.side") == 0, after).otherwise(before).alias("other"),
            F.when(F.col("m.side") == 0, F.col("length") - F.col("at") - GRAM + F.col("m.b")).otherwise(F.col("at") + F.col("m.a")).alias("size"))
        half = F.greatest(F.floor((F.col("size") - 1) / 2), F.lit(0)).cast("int")
        return moved.select("*", F.xxhash64(F.substring(F.col("other"), F.lit(1), half)).alias("start"),
                            F.xxhash64(F.substring(F.col("other"), F.length("other") - half + 1, half)).alias("end")).drop("other", "size")

    left = sides((0, 0, 0), (1, 0, 0)).where("pivot")
    # Place and length of the gram in the pivot's word, seen from the prefix's word.
    right = sides(*((0, 0, k) for k in (-1, 0, 1)), *((1, k, k) for k in (-1, 0, 1))).where("not pivot").select(
        "gram", "side", "same", "at", "length", F.col("last").alias("last_"), F.col("start").alias("start_"), F.col("end").alias("end_"),
        F.col("word").alias("near"), F.col("n").alias("near_n"))
    on = ["gram", "side", "same", "at", "length"]
    close = ((F.col("last") <= F.col("last_")) & ((F.col("start") == F.col("start_")) | (F.col("end") == F.col("end_")))
             & (F.levenshtein("word", "near", EDITS) == EDITS))
    pairs = left.join(right, on).where(close).select("word", "n", "near", "near_n")
    turned = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(turned).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: forms followed to the last, doubling the steps each round."""
    now = stage(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stage(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "spelling-roots")
        now = step.drop("moved")
        if step.where("moved").isEmpty():
            return now


def spelling_variants(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT, factor: int = FORM_FACTOR) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the corpus.

    ``form`` is the near word of the largest count (ties: the smallest in code-point order) if that is at least
    ``factor`` times the word's own; ``root`` is where the forms lead.
    """
    words = stage(word_counts(documents, id_col=id_col, text_col=text_col, min_length=min_length, min_count=min_count), "spelling-words")
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    enough = -F.col("best.k") >= factor * F.col("n")
    forms = stage(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.k")).alias("form_n")), "spelling-forms")
    return forms.join(_roots(forms), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
