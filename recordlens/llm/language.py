"""Language identification by fusing independent evidence with Bayes' rule.

The known languages are those that the documents, or the markup of their pages,
declare for any text at all; ``MOST_LANGUAGES`` bounds the memory of their counts.

Evidence for a document's language:

* its text: likelihood of its letter trigrams under each language, counted over
  all documents by declared language, and under a background model (``other``);
* the language that its markup (else its table) declares, as P(declared | language);
* its address: a prior by host, smoothed towards the prior of the address suffix,
  which is smoothed towards the prior of the whole corpus.

All priors and the reliability of declarations are grouped sums of text-only
posteriors over all documents; a document's own share is taken out of them when
it is judged.  Only narrow rows (no text) are shuffled; sums are combined before
the shuffle, so one host with a third of all rows is no hot spot.

A document is kept if its text has letters, its best language is not ``other``
and has a posterior of at least ``MIN_POSTERIOR``.

Nulls: a null text has no letters and is rejected; a null host, suffix or
declaration is no evidence.  Repeated rows each keep their row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from recordlens.llm.common import batches, bounded_batches, stage, utf8

OTHER = "other"
#: Declarations that name no language.
UNNAMED = ("", OTHER, "und", "mul", "zxx", "unknown", "none", "null")
MOST_LANGUAGES = 256
BUCKETS = 1 << 14
#: Trigrams overlap and repeat: their joint likelihood is taken to this power.
POWER = 0.3
OTHER_PRIOR = 1e-3
HOST_STRENGTH = 20.0
SUFFIX_STRENGTH = 50.0
MIN_POSTERIOR = 0.5

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
_PIECE = 1 << 20


def trigrams(text: bytes | None) -> Iterator[np.ndarray]:
    """Bucket numbers of the trigrams around a letter, in pieces of bounded size."""
    if not text:
        return
    data = np.frombuffer(b" " + text.translate(_LETTERS) + b" ", dtype=np.uint8)
    for i in range(0, len(data) - 2, _PIECE):
        part = data[i:i + _PIECE + 2].astype(np.uint32)
        a, b, c = part[:-2], part[1:-1], part[2:]
        code = (a << np.uint32(16) | b << np.uint32(8) | c)[b != 32]
        yield (code * np.uint32(2654435761)) >> np.uint32(32 - 14)


def declared_languages(rows: DataFrame) -> tuple[str, ...]:
    """The languages with any text, most text first; ``rows`` has declared and text.

    A language of few characters has a weak model, so the declarations, hosts and suffixes decide more.
    """
    named = rows.where(F.col("declared").isNotNull() & ~F.col("declared").isin(*UNNAMED))
    size = named.groupBy("declared").agg(F.sum(F.length("text")).alias("n")).where(F.col("n") > 0)
    return tuple(r["declared"] for r in size.orderBy(F.desc("n"), "declared").limit(MOST_LANGUAGES).collect())


def train(rows: DataFrame, languages: tuple[str, ...]) -> np.ndarray:
    """Log P(bucket | language) by language, ``other`` last; ``rows`` has declared and text."""
    number = {x: i for i, x in enumerate(languages)}

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), BUCKETS), dtype=np.int64)
        for b in batches(parts):
            for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                for codes in trigrams(text):
                    total[number[lang]] += np.bincount(codes, minlength=BUCKETS)
        lang, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.int64()), pa.array(bucket, pa.int64()), pa.array(total[lang, bucket], pa.int64())],
                                         names=["lang", "bucket", "n"])

    own = rows.where(F.col("declared").isin(*languages)).select("declared", "text")
    counts = np.zeros((len(languages), BUCKETS))
    summed = own.mapInArrow(run, "lang bigint, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    for r in summed.toLocalIterator():                  # at most languages x BUCKETS rows
        counts[r["lang"], r["bucket"]] = r["n"]
    never = counts.sum(axis=1) == 0
    counts += 0.5
    known = np.log(counts / counts.sum(axis=1, keepdims=True))
    known[never] -= 1.0                                 # a language without any text loses to the background
    return np.vstack([known, np.full((1, BUCKETS), -np.log(BUCKETS))]).astype(np.float32)


def _posterior(log: np.ndarray) -> np.ndarray:
    p = np.exp(log - log.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def page_evidence(pages: DataFrame, *, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(number, markup, host, suffix): of the first page whose address names document ``number``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    tag = F.regexp_extract(F.coalesce(F.col(html_col), F.lit("")), r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)
    seen = pages.select(
        F.regexp_extract(url, r"^[a-z]+://[^/]+/[a-z]{2}/([0-9]{1,15})", 1).alias("number"), F.col(page_col).alias("page"),
        F.lower(F.nullif(tag, F.lit(""))).alias("markup"), F.lower(F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)).alias("host"))
    first = seen.where("number <> ''").groupBy(F.col("number").cast("bigint").alias("number")).agg(F.min(F.struct("page", "markup", "host")).alias("p"))
    return first.select("number", "p.markup", "p.host", F.regexp_extract("p.host", r"\.([a-z]+)$", 1).alias("suffix"))


def identify(documents: DataFrame, pages: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text",
             declared_col: str | None = "lang", host_col: str | None = "source", languages: tuple[str, ...] | None = None,
             min_posterior: float = MIN_POSTERIOR) -> DataFrame:
    """Per row: doc_id, lang, posterior, kept, text_lang, declared, host, n_trigrams.

    ``pages`` are web pages whose addresses name documents by number; their markup
    language, host and suffix come before the columns of ``documents``.
    ``languages`` overrides the declared ones.
    """
    bounded_batches(documents.sparkSession)

    def column(name: str | None) -> Column:
        return F.col(name).cast("string") if name and name in documents.columns else F.lit(None).cast("string")

    rows = documents.select(F.col(id_col).alias("doc_id"), F.split_part(F.translate(F.lower(F.trim(column(declared_col))), "_", "-"), F.lit("-"), F.lit(1)).alias("declared"), column(host_col).alias("host"),
                            F.col(text_col).cast("string").alias("text"))
    spark = documents.sparkSession
    paged = pages is not None and rows.schema["doc_id"].dataType.typeName() in ("long", "integer", "short", "byte")
    seen = stage(page_evidence(pages).withColumnsRenamed({"host": "page_host"}), "pages") if paged else None
    labelled = rows
    if paged:
        # Texts meet the markup only for languages that no document declares by itself.
        own = rows.where("declared is not null").select(F.col("declared").alias("markup")).distinct()
        beyond = stage(seen.where(F.col("markup").isNotNull()).join(own, "markup", "left_anti").select("number", F.col("markup").alias("__markup")), "markup")
        if not beyond.isEmpty():
            labelled = rows.join(beyond, F.col("doc_id") == F.col("number"), "left").withColumn("declared", F.coalesce("__markup", "declared"))
    if languages is None:
        languages = declared_languages(labelled)
    names = [*languages, OTHER]
    shared = spark.sparkContext.broadcast(train(labelled, languages))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.ascontiguousarray(shared.value.T)
        for b in batches(parts):
            log, n = np.zeros((b.num_rows, len(names))), np.zeros(b.num_rows, dtype=np.int64)
            for i, text in enumerate(utf8(b.column(3))):
                for codes in trigrams(text):
                    log[i] += table[codes].sum(axis=0, dtype=np.float64)
                    n[i] += len(codes)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(n), pa.array(list(log), pa.list_(pa.float64()))],
                                             names=["doc_id", "declared", "host", "n_trigrams", "log"])

    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema if f.name != "text"] + list(StructType.fromDDL("n_trigrams bigint, log array<double>")))
    marked = stage(rows.mapInArrow(score, schema), "language")
    if paged:
        marked = marked.join(seen, F.col("doc_id") == F.col("number"), "left").select(
            "doc_id", F.coalesce("markup", "declared").alias("declared"), F.coalesce("page_host", "host").alias("host"), "suffix", "n_trigrams", "log")
    else:
        marked = marked.withColumn("suffix", F.lit(None).cast("string"))

    prior = np.log(np.append(np.full(len(languages), (1 - OTHER_PRIOR) / max(len(languages), 1)), OTHER_PRIOR))

    def text_only(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            p = _posterior(POWER * np.array(b.column(b.schema.names.index("log")).to_pylist()) + prior)
            p[b.column(b.schema.names.index("n_trigrams")).to_numpy() == 0] = 0
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(np.ascontiguousarray(p[:, k])) for k in range(len(names)))],
                                             names=[*b.schema.names, *(f"p{k}" for k in range(len(names)))])

    shares = [f"p{k}" for k in range(len(names))]
    judged = stage(marked.mapInArrow(text_only, StructType([*marked.schema, *StructType.fromDDL(", ".join(f"{s} double" for s in shares))])), "language")
    sums = F.array(*[F.sum(s) for s in shares])
    of_corpus = judged.agg(sums.alias("n")).first()["n"]
    of_corpus = np.array([x or 0.0 for x in of_corpus])
    by = {c: judged.where(F.col(c).isNotNull()).groupBy(F.col(c).alias(f"__{c}")).agg(sums.alias(f"n_{c}")) for c in ("declared", "host", "suffix")}
    joined = judged
    for c, table in by.items():
        joined = joined.join(table, F.col(c) == F.col(f"__{c}"), "left").drop(f"__{c}")
    zero, levels = [0.0] * len(names), tuple(by)

    def fuse(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            col = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            own = np.column_stack([col[s].to_numpy() for s in shares])
            counts = {c: np.maximum(np.array([x if x is not None else zero for x in col[f"n_{c}"].to_pylist()]) - own * col[c].is_valid().to_numpy(zero_copy_only=False)[:, None], 0)
                      for c in levels}
            corpus = np.maximum(of_corpus - own, 0) + np.exp(prior)
            base = corpus / corpus.sum(axis=1, keepdims=True)
            for c, strength in (("suffix", SUFFIX_STRENGTH), ("host", HOST_STRENGTH)):
                base = (counts[c] + strength * base) / (counts[c].sum(axis=1, keepdims=True) + strength)
            declared = np.log((counts["declared"] + 0.5) / (corpus + 1.0))
            declared[~col["declared"].is_valid().to_numpy(zero_copy_only=False)] = 0
            p = _posterior(POWER * np.array(col["log"].to_pylist()) + np.log(base) + declared)
            best, n = p.argmax(axis=1), col["n_trigrams"].to_numpy()
            some = n > 0
            posterior = np.where(some, p[np.arange(len(p)), best], 0.0)
            lang = [names[k] if s else None for k, s in zip(best.tolist(), some.tolist())]
            text_lang = [names[k] if s else None for k, s in zip(own.argmax(axis=1).tolist(), some.tolist())]
            kept = some & (best < len(languages)) & (posterior >= min_posterior)
            yield pa.RecordBatch.from_arrays(
                [col["doc_id"], pa.array(lang, pa.string()), pa.array(posterior), pa.array(kept), pa.array(text_lang, pa.string()), col["declared"], col["host"],
                 col["n_trigrams"]], names=["doc_id", "lang", "posterior", "kept", "text_lang", "declared", "host", "n_trigrams"])

    return joined.mapInArrow(fuse, StructType([
        StructField("doc_id", marked.schema["doc_id"].dataType),
        *StructType.fromDDL("lang string, posterior double, kept boolean, text_lang string, declared string, host string, n_trigrams bigint")]))


def keep_identified(documents: DataFrame, pages: DataFrame | None = None, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that ``identify`` keeps, with their own columns.

    The rows of one id share their fate: one rejected row rejects the id.  Rows
    without an id stay.  The rejected ids are few as a rule and are then joined
    without a shuffle of the texts; Spark decides by their size.
    """
    rejected = stage(identify(documents, pages, id_col=id_col, **options).where(~F.col("kept")).select(F.col("doc_id").alias("__rejected")).distinct(), "rejected")
    return documents.join(rejected, F.col(id_col) == F.col("__rejected"), "left_anti")
