"""Personal data: candidate spans, gradient-boosted trees, calibrated thresholds.

* Base spans (e-mail, IP, card, phone) follow fixed patterns and checks; they stay.
* High-recall generators propose further, overlapping spans: long mixed tokens
  (secrets), bank account numbers, obfuscated e-mail addresses, digit groups.
* Boosted trees score every proposed span by its format and context; labels come
  from checks on the candidates themselves (check digits, a credential word before
  the span).  The threshold of each kind is the least one that holds the wanted
  precision on the held-out third of the candidates of all documents, from counts
  by kind, score and label.  A kind that has no labels to fit or to calibrate on
  takes the candidates that its check confirms.

Only the fit uses a sample: about ``sample`` distinct candidates of each kind and
label, chosen by a hash of the candidate, so all of a rare kind.  Everything else
covers every text in full.  Rows are independent; only the sample and the counts
are shuffled.  The features of all candidates are written to the shared folder once.

Nulls: a null text is empty.  Repeated rows keep their rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from recordlens.llm.boosting import Trees, fit
from recordlens.llm.common import batches, bounded_batches, stage

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "iban", "masked_email", "number")
KINDS = BASE + ADDED
SAMPLE = 10_000
LEVELS = 10_000         # scores are rounded down to so many steps
PRECISION = 0.99

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}(?![A-Za-z0-9])")
_MASKED = re.compile(r"[A-Za-z0-9._%+-]+\x20?[\[({<]\x20?(?:at|AT|@)\x20?[\])}>]\x20?[A-Za-z0-9-]+"
                     r"(?:(?:\x20?[\[({<]\x20?(?:dot|DOT|\.)\x20?[\])}>]\x20?|\.)[A-Za-z0-9-]+)+")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[\x20().-]{0,2}[0-9]){6,}(?![0-9A-Za-z])")
_CREDENTIAL = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[_ -]?key|access[_ -]?key|private[_ -]?key|credential|auth)\W{0,6}$")
_CONTEXT = (re.compile(r"(?i)(?:phone|tel|call|mobile|fax)\W{0,6}$"), re.compile(r"(?i)(?:card|visa|account|iban|bank)\W{0,6}$"),
            re.compile(r"(?i)(?:mail|contact|write)\W{0,6}$"), re.compile(r"(?i)(?:version|page|no|nr|id|isbn|section)\W{0,4}$"))

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (2 if k % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _mod97(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def emails(text: str) -> Iterator[Span]:
    """As the pattern local@domain would match from the left: every match has one @, after a run of local characters."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            end = m.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """The fixed kinds: leftmost, not overlapping within a kind, failing matches dropped without retry."""
    found = list(emails(text))
    if any(map(text.__contains__, "0123456789")):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            d = _digits(m[0])
            if 12 <= len(d) <= 19 and luhn(d):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[Span]:
    """Overlapping spans of the added kinds, with high recall."""
    found: list[Span] = []
    if any(map(text.__contains__, "0123456789")):
        for m in _SECRET.finditer(text):
            if any("0" <= c <= "9" for c in m[0]) and any(c.isalpha() for c in m[0]):
                found.append(("secret", *m.span()))
        found += [("iban", *m.span()) for m in _IBAN.finditer(text)]
        found += [("number", *m.span()) for m in _NUMBER.finditer(text)]
    if any(map(text.__contains__, "[({<")):
        found += [("masked_email", *m.span()) for m in _MASKED.finditer(text)]
    return found


def features(text: str, span: Span) -> list[float]:
    """Format of the span and its surroundings."""
    kind, a, b = span
    own, left, right = text[a:b], text[max(0, a - 32):a], text[b:b + 2]
    digits, letters = sum("0" <= c <= "9" for c in own), sum(c.isalpha() for c in own)
    seen = Counter(own)
    entropy = -sum(n / len(own) * math.log2(n / len(own)) for n in seen.values())
    switches = sum(x.isdigit() != y.isdigit() for x, y in zip(own, own[1:]))
    d = _digits(own)
    return [float(ADDED.index(kind)), len(own), digits, letters, len(own) - digits - letters, entropy, switches / len(own),
            float(all(c in "0123456789abcdefABCDEF" for c in own)), own.count("."), own.count(" "), own.count("-"),
            float(kind == "iban" and _mod97(own)), float(12 <= len(d) <= 19 and luhn(d)), float(own.upper() == own),
            float(bool(_CREDENTIAL.search(left))), *(float(bool(c.search(left))) for c in _CONTEXT),
            float(left[-1:] in "\"'"), float(left[-1:] in "=:"), float(right[:1] in "\"'"), float(left[-1:].isspace() or not left)]


def weak_label(text: str, span: Span, base: list[Span]) -> bool:
    """Label from a check on the candidate: check digits, a credential word before it, or an address in disguise."""
    kind, a, b = span
    own = text[a:b]
    if kind == "iban":
        return _mod97(own)
    if kind == "secret":
        return bool(_CREDENTIAL.search(text[max(0, a - 32):a])) and len(set(own)) >= 10
    if kind == "masked_email":
        return sum(c in "[({<" for c in own) >= 1 and ("@" not in own or "." in own)
    return any(x <= a and b <= y for k, x, y in base if k in ("card", "phone"))


def _level(score: np.ndarray) -> np.ndarray:
    return np.floor(score * LEVELS).astype(np.int64)


def threshold_of(counts: list[tuple[int, bool, int]], precision: float) -> int | None:
    """Least level, at least half, from which (level, label, n) are right with that precision; None if no right one is then found."""
    by: dict[int, list[int]] = {}
    for level, label, n in counts:
        by.setdefault(level, [0, 0])[label] += n
    wrong = right = 0
    best = None
    for level in sorted(by, reverse=True):
        wrong, right = wrong + by[level][0], right + by[level][1]
        if level >= LEVELS // 2 and right and right >= precision * (wrong + right):
            best = level
    return best


@dataclass
class Model:
    trees: Trees | None
    threshold: dict[str, float]      # kinds without one follow their check

    def added(self, text: str, base: list[Span]) -> list[Span]:
        """Accepted candidates that no base span covers; of overlapping ones the best score stays."""
        proposed = candidates(text)
        if not proposed:
            return []
        score = _level(self.trees.score(np.array([features(text, s) for s in proposed]))) if self.trees else np.zeros(len(proposed), dtype=np.int64)
        taken, kept = [], []
        for i in sorted(range(len(proposed)), key=lambda i: (-score[i], proposed[i][1], proposed[i][2])):
            kind, a, b = proposed[i]
            inside = any(x <= a and b <= y for _, x, y in base)
            if inside or any(a < y and x < b for x, y in taken):
                continue
            if score[i] >= self.threshold[kind] if kind in self.threshold else weak_label(text, proposed[i], base):
                taken.append((a, b))
                kept.append(proposed[i])
        return kept

    def spans(self, text: str) -> tuple[list[Span], list[Span]]:
        """(base spans, all spans), in order."""
        base = base_spans(text)
        return base, sorted(base + self.added(text, base), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def train(documents: DataFrame, *, text_col: str = "text", sample: int = SAMPLE, precision: float = PRECISION) -> Model:
    """Fit on two thirds of a sample of the candidates of each kind and label, calibrate on the other third of all candidates."""
    bounded_batches(documents.sparkSession)
    width = len(features("0", ("number", 0, 1)))

    def propose(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            kind, x, y, fold, pick = [], [], [], [], []
            for text in b.column(0).to_pylist():
                base = base_spans(text)
                for s in candidates(text):
                    kind.append(s[0])
                    x.append(np.array(features(text, s)).tobytes())
                    y.append(weak_label(text, s, base))
                    mark = hashlib.sha256(text[s[1]:s[2]].encode()).hexdigest()
                    fold.append(int(mark[:6], 16) % 3)
                    pick.append(int(mark[6:18], 16) / 16 ** 12)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(x, pa.binary()), pa.array(y, pa.bool_()), pa.array(fold, pa.int64()),
                                              pa.array(pick, pa.float64())], names=["kind", "x", "y", "fold", "pick"])

    texts = documents.where(F.col(text_col).rlike(r"[0-9\[({<]")).select(F.col(text_col).cast("string").alias("text"))
    proposed = stage(texts.mapInArrow(propose, "kind string, x binary, y boolean, fold bigint, pick double"), "candidates", "zstd")
    seen = proposed.where("fold <> 0").groupBy("kind", "y").agg(F.count(F.lit(1)).alias("n")).collect()
    labelled = {r["kind"] for r in seen if r["y"]}
    if not labelled or all(r["y"] for r in seen):
        return Model(None, {})
    rate = F.lit(0.0)
    for r in seen:
        rate = F.when((F.col("kind") == r["kind"]) & (F.col("y") == r["y"]), F.lit(sample / r["n"])).otherwise(rate)
    # Copies of a candidate share their hash: they count once, so that no frequent one fills the driver.
    rows = proposed.where((F.col("fold") != 0) & (F.col("pick") < rate)).select("x", "y", "pick").distinct().orderBy("pick", "x", "y").collect()
    x = np.frombuffer(b"".join(bytes(r["x"]) for r in rows)).reshape(-1, width)
    y = np.array([r["y"] for r in rows], dtype=float)
    if not y.any() or y.all():
        return Model(None, {})
    trees = fit(x, y)

    def levels(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            level = _level(trees.score(np.frombuffer(b"".join(b.column(1).to_pylist())).reshape(-1, width)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(level, pa.int64()), b.column(2)], names=["kind", "level", "y"])

    held = proposed.where("fold = 0").select("kind", "x", "y").mapInArrow(levels, "kind string, level bigint, y boolean")
    counts: dict[str, list[tuple[int, bool, int]]] = {}
    for r in held.groupBy("kind", "level", "y").agg(F.count(F.lit(1)).alias("n")).collect():       # at most kinds x LEVELS x 2 rows
        counts.setdefault(r["kind"], []).append((r["level"], r["y"], r["n"]))
    found = {k: threshold_of(counts.get(k, []), precision) for k in labelled}
    return Model(trees, {k: t for k, t in found.items() if t is not None})


def listed(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find(documents: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    bounded_batches(documents.sparkSession)
    own = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = [*(f"n_{k}" for k in BASE), "base_sha256", "spans", "n_added"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            out = []
            for text in b.column(1).to_pylist():
                base, spans = model.spans(text or "")
                count = Counter(k for k, _, _ in base)
                out.append((*(count[k] for k in BASE), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(spans) - len(base)))
            cols = list(zip(*out))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types))], names=["doc_id", *names])

    kinds = [LongType()] * 4 + [StringType(), StringType(), LongType()]
    return own.mapInArrow(run, StructType([StructField("doc_id", own.schema["doc_id"].dataType), *(StructField(n, k) for n, k in zip(names, kinds))]))


def mask(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans are masked together under the first kind."""
    out, end = [], 0
    for kind, a, b in spans:
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join(out) + text[end:]


def redact(documents: DataFrame, model: Model, *, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``documents`` with masked texts (null stays null); a whole-number ``length_col`` is set to the new length where the text changed."""
    bounded_batches(documents.sparkSession)
    names = documents.columns
    at = names.index(text_col)
    size = names.index(length_col) if length_col in names and documents.schema[length_col].dataType == LongType() else None

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(rows):
            cols, old = list(b.columns), b.column(at).to_pylist()
            new = [t if t is None else mask(t, model.spans(t)[1]) for t in old]
            cols[at] = pa.array(new, b.column(at).type)
            if size is not None:
                cols[size] = pa.array([n if o is None or o == t else len(t) for n, o, t in zip(cols[size].to_pylist(), old, new)], pa.int64())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return documents.mapInArrow(run, StructType([StructField(f.name, f.dataType, True) for f in documents.schema]))
