"""Spelling variants, filter audit and line dedup against brute force and SQL."""

import hashlib
import os
import re
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordlens.llm import audit, linededup, spelling
from recordlens.llm.oracle import SQL
from recordlens.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ---- op11

def brute_words(rows, min_length=6, min_count=5):
    total = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + (len(a) >= len(b)):] == b[k + (len(b) >= len(a)):]


def brute_variants(words, factor=5):
    pieces = {}                     # a word and all it gives by one deletion: near words share one
    for w in words:
        for k in range(len(w) + 1):
            pieces.setdefault(w[:k] + w[k + 1:], set()).add(w)
            pieces.setdefault(w, set()).add(w)
    near = {w: set() for w in words}
    for group in pieces.values():
        for a in group:
            near[a] |= {b for b in group if one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= factor * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def test_spelling_variants(documents, rows):
    got = spelling.spelling_variants(documents)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == brute_variants(brute_words(rows))
    assert got.count() == len(brute_words(rows))


def test_spelling_chains_and_dense_words(spark):
    """Chains of forms, ties, one-letter words and many words within one edit of each other."""
    counts = {"abcdef": 1, "abcdeg": 5, "abcdeh": 5, "abcdefg": 25, "abcdefgh": 125, "zzzzzz": 2, "zzzzzzz": 9, "zzzzzzzz": 60,
              "éabcde": 7, "éabcdef": 40, "ÿÿÿÿÿÿ": 3, "x" * 5000: 4, "x" * 5001: 30, "qwerty": 1}
    counts |= {f"stem{a}{b}" + "ing": 1 + (ord(a) * 7 + ord(b)) % 40 for a in "abcdefgh" for b in "abcdefgh"}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    near = {(r.word, r.near) for r in spelling.near_words(words).collect()}
    want = {(a, b) for a in counts for b in counts if one_edit(a, b)}
    assert near == want and spelling.near_words(words).count() == len(want)
    # the same through texts: typed runs are rare, so the counts are taken from brute force
    rows = [(k, " ".join([w] * 5)) for k, w in enumerate(sorted(counts)) for _ in range(counts[w]) if len(w) < 100]
    got = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = brute_variants(brute_words(rows))
    assert {tuple(r) for r in got.collect()} == want
    assert any(form is not None and form != root for _, form, root, *_ in want)


@given(st.lists(st.text("abé", min_size=6, max_size=9), min_size=2, max_size=40, unique=True))
@settings(max_examples=150, deadline=None)
def test_pivots_meet_prefixes(words):
    """Of two words one edit apart, a pivot of the one is in the prefix of the other, at an allowed place."""
    grams = Counter(g for w in words for g in {w[k:k + 2] for k in range(len(w) - 1)})
    ranking = {g: (k, n) for k, (n, g) in enumerate(sorted((n, g) for g, n in grams.items()))}
    signed = {w: spelling.signature(w, ranking) for w in words}
    for w, (last, prefix, pivot) in signed.items():
        assert len(pivot) == 2 and abs(pivot[0][1] - pivot[1][1]) >= 2 and set(pivot) <= set(prefix)
        cost = {r: n for r, n in ranking.values()}
        pairs = [cost[a[0]] + cost[b[0]] for a in prefix for b in prefix if b[1] >= a[1] + 2]
        assert sum(cost[p[0]] for p in pivot) == min(pairs)
    for a in words:
        for b in words:
            if one_edit(a, b):
                r, s = (a, b) if signed[a][0] <= signed[b][0] else (b, a)
                moves = {(0, 0), (0, 1), (1, 1)} if len(s) > len(r) else {(0, 0)} if len(s) == len(r) else {(0, 0), (-1, -1)}
                assert any(g == h and y - x in {m[0] for m in moves} for g, x in signed[r][2] for h, y in signed[s][1])


def test_spelling_empty(empty, spark):
    assert spelling.spelling_variants(empty).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (None, "")], "doc_id int, text string")).collect() == []


# ---- op12

def brute_masks(rows):
    """(doc_id, part, mask) per row of (doc_id, text, part)."""
    least = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(least.get(text or "", key), key)
    out = []
    for key, text, part in rows:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
                  bool(re.search("[#$%&*|]", t)), key is not None and least[t] < key]
        out.append((key, part or "", sum(1 << k for k, f in enumerate(failed) if f)))
    return out


def brute_audit(rows, labels):
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    out = {}
    marked = brute_masks(rows)
    for part in {p for _, p, _ in marked}:
        own = [(k, m) for k, p, m in marked if p == part]
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                gone = [x for x in left if x[1] & bit]
                left = [x for x in left if not x[1] & bit]
                fails = sum(1 for x in own if x[1] & bit)
                out[part, "".join(order), step] = [len(left), len(gone), fails - len(gone), sum(1 for x in own if x[1] == bit),
                                                   sum(1 for x in gone if x[0] in good), sum(1 for x in gone if x[0] in toxic)]
                removed_by[letter] += len(gone)
        for order in permutations("ABCDE"):
            for step, letter in enumerate(order, 1):
                out[part, "".join(order), step].append(removed_by[letter])
    return {(*k, *v) for k, v in out.items()}


@pytest.fixture(scope="module")
def labels(spark):
    own = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    extra = spark.createDataFrame([(9_000_005, 1, 0), (9_000_005, 0, 1), (9_000_006, None, 1), (None, 1, 1), (9_000_004, 1, None)], "doc_id bigint, quality int, toxic int")
    return own.unionByName(extra)


def test_filter_audit(documents, labels, monkeypatch):
    docs = [(r.doc_id, r.text, r.lang) for r in documents.select("doc_id", "text", "lang").collect()]
    want = brute_audit(docs, [tuple(r) for r in labels.collect()])
    got = audit.audit(documents, labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


@pytest.mark.parametrize("local, partitions", [(1, 3), (40, 1), (1 << 20, 7)])
def test_duplicates_over_tries(spark, monkeypatch, local, partitions):
    """Prefixes of each other, long common beginnings, big groups of copies, repeated and missing ids, many splits."""
    monkeypatch.setattr(audit, "LOCAL_BYTES", local)
    monkeypatch.setattr(audit, "KEYS_PER_PARTITION", 4)
    long = "same beginning of many texts, " * 40
    texts = ["", None, "a", "ab", "abc", "abd", "é", "éé", "\U0001f600x", "\U0001f600y", long, long + "1", long + "2", long[:-1], long * 30, long * 30 + "z"]
    rows = [(k * 7 % 101, texts[k % len(texts)], "xy"[k % 2]) for k in range(400)]
    rows += [(k, "copies of one text", None) for k in range(500, 0, -1)] + [(3, "ab", "x"), (3, "ab", "y"), (None, "ab", "x"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    got = Counter()
    for r in audit.masks(docs, partitions=partitions).collect():
        got[r.doc_id, r.part, r["mask"]] += r.n
    assert got == Counter(brute_masks(rows))


@given(st.lists(st.binary(max_size=6), max_size=60))
@settings(max_examples=200, deadline=None)
def test_trie(texts):
    trie, want = audit.Trie(), {}
    for k, t in enumerate(texts):
        audit.offer(trie.find(t), -k, "p", 0, 1)
        want[t] = -k
    assert {t: held[0] for t, held in trie.terminals()} == want


def test_filter_audit_empty(empty, labels):
    assert audit.audit(empty, labels).collect() == []
    assert audit.masks(empty).collect() == []


# ---- op13

def brute_lines(rows, least=10):
    strip = " \t\n\x0b\x0c\r"
    found = Counter()
    for _, text in rows:
        found.update({lower(x.strip(strip)) for x in (text or "").split("\n")} - {""})
    out = []
    for key, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if found[lower(x.strip(strip))] < least]
        out.append((key, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return Counter(out)


ODD_LINES = ([(k, f"head {k}\n  SHARED line\t\n\nÉCOLE\nécole {k % 9}") for k in range(30)]
             + [(k, "shared LINE\r\nshared line") for k in range(9)] + [(7, "once\nonce\nonce")] * 9
             + [(None, "nothing new"), (None, "nothing new"), (40, None), (41, ""), (42, "\n\n"), (43, "École"), (44, " shared line"),
                (45, "\n".join(f"line {k % 5000}" for k in range(20_000)))]
             + [(50 + k, f"line 1\x0b\n{'x' * k}") for k in range(9)])


@pytest.mark.parametrize("batches, fanout, least", [(4, 2, 10), (1, 2, 2), (4, 3, 9)])
def test_line_dedup(spark, batches, fanout, least):
    docs = spark.createDataFrame([(k, t, "own") for k, t in ODD_LINES], "doc_id bigint, text string, n_lines string").repartition(7)
    got = linededup.digest(linededup.line_dedup(docs, min_documents=least, batches=batches, fanout=fanout))
    assert Counter(map(tuple, got.collect())) == brute_lines(ODD_LINES, least)


def test_line_dedup_of_corpus(documents, rows, empty):
    assert Counter(map(tuple, linededup.digest(linededup.line_dedup(documents)).collect())) == brute_lines(rows)
    assert linededup.line_dedup(empty).collect() == []


def test_line_runs_are_levelled(spark):
    """Runs are compacted in levels, frequent keys leave the later batches, and reading a run shuffles nothing."""
    runs = linededup.LineRuns(spark, min_documents=3, fanout=2, buckets=4)
    sizes = []
    try:
        for batch in range(5):
            keys = [(k, -k) for k in range(3)] * 3 + [(100 + batch, 0)]
            runs.add(spark.createDataFrame(keys, "h1 bigint, h2 bigint"))
            sizes.append([len(level) for level in runs.levels])
        assert sizes == [[1], [0, 1], [1, 1], [0, 0, 1], [1, 0, 1]]
        last = spark.table(runs.levels[0][0])
        assert [tuple(r) for r in last.collect()] == [(104, 0, 1)]
        plan = runs._merged(runs.runs()[:2])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("Initial Plan")[0]
        assert sorted(map(tuple, runs.frequent().collect())) == [(0, 0), (1, -1), (2, -2)]
        assert spark.table(runs.runs()[-1]).count() == 3 + 4
    finally:
        runs.close()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


@pytest.mark.parametrize("key", ["op12_filter_audit", "op13_line_dedup"])
def test_sql_twin(spark, key):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, name)}.parquet')")
    found = QUERIES[key](spark, SF_SMALL)
    rel = con.sql(SQL[key])
    assert sorted(found.columns) == sorted(rel.columns)
    order = sorted(found.columns)
    want = Counter(tuple(r[rel.columns.index(c)] for c in order) for r in rel.fetchall())
    assert Counter(tuple(r[c] for c in order) for r in found.collect()) == want
