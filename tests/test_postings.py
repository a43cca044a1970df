"""Postings gathered by bucket, rows numbered where they are written, bitmaps filled without a shuffle."""

import glob
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordlens.operators import bitmaps as bm
from recordlens.operators import search_index as sx

TEXTS = [None, "", "ab", "abc", "ABCabc", "Ünïcode", "日本語テキスト", "straße", "KKelvin", "tab\there", "aaaa", "\U0001f600x\U0001f600y", "1-URGENT F", "4-NOT SPECIFIED O"]


def batch(rows):
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[k] for r in rows], pa.string()) for k in (1, 2))], names=["n", "a", "b"])


def members(found):
    """(gram, bucket) -> places of all containers, and how many containers there were."""
    out, seen = {}, 0
    for b in found:
        for r in b.to_pylist():
            assert (r["few"] is None) != (r["bits"] is None)
            places = r["few"] if r["bits"] is None else np.flatnonzero(np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")).tolist()
            assert places == sorted(set(places)) and (len(places) <= bm.FEW) == (r["bits"] is None)
            out.setdefault((r["key"], r["bucket"]), []).extend(places)
            seen += 1
    return {k: sorted(v) for k, v in out.items()}, seen


def plain(rows):
    out = {}
    for number, *texts in rows:
        for gram in set().union(*(sx.grams_of(sx.folded(t)) for t in texts if t)):
            out.setdefault((gram, (number - 1) // 32_768 + 1), []).append((number - 1) % 32_768)
    return out


@pytest.mark.parametrize("gathered", [1, 50, 1 << 22])
def test_postings_are_those_of_each_row(monkeypatch, gathered):
    monkeypatch.setattr(sx, "GATHERED", gathered)
    rng = random.Random(4)
    rows = [(n, rng.choice(TEXTS), rng.choice(TEXTS)) for n in [*range(1, 300), *range(32_700, 32_900), *range(1 << 34, (1 << 34) + 900)]]
    got, _ = members(sx._batch_postings(batch(rows[k:k + 77]) for k in range(0, len(rows), 77)))
    assert got == plain(rows)
    assert list(sx._batch_postings([batch([])])) == [] and list(sx._batch_postings([batch([(1, None, "ab")])])) == []


def test_a_bucket_gives_one_container_a_gram():
    """However many batches its rows come in, there is nothing left to merge."""
    rows = [(n, TEXTS[n % len(TEXTS)], "solar") for n in range(1, 2000)]
    got, seen = members(sx._batch_postings(batch(rows[k:k + 100]) for k in range(0, len(rows), 100)))
    assert seen == len(got) and len(got["sol", 1]) == 1999


def test_more_letters_than_16_bits():
    text = "".join(map(chr, [*range(0x100, 0xD800), *range(0xE000, 0x1A000)]))
    rows = [(5, text, "abc"), (9, None, text[:40])]
    got, _ = members(sx._batch_postings([batch(rows)]))
    assert got == plain(rows)


def test_rows_are_numbered_where_they_are_written(spark, tmpdir_fresh):
    """No row is moved; a bucket is written by one task; rows of one id have numbers of their own."""
    rows = [(f"p{k % 50}" if k % 7 else None, f"text {k}", k) for k in range(400)]
    df = spark.createDataFrame(rows, "id string, text string, k int").repartition(3)
    index = sx.SearchIndex(spark, f"{tmpdir_fresh}/i", "id", ("text",)).build(df)
    stored = index._rows()
    assert sorted(map(str, stored.select("id", "text", "k").collect())) == sorted(map(str, df.collect()))
    assert stored.where("id is not null").select("__number").distinct().count() == sum(r[0] is not None for r in rows)
    assert stored.where("(id is null) <> (__number is null)").count() == 0
    folders = glob.glob(f"{tmpdir_fresh}/i/rows/__bucket=[0-9]*")
    assert folders and all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in folders)
    for word in ("text 1", "text 39[0-9]", "none such"):
        want = df.where(F.col("text").rlike(word))
        assert sorted(map(str, index.search(word).collect())) == sorted(map(str, want.collect())), word


def test_candidates_beyond_a_broadcast(spark, tmpdir_fresh, monkeypatch):
    monkeypatch.setattr(sx, "BROADCAST", 0)
    df = spark.range(500).selectExpr("cast(id as string) as id", "concat('text ', id % 13, ' end') as text").repartition(3)
    index = sx.SearchIndex(spark, f"{tmpdir_fresh}/i", "id", ("text",)).build(df)
    assert index.search("t 1[12] e").count() == df.where("text rlike 't 1[12] e'").count()


def test_bitmaps_are_filled_without_a_shuffle_of_places(spark):
    rng = random.Random(3)
    pairs = [("a", n) for n in range(1, 40_000)] + [(None, n) for n in range(1, 1400, 2)] + [("b", rng.randrange(1, 200_000)) for _ in range(300)]
    df = spark.createDataFrame(pairs, "key string, number bigint")
    made = bm.merge(bm.containers(df).unionByName(bm.containers(df.where("number % 3 = 0"))))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan, plan
    place = {}
    for r in made.collect():
        got = r["few"] if r["bits"] is None else np.flatnonzero(np.unpackbits(np.frombuffer(bytes(r["bits"]), np.uint8), bitorder="little")).tolist()
        assert (r["key"], r["bucket"]) not in place and len(r["bits"] or b"x" * 4096) == 4096
        place[r["key"], r["bucket"]] = got
    want = {}
    for k, n in sorted(set(pairs), key=str):
        want.setdefault((k, (n - 1) // 32_768 + 1), []).append((n - 1) % 32_768)
    assert place == {k: sorted(v) for k, v in want.items()}
    assert {r.key: r.patent_count for r in bm.counts(made).collect()} == {k: len({n for x, n in pairs if x == k}) for k in ("a", None, "b")}
