"""Counts from pairs, from containers of patent numbers and from batches equal those from the triples."""

import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from recordlens.operators import analytics as an
from recordlens.operators import bitmaps as bm
from recordlens.operators import factorised as fa
from recordlens.operators import tables as tb
from recordlens.streaming.standing import StandingCounts, run_standing

INVENTORS = "inventor_id string, name string, country string"
TRIPLES = "patent_id string, inventor_id string, company_id string"


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(3)
    inv = [(f"p{rng.randrange(60)}", f"i{rng.randrange(30)}") for _ in range(300)] + [(None, "i1"), ("p1", None), ("lonely", "i2"), ("", "i3")]
    asg = [(f"p{rng.randrange(80)}", f"c{rng.randrange(12)}") for _ in range(200)] + [(None, "c1"), ("alone", "c2"), ("p2", None), ("", "c3")]
    return spark.createDataFrame(inv, "patent_id string, inventor_id string"), spark.createDataFrame(asg, "patent_id string, company_id string")


@pytest.fixture(scope="module")
def dims(spark):
    inventors = spark.createDataFrame([(f"i{k}", f"name {k % 20}", [None, "US", "DE", ""][k % 4]) for k in range(28)], INVENTORS)
    companies = spark.createDataFrame([(f"c{k}", f"org {k}") for k in range(11)], "company_id string, name string")
    return inventors, companies


def test_factorised_equals_triples(pairs, dims):
    inventors, companies = dims
    links, triples = fa.linked_pairs(*pairs), tb.clean_relationships(*pairs)
    assert rows(fa.top_inventors(links, inventors)) == rows(an.q1_top_inventors(triples, inventors))
    assert rows(fa.top_companies(links, companies)) == rows(an.q2_top_companies(triples, companies))
    assert rows(fa.top_countries(links, inventors)) == rows(an.q3_top_countries(triples, inventors))
    assert rows(fa.country_share(links, inventors)) == rows(an.q6_country_share_cte(triples, inventors))
    assert rows(fa.inventor_ranking(links, inventors)) == rows(an.q7_inventor_ranking(triples, inventors))
    assert rows(fa.relationships(links)) == rows(triples)
    assert tuple(fa.link_counts(links).first()) == (triples.select("patent_id").distinct().count(), triples.count())


def test_factorised_hot_patent(spark):
    """A patent with 100,000 inventors and as many companies: 10,000,000,000 triples, never made."""
    n = 100_000
    inv = spark.range(n).select(F.lit("hot").alias("patent_id"), F.concat(F.lit("i"), "id").alias("inventor_id"))
    asg = spark.range(n).select(F.lit("hot").alias("patent_id"), F.concat(F.lit("c"), "id").alias("company_id"))
    inventors = inv.select("inventor_id", F.col("inventor_id").alias("name"), F.when(F.col("inventor_id").endswith("1"), "US").alias("country"))
    links = fa.linked_pairs(inv, asg)
    assert tuple(fa.link_counts(links).first()) == (1, n * n)
    assert fa.top_inventors(links, inventors).where("patent_count = 1").count() == n
    assert fa.top_companies(links, asg.select("company_id", F.col("company_id").alias("name"))).agg(F.sum("patent_count")).first()[0] == n
    assert sorted(map(tuple, fa.top_countries(links, inventors).collect()), key=str) == [("US", 1), (None, 1)]


def test_factorised_empty(spark, pairs, dims):
    links = fa.linked_pairs(pairs[0].limit(0), pairs[1])
    assert tuple(fa.link_counts(links).first()) == (0, 0) and fa.top_inventors(links, dims[0]).collect() == []


def test_containers_merge_and_roll_up(spark):
    """Sparse and full buckets, several buckets, repeats over batches, null and missing groups."""
    rng = random.Random(8)
    batches, want = [], defaultdict(set)
    for _ in range(3):
        own = [(k, n) for k, top, m in (("a", 70_000, 3_000), ("b", 40, 60), ("c", 200_000, 40), (None, 33_000, 900)) for n in (rng.randrange(1, top) for _ in range(m))]
        own += [("a", 1), ("a", 32_768), ("a", 32_769)] * 2
        batches.append(own)
        for k, n in own:
            want[k].add(n)
    parts = [bm.containers(spark.createDataFrame(b, "key string, number bigint")) for b in batches]
    for part in parts:
        assert part.where("(few is null) = (bits is null)").count() == 0 and part.where(F.size("few") > bm.FEW).count() == 0
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    merged = bm.merge(union)
    assert merged.count() == merged.select("key", "bucket").distinct().count()
    assert {r.key: r.patent_count for r in bm.counts(merged).collect()} == {k: len(v) for k, v in want.items()}
    again = bm.merge(merged.unionByName(parts[0]))
    assert {r.key: r.patent_count for r in bm.counts(again).collect()} == {k: len(v) for k, v in want.items()}
    groups = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", None)], "key string, group string")
    got = {r.key: r.patent_count for r in bm.counts(bm.rollup(union, groups)).collect()}
    assert got == {"x": len(want["a"] | want["b"]), None: len(want["c"])}
    assert bm.merge(union.limit(0)).count() == 0


def test_standing_results_equal_the_batch_query(spark, dims, tmpdir_fresh):
    """Several batches, repeated rows, a batch that fails before its commit, a restart and compaction."""
    inventors, companies = dims
    rng = random.Random(4)
    triples = [(f"p{rng.randrange(90)}", f"i{rng.randrange(30)}", f"c{rng.randrange(12)}") for _ in range(500)]
    source, ckpt = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "ckpt")
    store = StandingCounts(spark, os.path.join(tmpdir_fresh, "store"), compact_every=3)
    assert store.top_inventors(inventors).collect() == [] and store.total_patents() == 0

    def arrive(part):
        spark.createDataFrame(part, TRIPLES).coalesce(1).write.mode("append").parquet(source)

    def check(seen):
        want = spark.createDataFrame(seen, TRIPLES).distinct()
        fresh = StandingCounts(spark, store.base)
        assert rows(fresh.top_inventors(inventors)) == rows(an.q1_top_inventors(want, inventors))
        assert rows(fresh.top_companies(companies)) == rows(an.q2_top_companies(want, companies))
        assert rows(fresh.country_share(inventors)) == rows(an.q6_country_share_cte(want, inventors))

    arrive(triples[:200])
    arrive(triples[150:300])
    run_standing(spark, source, spark.createDataFrame([], TRIPLES).schema, store.add_links, ckpt, max_files_per_trigger=1)
    check(triples[:300])
    arrive(triples[250:])
    failed = []

    def fails(batch, df):
        if not failed:
            failed.append(batch)
            commit, store._commit = store._commit, lambda *a, **k: (_ for _ in ()).throw(OSError("lost"))
            try:
                store.add_links(batch, df)
            finally:
                store._commit = commit
        return store.add_links(batch, df)

    with pytest.raises(Exception, match="lost"):
        run_standing(spark, source, spark.createDataFrame([], TRIPLES).schema, fails, ckpt, max_files_per_trigger=1)
    check(triples[:300])
    run_standing(spark, source, spark.createDataFrame([], TRIPLES).schema, store.add_links, ckpt, max_files_per_trigger=1)
    check(triples)
    assert [r.compacted for r in store._committed()] == [False, False, True]
    assert not store.add_links(2, spark.createDataFrame([("new", "i1", "c1")], TRIPLES))     # a committed batch is not taken twice
    assert store.add_links(3, spark.createDataFrame([("new", "i1", "c1"), ("p1", "i1", "c1")], TRIPLES))
    check([*triples, ("new", "i1", "c1"), ("p1", "i1", "c1")])
    for batch, years in enumerate([[1999, None], [1999, 2001], [2001]]):
        assert store.add_patents(batch, spark.createDataFrame([(y,) for y in years], "year int"))
    assert not store.add_patents(1, spark.createDataFrame([(1,)], "year int"))
    assert [tuple(r) for r in store.patents_per_year().collect()] == [(None, 1), (1999, 2), (2001, 2)]
