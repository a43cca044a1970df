"""A key holding a third of the rows: results stay exact and the heavy
aggregations reduce map-side before the shuffle (checked on the plan)."""

import contextlib
import io

from recordlens.operators import analytics as an
from recordlens.plans.keep_one import keep_first
from recordlens.plans.rank import global_dense_rank


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _skewed_bridge(spark, n=900):
    # inventor i0 holds a third of all rows
    rows = [(f"p{i}", "i0" if i % 3 == 0 else f"i{i % 50 + 1}", f"c{i % 4}") for i in range(n)]
    return spark.createDataFrame(rows, "patent_id string, inventor_id string, company_id string")


def test_hot_inventor_counts_exact(spark):
    rel = _skewed_bridge(spark)
    inv = spark.createDataFrame([(f"i{k}", f"n{k}", "US") for k in range(51)],
                                "inventor_id string, name string, country string")
    got = {r.inventor_id: r.patent_count for r in an.inventor_patent_counts(rel, inv).collect()}
    assert got["i0"] == 300 and sum(got.values()) == 900
    plan = _plan(an.inventor_patent_counts(rel, inv))
    # two-level distinct count: partial aggregate on (inventor, patent) before any exchange
    assert "partial_count" in plan or "HashAggregate(keys=[inventor_id" in plan


def test_keep_first_reduces_map_side(spark):
    rel = _skewed_bridge(spark)
    first = keep_first(rel, ["inventor_id"])
    got = {r.inventor_id: (r.patent_id, r.company_id) for r in first.collect()}
    assert got["i0"] == ("p0", "c0")
    assert "partial_min" in _plan(first)


def test_rank_with_hot_key(spark):
    rows = [(f"id{i}", "same", 5) if i % 3 == 0 else (f"id{i}", f"n{i % 40}", i % 7) for i in range(900)]
    df = spark.createDataFrame(rows, "id string, name string, c long")
    ranked = {r.id: r.r for r in global_dense_rank(df, [("c", False), ("name", True)], "r").collect()}
    assert len(ranked) == 900
    hot = {ranked[f"id{i}"] for i in range(0, 900, 3)}
    assert len(hot) == 1
