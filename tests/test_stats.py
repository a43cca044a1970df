import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from recordlens.operators.stats import add_cumulative_share, histogram, summarize_concentration, trend_yoy
from recordlens.plans.rank import global_dense_rank


def test_concentration_zero_totals(spark):
    empty = spark.createDataFrame([], "k string, n long")
    zeros = spark.createDataFrame([("a", 0), ("b", 0)], "k string, n long")
    for df in (empty, zeros):
        row = summarize_concentration(df, "n").first().asDict()
        assert row == {"total": 0.0, "top1_pct": 0.0, "top3_pct": 0.0, "top5_pct": 0.0,
                       "hhi": 0.0, "entropy": 0.0}


def test_concentration_properties(spark):
    vals = [("a", 50), ("b", 30), ("c", 10), ("d", 5), ("e", 3), ("f", 2)]
    row = summarize_concentration(spark.createDataFrame(vals, "k string, n long"), "n").first()
    n = len(vals)
    assert row.total == 100.0 and row.top1_pct == 50.0 and row.top3_pct == 90.0 and row.top5_pct == 98.0
    assert 1.0 / n <= row.hhi <= 1.0
    assert 0.0 <= row.entropy <= math.log2(n)
    assert abs(row.hhi - round(sum((v / 100) ** 2 for _, v in vals), 4)) < 1e-9


def test_concentration_one_row(spark):
    row = summarize_concentration(spark.createDataFrame([("a", 7)], "k string, n long"), "n").first()
    assert row.top1_pct == 100.0 and row.hhi == 1.0 and row.entropy == 0.0


def test_pareto_zero_total_keeps_rank(spark):
    df = spark.createDataFrame([("a", 0), ("b", 0)], "k string, n long")
    rows = add_cumulative_share(df, "n", "k").orderBy("rank").collect()
    assert [(r.share_pct, r.cum_share_pct, r.rank) for r in rows] == [(0.0, 0.0, 1), (0.0, 0.0, 2)]


def test_pareto_shares_sum_to_100(spark):
    vals = [(f"k{i}", i * 7 % 13 + 1) for i in range(40)]
    df = spark.createDataFrame(vals, "k string, n long")
    rows = add_cumulative_share(df, "n", "k").orderBy("rank").collect()
    assert [r.rank for r in rows] == list(range(1, 41))
    assert abs(rows[-1].cum_share_pct - 100.0) <= 0.01 * 40
    cum = [r.cum_share_pct for r in rows]
    assert cum == sorted(cum)


def test_pareto_equals_a_running_sum(spark):
    vals = [(f"k{i % 17}", i % 5, i) for i in range(300)]
    got = add_cumulative_share(spark.createDataFrame(vals, "k string, n long, id long"), "n", "k", tiebreak=["id"]).orderBy("rank").collect()
    total, cum = sum(n for _, n, _ in vals), 0.0
    for place, (k, n, i) in enumerate(sorted(vals, key=lambda v: (-v[1], v[0], v[2])), 1):
        share = round(n / total * 100, 2)
        cum += share
        assert (got[place - 1].id, got[place - 1].rank, got[place - 1].share_pct) == (i, place, share)
        assert abs(got[place - 1].cum_share_pct - cum) < 0.006


def test_two_phase_rank_equals_window(spark):
    rows = [(f"id{i}", f"name{i % 37}", i % 11) for i in range(1500)]
    df = spark.createDataFrame(rows, "id string, name string, c long")
    ours = global_dense_rank(df, [("c", False), ("name", True)], "r")
    plain = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("c").desc(), F.col("name").asc())))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))
    ranks = sorted({r.r for r in ours.collect()})
    assert ranks == list(range(1, len(ranks) + 1))  # dense: no gaps


def test_rank_with_null_keys(spark):
    df = spark.createDataFrame([("a", None, 1), ("b", "x", 1), ("c", None, 1)], "id string, name string, c long")
    ours = {r.id: r.r for r in global_dense_rank(df, [("c", False), ("name", True)], "r").collect()}
    assert ours == {"a": 1, "c": 1, "b": 2}


def test_trend_yoy_needs_two_rows(spark):
    one = spark.createDataFrame([(2020, 5)], "year int, patent_count long")
    assert trend_yoy(one).first().yoy_pct is None
    two = spark.createDataFrame([(2020, 4), (2021, 5)], "year int, patent_count long")
    assert trend_yoy(two).first().yoy_pct == 25.0


def test_histogram_constant(spark):
    df = spark.createDataFrame([(3,), (3,)], "n long")
    rows = histogram(df, "n").collect()
    assert [(r.bin, r["count"]) for r in rows] == [(0, 2)]
