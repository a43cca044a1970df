"""Property tests (hypothesis) for ranks, shares, paging and the observed metrics."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from recordlens.operators import flat as fl
from recordlens.operators.explore import patent_page
from recordlens.operators.stats import add_cumulative_share
from recordlens.plans.rank import global_dense_rank

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
rows_st = st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.integers(0, 6)),
                   min_size=0, max_size=40)


@SETTINGS
@given(rows_st)
def test_two_phase_dense_rank_matches_window(spark, rows):
    data = [(f"id{i}", n, c) for i, (n, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "id string, name string, c long")
    ours = global_dense_rank(df, [("c", False), ("name", True)], "r", num_partitions=3)
    plain = df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("c").desc(), F.col("name").asc())))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, plain.collect()))


@SETTINGS
@given(rows_st)
def test_shares_sum_to_100(spark, rows):
    data = [(f"id{i}", c) for i, (_, c) in enumerate(rows)]
    df = spark.createDataFrame(data, "id string, c long")
    out = add_cumulative_share(df, "c", "id").orderBy("rank").collect()
    assert [r["rank"] for r in out] == list(range(1, len(out) + 1))
    total = sum(c for _, c in data)
    if out and total > 0:
        assert abs(sum(r.share_pct for r in out) - 100.0) <= 0.005 * len(out) + 1e-9
    else:
        assert all(r.share_pct == 0.0 and r.cum_share_pct == 0.0 for r in out)


@SETTINGS
@given(st.integers(1, 60), st.sampled_from([5, 7, 50]))
def test_pages_partition_the_window(spark, n, size):
    df = spark.createDataFrame([(f"{i:04d}",) for i in range(n)], "patent_id string")
    pages = max(1, -(-n // size))
    seen = []
    for p in range(1, pages + 1):
        seen += [r.patent_id for r in patent_page(df, page=p, size=size).collect()]
    assert seen == sorted(f"{i:04d}" for i in range(n))


def test_observed_metrics_equal_clean_metrics(spark):
    rows = [(" 1", "T", "2020-01-01", "i", "c"), ("1", "T", "2020-01-01", "i", "c"),
            ("1", "T", "2020-01-01", "i", "c"), ("2", "", "bad", "i", "c"), ("3", None, "2021-02-02", "", "c")]
    df = spark.createDataFrame(rows, "patent_id string, title string, filing_date string, inventor_id string, "
                                     "assignee_id string")
    out, metrics = fl.flat_clean_observed(df)
    out.write.format("noop").mode("overwrite").save()
    expected = fl.clean_metrics(df).first().asDict()
    assert metrics.get == expected == {"input_rows": 5, "duplicates_removed": 1, "rows_dropped": 2,
                                       "cleaned_rows": 2}


loc_st = st.lists(st.tuples(st.sampled_from(["L1", "L2", "L3"]), st.sampled_from([None, "AA", "BB"])),
                  max_size=8)
raw_st = st.lists(st.tuples(st.sampled_from(["L1", "L2", "L3"]), st.sampled_from(["CC", "DD"])), max_size=6)


@SETTINGS
@given(loc_st, raw_st)
def test_location_rewrite_equals_join_then_max(spark, locs, raws):
    """The one-row-per-location rewrite equals MAX(COALESCE(l, n)) over the joined rows."""
    from recordlens.operators.tables import clean_inventors
    inv = spark.createDataFrame([("p", f"i{i}", "A", "B", loc) for i, loc in enumerate(["L1", "L2", "L3", None])],
                                "patent_id string, inventor_id string, disambig_inventor_name_first string, "
                                "disambig_inventor_name_last string, location_id string")
    l_df = spark.createDataFrame(locs, "location_id string, disambig_country string")
    n_df = spark.createDataFrame(raws, "location_id string, country string")
    ours = {r.inventor_id: r.country for r in clean_inventors(inv, l_df, n_df).collect()}
    brute = {}
    for i, loc in enumerate(["L1", "L2", "L3", None]):
        ls = [c for lid, c in locs if lid == loc and loc is not None] or [None]
        ns = [c for lid, c in raws if lid == loc and loc is not None] or [None]
        vals = [lc if lc is not None else nc for lc in ls for nc in ns]
        vals = [v for v in vals if v is not None]
        brute[f"i{i}"] = max(vals) if vals else None
    assert ours == brute


name_rows_st = st.lists(st.tuples(st.sampled_from(["p1", "p2"]), st.sampled_from(["0", "1"]),
                                  st.sampled_from(["Zeta", "Acme", "Beta", "  "])), max_size=8)
uuid_rows_st = st.lists(st.tuples(st.sampled_from(["p1", "p2"]), st.sampled_from(["0", "1"]),
                                  st.sampled_from(["u1", "u2", ""])), max_size=8)


@SETTINGS
@given(uuid_rows_st, name_rows_st)
def test_uuid_map_reduction_equals_brute_force(spark, uuids, names):
    """Reducing the name side to MIN(org) per key before the join picks the same first name."""
    from recordlens.operators.enrich import uuid_name_map
    pers = spark.createDataFrame(uuids, "patent_id string, assignee_sequence string, disamb_assignee_id_2020 string")
    nm = spark.createDataFrame([(p, s, "x", o) for p, s, o in names],
                               "patent_id string, assignee_sequence string, assignee_id string, "
                               "disambig_assignee_organization string")
    ours = {r.uuid: r.name for r in uuid_name_map(pers, nm).collect()}
    joined = sorted((p, s, o, u) for p, s, u in uuids if u for p2, s2, o in names
                    if (p, s) == (p2, s2) and o.strip())
    brute = {}
    for p, s, o, u in joined:
        brute.setdefault(u, o)
    assert ours == brute
