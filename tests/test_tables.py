import os

from recordlens import pipeline
from recordlens.operators import analytics as an
from recordlens.operators import enrich as en
from recordlens.operators import quality as qa
from recordlens.operators import staging as stg
from recordlens.operators import tables as tb
from tests.conftest import write_text


def test_wide_ids_leftmost_wins(spark):
    raw = spark.createDataFrame(
        [("p1", "", None, ""), ("p2", "a", "", ""), ("p3", "", None, "c"), ("p4", "", "b", "c")],
        "patent_id string, disamb_assignee_id_2020 string, disamb_assignee_id_2021 string, "
        "disamb_assignee_id_2022 string")
    got = {r.patent_id: r.company_id for r in stg.stage_assignees(raw).collect()}
    assert got == {"p2": "a", "p3": "c", "p4": "b"}
    latest = {r.patent_id: r.company_id for r in stg.stage_assignees(raw, latest=True).collect()}
    assert latest == {"p2": "a", "p3": "c", "p4": "c"}


def test_no_dated_columns_gives_empty(spark):
    raw = spark.createDataFrame([("p1", "x")], "patent_id string, other string")
    df = stg.stage_assignees(raw)
    assert df.columns == ["patent_id", "company_id"] and df.count() == 0


def test_name_conflicts(spark):
    asg = spark.createDataFrame([("p1", "c1"), ("p2", "c1")], "patent_id string, company_id string")
    names = spark.createDataFrame([("c1", "Beta"), ("c1", "Alpha")], "assignee_id string, organization string")
    distinct = sorted(tuple(r) for r in tb.clean_companies(asg, names).collect())
    assert distinct == [("c1", "Alpha"), ("c1", "Beta")]
    assert [tuple(r) for r in tb.companies_table(tb.clean_companies(asg, names)).collect()] == [("c1", "Alpha")]


def test_location_country_with_repeated_ids(spark):
    # One location with a null and a non-null disambiguated row: the raw country
    # only competes because of the null row.
    inv = spark.createDataFrame([("p", "i1", "A", "B", "L1"), ("p", "i2", None, None, "L2")],
                                "patent_id string, inventor_id string, disambig_inventor_name_first string, "
                                "disambig_inventor_name_last string, location_id string")
    loc = spark.createDataFrame([("L1", None), ("L1", "AA"), ("L2", "BB")],
                                "location_id string, disambig_country string")
    raw = spark.createDataFrame([("L1", "ZZ"), ("L2", "CC")], "location_id string, country string")
    got = {r.inventor_id: (r.name, r.country) for r in tb.clean_inventors(inv, loc, raw).collect()}
    assert got == {"i1": ("A B", "ZZ"), "i2": ("i2", "BB")}


def test_worked_sample(spark):
    t = pipeline.sample_tables(spark)
    q1 = {r.inventor_id: r.patent_count for r in an.q1_top_inventors(t["relationships"], t["inventors"]).collect()}
    assert q1 == {"I1": 2, "I2": 2}
    q2 = {r.company_id: r.patent_count for r in an.q2_top_companies(t["relationships"], t["companies"]).collect()}
    assert q2 == {"C1": 1, "C2": 2}
    q6 = {r.country: (r.patent_count, r.patent_share_pct)
          for r in an.q6_country_share_cte(t["relationships"], t["inventors"]).collect()}
    assert q6 == {"GB": (2, 66.67), "DE": (2, 66.67)}
    q4 = sorted(tuple(r) for r in an.q4_patents_per_year(t["patents"]).collect())
    assert q4 == [(2015, 1), (2016, 2)]


def test_legacy_load_dedup_replay(spark):
    # Two rows share an inventor, two other rows share a company: the legacy
    # rule drops one row per repeat (5 -> 4 -> 3); the keyed rule keeps all 5.
    rel = spark.createDataFrame(
        [("p1", "i1", "c1"), ("p2", "i1", "c2"), ("p3", "i2", "c3"), ("p4", "i3", "c3"), ("p5", "i4", "c4")],
        "patent_id string, inventor_id string, company_id string")
    assert qa.load_dedup({"relationships": rel})["relationships"].count() == 5
    once = qa.keep_first(rel, ["inventor_id"], order=["patent_id", "company_id"]).count()
    assert once == 4
    assert qa.load_dedup_legacy(rel).count() == 3


def test_uuid_map_first_wins(spark):
    pers = spark.createDataFrame([("p1", "1", "u1"), ("p2", "1", "u1")],
                                 "patent_id string, assignee_sequence string, disamb_assignee_id_2020 string")
    names = spark.createDataFrame([("p1", "1", "x", "Zeta"), ("p1", "1", "x", "Acme"), ("p2", "1", "x", "Beta"),
                                   ("p2", "1", "x", "  ")],
                                  "patent_id string, assignee_sequence string, assignee_id string, "
                                  "disambig_assignee_organization string")
    assert [tuple(r) for r in en.uuid_name_map(pers, names).collect()] == [("u1", "Acme")]
    assert [tuple(r) for r in en.name_map_last(names).collect()] == [("x", "Beta")]


def _write_raw(d, with_optional=True):
    write_text(os.path.join(d, "g_patent.tsv"),
               "patent_id\tpatent_date\tpatent_title\twipo_kind\tpatent_type\n"
               "1\t2019-05-01\tWidget\tB2\tutility\n2\t2020-01-02\tGadget\t\tdesign\n")
    write_text(os.path.join(d, "g_patent_abstract.tsv"), "patent_id\tpatent_abstract\n1\tAbout widgets\n")
    write_text(os.path.join(d, "g_inventor_disambiguated.tsv"),
               "patent_id\tinventor_id\tdisambig_inventor_name_first\tdisambig_inventor_name_last\tlocation_id\n"
               "1\ti1\tAda\tLove\tL1\n2\ti1\tAda\tLove\tL1\n2\ti2\t\t\tL2\n")
    write_text(os.path.join(d, "g_location_disambiguated.tsv"), "location_id\tdisambig_country\nL1\tUS\nL2\t\n")
    write_text(os.path.join(d, "g_persistent_assignee.tsv"),
               "patent_id\tassignee_sequence\tdisamb_assignee_id_20200331\tdisamb_assignee_id_20210330\n"
               "1\t0\tu1\t\n2\t0\t\tu2\n")
    if with_optional:
        write_text(os.path.join(d, "g_location_not_disambiguated.tsv"), "location_id\traw_country\nL2\tJapan\n")
        write_text(os.path.join(d, "g_assignee_disambiguated.tsv"),
                   "patent_id\tassignee_sequence\tassignee_id\tdisambig_assignee_organization\n"
                   "1\t0\tu1\tAcme Corp\n")


def test_pipeline_from_raw_files(spark, tmpdir_fresh):
    _write_raw(tmpdir_fresh)
    t = pipeline.build_clean_tables(spark, tmpdir_fresh)
    pats = {r.patent_id: (r.year, r.classification, r.abstract) for r in t["patents"].collect()}
    assert pats == {"1": (2019, "B2", "About widgets"), "2": (2020, "design", None)}
    inv = {r.inventor_id: (r.name, r.country) for r in t["inventors"].collect()}
    assert inv == {"i1": ("Ada Love", "US"), "i2": ("i2", "JP")}
    assert {tuple(r) for r in t["companies"].collect()} == {("u1", "Acme Corp"), ("u2", "u2")}
    assert t["relationships"].count() == 3


def test_pipeline_with_staging_dir(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    _write_raw(raw)
    t = pipeline.build_clean_tables(spark, raw, out_dir=os.path.join(tmpdir_fresh, "tables"))
    assert os.path.isdir(os.path.join(tmpdir_fresh, "tables", "_staging", "inventors"))
    assert t["relationships"].count() == 3 and t["patents"].count() == 2


def test_pipeline_missing_optional_inputs(spark, tmpdir_fresh):
    _write_raw(tmpdir_fresh, with_optional=False)
    t = pipeline.build_clean_tables(spark, tmpdir_fresh)
    inv = {r.inventor_id: r.country for r in t["inventors"].collect()}
    assert inv == {"i1": "US", "i2": None}
    assert {tuple(r) for r in t["companies"].collect()} == {("u1", "u1"), ("u2", "u2")}


def test_pipeline_sample_fallback(spark, tmpdir_fresh):
    t = pipeline.build_clean_tables(spark, os.path.join(tmpdir_fresh, "empty"), sample=True)
    assert t["patents"].count() == 3 and t["relationships"].count() == 4


def test_enrichment_follows_the_chosen_assignee(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    _write_raw(raw)
    write_text(os.path.join(raw, "g_persistent_assignee.tsv"),
               "patent_id\tassignee_sequence\tdisamb_assignee_id_20200331\tdisamb_assignee_id_20220929\np1\t0\told\tnew\n")
    write_text(os.path.join(raw, "g_assignee_disambiguated.tsv"),
               "patent_id\tassignee_sequence\tx_disambig_assignee_id\tmy_organization\np1\t0\tz\tAcme\n")
    for latest, company in ((False, "old"), (True, "new")):
        staged = pipeline.build_staging(spark, raw, latest_assignee=latest, staging_dir=os.path.join(tmpdir_fresh, f"stg{latest}"))
        companies = pipeline.clean_tables_from_staging(staged)["companies"]
        got = pipeline.enrich_companies(staged, companies)
        assert [tuple(r) for r in got.collect()] == [(company, "Acme")]


def test_name_columns():
    import pytest
    from recordlens.operators.enrich import name_columns
    assert name_columns(["a", "assignee_id", "disambig_assignee_organization"]) == ("assignee_id", "disambig_assignee_organization")
    assert name_columns(["x_disambig_assignee_id", "raw_organization"]) == ("x_disambig_assignee_id", "raw_organization")
    assert name_columns(["assignee_id", "raw_assignee_name_last"]) == ("assignee_id", "raw_assignee_name_last")
    with pytest.raises(ValueError):
        name_columns(["assignee_id", "country"])


def test_flat_path_from_files(spark, tmpdir_fresh):
    write_text(os.path.join(tmpdir_fresh, "a.csv"),
               "Patent ID,patentTitle,date,Inventor,inventorName,assignee_id,company\n"
               " 1,T1,2020-01-01,i1,Ann,c1,Co\n1,T1,2020-01-01,i1,Ann,c1,Co\n2,,bad,i2,Bob,c2,Co2\n")
    write_text(os.path.join(tmpdir_fresh, "b.tsv"),
               "patent_id\ttitle\tfiling_date\tinventor_id\tname\tassignee_id\tcompany_name\n"
               "3\tT3\t2021-02-03\ti1\tAnn\tc1\t\n")
    metrics = {}
    t = pipeline.run_flat_path(spark, tmpdir_fresh, metrics=metrics)
    assert metrics == {"input_rows": 4, "duplicates_removed": 0, "rows_dropped": 1, "cleaned_rows": 3}
    assert sorted(r.patent_id for r in t["patents"].collect()) == ["1", "3"]
    assert {r.company_id: r.name for r in t["companies"].collect()} == {"c1": "Co"}
    assert t["relationships"].count() == 2


def test_shared_run_queries_equal_plain(spark):
    from recordlens.sources.fixture_views import fixture_views
    from tests.conftest import SF_SMALL
    tables = fixture_views(spark, SF_SMALL).clean_tables()
    plain = pipeline.run_queries(tables)
    shared = pipeline.run_queries(tables, shared=True)
    try:
        for k, df in plain.items():
            assert df.columns == shared[k].columns, k
            def key(t):
                return tuple((x is None, str(x)) for x in t)
            assert sorted(map(tuple, df.collect()), key=key) == sorted(map(tuple, shared[k].collect()), key=key), k
    finally:
        pipeline.release(shared)


def test_generate_reports(spark, tmpdir_fresh):
    import glob
    import json
    t = pipeline.sample_tables(spark)
    paths = pipeline.generate_reports(t, os.path.join(tmpdir_fresh, "reports"), os.path.join(tmpdir_fresh, "exports"))
    doc = json.loads("".join(open(f).read() for f in glob.glob(os.path.join(paths["summary_report"], "part-*"))))
    assert doc["total_patents"] == 3
    assert [r["inventor_id"] for r in doc["top_inventors"]] == ["I1", "I2"]
    assert [r["country"] for r in doc["top_countries"]] == ["DE", "GB"]
    q6 = "".join(open(f).read() for f in glob.glob(os.path.join(paths["q6_country_share_cte"], "part-*")))
    assert "GB,2,66.67" in q6


def test_load_clean_tables_with_fallback(spark, tmpdir_fresh):
    os.makedirs(os.path.join(tmpdir_fresh, "processed"))
    write_text(os.path.join(tmpdir_fresh, "processed", "clean_patents.csv"),
               "patent_id,title,abstract,filing_date,year,classification\n1,T,,2020-01-01,2020,B1\n")
    write_text(os.path.join(tmpdir_fresh, "clean_relationships.csv"),
               "patent_id,inventor_id,company_id\n1,i1,c1\n1,i1,c1\n")
    t = pipeline.load_clean_tables(spark, tmpdir_fresh)
    assert [tuple(r) for r in t["patents"].collect()] == [("1", "T", None, "2020-01-01", 2020, "B1")]
    assert t["relationships"].count() == 2          # taken as is, no de-duplication
    assert t["inventors"].count() == 0 and t["inventors"].columns == ["inventor_id", "name", "country"]


def test_null_country_group_kept_in_q3_dropped_in_dashboard(spark):
    rel = spark.createDataFrame([("p1", "i1", "c"), ("p2", "i2", "c"), ("p3", "i3", "c")],
                                "patent_id string, inventor_id string, company_id string")
    inv = spark.createDataFrame([("i1", "A", "US"), ("i2", "B", None), ("i3", "C", "")],
                                "inventor_id string, name string, country string")
    q3 = {r.country: r.patent_count for r in an.q3_top_countries(rel, inv).collect()}
    assert q3 == {"US": 1, None: 1, "": 1}
    dash = {r.country: (r.patent_count, r.share_pct) for r in an.dash_country_share(rel, inv).collect()}
    assert dash == {"US": (1, 33.33)}          # denominator still counts every linked patent


def test_null_year_kept_in_q4(spark):
    p = spark.createDataFrame([("1", 2020), ("2", None), ("3", None)], "patent_id string, year int")
    assert sorted(map(tuple, an.q4_patents_per_year(p).collect()), key=lambda t: (t[0] is None, t[0])) == \
        [(2020, 1), (None, 2)]


def test_extraction_stage(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    write_text(os.path.join(raw, "a.csv"), "patent,title,date\n1,T,2020-01-01\n2,U,2021-01-01\n")
    write_text(os.path.join(raw, "b.txt"), "id\tpatent_title\n3\tV\n")
    write_text(os.path.join(raw, "empty.tsv"), "patent_id\ttitle\n")
    out = pipeline.run_extraction(spark, raw, os.path.join(tmpdir_fresh, "extracted"))
    summary = {r.source_file: (r.records, r.columns) for r in pipeline.extraction_summary(out).collect()}
    assert summary == {"a.csv": (2, 10), "b.txt": (1, 10)}          # a file with no rows adds nothing
    rows = {r.patent_id: (r.title, r.filing_date) for r in out.collect()}
    assert rows == {"1": ("T", "2020-01-01"), "2": ("U", "2021-01-01"), "3": ("V", None)}


def test_staging_row_counts(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    _write_raw(raw)
    counts = {}
    pipeline.build_staging(spark, raw, staging_dir=os.path.join(tmpdir_fresh, "stg"), row_counts=counts)
    assert counts == {"patents": 2, "abstracts": 1, "inventors": 3, "locations": 2, "assignee_links": 2,
                      "raw_locations": 1, "name_links": 1}
