"""First and last row mean first and last in the files, whatever the ranges they are read in."""

import os

import pandas as pd
import pytest

from recordlens import pipeline
from recordlens.operators import enrich as en
from recordlens.sources.delimited import read_delimited
from tests.conftest import write_text
from tests.test_ranges import small_ranges

NAMES = [("P2", "0", "u1", "Zeta"), ("P1", "0", "u1", "Alpha"), ("P1", "1", "u2", "  "), ("P1", "1", "u2", "Mid\ndle"), ("P2", "0", "u1", "Omega"),
         (None, None, "u3", "Nameless"), ("P1", "0", "u1", "Beta"), ("P3", "0", "u2", None), ("P3", "0", "u2", "Late")] * 3 + [("P1", "0", "u1", "Final \"one\"")]
IDS = [("P9", "0", "x9"), ("P2", "0", "x1"), ("P1", "0", "x1"), ("P1", "1", "x2"), ("P3", "0", "x2"), ("P1", "0", "x3"), ("P2", "0", "x3"), ("P2", None, "x4")] * 4


def reference_maps():
    """The rules row by row: the last named row of an id, the first joined row of a uuid."""
    named = [r for r in NAMES if r[3] is not None and r[3].strip()]
    last = {}
    for _, _, key, name in named:
        last[key] = name
    first = {}
    for p, s, uuid in IDS:
        for q, t, _, name in named:
            if (p, s) == (q, t):
                first.setdefault(uuid, name)
    return last, first


@pytest.mark.parametrize("size", [60, 1 << 20])
def test_name_maps_follow_the_files(spark, tmpdir_fresh, size):
    names, ids = os.path.join(tmpdir_fresh, "n.tsv"), os.path.join(tmpdir_fresh, "i.tsv")
    pd.DataFrame(NAMES, columns=["patent_id", "assignee_sequence", "assignee_id", "disambig_assignee_organization"]).to_csv(names, sep="\t", index=False)
    pd.DataFrame(IDS, columns=["patent_id", "assignee_sequence", "disamb_assignee_id_2020"]).to_csv(ids, sep="\t", index=False)
    last, first = reference_maps()
    with small_ranges(spark, size):
        n, i = read_delimited(spark, names, row_order=True), read_delimited(spark, ids, row_order=True)
        assert {r.assignee_id: r.name for r in en.name_map_last(n).select("assignee_id", "name").collect()} == last
        assert dict(map(tuple, en.uuid_name_map(i, n).collect())) == first


RECORDS = "patent_id,title,abstract,filing_date,classification,inventor_id,name,country,assignee_id,company_name\n"


def test_flat_tables_keep_the_first_row_of_the_files(spark, tmpdir_fresh):
    """Two layouts whose files interleave by name; equal rows in two files differ by their source file."""
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    write_text(os.path.join(raw, "a.csv"), RECORDS + "P1,Zulu,\"x\ny\",2001-01-01,B1,I1,Zoe,ZZ,C1,Zed\nP1,Able,z,2001-01-02,B1,I1,Ann,AA,C1,Ace\n")
    write_text(os.path.join(raw, "b x.tsv"), "Patent ID\tdate\tInventor\tinventorName\torganization_id\tassigneeName\nP0\t2002-02-02\tI1\tAaa\tC2\tYak\nP2\t2002-02-03\tI2\tYan\tC2\tAnt\n")
    write_text(os.path.join(raw, "c.csv"), RECORDS + "P2,Beta,,2003-01-01,B1,I2,Bob,BB,C2,Bee\nP1,Zulu,\"x\ny\",2001-01-01,B1,I1,Zoe,ZZ,C1,Zed\n")
    tables = pipeline.run_flat_path(spark, raw, out_dir=os.path.join(tmpdir_fresh, "out"), file_order=True)
    rows = lambda t: sorted(tuple(r) for r in tables[t].collect())
    assert rows("inventors") == [("I1", "Zoe", "ZZ"), ("I2", "Yan", "Unknown")]
    assert rows("companies") == [("C1", "Zed"), ("C2", "Yak")]
    assert [r[:3] for r in rows("patents")] == [("P0", "Unknown", "Unknown"), ("P1", "Zulu", "x\ny"), ("P2", "Unknown", "Unknown")]
    plain = pipeline.run_flat_path(spark, raw)
    assert sorted(tuple(r) for r in plain["companies"].collect()) == [("C1", "Ace"), ("C2", "Ant")]


def test_staging_keeps_file_order(spark, tmpdir_fresh):
    raw = os.path.join(tmpdir_fresh, "raw")
    os.makedirs(raw)
    write_text(os.path.join(raw, "g_patent.tsv"), "patent_id\tpatent_date\tpatent_title\twipo_kind\tpatent_type\nP1\t2001-01-01\tT\tB1\tu\n")
    write_text(os.path.join(raw, "g_patent_abstract.tsv"), "patent_id\tpatent_abstract\nP1\t\"a\nb\"\n")
    write_text(os.path.join(raw, "g_inventor_disambiguated.tsv"), "patent_id\tinventor_id\tdisambig_inventor_name_first\tdisambig_inventor_name_last\tlocation_id\nP1\tI1\tA\tB\tL\n")
    write_text(os.path.join(raw, "g_location_disambiguated.tsv"), "location_id\tdisambig_country\nL\tUS\n")
    write_text(os.path.join(raw, "g_persistent_assignee.tsv"), "patent_id\tassignee_sequence\tdisamb_assignee_id_1\nP2\t0\tC1\nP1\t0\tC1\n")
    write_text(os.path.join(raw, "g_assignee_disambiguated.tsv"), "patent_id\tassignee_sequence\tassignee_id\tdisambig_assignee_organization\nP1\t0\tC1\tAlpha\nP2\t0\tC1\tZeta\nP2\t0\tC1\tAaa\n")
    for order, name in ((True, "Zeta"), (False, "Alpha")):
        staged = pipeline.build_staging(spark, raw, staging_dir=os.path.join(tmpdir_fresh, f"s{order}"), file_order=order)
        companies = pipeline.clean_tables_from_staging(staged)["companies"]
        assert [tuple(r) for r in pipeline.enrich_companies(staged, companies).collect()] == [("C1", name)]
