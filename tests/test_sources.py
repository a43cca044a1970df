import os

import pytest

from recordlens.sources.delimited import (cells_span_lines, detect_separator, list_raw_files, preview_delimited, read_delimited,
                                          read_header, read_json_report, read_or_empty)
from tests.conftest import write_text

RAGGED = ('patent_id\tTitle\t"Country"\n'
          'P1\tshort\n'
          'P2\tok\tUS\n'
          'P3\tlong\tJP\textra\n'
          'P4\t"multi\nline"\tDE\n'
          'P5\tNA\tNULL\n')


def test_ragged_rows(spark, tmpdir_fresh):
    p = write_text(os.path.join(tmpdir_fresh, "g.tsv"), RAGGED)
    rows = {r["patent_id"]: r for r in read_delimited(spark, p).collect()}
    assert set(rows) == {"P1", "P2", "P4", "P5"}           # long row dropped
    assert rows["P1"]["country"] is None                    # short row padded
    assert rows["P4"]["title"] == "multi\nline"             # quoted newline kept
    assert rows["P5"]["title"] == "NA" and rows["P5"]["country"] == "NULL"


def test_ragged_rows_one_column(spark, tmpdir_fresh):
    p = write_text(os.path.join(tmpdir_fresh, "g.tsv"), RAGGED)
    ids = sorted(r[0] for r in read_delimited(spark, p, columns=["patent_id"]).collect())
    assert ids == ["P1", "P2", "P4", "P5"]


def test_legacy_na(spark, tmpdir_fresh):
    p = write_text(os.path.join(tmpdir_fresh, "g.tsv"), RAGGED)
    rows = {r["patent_id"]: r for r in read_delimited(spark, p, legacy_na=True).collect()}
    assert rows["P5"]["title"] is None and rows["P5"]["country"] is None


def test_header_and_separator(spark, tmpdir_fresh):
    p = write_text(os.path.join(tmpdir_fresh, "a.csv"), ' "Patent ID",patentTitle\n1,x\n')
    assert detect_separator(p) == "," and detect_separator("x.TXT") == "\t"
    assert read_header(spark, p) == ["patent id", "patenttitle"]


def test_preview_rows(spark, tmpdir_fresh):
    p = write_text(os.path.join(tmpdir_fresh, "g.tsv"), RAGGED)
    assert len(preview_delimited(spark, p, 2).collect()) == 2
    assert len(preview_delimited(spark, p, -5).collect()) == 0


QUOTED = [("1", 'A "smart" device'), ("2", "tab\there"), ("3", "line\nbreak"), ("4", "path C:\\"), ("5", 'two""'), ("6", "plain"), ("7", '"')]


def test_quoted_cells_equal_pandas(spark, tmpdir_fresh):
    import pandas as pd
    for name, rows in (("all.tsv", QUOTED), ("lines.tsv", [r for r in QUOTED if "\n" not in r[1]])):
        path = os.path.join(tmpdir_fresh, name)
        pd.DataFrame(rows, columns=["id", "title"]).to_csv(path, sep="\t", index=False)
        want = sorted(map(tuple, pd.read_csv(path, sep="\t", dtype=str).values.tolist()))
        assert want == sorted(rows)
        assert cells_span_lines(spark, [path]) == (name == "all.tsv")
        for multiline in (None, True) if name == "all.tsv" else (None, True, False):
            assert sorted(map(tuple, read_delimited(spark, path, multiline=multiline).collect())) == want


def test_files_without_line_breaks_are_split(spark, tmpdir_fresh):
    path = write_text(os.path.join(tmpdir_fresh, "big.tsv"), "id\ttitle\n" + "".join(f'{i}\t"a ""b"" {i}"\n' for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        df = read_delimited(spark, path)
        assert df.rdd.getNumPartitions() > 3 and df.where("title like 'a \"b\" %'").count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_unreadable_input_raises(spark, tmpdir_fresh):
    from recordlens import pipeline
    os.makedirs(os.path.join(tmpdir_fresh, "t.parquet"))
    write_text(os.path.join(tmpdir_fresh, "t.parquet", "part-0.parquet"), "not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        read_or_empty(spark, os.path.join(tmpdir_fresh, "t.parquet"), fmt="parquet").count()
    with pytest.raises(FileNotFoundError):
        pipeline.build_clean_tables(spark, os.path.join(tmpdir_fresh, "nothing"))
    assert pipeline.build_clean_tables(spark, os.path.join(tmpdir_fresh, "nothing"), sample=True)["patents"].count() == 3


def test_list_files_and_missing(spark, tmpdir_fresh):
    write_text(os.path.join(tmpdir_fresh, "b.tsv"), "a\n1\n")
    write_text(os.path.join(tmpdir_fresh, "a.csv"), "a\n1\n")
    write_text(os.path.join(tmpdir_fresh, "c.json"), "{}")
    files = [os.path.basename(f) for f in list_raw_files(spark, tmpdir_fresh)]
    assert files == ["a.csv", "b.tsv"]
    assert list_raw_files(spark, os.path.join(tmpdir_fresh, "nope")) == []
    assert read_or_empty(spark, os.path.join(tmpdir_fresh, "nope.csv")).count() == 0


def test_json_report(spark, tmpdir_fresh):
    p = write_text(os.path.join(tmpdir_fresh, "r.json"), '{\n "total_patents": 4,\n "top": [{"c": null}]\n}\n')
    row = read_json_report(spark, p).first()
    assert row["total_patents"] == 4 and row["top"][0]["c"] is None
    assert read_json_report(spark, os.path.join(tmpdir_fresh, "none.json")).count() == 0


def test_splittable_read_still_drops_overlong_rows(spark, tmpdir_fresh):
    text = "patent_id\tinventor_id\n1\ti1\n2\ti2\textra\n3\n"
    p = write_text(os.path.join(tmpdir_fresh, "g_inventor.tsv"), text)
    ids = sorted(r[0] for r in read_delimited(spark, p, multiline=False, columns=["patent_id"]).collect())
    assert ids == ["1", "3"]


def test_files_grouped_by_layout(spark, tmpdir_fresh):
    from recordlens.sources.delimited import read_raw_files
    for i in range(3):
        write_text(os.path.join(tmpdir_fresh, f"m{i}.tsv"), f"patent_id\ttitle\n{i}\tT{i}\n")
    write_text(os.path.join(tmpdir_fresh, "other.csv"), "id,name\n9,x\n")
    frames = read_raw_files(spark, list_raw_files(spark, tmpdir_fresh))
    assert len(frames) == 2
    rows = sorted((r.source_file, r.patent_id) for f in frames if "patent_id" in f.columns for r in f.collect())
    assert rows == [("m0.tsv", "0"), ("m1.tsv", "1"), ("m2.tsv", "2")]
