"""What a large run writes to disk: shuffles of whole records, of texts and of columns that nothing reads."""

import contextlib
import glob
import io

import pytest
from pyspark.sql import functions as F

from recordlens import queries
from recordlens.operators import flat as fl
from recordlens.operators import quality as qa
from recordlens.sources.fixture_views import FixtureViews


@pytest.fixture()
def exchanges(spark):
    """The shuffles of a plan in which no side is small enough to be sent to all tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def lines(df) -> list[str]:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return [line for line in buf.getvalue().splitlines() if "Exchange hashpartitioning" in line]

    yield lines
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _small_tables(spark, path: str) -> FixtureViews:
    """Orders, line items and texts with repeated, missing and negative keys."""
    spark.range(1).select(F.lit(1).alias("x")).write.parquet(f"{path}/nation.parquet")
    spark.createDataFrame([(1, "Customer#1", 0), (2, "Customer#2", 21), (2, "Customer#2", 21), (None, "nobody", 3)],
                          "c_custkey bigint, c_name string, c_nationkey int").write.parquet(f"{path}/customer.parquet")
    day = "timestamp'1996-01-02 00:00:00'"
    spark.createDataFrame([(10, 1, "O", "1-URGENT"), (-10, 1, "F", None), (1, 2, "P", "x"), (1, 2, "P", "x"), (None, 1, "O", "x"), (7, None, "O", "x")],
                          "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string") \
        .withColumn("o_orderdate", F.expr(day)).write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(10, 5), (10, 5), (10, 6), (-10, 5), (1, 19), (1, 4), (None, 5), (7, 5), (1, None)],
                          "l_orderkey bigint, l_suppkey bigint").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(10, "text a"), (10, "text b"), (1, None), (None, "lost")], "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    return FixtureViews(spark, path)


def test_no_whole_record_is_shuffled_to_be_made_distinct(spark, exchanges):
    v = FixtureViews(spark, "/root/testdata/sf0.001")
    found = exchanges(fl.flat_clean(v.extracted_records))
    assert len(found) == 5 and not any("company_name" in line for line in found)


def test_records_of_odd_keys(spark, tmpdir_fresh):
    got = sorted(map(str, _small_tables(spark, tmpdir_fresh).extracted_records.select("patent_id", "title", "abstract", "inventor_id", "assignee_id").collect()))
    row = "Row(patent_id={!r}, title={!r}, abstract={!r}, inventor_id={!r}, assignee_id={!r})".format
    ten = [row(" 10", "1-URGENT", text, "1", s) for text in ("text a", "text b") for s in ("5", "5", "6")]
    one = [row("1", "x", None, "2", s) for s in (None, "4", None)] * 4      # two orders of that key, two customers
    assert got == sorted([*ten, *one, row(" -10", None, None, "1", "5")])


def _clean(spark):
    rows = [("1", "t", "long", "2001-01-01", 2001, "A", "i1", "n", "US", "c1", "o"), ("1", "t", "long", "2001-01-01", 2001, "A", "i2", "m", "US", "c1", "o"),
            ("1", None, "other", "2002-01-01", 2002, "A", "i1", "n", "US", "c2", "p"), (None, "t", None, None, None, "A", "i1", "a", "US", "c1", "o")] * 2
    return spark.createDataFrame(rows, "patent_id string, title string, abstract string, filing_date string, year int, classification string, "
                                       "inventor_id string, name string, country string, assignee_id string, company_name string")


def test_texts_of_patents_are_shuffled_once(spark, exchanges):
    patents = fl.flat_patents(_clean(spark))
    assert sorted(map(str, patents.select("patent_id", "title", "abstract").collect())) == [
        "Row(patent_id='1', title=None, abstract='other')", "Row(patent_id=None, title='t', abstract=None)"]
    assert len(exchanges(patents)) == 1


def _plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_orphans_read_no_texts(spark, tmpdir_fresh):
    _clean(spark).write.parquet(f"{tmpdir_fresh}/clean")
    t = fl.split_tables(spark.read.parquet(f"{tmpdir_fresh}/clean"))
    links = spark.createDataFrame([("1", "i1", "c1"), ("1", "i1", "c9"), ("2", "i9", "c1"), ("2", None, "c2")], "patent_id string, inventor_id string, company_id string")
    orphans = qa.fk_orphans(links, t["patents"], t["inventors"], t["companies"])
    assert {(r.foreign_key, r.orphan_rows, r.orphan_keys) for r in orphans.collect()} == {("patent_id", 2, 1), ("inventor_id", 2, 1), ("company_id", 1, 1)}
    assert "abstract" not in _plan_of(orphans)


def test_tables_are_counted_without_their_texts(spark, tmpdir_fresh):
    _clean(spark).write.parquet(f"{tmpdir_fresh}/clean")
    patents = spark.createDataFrame([("1", "t", "long", "2001-01-01", 2001, "A"), ("2", "t", "long", None, None, None)] * 2,
                                    "patent_id string, title string, abstract string, filing_date string, year int, classification string")
    patents.write.parquet(f"{tmpdir_fresh}/patents")
    both = fl.union_records(spark.read.parquet(f"{tmpdir_fresh}/patents"), fl.flat_patents(spark.read.parquet(f"{tmpdir_fresh}/clean")))
    counts = qa.table_counts(qa.load_dedup({"patents": both}))
    assert [tuple(r) for r in counts.collect()] == [("patents", 3)]        # 1, 2 and the missing id
    assert "abstract" not in _plan_of(counts)


def test_keyed_tables_are_shuffled_once_to_keep_one_row(spark, exchanges):
    rows = [("i1", "b", "US"), ("i1", "a", None), ("i1", "a", "US"), (None, "x", "DE"), (None, "x", "DE"), ("i2", None, None)]
    kept = qa.dedup_on_key(spark.createDataFrame(rows, "inventor_id string, name string, country string"), ["inventor_id"])
    assert len(exchanges(kept)) == 1
    assert {tuple(r) for r in kept.collect()} == {("i1", "a", None), ("i2", None, None), (None, "x", "DE")}


def test_files_of_the_stream_are_written_without_a_shuffle(spark, exchanges, tmpdir_fresh, monkeypatch):
    v = FixtureViews(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(queries.si, "scratch_path", lambda _, name: f"{tmpdir_fresh}/{name}")
    totals = queries._scm(v).collect()
    assert totals == fl.clean_metrics(v.extracted_records).collect()
    base = f"{tmpdir_fresh}/stream_metrics"
    assert len(glob.glob(f"{base}/in/*.parquet")) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.read.parquet(f"{base}/metrics").select("batch").distinct().count() == 2
