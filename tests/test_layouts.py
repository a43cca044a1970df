"""Search by postings, pages by a directory, layout along a curve, metrics per batch."""

import glob
import os
import random
import re

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from recordlens.operators import explore as ex
from recordlens.operators import flat as fl
from recordlens.operators.pages import PagedTable
from recordlens.operators.search_index import SearchIndex, folded, grams_of, required_grams
from recordlens.plans import zorder
from recordlens.streaming import ingest as si
from recordlens.streaming import metrics as sm

WORDS = ["urgent", "Ünïcode", "pump", "solar", "BLADE", "x+y", "a.b", "(paren)", "KELVIN", "straße", "tab\there", "日本語テキスト", "aaaa", "tail$"]


@pytest.fixture(scope="module")
def patents(spark):
    rng = random.Random(6)
    rows = [(f"p{k}", rng.choice([None, "", " ".join(rng.choices(WORDS, k=3))]), rng.choice([None, "\n".join(rng.choices(WORDS, k=6))]),
             rng.choice([None, 1999, 2001]), "B1", None) for k in range(300)]
    rows += [(None, "no id but urgent", None, 2000, "B2", None), ("p1", "repeated id, solar", "pump", 2000, "B2", None)]
    return spark.createDataFrame(rows, "patent_id string, title string, abstract string, year int, classification string, filing_date string")


@pytest.fixture(scope="module")
def index(spark, patents, tmp_path_factory):
    return SearchIndex(spark, str(tmp_path_factory.mktemp("index")), "patent_id", ("title", "abstract")).build(patents)


PATTERNS = ["urgent", "URGENT", "solar.*blade", "(pump|solar) x", "(?:pump|kelvin)s?", "aa+", "(ab)?urg(ent)+", "[ps]olar", "zzz", "no id", "a\\.b", "\\(paren\\)",
            "tail\\$", "stra(ß|ss)e", "日本語", "^urgent", "pump$", "p|s", "x{2,}", "\\bpump\\b", "(?i)pump", "\\x70ump", "\\p{L}ump", "pu(?=mp)mp", "so.ar", "STRASSE", "ünï", "[^a]ump", ""]


def test_search_equals_the_scan(index, patents):
    """Patterns with alternatives, repeats, classes, anchors and syntax that is left to a scan."""
    for pattern in PATTERNS:
        want = ex.search_patents(patents, pattern) if pattern else patents.where(F.coalesce(F.col("title"), F.col("abstract")).isNotNull())
        assert sorted(map(str, index.search(pattern).collect())) == sorted(map(str, want.select(*patents.columns).collect())), pattern


def test_candidates_are_few(index, patents):
    want = ex.search_patents(patents, "kelvin").count()
    rows = index.candidate_rows("kelvin").count()
    assert want <= rows <= want + 1 < patents.count() / 2          # the row without an id is always a candidate
    assert index.candidate_rows("zzzz").count() == 1
    assert index.candidates("p|s") is None and index.candidates("\\x70ump") is None


def test_index_of_nothing(spark, patents, tmpdir_fresh):
    empty = SearchIndex(spark, os.path.join(tmpdir_fresh, "i"), "patent_id", ("title",)).build(patents.limit(0))
    assert empty.search("urgent").collect() == [] and empty.search("u|v").collect() == []


@given(st.lists(st.sampled_from(["abc", "bcd", "a", "(abc|bcd)", "(?:ab)c", "[ab]", "d+", "(bcd)?", ".", "(a|bcda)", "x{2}", "(?:abca){1,2}", "^", "$", "é"]), max_size=5).map("".join),
       st.lists(st.text("abcdxéA", max_size=12), max_size=30))
@settings(max_examples=400, deadline=None)
def test_required_grams_hold_in_every_match(pattern, texts):
    needed = required_grams(pattern)
    if needed is not None:
        for t in texts:
            if re.search(pattern, t, re.IGNORECASE | re.ASCII):
                assert any(a <= grams_of(folded(t)) for a in needed)


def test_pages(spark, tmpdir_fresh):
    rng = random.Random(1)
    rows = [(rng.choice([None, f"k{rng.randrange(5000):05}"]) if k % 50 == 0 else f"k{rng.randrange(5000):05}", k) for k in range(6000)]
    df = spark.createDataFrame(rows, "key string, n int")
    table = PagedTable(spark, os.path.join(tmpdir_fresh, "t"), "key", ("n",)).build(df, rows_per_part=500)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    assert table.count() == 6000 and table.directory().count() >= 6
    for number, size in ((1, 50), (40, 100), (60, 100), (61, 100), (7, 999), (3, 2000), (0, 10)):
        at = (max(number, 1) - 1) * size
        assert [tuple(r) for r in table.page(number, size).collect()] == want[at:at + size], (number, size)
    # A deep page opens the parts of its rows alone.
    plan = table.page(40, 100)._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"PartitionFilters: \[(.*?)\], ", plan).group(1)
    assert 1 <= len(re.findall(r"(?<![#\d])\d+(?!\d)", re.sub(r"part#\d+", "part", read))) <= 2 and table.directory().count() >= 6, read
    last = want[3000][0]
    assert [tuple(r) for r in table.after(last, 700).collect()] == [r for r in want if r[0] is not None and r[0] > last][:700]
    empty = PagedTable(spark, os.path.join(tmpdir_fresh, "e"), "key").build(df.limit(0))
    assert empty.page(1).collect() == [] and empty.count() == 0


def row_groups_read(path, column, value):
    """Row groups whose bounds do not exclude the value, and all of them."""
    met = every = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            every += 1
            met += stats.has_min_max and stats.min <= value <= stats.max
    return met, every


def test_curve_layout_skips_row_groups_for_each_column(spark, tmpdir_fresh):
    rng = random.Random(2)
    countries = [f"C{k:02}" for k in range(30)]
    rows = [(rng.randrange(1980, 2012), rng.choice(["B1", "B2", "S1", "P1"]), rng.choice(countries), "x" * 20) for _ in range(60_000)]
    df = spark.createDataFrame(rows, "year int, classification string, country string, note string")
    path = zorder.save_along_curve(df, ["year", "classification", "country"], os.path.join(tmpdir_fresh, "z"), files=64)
    sorted_path = os.path.join(tmpdir_fresh, "s")
    df.repartitionByRange(64, "year", "classification", "country").sortWithinPartitions("year", "classification", "country").write.parquet(sorted_path)
    for column, value in (("year", 1995), ("classification", "B2"), ("country", "C11")):
        met, every = row_groups_read(path, column, value)
        assert every >= 48 and met <= 0.45 * every, (column, met, every)
        assert spark.read.parquet(path).where(F.col(column) == value).count() == sum(1 for r in rows if value in r)
    # Sorted by the columns in turn, the last one skips next to nothing.
    met, every = row_groups_read(sorted_path, "country", "C11")
    assert met >= 0.9 * every


def test_curve_key(spark):
    df = spark.createDataFrame([(None, "a"), (1, "a"), (1, None), (2, "b"), (2, "b")], "x int, y string")
    keyed = zorder.with_curve_key(df, ["x", "y"], "z", bits=4)
    assert sorted(map(str, keyed.drop("z").collect())) == sorted(map(str, df.collect()))
    assert keyed.where("z is null or z < 0 or z >= 256").count() == 0
    got = spark.createDataFrame([(5, 3)], "a bigint, b bigint").select(zorder.interleave([F.col("a"), F.col("b")], bits=3)).first()[0]
    assert got == 0b100111                       # 101 and 011, bit by bit
    with pytest.raises(ValueError):
        zorder.interleave([F.lit(1)] * 7, bits=10)


def test_batch_metrics_sum_to_the_stage_metrics(spark, tmpdir_fresh):
    rows = [(f" p{k % 40}", "t", None, ["2001-01-01", "soon", "3/4/2001"][k % 3], None, f"i{k % 7}", "n", "US", [None, "c"][k % 5 > 0], "o") for k in range(200)]
    cols = "patent_id string, title string, abstract string, filing_date string, classification string, inventor_id string, name string, country string, assignee_id string, company_name string"
    records = spark.createDataFrame(rows, cols)
    records.repartition(4).write.parquet(f"{tmpdir_fresh}/in")
    listener = sm.BatchMetrics(spark, f"{tmpdir_fresh}/metrics")
    spark.streams.addListener(listener)
    try:
        stream = sm.clean_stream(si.stream_files(spark, f"{tmpdir_fresh}/in", records.schema, max_files_per_trigger=2))
        si.run_to_parquet(stream, f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ckpt")
        per_batch = listener.rows()
    finally:
        spark.streams.removeListener(listener)
    assert per_batch.count() >= 2 and per_batch.select("batch").distinct().count() == per_batch.count()
    assert tuple(sm.totals(per_batch).first()) == tuple(fl.clean_metrics(records).select(*sm.COUNTS).first())
    assert spark.read.parquet(f"{tmpdir_fresh}/out").count() == fl.flat_clean(records).count()
