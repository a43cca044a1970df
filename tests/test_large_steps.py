"""Steps that large inputs wait for: shuffles, files and state that must not grow with what repeats."""

import contextlib
import glob
import io
import os

import pytest
from pyspark.sql import functions as F

from recordlens.operators import bitmaps as bm
from recordlens.plans.keep_one import keep_first
from recordlens.sources.fixture_views import FixtureViews
from recordlens.streaming import ingest as si
from recordlens.streaming import metrics as sm
from recordlens.streaming.seen import SeenKeys
from recordlens.streaming.standing import StandingCounts
from tests.conftest import SF_SMALL


@pytest.fixture()
def plan(spark):
    """The plan's text, with no side small enough to be sent to all tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def text(df) -> str:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        return buf.getvalue()

    yield text
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_relationships_are_made_distinct_where_they_are_joined(spark, plan):
    assert plan(FixtureViews(spark, SF_SMALL).relationships_view).count("Exchange hashpartitioning") == 2


def test_line_items_are_shuffled_once_for_the_records(spark, plan):
    text = plan(FixtureViews(spark, SF_SMALL).extracted_records)
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len([e for e in exchanges if "l_orderkey" in e]) == 1 and len(exchanges) == 5


def test_raw_files_follow_the_partitions(spark):
    v = FixtureViews(spark, SF_SMALL)
    rows = spark.range(300).select(F.col("id").cast("string").alias("v"), F.col("id").alias("o1"))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        path = v.raw_files("steps", rows, ["o1"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    files = sorted(glob.glob(os.path.join(path.removeprefix("file:"), "*.csv")))
    assert len(files) >= 10
    assert [line.strip('"\n') for f in files for line in list(open(f, encoding="utf-8"))[1:]] == [str(k) for k in range(300)]


def test_keep_first_takes_equal_rows_together_before_it_sorts(spark, plan):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("a", 1, None), (None, 3, "y"), (None, 3, "y")], "k string, n int, t string")
    first = keep_first(df, ["k"])
    assert sorted(map(str, first.collect())) == ["Row(k='a', n=1, t=None)", "Row(k=None, n=3, t='y')"]
    assert "HashAggregate(keys=[k" in plan(first)


def test_places_of_a_container_are_shuffled_once(spark, plan):
    pairs = spark.createDataFrame([("a", 1), ("a", 1), ("a", 40_000), (None, 2)], "key string, number bigint")
    assert {(r.key, r.bucket, tuple(r.few)) for r in bm.containers(pairs).collect()} == {("a", 1, (0,)), ("a", 2, (7231,)), (None, 1, (1,))}


def test_stream_state_holds_no_texts(spark, tmpdir_fresh):
    cols = "patent_id string, title string, abstract string, filing_date string, classification string, inventor_id string, name string, country string, assignee_id string, company_name string"
    rows = [("1", None, "a" * 1000, "2001-01-01", "", "i", "n", "US", "c", "o"), ("1", "", "a" * 1000, "2001-01-01", None, "i", "n", "US", "c", "o")] * 2
    records = spark.createDataFrame(rows, cols)
    records.write.parquet(f"{tmpdir_fresh}/in")
    stream = sm.clean_stream(si.stream_files(spark, f"{tmpdir_fresh}/in", records.schema))
    state = next(line for line in stream._jdf.queryExecution().analyzed().toString().splitlines() if "Deduplicate" in line)
    assert "_h1" in state and "abstract" not in state
    si.run_to_parquet(stream, f"{tmpdir_fresh}/out", f"{tmpdir_fresh}/ckpt")
    assert spark.read.parquet(f"{tmpdir_fresh}/out").count() == 2          # an empty cell is not a missing one


def _counted(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x: int) -> int:
        seen.add(1)
        return x

    return seen, F.udf(count, "bigint").asNondeterministic()


def test_links_of_a_batch_are_computed_once(spark, tmpdir_fresh):
    seen, count = _counted(spark)
    rows = spark.range(50).select(count("id").cast("string").alias("patent_id"), F.lit("i").alias("inventor_id"), F.lit("c").alias("company_id"))
    store = StandingCounts(spark, f"{tmpdir_fresh}/store")
    assert store.add_links(0, rows) and store.total_patents() == 50
    assert seen.value == 50


def test_known_keys_are_compared_twice_at_most(spark, tmpdir_fresh, monkeypatch):
    asked = []
    kept = SeenKeys._store
    monkeypatch.setattr(SeenKeys, "_store", lambda self, hashed, *a, **k: asked.append(hashed.is_cached) or kept(self, hashed, *a, **k))
    seen = SeenKeys(spark, f"{tmpdir_fresh}/s", ["id"])
    assert seen.add(0, spark.range(100)) and seen.add(1, spark.range(50, 150)) and asked == [True, True]
    assert sorted(r.id for r in seen.rows(spark.range(1).schema).collect()) == list(range(150))
