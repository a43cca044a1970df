import glob
import json
import os

import pytest

from recordlens.cache import cached_sql
from recordlens.operators.report import summary_json
from recordlens.sinks import drop_old_versions, overwrite_in_place, publish, read_published, save_tables, write_csv, write_json_document


def test_csv_header_only_when_empty(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "q5")
    write_csv(spark.createDataFrame([], "patent_id string, year int"), p)
    text = "".join(open(f).read() for f in glob.glob(os.path.join(p, "part-*")))
    assert text.strip() == "patent_id,year"


def test_summary_json_keeps_null(spark, tmpdir_fresh):
    df = spark.createDataFrame([(3, None)], "total_patents long, country string")
    doc = summary_json(df).first()["report"]
    assert json.loads(doc) == {"total_patents": 3, "country": None}
    p = write_json_document(df, os.path.join(tmpdir_fresh, "summary"))
    line = "".join(open(f).read() for f in glob.glob(os.path.join(p, "part-*"))).strip()
    assert "NaN" not in line and json.loads(line)["country"] is None


def test_save_tables_and_overwrite_in_place(spark, tmpdir_fresh):
    t = {"companies": spark.createDataFrame([("c1", "A"), ("c2", "B")], "company_id string, name string")}
    paths = save_tables(t, tmpdir_fresh)
    df = spark.read.parquet(paths["companies"])
    from pyspark.sql import functions as F
    changed = df.withColumn("name", F.when(F.col("company_id") == "c1", "Z").otherwise(F.col("name")))
    overwrite_in_place(changed, paths["companies"])
    assert sorted(map(tuple, spark.read.parquet(paths["companies"]).collect())) == [("c1", "Z"), ("c2", "B")]


def test_cache_reuses_and_invalidates(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    spark.createDataFrame([(1,), (2,)], "x int").write.parquet(src)
    spark.read.parquet(src).createOrReplaceTempView("cache_src")
    cache = os.path.join(tmpdir_fresh, "cache")
    a = cached_sql(spark, "SELECT SUM(x) AS s FROM cache_src", [src], cache)
    assert a.first().s == 3
    assert len(os.listdir(cache)) == 1
    cached_sql(spark, "SELECT SUM(x) AS s FROM cache_src", [src], cache)
    assert len(os.listdir(cache)) == 1
    spark.createDataFrame([(5,)], "x int").write.mode("append").parquet(src)
    spark.read.parquet(src).createOrReplaceTempView("cache_src")
    b = cached_sql(spark, "SELECT SUM(x) AS s FROM cache_src", [src], cache)
    assert b.first().s == 8 and len(os.listdir(cache)) == 2


def test_year_partitioned_patents_prune(spark, tmpdir_fresh):
    import contextlib
    import io
    from recordlens import pipeline
    from recordlens.operators.explore import filter_years
    t = pipeline.sample_tables(spark)
    paths = save_tables({"patents": t["patents"]}, tmpdir_fresh, partition_by={"patents": ["year"]})
    df = filter_years(spark.read.parquet(paths["patents"]), [2015, 2019])
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    part_filters = [ln for ln in buf.getvalue().splitlines() if ln.startswith("PartitionFilters")]
    assert part_filters and "year" in part_filters[0] and "IN (2015,2019)" in part_filters[0]
    assert sorted(r.year for r in df.collect()) == [2015]


def test_bucketed_tables_join_without_shuffle(spark, tmpdir_fresh):
    import contextlib
    import io
    from recordlens.operators.analytics import inventor_patent_counts
    from recordlens.sinks import save_bucketed
    rel = spark.createDataFrame([(f"p{i}", f"i{i % 7}", f"c{i % 3}") for i in range(50)],
                                "patent_id string, inventor_id string, company_id string")
    inv = spark.createDataFrame([(f"i{i}", f"n{i}", "US") for i in range(7)],
                                "inventor_id string, name string, country string")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS rl_test LOCATION '{tmpdir_fresh}/db'")
    names = save_bucketed({"relationships": rel, "inventors": inv},
                          {"relationships": "inventor_id", "inventors": "inventor_id"}, 4, database="rl_test")
    with_broadcast_off = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = spark.table(names["relationships"]).join(spark.table(names["inventors"]), "inventor_id")
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            joined.explain()
        assert "SortMergeJoin" in buf.getvalue() and "Exchange" not in buf.getvalue()
        counts = {r.inventor_id: r.patent_count for r in
                  inventor_patent_counts(spark.table(names["relationships"]), spark.table(names["inventors"])).collect()}
        assert counts == {f"i{k}": len([i for i in range(50) if i % 7 == k]) for k in range(7)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_broadcast_off)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_save_tables_observes_row_counts(spark, tmpdir_fresh):
    from recordlens import pipeline
    counts = {}
    save_tables(pipeline.sample_tables(spark), tmpdir_fresh, row_counts=counts)
    assert counts == {"patents": 3, "inventors": 2, "companies": 2, "relationships": 4}


def test_csv_reads_back_in_pandas_and_spark(spark, tmpdir_fresh):
    import pandas as pd
    from recordlens.sources.delimited import read_or_empty
    rows = [("1", 'say "hi", ok'), ("2", "line\nbreak"), ("3", "back\\slash"), ("4", None), ("5", '"')]
    path = write_csv(spark.createDataFrame(rows, "id string, title string").coalesce(1), os.path.join(tmpdir_fresh, "out"))
    file = glob.glob(os.path.join(path, "part-*"))[0]
    got = pd.read_csv(file, dtype=str).astype(object)
    assert sorted(map(tuple, got.where(got.notna(), None).values.tolist())) == rows
    assert sorted(map(tuple, read_or_empty(spark, path, schema="id string, title string").collect())) == rows


def test_half_written_cache_entry_is_rebuilt(spark, tmpdir_fresh):
    src, cache = os.path.join(tmpdir_fresh, "src"), os.path.join(tmpdir_fresh, "cache")
    spark.range(100).repartition(4).write.parquet(src)
    spark.read.parquet(src).createOrReplaceTempView("half_src")
    sql = "SELECT id FROM half_src"
    cached_sql(spark, sql, [src], cache)
    entry = os.path.join(cache, os.listdir(cache)[0])
    for f in os.listdir(entry):
        if f.startswith("_SUCCESS") or f.startswith("._SUCCESS") or f.startswith("part-00001"):
            os.remove(os.path.join(entry, f))
    assert cached_sql(spark, sql, [src], cache).count() == 100


def test_partitioned_tables_have_few_files(spark, tmpdir_fresh):
    df = spark.range(20000).selectExpr("cast(id as string) as patent_id", "cast(1980 + id % 40 as int) as year").repartition(16)
    paths = save_tables({"patents": df}, tmpdir_fresh, partition_by={"patents": ["year"]})
    assert len(glob.glob(os.path.join(paths["patents"], "year=*", "part-*"))) <= 80
    assert spark.read.parquet(paths["patents"]).count() == 20000


def test_publish(spark, tmpdir_fresh):
    """A table replaced from itself by versions: readers of the old one go on, a failed write is never seen."""
    path = f"{tmpdir_fresh}/companies"
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish(spark.createDataFrame([("c1", "old"), ("c2", "same")], "company_id string, name string"), path)
    before = read_published(spark, path)
    publish(before.selectExpr("company_id", "if(company_id = 'c1', 'new', name) as name"), path)
    after = read_published(spark, path)
    assert sorted(map(tuple, before.collect())) == [("c1", "old"), ("c2", "same")]
    assert sorted(map(tuple, after.collect())) == [("c1", "new"), ("c2", "same")]
    with pytest.raises(Exception, match="broken"):
        publish(after.selectExpr("company_id", "raise_error('broken') as name"), path)
    assert sorted(map(tuple, read_published(spark, path).collect())) == [("c1", "new"), ("c2", "same")]
    assert len(drop_old_versions(spark, path, keep=1)) == 1 and drop_old_versions(spark, path, keep=1) == []
    assert read_published(spark, path).count() == 2
