import os

from pyspark.sql import functions as F

from recordlens.streaming.ingest import ingest


def _write_batches(spark, d, n_files=3):
    for i in range(n_files):
        spark.createDataFrame([(f"p{i}", f"i{j % 2}") for j in range(5)] + [("p0", "i0")],
                              "patent_id string, inventor_id string") \
            .coalesce(1).write.mode("overwrite").parquet(os.path.join(d, f"part{i}"))
    return d


def test_stream_equals_batch_and_restart_adds_nothing(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "src")
    for i in range(3):
        os.makedirs(src, exist_ok=True)
    _write_batches(spark, os.path.join(tmpdir_fresh, "staging"))
    # flatten into one directory of files, as arriving files
    import glob
    import shutil
    for i, f in enumerate(sorted(glob.glob(os.path.join(tmpdir_fresh, "staging", "*", "*.parquet")))):
        shutil.copy(f, os.path.join(src, f"f{i}.parquet"))
    schema = spark.read.parquet(src).schema
    sink, ckpt = os.path.join(tmpdir_fresh, "out"), os.path.join(tmpdir_fresh, "ckpt")

    def upper(df):
        return df.withColumn("inventor_id", F.upper("inventor_id"))

    out = ingest(spark, src, schema, upper, sink, ckpt, max_files_per_trigger=1,
                 dedup_keys=["patent_id", "inventor_id"])
    batch = upper(spark.read.parquet(src)).dropDuplicates(["patent_id", "inventor_id"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, batch.collect()))
    n = out.count()
    again = ingest(spark, src, schema, upper, sink, ckpt, max_files_per_trigger=1,
                   dedup_keys=["patent_id", "inventor_id"])
    assert again.count() == n


def test_several_micro_batches_dedup_across_files(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "many")
    spark.range(1000).selectExpr("id % 100 as k", "'x' as v").repartition(8).write.parquet(src)
    schema = spark.read.parquet(src).schema
    ckpt = os.path.join(tmpdir_fresh, "many_ckpt")
    out = ingest(spark, src, schema, lambda df: df, os.path.join(tmpdir_fresh, "many_out"), ckpt, max_files_per_trigger=2, dedup_keys=["k"])
    assert out.count() == 100
    assert len([f for f in os.listdir(os.path.join(ckpt, "commits")) if f.isdigit()]) >= 4
