import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tests.conftest import SF_SMALL

LONG = " ".join(f"word{i % 977} of the long text number {i}." for i in range(9000))
ODD = [
    (9_000_001, None, None, None, None),
    (9_000_002, "", "en", "src0", 0),
    (9_000_003, " \t\n\x0b\x0c\r ", "xx", None, 7),
    (9_000_004, LONG, "en", "src0", len(LONG)),
    (9_000_005, "Same text twice over here today. " * 20, "en", "src0", 1),
    (9_000_005, "Same text twice over here today. " * 20, "en", "src0", 1),
    (9_000_006, "Same text twice over here today. " * 20, "en", "src1", 1),
    (None, "A row without an id stands here alone.", "en", "src2", 1),
    (9_000_007, "Ünïcödé   line 日本語   nbsp \U0001f600 x\x1cy [INST] <|endoftext|> a  b\n\n c", "fr", "src3", 3),
    (9_000_008, "x", "de", "src3", 1),
]


@pytest.fixture(scope="session")
def documents(spark):
    """Whole sf0.001 documents plus odd rows, with a column that clashes with results."""
    from pyspark.sql import functions as F
    base = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                         StructField("source", StringType()), StructField("n_chars", LongType())])
    return (base.unionByName(spark.createDataFrame(ODD, schema))
            .withColumn("kept", F.lit("own")).withColumn("fingerprint", F.lit(1)).withColumn("n_words", F.lit("w")).withColumn("posterior", F.lit("p")))


@pytest.fixture(scope="session")
def rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
