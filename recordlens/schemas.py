"""Declared schemas of the clean star model."""

from pyspark.sql import types as T

S = T.StringType()

PATENTS = T.StructType([
    T.StructField("patent_id", S, False), T.StructField("title", S, False),
    T.StructField("abstract", S), T.StructField("filing_date", S, False),
    T.StructField("year", T.IntegerType(), False), T.StructField("classification", S),
])
INVENTORS = T.StructType([
    T.StructField("inventor_id", S, False), T.StructField("name", S, False), T.StructField("country", S),
])
COMPANIES = T.StructType([T.StructField("company_id", S, False), T.StructField("name", S, False)])
RELATIONSHIPS = T.StructType([
    T.StructField("patent_id", S, False), T.StructField("inventor_id", S, False),
    T.StructField("company_id", S, False),
])
CLEAN = {"patents": PATENTS, "inventors": INVENTORS, "companies": COMPANIES, "relationships": RELATIONSHIPS}


def all_strings(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, S) for c in columns])
