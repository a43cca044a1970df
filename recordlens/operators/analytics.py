"""The seven named analytical queries and their dashboard variants.

All inputs are the clean star model: ``patents`` (patent_id key),
``inventors`` (inventor_id key), ``companies`` (company_id key) and the
``relationships`` bridge (patent_id, inventor_id, company_id).

Plan shape: counts are computed on the narrow bridge first (distinct
patents per entity is a two-level aggregate, so a hot entity costs one row
per map task) and only the small per-entity result is joined to the
dimension.  Big joins are left to AQE, which broadcasts a side only after
measuring it and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.plans.rank import global_dense_rank


def _distinct_patents(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct("patent_id").alias("patent_count"))


def inventor_patent_counts(relationships: DataFrame, inventors: DataFrame) -> DataFrame:
    """(inventor_id, name, country, patent_count) for linked inventors."""
    per_id = _distinct_patents(relationships.select("inventor_id", "patent_id"), "inventor_id")
    return inventors.select("inventor_id", "name", "country").join(per_id, "inventor_id")


def company_patent_counts(relationships: DataFrame, companies: DataFrame) -> DataFrame:
    per_id = _distinct_patents(relationships.select("company_id", "patent_id"), "company_id")
    return companies.select("company_id", "name").join(per_id, "company_id")


def inventor_patent_pairs(relationships: DataFrame) -> DataFrame:
    """Distinct (inventor_id, patent_id): the company fan-out removed once."""
    return relationships.select("inventor_id", "patent_id").distinct()


def country_patent_counts(relationships: DataFrame, inventors: DataFrame,
                          drop_unknown: bool = False) -> DataFrame:
    """Distinct patents per inventor country (null country is its own group)."""
    inv = inventors.select("inventor_id", "country")
    if drop_unknown:
        inv = inv.where(F.col("country").isNotNull() & (F.col("country") != ""))
    pairs = inventor_patent_pairs(relationships).join(inv, "inventor_id")
    return pairs.groupBy("country").agg(F.countDistinct("patent_id").alias("patent_count"))


def total_linked_patents(relationships: DataFrame) -> DataFrame:
    """One row: distinct patents in the bridge."""
    return relationships.agg(F.countDistinct("patent_id").alias("total"))


def q1_top_inventors(relationships: DataFrame, inventors: DataFrame) -> DataFrame:
    return (inventor_patent_counts(relationships, inventors)
            .orderBy(F.col("patent_count").desc(), F.col("name").asc()))


def q2_top_companies(relationships: DataFrame, companies: DataFrame) -> DataFrame:
    return (company_patent_counts(relationships, companies)
            .orderBy(F.col("patent_count").desc(), F.col("name").asc()))


def q3_top_countries(relationships: DataFrame, inventors: DataFrame) -> DataFrame:
    return (country_patent_counts(relationships, inventors)
            .orderBy(F.col("patent_count").desc(), F.col("country").asc()))


def q4_patents_per_year(patents: DataFrame) -> DataFrame:
    return (patents.groupBy("year").agg(F.count(F.lit(1)).alias("patent_count"))
            .orderBy(F.col("year").asc()))


def q5_patent_inventor_company_join(relationships: DataFrame, patents: DataFrame,
                                    inventors: DataFrame, companies: DataFrame) -> DataFrame:
    p = patents.select("patent_id", "title", "year")
    i = inventors.select("inventor_id", F.col("name").alias("inventor_name"), "country")
    c = companies.select("company_id", F.col("name").alias("company_name"))
    return (relationships.select("patent_id", "inventor_id", "company_id")
            .join(p, "patent_id").join(i, "inventor_id").join(c, "company_id")
            .select("patent_id", "title", "year", "inventor_id", "inventor_name", "country",
                    "company_id", "company_name")
            .orderBy(F.col("year").desc(), F.col("patent_id").asc()))


def _share(count_col: str, total_col: str) -> F.Column:
    return F.round(F.col(count_col).cast("double") / F.nullif(F.col(total_col), F.lit(0)) * 100, 2)


def q6_country_share_cte(relationships: DataFrame, inventors: DataFrame,
                         drop_unknown: bool = False, share_col: str = "patent_share_pct") -> DataFrame:
    counts = country_patent_counts(relationships, inventors, drop_unknown)
    total = total_linked_patents(relationships)
    # The total is a single row: broadcasting it is a proven-size cross join.
    return (counts.crossJoin(F.broadcast(total))
            .select("country", "patent_count", _share("patent_count", "total").alias(share_col))
            .orderBy(F.col("patent_count").desc(), F.col("country").asc()))


def q7_inventor_ranking(relationships: DataFrame, inventors: DataFrame) -> DataFrame:
    counts = inventor_patent_counts(relationships, inventors)
    ranked = global_dense_rank(counts, [("patent_count", False), ("name", True)], "inventor_rank")
    return (ranked.select("inventor_id", "name", "country", "patent_count", "inventor_rank")
            .orderBy(F.col("inventor_rank").asc(), F.col("name").asc()))


# -- dashboard variants ------------------------------------------------------

def dash_top_inventors(relationships: DataFrame, inventors: DataFrame, n: int = 20) -> DataFrame:
    """Top-n inventors; ties broken by id so the cut is deterministic."""
    return (inventor_patent_counts(relationships, inventors)
            .orderBy(F.col("patent_count").desc(), F.col("inventor_id").asc()).limit(n))


def dash_top_companies(relationships: DataFrame, companies: DataFrame, n: int = 20) -> DataFrame:
    return (company_patent_counts(relationships, companies)
            .orderBy(F.col("patent_count").desc(), F.col("company_id").asc()).limit(n))


def dash_top_countries(relationships: DataFrame, inventors: DataFrame, n: int = 20) -> DataFrame:
    return (country_patent_counts(relationships, inventors, drop_unknown=True)
            .orderBy(F.col("patent_count").desc(), F.col("country").asc()).limit(n))


def dash_country_share(relationships: DataFrame, inventors: DataFrame) -> DataFrame:
    """Known countries only, but the denominator counts every linked patent."""
    return q6_country_share_cte(relationships, inventors, drop_unknown=True, share_col="share_pct")


CLASS_LABELS = {
    # Display labels of the two grant kinds.
    "B1": "Granted (no prior publication)",
    "B2": "Granted (prior publication)",
}


def dash_classification(patents: DataFrame) -> DataFrame:
    label = F.when(F.col("classification") == "B1", CLASS_LABELS["B1"]) \
             .when(F.col("classification") == "B2", CLASS_LABELS["B2"])
    return (patents.where(F.col("classification").isNotNull())
            .groupBy("classification").agg(F.count(F.lit(1)).alias("count"))
            .select("classification", label.alias("label"), "count")
            .orderBy(F.col("count").desc(), F.col("classification").asc()))


def class_by_year(patents: DataFrame) -> DataFrame:
    return (patents.where(F.col("classification").isNotNull())
            .groupBy("year", "classification").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("year", "classification"))


def dash_join(relationships: DataFrame, patents: DataFrame, inventors: DataFrame,
              companies: DataFrame) -> DataFrame:
    p = patents.select("patent_id", "title", "year", "classification")
    i = inventors.select("inventor_id", F.col("name").alias("inventor_name"), "country")
    c = companies.select("company_id", F.col("name").alias("company_name"))
    return (relationships.select("patent_id", "inventor_id", "company_id")
            .join(p, "patent_id").join(i, "inventor_id").join(c, "company_id")
            .select("patent_id", "title", "year", "classification", "inventor_name", "country",
                    "company_name")
            .orderBy(F.col("year").desc(), F.col("patent_id").asc()))


def inventors_by_country(inventors: DataFrame, n: int = 30) -> DataFrame:
    """Inventor rows per country (null kept), the n largest groups."""
    return (inventors.groupBy("country").agg(F.count(F.lit(1)).alias("inventor_count"))
            .orderBy(F.col("inventor_count").desc(), F.col("country").asc_nulls_first()).limit(n))
