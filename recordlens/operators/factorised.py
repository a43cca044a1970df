"""Counts over patent links without the triple product.

The relationships table holds every (patent, inventor, company) triple: a patent with a hundred thousand
inventors and companies each has ten billion of them.  None of the counts needs them.  An inventor's patents
are those of its (patent, inventor) pairs whose patent has a company at all, so two pair sets, each reduced
by a semi-join with the other's patents, answer every question but the listing of the triples.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.operators import analytics as an


@dataclass(frozen=True)
class Links:
    """Distinct (patent_id, inventor_id) and (patent_id, company_id) pairs of the patents that have both."""

    inventors: DataFrame
    companies: DataFrame


def linked_pairs(inventors_stg: DataFrame, assignees_stg: DataFrame) -> Links:
    """The pairs that the relationships are made of; ids that are null link nothing, as in the triples."""
    inv = (inventors_stg.where(F.col("patent_id").isNotNull() & F.col("inventor_id").isNotNull())
           .select("patent_id", "inventor_id").distinct())
    asg = (assignees_stg.where(F.col("patent_id").isNotNull() & F.col("company_id").isNotNull())
           .select("patent_id", "company_id").distinct())
    # One row per patent on the right, so a patent with many companies is met once.
    return Links(inv.join(asg.select("patent_id").distinct(), "patent_id", "left_semi"),
                 asg.join(inv.select("patent_id").distinct(), "patent_id", "left_semi"))


def _counted(pairs: DataFrame, key: str) -> DataFrame:
    """Patents per key; the pairs are distinct, so a plain count does."""
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias("patent_count"))


def inventor_counts(links: Links, inventors: DataFrame) -> DataFrame:
    return inventors.select("inventor_id", "name", "country").join(_counted(links.inventors, "inventor_id"), "inventor_id")


def top_inventors(links: Links, inventors: DataFrame) -> DataFrame:
    return inventor_counts(links, inventors).orderBy(F.col("patent_count").desc(), F.col("name").asc())


def top_companies(links: Links, companies: DataFrame) -> DataFrame:
    counts = companies.select("company_id", "name").join(_counted(links.companies, "company_id"), "company_id")
    return counts.orderBy(F.col("patent_count").desc(), F.col("name").asc())


def top_countries(links: Links, inventors: DataFrame) -> DataFrame:
    return an.q3_top_countries(links.inventors, inventors)


def country_share(links: Links, inventors: DataFrame) -> DataFrame:
    return an.q6_country_share_cte(links.inventors, inventors)


def inventor_ranking(links: Links, inventors: DataFrame) -> DataFrame:
    return an.q7_inventor_ranking(links.inventors, inventors)


def link_counts(links: Links) -> DataFrame:
    """One row: linked patents, and the triples that they would make, counted without making them."""
    inv = links.inventors.groupBy("patent_id").agg(F.count(F.lit(1)).alias("i"))
    asg = links.companies.groupBy("patent_id").agg(F.count(F.lit(1)).alias("c"))
    return inv.join(asg, "patent_id").agg(
        F.count(F.lit(1)).alias("linked_patents"),
        F.coalesce(F.sum(F.col("i").cast("decimal(38,0)") * F.col("c")), F.lit(0)).cast("bigint").alias("relationships"))


def relationships(links: Links) -> DataFrame:
    """The triples themselves, for those who list them."""
    return links.inventors.join(links.companies, "patent_id").select("patent_id", "inventor_id", "company_id")
