"""Staging frames -> the four clean tables (staging path).

Plan shapes (SURVEY section 4, R2): every MAX/DISTINCT is pushed below the
row-multiplying join, so each side is first reduced on its join key.  MAX
ignores multiplicity and DISTINCT is idempotent, so the results equal the
join-then-group formulation while the join sees one row per key and a hot
key costs one row per map task in the partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.functions.dates import year_of
from recordlens.functions.names import grant_kind, org_name, person_name
from recordlens.functions.text import is_present


def clean_patents(patents_stg: DataFrame, abstracts_stg: DataFrame) -> DataFrame:
    """One row per patent: column-wise MAX, abstract joined after reduction."""
    p = (patents_stg.where(is_present("patent_id"))
         .groupBy("patent_id")
         .agg(F.max("title").alias("title"),
              F.max("patent_date").alias("filing_date"),
              F.max(grant_kind("wipo_kind", "patent_type")).alias("classification")))
    a = abstracts_stg.groupBy("patent_id").agg(F.max("abstract").alias("abstract"))
    return (p.join(a, "patent_id", "left")
            .select("patent_id", "title", "abstract", "filing_date",
                    year_of("filing_date").alias("year"), "classification"))


def location_countries(locations_stg: DataFrame, raw_locations_stg: DataFrame) -> DataFrame:
    """One row per location_id with the country MAX(COALESCE(l, n)) would give.

    Over all pairs of a location's rows, COALESCE(l.c, n.c) yields every
    non-null l value, plus every n value when some l row is null or there
    is no l row.  So the MAX is greatest(max(l), max(n) if that case holds)
    - exact even when location ids repeat.
    """
    l_agg = locations_stg.groupBy("location_id").agg(
        F.max("disambig_country").alias("_l_max"),
        F.max(F.col("disambig_country").isNull().cast("int")).alias("_l_null"))
    n_agg = raw_locations_stg.groupBy("location_id").agg(F.max("country").alias("_n_max"))
    j = l_agg.join(n_agg, "location_id", "full")
    open_to_n = F.col("_l_null").isNull() | (F.col("_l_null") == 1)
    return j.select("location_id",
                    F.greatest(F.col("_l_max"), F.when(open_to_n, F.col("_n_max")))
                    .alias("country"))


def clean_inventors(inventors_stg: DataFrame, locations_stg: DataFrame,
                    raw_locations_stg: DataFrame) -> DataFrame:
    loc = location_countries(locations_stg, raw_locations_stg)
    i = inventors_stg.where(is_present("inventor_id")).select(
        "inventor_id", "location_id",
        person_name("disambig_inventor_name_first", "disambig_inventor_name_last",
                    "inventor_id").alias("_name"))
    # One row per inventor and place, so a place shared by many rows is joined once per inventor.
    i = i.groupBy("inventor_id", "location_id").agg(F.max("_name").alias("_name"))
    return (i.join(loc, "location_id", "left")
            .groupBy("inventor_id")
            .agg(F.max("_name").alias("name"), F.max("country").alias("country")))


def clean_companies(assignees_stg: DataFrame, names_stg: DataFrame) -> DataFrame:
    """DISTINCT (company_id, name); one id may get two rows (two names)."""
    ids = assignees_stg.where(is_present("company_id")).select("company_id").distinct()
    names = names_stg.select("assignee_id", "organization").distinct()
    j = ids.join(names, ids.company_id == names.assignee_id, "left")
    return j.select("company_id", org_name("organization", "company_id").alias("name")).distinct()


def companies_table(clean_companies_df: DataFrame) -> DataFrame:
    """Keyed companies table: one name per id (the smallest), deterministic."""
    return clean_companies_df.groupBy("company_id").agg(F.min("name").alias("name"))


def clean_relationships(inventors_stg: DataFrame, assignees_stg: DataFrame) -> DataFrame:
    """Distinct (patent, inventor, company) triples linked through the patent.

    Both sides are made distinct on (patent, entity) first; the join of two
    distinct pair sets on patent_id is already unique on the triple.  A blank
    (not null) patent id is an id like any other here: input in which many
    rows have it should be filtered before, as it links all of their
    inventors with all of their companies.
    """
    inv = (inventors_stg.where(F.col("patent_id").isNotNull() & F.col("inventor_id").isNotNull())
           .select("patent_id", "inventor_id").distinct())
    asg = (assignees_stg.where(F.col("patent_id").isNotNull() & F.col("company_id").isNotNull())
           .select("patent_id", "company_id").distinct())
    return inv.join(asg, "patent_id").select("patent_id", "inventor_id", "company_id")
