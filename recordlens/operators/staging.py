"""Staging: raw record files -> typed-as-text staging frames.

Each function takes a raw all-string DataFrame (header names already
normalised) and returns the staging projection.  Projections and filters
are plain Column expressions, so Catalyst pushes the null filters into the
scan and prunes every unused raw column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.functions.country import normalize_country
from recordlens.functions.text import strip_ws

ASSIGNEE_ID_PREFIX = "disamb_assignee_id_"


def _rename_first(df: DataFrame, candidates: list[str], target: str) -> DataFrame:
    if target in df.columns:
        return df
    for c in candidates:
        if c in df.columns:
            return df.withColumnRenamed(c, target)
    return df.withColumn(target, F.lit(None).cast("string"))


def stage_patents(raw: DataFrame) -> DataFrame:
    df = _rename_first(raw, ["patent_title"], "title")
    return (df.select("patent_id", "patent_date", "title", "wipo_kind", "patent_type")
            .where(F.col("patent_id").isNotNull()))


def stage_abstracts(raw: DataFrame) -> DataFrame:
    df = _rename_first(raw, ["patent_abstract"], "abstract")
    return df.select("patent_id", "abstract").where(F.col("patent_id").isNotNull())


def stage_inventors(raw: DataFrame) -> DataFrame:
    return (raw.select("patent_id", "inventor_id", "disambig_inventor_name_first",
                       "disambig_inventor_name_last", "location_id")
            .where(F.col("patent_id").isNotNull() & F.col("inventor_id").isNotNull()))


def stage_locations(raw: DataFrame) -> DataFrame:
    return raw.select("location_id", "disambig_country").where(F.col("location_id").isNotNull())


def stage_raw_locations(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Raw location text -> normalised alpha-2 country; rows without one dropped."""
    return (raw.select("location_id", normalize_country("raw_country", strict).alias("country"))
            .where(F.col("location_id").isNotNull() & F.col("country").isNotNull()))


def assignee_id_columns(columns: list[str]) -> list[str]:
    """Dated assignee-id columns, discovered by prefix, in file order."""
    return [c for c in columns if c.startswith(ASSIGNEE_ID_PREFIX)]


def stage_assignees(raw: DataFrame, latest: bool = False,
                    extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """(patent_id, company_id): the leftmost non-blank dated id column wins.

    ``latest=True`` prefers the rightmost (most recent) column instead.
    No dated columns -> an empty frame with the same schema.
    """
    cols = assignee_id_columns(raw.columns)
    keys = ["patent_id", *extra_keys]
    if not cols:
        schema = T.StructType([T.StructField(k, T.StringType()) for k in keys]
                              + [T.StructField("company_id", T.StringType())])
        return raw.sparkSession.createDataFrame([], schema)
    if latest:
        cols = list(reversed(cols))
    company = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in cols])
    return (raw.select(*keys, company.alias("company_id"))
            .where(F.col("patent_id").isNotNull() & F.col("company_id").isNotNull()))


def stage_assignee_names(raw: DataFrame) -> DataFrame:
    """(assignee_id, organization), blank organisations dropped."""
    id_col = next((c for c in ("assignee_id", "disambig_assignee_id") if c in raw.columns), None)
    if id_col is None or "disambig_assignee_organization" not in raw.columns:
        schema = "assignee_id string, organization string"
        return raw.sparkSession.createDataFrame([], schema)
    return (raw.select(F.col(id_col).alias("assignee_id"),
                       F.col("disambig_assignee_organization").alias("organization"))
            .where(F.col("assignee_id").isNotNull() & F.col("organization").isNotNull()
                   & (strip_ws("organization") != "")))
