"""Data-quality reports: orphan keys, per-table counts, key de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.plans.keep_one import keep_first

TABLE_KEYS = {
    "patents": ["patent_id"],
    "inventors": ["inventor_id"],
    "companies": ["company_id"],
    "relationships": ["patent_id", "inventor_id", "company_id"],
}


def fk_orphans(relationships: DataFrame, patents: DataFrame, inventors: DataFrame,
               companies: DataFrame) -> DataFrame:
    """Rows of the bridge whose key is missing from its dimension, per FK.

    Per key the bridge is reduced to (key, rows) on the map side and
    anti-joined with the dimension's keys: the join sees keys, not rows.
    """
    def orphans(key: str, dim: DataFrame) -> DataFrame:
        counts = relationships.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
        lost = counts.join(dim.select(key).distinct(), key, "left_anti")
        return lost.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("orphan_rows"), F.count(key).alias("orphan_keys")).select(
            F.lit(key).alias("foreign_key"), "orphan_rows", "orphan_keys")

    checks = [("patent_id", patents), ("inventor_id", inventors), ("company_id", companies)]
    return reduce(DataFrame.unionByName, [orphans(*c) for c in checks])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count) for each named table; counts run in parallel."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def dedup_on_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per primary key; the kept row is the smallest by the other columns."""
    if set(keys) == set(df.columns):
        return df.distinct()
    return keep_first(df, keys, repeated=False)


def load_dedup(tables: dict[str, DataFrame], keys: dict[str, list[str]] = TABLE_KEYS) -> dict[str, DataFrame]:
    """Each table de-duplicated on its own key, globally (not per chunk)."""
    return {name: dedup_on_key(df, keys[name]) for name, df in tables.items()}


def load_dedup_legacy(relationships: DataFrame) -> DataFrame:
    """Replay of the original load's defect, for comparison only.

    The bridge was cut to one row per inventor, then one per company, as if
    those were its keys.  Kept rows: smallest by the remaining columns.
    """
    once = keep_first(relationships, ["inventor_id"], order=["patent_id", "company_id"])
    return keep_first(once, ["company_id"], order=["patent_id", "inventor_id"])
