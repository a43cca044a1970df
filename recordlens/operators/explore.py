"""Explorer and overview frames: search, year filters, paging, KPIs, geo."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlens.functions.country import country_to_iso3


def _matches(col: str, keyword: str, literal: bool) -> F.Column:
    c = F.col(col)
    hit = F.lower(c).contains(keyword.lower()) if literal else c.rlike("(?i)" + keyword)
    return F.coalesce(hit, F.lit(False))


def search_patents(patents: DataFrame, keyword: str | None, literal: bool = False) -> DataFrame:
    """Case-insensitive regex (or ``literal``) match on title OR abstract."""
    if not keyword:
        return patents
    return patents.where(_matches("title", keyword, literal) | _matches("abstract", keyword, literal))


def search_inventors(inventors: DataFrame, keyword: str | None, literal: bool = False) -> DataFrame:
    if not keyword:
        return inventors
    return inventors.where(_matches("name", keyword, literal))


def filter_years(patents: DataFrame, years: list[int] | None) -> DataFrame:
    """Keep the selected years; an empty selection means no filter."""
    if not years:
        return patents
    return patents.where(F.col("year").isin([int(y) for y in years]))


def year_choices(patents: DataFrame) -> DataFrame:
    return patents.select("year").where(F.col("year").isNotNull()).distinct().orderBy("year")


def patent_page(filtered: DataFrame, page: int = 1, size: int = 100,
                window: int | None = None) -> DataFrame:
    """Page ``page`` (1-based) of the rows in patent_id order.

    Spark plans this as a top-k (TakeOrderedAndProject) bounded by
    ``page * size``; for deep pages use :func:`patent_page_after`.  A caller
    may ask for a preview of the first ``window`` rows; there is none by default.
    """
    start = (max(int(page), 1) - 1) * size
    end = start + size
    if window is not None:
        end = min(end, window)
    if end <= start:
        return filtered.limit(0)
    return filtered.orderBy(F.col("patent_id").asc()).limit(end).offset(start)


def patent_page_after(filtered: DataFrame, last_patent_id: str | None, size: int = 100) -> DataFrame:
    """Keyset page: the next ``size`` rows after ``last_patent_id``."""
    df = filtered if last_patent_id is None else filtered.where(F.col("patent_id") > last_patent_id)
    return df.orderBy(F.col("patent_id").asc()).limit(size)


def page_count(filtered: DataFrame, size: int = 100, window: int | None = None) -> DataFrame:
    """One row: rows (of the preview window, if one is given) and pages = max(1, ceil(rows / size))."""
    n = F.count(F.lit(1))
    rows = F.least(n, F.lit(window)) if window is not None else n
    return filtered.agg(rows.alias("window_rows")).select(
        "window_rows", F.greatest(F.lit(1), F.ceil(F.col("window_rows") / size)).cast("int").alias("pages"))


def patent_detail(patents: DataFrame, patent_id: str) -> DataFrame:
    return patents.where(F.col("patent_id") == patent_id).select(
        "patent_id", "title", "abstract", "year", "classification", "filing_date")


def slice_years(window_df: DataFrame) -> DataFrame:
    """Rows per year in a slice, null year kept."""
    return (window_df.groupBy("year").agg(F.count(F.lit(1)).alias("patent_count"))
            .orderBy(F.col("year").asc_nulls_last()))


def slice_diagnostics(window_df: DataFrame) -> DataFrame:
    """Unique years, earliest/latest year, unique classes, abstract coverage %."""
    return window_df.agg(
        F.countDistinct("year").alias("unique_years"),
        F.min("year").alias("earliest_year"),
        F.max("year").alias("latest_year"),
        F.countDistinct("classification").alias("classification_types"),
        F.bround(F.avg(F.col("abstract").isNotNull().cast("double")) * 100, 2).alias("abstract_coverage_pct"),
    )


def country_geo(country_frame: DataFrame) -> DataFrame:
    """Adds iso3 (null when unmappable) and a display label (null -> 'Unknown')."""
    return country_frame.withColumn("iso3", country_to_iso3("country")) \
        .withColumn("country_label", F.coalesce(F.col("country"), F.lit("Unknown")))


def country_geo_map(country_frame: DataFrame) -> DataFrame:
    """Only rows that a world map can place: a three-letter iso3."""
    g = country_geo(country_frame)
    return g.where(F.col("iso3").isNotNull() & (F.length("iso3") == 3))


def top_n(frame: DataFrame, order: list[F.Column], default: int = 10, max_value: int = 20) -> DataFrame:
    """First n rows, n = count if count <= 1 else min(default, min(max_value, count)).

    Meant for an already-cut frame (a top-20 list): the ordered window runs
    in one task, which is only right for a bounded input.
    """
    w = Window.orderBy(*order)
    df = frame.withColumn("_rn", F.row_number().over(w)) \
        .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy()))
    n = F.when(F.col("_cnt") <= 1, F.col("_cnt")).otherwise(
        F.least(F.lit(default), F.least(F.lit(max_value), F.col("_cnt"))))
    return df.where(F.col("_rn") <= n).drop("_rn", "_cnt")


def kpi_overview(patents: DataFrame, inventors: DataFrame, companies: DataFrame,
                 relationships: DataFrame, per_year: DataFrame, geo_map: DataFrame) -> DataFrame:
    """The overview KPIs as one row (each a parallel aggregate; rows joined 1x1)."""
    one = F.count(F.lit(1))
    # total_patents is the sum of the per-year counts: patents scanned once.
    parts = [
        per_year.agg(F.coalesce(F.sum("patent_count"), F.lit(0)).alias("total_patents")),
        inventors.agg(one.alias("total_inventors")),
        companies.agg(one.alias("total_companies")),
        relationships.agg(one.alias("linked_records")),
        per_year.where(F.col("year").isNotNull()).agg(
            F.max("year").alias("latest_year"),
            F.max_by("patent_count", "year").alias("latest_year_count")),
        geo_map.agg(one.alias("mapped_countries")),
    ]
    row = parts[0]
    for p in parts[1:]:
        row = row.crossJoin(F.broadcast(p))
    ratio = F.when(F.col("total_patents") > 0,
                   F.bround(F.col("linked_records") / F.col("total_patents") * 100, 2)).otherwise(F.lit(0.0))
    return row.select("total_patents", "total_inventors", "total_companies", "linked_records",
                      "latest_year", F.coalesce(F.col("latest_year_count"), F.lit(0)).alias("latest_year_count"),
                      ratio.alias("linked_ratio_pct"), "mapped_countries")
