"""Report frames: top entities, the summary document and diagnostics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordlens.operators import analytics as an


def _top(df: DataFrame, order: list, k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def top_entities(relationships: DataFrame, patents: DataFrame, inventors: DataFrame,
                 companies: DataFrame, k_inventors: int = 3, k_companies: int = 3,
                 k_countries: int = 5) -> dict[str, DataFrame]:
    """head(k) of q1, q2, q3 (ties broken by id/label for a stable cut)."""
    inv = _top(an.inventor_patent_counts(relationships, inventors),
               [F.col("patent_count").desc(), F.col("name").asc(), F.col("inventor_id").asc()], k_inventors)
    com = _top(an.company_patent_counts(relationships, companies),
               [F.col("patent_count").desc(), F.col("name").asc(), F.col("company_id").asc()], k_companies)
    cty = _top(an.country_patent_counts(relationships, inventors),
               [F.col("patent_count").desc(), F.col("country").asc()], k_countries)
    return {"top_inventors": inv, "top_companies": com, "top_countries": cty}


def top_entities_long(tops: dict[str, DataFrame]) -> DataFrame:
    """The three top lists as one long frame: (list, position, id, label, patent_count)."""
    specs = {"top_inventors": ("inventor_id", "name", ["patent_count", "name", "inventor_id"]),
             "top_companies": ("company_id", "name", ["patent_count", "name", "company_id"]),
             "top_countries": ("country", "country", ["patent_count", "country"])}
    parts = []
    for name, (id_col, label_col, order) in specs.items():
        w = Window.orderBy(F.col(order[0]).desc(), *[F.col(c).asc() for c in order[1:]])
        parts.append(tops[name].select(
            F.lit(name).alias("list"), F.row_number().over(w).alias("position"),
            F.col(id_col).alias("entity_id"), F.col(label_col).alias("label"), "patent_count"))
    return reduce(DataFrame.unionByName, parts)


def summary_report(patents: DataFrame, tops: dict[str, DataFrame]) -> DataFrame:
    """One row: total patents and each top list as an ordered array of records.

    The arrays are built from the k-row top lists (bounded by k), sorted by
    (position) so the JSON keeps the ranking order.
    """
    row = patents.agg(F.count(F.lit(1)).alias("total_patents"))
    order_specs = {"top_inventors": ["patent_count", "name", "inventor_id"],
                   "top_companies": ["patent_count", "name", "company_id"],
                   "top_countries": ["patent_count", "country"]}
    for name, order in order_specs.items():
        df = tops[name]
        w = Window.orderBy(F.col(order[0]).desc(), *[F.col(c).asc() for c in order[1:]])
        arr = (df.withColumn("_pos", F.row_number().over(w))
               .agg(F.sort_array(F.collect_list(F.struct("_pos", F.struct(*df.columns).alias("r"))))
                    .alias("_a"))
               .select(F.transform("_a", lambda x: x["r"]).alias(name)))
        row = row.crossJoin(F.broadcast(arr))
    return row


def summary_json(summary: DataFrame) -> DataFrame:
    """The summary row as one JSON document; null values are kept as null."""
    return summary.select(F.to_json(F.struct(*summary.columns), {"ignoreNullFields": "false"})
                          .alias("report"))


def report_diagnostics(relationships: DataFrame, patents: DataFrame, inventors: DataFrame,
                       companies: DataFrame) -> DataFrame:
    """Sum over years, entity counts, top entity and its count, countries seen."""
    per_year = an.q4_patents_per_year(patents)
    inv = an.inventor_patent_counts(relationships, inventors)
    com = an.company_patent_counts(relationships, companies)
    cty = an.country_patent_counts(relationships, inventors)
    def top_one(df: DataFrame, id_col: str):
        # Largest count, then smallest name, then smallest id: one aggregate pass
        # gives both the row count and the top entity.
        key = F.struct((-F.col("patent_count")).alias("k0"), F.col("name").alias("k1"), F.col(id_col).alias("k2"))
        return F.min_by(F.struct(F.col("name").alias("name"), F.col("patent_count").alias("n")), key)

    inv_row = inv.agg(F.count(F.lit(1)).alias("inventor_records"), top_one(inv, "inventor_id").alias("_ti")) \
        .select("inventor_records", F.col("_ti.name").alias("top_inventor"),
                F.col("_ti.n").alias("top_inventor_patents"))
    com_row = com.agg(F.count(F.lit(1)).alias("companies_with_patents"), top_one(com, "company_id").alias("_tc")) \
        .select("companies_with_patents", F.col("_tc.name").alias("top_company"),
                F.col("_tc.n").alias("top_company_patents"))
    parts = [
        per_year.agg(F.sum("patent_count").alias("patents_in_years")),
        inv_row,
        com_row,
        cty.agg(F.count(F.lit(1)).alias("countries_reported"),
                F.sum("patent_count").alias("patents_in_country_stats")),
    ]
    row = parts[0]
    for p in parts[1:]:
        row = row.crossJoin(F.broadcast(p))
    return row.select("patents_in_years", "inventor_records", "top_inventor", "top_inventor_patents",
                      "companies_with_patents", "top_company", "top_company_patents", "countries_reported",
                      "patents_in_country_stats")
