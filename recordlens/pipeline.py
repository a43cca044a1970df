"""End-to-end jobs: raw files -> staging -> clean tables -> analytics -> reports.

One driver program; every step is a lazy DataFrame plan executed on the
cluster at the writes.  Enrichment of company names runs before the
analytics (the original ran it after the reports, so reports showed stale
names).  Missing optional inputs become empty frames with their schema.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens import schemas
from recordlens.cache import file_exists
from recordlens.operators import analytics as an
from recordlens.operators import enrich as en
from recordlens.operators import flat as fl
from recordlens.operators import quality as qa
from recordlens.operators import report as rp
from recordlens.operators import staging as stg
from recordlens.operators import tables as tb
from recordlens.sinks import export_results, save_tables, write_csv, write_json_document
from recordlens.sources.delimited import (list_raw_files, path_is_missing, read_delimited, read_header,
                                          read_raw_files, union_all)

# File names of the raw record format.
CORE_FILES = {
    "patents": "g_patent.tsv",
    "abstracts": "g_patent_abstract.tsv",
    "inventors": "g_inventor_disambiguated.tsv",
    "locations": "g_location_disambiguated.tsv",
    "assignees": "g_persistent_assignee.tsv",
}
OPTIONAL_FILES = {
    "raw_locations": "g_location_not_disambiguated.tsv",
    "names": "g_assignee_disambiguated.tsv",
}

# A tiny made-up data set for trying the library without raw files.
SAMPLE_PATENTS = [
    ("P1", "Folding bicycle frame", "A frame whose halves turn about one hinge.", "2015-03-02", 2015, "B62K"),
    ("P2", "Solar water pump", "A pump that a panel drives without a battery.", "2016-09-19", 2016, "F04B"),
    ("P3", "Quiet fan blade", "A blade with a toothed trailing edge.", "2016-12-30", 2016, "F04D"),
]
SAMPLE_INVENTORS = [("I1", "Ada Example", "GB"), ("I2", "Ben Muster", "DE")]
SAMPLE_COMPANIES = [("C1", "Hinge Works"), ("C2", "Blade and Pump")]
SAMPLE_RELATIONSHIPS = [("P1", "I1", "C1"), ("P2", "I2", "C2"), ("P3", "I2", "C2"), ("P3", "I1", "C2")]


def sample_tables(spark: SparkSession) -> dict[str, DataFrame]:
    rows = {"patents": SAMPLE_PATENTS, "inventors": SAMPLE_INVENTORS,
            "companies": SAMPLE_COMPANIES, "relationships": SAMPLE_RELATIONSHIPS}
    return {k: spark.createDataFrame(v, schemas.CLEAN[k]) for k, v in rows.items()}


def _path(raw_dir: str, name: str) -> str:
    return f"{raw_dir.rstrip('/')}/{name}"


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a raw file is there; any other fault than a missing path raises."""
    try:
        read_header(spark, path)
        return True
    except AnalysisException as exc:
        if path_is_missing(exc):
            return False
        raise


def core_files_available(spark: SparkSession, raw_dir: str) -> bool:
    return all(_exists(spark, _path(raw_dir, f)) for f in CORE_FILES.values())


def build_staging(spark: SparkSession, raw_dir: str, legacy_na: bool = False,
                  latest_assignee: bool = False, staging_dir: str | None = None,
                  row_counts: dict[str, int] | None = None, file_order: bool = False) -> dict[str, DataFrame]:
    """Staging frames from the raw files (all text, staging rules applied).

    ``assignee_links`` and ``name_links`` keep the assignee sequence for the
    name enrichment; ``assignees`` and ``names`` are projections of them.
    With ``staging_dir`` each frame that is read from a raw file is written
    once as Parquet (an empty input keeps its explicit schema) and read back,
    so the clean-table builds and the enrichment never parse raw text again;
    ``row_counts`` then receives the rows written per staging table,
    observed during those writes.  ``file_order`` carries the place of each
    assignee and name row in its file, so that "first" and "last" name mean
    first and last in the file.
    """
    def raw(name: str, order: bool = False) -> DataFrame:
        return read_delimited(spark, _path(raw_dir, name), legacy_na=legacy_na, row_order=order)

    links = ("assignee_sequence", "row_order") if file_order else ("assignee_sequence",)
    assignees = raw(CORE_FILES["assignees"], file_order)
    if "assignee_sequence" not in assignees.columns:
        assignees = assignees.withColumn("assignee_sequence", F.lit(None).cast("string"))
    staged = {
        "patents": stg.stage_patents(raw(CORE_FILES["patents"])),
        "abstracts": stg.stage_abstracts(raw(CORE_FILES["abstracts"])),
        "inventors": stg.stage_inventors(raw(CORE_FILES["inventors"])),
        "locations": stg.stage_locations(raw(CORE_FILES["locations"])),
        "assignee_links": stg.stage_assignees(assignees, latest=latest_assignee, extra_keys=links),
    }
    rl_path = _path(raw_dir, OPTIONAL_FILES["raw_locations"])
    staged["raw_locations"] = (stg.stage_raw_locations(raw(OPTIONAL_FILES["raw_locations"]))
                               if _exists(spark, rl_path)
                               else spark.createDataFrame([], "location_id string, country string"))
    nm_path = _path(raw_dir, OPTIONAL_FILES["names"])
    staged["name_links"] = (en.named_rows(raw(OPTIONAL_FILES["names"], file_order)) if _exists(spark, nm_path)
                            else spark.createDataFrame([], "patent_id string, assignee_sequence string, assignee_id string, organization string"
                                                       + (", row_order bigint" if file_order else "")))
    if staging_dir is not None:
        paths = save_tables(staged, staging_dir, row_counts=row_counts)
        staged = {k: spark.read.parquet(p) for k, p in paths.items()}
    staged["assignees"] = staged["assignee_links"].select("patent_id", "company_id")
    staged["names"] = staged["name_links"].where("assignee_id is not null").select("assignee_id", "organization")
    return staged


def clean_tables_from_staging(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    companies = tb.companies_table(tb.clean_companies(staged["assignees"], staged["names"]))
    return {
        "patents": tb.clean_patents(staged["patents"], staged["abstracts"]),
        "inventors": tb.clean_inventors(staged["inventors"], staged["locations"], staged["raw_locations"]),
        "companies": companies,
        "relationships": tb.clean_relationships(staged["inventors"], staged["assignees"]),
    }


def build_clean_tables(spark: SparkSession, raw_dir: str, out_dir: str | None = None, sample: bool = False,
                       **kwargs) -> dict[str, DataFrame]:
    """Staging path; missing core files are an error unless ``sample`` asks for the built-in sample.

    With ``out_dir`` the staging frames are also persisted under
    ``out_dir/_staging`` so every raw file is parsed exactly once.
    """
    if not core_files_available(spark, raw_dir):
        if not sample:
            raise FileNotFoundError(f"core record files are missing in {raw_dir}")
        tables = sample_tables(spark)
    else:
        if out_dir is not None:
            kwargs.setdefault("staging_dir", f"{out_dir.rstrip('/')}/_staging")
        tables = clean_tables_from_staging(build_staging(spark, raw_dir, **kwargs))
    if out_dir is None:
        return tables
    paths = save_tables(tables, out_dir)
    return {k: spark.read.parquet(p) for k, p in paths.items()}


CLEAN_FILES = {"patents": "clean_patents.csv", "inventors": "clean_inventors.csv",
               "companies": "clean_companies.csv", "relationships": "clean_relationships.csv"}


def load_clean_tables(spark: SparkSession, base_dir: str) -> dict[str, DataFrame]:
    """Clean CSV tables with their declared schemas, first from
    ``base_dir/processed``, else from ``base_dir`` itself, per table.

    Rows are taken as they are (no key de-duplication), like a first-use
    build from exported files; a table found in neither place is an empty
    frame with its schema.
    """
    from recordlens.sources.delimited import read_or_empty
    out = {}
    for name, file in CLEAN_FILES.items():
        schema = schemas.CLEAN[name]
        primary = f"{base_dir.rstrip('/')}/processed/{file}"
        fallback = f"{base_dir.rstrip('/')}/{file}"
        path = primary if _exists(spark, primary) else fallback
        out[name] = read_or_empty(spark, path, schema=schema)
    return out


def enrich_companies(staged: dict[str, DataFrame], companies: DataFrame) -> DataFrame:
    """Company names from the (persistent id, organisation) links of the staging frames."""
    m = en.name_map_from_links(staged["assignee_links"], staged["name_links"])
    return en.enrich_company_names(companies, m).select("company_id", "name")


def clean_tables_exist(spark: SparkSession, tables_dir: str) -> bool:
    """Whether all four clean tables have been written to the end."""
    return all(file_exists(spark, f"{tables_dir.rstrip('/')}/{k}/_SUCCESS") for k in schemas.CLEAN)


def run_queries(tables: dict[str, DataFrame], shared: bool = False) -> dict[str, DataFrame]:
    """q1..q7 over the clean tables.

    With ``shared=True`` the per-inventor counts (used by q1 and q7) and the
    per-country counts (q3 and q6) are built once and persisted
    (memory and disk; recomputed from lineage if an executor is lost), as
    the original pipeline re-ran the same join for every query.  Call
    :func:`release` on the result when done.
    """
    r, p, i, c = tables["relationships"], tables["patents"], tables["inventors"], tables["companies"]
    if not shared:
        return {
            "q1_top_inventors": an.q1_top_inventors(r, i),
            "q2_top_companies": an.q2_top_companies(r, c),
            "q3_top_countries": an.q3_top_countries(r, i),
            "q4_patents_per_year": an.q4_patents_per_year(p),
            "q5_patent_inventor_company_join": an.q5_patent_inventor_company_join(r, p, i, c),
            "q6_country_share_cte": an.q6_country_share_cte(r, i),
            "q7_inventor_ranking": an.q7_inventor_ranking(r, i),
        }
    from pyspark import StorageLevel
    from recordlens.plans.rank import global_dense_rank
    inv_counts = an.inventor_patent_counts(r, i).persist(StorageLevel.MEMORY_AND_DISK)
    cty_counts = an.country_patent_counts(r, i).persist(StorageLevel.MEMORY_AND_DISK)
    total = an.total_linked_patents(r)
    share = F.round(F.col("patent_count").cast("double") / F.nullif(F.col("total"), F.lit(0)) * 100, 2)
    ranked = global_dense_rank(inv_counts, [("patent_count", False), ("name", True)], "inventor_rank")
    out = {
        "q1_top_inventors": inv_counts.orderBy(F.col("patent_count").desc(), F.col("name").asc()),
        "q2_top_companies": an.q2_top_companies(r, c),
        "q3_top_countries": cty_counts.orderBy(F.col("patent_count").desc(), F.col("country").asc()),
        "q4_patents_per_year": an.q4_patents_per_year(p),
        "q5_patent_inventor_company_join": an.q5_patent_inventor_company_join(r, p, i, c),
        "q6_country_share_cte": cty_counts.crossJoin(F.broadcast(total))
        .select("country", "patent_count", share.alias("patent_share_pct"))
        .orderBy(F.col("patent_count").desc(), F.col("country").asc()),
        "q7_inventor_ranking": ranked.select("inventor_id", "name", "country", "patent_count", "inventor_rank")
        .orderBy(F.col("inventor_rank").asc(), F.col("name").asc()),
    }
    out["_persisted"] = [inv_counts, cty_counts]  # type: ignore[assignment]
    return out


def release(results: dict) -> None:
    for df in results.pop("_persisted", []):
        df.unpersist()


def generate_reports(tables: dict[str, DataFrame], reports_dir: str, exports_dir: str) -> dict[str, str]:
    """Exports of q1..q7, the top-entity CSVs and the summary JSON."""
    r, p, i, c = tables["relationships"], tables["patents"], tables["inventors"], tables["companies"]
    results = run_queries(tables, shared=True)
    persisted = results.pop("_persisted")
    paths = export_results(results, exports_dir)
    for df in persisted:
        df.unpersist()
    tops = rp.top_entities(r, p, i, c)
    paths["top_inventors"] = write_csv(tops["top_inventors"], f"{exports_dir}/top_inventors")
    paths["top_companies"] = write_csv(tops["top_companies"], f"{exports_dir}/top_companies")
    paths["country_trends"] = write_csv(an.q3_top_countries(r, i), f"{exports_dir}/country_trends")
    paths["summary_report"] = write_json_document(rp.summary_report(p, tops), f"{reports_dir}/summary_report")
    return paths


def extract_records(spark: SparkSession, raw_dir: str, legacy_na: bool = False, file_order: bool = False) -> DataFrame:
    """Flat path extract: every supported file, aliases mapped, source file kept.

    ``file_order`` numbers the rows by file and line, so that the first row
    of a key is the first in the files.

    Files are grouped per header (one read per file, since headers may
    differ); a file with no rows adds nothing.
    """
    files = list_raw_files(spark, raw_dir)
    if not files:
        raise FileNotFoundError(f"no raw input files in {raw_dir}")
    frames = [fl.map_columns(df) for df in read_raw_files(spark, files, legacy_na=legacy_na, row_order=file_order)]
    return union_all(frames)


def extraction_summary(records: DataFrame) -> DataFrame:
    """Rows extracted per source file, plus the column count (one row per file)."""
    n_cols = len([c for c in records.columns if c not in ("source_file", "row_order")])
    return (records.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"))
            .withColumn("columns", F.lit(n_cols)).orderBy("source_file"))


def run_extraction(spark: SparkSession, raw_dir: str, output: str) -> DataFrame:
    """Flat path extract stage: unified records as Parquet (``<output>_parquet``), exported once as CSV."""
    path = f"{output.rstrip('/')}_parquet"
    extract_records(spark, raw_dir).write.mode("overwrite").parquet(path)
    records = spark.read.parquet(path)
    write_csv(records, output)
    return records


def run_flat_path(spark: SparkSession, raw_dir: str, out_dir: str | None = None,
                  metrics: dict | None = None, file_order: bool = False) -> dict[str, DataFrame]:
    """Flat path: extract, clean once, split into four tables.

    The cleaned records feed four table builds, so they are written once
    (``out_dir/_cleaned``, or a checkpoint without ``out_dir``) instead of
    being recomputed per table.  Stage statistics are observed during that
    single write and stored into ``metrics`` when a dict is passed.
    """
    from recordlens.session import materialize
    clean, observed = fl.flat_clean_observed(extract_records(spark, raw_dir, file_order=file_order))
    if out_dir is None:
        clean = materialize(clean)
    else:
        path = f"{out_dir.rstrip('/')}/_cleaned"
        clean.write.mode("overwrite").parquet(path)
        clean = spark.read.parquet(path)
    if metrics is not None:
        metrics.update(observed.get)
    tables = fl.split_tables(clean)
    if out_dir is None:
        return tables
    paths = save_tables(tables, out_dir)
    return {k: spark.read.parquet(v) for k, v in paths.items()}


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, row_count) per table, all counted in parallel."""
    return qa.table_counts(tables)


__all__ = ["build_clean_tables", "build_staging", "clean_tables_exist", "clean_tables_from_staging", "enrich_companies",
           "extract_records", "extraction_summary", "generate_reports", "load_clean_tables", "release",
           "run_extraction", "run_flat_path", "run_queries", "sample_tables", "table_row_counts"]
