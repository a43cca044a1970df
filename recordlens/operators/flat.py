"""Flat path: wide extracted records -> cleaned records -> four tables.

This path has its own rules, deliberately kept apart from the staging path:
ids are stripped after the full-row de-duplication, missing text becomes
'Unknown', and "first row per key" takes an explicit order.  Records that
carry ``row_order`` (the place in the files) keep the first row by it; others
order by their columns.  Difference from the original, by design: an id that is blank
after stripping is dropped like a missing one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.functions.dates import date_text, parse_date_text
from recordlens.functions.text import snake_case, strip_ws
from recordlens.plans.keep_one import keep_first

# Canonical field -> accepted header aliases, first match wins.
RELEVANT_FIELDS = {
    "patent_id": ["patent_id", "patent", "id"],
    "title": ["title", "patent_title"],
    "abstract": ["abstract", "patent_abstract"],
    "filing_date": ["filing_date", "date", "patent_date"],
    "classification": [
        "classification",
        "main_classification",
        "cpc_subgroup_id",
        "cpc_group_id",
        "uspc_mainclass_id",
    ],
    "inventor_id": ["inventor_id", "inventor", "inventor_key_id"],
    "name": ["name", "inventor_name", "inventor_full_name"],
    "country": ["country", "inventor_country"],
    "assignee_id": ["assignee_id", "company_id", "organization_id"],
    "company_name": ["company_name", "assignee_name", "company", "organization_name"],
}

ID_COLUMNS = ["patent_id", "inventor_id", "assignee_id"]
REQUIRED = ["patent_id", "inventor_id", "assignee_id", "filing_date"]
TEXT_COLUMNS = ["title", "abstract", "classification", "name", "country", "company_name"]
UNKNOWN = "Unknown"


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(c) for c in df.columns])


def map_columns(df: DataFrame, fields: dict[str, list[str]] = RELEVANT_FIELDS,
                keep: tuple[str, ...] = ("source_file", "row_order")) -> DataFrame:
    """Canonical columns by ordered aliases; an absent field is a null column.

    The choice is made at plan time from the header, so the result is a
    plain projection (no per-row work beyond the column reads).
    """
    df = snake_columns(df)
    cols = []
    for canonical, aliases in fields.items():
        match = next((a for a in aliases if a in df.columns), None)
        cols.append((F.col(match) if match else F.lit(None)).cast("string").alias(canonical))
    cols += [F.col(k) for k in keep if k in df.columns]
    return df.select(*cols)


def union_records(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name; columns missing from a frame become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row de-duplication; of equal rows at several places of the files the first place stays."""
    if "row_order" not in df.columns:
        return df.dropDuplicates()
    rest = [c for c in df.columns if c != "row_order"]
    return df.groupBy(*rest).agg(F.min("row_order").alias("row_order")).select(*df.columns)


def _clean_keep_condition(df: DataFrame):
    present = [F.col(c).isNotNull() & (F.col(c) != "") for c in ID_COLUMNS]
    cond = F.col("_date").isNotNull()
    for p in present:
        cond = cond & p
    return cond


def _prepare(df: DataFrame) -> DataFrame:
    """Strip ids and parse the date (columns already in snake_case)."""
    for c in ID_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, strip_ws(c))
    return df.withColumn("_day", date_text("filing_date")).withColumn("_date", parse_date_text("_day")).drop("_day")


def flat_clean(records: DataFrame) -> DataFrame:
    """Full-row de-duplication, id strip, date parse, required fields, text fill.

    The keep condition is a function of each row alone, so Catalyst pushes
    it below the de-duplication (and into the scans): duplicates are
    identical rows and are kept or dropped together, so the result is the
    same as filtering after de-duplication.
    """
    return clean_rows(_distinct_rows(snake_columns(records)))


def clean_rows(df: DataFrame) -> DataFrame:
    """The part of ``flat_clean`` that judges each row alone (columns already in snake_case)."""
    df = _prepare(df)
    df = df.where(_clean_keep_condition(df))
    for c in TEXT_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, F.coalesce(F.nullif(strip_ws(c), F.lit("")), F.lit(UNKNOWN)))
    base = [c for c in df.columns if c not in ("_date",)]
    return df.select(*[F.date_format("_date", "yyyy-MM-dd").alias(c) if c == "filing_date" else F.col(c)
                       for c in base], F.year("_date").cast("int").alias("year"))


def flat_clean_observed(records: DataFrame):
    """``flat_clean`` plus an Observation filled in by the first action on it.

    The stage statistics (input rows, rows after de-duplication, output
    rows) are gathered while the cleaned data is written, with no extra pass
    over the input.  Returns ``(cleaned_frame, observation)``; read
    ``observation.get`` after the write.
    """
    from pyspark.sql import Observation
    obs_in, obs_dd, obs_out = (Observation("flat_input"), Observation("flat_dedup"),
                               Observation("flat_output"))
    snake = snake_columns(records).observe(obs_in, F.count(F.lit(1)).alias("rows"))
    dedup = _distinct_rows(snake).observe(obs_dd, F.count(F.lit(1)).alias("rows"))
    out = clean_rows(dedup)
    out = out.observe(obs_out, F.count(F.lit(1)).alias("rows"))

    class _Metrics:
        @property
        def get(self) -> dict:
            n_in, n_dd, n_out = obs_in.get["rows"], obs_dd.get["rows"], obs_out.get["rows"]
            return {"input_rows": n_in, "duplicates_removed": n_in - n_dd,
                    "rows_dropped": n_dd - n_out, "cleaned_rows": n_out}

    return out, _Metrics()


def clean_metrics(records: DataFrame) -> DataFrame:
    """Stage statistics as one row: input, duplicates removed, dropped, output.

    One shuffle: group identical raw rows (count the copies and evaluate the
    keep condition once per distinct row), then sum over the groups.  Texts
    that the keep condition does not read are grouped by their 256-bit hash,
    so no text is shuffled.
    """
    snake = snake_columns(records)
    snake = snake.select(*[F.sha2(c, 256).alias(c) if c in TEXT_COLUMNS and c not in REQUIRED else F.col(c) for c in snake.columns])
    groups = snake.groupBy(*snake.columns).agg(F.count(F.lit(1)).alias("_copies"))
    flagged = _prepare(groups)
    flagged = flagged.withColumn("_keep", _clean_keep_condition(flagged).cast("long"))
    row = flagged.agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("input_rows"),
                      F.count(F.lit(1)).alias("_dedup"),
                      F.coalesce(F.sum("_keep"), F.lit(0)).alias("cleaned_rows"))
    return row.select(
        "input_rows",
        (F.col("input_rows") - F.col("_dedup")).alias("duplicates_removed"),
        (F.col("_dedup") - F.col("cleaned_rows")).alias("rows_dropped"),
        "cleaned_rows")


def _first(clean: DataFrame, key: str, repeated: bool = True, **columns: str) -> DataFrame:
    """One row per key with the named columns: the first by ``row_order`` if the rows have one, else by their columns."""
    own = [F.col(source).alias(name) for name, source in columns.items()]
    if "row_order" not in clean.columns:
        return keep_first(clean.select(*own), [key], repeated=repeated)
    return keep_first(clean.select(*own, "row_order"), [key], order=["row_order"], repeated=repeated).drop("row_order")


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def flat_patents(clean: DataFrame) -> DataFrame:
    # A patent has few rows, and they hold its texts: these are shuffled once.
    return _first(clean, "patent_id", repeated=False, **_same("patent_id", "title", "abstract", "filing_date", "year", "classification"))


def flat_inventors(clean: DataFrame) -> DataFrame:
    return _first(clean, "inventor_id", **_same("inventor_id", "name", "country"))


def flat_companies(clean: DataFrame) -> DataFrame:
    return _first(clean, "company_id", company_id="assignee_id", name="company_name")


def flat_relationships(clean: DataFrame) -> DataFrame:
    return clean.select("patent_id", "inventor_id",
                        F.col("assignee_id").alias("company_id")).distinct()


def split_tables(clean: DataFrame) -> dict[str, DataFrame]:
    return {"patents": flat_patents(clean), "inventors": flat_inventors(clean),
            "companies": flat_companies(clean), "relationships": flat_relationships(clean)}
