"""Company-name enrichment: id -> organisation maps and the name update.

Both maps pick one name per id: ``uuid_name_map`` the first and
``name_map_last`` the last row.  Inputs that carry ``row_order`` (the place of
the row in its files, see ``read_delimited``) are taken in file order, others by
(patent_id, assignee_sequence, organization).  Each pick is an algebraic
min/max of a struct, so a hot id is pre-reduced on every map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlens.functions.text import strip_ws
from recordlens.operators.staging import stage_assignees
from recordlens.plans.keep_one import keep_first

NAME_ORDER = ["patent_id", "assignee_sequence", "organization"]


def name_columns(columns: list[str]) -> tuple[str, str]:
    """(id column, name column) of a names file, whose headers vary between releases.

    The id is ``assignee_id`` or any column that contains
    ``disambig_assignee_id``; the name is ``disambig_assignee_organization``,
    else a column that contains ``organization``, else ``assignee_name``.
    """
    def pick(*tests):
        return next((c for test in tests for c in columns if test(c)), None)

    found = (pick(lambda c: c == "assignee_id" or "disambig_assignee_id" in c),
             pick(lambda c: c == "disambig_assignee_organization", lambda c: "organization" in c, lambda c: "assignee_name" in c))
    if None in found:
        raise ValueError(f"no id and name columns among {columns}")
    return found


def named_rows(names_raw: DataFrame) -> DataFrame:
    """(patent_id, assignee_sequence, assignee_id, organization) of the rows with a name."""
    key, name = name_columns(names_raw.columns)
    org = F.col(name)
    link = [F.col(c) if c in names_raw.columns else F.lit(None).cast("string").alias(c) for c in ("patent_id", "assignee_sequence")]
    link += [F.col("row_order")] if "row_order" in names_raw.columns else []
    return names_raw.where(org.isNotNull() & (strip_ws(org) != "")).select(
        *link, F.col(key).alias("assignee_id"), org.alias("organization"))


def uuid_name_map(persistent_raw: DataFrame, names_raw: DataFrame, latest: bool = False) -> DataFrame:
    """company uuid -> organisation, linked through (patent_id, assignee_sequence).

    The uuid of a persistent row is its leftmost non-blank dated id
    (``latest`` = rightmost).  Ordered by (patent_id, assignee_sequence,
    organization), the first joined row of a uuid sits at its smallest key
    with that key's smallest organisation; so the name side is reduced to
    MIN(organization) per key before the join.  The join is then
    many-to-one: no pair explosion even when a key repeats on both sides.
    In file order the first joined row is the first persistent row that has a
    name, with the first name of its key.
    """
    extra = ("assignee_sequence", "row_order") if "row_order" in persistent_raw.columns else ("assignee_sequence",)
    return name_map_from_links(stage_assignees(persistent_raw, latest=latest, extra_keys=extra), named_rows(names_raw))


def name_map_from_links(assignee_links: DataFrame, name_links: DataFrame) -> DataFrame:
    """``uuid_name_map`` over staged links (see there)."""
    if "row_order" in assignee_links.columns and "row_order" in name_links.columns:
        return _first_names_in_files(assignee_links, name_links)
    uuids = (assignee_links.where(F.col("assignee_sequence").isNotNull())
             .select("patent_id", "assignee_sequence", F.col("company_id").alias("uuid"))
             .distinct())
    orgs = (name_links.groupBy("patent_id", "assignee_sequence")
            .agg(F.min("organization").alias("organization")))
    linked = uuids.join(orgs, ["patent_id", "assignee_sequence"])
    first = keep_first(linked.select("uuid", *NAME_ORDER), ["uuid"], order=NAME_ORDER)
    return first.select("uuid", F.col("organization").alias("name"))


def _first_names_in_files(assignee_links: DataFrame, name_links: DataFrame) -> DataFrame:
    """(uuid, name) where the first row in file order wins on both sides."""
    key = ["patent_id", "assignee_sequence"]
    # Rows without a patent id or sequence match each other, as missing keys do where the rule comes from.
    orgs = name_links.groupBy(*key).agg(F.min_by("organization", "row_order").alias("name")).select(
        *[F.col(c).alias(f"_{c}") for c in key], "name")
    first = assignee_links.groupBy(F.col("company_id").alias("uuid"), *key).agg(F.min("row_order").alias("at"))
    same = F.col("patent_id").eqNullSafe(F.col("_patent_id")) & F.col("assignee_sequence").eqNullSafe(F.col("_assignee_sequence"))
    return first.join(orgs, same).groupBy("uuid").agg(F.min_by("name", "at").alias("name"))


def name_map_last(names_raw: DataFrame, order: list[str] | None = None) -> DataFrame:
    """assignee_id -> organisation where the last row (by ``order``) wins."""
    rows = named_rows(names_raw).where(F.col("assignee_id").isNotNull())
    if order is None and "row_order" in rows.columns:
        return rows.groupBy("assignee_id").agg(F.max_by("organization", "row_order").alias("name"))
    order = order or NAME_ORDER
    last = keep_first(rows.select("assignee_id", *order), ["assignee_id"], order=order, last=True)
    return last.select("assignee_id", F.col("organization").alias("name"))


def enrich_company_names(companies: DataFrame, name_map: DataFrame,
                         map_key: str = "uuid") -> DataFrame:
    """Replace a company's name by the mapped one where the id is known.

    A left join on the id; the map is one row per id, so AQE broadcasts it
    when its measured size allows, else sort-merges.
    """
    m = name_map.select(F.col(map_key).alias("_mid"), F.col("name").alias("_mname"))
    j = companies.join(m, companies.company_id == m._mid, "left")
    return j.select("company_id", F.coalesce("_mname", "name").alias("name"),
                    F.col("name").alias("previous_name"))


def enrich_metrics(enriched: DataFrame) -> DataFrame:
    """One row: companies seen and names changed."""
    changed = ~F.col("name").eqNullSafe(F.col("previous_name"))
    return enriched.agg(F.count(F.lit(1)).alias("companies"),
                        F.count(F.when(changed, 1)).alias("names_changed"))
