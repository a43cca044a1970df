"""Equivalent SQL for every registered query, runnable by an independent engine.

Each query is written from its meaning, with relational operators of its own
choice (distinct pairs, semi-joins, window picks).  It shares with the Spark side
only the two fixed country tables.  The fixture views
are inlined as leading CTEs, in dependency order.  Portable rules: ``||``
instead of CONCAT, explicit NULLS FIRST on ascending keys, counts BIGINT,
ranks and years INTEGER, shares DOUBLE.
"""

from __future__ import annotations

from recordlens.functions.country import ISO2_VARIANTS, ISO3_VARIANTS


def _odd(key: str, date: str) -> str:
    day = f"strftime({date}, '%Y-%m-%d')"
    return (f"CASE WHEN {key} % 43 = 0 THEN {day} || 'garbage' WHEN {key} % 47 = 0 THEN {day} || 'T08:30:00'"
            f" WHEN {key} % 53 = 0 THEN {day} || 'T99' WHEN {key} % 59 = 0 THEN {day} || ' 23:15' ELSE {day} END")


VIEWS: dict[str, str] = {
    "raw_country": """SELECT * FROM (VALUES (0,'US'),(1,'usa '),(2,'United States'),(3,'JP'),(4,'Japan'),
 (5,'DE'),(6,'Deutschland'),(7,'GB'),(8,'UK'),(9,'FR'),(10,'KR'),(11,'South Korea'),(12,'CN'),(13,'TW'),
 (14,'Hong Kong'),(15,'NL'),(16,'Holland'),(17,'Finland'),(18,'Austria'),(19,'U.S.A.'),(20,''),
 (21,CAST(NULL AS VARCHAR)),(22,'JPX'),(23,'1X'),(24,'NA')) AS t(nk, raw)""",
    "patents_raw": f"""SELECT CAST(l_orderkey AS VARCHAR) AS patent_id,
 {_odd('l_orderkey', 'l_shipdate')} AS patent_date, p_name AS title,
 CASE l_returnflag WHEN 'A' THEN 'B1' WHEN 'N' THEN 'B2' ELSE '' END AS wipo_kind,
 CASE l_linestatus WHEN 'O' THEN 'utility' ELSE 'design' END AS patent_type
 FROM lineitem JOIN part ON p_partkey = l_partkey""",
    "abstracts_raw": "SELECT CAST(doc_id AS VARCHAR) AS patent_id, text AS abstract FROM documents",
    "inventors_raw": """SELECT CAST(o_orderkey AS VARCHAR) AS patent_id, CAST(c_custkey AS VARCHAR) AS inventor_id,
 CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Customer' END AS disambig_inventor_name_first,
 CASE WHEN c_custkey % 13 = 0 THEN '' ELSE SUBSTRING(c_name,10,9) END AS disambig_inventor_name_last,
 'loc-' || CAST(c_nationkey AS VARCHAR) AS location_id
 FROM orders JOIN customer ON c_custkey = o_custkey""",
    "locations_raw": """SELECT 'loc-' || CAST(n_nationkey AS VARCHAR) AS location_id,
 CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE 'C' || CAST(n_nationkey AS VARCHAR) END AS disambig_country
 FROM nation""",
    "locations_nd_raw": "SELECT 'loc-' || CAST(nk AS VARCHAR) AS location_id, raw AS raw_country FROM raw_country",
    "persistent_assignee_raw": """SELECT CAST(l_orderkey AS VARCHAR) AS patent_id,
 CAST(l_linenumber AS VARCHAR) AS assignee_sequence,
 CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'a' || CAST(l_suppkey AS VARCHAR) END AS disamb_assignee_id_20200331,
 CASE WHEN l_suppkey % 2 = 0 THEN NULL ELSE 'b' || CAST(l_suppkey AS VARCHAR) END AS disamb_assignee_id_20210330,
 CASE WHEN l_suppkey % 12 = 0 THEN '' ELSE 'c' || CAST(l_suppkey AS VARCHAR) END AS disamb_assignee_id_20220929
 FROM lineitem""",
    "assignee_names_raw": """SELECT CAST(l_orderkey AS VARCHAR) AS patent_id,
 CAST(l_linenumber AS VARCHAR) AS assignee_sequence, 'a' || CAST(s_suppkey AS VARCHAR) AS assignee_id,
 CASE WHEN s_suppkey % 7 = 0 THEN '  ' ELSE s_name END AS disambig_assignee_organization
 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""",
    "patents": """SELECT CAST(o_orderkey AS VARCHAR) AS patent_id, o_orderpriority || ' ' || o_orderstatus AS title,
 d.text AS abstract, SUBSTRING(CAST(o_orderdate AS VARCHAR),1,10) AS filing_date,
 CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS year,
 CASE o_orderstatus WHEN 'F' THEN 'B1' WHEN 'O' THEN 'B2' ELSE o_orderpriority END AS classification
 FROM orders LEFT JOIN documents d ON d.doc_id = o_orderkey""",
    "inventors": """SELECT CAST(c_custkey AS VARCHAR) AS inventor_id, c_name AS name,
 UPPER(SUBSTRING(NULLIF(TRIM(raw),''),1,2)) AS country
 FROM customer LEFT JOIN raw_country ON nk = c_nationkey""",
    "companies": """SELECT CAST(s_suppkey AS VARCHAR) AS company_id,
 CASE WHEN s_suppkey % 7 = 0 THEN CAST(s_suppkey AS VARCHAR) ELSE s_name END AS name FROM supplier""",
    "relationships": """SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS patent_id, CAST(o_custkey AS VARCHAR) AS inventor_id,
 CAST(l_suppkey AS VARCHAR) AS company_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
    "extracted_records": f"""SELECT CASE WHEN o_orderkey % 10 = 0 THEN ' ' || CAST(o_orderkey AS VARCHAR)
 ELSE CAST(o_orderkey AS VARCHAR) END AS patent_id,
 CASE WHEN o_orderkey % 9 = 0 THEN '  ' ELSE o_orderpriority END AS title, d.text AS abstract,
 CASE WHEN o_orderkey % 17 = 0 THEN 'not-a-date' WHEN o_orderkey % 23 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
  WHEN o_orderkey % 29 = 0 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN o_orderkey % 31 = 0 THEN strftime(o_orderdate, '%Y%m%d')
  WHEN o_orderkey % 37 = 0 THEN strftime(o_orderdate, '%B %-d, %Y') WHEN o_orderkey % 41 = 0 THEN upper(strftime(o_orderdate, '%-d %b %Y'))
  ELSE {_odd('o_orderkey', 'o_orderdate')} END AS filing_date,
 CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS classification,
 CAST(c_custkey AS VARCHAR) AS inventor_id, c_name AS name, raw AS country,
 CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_suppkey AS VARCHAR) END AS assignee_id,
 'Supplier ' || CAST(l_suppkey AS VARCHAR) AS company_name
 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
 LEFT JOIN raw_country ON nk = c_nationkey LEFT JOIN documents d ON d.doc_id = o_orderkey""",
}

VIEWS["location_mentions"] = """SELECT 'loc-' || CAST(c_nationkey AS VARCHAR) AS location_id,
 CASE WHEN c_nationkey % 3 = 0 THEN NULL ELSE 'C' || CAST(c_nationkey AS VARCHAR) END AS disambig_country
 FROM customer"""
VIEWS["raw_location_mentions"] = """SELECT 'loc-' || CAST(c_nationkey AS VARCHAR) AS location_id, raw AS raw_country
 FROM customer LEFT JOIN raw_country ON nk = c_nationkey"""

DEPENDS = {
    "raw_location_mentions": ["raw_country"],
    "locations_nd_raw": ["raw_country"],
    "inventors": ["raw_country"],
    "extracted_records": ["raw_country"],
}


def with_views(body: str, views: list[str], extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the named fixture views (and extra CTEs) as one WITH."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            add(dep)
        if name not in ordered:
            ordered.append(name)

    for v in views:
        add(v)
    ctes = [(n, VIEWS[n]) for n in ordered] + list(extra_ctes or [])
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in ctes) + "\n" + body


SQL: dict[str, str] = {}


def register(key: str, views: list[str], body: str, extra_ctes: list[tuple[str, str]] | None = None):
    SQL[key] = with_views(body, views, extra_ctes)


# -- q1..q7 -------------------------------------------------------------------
# Counts are taken on distinct (entity, patent) pairs; a dimension only filters and labels them.
_INV_COUNTS = """SELECT dim.inventor_id, dim.name, dim.country, SUM(per_id.n)::BIGINT AS patent_count
 FROM (SELECT inventor_id, COUNT(*) AS n FROM (SELECT DISTINCT inventor_id, patent_id FROM relationships WHERE patent_id IS NOT NULL)
       GROUP BY inventor_id) per_id
 JOIN (SELECT DISTINCT inventor_id, name, country FROM inventors) dim USING (inventor_id)
 GROUP BY dim.inventor_id, dim.name, dim.country"""
_CO_COUNTS = """SELECT dim.company_id, dim.name, SUM(per_id.n)::BIGINT AS patent_count
 FROM (SELECT company_id, COUNT(*) AS n FROM (SELECT DISTINCT company_id, patent_id FROM relationships WHERE patent_id IS NOT NULL)
       GROUP BY company_id) per_id
 JOIN (SELECT DISTINCT company_id, name FROM companies) dim USING (company_id)
 GROUP BY dim.company_id, dim.name"""
_COUNTRY_COUNTS = """SELECT country, COUNT(*) AS patent_count
 FROM (SELECT DISTINCT who.country, link.patent_id FROM inventors who, relationships link
       WHERE who.inventor_id = link.inventor_id AND link.patent_id IS NOT NULL{known}) GROUP BY country"""
_KNOWN = " AND who.country <> ''"

register("q1_top_inventors", ["relationships", "inventors"],
         f"SELECT * FROM ({_INV_COUNTS}) ORDER BY patent_count DESC, name NULLS FIRST")
register("q2_top_companies", ["relationships", "companies"],
         f"SELECT * FROM ({_CO_COUNTS}) ORDER BY patent_count DESC, name NULLS FIRST")
register("q3_top_countries", ["relationships", "inventors"],
         f"SELECT * FROM ({_COUNTRY_COUNTS.format(known='')}) ORDER BY patent_count DESC, country NULLS FIRST")
register("q4_patents_per_year", ["patents"],
         "SELECT year, SUM(1)::BIGINT AS patent_count FROM patents GROUP BY ALL ORDER BY year NULLS FIRST")
register("q5_patent_inventor_company_join", ["relationships", "patents", "inventors", "companies"],
         """SELECT link.patent_id, doc.title, doc.year, link.inventor_id, who.name AS inventor_name, who.country,
 link.company_id, org.name AS company_name
 FROM companies org, inventors who, patents doc, relationships link
 WHERE org.company_id = link.company_id AND who.inventor_id = link.inventor_id AND doc.patent_id = link.patent_id
 ORDER BY doc.year DESC NULLS LAST, link.patent_id""")
_SHARE = """SELECT country, patent_count, ROUND(100 * (CAST(patent_count AS DOUBLE)
   / (SELECT COUNT(DISTINCT patent_id) FROM relationships)), 2) AS {share}
 FROM ({counts}) ORDER BY patent_count DESC, country NULLS FIRST"""
register("q6_country_share_cte", ["relationships", "inventors"],
         _SHARE.format(counts=_COUNTRY_COUNTS.format(known=""), share="patent_share_pct"))
register("q7_inventor_ranking", ["relationships", "inventors"],
         f"""WITH counted AS ({_INV_COUNTS}),
 places AS (SELECT patent_count, name, CAST(ROW_NUMBER() OVER (ORDER BY patent_count DESC, name NULLS FIRST) AS INTEGER) AS inventor_rank
            FROM (SELECT DISTINCT patent_count, name FROM counted))
 SELECT c.inventor_id, c.name, c.country, c.patent_count, p.inventor_rank
 FROM counted c JOIN places p ON p.patent_count = c.patent_count AND p.name IS NOT DISTINCT FROM c.name
 ORDER BY p.inventor_rank, c.name NULLS FIRST""".replace("WITH counted AS", "SELECT * FROM (WITH counted AS", 1) + ")")

# -- the same results by other ways: from pairs, from sets of patent numbers, from batches
for _key, _same in {"factorised_top_inventors": "q1_top_inventors", "factorised_top_companies": "q2_top_companies",
                    "factorised_top_countries": "q3_top_countries", "factorised_country_share": "q6_country_share_cte",
                    "factorised_inventor_ranking": "q7_inventor_ranking", "bitmap_top_inventors": "q1_top_inventors",
                    "bitmap_top_countries": "q3_top_countries", "standing_top_inventors": "q1_top_inventors",
                    "standing_top_companies": "q2_top_companies", "standing_country_share": "q6_country_share_cte",
                    "standing_patents_per_year": "q4_patents_per_year"}.items():
    SQL[_key] = SQL[_same]
register("factorised_link_counts", ["relationships"],
         "SELECT COUNT(DISTINCT patent_id) AS linked_patents, COUNT(*) AS relationships FROM relationships")

# -- dashboard variants ---------------------------------------------------------
register("dash_top_inventors", ["relationships", "inventors"],
         _INV_COUNTS + " ORDER BY patent_count DESC, dim.inventor_id LIMIT 20")
register("dash_top_companies", ["relationships", "companies"],
         _CO_COUNTS + " ORDER BY patent_count DESC, dim.company_id LIMIT 20")
register("dash_top_countries", ["relationships", "inventors"],
         _COUNTRY_COUNTS.format(known=_KNOWN) + " ORDER BY patent_count DESC, country LIMIT 20")
register("dash_country_share", ["relationships", "inventors"],
         _SHARE.format(counts=_COUNTRY_COUNTS.format(known=_KNOWN), share="share_pct"))
register("dash_classification", ["patents"],
         """SELECT classification,
 CASE classification WHEN 'B1' THEN 'Granted (no prior publication)'
                     WHEN 'B2' THEN 'Granted (prior publication)' END AS label,
 COUNT(*) AS count FROM patents WHERE classification IS NOT NULL
 GROUP BY classification ORDER BY count DESC""")
register("class_by_year", ["patents"],
         """SELECT year, classification, COUNT(*) AS count FROM patents
 WHERE classification IS NOT NULL GROUP BY year, classification ORDER BY year, classification""")
register("dash_join", ["relationships", "patents", "inventors", "companies"],
         """SELECT p.patent_id, p.title, p.year, p.classification, i.name AS inventor_name, i.country,
 c.name AS company_name
 FROM relationships r JOIN patents p ON p.patent_id = r.patent_id
 JOIN inventors i ON i.inventor_id = r.inventor_id JOIN companies c ON c.company_id = r.company_id
 ORDER BY p.year DESC, p.patent_id""")
register("inventors_by_country", ["inventors"],
         """SELECT country, COUNT(*) AS inventor_count FROM inventors GROUP BY country
 ORDER BY inventor_count DESC, country ASC NULLS FIRST LIMIT 30""")

# -- raw files in file order --------------------------------------------------------
_FILE_NAMES = """SELECT CAST(l_orderkey AS VARCHAR) AS patent_id, CAST(l_linenumber AS VARCHAR) AS assignee_sequence,
 'a' || CAST(l_suppkey AS VARCHAR) AS assignee_id,
 s_name || ' "' || CAST(l_partkey AS VARCHAR) || '"' || chr(10) || CAST(l_orderkey AS VARCHAR) AS organization,
 ROW_NUMBER() OVER (ORDER BY l_partkey, l_orderkey, l_linenumber, l_suppkey) AS place
 FROM lineitem JOIN supplier ON s_suppkey = l_suppkey WHERE l_partkey % 7 <> 0"""
_FILE_IDS = """SELECT CAST(l_orderkey AS VARCHAR) AS patent_id, CAST(l_linenumber AS VARCHAR) AS assignee_sequence,
 CASE WHEN l_suppkey % 3 = 0 THEN 'b' ELSE 'a' END || CAST(l_suppkey AS VARCHAR) AS uuid,
 ROW_NUMBER() OVER (ORDER BY -l_partkey, l_orderkey, l_linenumber, l_suppkey) AS place FROM lineitem"""
register("quoted_text_ranges", ["abstracts_raw"], "SELECT patent_id, NULLIF(abstract, '') AS abstract FROM abstracts_raw WHERE patent_id IS NOT NULL")
register("name_map_file_last", [], f"""SELECT assignee_id, organization AS name FROM ({_FILE_NAMES})
 QUALIFY ROW_NUMBER() OVER (PARTITION BY assignee_id ORDER BY place DESC) = 1""")
register("uuid_map_file_first", [], f"""SELECT uuid, organization AS name
 FROM ({_FILE_IDS}) ids JOIN ({_FILE_NAMES}) names USING (patent_id, assignee_sequence)
 QUALIFY ROW_NUMBER() OVER (PARTITION BY uuid ORDER BY ids.place, names.place) = 1""")

# -- country normalisers in SQL ---------------------------------------------------


def _values_cte(name: str, codes: dict[str, str]) -> tuple[str, str]:
    rows = ",".join(f"('{variant}','{code}')" for variant, code in codes.items())
    return name, f"SELECT * FROM (VALUES {rows}) AS t(variant, code)"


ISO2_CTE = _values_cte("iso2_map", ISO2_VARIANTS)
ISO3_CTE = _values_cte("iso3_map", ISO3_VARIANTS)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_iso2(x: str) -> str:
    v = f"NULLIF(UPPER({sql_strip(x)}), '')"
    return (f"(CASE WHEN {v} IS NULL THEN NULL ELSE COALESCE((SELECT code FROM iso2_map WHERE variant = {v}),"
            f" CASE WHEN regexp_full_match(SUBSTRING({v},1,2), '\\p{{L}}{{2}}') THEN SUBSTRING({v},1,2) END) END)")


def sql_iso3(x: str) -> str:
    v = f"NULLIF(UPPER({sql_strip(x)}), '')"
    return (f"(CASE WHEN {v} IS NULL THEN NULL ELSE COALESCE((SELECT code FROM iso3_map WHERE variant = {v}),"
            f" CASE WHEN regexp_full_match({v}, '\\p{{L}}{{3}}') THEN {v} END) END)")


# -- staging ----------------------------------------------------------------------
STG = {
    "stg_patents": ("SELECT patent_id, patent_date, title, wipo_kind, patent_type FROM patents_raw "
                    "WHERE patent_id IS NOT NULL"),
    "stg_abstracts": "SELECT patent_id, abstract FROM abstracts_raw WHERE patent_id IS NOT NULL",
    "stg_inventors": ("SELECT patent_id, inventor_id, disambig_inventor_name_first, disambig_inventor_name_last,"
                      " location_id FROM inventors_raw WHERE patent_id IS NOT NULL AND inventor_id IS NOT NULL"),
    "stg_locations": "SELECT location_id, disambig_country FROM location_mentions WHERE location_id IS NOT NULL",
    "stg_raw_locations": (f"SELECT * FROM (SELECT location_id, {sql_iso2('raw_country')} AS country "
                          "FROM raw_location_mentions) WHERE location_id IS NOT NULL AND country IS NOT NULL"),
    "stg_assignees": ("SELECT * FROM (SELECT patent_id, COALESCE(NULLIF(disamb_assignee_id_20200331,''),"
                      " NULLIF(disamb_assignee_id_20210330,''), NULLIF(disamb_assignee_id_20220929,'')) AS company_id"
                      " FROM persistent_assignee_raw) WHERE patent_id IS NOT NULL AND company_id IS NOT NULL"),
    "stg_assignee_names": ("SELECT assignee_id, disambig_assignee_organization AS organization FROM assignee_names_raw"
                           " WHERE assignee_id IS NOT NULL AND disambig_assignee_organization IS NOT NULL AND "
                           + sql_strip("disambig_assignee_organization") + " <> ''"),
}
STG_VIEWS = {"stg_patents": ["patents_raw"], "stg_abstracts": ["abstracts_raw"],
             "stg_inventors": ["inventors_raw"], "stg_locations": ["location_mentions"],
             "stg_raw_locations": ["raw_location_mentions"], "stg_assignees": ["persistent_assignee_raw"],
             "stg_assignee_names": ["assignee_names_raw"]}


def register_staged(key: str, stages: list[str], body: str, extra: list[tuple[str, str]] | None = None):
    views = [v for s in stages for v in STG_VIEWS[s]]
    ctes = list(extra or [])
    if "stg_raw_locations" in stages:
        ctes.append(ISO2_CTE)
    ctes += [(s, STG[s]) for s in stages]
    register(key, views, body, ctes)


register("stage_patents", ["patents_raw"], STG["stg_patents"])
register("stage_abstracts", ["abstracts_raw"], STG["stg_abstracts"])
register("stage_inventors", ["inventors_raw"], STG["stg_inventors"])
register("stage_locations", ["location_mentions"],
         "SELECT location_id, disambig_country FROM location_mentions WHERE location_id IS NOT NULL")
register("stage_raw_locations", ["raw_location_mentions"],
         f"SELECT * FROM (SELECT location_id, {sql_iso2('raw_country')} AS country FROM raw_location_mentions)"
         " WHERE location_id IS NOT NULL AND country IS NOT NULL", [ISO2_CTE])
register("stage_assignees", ["persistent_assignee_raw"], STG["stg_assignees"])
register("stage_assignee_names", ["assignee_names_raw"], STG["stg_assignee_names"])
register("country_iso2", ["extracted_records"],
         f"SELECT country AS raw_country, {sql_iso2('country')} AS country_iso2, COUNT(*) AS n"
         " FROM extracted_records GROUP BY 1, 2", [ISO2_CTE])

# -- clean tables ---------------------------------------------------------------
# Each column's largest value is picked on its own; joins see one row per key.
_VALID_DAY = "^([0-9]{4}-[0-9]{2}-[0-9]{2})([ T]([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?)?$"
register_staged("clean_patents", ["stg_patents", "stg_abstracts"], f"""SELECT one.*,
 CAST(YEAR(TRY_STRPTIME(regexp_extract(one.filing_date, '{_VALID_DAY}', 1), '%Y-%m-%d')) AS INTEGER) AS year, texts.abstract
 FROM (SELECT patent_id, MAX(title) AS title, MAX(patent_date) AS filing_date,
         MAX(CASE WHEN wipo_kind <> '' THEN wipo_kind WHEN patent_type <> '' THEN patent_type END) AS classification
       FROM stg_patents WHERE length(patent_id) > 0 GROUP BY ALL) one
 LEFT JOIN (SELECT patent_id, MAX(abstract) AS abstract FROM stg_abstracts GROUP BY ALL) texts USING (patent_id)""")
register_staged("clean_inventors", ["stg_inventors", "stg_locations", "stg_raw_locations"], """SELECT inventor_id, MAX(shown) AS name,
 MAX(place.country) AS country
 FROM (SELECT DISTINCT inventor_id, location_id, CASE WHEN full_name <> '' THEN full_name ELSE inventor_id END AS shown
       FROM (SELECT *, TRIM(COALESCE(disambig_inventor_name_first, '') || ' ' || COALESCE(disambig_inventor_name_last, '')) AS full_name
             FROM stg_inventors) WHERE inventor_id <> '') person
 LEFT JOIN (SELECT location_id, CASE WHEN known.c IS NOT NULL THEN known.c ELSE written.c END AS country
            FROM (SELECT DISTINCT location_id, disambig_country AS c FROM stg_locations) known
            FULL JOIN (SELECT DISTINCT location_id, country AS c FROM stg_raw_locations) written USING (location_id)) place USING (location_id)
 GROUP BY inventor_id""")
_NAMED_IDS = """SELECT owner.company_id, CASE WHEN label <> '' THEN label ELSE owner.company_id END AS name
 FROM (SELECT DISTINCT company_id FROM stg_assignees WHERE company_id <> '') owner
 LEFT JOIN (SELECT DISTINCT assignee_id AS company_id, TRIM(organization) AS label FROM stg_assignee_names) org USING (company_id)"""
register_staged("clean_companies", ["stg_assignees", "stg_assignee_names"], f"SELECT DISTINCT * FROM ({_NAMED_IDS})")
register_staged("clean_relationships", ["stg_inventors", "stg_assignees"], """SELECT * FROM
 (SELECT DISTINCT patent_id, inventor_id FROM stg_inventors) JOIN (SELECT DISTINCT patent_id, company_id FROM stg_assignees) USING (patent_id)""")
register_staged("companies_table", ["stg_assignees", "stg_assignee_names"],
                f"SELECT company_id, MIN(name) AS name FROM ({_NAMED_IDS}) GROUP BY ALL")

# -- flat path --------------------------------------------------------------------
_S = sql_strip
_CLOCK = "([01][0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?"
_DAY = f"regexp_replace({_S('filing_date')}, '[ T]{_CLOCK}$', '')"
_FLAT_DATE = (f"CAST(TRY_STRPTIME({_DAY}, ['%Y-%m-%d', '%m/%d/%Y', '%Y/%m/%d', '%Y%m%d', '%B %d, %Y', '%b %d, %Y',"
              " '%d %B %Y', '%d %b %Y', '%d-%b-%Y']) AS DATE)")


def _unk(c: str) -> str:
    return f"COALESCE(NULLIF({_S(c)}, ''), 'Unknown') AS {c}"


FLAT_CLEAN_CTE = ("flat_clean", f"""SELECT patent_id, {_unk('title')}, {_unk('abstract')},
 strftime(d, '%Y-%m-%d') AS filing_date, {_unk('classification')}, inventor_id, {_unk('name')}, {_unk('country')},
 assignee_id, {_unk('company_name')}, CAST(YEAR(d) AS INTEGER) AS year
 FROM (SELECT {_S('patent_id')} AS patent_id, title, abstract, classification, {_S('inventor_id')} AS inventor_id,
   name, country, {_S('assignee_id')} AS assignee_id, company_name, {_FLAT_DATE} AS d
   FROM (SELECT DISTINCT * FROM extracted_records))
 WHERE patent_id IS NOT NULL AND patent_id <> '' AND inventor_id IS NOT NULL AND inventor_id <> ''
   AND assignee_id IS NOT NULL AND assignee_id <> '' AND d IS NOT NULL""")

register("map_columns", ["extracted_records"], """SELECT patent_id, title, CAST(NULL AS VARCHAR) AS abstract,
 filing_date, classification, inventor_id, name, country, assignee_id, company_name FROM extracted_records""")
register("union_records", ["extracted_records"], """SELECT *, 'records.csv' AS source_file FROM extracted_records
 UNION ALL SELECT patent_id, title, CAST(NULL AS VARCHAR) AS abstract, filing_date, classification, inventor_id,
 name, country, assignee_id, company_name, 'records_alias.tsv' AS source_file FROM extracted_records""")
register("flat_clean", ["extracted_records"], "SELECT * FROM flat_clean", [FLAT_CLEAN_CTE])
register("clean_metrics", ["extracted_records"], """SELECT n_in AS input_rows, n_in - n_dd AS duplicates_removed,
 n_dd - n_out AS rows_dropped, n_out AS cleaned_rows FROM
 (SELECT (SELECT COUNT(*) FROM extracted_records) AS n_in,
         (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM extracted_records)) AS n_dd,
         (SELECT COUNT(*) FROM flat_clean) AS n_out)""", [FLAT_CLEAN_CTE])


def _first_sql(cols: list[str], key: str, src: str) -> str:
    rest = [c for c in cols if c != key]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return (f"SELECT {', '.join(cols)} FROM (SELECT {', '.join(cols)}, ROW_NUMBER() OVER "
            f"(PARTITION BY {key} ORDER BY {order}) AS rn FROM {src}) WHERE rn = 1")


register("flat_patents", ["extracted_records"],
         _first_sql(["patent_id", "title", "abstract", "filing_date", "year", "classification"],
                    "patent_id", "flat_clean"), [FLAT_CLEAN_CTE])
register("flat_inventors", ["extracted_records"],
         _first_sql(["inventor_id", "name", "country"], "inventor_id", "flat_clean"), [FLAT_CLEAN_CTE])
register("flat_companies", ["extracted_records"],
         _first_sql(["company_id", "name"], "company_id",
                    "(SELECT assignee_id AS company_id, company_name AS name FROM flat_clean)"), [FLAT_CLEAN_CTE])
register("flat_relationships", ["extracted_records"],
         "SELECT DISTINCT patent_id, inventor_id, assignee_id AS company_id FROM flat_clean", [FLAT_CLEAN_CTE])

# -- frames reused by the statistics --------------------------------------------------
TOP_COMPANIES = ("top_companies", _CO_COUNTS + " ORDER BY patent_count DESC, dim.company_id LIMIT 20")
TOP_INVENTORS = ("top_inventors", _INV_COUNTS + " ORDER BY patent_count DESC, dim.inventor_id LIMIT 20")
INV_COUNTS = ("inv_counts", _INV_COUNTS)
COUNTRY_SHARE_KNOWN = ("country_share_known", _SHARE.format(counts=_COUNTRY_COUNTS.format(known=_KNOWN), share="share_pct"))
COUNTRY_SHARE_ALL = ("country_share_all", _SHARE.format(counts=_COUNTRY_COUNTS.format(known=""), share="patent_share_pct"))
PER_YEAR = ("per_year", "SELECT year, COUNT(*) AS patent_count FROM patents GROUP BY year")
_RI = ["relationships", "inventors"]
_RC = ["relationships", "companies"]


def _pareto(frame: str, cols: list[str], value: str, label: str, tiebreak: list[str]) -> str:
    order = ", ".join([f"{value} DESC NULLS LAST", f"{label} ASC NULLS FIRST"] + [f"{c} ASC NULLS FIRST" for c in tiebreak])
    col_list = ", ".join(cols)
    return f"""SELECT {col_list}, share_pct,
 CASE WHEN total > 0 THEN round_even(SUM(share_pct) OVER (ORDER BY {order}
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) ELSE 0.0 END AS cum_share_pct,
 CAST(ROW_NUMBER() OVER (ORDER BY {order}) AS INTEGER) AS rank
 FROM (SELECT {col_list}, t.total,
   CASE WHEN t.total > 0 THEN round_even({value} / t.total * 100, 2) ELSE 0.0 END AS share_pct
   FROM {frame} CROSS JOIN (SELECT CAST(SUM({value}) AS DOUBLE) AS total FROM {frame}) t)"""


register("pareto_companies", _RC, _pareto("top_companies", ["company_id", "name", "patent_count"],
                                          "patent_count", "name", ["company_id"]), [TOP_COMPANIES])
register("pareto_inventors", _RI, _pareto("top_inventors", ["inventor_id", "name", "country", "patent_count"],
                                          "patent_count", "name", ["inventor_id"]), [TOP_INVENTORS])
register("pareto_countries", _RI, _pareto("country_share_known", ["country", "patent_count"],
                                          "patent_count", "country", []), [COUNTRY_SHARE_KNOWN])
register("pareto_inventors_all", _RI, _pareto("inv_counts", ["inventor_id", "name", "country", "patent_count"],
                                              "patent_count", "name", ["inventor_id"]), [INV_COUNTS])


def _concentration(frame: str, value: str) -> str:
    pct = "CASE WHEN total > 0 THEN round_even(top{k} / total * 100, 2) ELSE 0.0 END AS top{k}_pct"
    return f"""SELECT CASE WHEN total > 0 THEN total ELSE 0.0 END AS total,
 {pct.format(k=1)}, {pct.format(k=3)}, {pct.format(k=5)},
 CASE WHEN total > 0 THEN round_even(COALESCE(hhi, 0.0), 4) ELSE 0.0 END AS hhi,
 CASE WHEN total > 0 THEN round_even(COALESCE(ent, 0.0), 3) ELSE 0.0 END AS entropy
 FROM (SELECT t.total,
   (SELECT COALESCE(SUM(v), 0.0) FROM (SELECT v FROM vals ORDER BY v DESC LIMIT 1)) AS top1,
   (SELECT COALESCE(SUM(v), 0.0) FROM (SELECT v FROM vals ORDER BY v DESC LIMIT 3)) AS top3,
   (SELECT COALESCE(SUM(v), 0.0) FROM (SELECT v FROM vals ORDER BY v DESC LIMIT 5)) AS top5,
   (SELECT SUM((v / t.total) * (v / t.total)) FROM vals WHERE t.total > 0) AS hhi,
   (SELECT SUM(-(v / t.total) * log2(v / t.total)) FROM vals WHERE t.total > 0 AND v > 0) AS ent
   FROM (SELECT COALESCE(SUM(v), 0.0) AS total FROM vals) t)"""


def _vals(frame: str, value: str) -> tuple[str, str]:
    return "vals", f"SELECT CAST(COALESCE({value}, 0) AS DOUBLE) AS v FROM {frame}"


register("concentration_companies", _RC, _concentration("top_companies", "patent_count"),
         [TOP_COMPANIES, _vals("top_companies", "patent_count")])
register("concentration_inventors", _RI, _concentration("top_inventors", "patent_count"),
         [TOP_INVENTORS, _vals("top_inventors", "patent_count")])
register("concentration_countries", _RI, _concentration("country_share_known", "patent_count"),
         [COUNTRY_SHARE_KNOWN, _vals("country_share_known", "patent_count")])
register("concentration_inventors_all", _RI, _concentration("inv_counts", "patent_count"),
         [INV_COUNTS, _vals("inv_counts", "patent_count")])

register("trend_rolling", ["patents"], """SELECT year, patent_count,
 AVG(patent_count) OVER (ORDER BY year ASC NULLS LAST ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3yr
 FROM per_year""", [PER_YEAR])
register("trend_yoy", ["patents"], """SELECT year AS latest_year, patent_count AS latest_count,
 prev AS previous_count,
 CASE WHEN prev > 0 THEN round_even((patent_count - CAST(prev AS DOUBLE)) / CAST(prev AS DOUBLE) * 100, 2) END AS yoy_pct
 FROM (SELECT year, patent_count, LAG(patent_count) OVER (ORDER BY year ASC NULLS LAST) AS prev,
   ROW_NUMBER() OVER (ORDER BY year DESC NULLS FIRST) AS rn FROM per_year) WHERE rn = 1""", [PER_YEAR])
register("trend_series", ["patents"],
         "SELECT CAST(year AS INTEGER) AS year, patent_count FROM per_year WHERE year IS NOT NULL ORDER BY year",
         [PER_YEAR])
register("country_histogram", _RI, """SELECT bin, lo + bin * (hi - lo) / bins AS bin_start,
 lo + (bin + 1) * (hi - lo) / bins AS bin_end, COUNT(*) AS count
 FROM (SELECT CASE WHEN hi = lo THEN 0 ELSE CAST(LEAST(FLOOR((v - lo) / ((hi - lo) / bins)), bins - 1) AS INTEGER) END AS bin,
   lo, hi, bins FROM (SELECT CAST(patent_count AS DOUBLE) AS v FROM country_share_known WHERE patent_count IS NOT NULL)
   CROSS JOIN (SELECT MIN(CAST(patent_count AS DOUBLE)) AS lo, MAX(CAST(patent_count AS DOUBLE)) AS hi,
     CAST(LEAST(20, GREATEST(5, FLOOR(COUNT(patent_count) / 2))) AS INTEGER) AS bins FROM country_share_known))
 GROUP BY bin, lo, hi, bins ORDER BY bin""", [COUNTRY_SHARE_KNOWN])
register("country_geo", _RI, f"""SELECT country, patent_count, patent_share_pct, {sql_iso3('country')} AS iso3,
 COALESCE(country, 'Unknown') AS country_label FROM country_share_all""", [ISO3_CTE, COUNTRY_SHARE_ALL])
register("country_geo_map", _RI, f"""SELECT * FROM (SELECT country, patent_count, share_pct,
 {sql_iso3('country')} AS iso3, COALESCE(country, 'Unknown') AS country_label FROM country_share_known)
 WHERE iso3 IS NOT NULL AND LENGTH(iso3) = 3""", [ISO3_CTE, COUNTRY_SHARE_KNOWN])

# -- explorer / overview -------------------------------------------------------------------
_KW = "(COALESCE(regexp_matches(title, 'urgent', 'i'), false) OR COALESCE(regexp_matches(abstract, 'urgent', 'i'), false))"
_YEARS = "year IN (1995, 1997, 1999)"
register("search_patents", ["patents"],
         f"SELECT patent_id, title, year, classification, filing_date FROM patents WHERE {_KW}")
register("search_inventors", ["inventors"],
         "SELECT name, country FROM inventors WHERE COALESCE(regexp_matches(name, '#00000(1|2)', 'i'), false)")
register("filter_years", ["patents"],
         f"SELECT patent_id, title, year, classification, filing_date FROM patents WHERE {_YEARS}")
register("year_choices", ["patents"], "SELECT DISTINCT year FROM patents WHERE year IS NOT NULL ORDER BY year")
register("patent_page", ["patents"], f"""SELECT patent_id, title, year, classification, filing_date FROM patents
 WHERE {_KW} AND {_YEARS} ORDER BY patent_id LIMIT 50 OFFSET 100""")
register("patent_page_after", ["patents"],
         "SELECT patent_id, title, year FROM patents WHERE patent_id > '5000' ORDER BY patent_id LIMIT 100")
register("page_count", ["patents"], f"""SELECT COUNT(*) AS window_rows,
 CAST(GREATEST(1, CEIL(COUNT(*) / 100)) AS INTEGER) AS pages FROM patents WHERE {_KW}""")
register("patent_detail", ["patents"], """SELECT patent_id, title, abstract, year, classification, filing_date
 FROM patents WHERE patent_id = '7'""")
register("slice_years", ["patents"], f"""SELECT year, COUNT(*) AS patent_count FROM patents WHERE {_KW}
 GROUP BY year ORDER BY year""")
register("slice_diagnostics", ["patents"], f"""SELECT COUNT(DISTINCT year) AS unique_years, MIN(year) AS earliest_year,
 MAX(year) AS latest_year, COUNT(DISTINCT classification) AS classification_types,
 round_even(AVG(CASE WHEN abstract IS NOT NULL THEN 1.0 ELSE 0.0 END) * 100, 2) AS abstract_coverage_pct
 FROM patents WHERE {_KW}""")
register("top_n", _RI, """SELECT inventor_id, name, country, patent_count FROM (
 SELECT *, ROW_NUMBER() OVER (ORDER BY patent_count DESC, inventor_id ASC) AS rn, COUNT(*) OVER () AS cnt
 FROM top_inventors) WHERE rn <= CASE WHEN cnt <= 1 THEN cnt ELSE LEAST(10, LEAST(20, cnt)) END""", [TOP_INVENTORS])
register("kpi_overview", ["relationships", "inventors", "companies", "patents"], f"""SELECT
 (SELECT COUNT(*) FROM patents) AS total_patents, (SELECT COUNT(*) FROM inventors) AS total_inventors,
 (SELECT COUNT(*) FROM companies) AS total_companies, (SELECT COUNT(*) FROM relationships) AS linked_records,
 (SELECT MAX(year) FROM per_year WHERE year IS NOT NULL) AS latest_year,
 COALESCE((SELECT arg_max(patent_count, year) FROM per_year WHERE year IS NOT NULL), 0) AS latest_year_count,
 CASE WHEN (SELECT COUNT(*) FROM patents) > 0 THEN round_even(CAST((SELECT COUNT(*) FROM relationships) AS DOUBLE)
   / (SELECT COUNT(*) FROM patents) * 100, 2) ELSE 0.0 END AS linked_ratio_pct,
 (SELECT COUNT(*) FROM (SELECT {sql_iso3('country')} AS iso3 FROM country_share_known)
   WHERE iso3 IS NOT NULL AND LENGTH(iso3) = 3) AS mapped_countries""", [PER_YEAR, ISO3_CTE, COUNTRY_SHARE_KNOWN])

# -- enrichment ------------------------------------------------------------------------
_UUID_SRC = ["persistent_assignee_raw", "assignee_names_raw"]
_NAMED = ("named", "SELECT patent_id, assignee_sequence, assignee_id, disambig_assignee_organization AS organization"
          " FROM assignee_names_raw WHERE disambig_assignee_organization IS NOT NULL AND "
          + sql_strip("disambig_assignee_organization") + " <> ''")
_UUIDS = ("uuids", "SELECT patent_id, assignee_sequence, COALESCE(NULLIF(disamb_assignee_id_20200331,''),"
          " NULLIF(disamb_assignee_id_20210330,''), NULLIF(disamb_assignee_id_20220929,'')) AS uuid"
          " FROM persistent_assignee_raw WHERE patent_id IS NOT NULL")
_UUID_MAP = ("uuid_map", """SELECT uuid, organization AS name FROM (SELECT p.uuid, p.patent_id, p.assignee_sequence,
 n.organization, ROW_NUMBER() OVER (PARTITION BY p.uuid ORDER BY p.patent_id, p.assignee_sequence, n.organization) AS rn
 FROM uuids p JOIN named n ON n.patent_id = p.patent_id AND n.assignee_sequence = p.assignee_sequence
 WHERE p.uuid IS NOT NULL) WHERE rn = 1""")
register("uuid_name_map", _UUID_SRC, "SELECT * FROM uuid_map", [_NAMED, _UUIDS, _UUID_MAP])
register("name_map_last", ["assignee_names_raw"], """SELECT assignee_id, organization AS name FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY assignee_id ORDER BY patent_id DESC NULLS LAST,
   assignee_sequence DESC NULLS LAST, organization DESC NULLS LAST) AS rn FROM named WHERE assignee_id IS NOT NULL)
 WHERE rn = 1""", [_NAMED])
_CLEAN_CO = ("clean_co", f"SELECT DISTINCT * FROM ({_NAMED_IDS})")
_ENRICHED = ("enriched", """SELECT c.company_id, COALESCE(m.name, c.name) AS name, c.name AS previous_name
 FROM clean_co c LEFT JOIN uuid_map m ON m.uuid = c.company_id""")
register_staged("enrich_company_names", ["stg_assignees", "stg_assignee_names"], "SELECT * FROM enriched",
                [_NAMED, _UUIDS, _UUID_MAP])
SQL["enrich_company_names"] = SQL["enrich_company_names"].replace(
    "\nSELECT * FROM enriched", f",\n{_CLEAN_CO[0]} AS ({_CLEAN_CO[1]}),\n{_ENRICHED[0]} AS ({_ENRICHED[1]})\nSELECT * FROM enriched")
SQL["enrich_metrics"] = SQL["enrich_company_names"].replace(
    "\nSELECT * FROM enriched", "\nSELECT COUNT(*) AS companies,"
    " COUNT(CASE WHEN name IS DISTINCT FROM previous_name THEN 1 END) AS names_changed FROM enriched")

# -- quality ---------------------------------------------------------------------------
_FLAT_P = ("flat_p", _first_sql(["patent_id", "title", "abstract", "filing_date", "year", "classification"],
                                 "patent_id", "flat_clean"))
_FLAT_I = ("flat_i", _first_sql(["inventor_id", "name", "country"], "inventor_id", "flat_clean"))
_FLAT_C = ("flat_c", _first_sql(["company_id", "name"], "company_id",
                                 "(SELECT assignee_id AS company_id, company_name AS name FROM flat_clean)"))
_FLAT_R = ("flat_r", "SELECT DISTINCT patent_id, inventor_id, assignee_id AS company_id FROM flat_clean")
_FLAT_ALL = [FLAT_CLEAN_CTE, _FLAT_P, _FLAT_I, _FLAT_C, _FLAT_R]


def _orphan(key: str, dim: str) -> str:
    return (f"SELECT '{key}' AS foreign_key, COUNT(*) AS orphan_rows, COUNT(DISTINCT r.{key}) AS orphan_keys"
            f" FROM relationships r WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = r.{key})")


register("fk_orphans", ["relationships", "extracted_records"],
         " UNION ALL ".join([_orphan("patent_id", "flat_p"), _orphan("inventor_id", "flat_i"),
                             _orphan("company_id", "flat_c")]), _FLAT_ALL)
register("table_counts", ["patents", "inventors", "companies", "relationships"], " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", COUNT(*) AS row_count FROM {t}"
    for t in ["patents", "inventors", "companies", "relationships"]))
register("load_dedup", ["patents", "inventors", "companies", "relationships", "extracted_records"], " UNION ALL ".join([
    "SELECT 'patents' AS \"table\", COUNT(DISTINCT patent_id) AS row_count FROM (SELECT patent_id FROM patents"
    " UNION ALL SELECT patent_id FROM flat_p)",
    "SELECT 'inventors', COUNT(DISTINCT inventor_id) FROM (SELECT inventor_id FROM inventors"
    " UNION ALL SELECT inventor_id FROM flat_i)",
    "SELECT 'companies', COUNT(DISTINCT company_id) FROM (SELECT company_id FROM companies"
    " UNION ALL SELECT company_id FROM flat_c)",
    "SELECT 'relationships', COUNT(*) FROM (SELECT patent_id, inventor_id, company_id FROM relationships"
    " UNION SELECT patent_id, inventor_id, company_id FROM flat_r)"]), _FLAT_ALL)
register("load_dedup_inventors", ["inventors", "extracted_records"],
         _first_sql(["inventor_id", "name", "country"], "inventor_id",
                    "(SELECT inventor_id, name, country FROM inventors UNION ALL SELECT * FROM flat_i)"), _FLAT_ALL)

# -- reports ---------------------------------------------------------------------------
_TOPS = [
    ("top_inv", _INV_COUNTS + " ORDER BY patent_count DESC, dim.name, dim.inventor_id LIMIT 3"),
    ("top_co", _CO_COUNTS + " ORDER BY patent_count DESC, dim.name, dim.company_id LIMIT 3"),
    ("top_cty", _COUNTRY_COUNTS.format(known="") + " ORDER BY patent_count DESC, country NULLS FIRST LIMIT 5"),
]
_RICC = ["relationships", "inventors", "companies", "patents"]
register("report_top_entities", _RICC, """
 SELECT 'top_inventors' AS list, CAST(ROW_NUMBER() OVER (ORDER BY patent_count DESC, name, inventor_id) AS INTEGER)
   AS position, inventor_id AS entity_id, name AS label, patent_count FROM top_inv
 UNION ALL SELECT 'top_companies', CAST(ROW_NUMBER() OVER (ORDER BY patent_count DESC, name, company_id) AS INTEGER),
   company_id, name, patent_count FROM top_co
 UNION ALL SELECT 'top_countries', CAST(ROW_NUMBER() OVER (ORDER BY patent_count DESC, country NULLS FIRST) AS INTEGER),
   country, country, patent_count FROM top_cty""", _TOPS)
register("report_summary", _RICC, """SELECT CAST(to_json({
 'total_patents': (SELECT COUNT(*) FROM patents),
 'top_inventors': (SELECT list({'inventor_id': inventor_id, 'name': name, 'country': country,
     'patent_count': patent_count} ORDER BY patent_count DESC, name, inventor_id) FROM top_inv),
 'top_companies': (SELECT list({'company_id': company_id, 'name': name, 'patent_count': patent_count}
     ORDER BY patent_count DESC, name, company_id) FROM top_co),
 'top_countries': (SELECT list({'country': country, 'patent_count': patent_count}
     ORDER BY patent_count DESC, country NULLS FIRST) FROM top_cty)}) AS VARCHAR) AS report""", _TOPS)
register("report_diagnostics", _RICC, """SELECT
 (SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM patents GROUP BY year))::BIGINT AS patents_in_years,
 (SELECT COUNT(*) FROM inv_counts) AS inventor_records,
 (SELECT name FROM inv_counts ORDER BY patent_count DESC, name, inventor_id LIMIT 1) AS top_inventor,
 (SELECT patent_count FROM inv_counts ORDER BY patent_count DESC, name, inventor_id LIMIT 1) AS top_inventor_patents,
 (SELECT COUNT(*) FROM co_counts) AS companies_with_patents,
 (SELECT name FROM co_counts ORDER BY patent_count DESC, name, company_id LIMIT 1) AS top_company,
 (SELECT patent_count FROM co_counts ORDER BY patent_count DESC, name, company_id LIMIT 1) AS top_company_patents,
 (SELECT COUNT(*) FROM cty_counts) AS countries_reported,
 (SELECT SUM(patent_count) FROM cty_counts)::BIGINT AS patents_in_country_stats""",
         [INV_COUNTS, ("co_counts", _CO_COUNTS), ("cty_counts", _COUNTRY_COUNTS.format(known=""))])

# -- links and manifests -----------------------------------------------------------------
_LINK_PAGES = ("link_pages", """SELECT page_id, url, html || CASE WHEN page_id % 3 = 0 THEN
 replace('<a href="https://files.example.org/data set/p@.zip">a</a> <a href=''/odd|path/{x}/P@.ZIP?sig=1''>b</a>'
  || ' <a href="/docs/p@.zip.html">c</a> <a href="rel/p@.zip#top">d</a> <a href="https://p@.zip">e</a>', '@', CAST(page_id AS VARCHAR))
 ELSE '' END AS html FROM pages""")
_FOUND = ("found", """SELECT DISTINCT page_id, url, trim(unnest(
 regexp_extract_all(html, 'href=["'']([^"'']+)["'']', 1, 'i')
 || regexp_extract_all(html, '(https?://[^"''\\s<>]+\\.zip(\\?[^"''\\s<>]*)?)', 1, 'i')
 || regexp_extract_all(html, '(/[^"''\\s<>]+\\.zip(\\?[^"''\\s<>]*)?)', 1, 'i'))) AS h FROM link_pages""")
_RESOLVED = ("resolved", """SELECT DISTINCT page_id, CASE
 WHEN regexp_matches(h, '^https?://') THEN h
 WHEN h LIKE '//%' THEN regexp_extract(url, '^[a-z]+:') || h
 WHEN h LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || h
 ELSE regexp_extract(regexp_extract(url, '^[^?#]*'), '^.*/') || h END AS link FROM found""")
register("page_links", [], "SELECT * FROM resolved", [_LINK_PAGES, _FOUND, _RESOLVED])
register("page_archives", [], """SELECT * FROM resolved
 WHERE lower(regexp_replace(regexp_extract(link, '^[^?#]*'), '^[a-z]+://[^/]*', '')) LIKE '%.zip'""", [_LINK_PAGES, _FOUND, _RESOLVED])
register("manifest_files", [], """SELECT page_id, name, url, size FROM (SELECT page_id,
 'page_' || CAST(page_id AS VARCHAR) || CASE page_id % 3 WHEN 0 THEN '.zip' WHEN 1 THEN '.ZIP' ELSE '.html' END AS name,
 CASE WHEN page_id % 2 = 0 THEN url ELSE 'https://data.example.org/files/' || CAST(page_id AS VARCHAR) END AS url,
 CAST(CASE WHEN page_id % 5 = 0 THEN 0 WHEN page_id % 7 = 0 THEN NULL ELSE length(html) END AS BIGINT) AS size
 FROM pages) WHERE page_id % 3 <> 2""")
register("json_props", [], """SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
 FROM events""")

# -- streaming (oracle = the batch view) ----------------------------------------------------
register("stream_ingest", ["patents"], "SELECT * FROM patents")
register("stream_dedup", ["relationships"], "SELECT * FROM relationships")
register("stream_dedup_files", ["relationships"], "SELECT * FROM relationships")

# -- the same results by an index, a directory, a layout, a stream
SQL["search_patents_indexed"] = SQL["search_patents"]
register("search_pattern_indexed", ["patents"],
         """SELECT patent_id, title, year FROM patents
 WHERE regexp_matches(coalesce(title, ''), '(?i)(LOW|not spec[a-z]+) ?[FO]$') OR regexp_matches(coalesce(abstract, ''), '(?i)(LOW|not spec[a-z]+) ?[FO]$')""")
register("patent_page_directory", ["patents"],
         "SELECT patent_id, title, year, classification, filing_date FROM patents ORDER BY patent_id LIMIT 100 OFFSET 9900")
register("curve_layout_slice", ["relationships", "patents", "inventors", "companies"],
         """SELECT p.patent_id, p.title, p.year, p.classification, i.name AS inventor_name, i.country, c.name AS company_name
 FROM relationships r JOIN patents p ON p.patent_id = r.patent_id
 JOIN inventors i ON i.inventor_id = r.inventor_id JOIN companies c ON c.company_id = r.company_id
 WHERE p.year = 1996 AND p.classification = 'B1' AND i.country = 'US'""")
SQL["stream_clean_metrics"] = SQL["clean_metrics"]
