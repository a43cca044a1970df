"""Registered queries over the fixture views (one per SURVEY section 2 key)."""

from __future__ import annotations

from pyspark.sql import functions as F

from recordlens.functions.country import normalize_country
from recordlens.operators import analytics as an
from recordlens.operators import bitmaps as bm
from recordlens.operators import enrich as en
from recordlens.operators import explore as ex
from recordlens.operators import factorised as fa
from recordlens.operators import flat as fl
from recordlens.operators import links as lk
from recordlens.operators import quality as qa
from recordlens.operators import report as rp
from recordlens.operators import staging as stg
from recordlens.operators import stats as st
from recordlens.operators import tables as tb
from recordlens.operators.pages import PagedTable
from recordlens.operators.search_index import SearchIndex
from recordlens.plans.zorder import save_along_curve
from recordlens.registry import query
from recordlens.sources.delimited import read_delimited
from recordlens.streaming import ingest as si
from recordlens.streaming import metrics as sm
from recordlens.streaming.seen import ingest_distinct
from recordlens.streaming.standing import StandingCounts, run_standing


STREAM_FILES = 8


# -- q1..q7 -------------------------------------------------------------------
@query("q1_top_inventors")
def _q1(v):
    return an.q1_top_inventors(v.relationships, v.inventors)


@query("q2_top_companies")
def _q2(v):
    return an.q2_top_companies(v.relationships, v.companies)


@query("q3_top_countries")
def _q3(v):
    return an.q3_top_countries(v.relationships, v.inventors)


@query("q4_patents_per_year")
def _q4(v):
    return an.q4_patents_per_year(v.patents)


@query("q5_patent_inventor_company_join")
def _q5(v):
    return an.q5_patent_inventor_company_join(v.relationships, v.patents, v.inventors, v.companies)


@query("q6_country_share_cte")
def _q6(v):
    return an.q6_country_share_cte(v.relationships, v.inventors)


@query("q7_inventor_ranking")
def _q7(v):
    return an.q7_inventor_ranking(v.relationships, v.inventors)


# -- q1..q7 without the triples --------------------------------------------------
def _links(v):
    return fa.linked_pairs(v.inventors_raw, v.company_links)


@query("factorised_top_inventors")
def _fti(v):
    """q1 from the (patent, inventor) and (patent, company) pairs."""
    return fa.top_inventors(_links(v), v.inventors)


@query("factorised_top_companies")
def _ftc(v):
    return fa.top_companies(_links(v), v.companies)


@query("factorised_top_countries")
def _ftco(v):
    return fa.top_countries(_links(v), v.inventors)


@query("factorised_country_share")
def _fcs(v):
    return fa.country_share(_links(v), v.inventors)


@query("factorised_inventor_ranking")
def _fir(v):
    return fa.inventor_ranking(_links(v), v.inventors)


@query("factorised_link_counts")
def _flc(v):
    return fa.link_counts(_links(v))


# -- q1, q2, q3, q6 from mergeable sets, q1..q4 as standing results ----------------
def _containers(v, key):
    numbers = bm.patent_numbers(v.relationships)
    return bm.containers(bm.numbered_pairs(v.relationships, numbers, key))


@query("bitmap_top_inventors")
def _bti(v):
    """q1 as members of containers of patent numbers."""
    counts = bm.counts(_containers(v, "inventor_id")).withColumnRenamed("key", "inventor_id")
    return v.inventors.join(counts, "inventor_id").orderBy(F.col("patent_count").desc(), F.col("name").asc())


@query("bitmap_top_countries")
def _btco(v):
    """q3 by rolling the inventors' containers up."""
    groups = v.inventors.select(F.col("inventor_id").alias("key"), F.col("country").alias("group"))
    counts = bm.counts(bm.rollup(_containers(v, "inventor_id"), groups)).withColumnRenamed("key", "country")
    return counts.orderBy(F.col("patent_count").desc(), F.col("country").asc())


_STANDING: dict = {}


def _standing(v):
    """Line items and orders streamed in several batches into standing counts, once per set of views."""
    if id(v) not in _STANDING:
        spark, orders = v.spark, v.t.orders
        base = si.scratch_path(spark, "standing")
        store = StandingCounts(spark, f"{base}/store", compact_every=3)
        v.t.lineitem.repartition(STREAM_FILES).write.parquet(f"{base}/items")
        orders.repartition(STREAM_FILES).write.parquet(f"{base}/orders")

        def to_links(items):
            j = items.join(orders.select("o_orderkey", "o_custkey"), F.col("o_orderkey") == F.col("l_orderkey"))
            return j.select(F.col("o_orderkey").cast("string").alias("patent_id"), F.col("o_custkey").cast("string").alias("inventor_id"),
                            F.col("l_suppkey").cast("string").alias("company_id"))

        run_standing(spark, f"{base}/items", v.t.lineitem.schema, store.add_links, f"{base}/ckpt1", to_links, max_files_per_trigger=STREAM_FILES // 4)
        run_standing(spark, f"{base}/orders", orders.schema, store.add_patents, f"{base}/ckpt2",
                     lambda o: o.select(F.year("o_orderdate").alias("year")), max_files_per_trigger=STREAM_FILES // 2)
        _STANDING[id(v)] = (v, store)
    return _STANDING[id(v)][1]


@query("standing_top_inventors")
def _sti1(v):
    """q1 kept up to date batch by batch."""
    return _standing(v).top_inventors(v.inventors)


@query("standing_top_companies")
def _stc(v):
    return _standing(v).top_companies(v.companies)


@query("standing_country_share")
def _stcs(v):
    """q3 and q6 kept up to date batch by batch."""
    return _standing(v).country_share(v.inventors)


@query("standing_patents_per_year")
def _stpy(v):
    return _standing(v).patents_per_year()


# -- dashboard frames -----------------------------------------------------------
@query("dash_top_inventors")
def _dti(v):
    return an.dash_top_inventors(v.relationships, v.inventors)


@query("dash_top_companies")
def _dtc(v):
    return an.dash_top_companies(v.relationships, v.companies)


@query("dash_top_countries")
def _dtco(v):
    return an.dash_top_countries(v.relationships, v.inventors)


@query("dash_country_share")
def _dcs(v):
    return an.dash_country_share(v.relationships, v.inventors)


@query("dash_classification")
def _dcl(v):
    return an.dash_classification(v.patents)


@query("class_by_year")
def _cby(v):
    return an.class_by_year(v.patents)


@query("dash_join")
def _dj(v):
    return an.dash_join(v.relationships, v.patents, v.inventors, v.companies)


@query("inventors_by_country")
def _ibc(v):
    return an.inventors_by_country(v.inventors)


# -- staging ------------------------------------------------------------------------


@query("stage_patents")
def _sp(v):
    return stg.stage_patents(v.patents_raw)


@query("stage_abstracts")
def _sa(v):
    return stg.stage_abstracts(v.abstracts_raw)


@query("stage_inventors")
def _si(v):
    return stg.stage_inventors(v.inventors_raw)


@query("stage_locations")
def _sl(v):
    return stg.stage_locations(v.location_mentions)


@query("stage_raw_locations")
def _srl(v):
    return stg.stage_raw_locations(v.raw_location_mentions)


@query("stage_assignees")
def _sas(v):
    return stg.stage_assignees(v.persistent_assignee_raw)


@query("stage_assignee_names")
def _san(v):
    return stg.stage_assignee_names(v.assignee_names_raw)


@query("country_iso2")
def _ciso2(v):
    return (v.extracted_records.groupBy(F.col("country").alias("raw_country"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select("raw_country", normalize_country("raw_country").alias("country_iso2"), "n"))


# -- raw files: quoted line breaks, file order ------------------------------------
_PLACES = ["o1", "o2", "o3", "o4"]


def _read_files(v, name, rows, order, **options):
    return read_delimited(v.spark, v.raw_files(name, rows, order), sep="\t", **options)


@query("quoted_text_ranges")
def _qtr(v):
    """Abstracts with line breaks in their cells, written as quoted files and read back in ranges."""
    rows = v.abstracts_raw.withColumn("o1", F.col("patent_id").cast("bigint"))
    return stg.stage_abstracts(_read_files(v, "abstracts", rows, ["o1"]))


@query("name_map_file_last")
def _nmfl(v):
    """id -> name where the last row of the files wins."""
    return en.name_map_last(_read_files(v, "names", v.assignee_names_conflicting, _PLACES, row_order=True))


@query("uuid_map_file_first")
def _umff(v):
    """uuid -> name where the first row of the files wins."""
    names = _read_files(v, "names", v.assignee_names_conflicting, _PLACES, row_order=True)
    return en.uuid_name_map(_read_files(v, "assignees", v.assignees_placed, _PLACES, row_order=True), names)


# -- clean tables -------------------------------------------------------------------
def staged(v):
    return {
        "patents": stg.stage_patents(v.patents_raw),
        "abstracts": stg.stage_abstracts(v.abstracts_raw),
        "inventors": stg.stage_inventors(v.inventors_raw),
        "locations": stg.stage_locations(v.location_mentions),
        "raw_locations": stg.stage_raw_locations(v.raw_location_mentions),
        "assignees": stg.stage_assignees(v.persistent_assignee_raw),
        "names": stg.stage_assignee_names(v.assignee_names_raw),
    }


@query("clean_patents")
def _cp(v):
    s = staged(v)
    return tb.clean_patents(s["patents"], s["abstracts"])


@query("clean_inventors")
def _ci(v):
    s = staged(v)
    return tb.clean_inventors(s["inventors"], s["locations"], s["raw_locations"])


@query("clean_companies")
def _cc(v):
    s = staged(v)
    return tb.clean_companies(s["assignees"], s["names"])


@query("companies_table")
def _ct(v):
    s = staged(v)
    return tb.companies_table(tb.clean_companies(s["assignees"], s["names"]))


@query("clean_relationships")
def _cr(v):
    s = staged(v)
    return tb.clean_relationships(s["inventors"], s["assignees"])


# -- flat path ------------------------------------------------------------------------


@query("map_columns")
def _mc(v):
    return fl.map_columns(v.records_alias_layout)


@query("union_records")
def _ur(v):
    a = v.extracted_records.withColumn("source_file", F.lit("records.csv"))
    b = fl.map_columns(v.records_alias_layout.withColumn("source_file", F.lit("records_alias.tsv")))
    return fl.union_records(a, b)


@query("flat_clean")
def _fc(v):
    return fl.flat_clean(v.extracted_records)


@query("clean_metrics")
def _cm(v):
    return fl.clean_metrics(v.extracted_records)


@query("flat_patents")
def _fp(v):
    return fl.flat_patents(fl.flat_clean(v.extracted_records))


@query("flat_inventors")
def _fi(v):
    return fl.flat_inventors(fl.flat_clean(v.extracted_records))


@query("flat_companies")
def _fco(v):
    return fl.flat_companies(fl.flat_clean(v.extracted_records))


@query("flat_relationships")
def _fr(v):
    return fl.flat_relationships(fl.flat_clean(v.extracted_records))


# -- statistics ------------------------------------------------------------------------


@query("pareto_companies")
def _pc(v):
    return st.add_cumulative_share(an.dash_top_companies(v.relationships, v.companies),
                                   "patent_count", "name", tiebreak=["company_id"], bounded=True)


@query("pareto_inventors")
def _pi(v):
    return st.add_cumulative_share(an.dash_top_inventors(v.relationships, v.inventors),
                                   "patent_count", "name", tiebreak=["inventor_id"], bounded=True)


@query("pareto_countries")
def _pco(v):
    return st.add_cumulative_share(an.dash_country_share(v.relationships, v.inventors),
                                   "patent_count", "country")


@query("pareto_inventors_all")
def _pia(v):
    return st.add_cumulative_share(an.inventor_patent_counts(v.relationships, v.inventors),
                                   "patent_count", "name", tiebreak=["inventor_id"])


@query("concentration_companies")
def _ccomp(v):
    return st.summarize_concentration(an.dash_top_companies(v.relationships, v.companies), "patent_count")


@query("concentration_inventors")
def _cinv(v):
    return st.summarize_concentration(an.dash_top_inventors(v.relationships, v.inventors), "patent_count")


@query("concentration_countries")
def _ccty(v):
    return st.summarize_concentration(an.dash_country_share(v.relationships, v.inventors), "patent_count")


@query("concentration_inventors_all")
def _cinva(v):
    return st.summarize_concentration(an.inventor_patent_counts(v.relationships, v.inventors), "patent_count")


@query("trend_rolling")
def _tr(v):
    return st.trend_rolling(an.q4_patents_per_year(v.patents))


@query("trend_yoy")
def _ty(v):
    return st.trend_yoy(an.q4_patents_per_year(v.patents))


@query("trend_series")
def _ts(v):
    return st.trend_series(an.q4_patents_per_year(v.patents))


@query("country_histogram")
def _ch(v):
    return st.histogram(an.dash_country_share(v.relationships, v.inventors), "patent_count")


@query("country_geo")
def _cg(v):
    return ex.country_geo(an.q6_country_share_cte(v.relationships, v.inventors))


@query("country_geo_map")
def _cgm(v):
    return ex.country_geo_map(an.dash_country_share(v.relationships, v.inventors))


# -- explorer / overview ----------------------------------------------------------------
SEARCH_KEYWORD = "urgent"
SEARCH_PATTERN = "(LOW|not spec[a-z]+) ?[FO]$"
FILTER_YEARS = [1995, 1997, 1999]


@query("search_patents")
def _spat(v):
    return ex.search_patents(v.patents, SEARCH_KEYWORD).select(
        "patent_id", "title", "year", "classification", "filing_date")


def _index(v):
    return SearchIndex(v.spark, si.scratch_path(v.spark, "search_index"), "patent_id", ("title", "abstract")).build(v.patents)


@query("search_patents_indexed")
def _spi(v):
    """The keyword search by trigram postings."""
    return _index(v).search(SEARCH_KEYWORD).select("patent_id", "title", "year", "classification", "filing_date")


@query("search_pattern_indexed")
def _spti(v):
    """A pattern with alternatives, repeats and classes by trigram postings."""
    return _index(v).search(SEARCH_PATTERN).select("patent_id", "title", "year")


@query("search_inventors")
def _sinv(v):
    return ex.search_inventors(v.inventors, "#00000(1|2)").select("name", "country")


@query("filter_years")
def _fy(v):
    return ex.filter_years(v.patents, FILTER_YEARS).select(
        "patent_id", "title", "year", "classification", "filing_date")


@query("year_choices")
def _yc(v):
    return ex.year_choices(v.patents)


@query("patent_page")
def _pp(v):
    filtered = ex.filter_years(ex.search_patents(v.patents, SEARCH_KEYWORD), FILTER_YEARS)
    return ex.patent_page(filtered, page=3, size=50).select(
        "patent_id", "title", "year", "classification", "filing_date")


@query("patent_page_after")
def _ppa(v):
    return ex.patent_page_after(v.patents, "5000", size=100).select("patent_id", "title", "year")


@query("patent_page_directory")
def _ppd(v):
    """A deep page read from a range-sorted table by its directory."""
    table = PagedTable(v.spark, si.scratch_path(v.spark, "pages"), "patent_id").build(
        v.patents.select("patent_id", "title", "year", "classification", "filing_date"), rows_per_part=2000)
    return table.page(100, size=100)


@query("curve_layout_slice")
def _cls(v):
    """A year, class and country slice of the star join laid out along a space-filling curve."""
    rows = an.dash_join(v.relationships, v.patents, v.inventors, v.companies)
    path = save_along_curve(rows, ["year", "classification", "country"], si.scratch_path(v.spark, "curve"), files=8)
    return v.spark.read.parquet(path).where("year = 1996 and classification = 'B1' and country = 'US'")


@query("page_count")
def _pgc(v):
    return ex.page_count(ex.search_patents(v.patents, SEARCH_KEYWORD), size=100)


@query("patent_detail")
def _pd(v):
    return ex.patent_detail(v.patents, "7")


@query("slice_years")
def _sy(v):
    return ex.slice_years(ex.search_patents(v.patents, SEARCH_KEYWORD))


@query("slice_diagnostics")
def _sd(v):
    return ex.slice_diagnostics(ex.search_patents(v.patents, SEARCH_KEYWORD))


@query("top_n")
def _tn(v):
    return ex.top_n(an.dash_top_inventors(v.relationships, v.inventors),
                    [F.col("patent_count").desc(), F.col("inventor_id").asc()])


@query("kpi_overview")
def _kpi(v):
    per_year = an.q4_patents_per_year(v.patents)
    geo = ex.country_geo_map(an.dash_country_share(v.relationships, v.inventors))
    return ex.kpi_overview(v.patents, v.inventors, v.companies, v.relationships, per_year, geo)


# -- enrichment / quality ------------------------------------------------------------------


@query("uuid_name_map")
def _unm(v):
    return en.uuid_name_map(v.persistent_assignee_raw, v.assignee_names_raw)


@query("name_map_last")
def _nml(v):
    return en.name_map_last(v.assignee_names_raw)


def _enriched(v):
    s = staged(v)
    companies = tb.clean_companies(s["assignees"], s["names"])
    return en.enrich_company_names(companies, en.uuid_name_map(v.persistent_assignee_raw,
                                                                 v.assignee_names_raw))


@query("enrich_company_names")
def _ecn(v):
    return _enriched(v)


@query("enrich_metrics")
def _em(v):
    return en.enrich_metrics(_enriched(v))


def _flat_tables(v):
    return fl.split_tables(v.flat_clean_table)


@query("fk_orphans")
def _fko(v):
    t = _flat_tables(v)
    return qa.fk_orphans(v.relationships, t["patents"], t["inventors"], t["companies"])


@query("table_counts")
def _tc(v):
    return qa.table_counts(v.clean_tables())


@query("load_dedup")
def _ld(v):
    flat = _flat_tables(v)
    both = {k: fl.union_records(v.clean_tables()[k].select(*flat[k].columns), flat[k])
            for k in ("patents", "inventors", "companies", "relationships")}
    return qa.table_counts(qa.load_dedup(both))


@query("load_dedup_inventors")
def _ldi(v):
    flat = _flat_tables(v)
    both = fl.union_records(v.inventors, flat["inventors"])
    return qa.dedup_on_key(both, ["inventor_id"])


# -- reports ---------------------------------------------------------------------------
def _tops(v):
    return rp.top_entities(v.relationships, v.patents, v.inventors, v.companies)


@query("report_top_entities")
def _rte(v):
    return rp.top_entities_long(_tops(v))


@query("report_summary")
def _rs(v):
    return rp.summary_json(rp.summary_report(v.patents, _tops(v)))


@query("report_diagnostics")
def _rd(v):
    return rp.report_diagnostics(v.relationships, v.patents, v.inventors, v.companies)


# -- links and manifests ------------------------------------------------------------------
MANIFEST_BASE_URL = "https://data.example.org"


@query("page_links")
def _pl(v):
    return lk.page_links(v.link_pages)


@query("page_archives")
def _pa(v):
    return lk.page_archives(lk.page_links(v.link_pages))


@query("manifest_files")
def _mf(v):
    return lk.manifest_files(v.manifests, "manifest", MANIFEST_BASE_URL, keep=("page_id",))


@query("json_props")
def _jp(v):
    return lk.json_props(v.t.events, "props", {"k": "int"}, keep=("event_id", "event_type"))


# -- streaming -------------------------------------------------------------------------


@query("stream_ingest")
def _sti(v):
    """Orders files streamed in, each batch shaped into patents rows."""
    spark = v.spark
    docs = v.t.documents.select("doc_id", "text")

    def to_patents(orders):
        j = orders.join(docs, docs.doc_id == orders.o_orderkey, "left")
        return j.select(
            F.col("o_orderkey").cast("string").alias("patent_id"),
            F.concat(F.col("o_orderpriority"), F.lit(" "), F.col("o_orderstatus")).alias("title"),
            F.col("text").alias("abstract"),
            F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("filing_date"),
            F.year("o_orderdate").cast("int").alias("year"),
            F.when(F.col("o_orderstatus") == "F", "B1").when(F.col("o_orderstatus") == "O", "B2")
            .otherwise(F.col("o_orderpriority")).alias("classification"))

    base = si.scratch_path(spark, "stream_ingest")
    # The table as arriving files, taken in several micro-batches.
    v.t.orders.repartition(STREAM_FILES).write.parquet(f"{base}/in")
    return si.ingest(spark, f"{base}/in", v.t.orders.schema, to_patents, f"{base}/out", f"{base}/ckpt",
                     max_files_per_trigger=STREAM_FILES // 2)


@query("stream_dedup")
def _std(v):
    """Line items streamed in, linked to orders, de-duplicated to distinct triples."""
    spark = v.spark
    orders = v.t.orders.select("o_orderkey", "o_custkey")

    def to_links(items):
        j = items.join(orders, orders.o_orderkey == items.l_orderkey)
        return j.select(F.col("o_orderkey").cast("string").alias("patent_id"),
                        F.col("o_custkey").cast("string").alias("inventor_id"),
                        F.col("l_suppkey").cast("string").alias("company_id"))

    base = si.scratch_path(spark, "stream_dedup")
    v.t.lineitem.repartition(STREAM_FILES).write.parquet(f"{base}/in")
    return si.ingest(spark, f"{base}/in", v.t.lineitem.schema, to_links, f"{base}/out", f"{base}/ckpt",
                     max_files_per_trigger=STREAM_FILES // 2, dedup_keys=["patent_id", "inventor_id", "company_id"])


@query("stream_clean_metrics")
def _scm(v):
    """Row counts of the cleaning stage summed over the micro-batches of a stream."""
    spark = v.spark
    base = si.scratch_path(spark, "stream_metrics")
    records = v.extracted_records
    # The files as their tasks write them, so no record is shuffled for them; half of them are a batch.
    records.write.parquet(f"{base}/in")
    files = len(spark.read.schema(records.schema).parquet(f"{base}/in").inputFiles())
    listener = sm.BatchMetrics(spark, f"{base}/metrics")
    spark.streams.addListener(listener)
    try:
        stream = sm.clean_stream(si.stream_files(spark, f"{base}/in", records.schema, max_files_per_trigger=max(1, -(-files // 2))))
        si.run_to_parquet(stream, f"{base}/out", f"{base}/ckpt")
        return sm.totals(listener.rows())
    finally:
        spark.streams.removeListener(listener)


@query("stream_dedup_files")
def _stdf(v):
    """The distinct triples of streamed line items, by key files and filters instead of a state row per key."""
    spark = v.spark
    orders = v.t.orders.select("o_orderkey", "o_custkey")

    def to_links(items):
        j = items.join(orders, orders.o_orderkey == items.l_orderkey)
        return j.select(F.col("o_orderkey").cast("string").alias("patent_id"), F.col("o_custkey").cast("string").alias("inventor_id"),
                        F.col("l_suppkey").cast("string").alias("company_id"))

    base = si.scratch_path(spark, "stream_dedup_files")
    v.t.lineitem.repartition(STREAM_FILES).write.parquet(f"{base}/in")
    return ingest_distinct(spark, f"{base}/in", v.t.lineitem.schema, to_links, base, ["patent_id", "inventor_id", "company_id"],
                           max_files_per_trigger=STREAM_FILES // 4)
