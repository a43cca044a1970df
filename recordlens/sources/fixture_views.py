"""The record schemas expressed over the driver's test tables.

The test tables are TPC-H-like; these views give them the shape of the raw
record files (``*_raw``), the clean star model (patents, inventors,
companies, relationships) and the flat extracted-record form, so every
operator in the library runs on data that grows with the scale factor.
The mapping rules are the ones written down in FIXTURES.md section 3; the
oracle SQL in :mod:`recordlens.oracle` states the same views in SQL.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.sources.testdata import TableSet

# Nation key -> messy country text, as specified for the fixture
# (covers every branch of the country normalisers).
RAW_COUNTRY_ROWS = [
    (0, "US"), (1, "usa "), (2, "United States"), (3, "JP"), (4, "Japan"), (5, "DE"),
    (6, "Deutschland"), (7, "GB"), (8, "UK"), (9, "FR"), (10, "KR"), (11, "South Korea"),
    (12, "CN"), (13, "TW"), (14, "Hong Kong"), (15, "NL"), (16, "Holland"), (17, "Finland"),
    (18, "Austria"), (19, "U.S.A."), (20, ""), (21, None), (22, "JPX"), (23, "1X"), (24, "NA"),
]


def _s(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string")


def _record_id(key: str) -> Column:
    """The patent id of the flat records: another text for each key, some with a space before it."""
    return F.when(F.col(key) % 10 == 0, F.concat(F.lit(" "), _s(key))).otherwise(_s(key))


def _date10(c: str) -> Column:
    return F.substring(F.col(c).cast("string"), 1, 10)


def _odd_dates(key: Column, date: str) -> Column:
    """ISO dates, some with a time after them and some with other text."""
    day = _date10(date)
    return (F.when(key % 43 == 0, F.concat(day, F.lit("garbage"))).when(key % 47 == 0, F.concat(day, F.lit("T08:30:00")))
            .when(key % 53 == 0, F.concat(day, F.lit("T99"))).when(key % 59 == 0, F.concat(day, F.lit(" 23:15"))).otherwise(day))


class FixtureViews:
    """All fixture views of one scale-factor directory, built lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        import uuid
        self.spark = spark
        self.t = TableSet(spark, sf_dir)
        self._run_id = uuid.uuid4().hex[:12]

    # -- lookup --------------------------------------------------------------
    @cached_property
    def raw_country(self) -> DataFrame:
        schema = T.StructType([T.StructField("nk", T.IntegerType()),
                               T.StructField("raw", T.StringType())])
        # 25 fixed rows: a proven-small dimension, always broadcast.
        return F.broadcast(self.spark.createDataFrame(RAW_COUNTRY_ROWS, schema))

    # -- raw (staging) form ---------------------------------------------------
    @cached_property
    def patents_raw(self) -> DataFrame:
        li, part = self.t.lineitem, self.t.part
        return li.join(part, part.p_partkey == li.l_partkey).select(
            _s("l_orderkey").alias("patent_id"),
            _odd_dates(F.col("l_orderkey"), "l_shipdate").alias("patent_date"),
            F.col("p_name").alias("title"),
            F.when(F.col("l_returnflag") == "A", "B1").when(F.col("l_returnflag") == "N", "B2")
            .otherwise("").alias("wipo_kind"),
            F.when(F.col("l_linestatus") == "O", "utility").otherwise("design").alias("patent_type"),
        )

    @cached_property
    def abstracts_raw(self) -> DataFrame:
        return self.t.documents.select(_s("doc_id").alias("patent_id"),
                                       F.col("text").alias("abstract"))

    @cached_property
    def inventors_raw(self) -> DataFrame:
        o, c = self.t.orders, self.t.customer
        return o.join(c, c.c_custkey == o.o_custkey).select(
            _s("o_orderkey").alias("patent_id"),
            _s("c_custkey").alias("inventor_id"),
            F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
            .otherwise(F.lit("Customer")).alias("disambig_inventor_name_first"),
            F.when(F.col("c_custkey") % 13 == 0, F.lit(""))
            .otherwise(F.substring("c_name", 10, 9)).alias("disambig_inventor_name_last"),
            F.concat(F.lit("loc-"), _s("c_nationkey")).alias("location_id"),
        )

    @cached_property
    def locations_raw(self) -> DataFrame:
        return self.t.nation.select(
            F.concat(F.lit("loc-"), _s("n_nationkey")).alias("location_id"),
            F.when(F.col("n_nationkey") % 3 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("C"), _s("n_nationkey"))).alias("disambig_country"),
        )

    @cached_property
    def locations_nd_raw(self) -> DataFrame:
        return self.raw_country.select(
            F.concat(F.lit("loc-"), _s("nk")).alias("location_id"),
            F.col("raw").alias("raw_country"))

    @cached_property
    def persistent_assignee_raw(self) -> DataFrame:
        s = F.col("l_suppkey")
        return self.t.lineitem.select(
            _s("l_orderkey").alias("patent_id"),
            _s("l_linenumber").alias("assignee_sequence"),
            F.when(s % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("a"), _s(s)))
            .alias("disamb_assignee_id_20200331"),
            F.when(s % 2 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("b"), _s(s)))
            .alias("disamb_assignee_id_20210330"),
            F.when(s % 12 == 0, F.lit("")).otherwise(F.concat(F.lit("c"), _s(s)))
            .alias("disamb_assignee_id_20220929"),
        )

    @cached_property
    def assignee_names_raw(self) -> DataFrame:
        li, su = self.t.lineitem, self.t.supplier
        return li.join(su, su.s_suppkey == li.l_suppkey).select(
            _s("l_orderkey").alias("patent_id"),
            _s("l_linenumber").alias("assignee_sequence"),
            F.concat(F.lit("a"), _s("s_suppkey")).alias("assignee_id"),
            F.when(F.col("s_suppkey") % 7 == 0, F.lit("  ")).otherwise(F.col("s_name"))
            .alias("disambig_assignee_organization"),
        )

    @cached_property
    def location_mentions(self) -> DataFrame:
        """Disambiguated location rows, one per customer (repeats kept)."""
        nk = F.col("c_nationkey")
        return self.t.customer.select(
            F.concat(F.lit("loc-"), _s(nk)).alias("location_id"),
            F.when(nk % 3 == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("C"), _s(nk))).alias("disambig_country"))

    @cached_property
    def raw_location_mentions(self) -> DataFrame:
        """Raw (non-disambiguated) location rows, one per customer."""
        c, rc = self.t.customer, self.raw_country
        return c.join(rc, rc.nk == c.c_nationkey, "left").select(
            F.concat(F.lit("loc-"), _s("c_nationkey")).alias("location_id"),
            F.col("raw").alias("raw_country"))

    # -- clean star model -----------------------------------------------------
    @cached_property
    def patents_view(self) -> DataFrame:
        o, d = self.t.orders, self.t.documents
        return o.join(d, d.doc_id == o.o_orderkey, "left").select(
            _s("o_orderkey").alias("patent_id"),
            F.concat(F.col("o_orderpriority"), F.lit(" "), F.col("o_orderstatus")).alias("title"),
            F.col("text").alias("abstract"),
            _date10("o_orderdate").alias("filing_date"),
            F.year("o_orderdate").cast("int").alias("year"),
            F.when(F.col("o_orderstatus") == "F", "B1").when(F.col("o_orderstatus") == "O", "B2")
            .otherwise(F.col("o_orderpriority")).alias("classification"),
        )

    @cached_property
    def inventors_view(self) -> DataFrame:
        c = self.t.customer
        rc = self.raw_country
        return c.join(rc, rc.nk == c.c_nationkey, "left").select(
            _s("c_custkey").alias("inventor_id"),
            F.col("c_name").alias("name"),
            F.upper(F.substring(F.nullif(F.trim("raw"), F.lit("")), 1, 2)).alias("country"),
        )

    @cached_property
    def companies_view(self) -> DataFrame:
        return self.t.supplier.select(
            _s("s_suppkey").alias("company_id"),
            F.when(F.col("s_suppkey") % 7 == 0, _s("s_suppkey")).otherwise(F.col("s_name"))
            .alias("name"),
        )

    @cached_property
    def relationships_view(self) -> DataFrame:
        li, o = self.t.lineitem, self.t.orders
        # Distinct before the casts: the keys are still those the join was dealt by, so no second shuffle.
        j = li.join(o, o.o_orderkey == li.l_orderkey).select("o_orderkey", "o_custkey", "l_suppkey").distinct()
        return j.select(
            _s("o_orderkey").alias("patent_id"),
            _s("o_custkey").alias("inventor_id"),
            _s("l_suppkey").alias("company_id"),
        )

    @cached_property
    def company_links(self) -> DataFrame:
        """(patent_id, company_id) as the relationships link them."""
        return self.t.lineitem.select(_s("l_orderkey").alias("patent_id"), _s("l_suppkey").alias("company_id"))

    # -- flat extracted-record form ------------------------------------------
    @cached_property
    def extracted_records(self) -> DataFrame:
        li, o, c, d = self.t.lineitem, self.t.orders, self.t.customer, self.t.documents
        rc = self.raw_country
        # Orders get their customer and text first, so neither is shuffled once per line item.  All are dealt by the
        # record's own patent id: equal records meet in one task, so the full-row de-duplication shuffles none of them.
        # The number of tasks is given, as AQE would join tasks by their bytes before an order is repeated per line item.
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        placed = (o.join(c, c.c_custkey == o.o_custkey)
                  .join(rc, rc.nk == c.c_nationkey, "left")
                  .withColumn("patent_id", _record_id("o_orderkey"))
                  .repartition(tasks, "patent_id"))
        texts = d.select(_record_id("doc_id").alias("_doc"), F.col("text").alias("abstract"))
        items = li.select(_record_id("l_orderkey").alias("l_orderkey"), "l_suppkey")
        ok = F.col("o_orderkey")
        orders = placed.join(texts, F.col("_doc") == F.col("patent_id"), "left").select(
            "patent_id",
            F.when(ok % 9 == 0, F.lit("  ")).otherwise(F.col("o_orderpriority")).alias("title"),
            "abstract",
            F.when(ok % 17 == 0, F.lit("not-a-date"))
            .when(ok % 23 == 0, F.date_format("o_orderdate", "M/d/yyyy"))
            .when(ok % 29 == 0, F.date_format("o_orderdate", "yyyy/MM/dd"))
            .when(ok % 31 == 0, F.date_format("o_orderdate", "yyyyMMdd"))
            .when(ok % 37 == 0, F.date_format("o_orderdate", "MMMM d, yyyy"))
            .when(ok % 41 == 0, F.upper(F.date_format("o_orderdate", "d MMM yyyy")))
            .otherwise(_odd_dates(ok, "o_orderdate")).alias("filing_date"),
            F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
            .otherwise(F.col("o_orderstatus")).alias("classification"),
            _s("c_custkey").alias("inventor_id"),
            F.col("c_name").alias("name"),
            F.col("raw").alias("country"),
        )
        return items.join(orders, F.col("l_orderkey") == F.col("patent_id")).select(
            *orders.columns,
            F.when(F.col("l_suppkey") % 19 == 0, F.lit(None).cast("string"))
            .otherwise(_s("l_suppkey")).alias("assignee_id"),
            F.concat(F.lit("Supplier "), _s("l_suppkey")).alias("company_name"),
        )

    @cached_property
    def records_alias_layout(self) -> DataFrame:
        """The flat records under another file's header spelling (no abstract)."""
        return self.extracted_records.select(
            F.col("patent_id").alias("Patent ID"), F.col("title").alias("patentTitle"),
            F.col("filing_date").alias("date"), F.col("classification").alias("main_classification"),
            F.col("inventor_id").alias("Inventor"), F.col("name").alias("inventorName"),
            F.col("country").alias("inventor_country"), F.col("assignee_id").alias("organization_id"),
            F.col("company_name").alias("assigneeName"), F.lit("x").alias("Notes"))

    @cached_property
    def link_pages(self) -> DataFrame:
        """The pages with links to archives added: odd paths, queries, names that only look like archives."""
        pid = F.col("page_id")
        extra = F.format_string(
            '<a href="https://files.example.org/data set/p%1$s.zip">a</a> <a href=\'/odd|path/{x}/P%1$s.ZIP?sig=1\'>b</a>'
            ' <a href="/docs/p%1$s.zip.html">c</a> <a href="rel/p%1$s.zip#top">d</a> <a href="https://p%1$s.zip">e</a>', _s(pid))
        return self.t.pages.select("page_id", "url", F.when(pid % 3 == 0, F.concat("html", extra)).otherwise(F.col("html")).alias("html"))

    @cached_property
    def manifests(self) -> DataFrame:
        """One JSON file manifest per page (both key spellings, empty lists, zero sizes, mixed file types)."""
        pid = F.col("page_id")
        ext = F.when(pid % 3 == 0, ".zip").when(pid % 3 == 1, ".ZIP").otherwise(".html")
        name = F.concat(F.lit("page_"), _s(pid), ext)
        uri = F.when(pid % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("/files/"), _s(pid)))
        size = F.when(pid % 5 == 0, "0").when(pid % 7 == 0, "").otherwise(_s(F.length("html")))
        before = F.when(pid % 8 == 0, '"bulkDataProductBags":[],').otherwise("")
        empty = F.when(pid % 3 == 0, F.concat(F.lit('"'), F.when(pid % 4 == 0, "productFileBag").otherwise("bulkDataFileBag"),
                                              F.lit('":{"fileDataBag":[]},'))).otherwise("")
        products = F.when(pid % 4 == 0, "bulkDataProductBag").otherwise("bulkDataProductBags")
        bag = F.when(pid % 4 == 0, "bulkDataFileBag").otherwise("productFileBag")
        doc = F.format_string(
            '{%s"%s":[{%s"%s":{"fileDataBag":[{"fileName":"%s","fileDownloadURI":"%s","fileSize":"%s"}]}}]}',
            before, products, empty, bag, name, uri, size)
        return self.t.pages.select("page_id", doc.alias("manifest"))

    # -- raw files --------------------------------------------------------------
    def raw_files(self, name: str, rows: DataFrame, order: list[str], files: int = 6) -> str:
        """``rows`` (without ``order``) as quoted TSV files in a shared folder, in the given order over sorted file names."""
        from recordlens.streaming.ingest import scratch_path
        path = scratch_path(self.spark, name)
        # More files for more tasks: a file is sorted by one task; the order over all files is the same.
        files = max(files, int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        placed = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop(*order)
        (placed.write.option("header", True).option("sep", "\t").option("escape", '"').option("quoteAll", True).option("emptyValue", "")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
        return path

    @cached_property
    def assignee_names_conflicting(self) -> DataFrame:
        """Name rows whose names differ from row to row, with the columns that order them in their files."""
        li, su = self.t.lineitem, self.t.supplier
        return li.join(su, su.s_suppkey == li.l_suppkey).select(
            _s("l_orderkey").alias("patent_id"), _s("l_linenumber").alias("assignee_sequence"),
            F.concat(F.lit("a"), _s("s_suppkey")).alias("assignee_id"),
            F.when(F.col("l_partkey") % 7 == 0, F.lit("  ")).otherwise(F.concat("s_name", F.lit(" \""), _s("l_partkey"), F.lit("\"\n"), _s("l_orderkey")))
            .alias("disambig_assignee_organization"),
            F.col("l_partkey").alias("o1"), F.col("l_orderkey").alias("o2"), F.col("l_linenumber").alias("o3"), F.col("l_suppkey").alias("o4"))

    @cached_property
    def assignees_placed(self) -> DataFrame:
        """The assignee rows with the columns that order them in their files."""
        s = F.col("l_suppkey")
        return self.t.lineitem.select(
            _s("l_orderkey").alias("patent_id"), _s("l_linenumber").alias("assignee_sequence"),
            F.when(s % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("a"), _s(s))).alias("disamb_assignee_id_20200331"),
            F.concat(F.lit("b"), _s(s)).alias("disamb_assignee_id_20210330"),
            (-F.col("l_partkey")).alias("o1"), F.col("l_orderkey").alias("o2"), F.col("l_linenumber").alias("o3"), s.alias("o4"))

    # -- the clean star model as tables ------------------------------------------
    # The analytical queries run against the loaded clean tables, as the
    # original queries ran against its database.  Each table is built from
    # the base tables once per session and written as Parquet into the
    # shared checkpoint folder (a written table survives executor loss and
    # keeps column pruning and size statistics); every later query reads it.
    def _table(self, name: str, view: DataFrame) -> DataFrame:
        from recordlens.session import ensure_checkpoint_dir
        base = ensure_checkpoint_dir(self.spark)
        if not base:
            return view
        path = f"{base.rstrip('/')}/recordlens-fixture-tables/{self._run_id}/{name}"
        view.write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def patents(self) -> DataFrame:
        return self._table("patents", self.patents_view)

    @cached_property
    def inventors(self) -> DataFrame:
        return self._table("inventors", self.inventors_view)

    @cached_property
    def companies(self) -> DataFrame:
        return self._table("companies", self.companies_view)

    @cached_property
    def relationships(self) -> DataFrame:
        return self._table("relationships", self.relationships_view)

    @cached_property
    def flat_clean_table(self) -> DataFrame:
        """The cleaned flat records, written once, as several table builds read them."""
        from recordlens.operators.flat import flat_clean
        return self._table("flat_clean", flat_clean(self.extracted_records))

    def build_clean_tables(self) -> dict[str, DataFrame]:
        """Write the four clean tables now (otherwise each is built on first use)."""
        return self.clean_tables()

    def clean_tables(self) -> dict[str, DataFrame]:
        return {"patents": self.patents, "inventors": self.inventors,
                "companies": self.companies, "relationships": self.relationships}


_CACHE: dict[tuple[str, str], FixtureViews] = {}


def fixture_views(spark: SparkSession, sf_dir: str) -> FixtureViews:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = FixtureViews(spark, sf_dir)
    return _CACHE[key]
