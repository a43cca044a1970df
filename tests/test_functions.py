from pyspark.sql import functions as F

from recordlens.functions.country import country_to_iso3, normalize_country
from recordlens.functions.text import normalize_header, snake_case, strip_ws


def _apply(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


def test_normalize_country(spark):
    vals = [" usa ", "Hong Kong", "Austria", "Finland", "U.S.A.", "", None, "1X", "deutschland", "NA"]
    assert _apply(spark, vals, normalize_country) == ["US", "HK", "AU", "FI", None, None, None, None, "DE", "NA"]


def test_normalize_country_strict(spark):
    vals = ["Austria", "usa", "ZZ"]
    assert _apply(spark, vals, lambda c: normalize_country(c, strict=True)) == [None, "US", None]


def test_country_to_iso3(spark):
    vals = ["JPX", "DEX", "HK", "XYZ", "FI", " us ", None, "A1B"]
    assert _apply(spark, vals, country_to_iso3) == ["JPN", "DEU", None, "XYZ", None, "USA", None, None]


def test_strip_all_whitespace(spark):
    vals = ["\t a b \n", " x ", "  "]
    assert _apply(spark, vals, strip_ws) == ["a b", "x", ""]


def test_header_normalisers():
    assert snake_case("Patent ID") == "patent_id"
    assert snake_case("patentTitle") == "patent_title"
    assert snake_case(" inventor-name ") == "inventor_name"
    assert normalize_header(' "Country" ') == "country"


def test_nullif_blank(spark):
    from recordlens.functions.text import blank_to_null
    assert _apply(spark, ["", " ", "x"], lambda c: blank_to_null(c, strip=True)) == [None, None, "x"]
    assert _apply(spark, ["a"], lambda c: F.upper(c)) == ["A"]


def test_search_regex_and_literal(spark):
    from recordlens.operators.explore import search_inventors, search_patents
    p = spark.createDataFrame([("1", "A.C motor", None), ("2", "abc", "x"), ("3", None, "ABC drive")],
                              "patent_id string, title string, abstract string")
    regex = sorted(r.patent_id for r in search_patents(p, "a.c").collect())
    literal = sorted(r.patent_id for r in search_patents(p, "a.c", literal=True).collect())
    assert regex == ["1", "2", "3"] and literal == ["1"]
    assert search_patents(p, "").count() == 3          # empty keyword: no filter
    inv = spark.createDataFrame([("Ann Lee",), ("BOB",), (None,)], "name string")
    assert [r.name for r in search_inventors(inv, "^b").collect()] == ["BOB"]


def test_iso_date_takes_whole_values_only(spark):
    from recordlens.functions.dates import year_of
    vals = ["2018-04-10", "2018-04-10garbage", "2018-04-10T99", "2018-04-10T08:30", "2018-04-10 08:30:15.5Z", "04/10/2018", "", None]
    assert _apply(spark, vals, year_of) == [2018, None, None, 2018, 2018, None, None, None]


def test_lenient_dates(spark):
    import datetime
    from recordlens.functions.dates import parse_date_lenient
    day = datetime.date(2018, 4, 10)
    good = ["2018-04-10", " 2018-4-10 ", "04/10/2018", "4/10/2018", "2018/04/10", "20180410", "April 10, 2018", "APR 10, 2018", "10 april 2018",
            "10-Apr-2018", "2018-04-10T08:00", "04/10/2018 08:00:00"]
    assert _apply(spark, good, parse_date_lenient) == [day] * len(good)
    assert _apply(spark, ["2018-04-10garbage", "2018-04-10T99", "13/45/2018", "soon", "", None], parse_date_lenient) == [None] * 6


def test_snake_case_rules():
    for name, want in (("IPCClass", "ipcclass"), ("a  b--C", "a_b_c"), ("disamb_assigneeId2020A", "disamb_assignee_id2020_a"), ("__x__", "x"), ("Größe Max", "größe_max"), ("", "")):
        assert snake_case(name) == want


def test_pages_beyond_a_million_rows(spark):
    from recordlens.operators.explore import page_count, patent_page
    rows = spark.range(1_000_250).selectExpr("lpad(cast(id as string), 9, '0') as patent_id")
    assert tuple(page_count(rows).first()) == (1_000_250, 10_003)
    assert patent_page(rows, page=10_002).count() == 100 and patent_page(rows, page=10_003).count() == 50
    assert tuple(page_count(rows, window=1000).first()) == (1000, 10)
