"""Link discovery in web pages and file rows from nested JSON manifests.

Extraction is JVM-side (``regexp_extract_all`` over the page text, then
``explode``); only the short extracted link strings pass through a
vectorised pandas UDF that applies the exact HTML-entity decoding and URL
resolution rules of the standard library (thousands of named entities and
RFC 3986 dot-segment handling are not expressible as Column expressions).
"""

from __future__ import annotations

import html
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlens.functions.text import WHITESPACE

# The three link patterns (attribute links, absolute archive
# URLs in text, root-relative archive paths in text).
HREF_PATTERN = r"""(?i)href=["']([^"']+)["']"""
ABSOLUTE_ZIP_PATTERN = r"""(?i)(https?://[^"'\s<>]+\.zip(?:\?[^"'\s<>]*)?)"""
RELATIVE_ZIP_PATTERN = r"""(?i)(/[^"'\s<>]+\.zip(?:\?[^"'\s<>]*)?)"""


@F.pandas_udf(T.StringType())
def resolve_link(base: pd.Series, link: pd.Series) -> pd.Series:
    """html-unescape the stripped link and resolve it against the page URL."""
    return pd.Series([None if (b is None or l is None) else urljoin(b, html.unescape(l.strip()))
                      for b, l in zip(base, link)], dtype=object)


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html",
               id_col: str = "page_id") -> DataFrame:
    """Distinct absolute links per page from the three candidate lists."""
    cands = F.concat(
        F.regexp_extract_all(F.col(html_col), F.lit(HREF_PATTERN), 1),
        F.regexp_extract_all(F.col(html_col), F.lit(ABSOLUTE_ZIP_PATTERN), 1),
        F.regexp_extract_all(F.col(html_col), F.lit(RELATIVE_ZIP_PATTERN), 1),
    )
    raw = (pages.where(F.col(url_col).isNotNull() & F.col(html_col).isNotNull())
           .select(id_col, url_col, F.explode(F.array_distinct(cands)).alias("_cand"))
           .withColumn("_cand", F.btrim("_cand", F.lit(WHITESPACE))).distinct())
    # Absolute links and rooted paths without entities, dot segments or empty
    # tails resolve by concatenation; only the others go through Python.
    cand, base = F.col("_cand"), F.col(url_col)
    origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    plain = ~cand.contains("&") & ~cand.rlike(r"/\.{1,2}(?:[/?#]|$)|[?#;]$|[?;]#|[\x00-\x1f]")
    absolute = plain & cand.rlike(r"^https?://[^/?#]+/")
    rooted = plain & cand.rlike(r"^/[^/]") & base.rlike(r"^https?://[^/?#]+")
    simple = F.when(absolute, cand).when(rooted, F.concat(origin, cand))
    odd = simple.isNull()
    resolved = raw.select(id_col, simple.alias("_simple"), resolve_link(F.when(odd, base), F.when(odd, cand)).alias("_odd"))
    return resolved.select(id_col, F.coalesce("_simple", "_odd").alias("link")).distinct()


def page_archives(links: DataFrame, link_col: str = "link") -> DataFrame:
    """Only links whose URL path ends in .zip (case-insensitive)."""
    path = F.regexp_extract(F.col(link_col), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return links.where(F.lower(path).endswith(".zip"))


# Nested manifest: products -> file bag -> list of files.
_FILE = T.StructType([T.StructField("fileName", T.StringType()),
                      T.StructField("fileDownloadURI", T.StringType()),
                      T.StructField("fileSize", T.StringType())])
_BAG = T.StructType([T.StructField("fileDataBag", T.ArrayType(_FILE))])
_PRODUCT = T.StructType([T.StructField("bulkDataFileBag", _BAG), T.StructField("productFileBag", _BAG)])
MANIFEST_SCHEMA = T.StructType([
    T.StructField("bulkDataProductBags", T.ArrayType(_PRODUCT)),
    T.StructField("bulkDataProductBag", T.ArrayType(_PRODUCT)),
])


def _first_filled(*lists):
    """The first list that has an element (explode skips the null of none)."""
    return F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])


def manifest_files(manifests: DataFrame, json_col: str, base_url: str,
                   name_pattern: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """File rows (name, url, size) from JSON manifests, one row per listed file.

    Either product-list spelling and either file-bag spelling is accepted;
    entries without name or URL are skipped, only ``.zip`` names are kept,
    optionally filtered by a case-insensitive ``name_pattern``; relative
    URIs are prefixed with ``base_url``; size becomes a long or null.
    """
    parsed = manifests.select(*keep, F.from_json(F.col(json_col), MANIFEST_SCHEMA).alias("_m"))
    products = _first_filled(F.col("_m.bulkDataProductBags"), F.col("_m.bulkDataProductBag"))
    prod = parsed.select(*keep, F.explode(products).alias("_p"))
    files = _first_filled(F.col("_p.bulkDataFileBag.fileDataBag"), F.col("_p.productFileBag.fileDataBag"))
    f = prod.select(*keep, F.explode(files).alias("_f"))
    name, url, size = F.col("_f.fileName"), F.col("_f.fileDownloadURI"), F.col("_f.fileSize")
    cond = (name.isNotNull() & (name != "") & url.isNotNull() & (url != "")
            & F.lower(name).endswith(".zip"))
    if name_pattern:
        cond = cond & name.rlike("(?i)" + name_pattern)
    full = F.when(url.startswith("http"), url).otherwise(F.concat(F.lit(base_url), url))
    sz = F.nullif(size, F.lit("")).try_cast("long")
    return f.where(cond).select(*keep, name.alias("name"), full.alias("url"),
                                sz.alias("size"))


def json_props(df: DataFrame, json_col: str, fields: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed fields pulled out of a JSON text column (bad JSON / type -> null)."""
    return df.select(*keep, *[F.get_json_object(F.col(json_col), f"$.{name}").try_cast(dtype).alias(name)
                              for name, dtype in fields.items()])
