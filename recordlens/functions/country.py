"""Country text -> ISO codes as Column expressions.

Both lookups are literal maps (constant-folded, evaluated inside whole-stage
codegen); the fallbacks are regex tests on the normalised text.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordlens.functions.text import as_col, strip_ws

# Variant spelling -> ISO 3166-1 alpha-2 code.
ISO2_VARIANTS = {
    "US": "US", "USA": "US", "UNITED STATES": "US", "UNITED STATES OF AMERICA": "US",
    "GB": "GB", "UK": "GB", "UNITED KINGDOM": "GB", "GREAT BRITAIN": "GB",
    "JP": "JP", "JAPAN": "JP",
    "DE": "DE", "GERMANY": "DE", "DEUTSCHLAND": "DE",
    "FR": "FR", "FRANCE": "FR",
    "CA": "CA", "CANADA": "CA",
    "CN": "CN", "CHINA": "CN",
    "IN": "IN", "INDIA": "IN",
    "BR": "BR", "BRAZIL": "BR",
    "AU": "AU", "AUSTRALIA": "AU",
    "NL": "NL", "NETHERLANDS": "NL", "HOLLAND": "NL",
    "KR": "KR", "SOUTH KOREA": "KR", "KOREA": "KR",
    "SG": "SG", "SINGAPORE": "SG",
    "CH": "CH", "SWITZERLAND": "CH", "SWISS": "CH",
    "SE": "SE", "SWEDEN": "SE",
    "NO": "NO", "NORWAY": "NO",
    "DK": "DK", "DENMARK": "DK",
    "IT": "IT", "ITALY": "IT",
    "ES": "ES", "SPAIN": "ES",
    "MX": "MX", "MEXICO": "MX",
    "RU": "RU", "RUSSIA": "RU", "RUSSIAN FEDERATION": "RU",
    "IL": "IL", "ISRAEL": "IL",
    "TW": "TW", "TAIWAN": "TW",
    "HK": "HK", "HONG KONG": "HK",
}

# Country text -> ISO 3166-1 alpha-3 code used for map rendering.
ISO3_VARIANTS = {
    "US": "USA", "USA": "USA", "UNITED STATES": "USA", "UNITED STATES OF AMERICA": "USA",
    "JP": "JPN", "JPN": "JPN", "JPX": "JPN", "JAPAN": "JPN",
    "DE": "DEU", "DEU": "DEU", "DEX": "DEU", "GERMANY": "DEU",
    "FR": "FRA", "FRA": "FRA", "FRANCE": "FRA",
    "GB": "GBR", "UK": "GBR", "GBR": "GBR", "UNITED KINGDOM": "GBR",
    "DK": "DNK", "DNK": "DNK", "DKX": "DNK", "DENMARK": "DNK",
    "KR": "KOR", "KOR": "KOR", "KOREA": "KOR", "SOUTH KOREA": "KOR",
    "CN": "CHN", "CHN": "CHN", "CHINA": "CHN",
    "TW": "TWN", "TWN": "TWN", "TAIWAN": "TWN",
    "CA": "CAN", "CAN": "CAN", "CANADA": "CAN",
    "IL": "ISR", "ISR": "ISR", "ISRAEL": "ISR",
    "BR": "BRA", "BRA": "BRA", "BRAZIL": "BRA",
    "IN": "IND", "IND": "IND", "INDIA": "IND",
    "AU": "AUS", "AUS": "AUS", "AUSTRALIA": "AUS",
    "NL": "NLD", "NLD": "NLD", "NETHERLANDS": "NLD",
    "CH": "CHE", "CHE": "CHE", "SWITZERLAND": "CHE",
    "SE": "SWE", "SWE": "SWE", "SWEDEN": "SWE",
    "NO": "NOR", "NOR": "NOR", "NORWAY": "NOR",
    "ES": "ESP", "ESP": "ESP", "SPAIN": "ESP",
    "IT": "ITA", "ITA": "ITA", "ITALY": "ITA",
    "MX": "MEX", "MEX": "MEX", "MEXICO": "MEX",
    "RU": "RUS", "RUS": "RUS", "RUSSIA": "RUS",
    "SG": "SGP", "SGP": "SGP", "SINGAPORE": "SGP",
}


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def _norm_upper(c: str | Column) -> Column:
    return F.nullif(F.upper(strip_ws(as_col(c))), F.lit(""))


def normalize_country(c: str | Column, strict: bool = False) -> Column:
    """Country text -> alpha-2 code.

    Strip, upper-case, look up the variant table; otherwise the first two
    characters when both are letters (so ``AUSTRIA`` gives ``AU``), else
    null.  ``strict=True`` skips that two-letter fallback.
    """
    v = _norm_upper(c)
    hit = F.element_at(_literal_map(ISO2_VARIANTS), v)
    if strict:
        return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(hit)
    head = F.substring(v, 1, 2)
    fallback = F.when(head.rlike(r"^\p{L}{2}$"), head)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(hit, fallback))


def country_to_iso3(c: str | Column) -> Column:
    """Country text -> alpha-3 code; three letters pass through, else null."""
    v = _norm_upper(c)
    hit = F.element_at(_literal_map(ISO3_VARIANTS), v)
    fallback = F.when(v.rlike(r"^\p{L}{3}$"), v)
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(F.coalesce(hit, fallback))
