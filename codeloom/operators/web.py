"""Visit-attribution and consent rules over page/event tables.

The page script applies these one visitor at a time in a browser; here they
are stateless column rules over a page or event log, so the same functions
serve a batch ``DataFrame`` and a streaming one (see ``codeloom.streaming``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codeloom.functions.text import null_if_empty

# Event names, categories and the fallback label of the page
# script, and the 27 country codes for which a consent banner is shown.
SOURCE_VISIT = "source_visit"
TRAFFIC_SOURCE = "traffic_source"
LINK_CLICK = "resume_click"
ENGAGEMENT = "engagement"
DIRECT = "direct"
BANNER_COUNTRIES = ("AT", "BE", "BG", "HR", "CY", "CZ", "DK", "EE", "FI", "FR", "DE", "GR",
                    "HU", "IE", "IT", "LV", "LT", "LU", "MT", "NL", "PL", "PT", "RO", "SK",
                    "SI", "ES", "SE")

# An opening link tag, and one attribute with its value; both take quoted values whole.
LINK_TAG = r"""(?i)<a(?=\s)(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
ATTRIBUTE = r"""\s([^\s=>"'/]++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)"""


def _decoded(c: Column) -> Column:
    """Form decoding: ``+`` is a space, ``%xx`` a byte; a stray percent sign stands for itself."""
    return F.call_function("try_url_decode", F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def query_param(url: str | Column, key: str) -> Column:
    """V1: first value of a query-string parameter, form-decoded as a browser does.

    Any text is a URL: only the part between the first ``?`` and ``#`` counts,
    names may be percent-encoded, and a name without ``=`` has an empty value.
    NULL without the parameter.
    """
    u = F.col(url) if isinstance(url, str) else url
    query = F.regexp_extract(u, r"(?s)^[^?#]*\?([^#]*)", 1)
    own = F.filter(F.split(query, "&"), lambda p: _decoded(F.regexp_extract(p, r"(?s)^[^=]*", 0)) == key)
    return _decoded(F.regexp_extract(F.get(own, F.lit(0)), r"(?s)^[^=]*=?(.*)$", 1))


def utm_params(df: DataFrame, url: str = "url") -> DataFrame:
    """V1: add ``utm_source`` and ``utm_campaign``."""
    return (df.withColumn("utm_source", query_param(url, "utm_source"))
              .withColumn("utm_campaign", query_param(url, "utm_campaign")))


def source_visit_events(df: DataFrame) -> DataFrame:
    """V2/V3: one event per visit with a non-empty source; label ``source[ | campaign]``."""
    src = null_if_empty("utm_source")
    camp = null_if_empty("utm_campaign")
    return (df.where(src.isNotNull())
              .withColumn("event_name", F.lit(SOURCE_VISIT))
              .withColumn("event_category", F.lit(TRAFFIC_SOURCE))
              .withColumn("event_label", F.concat_ws(" | ", src, camp)))


def link_click_events(df: DataFrame, needle: str, html: str = "html") -> DataFrame:
    """V4: one event per link whose href contains ``needle``; label source or ``direct``.

    Links are the ``<a>`` tags of the whole page text outside comments, in any
    letter case, with a quoted or unquoted ``href`` attribute of their own
    (``&amp;`` decoded); one output row per link.
    """
    tags = F.regexp_extract_all(F.regexp_replace(F.col(html), "(?s)<!--.*?-->", ""), F.lit(LINK_TAG), F.lit(0))
    links = df.withColumn("__tag", F.explode(tags))
    attributes = F.regexp_extract_all(F.col("__tag"), F.lit(ATTRIBUTE), F.lit(0))
    own = F.get(F.filter(attributes, lambda x: F.lower(F.regexp_extract(x, ATTRIBUTE, 1)) == "href"), F.lit(0))
    value = F.regexp_replace(F.regexp_extract(own, ATTRIBUTE, 2), """^["']|["']$""", "")
    links = links.withColumn("href", F.replace(value, F.lit("&amp;"), F.lit("&"))).drop("__tag")
    return (links.where(F.col("href").contains(needle))
                 .withColumn("event_name", F.lit(LINK_CLICK))
                 .withColumn("event_category", F.lit(ENGAGEMENT))
                 .withColumn("event_label", F.coalesce(null_if_empty("utm_source"), F.lit(DIRECT))))


def consent_action(consent: str | Column, country: str | Column,
                   banner_countries: Sequence[str] = BANNER_COUNTRIES) -> Column:
    """V5: stored consent -> ``none``; banner country -> ``banner``; else ``track``.

    The page tests the stored value for truthiness, so an empty string counts
    as no consent; NULL country is not a banner country, hence ``track``.
    """
    c = null_if_empty(F.col(consent) if isinstance(consent, str) else consent)
    k = F.col(country) if isinstance(country, str) else country
    return (F.when(c.isNotNull(), F.lit("none"))
            .when(k.isin(list(banner_countries)), F.lit("banner"))
            .otherwise(F.lit("track")))


def json_field(col: str | Column, field: str, cast: str = "int") -> Column:
    """V6: one top-level field of a JSON text column (NULL when absent or not castable)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.get_json_object(c, f"$['{field}']").try_cast(cast)
