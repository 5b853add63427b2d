"""DOI and link expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import EDGE_BEFORE, WS, as_col, strip, stripped_or_empty

# A run of characters that can belong to a DOI suffix: no whitespace, angle brackets or quotes.
_NOT_SPACE = WS.replace("[", "[^", 1)
_DOI_RUN = _NOT_SPACE[:-1] + "<>\"']+"
DOI_IN_TEXT = rf"{EDGE_BEFORE}(10\.[0-9]{{4,9}}/{_DOI_RUN})"
DOI_LOOSE = rf"10\.[0-9]{{4,9}}/{_NOT_SPACE}+"

# Query parameters that only track the visitor.
TRACKING_PARAMETERS = ("utm_[^=&]+", "spm", "fbclid", "gclid")


def doi_in(c: Column | str) -> Column:
    """First DOI in a text, without the closing punctuation that tends to follow it."""
    found = F.nullif(F.regexp_extract(as_col(c), DOI_IN_TEXT, 1), F.lit(""))
    return F.regexp_replace(found, r"[).,;]+\z", "")


def guess_doi(*candidates: Column | str) -> Column:
    return F.coalesce(*(doi_in(c) for c in candidates))


def ingest_doi(c: Column | str) -> Column:
    """DOI key used when articles are stored: resolver address or ``doi:`` label removed, lower case."""
    c = F.regexp_replace(strip(c), r"(?i)^https?://(dx\.)?doi\.org/", "")
    c = F.regexp_replace(c, rf"(?i)^doi:{WS}*", "")
    return F.nullif(F.lower(strip(c)), F.lit(""))


def lookup_doi(c: Column | str) -> Column:
    """DOI key used when a user looks articles up; more lenient about schemes and slashes, never NULL."""
    c = F.regexp_replace(stripped_or_empty(c), r"(?i)^(https?://)?(dx\.)?doi\.org/", "")
    c = strip(F.replace(c, F.lit("doi:"), F.lit("")))
    return F.lower(F.regexp_replace(c, r"^/+|/+\z", ""))


def publisher_doi(c: Column | str) -> Column:
    """Remove a leading ``doi:`` and then a leading https resolver address."""
    c = strip(F.regexp_replace(strip(c), r"(?i)^doi:", ""))
    return F.nullif(strip(F.regexp_replace(c, r"(?i)^https://doi\.org/", "")), F.lit(""))


def normalize_link(c: Column | str) -> Column:
    """Drop tracking parameters, dangling separators and one trailing slash."""
    names = "|".join(TRACKING_PARAMETERS)
    c = F.regexp_replace(strip(c), rf"(?i)([?&])({names})=[^&#]*", "$1")
    c = F.regexp_replace(c, r"[?&]+\z", "")
    return F.when(F.length(c) > 1, F.regexp_replace(c, r"/\z", "")).otherwise(c)


def domain_of(c: Column | str) -> Column:
    """Lower-case authority part; empty for text without one, NULL for NULL or empty input."""
    c = as_col(c)
    authority = F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    return F.when(c != "", F.lower(authority))


def host_in(c: Column | str, suffix: str, compat: bool = False) -> Column:
    """Whether a link belongs to ``suffix`` or one of its subdomains; ``compat`` drops the dot guard."""
    domain = F.coalesce(domain_of(c), F.lit(""))
    if compat:
        return domain.endswith(suffix)
    return (domain == suffix) | domain.endswith("." + suffix)


def is_html_type(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit("")).rlike("(?i)text/html")
