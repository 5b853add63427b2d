"""Article-level rules: better abstracts and article types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import as_col, stripped_or_empty

# Article types by lower-case name.
ARTICLE_TYPES = {
    "article": "Article",
    "research article": "Article",
    "review article": "Review",
    "review": "Review",
    "brief communication": "Brief Communication",
    "letter": "Letter",
    "analysis": "Analysis",
    "perspective": "Perspective",
    "correspondence": "Correspondence",
    "editorial": "Editorial",
    "comment": "Comment",
    "news": "News",
    "news & views": "News & Views",
    "research highlight": "Research Highlight",
    "careers": "Careers",
}


def article_type(c: Column | str) -> Column:
    """Canonical label of a known article type; unknown types stay as they are."""
    c = as_col(c)
    table = F.create_map(*(F.lit(x) for pair in ARTICLE_TYPES.items() for x in pair))
    return F.coalesce(F.element_at(table, F.lower(c)), c)


def is_better_abstract(old: Column | str, new: Column | str) -> Column:
    """Fill a gap, take a text at least 20 characters longer, or replace a stub under 80 characters."""
    old, new = stripped_or_empty(old), stripped_or_empty(new)
    gain = F.length(new) - F.length(old)
    return (new != "") & (new != old) & ((old == "") | (gain >= 20) | (F.length(old) < 80))
