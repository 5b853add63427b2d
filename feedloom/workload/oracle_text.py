"""SQL fragments for the checking engine (DuckDB dialect)."""

from __future__ import annotations

from feedloom.functions.topics import TOPIC_TERMS
from feedloom.schemas import DEFAULT_TOPIC, TOPICS


def ingest_doi(c: str) -> str:
    return (
        rf"nullif(lower(trim(regexp_replace(regexp_replace(trim({c}), '^https?://(dx\.)?doi\.org/', '', 'i'),"
        rf" '^doi:\s*', '', 'i'))), '')"
    )


def lookup_doi(c: str) -> str:
    bare = rf"regexp_replace(trim(coalesce({c}, '')), '^(https?://)?(dx\.)?doi\.org/', '', 'i')"
    return f"lower(trim(trim(replace({bare}, 'doi:', '')), '/'))"


def link(c: str) -> str:
    s = rf"regexp_replace(trim({c}), '([?&])(utm_[^=&]+|spm|fbclid|gclid)=[^&#]*', '\1', 'gi')"
    s = f"regexp_replace({s}, '[?&]+$', '')"
    return f"CASE WHEN length({s}) > 1 THEN regexp_replace({s}, '/$', '') ELSE {s} END"


def json_string(c: str) -> str:
    return f"""coalesce('"' || replace({c}, '"', '\\"') || '"', 'null')"""


def uid() -> str:
    fields = ("doi", "id_like", "journal", "link", "pub_date", "title")
    json = "'{' || " + " || ', ' || ".join(f"""'"{f}": ' || {json_string(f)}""" for f in fields) + " || '}'"
    return (
        f"coalesce('doi:' || {ingest_doi('doi')}, 'id:' || nullif(id_like, ''),"
        f" 'linkhash:' || substr(sha256(nullif({link('link')}, '')), 1, 24), 'hash:' || substr(sha256({json}), 1, 24))"
    )


def collapse(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def tags(c: str) -> str:
    """Stored tag text as a list."""
    listed = rf"""string_split(regexp_replace({c}, '[\["\]]', '', 'g'), ', ')"""
    return f"CASE WHEN coalesce({c}, '') = '' THEN CAST([] AS VARCHAR[]) WHEN {c} LIKE '[%' THEN {listed} ELSE [{c}] END"


def topic_list(topics=TOPICS) -> str:
    return "[" + ", ".join(f"'{t}'" for t in topics) + "]"


def has_topic(c: str, topics=TOPICS) -> str:
    return f"len(list_intersect({tags(c)}, {topic_list(topics)})) > 0"


def primary_topic(text: str) -> str:
    edge = r"[^\p{L}\p{N}_]"
    whens = " ".join(
        f"WHEN regexp_matches({text}, '(^|{edge})({'|'.join(terms)})($|{edge})') THEN '{topic}'"
        for topic, terms in TOPIC_TERMS.items()
    )
    return f"CASE {whens} ELSE '{DEFAULT_TOPIC}' END"


def incomplete(c: str) -> str:
    s = f"trim({c})"
    return (
        f"CASE WHEN {c} IS NULL OR {c} = '' THEN true WHEN regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') THEN false"
        f" WHEN regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}$') THEN true ELSE length({s}) < 10 END"
    )


def better(old: str, new: str) -> str:
    o, n = strip(f"coalesce({old}, '')"), strip(f"coalesce({new}, '')")
    return (
        f"CASE WHEN {n} = '' THEN false WHEN {o} = '' THEN true WHEN {n} = {o} THEN false"
        f" WHEN length({n}) - length({o}) >= 20 THEN true WHEN length({o}) < 80 THEN true ELSE false END"
    )
