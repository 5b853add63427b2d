"""String expressions. Everything is native except the rare strings with unusual HTML entities."""

from __future__ import annotations

import html
import sys
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Ship the entity decoder by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Unicode whitespace in classes on which Java and RE2 agree.
WS = r"[\p{Z}\t-\r\x1C-\x1F\x85]"
WS_CHARS = (
    " \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Word edges for Unicode text; \b is ASCII-only or inconsistent between engines.
WORD = r"[\p{L}\p{N}_]"
EDGE_BEFORE = rf"(?<!{WORD})"
EDGE_AFTER = rf"(?!{WORD})"

# Ampersands that native replacement decodes exactly, even when decoding is applied twice.
_PLAIN_AMPERSANDS = r"&(?!(?:lt|gt|quot);|amp;(?=[\t\n\f <&]|\z)|[\t\n\f <&]|\z)"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Whitespace removed at both ends; looks at the ends only, whatever the length of the text."""
    return F.trim(as_col(c), F.lit(WS_CHARS))


def blank_to_null(c: Column | str) -> Column:
    """Stripped text, NULL when nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def stripped_or_empty(c: Column | str) -> Column:
    return F.coalesce(strip(c), F.lit(""))


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*(F.nullif(as_col(c), F.lit("")) for c in cols))


def changed(new: Column, old: Column) -> Column:
    """Null-safe inequality."""
    return ~new.eqNullSafe(old)


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(as_col(c).cast("binary"), 256)


def show_value(c: Column | str) -> Column:
    """Printable form for change reports."""
    c = as_col(c).cast("string")
    return F.when(c.isNull(), "(NULL)").when(strip(c) == "", "(EMPTY)").otherwise(c)


def truncate(c: Column | str, limit: int, suffix: str = "") -> Column:
    c = as_col(c)
    return F.when(F.length(c) > limit, F.concat(F.substr(c, F.lit(1), F.lit(limit)), F.lit(suffix))).otherwise(c)


def _decode(text: str | None, times: int) -> str | None:
    for _ in range(times if text is not None else 0):
        text = html.unescape(text)
    return text


def by_rows(fn: Callable, column: pa.Array, kind: pa.DataType, rows: int = 500) -> pa.Array:
    """``fn`` of each value that is not null. Of a batch, whatever its size, few rows at a time are Python objects."""
    parts = (column.slice(k, rows) for k in range(0, len(column), rows))
    made = [pa.array([None if v is None else fn(v) for v in part.to_pylist()] if part.null_count < len(part) else [None] * len(part), kind) for part in parts]
    return pa.concat_arrays(made) if made else pa.array([], kind)


@F.arrow_udf(T.ArrayType(T.StringType()))
def _decode_once(lists: pa.Array) -> pa.Array:
    return by_rows(lambda texts: [_decode(t, 1) for t in texts], lists, pa.list_(pa.string()))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _decode_twice(lists: pa.Array) -> pa.Array:
    return by_rows(lambda texts: [_decode(t, 2) for t in texts], lists, pa.list_(pa.string()))


def _decode_plain(c: Column) -> Column:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def unescape_all(texts: Column, times: int = 1) -> Column:
    """HTML entity decoding of an array of texts.

    Texts without ``&`` or with only the XML entities stay in the JVM. A row with others goes through one Arrow
    batch; the remaining rows travel as NULL.
    """
    decoder = {1: _decode_once, 2: _decode_twice}[times]
    unusual = F.exists(texts, lambda t: t.rlike(_PLAIN_AMPERSANDS))
    return F.coalesce(decoder(F.when(unusual, texts)), F.transform(texts, _decode_plain))


def unescape(c: Column | str, times: int = 1) -> Column:
    return F.get(unescape_all(F.array(as_col(c)), times), F.lit(0))


def clean_all(texts: Column, decode: int = 1) -> Column:
    """``clean_text`` of an array of texts, in one step for all of them."""
    return F.transform(unescape_all(texts, decode), collapse_spaces)


def collapse_spaces(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(as_col(c), rf"{WS}+", " "))


def clean_text(c: Column | str, decode: int = 1) -> Column:
    """Decode entities (once per parsing layer), collapse whitespace, strip."""
    return collapse_spaces(unescape(c, decode) if decode else as_col(c))


def json_quote(c: Column | str) -> Column:
    """A JSON string literal with non-ASCII characters kept."""
    c = as_col(c)
    for raw, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
                         ("\b", "\\b"), ("\f", "\\f")):
        c = F.replace(c, F.lit(raw), F.lit(escaped))
    with_controls = F.aggregate(
        F.sequence(F.lit(0), F.lit(31)),
        c,
        lambda acc, i: F.replace(
            acc, F.char(i), F.concat(F.lit("\\u00"), F.lpad(F.lower(F.hex(i)), 2, "0"))
        ),
    )
    return F.concat(F.lit('"'), F.when(c.rlike(r"[\x00-\x1F]"), with_controls).otherwise(c), F.lit('"'))


def json_value(c: Column | str) -> Column:
    c = as_col(c)
    return F.coalesce(json_quote(c), F.lit("null"))
