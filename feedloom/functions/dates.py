"""Date expressions over the free-text dates that feeds and pages carry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import WS, as_col, strip

# English month names in calendar order.
MONTHS = ("january", "february", "march", "april", "may", "june", "july",
          "august", "september", "october", "november", "december")

# Words that may stand in a date without meaning; weekdays; zone names.
_FILLERS = ("at", "on", "and", "ad", "of", "mon", "monday", "tue", "tues", "tuesday", "wed", "wednesday",
            "thu", "thur", "thurs", "thursday", "fri", "friday", "sat", "saturday", "sun", "sunday")
_ZONES = "z|utc|gmt|est|edt|cst|cdt|mst|mdt|pst|pdt|bst|cet|cest|jst"

_TIME = (r"(?<![0-9:])[0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?[ ]*(?:[ap]m(?![a-z]))?"
         rf"[ ]*(?:(?:{_ZONES})(?![a-z]))?[ ]*(?:[+-][0-9]{{2}}:?[0-9]{{2}}(?![0-9]))?")
_DAY_MONTH_YEAR = rf"([0-9]{{1,2}}){WS}+([A-Za-z]+){WS}+([0-9]{{4}})"


def local_time(at: datetime) -> Column:
    """A zone-free timestamp literal; independent of the session's and the driver's time zones."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def human_date(c: Column | str) -> Column:
    """First ``day MonthName year`` in a text as ``yyyy-MM-dd``; the day is not range-checked."""
    c = as_col(c)
    month_no = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.regexp_extract(c, _DAY_MONTH_YEAR, 2)))
    day = F.regexp_extract(c, _DAY_MONTH_YEAR, 1)
    year = F.regexp_extract(c, _DAY_MONTH_YEAR, 3)
    return F.when(
        month_no > 0,
        F.concat_ws("-", year, F.lpad(month_no.cast("string"), 2, "0"), F.lpad(day, 2, "0")),
    )


def iso_date_prefix(c: Column | str) -> Column:
    """The first ten characters when they look like ``yyyy-MM-dd``."""
    head = F.substr(as_col(c), F.lit(1), F.lit(10))
    return F.when(head.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), head)


def is_incomplete_date(c: Column | str) -> Column:
    c = as_col(c)
    s = strip(c)
    return (
        F.when(c.isNull() | (c == ""), True)
        .when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), False)
        .when(s.rlike(r"^[0-9]{4}-[0-9]{2}\z"), True)
        .otherwise(F.length(s) < 10)
    )


def _bind(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _words(c: Column) -> Column:
    """The numbers and month names of a date in order, as lower-case words; NULL where something else stands."""
    s = F.regexp_replace(F.lower(strip(c)), r"(?<=[0-9])t(?=[0-9]{2})", " ")
    s = F.regexp_replace(s, _TIME, " ")
    s = F.regexp_replace(s, r"(?<=[0-9])(?:st|nd|rd|th)(?![a-z0-9])", "")
    plain = s.rlike(rf"^(?:[0-9a-z]|[-/.,;']|{WS})+\z") & ~s.rlike(r"[0-9][a-z]|[a-z][0-9]") & ~s.rlike(r"^[0-9]+[.,][0-9]+\z")
    words = F.filter(F.regexp_extract_all(s, F.lit("([0-9]+|[a-z]+)"), 1), lambda w: ~w.isin(*_FILLERS))
    return F.when(plain, words)


def _month_number(word: Column) -> Column:
    """1 to 12 for a month's name or its first three letters, else NULL."""
    rule = None
    for number, name in enumerate(MONTHS, 1):
        names = {name, name[:3], *(("sept",) if number == 9 else ())}
        hit = word.isin(*sorted(names))
        rule = F.when(hit, number) if rule is None else rule.when(hit, number)
    return rule


def _year(number: Column, century: int) -> Column:
    """Two digits mean the year nearest to ``century``."""
    n = number.try_cast("int")
    near = n + century // 100 * 100
    moved = F.when(near >= century + 50, near - 100).when(near < century - 50, near + 100).otherwise(near)
    return F.when(F.length(number) > 2, n).otherwise(moved)


def _ordered(words: Column, century: int) -> Column:
    """``yyyy-M-d`` of at most three words, by what each can be: names are months, more than two digits or more than 31
    a year; without either, month, day, year, or day, month, year where the first cannot be a month."""
    at = lambda k: F.get(words, F.lit(k))
    big = lambda w: (F.length(w) > 2) | (w.try_cast("int") > 31)
    number = lambda w: w.rlike(r"^[0-9]{1,4}\z")
    date = lambda y, m, d: F.concat_ws("-", F.lpad(_year(y, century).cast("string"), 4, "0"), m.cast("string"), d)
    part = lambda w, start, n: F.substr(w, F.lit(start), F.lit(n))
    packed = lambda w: date(part(w, 1, 4), part(w, 5, 2).try_cast("int"), part(w, 7, 2))
    one = F.lit("1")

    def named(m: Column, a: Column, b: Column, year_first: Column) -> Column:
        return F.when(number(a) & number(b), F.when(year_first, date(a, m, b)).otherwise(date(b, m, a)))

    def three(a: Column, b: Column, c: Column) -> Column:
        month = _month_number
        return (
            F.when(month(a).isNotNull(), named(month(a), b, c, big(b) & (F.length(c) < 3)))
            .when(month(b).isNotNull(), named(month(b), a, c, big(a) & (F.length(c) < 3)))
            .when(month(c).isNotNull(), named(month(c), a, b, ~big(b)))
            .when(~(number(a) & number(b) & number(c)), None)
            .when(big(a), date(a, b.try_cast("int"), c))
            .when(a.try_cast("int") > 12, date(c, b.try_cast("int"), a))
            .otherwise(date(c, a.try_cast("int"), b))
        )

    def two(a: Column, b: Column) -> Column:
        return (
            F.when(a.rlike(r"^[0-9]{8}\z") & b.rlike(r"^(?:[0-9]{4}|[0-9]{6})\z"), packed(a))  # with a time
            .when(_month_number(a).isNotNull(), F.when(number(b) & big(b), date(b, _month_number(a), one)))
            .when(_month_number(b).isNotNull(), F.when(number(a) & big(a), date(a, _month_number(b), one)))
            .when(~(number(a) & number(b)), None)
            .when(big(a), date(a, b.try_cast("int"), one))
            .when(big(b), date(b, a.try_cast("int"), one))
        )

    alone = F.when(at(0).rlike(r"^[0-9]{4}\z"), date(at(0), F.lit(1), one)).when(
        at(0).rlike(r"^[0-9]{8}(?:[0-9]{4}|[0-9]{6})?\z"), packed(at(0))).when(
        at(0).rlike(r"^[0-9]{6}\z"), three(part(at(0), 1, 2), part(at(0), 3, 2), part(at(0), 5, 2)))
    size = F.size(words)
    return F.when(size == 1, alone).when(size == 2, two(at(0), at(1))).when(size == 3, three(at(0), at(1), at(2)))


def flexible_date(c: Column | str, century: int = 2025) -> Column:
    """A DATE from free text: numbers and month names in any usual order, with weekdays, ordinals, times and zones about
    them; NULL when it is none, or names no year.

    A missing day or month reads as the first. Two-digit years lie within fifty years of ``century``.
    """
    return _bind(_words(as_col(c)), lambda words: F.try_to_date(_ordered(words, century), "yyyy-M-d"))
