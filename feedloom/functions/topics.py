"""Topic labels: rules as data, classifiers as expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom.functions.text import EDGE_AFTER, EDGE_BEFORE, WS, as_col, json_quote, strip
from feedloom.schemas import DEFAULT_TOPIC, TOPICS

# The terms of each topic, in priority order. A term must match between two word edges;
# \s* stands for optional whitespace of any kind.
TOPIC_TERMS = {
    "生命科学": (
        r"genome", r"genomic", r"transcriptome", r"metagenome", r"proteome",
        r"cellular", r"stem\s*cell", r"tissue", r"organ", r"neuron", r"neuro",
        r"protein", r"rna", r"mrna", r"dna",
        r"immun", r"immune", r"immunology", r"virus", r"viral",
        r"cancer", r"tumor", r"oncology", r"pathway", r"biology", r"biological", r"biomed", r"biomedical",
        r"life\s*science", r"biochemistry", r"molecular",
        r"clinical trial", r"patient", r"disease", r"therapy",
    ),
    "人工智能": (
        r"ai", r"artificial\s*intelligence", r"machine\s*learning", r"ml", r"deep\s*learning", r"dl",
        r"neural\s*network", r"cnn", r"rnn", r"gan", r"gpt", r"transformer", r"bert", r"llm",
        r"foundation\s*model", r"reinforcement\s*learning", r"rl", r"q-learning",
        r"self-supervised", r"supervised\s*learning", r"unsupervised\s*learning", r"few-shot", r"zero-shot",
        r"transfer\s*learning", r"representation\s*learning", r"backpropagation",
        r"computer\s*vision", r"image\s*recognition", r"object\s*detection", r"segmentation",
        r"natural\s*language\s*processing", r"nlp", r"language\s*model", r"speech\s*recognition",
        r"recommendation\s*system", r"knowledge\s*graph", r"ai\s*agent", r"autonomous", r"multi-agent",
    ),
    "3D打印和增材制造": (
        r"3d\s*print", r"3d-print", r"additive\s*manufactur", r"rapid\s*prototyping",
        r"fused\s*deposition\s*modeling", r"fdm", r"fused\s*filament\s*fabrication", r"fff",
        r"stereolithography", r"sla", r"selective\s*laser\s*sintering", r"sls",
        r"powder\s*bed", r"binder\s*jetting", r"direct\s*energy\s*deposition", r"ded",
        r"electron\s*beam\s*melting", r"ebm", r"inkjet\s*printing", r"bioprinting", r"bio-printing",
        r"extrusion\s*printing", r"laser\s*melting", r"metal\s*printing", r"metal\s*additive",
    ),
}


def _alternation(terms: Sequence[str]) -> str:
    """One pattern for all terms, grouped by first letter so that a failing position is given up early."""
    by_letter: dict[str, list[str]] = {}
    for term in terms:
        by_letter.setdefault(term[0], []).append(term[1:].replace(r"\s", WS))
    return "|".join(f"{letter}(?:{'|'.join(rest)})" for letter, rest in by_letter.items())


def topic_pattern(topic: str) -> str:
    terms = TOPIC_TERMS[topic]
    letters = "".join(sorted({t[0] for t in terms}))
    return rf"{EDGE_BEFORE}(?=[{letters}])(?:{_alternation(terms)}){EDGE_AFTER}"


def tagging_text(title: Column | str, abstract: Column | str) -> Column:
    blank = F.lit("")
    return F.lower(F.concat_ws("\n", F.coalesce(as_col(title), blank), F.coalesce(as_col(abstract), blank)))


def primary_topic(text: Column) -> Column:
    """First topic in priority order whose terms occur in the lower-case text."""
    rule = None
    for topic in TOPIC_TERMS:
        hit = text.rlike(topic_pattern(topic))
        rule = F.when(hit, topic) if rule is None else rule.when(hit, topic)
    return rule.otherwise(DEFAULT_TOPIC)


def topic_array(text: Column, primary: Column | None = None, limit: int = 5) -> Column:
    """The primary topic, then every topic whose own name occurs in the text."""
    named = F.filter(F.array(*map(F.lit, TOPICS)), lambda t: F.contains(text, F.lower(t)))
    primary = primary_topic(text) if primary is None else primary
    return F.slice(F.array_distinct(F.concat(F.array(primary), named)), 1, limit)


def label_from_answer(answer: Column | str, text: Column) -> Column:
    """Topic named in an external classifier's answer, else the rule-based one."""
    tidy = F.regexp_replace(strip(answer), "[' ]", "")
    named = F.filter(F.array(*map(F.lit, TOPICS)), lambda t: F.contains(tidy, t))
    return F.coalesce(F.get(named, F.lit(0)), primary_topic(text))


def decode_tags(c: Column | str) -> Column:
    """Stored tag text to an array: a JSON array as such, anything else as one element."""
    c = as_col(c)
    parsed = F.from_json(F.when(F.ltrim(c).startswith("["), c), "array<string>")
    return F.when(c.isNull() | (c == ""), F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array(c)))


def encode_tags(c: Column | str) -> Column:
    """Array to JSON array text with non-ASCII characters kept."""
    return F.concat(F.lit("["), F.array_join(F.transform(as_col(c), json_quote), ", "), F.lit("]"))


def has_topic(tag: Column | str, topics: Sequence[str] | None, compat: bool = False) -> Column:
    """Topic filter; no topics means no restriction.

    ``compat`` compares the stored text itself, which never matches a stored JSON array.
    """
    if not topics:
        return F.lit(True)
    if compat:
        return as_col(tag).isin(*topics)
    tag = as_col(tag)
    # Only texts that hold a topic's characters, or an escape that may stand for them, can decode to it. Parquet applies
    # this to its dictionaries, and the other rows are never parsed.
    held = reduce(or_, (F.contains(tag, F.lit(t)) for t in topics), F.contains(tag, F.lit("\\")))
    return held & F.arrays_overlap(decode_tags(tag), F.array(*map(F.lit, topics)))
