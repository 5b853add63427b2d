"""Toxicity by a linear-chain conditional random field over words.

Labels are of documents, so token labels are derived: features of words (the word, its prefixes) that occur in
significantly more toxic than clean training documents mark the toxic words of toxic documents. A two-state chain is
fitted to them; forward-backward marginals of its words give toxic spans, and a logistic function of the marginals,
fitted on the same documents, gives the document's score.

The fit takes a bounded sample of labelled rows: at most ``TOXIC_ROWS`` toxic and ``CLEAN_ROWS`` clean ones, those with
the smallest hash of their id. Near copies among them would pass off any of their words as evidence, so only texts with
mostly new word sequences are learnt from; a quarter of those fits the score, the rest the chain, on at most
``CHAIN_WORDS`` words. Scoring reads whole texts.

Defined results: null and empty texts have no words and the score of a document without evidence; a null id is held out
and never learnt from; labels that repeat an id count as toxic if one of them does, null labels are none; without labels
of both kinds every score is 0; ties, repeated rows and very long texts are scored row by row; an empty table gives no
rows. Extra columns are not read.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import Rows, map_batches

TOXIC_ROWS, CLEAN_ROWS, CHAIN_WORDS = 1_500, 3_000, 300_000
FOLDS = 5
MEMO_WORDS = 200_000
_EDGE = ".,;:!?\"'()[]{}<>*_-`"
_SHOWN = 0.5


class Model(NamedTuple):
    weights: dict[str, float]  # of features, for the toxic state against the other
    bias: float
    stay: np.ndarray  # 2 x 2, exponentiated transition scores
    lift: np.ndarray  # intercept and weights of the document's logistic function


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def word_features(word: str) -> list[str]:
    """The word without punctuation in lower case, its prefixes and suffixes."""
    w = word.strip(_EDGE).lower()
    return ["w:" + w, *(f"p{k}:{w[:k]}" for k in (3, 4, 5, 6) if len(w) > k), *(f"s{k}:{w[-k:]}" for k in (3, 4) if len(w) > k)]


def evidence(texts: list[str], toxic: list[int], least: float = 20.0, ratio: float = 6.0) -> set[str]:
    """Features that significantly many toxic documents hold (log-likelihood ratio of a two-by-two table)."""
    shown = lambda w: [f for f in word_features(w) if f[0] != "s"]
    with_, without, memo = Counter(), Counter(), {}
    for text, y in zip(texts, toxic):
        if y:
            with_.update({f for w in set(text.split()) for f in shown(w)})
    with_ = {f: n for f, n in with_.items() if n > 2}
    for text, y in zip(texts, toxic):
        if not y:
            words = set(text.split())
            memo.update((w, [f for f in shown(w) if f in with_]) for w in words if w not in memo)
            without.update({f for w in words for f in memo[w]})
    n1, n0 = sum(toxic), len(toxic) - sum(toxic)
    found = set()
    for f, a in with_.items():
        b = without.get(f, 0)
        if a / n1 < ratio * (b + 0.5) / n0:
            continue
        table = ((a, n1), (b, n0), (n1 - a, n1), (n0 - b, n0))
        share = (a + b) / (n1 + n0)
        score = 2 * sum(x * np.log(x / (n * (share if k < 2 else 1 - share))) for k, (x, n) in enumerate(table) if x)
        if score >= least:
            found.add(f)
    return found


def diverse(texts: list[str], new: float = 0.7) -> list[int]:
    """Positions of texts whose runs of five words are mostly not in texts taken before."""
    seen: set[int] = set()
    out = []
    for i, text in enumerate(texts):
        w = text.split()
        runs = {hash(x) for x in zip(w, w[1:], w[2:], w[3:], w[4:])} or {hash(text)}
        if len(runs - seen) >= new * len(runs):
            out.append(i)
            seen |= runs
    return out


def marginals(scores: np.ndarray, starts: np.ndarray, lengths: np.ndarray, stay: np.ndarray) -> np.ndarray:
    """Probability of the toxic state at each word of several sequences that lie in one array.

    With two states, forward and backward messages are ratios; all sequences advance together, the longest first.
    """
    out = np.empty(len(scores))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # sequences longer than t
    (t00, t01), (t10, t11) = stay
    e, forward = np.exp(np.clip(scores, -30, 30)), np.empty(len(scores))
    ratio = np.empty(0)
    for t in range(steps):
        n = active[t]
        at = starts[:n] + t
        ratio = e[at] if t == 0 else e[at] * (t01 + t11 * ratio[:n]) / (t00 + t10 * ratio[:n])
        forward[at] = ratio
    back = np.ones(len(lengths))
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        both = forward[at] * back[:n]
        out[at] = both / (1 + both)
        mine = e[at] * back[:n]
        back[:n] = (t10 + t11 * mine) / (t00 + t01 * mine)
    return out


def fit_chain(texts: list[str], toxic: list[int], marks: set[str], rounds: int = 50) -> tuple[dict[str, float], float, np.ndarray]:
    """Weights and transitions by gradient steps on the conditional likelihood, for sequences of up to 256 words."""
    known: dict[str, int] = {"": 0}
    memo: dict[str, tuple[list[int], bool]] = {}
    rows, labels, lengths = [], [], []
    left = {0: CHAIN_WORDS // 2, 1: CHAIN_WORDS // 2}
    for text, y in zip(texts, toxic):
        words = text.split()
        for at in range(0, len(words), 256):
            part = words[at:at + 256]
            if left[y] < len(part):
                break
            left[y] -= len(part)
            lengths.append(len(part))
            for w in part:
                if w not in memo:
                    features = word_features(w)
                    memo[w] = [known.setdefault(f, len(known)) for f in features], any(f in marks for f in features)
                rows.append(memo[w][0])
                labels.append(y and memo[w][1])
    width = max(map(len, rows), default=1)
    index = np.array([r + [0] * (width - len(r)) for r in rows])
    y, lengths = np.array(labels, float), np.array(lengths)
    starts = np.cumsum(lengths) - lengths
    inner = np.ones(len(y), bool)
    inner[starts] = False
    log_t = np.zeros((2, 2))
    for a in (0, 1):  # transitions as counted, smoothed
        for b in (0, 1):
            log_t[a, b] = np.log(((y[np.flatnonzero(inner) - 1] == a) & (y[inner] == b)).sum() + 1.0)
        log_t[a] -= np.log(np.exp(log_t[a]).sum())
    w, bias, sums = np.zeros(len(known)), -3.0, [np.full(len(known), 1e-2), 1e-2]
    for _ in range(rounds):
        p = marginals(w[index].sum(axis=1) + bias, starts, lengths, np.exp(log_t))
        error = p - y
        grad = np.bincount(index.ravel(), np.repeat(error, width), len(known)) + 1e-2 * w
        grad[0] = 0
        sums[0] += grad * grad
        sums[1] += error.sum() ** 2
        w -= 0.5 * grad / np.sqrt(sums[0])
        bias -= 0.5 * error.sum() / np.sqrt(sums[1])
    return {f: float(w[k]) for f, k in known.items() if abs(w[k]) > 1e-3}, bias, np.exp(log_t)


def _document_features(p: np.ndarray) -> tuple[float, float]:
    """The strongest marginal as a logit, and how many words are toxic."""
    if not len(p):
        return -8.0, 0.0
    top = min(max(p.max(), 1e-6), 1 - 1e-6)
    return float(np.clip(np.log(top / (1 - top)), -8, 8)), float(np.log1p(p[p >= _SHOWN].sum()))


def fit_lift(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps, with a small ridge."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(3), x.T @ (y - p) - 0.05 * w)
    return w


class Scorer:
    def __init__(self, model: Model, memo_words: int = MEMO_WORDS) -> None:
        self.model, self.limit, self.memo = model, memo_words, {}
        kinds: dict[str, dict[str, float]] = {}
        for feature, weight in model.weights.items():
            kind, _, text = feature.partition(":")
            kinds.setdefault(kind, {})[text] = weight
        self.whole = kinds.get("w", {}).get
        self.parts = [(k, slice(0, k), kinds[f"p{k}"].get) for k in (3, 4, 5, 6) if f"p{k}" in kinds]
        self.parts += [(k, slice(-k, None), kinds[f"s{k}"].get) for k in (3, 4) if f"s{k}" in kinds]

    def word(self, w: str) -> float:
        """The score of a word: the weights of ``word_features``, looked up by kind."""
        text = w.strip(_EDGE).lower()
        n = len(text)
        s = self.model.bias + sum([self.whole(text, 0.0), *[get(text[part], 0.0) for k, part, get in self.parts if n > k]])
        if len(self.memo) >= self.limit:
            self.memo.clear()
        if len(w) <= 64:
            self.memo[w] = s
        return s

    def marginals(self, texts: list[str | None]) -> list[np.ndarray]:
        get, values = self.memo.get, array("d")
        lengths = np.zeros(len(texts), np.int64)
        for k, text in enumerate(texts):  # the words of one text at a time
            words = text.split() if text else []
            lengths[k] = len(words)
            values.extend(s if (s := get(w)) is not None else self.word(w) for w in words)
        scores = np.frombuffer(values)
        starts = np.cumsum(lengths) - lengths
        p = marginals(scores, starts, lengths, self.model.stay)
        return [p[a:a + n] for a, n in zip(starts, lengths)]

    def score(self, p: np.ndarray) -> float:
        if not self.model.lift.any():
            return 0.0
        z = self.model.lift @ np.array([1.0, *_document_features(p)])
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    @staticmethod
    def spans(text: str | None, p: np.ndarray) -> list[dict]:
        """Character offsets of toxic words, neighbours joined."""
        if not (p >= _SHOWN).any():
            return []
        out: list[dict] = []
        last = -2
        for k, m in enumerate(re.finditer(r"\S+", text)):
            if p[k] >= _SHOWN:
                if last == k - 1:
                    out[-1]["end"] = m.end()
                else:
                    out.append({"start": m.start(), "end": m.end()})
                last = k
        return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the bounded sample. Ids are chosen from the labels alone, then their texts are looked up."""
    known = labels.where(F.col("toxic").isNotNull() & ~held_out(F.col(id_col))).groupBy(F.col(id_col).alias("label_id")).agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("label_id"), F.col("label_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(TOXIC_ROWS).unionByName(known.where("toxic <> 1").orderBy(*order).limit(CLEAN_ROWS))
    picked = docs.select(F.col(id_col).alias("label_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    rows = picked.join(F.broadcast(chosen), "label_id").select("label_id", "text", "toxic").collect()  # bounded by the sample
    rows.sort(key=lambda r: (xxhash.xxh64_intdigest(str(r["label_id"])), r["text"]))
    rows = [rows[i] for i in diverse([r["text"] for r in rows])]
    texts, toxic = [r["text"] for r in rows], [int(r["toxic"] == 1) for r in rows]
    if not 0 < sum(toxic) < len(toxic):
        return Model({}, 0.0, np.ones((2, 2)), np.zeros(3))
    return fit_texts(texts, toxic)


def fit_texts(texts: list[str], toxic: list[int]) -> Model:
    """The chain from three quarters of the texts, the document's score from the other quarter."""
    part = lambda x, k: [v for i, v in enumerate(x) if (i % 4 == 3) == k]
    chain, lift = part(texts, False), part(texts, True)
    y, lift_y = part(toxic, False), part(toxic, True)
    if not 0 < sum(y) < len(y) or not 0 < sum(lift_y) < len(lift_y):
        chain, y, lift, lift_y = texts, toxic, texts, toxic
    weights, bias, stay = fit_chain(chain, y, evidence(chain, y))
    scorer = Scorer(Model(weights, bias, stay, np.zeros(3)))
    x = [_document_features(p) for p in scorer.marginals(lift)]
    return Model(weights, bias, stay, fit_lift(np.array(x), np.array(lift_y, float)))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, predicted, spans`` of every row; spans are character offsets of toxic words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Rows:
        scorer = Scorer(shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(1).to_pylist()
            found = scorer.marginals(texts)
            scores = [scorer.score(p) for p in found]
            return pa.record_batch([
                batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                pa.array([scorer.spans(t, p) for t, p in zip(texts, found)], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
            ], names=[id_col, "score", "predicted", "spans"])

        return step

    rows = docs.select(id_col, text_col)
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, score double, predicted int, spans array<struct<start:int,end:int>>"
    return map_batches(rows, make, schema)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score 0.5 or more; nothing else changes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Rows:
        scorer = Scorer(shared.value)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = scorer.marginals(batch.column(text_col).to_pylist())
            return batch.filter(pa.array([scorer.score(p) < 0.5 for p in found], pa.bool_()))

        return step

    return map_batches(docs, make, docs.schema)
