"""What Python workers of the text operators hold at once."""

from __future__ import annotations

import gc
import random
import tracemalloc

import numpy as np
import pyarrow as pa

from feedloom.llm import toxicity
from feedloom.llm.bpe_lattice import Lattice, State, load_pieces
from feedloom.llm.common import BATCH_BYTES, map_batches
from feedloom.llm.queries import MODEL
from feedloom.llm.sentencepiece_codec import Codec


def test_forgotten_states_are_free_at_once():
    lattice, rnd = Lattice(load_pieces(MODEL), limit=200, joined_limit=100), random.Random(3)
    gc.collect()
    before = sum(isinstance(x, State) for x in gc.get_objects())
    gc.disable()
    try:
        state = lattice.start
        for _ in range(5_000):
            char = rnd.choice("abcdeé中 ")
            state = (state.get(char) or lattice.step(state, char))[0]
        alive = sum(isinstance(x, State) for x in gc.get_objects()) - before
    finally:
        gc.enable()
    assert alive <= 200 + 2 and len(lattice.joined) <= 100


def test_few_states_and_pairs_give_the_same_ids():
    rnd, few, many = random.Random(4), Codec(MODEL), Codec(MODEL)
    few.lattice = Lattice(few.pieces, limit=20, joined_limit=5)
    words = pa.array([" " * rnd.randint(0, 1) + "".join(rnd.choices("abceinorst\0é中😀", k=rnd.randint(1, 40))) for _ in range(300)])
    got, want = few.encode_words(words), many.encode_words(words)
    assert all(np.array_equal(a, b) for a, b in zip(got, want))


def test_words_of_one_text_at_a_time():
    rnd = random.Random(5)
    texts = [" ".join(f"{rnd.getrandbits(60):x}" for _ in range(1_000)) for _ in range(200)]
    weights = {"w:abc": 1.5, "p3:abc": 0.7, "p4:abcd": 0.1, "s3:bcd": 0.3, "s4:abcd": -0.9}
    model = toxicity.Model(weights, -2.0, np.array([[0.9, 0.1], [0.9, 0.1]]), np.array([-1.0, 1.0, 1.0]))
    scorer = toxicity.Scorer(model, memo_words=1_000)
    for word in ["abc", "(ABC)", "abcd", "xabcd", "abcde", "ab", "", "...", "éabcd"]:
        assert scorer.word(word) == -2.0 + sum(weights.get(f, 0.0) for f in toxicity.word_features(word))
    tracemalloc.start()
    try:
        found = scorer.marginals(texts)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [len(p) for p in found] == [1_000] * 200
    assert most < 70 * 200_000  # bytes a word


def test_batches_from_executors_are_bounded(spark):
    docs = spark.range(6_000, numPartitions=1).selectExpr("id", "repeat('word ', 1000) AS text")

    def make():
        return lambda batch: pa.record_batch([pa.array([batch.column(1).buffers()[2].size])], names=["size"])

    assert max(r["size"] for r in map_batches(docs, make, "size long").collect()) < 2.2 * BATCH_BYTES
