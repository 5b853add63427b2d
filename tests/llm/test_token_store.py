"""Token files beside the library, codes beside an exhaustive search, and files that are cut or damaged."""

import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import queries, token_store
from feedloom.llm.word_batches import split_words

LIBRARY = Tokenizer.from_file(queries.BYTE_MODEL)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def hostile(draw):
    bits = ["a", "The", "é", "é", "中文", "😀", " ", "  ", "\n", "\t", "\r\n", " ", " ", ".", "'s", "'", "don't", "123", "-", "<|endoftext|>", "<|", "​", "\x0b", "\x85", "　", "_", "\x00"]
    return "".join(draw.choice(bits) for _ in range(draw.randrange(12)))


def test_words_joined_are_the_text():
    draw = random.Random(1)
    texts = [hostile(draw) for _ in range(500)] + [None, "", " ", "  a", "a ", "a  b", "a b\nc d"]
    words, numbers, ends = split_words(pa.array(texts, pa.string()))
    words = words.to_pylist()
    starts = np.r_[0, ends[:-1]]
    assert ["".join(words[k] for k in numbers[a:b]) for a, b in zip(starts, ends)] == [t or "" for t in texts]
    assert len(set(words)) == len(words) and "" not in words


def test_ids_are_those_of_the_library():
    draw = random.Random(2)
    own = token_store.Tokenizer(queries.BYTE_MODEL)
    assert own.by_words
    own.words.limit = 3_000  # the table of words is dropped on the way
    for _ in range(6):
        texts = [hostile(draw) for _ in range(800)] + [None, "", "x" * 5_000 + " y", "w " * 3_000]
        flat, n = own.ids(pa.array(texts, pa.string()))
        want = [library_ids(t) for t in texts]
        assert n.tolist() == list(map(len, want)) and flat.tolist() == [i for ids in want for i in ids]


def test_another_kind_of_tokenizer_gets_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = token_store.Tokenizer(path), Tokenizer.from_file(path)
    flat, n = own.ids(pa.array(["Two  words\nhere", None], pa.string()))
    assert not own.by_words and flat.tolist() == library.encode("Two  words\nhere", add_special_tokens=False).ids + library.encode("", add_special_tokens=False).ids and n[0] > 0


@pytest.mark.parametrize("counts, limit", [((1, 1, 2, 3, 5, 8), 3), ((1, 1, 2, 3, 5, 8), 6), ((7, 7, 7, 7), 2), ((1, 100, 1, 1, 1), 3), ((5,), 4), ((3, 4), 1)])
def test_code_lengths_are_the_best_within_the_limit(counts, limit):
    found = token_store.code_lengths(dict(enumerate(counts)), limit)
    cost = sum(counts[i] * n for i, n in found.items())
    every = (ls for ls in product(range(1, limit + 1), repeat=len(counts)) if sum(2.0 ** -n for n in ls) <= 1)
    assert cost == min(sum(c * n for c, n in zip(counts, ls)) for ls in every) and max(found.values()) <= limit


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError):
        token_store.code_lengths(dict.fromkeys(range(5), 1), 2)


def test_codes_are_canonical_and_read_back():
    draw = np.random.default_rng(4)
    ids = (draw.pareto(0.7, 20_000) * 3).astype(np.int64) % 40_000
    lengths = token_store.code_lengths(dict(zip(*(a.tolist() for a in np.unique(ids, return_counts=True)))), 16)
    code = token_store.Code(lengths)
    order = sorted(lengths, key=lambda i: (lengths[i], i))
    shown = [f"{code.code[i]:0{lengths[i]}b}" for i in order]
    assert shown == sorted(shown) and not any(b.startswith(a) for a, b in zip(shown, shown[1:]))
    data, offsets = code.pack(ids, 50)
    assert code.unpack(data, offsets, len(ids), 50).tolist() == ids.tolist()
    third = code.unpack(data[offsets[3] // 8:], np.array([offsets[3] % 8]), 50, 50)  # one lane alone
    assert third.tolist() == ids[150:200].tolist()
    offsets = offsets.copy()
    offsets[5] += 1
    with pytest.raises(ValueError):
        code.unpack(data, offsets, len(ids), 50)


def test_a_damaged_block_is_refused():
    whole = token_store.frame({"n": 0, "every": 4, "docs": []}, np.zeros(0, "<u4"), b"\x01")
    assert len(list(token_store.frames(whole + b"\n" + whole + b"\n"))) == 2
    with pytest.raises(ValueError):
        list(token_store.frames(whole[:-1] + b"\x02\n"))
    with pytest.raises(ValueError):
        list(token_store.frames(whole[:-1]))


def test_joined_checksums():
    draw = random.Random(6)
    for _ in range(50):
        a, b = (bytes(draw.randrange(256) for _ in range(draw.randrange(400))) for _ in range(2))
        assert token_store.crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(rows):
    docs = sorted(((i is not None, i or 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids) for i, t in rows for ids in [library_ids(t) + [0]]))
    out, start = [], 0
    for has, i, n, crc, ids in docs:
        out.append((i if has else None, start, n, crc))
        start += n
    return out


@pytest.mark.parametrize("block", [7, token_store.BLOCK_IDS])
def test_files_hold_every_document(spark, messy, block, monkeypatch):
    monkeypatch.setattr(token_store, "FILE_BLOCKS", 3)
    rows = [(r.doc_id, r.text) for r in messy.collect() if not r.text or len(r.text) < 1_000] + [(k % 40, f"text {k} and more") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("n", F.lit(1)).withColumn("part", F.lit(2))
    path = token_store.write_ids(token_store.tokenize(docs.repartition(5), queries.BYTE_MODEL), block_ids=block)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    got = [tuple(r) for r in token_store.document_digests(token_store.read_pieces(spark, path)).collect()]
    assert sorted(got, key=order) == expected(rows)
    pieces = token_store.read_pieces(spark, path).orderBy("part", "at").collect()
    texts = {}
    for p in pieces:
        texts.setdefault((p.part, p.doc), [p.id, []])[1].extend(p.ids)
    assert sorted(map(str, ([i, LIBRARY.decode(ids[:-1], skip_special_tokens=False)] for i, ids in texts.values()))) == sorted(str([i, t or ""]) for i, t in rows)


def test_a_long_document_and_string_ids(spark, messy):
    docs = messy.where("doc_id = 4").limit(1).select(F.concat(F.lit("d"), "doc_id").alias("name"), "text")
    path = token_store.write_ids(token_store.tokenize(docs, queries.BYTE_MODEL, end_id=None, id_col="name"), block_ids=1_000)
    row, ids = token_store.document_digests(token_store.read_pieces(spark, path)).first(), library_ids(docs.first().text)
    assert tuple(row) == ("d4", 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_an_empty_table_and_texts_without_ids(spark, nothing):
    path = token_store.write_ids(token_store.tokenize(nothing, queries.BYTE_MODEL))
    assert token_store.document_digests(token_store.read_pieces(spark, path)).count() == 0
    one = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    path = token_store.write_ids(token_store.tokenize(one, queries.BYTE_MODEL))  # one symbol
    assert sorted(tuple(r) for r in token_store.document_digests(token_store.read_pieces(spark, path)).collect()) == expected([(1, ""), (2, "")])


def test_the_query_over_its_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = queries.token_ids(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected(rows)
