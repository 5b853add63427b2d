"""Operators beside plain Python versions of what they promise."""

import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from feedloom.llm import decontaminate, licenses, sentencepiece_codec, simhash, substring_dedup, token_counts, topk, toxicity, warc
from feedloom.llm.components import components


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")


def test_tokens_match_the_library(texts, model):
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    counter, codec = token_counts.TokenCounter(model), sentencepiece_codec.Codec(model)
    rnd = random.Random(5)
    parts = ["a", "the", " ", "  ", "\n", "</s>", "é", "x́", "😀", "中", "ing", "\0", "1", "00", "    "]
    for text in [*texts.values(), *("".join(rnd.choices(parts, k=rnd.randint(0, 60))) for _ in range(500))]:
        want = library.encode(text)
        assert codec.encode(text) == want
        assert codec.stream(codec.lattice.surface(text)) == want
        assert codec.decode(want) == text
        assert counter.count(text) == len(want)
        assert counter.count(text, chunk=7) == len(want)  # maps of many chunks, some without a boundary


def test_chunk_maps_compose_in_any_grouping(model):
    counter = token_counts.TokenCounter(model)
    text = counter.lattice.surface("one two\nthree   " + "x" * 90 + " four")
    maps = [counter.chunk_map(text[i:i + 9]) for i in range(0, len(text), 9)]
    left = maps[0]
    for m in maps[1:]:
        left = counter.compose(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = counter.compose(m, right)
    total = lambda m: counter.run(m.head) + (m.count or 0) + counter.run(m.tail)
    assert total(left) == total(right) == counter.run(text)


def test_the_encoder_keeps_a_bounded_window(model):
    codec = sentencepiece_codec.Codec(model)
    encoder = sentencepiece_codec.Encoder(codec.lattice)
    text = "thinganoness" * 2000
    ids = encoder.feed(text) + encoder.finish()
    assert ids == codec.stream(text) and encoder.widest <= 64


def dedup_by_hand(rows, window=13):
    first = {}
    for doc, text in rows:
        words = text.split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            first[key] = min(first.get(key, doc), doc)
    out = {}
    for doc, text in rows:
        words = text.split()
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i:i + window])] < doc:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc] = len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


@pytest.mark.parametrize("hot", [(512, 64), (3, 4)])
def test_substring_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(substring_dedup, "HOT_DOCS", hot[0])
    monkeypatch.setattr(substring_dedup, "HOT_IN_TASK", hot[1])
    rnd = random.Random(2)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(300)]
    rows = []
    for doc in range(60):
        words = [f"u{rnd.randint(0, 10 ** 6)}" for _ in range(rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randint(0, 280)
            words += base[at:at + rnd.randint(5, 40)]
        rows.append((doc, " ".join(words)))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dedup_by_hand(rows)


def test_a_hot_passage_makes_no_rows_of_its_windows(spark):
    """One passage of 40 words in 400 and in 1,200 documents: rows follow the documents, not the passage's windows."""
    made = {}
    for n in (400, 1200):
        shared = " ".join(f"s{k}" for k in range(40))
        rows = [(d, " ".join(f"a{d}x{k}" for k in range(15)) + f" {shared} " + " ".join(f"b{d}x{k}" for k in range(15))) for d in range(n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_digest(docs).collect()}
        assert got == dedup_by_hand(rows)
        made[n] = {r.kind: r["count"] for r in substring_dedup.segments_of(docs).groupBy("kind").count().collect()}
    per_batch = 4 * 32  # rows of packed windows: one for each batch and route
    assert sum(made[400].values()) <= 8 * 400 + per_batch and sum(made[1200].values()) <= 8 * 1200 + per_batch
    assert made[1200][substring_dedup.HOT] <= per_batch


def test_extra_columns_with_the_names_of_helpers_keep_their_values(spark):
    shared = " ".join(f"s{k}" for k in range(20))
    rows = [(d, f"x{d} {shared}", 7 + d, "p", "q") for d in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dedup_version long, Dedup_Parts string, dedup_doc string")
    out = {r.doc_id: tuple(r) for r in substring_dedup.dedup_texts(docs).collect()}
    assert out == {d: (d, t if d == 0 else f"x{d}", v, p, q) for d, t, v, p, q in rows}
    assert substring_dedup.dedup_texts(docs).columns == docs.columns


def test_automata_in_blocks_agree_with_one():
    rnd = random.Random(3)
    segments = [[rnd.choice("ab") for _ in range(rnd.randint(4, 20))] for _ in range(40)]
    docs = [rnd.randint(0, 30) for _ in segments]
    whole = substring_dedup.first_documents(segments, docs, 4)
    assert whole == substring_dedup.first_documents(segments, docs, 4, block_words=15)
    want = defaultdict(lambda: 1 << 62)
    for s, d in zip(segments, docs):
        for i in range(len(s) - 3):
            want[tuple(s[i:i + 4])] = min(want[tuple(s[i:i + 4])], d)
    assert whole == [[want[tuple(s[i:i + 4])] for i in range(len(s) - 3)] for s in segments]


def test_matching_statistics():
    automaton = substring_dedup.Automaton()
    automaton.add(list("abcab"), 1)
    automaton.add(list("cabd"), 2)
    automaton.close()
    assert [n for n, _ in automaton.statistics(list("xabdcabz"), 9)] == [0, 1, 2, 3, 1, 2, 3, 0]


def simhash_by_hand(rows):
    def fp(text):
        w = text.encode().lower().split()
        grams = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    prints = {d: fp(t) for d, t in rows}
    root = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return {d: (prints[d], root[d]) for d in prints}


def test_simhash_groups(spark, docs, texts):
    want = simhash_by_hand(texts.items())
    got = simhash.classes(simhash.fingerprints(docs)).collect()
    assert {r.doc_id: (r.bits % (1 << 64), r.component_id) for r in got} == want
    assert len({c for _, c in want.values()}) < len(want)


@pytest.mark.parametrize("block", [512, 8])
def test_links_connect_what_is_near(spark, block):
    rnd = random.Random(7)
    centres = [rnd.getrandbits(64) for _ in range(6)]
    bits = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 5))) for c in centres for _ in range(60)} | {0, (1 << 64) - 1}
    signed = [b - (1 << 64) if b >> 63 else b for b in sorted(bits)]
    points = spark.createDataFrame([(b, 0, b) for b in signed], "node long, layer int, bits long")
    found = {(r.a, r.b) for r in simhash.links(points, block=block).collect()}
    near = lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 3
    assert all(near(a, b) for a, b in found)

    def roots(pairs):
        root = {b: b for b in signed}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
        return {b: find(b) for b in signed}

    assert roots(found) == roots((a, b) for a in signed for b in signed if a < b and near(a, b))


def test_embedding_is_a_lower_bound(spark):
    rnd = random.Random(9)
    a = np.array([rnd.getrandbits(64) for _ in range(500)], np.uint64)
    b = a ^ np.array([sum(1 << k for k in rnd.sample(range(64), rnd.randint(0, 6))) for _ in a], np.uint64)
    assert (simhash.close(a, b, 3) == (np.bitwise_count(a ^ b) <= 3)).all()


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(8, 90)]
    got = {r.node: r.root for r in components(spark.createDataFrame([*chain, *star, (3, 3)], "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in range(7, 90)}}


def test_keep_first_keeps_one_of_each_component(spark, texts):
    rows = sorted(texts.items()) + [(10_001, " ".join((texts[max(texts)] or "a").split()).upper()), (10_002, "no yes"), (10_003, "yes no"), (10_004, "Yes  no")]
    want = {d for d, (_, c) in simhash_by_hand(rows).items() if d == c}
    rows += [(10_003, "yes no"), (10_004, "a text of its own"), (None, "yes no")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("id", F.lit(2)).withColumn("bits", F.lit(3))
    kept = simhash.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str(tuple(r)[:2]) for r in kept.collect()) == sorted(str(r) for r in rows if r[0] is None or r[0] in want or r[1] == "a text of its own")


@pytest.mark.parametrize("limit", [1 << 20, 40])
def test_decontamination_in_one_block_and_in_many(spark, docs, texts, limit):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").limit(8).unionByName(
        spark.createDataFrame([(900, "In, of"), (901, None), (None, "thonst a"), (902, "...")], "item_id long, text string"))
    windows = defaultdict(set)
    for item, text in bench.select("item_id", "text").collect():
        w = decontaminate.words_of(text)
        for i in range(max(1, len(w) - 9)) if w else ():
            windows[tuple(w[i:i + 10])].add(item)
    got = {r.doc_id: r for r in decontaminate.scan_documents(docs, bench, limit=limit).collect()}
    cut = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, bench, limit=limit).collect()}
    assert len(got) == len(cut) == len(texts)
    for doc, text in texts.items():
        w, hit, items = decontaminate.words_of(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if found := windows.get(tuple(w[i:i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        assert {k for s in got[doc].spans for k in range(s.start, s.end)} == hit
        assert list(got[doc]["items"]) == sorted(str(i) for i in items if i is not None)
        assert decontaminate.words_of(cut[doc]) == [x for k, x in enumerate(w) if k not in hit]
        assert hit or cut[doc] == text


@pytest.mark.parametrize("limit", [1 << 20, 2])
def test_decontamination_keeps_columns_with_the_names_of_helpers(spark, limit):
    bench = spark.createDataFrame([(k, " ".join(f"b{k}x{i}" for i in range(12))) for k in range(4)], "item_id long, text string")
    rows = [(k, f"start b{k}x0 " + " ".join(f"b{k}x{i}" for i in range(12)) + " end", 7 + k, "s", "more") for k in range(4)] + [(9, None, 1, "s", "more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, cut_key long, Cut_Spans string, scan_key string")
    out = decontaminate.remove_spans(docs, bench, limit=limit)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(k, "start b%dx0 end" % k if t else None, v, a, b) for k, t, v, a, b in rows]
    assert {r.doc_id: list(r["items"]) for r in decontaminate.scan_documents(docs, bench, limit=limit).collect()} == {**{k: [str(k)] for k in range(4)}, 9: []}


@pytest.mark.parametrize("chunk", [1 << 16, 2])
@pytest.mark.parametrize("kind, large", [("float", 3.0e6), ("double", 3.0e6), ("float", 1e12), ("float", 3e38), ("double", 1e100)])
def test_top_k_of_large_components(spark, chunk, kind, large):
    rows = [(20, [large, 1.0, -0.5]), (1, [large, 1 / 64, 0.0]), (2, [large, 3 / 64, 0.0]), (3, [large, 2 / 64, 0.0]), (4, [-large, 0.25, 0.0]),
            (40, [1.0, 2.0, 3.0]), (5, [0.5, 0.5, 0.5]), (6, [-large, 0.25, 0.0])]
    got = topk.top_k(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>"), k=4, chunk=chunk).collect()
    as_given = np.float32 if kind == "float" else np.float64
    v = {i: [math.floor(64 * Fraction(float(as_given(c)))) for c in x] for i, x in rows}
    clip = lambda n: max(-(1 << 63), min((1 << 63) - 1, n))
    want = set()
    for i in (20, 40):
        best = sorted((-sum(a * b for a, b in zip(v[i], v[j])), j) for j in v if j != i)[:4]
        want |= {(i, r + 1, j, clip(-n)) for r, (n, j) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == 8


@pytest.mark.parametrize("chunk", [1 << 16, 40])
def test_top_k(spark, chunk):
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(300, 12)) * rnd.exponential(size=(300, 1))
    x[7] = x[8] = x[9]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(400, None), (401, [1.0, None]), (402, [float("nan")]), (420, [float("inf")]), (440, [0.5, 0.25]), (460, [])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5, chunk=chunk).collect()
    q = {i: np.floor(64 * np.float32(v).astype(float)).astype(int) for i, v in rows if v and i not in (401, 402, 420)}
    pad = lambda v: np.r_[v, np.zeros(12 - len(v), int)]
    want = set()
    for i in q:
        if i % 20 == 0:
            best = sorted((-int(pad(q[i]) @ pad(q[j])), j) for j in q if j != i)[:5]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_warc_round_trip_with_segments_and_hostile_pages(spark, tmp_path):
    pages = [(1, "http://a/ b\r\nWARC/1.1", "x" * 300 + "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "é😀" * 90), (2, None, None), (3, "u", ""), (4, "u", "x"), (5, "u", "x")]
    planned = warc.plan_records(spark.createDataFrame(pages, "page_id long, url string, html string"), min_bytes=1)
    path = warc.write_archives(planned, f"file://{tmp_path}/w", segment_bytes=64, chunk_chars=50)
    got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert len(got) == 5
    for page, _, html in pages[:4]:
        assert bytes(got[page].payload).decode() == (html or "") and got[page].record_type == "response"
    assert (got[5].record_type, got[5].refers_to, got[5].payload, got[5].payload_length) == ("revisit", 4, None, 1)


def test_broken_segments_end_the_query(spark, tmp_path):
    planned = warc.plan_records(spark.createDataFrame([(1, "u", "y" * 500)], "page_id long, url string, html string"))
    path = warc.write_archives(planned, f"file://{tmp_path}/w", segment_bytes=64)
    lines = [r.value for r in spark.read.option("lineSep", warc.VERSION).text(path).collect() if r.value]
    kept = [v for v in lines if "WARC-Segment-Number: 3\r\n" not in v]
    assert len(kept) == len(lines) - 1
    spark.createDataFrame([("".join(warc.VERSION + v for v in kept).removesuffix("\r\n"),)], "value string").write.option("lineSep", "\r\n").text(f"file://{tmp_path}/b")
    with pytest.raises(Exception, match="broken segments"):
        warc.read_archives(spark, f"file://{tmp_path}/b").collect()


def test_license_sequences():
    s = licenses.Scanner()
    x = licenses.SENTENCES
    mit = f"{x['mit-grant']} junk here. {x['mit-notice']}\n{x['mit-warranty']} Tail."
    assert [m.license for m in s.scan(mit)[2]] == ["MIT"]
    assert [m.license for m in s.scan(f"{x['bsd-grant']} {x['bsd-source']} {x['bsd-binary']}")[2]] == ["BSD-2-Clause"]
    assert [m.license for m in s.scan(f"{x['bsd-grant']} {x['bsd-source']} {x['bsd-binary']} {x['bsd-endorse']}")[2]] == ["BSD-3-Clause"]
    assert s.scan(f"{x['mit-notice']} {x['mit-grant']}")[2] == []  # the order is wrong
    assert s.scan(f"{x['gpl-free']} a. b. c. {x['gpl-hope']}")[2] == []  # too far apart


def test_every_license_rule_can_match():
    import textwrap

    s, x = licenses.Scanner(), licenses.SENTENCES
    for name, ids in licenses.RULES:
        for text in (" ".join(x[k] for k in ids), "\n\n".join(textwrap.fill(x[k], 60) for k in ids),
                     "/*" + "*" * 900 + "\n" + "\n *\n".join(textwrap.fill(x[k], 72, initial_indent=" * ", subsequent_indent=" * ") for k in ids) + "\n */"):
            assert [m.license for m in s.scan(text)[2]] == [name]
    wrapped = textwrap.fill("one two " * 40, 60)
    known = textwrap.fill(x["mit-grant"], 70)
    text = f"{wrapped}.\n\n{known}\n{wrapped}\n\n{wrapped}\n{textwrap.fill(x['mit-notice'], 70)}"
    n, known, found = s.scan(text)  # a sentence over several lines is one, in the gap too
    assert (n, known, [text[m.start:m.end].split()[0] for m in found]) == (5, 2, ["Permission"])
    apache = f"{x['apache-notice']}\n{x['apache-use']}\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n"
    assert [m.license for m in s.scan(apache)[2]] == ["Apache-2.0"]
    padded = " *" * 900 + " " + x["isc-grant"]
    assert [m.license for m in s.scan(padded)[2]] == ["ISC"]


def test_license_lines_of_documents(spark, docs, texts):
    got = {r.doc_id: [m.license for m in r.matches] for r in licenses.scan_licenses(docs).collect()}
    names = {"Released under the MIT License.": "MIT", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "All-rights-reserved",
             "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only"}
    assert got == {d: [names[line] for line in t.split("\n") if line in names] for d, t in texts.items()}
    assert any(got.values())


def chain_by_hand(scores, stay):
    import itertools

    total, on = 0.0, np.zeros(len(scores))
    for path in itertools.product((0, 1), repeat=len(scores)):
        weight = np.exp(sum(s for s, y in zip(scores, path) if y)) * np.prod([stay[a][b] for a, b in zip(path, path[1:])])
        total += weight
        on += weight * np.array(path)
    return on / total


def test_forward_backward():
    rnd = np.random.default_rng(4)
    stay = np.array([[0.9, 0.1], [0.4, 0.6]])
    parts = [rnd.normal(size=n) for n in (5, 1, 8, 3)]
    lengths = np.array([len(p) for p in parts])
    got = toxicity.marginals(np.concatenate(parts), np.cumsum(lengths) - lengths, lengths, stay)
    assert np.allclose(got, np.concatenate([chain_by_hand(p, stay) for p in parts]))


def test_toxicity_on_held_out_rows(spark):
    from feedloom.llm.queries import toxicity_scores

    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = toxicity_scores(spark, sf).collect()
    held = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [s for s, y in held if y], [s for s, y in held if not y]
    assert toxic and clean and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([a > b for a in toxic for b in clean]) > 0.9
    assert np.mean([(s >= 0.5) == bool(y) for s, y in held]) > 0.9
