"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; the queries beside their SQL."""

import pytest
from compare import check, duck

import corpus_pipeline
from feedloom.llm import chat, decontaminate, licenses, queries, sentencepiece_codec, simhash, substring_dedup, token_counts, topk, toxicity, warc
from feedloom.llm.common import rewrite_text

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert check(duck(SF_DIR), queries.QUERIES[name](spark, SF_DIR), queries.ORACLES[name]) is None


def bench(spark):
    return spark.createDataFrame([(1, "alpha beta gamma"), (1, "alpha beta gamma"), (2, None), (None, "word1 tail1"), (3, "")], "item_id long, text string")


def operators(spark, model):
    tox = toxicity.Model({"w:beta": 9.0}, -4.0, __import__("numpy").array([[0.9, 0.1], [0.9, 0.1]]), __import__("numpy").array([-1.0, 1.0, 1.0]))
    return {
        "toxicity": lambda d: toxicity.score_documents(d, tox), "substring": substring_dedup.dedup_digest,
        "encode": lambda d: sentencepiece_codec.encode_texts(d, model), "count": lambda d: token_counts.count_tokens(d, model),
        "simhash": lambda d: simhash.classes(simhash.fingerprints(d)), "licenses": licenses.scan_licenses,
        "leaks": lambda d: decontaminate.summary(decontaminate.scan_documents(d, bench(spark))),
        "keep_clean": lambda d: toxicity.keep_clean(d, tox), "keep_first": simhash.keep_first,
        "cut_repeats": substring_dedup.dedup_texts, "cut_leaks": lambda d: decontaminate.remove_spans(d, bench(spark)),
    }


@pytest.mark.parametrize("name", ["toxicity", "substring", "encode", "count", "simhash", "licenses", "leaks", "cut_repeats", "cut_leaks"])
def test_every_row_has_a_result(spark, model, messy, nothing, name):
    fn = operators(spark, model)[name]
    assert sorted(str(r.doc_id) for r in fn(messy).select("doc_id").collect()) == sorted(str(r.doc_id) for r in messy.collect())
    assert fn(nothing).count() == 0


def test_filters_on_messy_rows(spark, model, messy, nothing):
    ops = operators(spark, model)
    assert sorted(str(r.doc_id) for r in ops["keep_clean"](messy).collect()) == ["2", "3", "4", "4", "5", "7"]
    assert sorted(str(r.doc_id) for r in ops["keep_first"](messy).collect()) == ["1", "2", "4", "4", "7", "None"]
    assert ops["keep_clean"](nothing).count() == ops["keep_first"](nothing).count() == 0
    assert ops["keep_first"](messy).columns == messy.columns


def test_without_labels_of_both_kinds_scores_are_zero(spark, messy):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(messy, labels)
    assert {r.score for r in toxicity.score_documents(messy, model).collect()} == {0.0}


def test_messy_tokens_decode(spark, model, messy):
    ids = sentencepiece_codec.encode_texts(messy, model)
    back = {r.doc_id: r.text for r in sentencepiece_codec.decode_ids(ids, model).collect()}
    assert all(back[r.doc_id] == (r.text and r.text.replace("▁", " ")) for r in messy.collect() if r.doc_id)
    assert [r.exact for r in ids.where("doc_id = 7").collect()] == [False]


def test_rewriting_keeps_other_columns(spark):
    rows = spark.createDataFrame([(1, "a b", "en", 3), (2, None, None, None)], "doc_id long, text string, lang string, n_chars int")
    out = rewrite_text(rows, lambda: lambda texts: [t and t + "!" for t in texts])
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == [(1, "a b!", "en", 4), (2, None, None, None)]


def test_chat_events_fold(spark):
    log = [
        (1, 0, 0, "user", "delta", "he"), (1, 1, 0, "user", "delta", "llo"), (1, 2, 1, "assistant", "delta", "bad"),
        (1, 3, 1, "assistant", "regenerate", None), (1, 5, 1, "assistant", "delta", "d</s>"), (1, 4, 1, "assistant", "delta", "goo"),
        (1, 6, 0, None, "edit", "hi [/INST]"), (1, 7, 0, "user", None, "!"), (None, 0, None, None, "delta", None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, message long, role string, kind string, text string")
    shown = chat.render(chat.reconstruct(events))
    back = {r.conv_id: r for r in chat.parse(shown).collect()}
    assert [tuple(t) for t in back[1].turns] == [("user", "hi [/INST]!"), ("assistant", "good</s>")]
    assert back[1].loss_text == "good</s>" and [tuple(t) for t in back[None].turns] == [("", "")]
    for r in shown.collect():
        assert r.formatted.count("</s>") == len(back[r.conv_id].turns)
        assert r.conv_id is None or "".join(r.formatted[s.start:s.start + s.length] for s in r.loss_mask) == "good<\\/s>"
    assert chat.parse(chat.render(chat.reconstruct(events.where("1 = 0")))).count() == 0


@pytest.mark.parametrize("text", ["\\<\\\\[", "<<\\", "[/ROLE]</s><s>", "", "a\\", "[\\[", "\n"])
def test_escapes_are_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select("t", chat.escape(__import__("pyspark").sql.functions.col("t")).alias("e"))
    row = row.select("t", "e", chat.unescape(__import__("pyspark").sql.functions.col("e")).alias("u")).head()
    assert row.u == text and not any(x in row.e for x in ("<s>", "</s>", "[/ROLE]", "[INST]"))


def test_chat_rows_with_nulls_and_ties(spark):
    rows = spark.createDataFrame([(5, 1, "user", None), (5, 1, "user", None), (5, None, None, "x"), (None, 0, "assistant", "y")], "conv_id long, turn long, role string, text string")
    back = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.parse(chat.render(chat.reconstruct(chat.message_events(rows)))).collect()}
    assert back == {5: [("", "x"), ("user", ""), ("user", "")], None: [("assistant", "y")]}


def test_chat_stays_in_the_jvm(spark):
    plan = queries.chat_format(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_warc_rows_with_nulls_and_ties(spark):
    rows = spark.createDataFrame([(None, None, "a", 1), (3, "u", "a", 1), (3, "u", "a", 1), (9, "u", "a", 1), (None, "v", None, 1)], "page_id long, url string, html string, payload int")
    path = warc.write_archives(warc.plan_records(rows))
    got = sorted((str(r.page_id), r.record_type, r.refers_to) for r in warc.read_archives(spark, path).collect())
    assert got == [("3", "response", None), ("3", "response", None), ("9", "revisit", 3), ("None", "response", None), ("None", "revisit", 3)]
    empty = warc.write_archives(warc.plan_records(rows.where("1 = 0")))
    assert warc.read_archives(spark, empty).count() == 0


def test_top_k_of_nothing(spark):
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert topk.top_k(spark.createDataFrame([(20, None), (40, [1.0])], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES][1] == "near-duplicates" and corpus_pipeline.ORACLE_SQL is None
    kept, first = docs, {r.doc_id: r.text for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in kept.collect()}
        path = f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}"
        step(spark, kept, SF_DIR).write.mode("overwrite").parquet(path)
        kept = spark.read.parquet(path)
        if name == "sentencepiece":
            assert {r.doc_id for r in kept.collect()} == set(before) and kept.where("not exact").count() == 0
            break
        assert kept.columns == docs.columns
        after = {r.doc_id: r.text for r in kept.collect()}
        assert set(after) <= set(before) and kept.where("n_chars <> length(text)").count() == 0
        if name in ("substring-dedup", "decontamination"):
            assert set(after) == set(before)
        if name == "substring-dedup":
            windows = {}
            for d in sorted(before):
                w = before[d].split()
                for i in range(len(w) - 12):
                    windows.setdefault(tuple(w[i:i + 13]), d)
            for d, t in before.items():
                w, gone = t.split(), set()
                for i in range(len(w) - 12):
                    if windows[tuple(w[i:i + 13])] < d:
                        gone.update(range(i, i + 13))
                assert after[d] == (" ".join(x for i, x in enumerate(w) if i not in gone) if gone else t)
    assert len(before) < len(first)
