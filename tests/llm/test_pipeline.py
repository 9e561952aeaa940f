"""The pipeline, stage by stage."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tidemark.llm.common import keep

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(keep(stage(spark, made[-1], SMALL)))
    return made


def test_filters_keep_columns_and_clean_documents(stages):
    docs = stages[0]
    for made in stages[1:5]:
        assert made.columns == docs.columns
    labelled = {r["doc_id"] for r in docs.where("lang is not null and text rlike '\\\\p{L}'").collect()}
    assert labelled <= {r["doc_id"] for r in stages[1].collect()}
    before, after = ({r["doc_id"]: r["text"] for r in s.collect()} for s in stages[1:3])
    seen: dict[str, int] = {}
    for text in before.values():
        for line in text.split("\n"):
            seen[line] = seen.get(line, 0) + 1
    for doc, text in before.items():
        if all(seen[line] == 1 for line in text.split("\n")):
            assert after[doc] == text
        elif doc in after:
            assert len(after[doc]) <= len(text)


def _language_docs(spark, langs):
    texts = ["the cat sat on the mat and slept", "der Hund lief durch den Wald", "0 1 2", None, "the end of the day", "und die Katze"]
    rows = [(i, t, langs[i % len(langs)], "a", 1) for i, t in enumerate(texts * 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_language_stage_follows_the_prediction(spark, monkeypatch):
    docs = _language_docs(spark, ["en", "de", None, "en", "en", "de"])
    scores = {0: 0.9, 1: 0.52, 4: 0.53, 5: 1.0}  # the bound of two languages is 0.525

    def answer(named, model):
        assert len(model[1]) == 2
        made = [(i, False, "en", scores.get(i, 0.0)) for i in range(24)]
        return spark.createDataFrame(made, "doc_id long, held_out boolean, lang_pred string, score double")

    monkeypatch.setattr(corpus_pipeline.langid, "identify_languages", answer)
    assert {r["doc_id"] for r in corpus_pipeline.language_stage(spark, docs, SMALL).collect()} == {0, 4, 5}


@pytest.mark.parametrize("langs", [[None], ["en"]])
def test_without_languages_to_learn_documents_with_letters_stay(spark, langs):
    docs = _language_docs(spark, langs)
    made = corpus_pipeline.language_stage(spark, docs, SMALL)
    assert {r["doc_id"] for r in made.collect()} == {i for i in range(24) if i % 6 not in (2, 3)}


def test_one_of_each_group_stays(stages):
    from test_llm import fingerprint_by_hand, roots

    prints = {r["doc_id"]: fingerprint_by_hand(r["text"]) for r in stages[2].collect()}
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    assert {r["doc_id"] for r in stages[3].collect()} == set(roots(ids, links).values())


def test_packed_pieces_are_whole_documents(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokens, documents, places = {}, {}, {}
    for r in stages[5].collect():
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for r in stages[4].collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids
        documents[r["doc_id"]] = documents.get(r["doc_id"], 0) + len(ids) + 1
    assert tokens == documents
    for pieces in places.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_awkward_rows_go_through(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    text = lambda: " ".join(word() for _ in range(30))
    rows = [(i, text(), "en", rng.choice(["a", "b", None]), 1, "x") for i in range(30)]
    rows += [rows[0], rows[0], (None, text(), None, "a", None, "y"), (None, None, None, None, None, None), (40, "", "en", "a", 0, "x"), (41, "12 34", "en", "a", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key string")
    for docs_in in (docs, docs.limit(0)):
        made = docs_in
        for name, stage in corpus_pipeline.STAGES:
            made = keep(stage(spark, made, SMALL))
            if name != "best_fit_packing":
                assert made.columns == docs.columns
            if name == "language_id":
                assert made.count() == (33 if docs_in is docs else 0)
            if name == "simhash_near_dedup":
                assert made.count() == (31 if docs_in is docs else 0)


def test_run_is_registered(spark):
    import __spark_entry__ as driver

    assert driver.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SMALL).count() > 0
