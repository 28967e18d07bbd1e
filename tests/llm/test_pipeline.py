from __future__ import annotations

import random

import pytest

import corpus_pipeline
from salesmart.llm import shared, stages
from tests.llm.helpers import CLASHING, SF, prose

SCHEMA = f"doc_id long, text string, lang string, source string, n_chars int, {CLASHING}"


def documents(spark, texts: list[tuple]):
    rows = [(k, t, lang, "s", len(t) if t is not None else None, *"abcdef") for k, t, lang in texts]
    return spark.createDataFrame(rows, SCHEMA)


def planted(spark):
    """Clean documents, and of each kind that a stage must catch."""
    rng = random.Random(12)
    clean = [(i, " ".join(prose(rng, 80)), rng.choice(("en", "de"))) for i in range(30)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text.split()
    long = "a boilerplate line that many documents share"
    own = lambda n: " ".join(prose(rng, n))
    base = prose(rng, 100)
    near = [*base[:50], "changed", *base[51:]]
    kinds = {
        "letterless": [(100, None, "en"), (101, "", None), (102, "12 -- 34", "en")],
        "lines": [(110, f"{own(30)}\n{long}", "en"), (111, f"{long}!\n{own(30)}", "en"), (112, long, "en")],
        "near": [(120, " ".join(base), "en"), (121, " ".join(near), "en"), (122, " ".join(base), "en")],
        "leak": [(130, f"{own(40)} {' '.join(item[:14])} {own(10)}", "en")],
    }
    return clean, kinds


def keys(df) -> set:
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_catch_what_is_planted_and_keep_the_rest(spark):
    clean, kinds = planted(spark)
    everything = clean + [row for rows in kinds.values() for row in rows]
    docs = documents(spark, everything)
    kept = {k for k, *_ in clean}

    first = shared.stored(stages.identify_language(spark, docs, SF), "t")
    assert first.columns == docs.columns
    assert keys(first) == {k for k, *_ in everything} - {100, 101, 102}
    assert {r.doc_id: r.score for r in first.collect()}[0] == "f"

    second = shared.stored(stages.drop_repeated_lines(spark, first, SF), "t")
    text = {r.doc_id: r.text for r in second.collect()}
    assert second.columns == docs.columns and {r.n_chars - len(r.text) for r in second.collect()} == {0}
    assert "boilerplate" in text[110] and "boilerplate" not in text[111] and 112 not in text and 122 not in text

    third = stages.keep_one_of_similar(spark, first, SF)
    assert third.columns == docs.columns
    assert keys(third) >= kept | {120, 130} and not keys(third) & {121, 122}

    fourth = stages.drop_contaminated(spark, first, SF)
    assert fourth.columns == docs.columns and keys(first) - keys(fourth) == {130}

    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = shared.stored(stage(spark, docs, SF), "t")
        assert kept <= keys(docs), name


def test_unlabelled_documents_stay_and_limits_are_by_language(spark):
    docs = documents(spark, [(1, "some text", None), (2, "жук", None), (3, "12 --", None), (4, None, None)])
    assert keys(stages.identify_language(spark, docs, SF)) == {1, 2}
    rng = random.Random(4)
    letters = [chr(0x4E00 + i) for i in range(3000)]  # few n-grams of any text are common
    rows = [(k, "的人" + "".join(rng.choices(letters, k=60)), "zh") for k in range(120)]
    assert len(keys(stages.identify_language(spark, documents(spark, rows), SF))) > 100


def test_copies_of_many_lines_go_whole(spark):
    rng = random.Random(31)
    text = "\n".join(["Les.", "", " ".join(prose(rng, 12)), "And ornd.", " ".join(prose(rng, 9)), "One, two three.", "x"])
    rows = [(1, text, "en"), (2, text, "en"), (3, text + "\n ", "en"), (4, f"{text}\nOnly here.", "en")]
    found = stages.drop_repeated_lines(spark, documents(spark, rows), SF)
    assert {r.doc_id: r.text for r in found.collect()} == {1: text, 4: "\nOnly here."}


@pytest.mark.parametrize("number", range(5))
def test_each_stage_takes_odd_tables(spark, number):
    stage = corpus_pipeline.STAGES[number][1]
    assert stage(spark, documents(spark, []), SF).collect() == []
    rows = [(None, "null key with some words", "en"), (1, "same id", "en"), (1, "another text", "en"), (2, None, None), (3, "", "en"), (4, "...", None)]
    docs = documents(spark, [*rows, rows[1]])
    found = stage(spark, docs, SF)
    if number < 4:
        assert found.columns == docs.columns
    texts = {(r.doc_id, r.text) for r in found.collect()} if number < 4 else set()
    assert number == 4 or {(None, rows[0][1]), (1, "same id"), (1, "another text")} <= texts


def test_wordless_documents_are_no_copies(spark):
    docs = documents(spark, [(1, "", "en"), (2, None, "en"), (3, " ", "en"), (4, "x", "en"), (5, "x", "en")])
    assert keys(stages.keep_one_of_similar(spark, docs, SF)) == {1, 2, 3, 4}


def test_pipeline_is_the_stages_in_order(spark):
    found = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = shared.stored(stage(spark, docs, SF), "t")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    rows = lambda df: sorted(tuple(r) for r in df.select(*columns).collect())
    assert rows(found) == rows(docs) and found.count() > 100
