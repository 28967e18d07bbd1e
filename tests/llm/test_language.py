from __future__ import annotations

import random
import tracemalloc
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from salesmart.llm import language
from salesmart.llm.queries import QUERIES
from tests.llm.helpers import SF, by_key, table

LABELLED = "doc_id long, text string, lang string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = by_key(language.identify(docs))
    known = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert {k: r["held_out"] for k, r in found.items()} == {k: crc32(str(k).encode()) % 4 == 2 for k in known}
    held = [k for k, r in found.items() if r["held_out"]]
    assert sum(found[k]["lang_pred"] == known[k] for k in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found.values())


def rows() -> list[tuple]:
    made = []
    for i in range(60):
        made.append((2 * i, f"the cat and the dog went thither {i}", "xx"))
        made.append((2 * i + 1, f"der hund und die katze gingen dorthin {i}", "yy"))
    return made


def test_edges(spark):
    extra = [
        (1000, None, "xx"), (1001, "", "xx"), (1002, "12 34 ---", "xx"), (1003, "THE CAT", None),
        (1004, "Der Hund " * 20_000, "xx"), (None, "the dog", "yy"), (1003, "THE CAT", None), (1005, "ж", None),
    ]
    found = language.identify(table(spark, rows() + extra, LABELLED)).collect()
    assert len(found) == 128
    label = {r.doc_id: (r.lang_pred, r.score) for r in found}
    for key in (1000, 1001, 1002):
        assert label[key] == ("und", 0.0)
    assert label[1003][0] == "xx" and label[1004][0] == "yy" and label[None][0] == "xx"
    assert label[1005][0] in ("xx", "yy")
    assert next(r.held_out for r in found if r.doc_id is None) is True


def test_nothing_learned_and_no_rows(spark):
    found = language.identify(table(spark, [(1, "some text", None), (2, None, "xx")], LABELLED)).collect()
    assert {r.lang_pred for r in found} == {"und"} and {r.score for r in found} == {0.0}
    assert language.identify(table(spark, [], LABELLED)).collect() == []


def test_more_than_64_languages():
    grams = {f"l{i:03}": np.array([hash((i, j)) for j in range(40)], np.int64).view(np.uint64) for i in range(70)}
    model = language.build(grams)
    assert model.masks.shape[1] == 2
    for number, hashes in enumerate(grams.values()):
        cells = model.cells(hashes)
        found = np.bitwise_and.reduce([model.masks[c, number // 64] for c in cells])
        assert ((found >> np.uint64(number % 64)) & np.uint64(1)).all()


def test_grams_do_not_cross_words_or_texts():
    one = [set(h.tolist()) for h, _ in language.gram_hashes(["ab"])]
    two = [set(h[o == 1].tolist()) for h, o in language.gram_hashes(["zq", "ab", "zq"])]
    assert one == two


def grams_of(text: str) -> Counter:
    """The n-grams of a text, of letters in lower case and single spaces."""
    letters = "".join((c.lower() or c)[0] if c.isalpha() else " " for c in text)
    line = " " + " ".join(letters.split()) + " " if letters.split() else " "
    found = Counter()
    for order in language.ORDERS:
        for i in range(len(line) - order + 1):
            gram = line[i : i + order]
            if " " not in gram[1:-1] and (order > 2 or gram.strip()):
                found[gram] += 1
    return found


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 1 << 17])
def test_grams_of_pieces_are_those_of_the_text(monkeypatch, piece):
    monkeypatch.setattr(language, "PIECE", piece)
    rng = random.Random(piece)
    texts = ["", "a", "  ", "x1y", "É. b", *("".join(rng.choices("abcD é1 .", k=30)) for _ in range(40))]
    got = [Counter() for _ in texts]
    for hashes, owner in language.gram_hashes(texts):
        for h, o in zip(hashes.tolist(), owner.tolist()):
            got[o][h] += 1
    for text, found in zip(texts, got):
        wanted = grams_of(text)
        if text.strip() and wanted:  # one name for each n-gram, as often as it stands there
            assert sorted(found.values()) == sorted(wanted.values()), text
    whole = Counter()
    for found in got:
        whole.update(found)
    assert len(whole) == len(set().union(*(grams_of(t) for t in texts)))


def plain_model(rows: list[tuple]) -> dict[str, set[str]]:
    """The n-grams that each language contains, by the rules and without filters."""
    texts: dict[str, set[str]] = {}
    for text, lang in rows:
        if text is not None and lang is not None:
            texts.setdefault(lang, set()).add(text)
    docs = {lang: Counter(g for t in own for g in grams_of(t)) for lang, own in texts.items()}
    share = {lang: {g: n / len(texts[lang]) for g, n in found.items()} for lang, found in docs.items()}
    top: dict[str, float] = {}
    for lang, found in share.items():
        for gram, part in found.items():
            if part >= language.MIN_SHARE and (docs[lang][gram] >= language.MIN_DOCS or part >= language.FEW):
                top[gram] = max(part, top.get(gram, 0))
    return {
        lang: {
            g for g, part in found.items()
            if part >= language.MIN_SHARE and (docs[lang][g] >= language.MIN_DOCS or part >= language.FEW)
            and part >= language.MIN_RATIO * top[g]
        } for lang, found in share.items()
    }


def test_predictions_by_brute_force(spark):
    """n-gram sets in place of the filters: the same languages, and scores up to false positives."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    learned = plain_model([(d.text, d.lang) for d in docs if crc32(str(d.doc_id).encode()) % 4 != 2])
    commonest = Counter(d.lang for d in docs if d.text is not None and crc32(str(d.doc_id).encode()) % 4 != 2)
    order = sorted(learned, key=lambda lang: (-commonest[lang], lang))
    found = by_key(QUERIES["op4_language"](spark, SF))
    assert set(found) == {d.doc_id for d in docs}
    near = 0
    for d in docs:
        grams = grams_of(d.text or "")
        total = grams.total()
        row = found[d.doc_id]
        if not any(c.isalpha() for c in d.text or ""):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        shares = [sum(n for g, n in grams.items() if g in learned[lang]) / total for lang in order]
        best = max(shares)
        if sorted(shares)[-2] < best - 0.02:
            near += 1
            assert row["lang_pred"] == order[shares.index(best)]
            assert abs(row["score"] - best) < 0.02
    assert near > 0.9 * len(docs)


def test_a_text_of_20_mb(spark):
    extra = [(1000, "the dog and the cat " * 1_000_000, None), (1001, "hundundkatze" * 1_700_000, None)]
    label = {r.doc_id: r.lang_pred for r in language.identify(table(spark, rows() + extra, LABELLED)).collect()}
    assert label[1000] == "xx" and label[1001] == "yy"


def test_training_slices_take_little_memory():
    text = " ".join(f"wort{i % 977}und" for i in range(90_000))[: 1 << 20]
    texts, langs = [text[i : i + 2000] for i in range(0, len(text), 2000)], np.zeros(525, np.int64)
    tracemalloc.start()
    for _ in language.gram_documents(texts, langs[: len(texts)]):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 << 20


def test_copies_count_once_in_the_sample(spark):
    copied = [(i, f"{word} und nichts sonst", word) for i, word in enumerate(["abcd", "efgh", "ijkl", "mnop", "qrst"])]
    docs = table(spark, copied * 300, LABELLED)
    assert language.train(docs, sample=3).languages == ["abcd", "efgh", "ijkl", "mnop", "qrst"]
    others = [(k, f"seltene worte {k}", "de") for k in range(3)]
    model = language.train(table(spark, copied[:1] * 400 + [(9, "ganz viele kopien", "de")] * 400 + others, LABELLED))
    assert model.predict(["seltene worte"])[1][0] > 0.9


def test_all_distinct_texts_are_learned_from(spark):
    docs = table(spark, [(k, f"wort {k}", "de") for k in range(4_000)] + [(0, "wort 0", "de")] * 5, LABELLED)
    drawn = language.draw(docs)
    assert drawn.drawn == {"de": 4_000} and drawn.rows == {"de": 4_005} and drawn.texts.count() == 4_000


def test_usual_scores_are_medians_of_distinct_texts(spark):
    rows = [(f"t{k}", "xx", "xx", k / 1000) for k in range(101)] + [("t0", "xx", "xx", 0.0)] * 500
    rows += [("other", "yy", "xx", 0.9), ("none", None, "xx", 0.9), (None, "xx", "xx", 0.9)]
    scored = spark.createDataFrame(rows, "text string, lang string, lang_pred string, score double")
    assert language.usual_scores(scored) == {"xx": 0.05}
