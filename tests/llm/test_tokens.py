from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from salesmart.llm import tokens
from salesmart.llm.token_counts import count_tokens
from tests.llm.helpers import SF, by_key, table

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
TRICKY = [
    "", " ", "\n", "it's OK. don't <|endoftext|>x<|startoftext|> a.'s \"Hi!\" ... (abc) x²",
    "two  spaces \t tab\n\n nl  ", "a\r\nb c", "É. ÉÈ ΑΣ. İ.", "10.5%, 3.14! a1. ***x***",
    "x'S. 'T 's. <| <|endoftext|>. END<|ENDOFTEXT|>", "é. x́", "word\x1cword !\x1c!", "中文 字。 test", "x" * 500 + ".",
]


@pytest.mark.parametrize("name", FILES)
def test_ids_are_the_librarys(name):
    path = public_tokenizers.path(name)
    library = Tokenizer.from_file(path)
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choice("ab'.,!sST <|>\n1é²Σ") for _ in range(rng.randrange(15))) for _ in range(1500)]
    encoder = tokens.Encoder(path, lambda ids: np.array(ids, "<u4").tobytes())
    for text, parts in zip(texts, encoder.encode(texts), strict=True):
        ids = library.encode(text, add_special_tokens=False).ids
        assert b"".join(parts) == np.array(ids, "<u4").tobytes(), text


@pytest.mark.parametrize("name", [*FILES, "piece_bpe_32k.model"])
def test_counts(spark, name):
    path = public_tokenizers.path(name)
    rows = list(enumerate([*TRICKY, None, "word " * 3000]))
    found = by_key(count_tokens(table(spark, rows), path))
    if name.endswith("json"):
        library = Tokenizer.from_file(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    else:
        count = lambda t: len(tokens.sentence_pieces(path).encode(t))
    for key, text in rows:
        expected = count(text or "")
        assert found[key] == {
            "doc_id": key, "n_bytes": len((text or "").encode()), "n_tokens": expected, "over_limit": expected > 2048,
        }


def test_repeated_rows_and_no_rows(spark):
    path = public_tokenizers.path(FILES[0])
    assert count_tokens(table(spark, [(1, "a b")] * 2 + [(None, "a")]), path).count() == 3
    assert count_tokens(table(spark, []), path).collect() == []


def test_query_matches_the_library(spark):
    from salesmart.llm.queries import QUERIES

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    library = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    for key, row in by_key(QUERIES["op10_token_counts"](spark, SF)).items():
        assert row["n_tokens"] == len(library.encode(texts[key], add_special_tokens=False).ids)


def test_case_counts_where_the_tokenizer_keeps_it(tmp_path):
    import json

    with open(public_tokenizers.path(FILES[0]), encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = None
    path = str(tmp_path / "cased.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path, list)
    assert encoder.cut == "space" and not encoder.lowers
    for text in ("HELLO world", "Hello, WORLD! HELLO", "hello"):
        ids = [i for part in encoder.encode([text])[0] for i in part]
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_added_tokens_that_take_spaces_forbid_cuts(tmp_path):
    import json

    with open(public_tokenizers.path(FILES[1]), encoding="utf-8") as file:
        spec = json.load(file)
    for token in spec["added_tokens"]:
        token["rstrip"] = True
    path = str(tmp_path / "greedy.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(spec, file)
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path, list)
    text = "one <|endoftext|> two  <|endoftext|>\nthree"
    assert [i for part in encoder.encode([text])[0] for i in part] == library.encode(text, add_special_tokens=False).ids


def test_many_words_and_few_kept(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 300)
    rng = random.Random(4)
    path = public_tokenizers.path(FILES[1])
    library, encoder = Tokenizer.from_file(path), tokens.Encoder(path, tokens._packed)
    for _ in range(12):
        texts = ["".join(rng.choice(["w", " ", " x", "\n", "é", "7", "<|endoftext|>", "y" * 70]) for _ in range(200)) for _ in range(30)]
        texts += [" ".join(f"{rng.randrange(5000)}" for _ in range(200)) for _ in range(10)]
        for text, parts in zip(texts, encoder.encode(texts), strict=True):
            assert b"".join(parts) == np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_words_learned_together_have_the_ids_of_the_library(monkeypatch):
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library, rng = tokens.Encoder(path, list), Tokenizer.from_file(path), random.Random(5)
    some = ["a", "Bé", "12", "½", "Ⅷ", "一", "́", "'s", "...", " ", "  ", "\n", " \n", "\t", "\u00a0", "<|endoftext|>", "<", "Ġ"]
    texts = ["".join(rng.choices(some, k=rng.randrange(40))) for _ in range(2_000)]
    texts += [" ".join(f"wort{rng.random()}x" for _ in range(50)) for _ in range(20)]
    alone = []
    monkeypatch.setattr(encoder, "_values", lambda words, real=encoder._values: alone.extend(words) or real(words))
    got = [sum(parts, []) for parts in encoder.encode(texts)]
    assert got == [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert not any(w.startswith(" wort") for w in alone)


def test_words_known_of_old_are_looked_up_one_by_one(monkeypatch):
    """What has to be gone through are the new texts' words, not all that are kept."""

    class Kept(dict):
        def __iter__(self):
            raise AssertionError("all old words were gone through")

    path = public_tokenizers.path("byte_bpe_50k.json")
    monkeypatch.setattr(tokens, "CACHED_WORDS", 3)
    encoder, library = tokens.id_encoder.__wrapped__(path), Tokenizer.from_file(path)
    texts = ["one two three four\nfive", "two five,\nsix seven eight", "nine\u2003ten one", "one\n\ntwo  six", "\nsix one "]
    for text in texts:
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.totals([text], b"".join) == [ids]
        encoder.old = Kept(encoder.old)
    assert [tokens.lengths(path, [t]) for t in texts] == [[len(library.encode(t).ids)] for t in texts]


def test_white_space_other_than_spaces_and_line_feeds():
    assert {c for c in map(chr, range(0x110000)) if c.isspace()} - {" ", "\n"} == set(tokens._ODD_SPACES)


def test_punctuation_at_the_end_of_a_word_is_learned_once(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, library, rng = tokens.id_encoder.__wrapped__(path), Tokenizer.from_file(path), random.Random(6)
    learned = []
    monkeypatch.setattr(encoder, "_learn", lambda missing, real=encoder._learn: learned.extend(missing) or real(missing))
    tails = ["", ",", ".", "!!", "...", "%%%", "$$$", "_", "'", "',", "'s.", "<", "<|endoftext|>", "<|endoftext|>.", "…"]
    words = ["Haus", "très", "x²", "一", "7", "_", "x́", "-", "(a)", "a.b"]
    texts = [f"{a}{t}{gap}{b}{u}" for a in words for t in tails for b in ("x", "é") for u in tails[:6] for gap in (" ", "\n", "  ")]
    texts += [" ".join(rng.choice(words) + rng.choice(tails[:11]) for _ in range(rng.randrange(60))) for _ in range(300)]
    ids = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.totals(texts, b"".join) == ids
    learned.clear()
    encoder.totals(["so strasse, strasse. strasse!! strasse"], b"".join)
    assert [part for part in learned if "strasse" in part] == ["strasse"]


def test_letters_and_digits_end_a_token_before_punctuation():
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ends = [c for c in map(chr, range(0x110000)) if c.isalnum()]
    ids = lambda texts: [e.ids for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    after = ids([",."])[0]
    assert ids([f" a{c},." for c in ends]) == [found + after for found in ids([f" a{c}" for c in ends])]
