from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from salesmart.llm import substrings, words
from tests.llm.helpers import by_key, prose, table, thue_morse, white_words


def expected(rows: list[tuple], window: int) -> dict:
    listed = {k: white_words(t) for k, t in rows}
    count = Counter(tuple(w[i : i + window]) for w in listed.values() for i in range(len(w) - window + 1))
    out = {}
    for key, w in listed.items():
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[key] = (len(w), len(gone), kept)
    return out


def got(df) -> dict:
    return {k: (r["n_words"], r["n_removed"], r["kept"]) for k, r in by_key(df).items()}


def corpus(seed: int, window: int) -> list[tuple]:
    rng = random.Random(seed)
    passages = [prose(rng, rng.randrange(window - 3, 3 * window)) for _ in range(6)]
    passages.append(["la"] * (window + 7))
    passages.append(["la", "lo"] * window)
    passages.append(prose(rng, 5) + ["la"] * (window - 8) + prose(rng, 5))
    rows: list[tuple] = [(900, None), (901, ""), (902, " \n "), (903, "one two")]
    for key in range(60):
        listed: list[str] = []
        for _ in range(rng.randrange(5)):
            listed += prose(rng, rng.randrange(2 * window))
            if rng.random() < 0.6:
                part = rng.choice(passages)
                at = rng.randrange(3)
                listed += part[at : len(part) - rng.randrange(3)]
            if rng.random() < 0.2:
                listed += ["la"] * rng.randrange(2 * window)
        rows.append((key, rng.choice((" ", "\n", " \t ")).join(listed)))
    rows.append((990, rows[10][1]))
    return rows


@pytest.mark.parametrize(("seed", "window"), [(1, 35), (2, 35), (3, 9)])
def test_by_brute_force(spark, seed, window):
    rows = corpus(seed, window)
    assert got(substrings.remove_repeats(table(spark, rows), window=window)) == expected(rows, window)


def test_digest(spark):
    rows = [(1, "a  b\nc"), (2, None)]
    found = by_key(substrings.summarise(substrings.remove_repeats(table(spark, rows))))
    assert found[1]["kept_sha256"] == hashlib.sha256(b"a b c").hexdigest()
    assert found[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()


def test_repeated_rows_null_keys_and_no_rows(spark):
    text = " ".join(f"w{i}" for i in range(40))
    found = substrings.remove_repeats(table(spark, [(1, text), (1, text), (None, text + " end")])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in found) == [(0, 40), (1, 40), (1, 40)]
    assert substrings.remove_repeats(table(spark, [])).collect() == []


def test_symbols_are_the_same_wherever_their_context_stands():
    rng = random.Random(6)
    shared = prose(rng, 60, 30)
    names = {}
    for before, after in ((3, 9), (17, 2), (0, 0)):
        listed = prose(rng, before, 30) + shared + prose(rng, after, 30)
        found = words.split(pa.array([" ".join(listed)]))
        symbols = substrings.Symbols(found.hashes)
        assert (np.diff(symbols.low) >= 0).all() and (np.diff(symbols.high) >= 0).all()
        inside = (symbols.low >= before) & (symbols.high <= before + 60)
        own = set(zip((symbols.begin - before)[inside].tolist(), (symbols.end - before)[inside].tolist(), symbols.name[inside].tolist()))
        names[before] = own
    assert names[3] == names[17] and len(names[3]) > 10 and names[0] <= names[3]


def test_words_of_two_letters_in_patterns_differ(spark):
    one, other = thue_morse(1024)
    shared_words = prose(random.Random(1), 34)
    rows = [(1, " ".join([one, *shared_words])), (2, " ".join([other, *shared_words]))]
    assert got(substrings.remove_repeats(table(spark, rows))) == expected(rows, 35)
    patterns = [(i, t) for i, t in enumerate(thue_morse(4096, "w ", "v "))]
    assert got(substrings.remove_repeats(table(spark, patterns))) == expected(patterns, 35)


def test_a_text_of_20_mb(spark):
    passage = " ".join(prose(random.Random(3), 60))
    long = " ".join(f"n{i}" for i in range(2_500_000))
    rows = [(1, f"{long} {passage}"), (2, f"before {passage} after")]
    found = got(substrings.remove_repeats(table(spark, rows)))
    assert found == {1: (2_500_060, 60, long), 2: (62, 60, "before after")}
