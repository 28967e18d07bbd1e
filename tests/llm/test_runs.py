from __future__ import annotations

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import runs
from salesmart.llm.queries import QUERIES
from tests.llm.helpers import SF, by_key, table, white_words


def plain_runs(words: list, min_length: int = 6, min_exponent: int = 4) -> list[tuple[int, int, int]]:
    """Every period's stretches of equal words, the smallest period of each kept."""
    found = {}
    for period in range(1, len(words) // min_exponent + 1):
        start = 0
        for i in range(period, len(words) + 1):
            if i == len(words) or words[i] != words[i - period]:
                length = i - start
                if length >= max(min_length, min_exponent * period):
                    found.setdefault((start, length), period)
                start = i - period + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def found_in(texts: list[list[int]], *limits) -> list:
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return runs.find(np.array([w for t in texts for w in t], np.int32), first, *limits)


PIECES = st.lists(
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=5), st.integers(1, 7)), max_size=6
).map(lambda made: [w for unit, times in made for w in unit * times])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, min_size=1, max_size=4), st.sampled_from([(6, 4), (2, 3), (9, 3), (6, 5)]))
def test_runs_are_those_of_a_search_by_period(texts, limits):
    assert found_in(texts, *limits) == [plain_runs(t, *limits) for t in texts]


def test_long_random_texts_with_nested_runs():
    rng = random.Random(5)
    texts = []
    for _ in range(6):
        words = []
        for _ in range(40):
            unit = [rng.randrange(3) for _ in range(rng.randrange(1, 6))] * rng.randrange(1, 6)
            unit += [rng.randrange(50) for _ in range(rng.randrange(4))]
            words += unit * rng.randrange(1, 6)
        texts.append(words)
    assert found_in(texts) == [plain_runs(t) for t in texts]


def test_words_before_and_after_a_stretch_are_looked_at():
    unit = list(range(10, 17))
    words = [16] + unit * 5 + unit[:3] + [99] + unit * 4 + [98] + unit * 2
    assert found_in([words]) == [plain_runs(words)] == [[(0, 39, 7), (40, 28, 7)]]


def test_one_word_very_often_and_very_long_texts(spark):
    many = 300_000
    assert found_in([[7] * many]) == [[(0, many, 1)]]
    cycle = list(range(1000)) * 200
    assert found_in([cycle]) == [[(0, 200_000, 1000)]]
    text = " ".join(f"word{i}" for i in range(1_000_000)) + " " + "again and " * 800_000  # 20 MB
    row = runs.find_runs(table(spark, [(1, text)])).first()
    assert row.n_words == 2_600_000
    assert [tuple(r) for r in row.runs] == [(1_000_000, 1_600_000, 2)]
    assert row.collapsed == text[: text.index("again")] + "again and"


def test_other_limits_are_refused(spark):
    with pytest.raises(ValueError):
        runs.find_runs(table(spark, [(1, "a")]), min_exponent=2)


def test_edges(spark):
    long = "ab " * 5 + "cd"
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "ab " * 6), (5, "ab " * 5), (6, "a b " * 4 + "c"), (7, long), (7, long),
        (None, "x\x1cy " * 6), (8, "a a " * 7),
    ]
    found = runs.find_runs(table(spark, rows))
    assert found.columns == ["doc_id", "n_words", "runs", "strongest", "collapsed"]
    got = sorted(
        ((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest, r.collapsed) for r in found.collect()),
        key=str,
    )
    expected = [
        (1, 0, [], None, ""), (2, 0, [], None, ""), (3, 0, [], None, ""), (4, 6, [(0, 6, 1)], 0, "ab"),
        (5, 5, [], None, "ab ab ab ab ab"), (6, 9, [(0, 8, 2)], 0, "a b c"), (7, 6, [], None, long), (7, 6, [], None, long),
        (8, 7, [(0, 7, 1)], 0, "a a"), (None, 6, [(0, 6, 1)], 0, "x\x1cy"),
    ]
    assert got == sorted(expected, key=str)
    assert runs.find_runs(table(spark, [])).collect() == []


def test_the_strongest_run():
    assert runs.strongest([]) is None
    assert runs.strongest([(0, 8, 2), (0, 9, 1), (20, 9, 1)]) == 1
    assert runs.strongest([(0, 400_000_001, 100_000_000), (5, 400_000_002, 100_000_000)]) == 1


def expected_row(doc_id: int | None, text: str | None) -> tuple:
    words = white_words(text)
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))
    return len(found), *best, milli, *digests


def test_query_against_a_search_by_period(spark):
    found = by_key(QUERIES["op11_runs"](spark, SF))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = [d for d in docs if len(d.text or "") < 40_000]
    assert len(found) == len(docs) and len(short) > 0.9 * len(docs)
    for d in short:
        assert tuple(found[d.doc_id][c] for c in columns) == expected_row(d.doc_id, d.text)
    assert any(r["n_runs"] for r in found.values())


def test_texts_made_periodic(spark):
    keys = [k for k in range(200) if crc32(str(k).encode()) % 10 == 0][:3]
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(k, text) for k in keys] + [(keys[0] + 1, text), (keys[1], None), (keys[2], " "), (None, text)]
    got = runs.summarise(runs.find_runs(runs.with_periods(table(spark, rows)))).collect()
    columns = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(str((r.doc_id, *(r[c] for c in columns))) for r in got) == sorted(
        str((k, *expected_row(k, t))) for k, t in rows
    )
