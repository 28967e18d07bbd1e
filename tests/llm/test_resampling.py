from __future__ import annotations

import math
import random
from collections import Counter
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import resampling
from tests.llm.helpers import plain_words, table


def plain(docs: list[tuple], target: list[str | None], orders=(1, 1), buckets=10_000, percent=10, min_words=20) -> list:
    def features(text):
        listed = plain_words(text)
        return [" ".join(listed[i : i + n]) for n in range(orders[0], orders[1] + 1) for i in range(len(listed) - n + 1)]

    bucket = lambda f: crc32(f.encode()) % buckets
    corpus = Counter(bucket(f) for _, text in docs for f in features(text))
    wanted = Counter(bucket(f) for text in target for f in features(text))
    S, T = corpus.total(), wanted.total()
    gain = lambda b: math.floor(1000 * math.log((wanted[b] + 1) * (S + buckets) / ((corpus[b] + 1) * (T + buckets))))
    rows = []
    for key, text in docs:
        found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(plain_words(text)) >= min_words])
    long = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0]))
    for place, row in enumerate(long[: len(long) * percent // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def texts(count: int, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"Wort{i}" for i in range(300)] + ["é", "中文", "I'm"]
    return [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(count)]


ODD = [(500, None), (501, ""), (502, "-- !!"), (503, "A a A-a"), (503, "A a A-a"), (504, "word " * 300_000), (505, "x\x00y\x1cz")]


@pytest.mark.parametrize("orders", [(1, 1), (1, 2), (2, 3)])
def test_against_a_plain_version(spark, orders):
    docs, target = texts(300) + ODD, [t for _, t in texts(20, 4)] + [None, ""]
    found = resampling.resample(
        table(spark, docs), table(spark, list(enumerate(target)), "item_id long, text string"), orders=orders
    )
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, target, orders)


def test_null_keys_and_empty_tables(spark):
    no_items = table(spark, [], "item_id long, text string")
    rows = [(None, "a b"), (None, "a b"), (3, "a b c")]
    found = resampling.resample(table(spark, rows), no_items).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows, [])
    assert resampling.resample(table(spark, []), no_items).collect() == []
    ties = [(7, "w " * 25)] * 30
    ranked = [r["rank"] for r in resampling.resample(table(spark, ties), no_items).collect()]
    assert sorted(r for r in ranked if r) == [1, 2, 3] and len(ranked) == 30


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.integers(-5000, 5000), min_size=1, max_size=200),
    st.lists(st.lists(st.integers(0, 10**6), max_size=300), min_size=1, max_size=5),
)
def test_bit_slices_add_up_exactly(gain, made):
    codes = [[c % len(gain) for c in text] for text in made]
    owner = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
    flat = np.array([c for text in codes for c in text], np.uint16)
    sums = resampling.GainPlanes(np.array(gain)).sums(flat, owner, len(codes))
    assert sums.tolist() == [sum(gain[c] for c in text) for text in codes]


def test_counts_above_any_power(spark):
    gain = np.array([-7, 5, 0, 1023])
    flat = np.repeat(np.array([0, 1, 3], np.uint16), [70_000, 3, 65_536])
    assert resampling.GainPlanes(gain).sums(flat, np.zeros(len(flat), int), 1).tolist() == [-490_000 + 15 + 1023 * 65_536]


def test_rows_drawn_are_closer_to_the_target(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(f"{'t' if i % 4 == 0 else 'o'}{rng.randrange(50)}" for _ in range(40))) for i in range(400)]
    items = [(i, " ".join(f"t{rng.randrange(50)}" for _ in range(40))) for i in range(30)]
    found = resampling.resample(table(spark, docs), table(spark, items, "item_id long, text string"))
    drawn = [r.doc_id for r in found.filter("rank IS NOT NULL").collect()]
    assert len(drawn) == 40 and sum(k % 4 == 0 for k in drawn) >= 30
