from __future__ import annotations

import random
from itertools import combinations

import pytest

from salesmart.llm import jaccard, links
from tests.llm.helpers import Classes, ascii_lower, by_key, prose, table, thue_morse, white_words


def shingles(text: str | None) -> set:
    listed = white_words(ascii_lower(text))
    return {tuple(listed[i : i + 5]) for i in range(len(listed) - 4)} or ({tuple(listed)} if listed else set())


def expected(rows: list[tuple]) -> dict:
    sets = {k: shingles(t) for k, t in rows}
    classes = Classes(sets)
    for a, b in combinations(sets, 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * len(sets[a] | sets[b]):
            classes.join(a, b)
    return {k: (len(sets[k]), classes.find(k)) for k in sets}


def got(df) -> dict:
    return {k: (r["n_shingles"], r["component_id"]) for k, r in by_key(df).items()}


def corpus(seed: int) -> list[tuple]:
    """Copies edited by various amounts, short texts, common passages, long texts."""
    rng = random.Random(seed)
    passage = prose(rng, 12)
    texts: list[str | None] = [None, "", " \n", "one", "One", "two words"]
    for size in (5, 6, 7, 8, 9, 10, 11, 12, 14, 20, 60, 200, 1500):
        base = prose(rng, size)
        for _ in range(8):
            own = list(base)
            for _ in range(rng.randrange(1 + max(1, size // 25))):
                own[rng.randrange(len(own))] = f"w{rng.randrange(4000)}"
            if rng.random() < 0.4:
                own = own[rng.randrange(2) : len(own) - rng.randrange(2)]
            texts.append(" ".join(own + (passage if rng.random() < 0.3 else [])))
    for _ in range(30):
        texts.append(" ".join(passage + prose(rng, rng.randrange(3, 30))))
    keys = rng.sample(range(10_000), len(texts))
    return list(zip(keys, texts))


@pytest.mark.parametrize("seed", (1, 2))
def test_components_by_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    if seed == 2:  # all kinds of lists and splits
        monkeypatch.setattr(links, "BLOCK", 3)
        monkeypatch.setattr(jaccard, "LEAST_FREQUENT", 3)
        monkeypatch.setattr(jaccard, "SEEN", 2)
    assert got(jaccard.join(table(spark, rows))) == expected(rows)


def test_boundary_follows_cost():
    assert jaccard.boundary(1.0) <= jaccard.boundary(10.0) <= jaccard.boundary(1e9) == jaccard.LARGEST_SMALL
    for n in range(1, 60):
        for m in jaccard.partner_sizes(n):
            common = jaccard.overlap(n, m)
            assert 100 * common >= 75 * (n + m - common) > 100 * (common - 1) - 75
            assert common >= n - jaccard.prefix_length(n) + 1


def test_equal_small_subsets_link(spark):
    rows = [(i, " ".join(f"a{j}" for j in range(9 + i % 2))) for i in range(6)]
    assert got(jaccard.join(table(spark, rows))) == expected(rows)


def test_repeated_rows_null_keys_and_no_rows(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(7, long), (7, long), (None, long), (3, "other words here and there"), (None, None)]
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in jaccard.join(table(spark, rows)).collect())
    assert found == [(-1, 0, -1), (-1, 36, 7), (3, 1, 3), (7, 36, 7), (7, 36, 7)]
    assert jaccard.join(table(spark, [])).collect() == []


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 90)], "a long, b long")
    found = {r.id: r.component for r in links.components(edges).collect()}
    assert found == {i: 0 for i in range(51)} | {90: 90, 100: 90}


def test_words_of_two_letters_in_patterns_differ(spark):
    one, other = thue_morse(1024)
    rows = [(1, one), (2, other), (3, f"{other} "), (4, " ".join(thue_morse(1024, "w ", "v ")))]
    rows += [(5 + i, t) for i, t in enumerate(thue_morse(1024, "w ", "v "))]
    assert got(jaccard.join(table(spark, rows))) == expected(rows)


def test_subsets_of_equal_names_are_compared(spark):
    sets = [(1, [1, 2, 3, 4]), (2, [1, 2, 3, 5]), (3, [7, 8, 9, 10]), (4, [1, 2, 3, 4, 6]), (5, [1, 2, 3, 4, 9])]
    small = spark.createDataFrame([(i, len(s), s) for i, s in sets], "id long, size long, small array<long>")
    # One name for subsets that are equal and for one, of set 3, that is not.
    named = [(77, jaccard.UNEQUAL, i, len(s)) for i, s in sets if i != 2]
    found = jaccard._subset_links(spark.createDataFrame(named, "token long, salt int, id long, size long"), small)
    assert sorted((r.a, r.b) for r in found.collect()) == [(1, 4), (1, 5)]


def test_a_text_of_20_mb(spark):
    long = " ".join(f"n{i}" for i in range(2_500_000))
    rows = [(1, long), (2, long + " and a little more"), (3, "n1 n2 n3 n4 n5")]
    assert got(jaccard.join(table(spark, rows))) == {1: (2_499_996, 1), 2: (2_500_000, 1), 3: (1, 3)}
