from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from salesmart.llm import words
from tests.llm.helpers import ascii_lower, thue_morse, white_words

TEXT = st.text(alphabet="ab \t\n\x0b\x1cé中A.", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | TEXT, min_size=1, max_size=5), st.booleans())
def test_words_are_those_of_the_pattern(texts, lower):
    found = words.split(pa.array(texts, pa.string()), words.WHITE, lower=lower)
    expected = [white_words(ascii_lower(t) if lower else t) for t in texts]
    got = [
        [found.data[found.start[i] : found.end[i]].tobytes().decode() for i in range(*bounds)]
        for bounds in zip(found.first, found.first[1:])
    ]
    assert got == expected
    names = {}
    for word, name in zip((w for e in expected for w in e), found.hashes.tolist()):
        assert names.setdefault(word, name) == name
    assert len(set(names.values())) == len(names)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | TEXT, min_size=1, max_size=4))
def test_shingle_sets(texts):
    hashes, owner = words.shingle_sets(words.split(pa.array(texts, pa.string())), 5)
    for number, text in enumerate(texts):
        listed = white_words(text)
        shingles = {tuple(listed[i : i + 5]) for i in range(len(listed) - 4)} or ({tuple(listed)} if listed else set())
        assert len(set(hashes[owner == number].tolist())) == len(shingles)


def test_long_grams_are_the_same_wherever_they_stand():
    listed = [f"w{i}" for i in range(60)]
    one = words.split(pa.array([" ".join(listed)]))
    other = words.split(pa.array(["x y " + " ".join(listed)]))
    assert words.grams(one.hashes, 35).tolist() == words.grams(other.hashes, 35)[2:].tolist()


def test_patterns_of_two_letters_or_words_have_names_of_their_own():
    one, other = thue_morse(1024)
    found = words.split(pa.array([one, other, one]))
    assert found.hashes[0] == found.hashes[2] != found.hashes[1]
    for size in (35, 64, 1024, 1500):
        names = [words.split(pa.array([t])).hashes for t in thue_morse(2048, "w ", "v ")]
        whole = [words.Spans(n)(np.array([0]), np.array([size]))[0] for n in names]
        assert whole[0] != whole[1]
        if size < 100:
            assert words.grams(names[0], size)[0] != words.grams(names[1], size)[0]


def test_spans_are_the_same_wherever_they_stand():
    listed = [f"w{i % 9}" for i in range(50)]
    one, other = (words.Spans(words.split(pa.array([p + " ".join(listed)])).hashes) for p in ("", "x y z "))
    begin, size = np.arange(40), np.arange(1, 41) % 11
    size[size == 0] = 5
    assert one(begin, begin + size).tolist() == other(begin + 3, begin + size + 3).tolist()
    names = one(np.zeros(50, int), np.arange(1, 51))
    assert len(set(names.tolist())) == 50
