from __future__ import annotations

import random
import re
from itertools import product

import pytest

from salesmart.llm import licenses
from salesmart.llm.license_rules import rules
from tests.llm.helpers import by_key, plain_words, table

PHRASES = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}


def base(text: str | None) -> tuple:
    listed = plain_words(text)
    places = [
        (at, label)
        for label, phrase in PHRASES.items()
        for at in range(len(listed))
        if listed[at : at + len(phrase.split())] == phrase.split()
    ]
    starts = [at for at, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(listed), len(places), min(starts, default=None), max(starts, default=None), labels


def test_base_places_by_brute_force(spark):
    rng = random.Random(2)
    pool = "under the mit license apache version 2 20 cc by nc CC-BY-NC é x".split()
    texts = [None, "", " ", "MIT", "under the\nMIT-License", "Apache License, Version 2.0", "apache license version 20"]
    texts += [rng.choice((" ", "-", ".\n")).join(rng.choices(pool, k=rng.randrange(60))) for _ in range(200)]
    texts.append("filler " * 50_000 + "Under the MIT license")
    found = by_key(licenses.summarise(licenses.scan(table(spark, list(enumerate(texts))))))
    for key, text in enumerate(texts):
        row = found[key]
        assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["base_labels"]) == base(text)
        assert set(filter(None, row["base_labels"].split(","))) <= set(filter(None, row["labels"].split(",")))
        assert 0 <= row["score"] <= 1


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Released under the MIT License.", {"mit"}),
        ("Licensed under the Apache License, Version 2.0.", {"apache-2"}),
        ("licensed under the GNU General Public License, version 3.", {"gpl-3"}),
        ("Licensed under CC BY-NC 4.0.", {"cc-by-nc-4.0"}),
        ("SPDX-License-Identifier: GPL-2.0-or-later", {"gpl-2-or-later"}),
        ("SPDX-License-Identifier: MIT", {"mit"}),
        ("https://creativecommons.org/licenses/by-sa/4.0/", {"cc-by-sa-4.0"}),
        ("This is not licensed under the GPL v3 at all.", set()),
        ("GNU Lesser General Public License v2.1", {"lgpl-2.1"}),
        ("GNU Affero General Public License version 3", {"agpl-3"}),
        ("a gpl-like thing, mits and bsds", set()),
        ("All rights reserved.", {"proprietary"}),
    ],
)
def test_rules(text, labels):
    assert {s["label"] for s in licenses.scan_text(text)["spans"]} == labels


def test_contained_detections_go_and_others_stay():
    spans = licenses.scan_text("Licensed under the Apache License, Version 2.0. Apache License")["spans"]
    assert [(s["label"], s["first"], s["last"]) for s in sorted(spans, key=lambda s: s["first"])] == [
        ("apache-2", 0, 7), ("apache", 8, 9),
    ]


def test_every_rule_has_its_keyword_where_it_matches():
    assert len(rules()) > 300
    for rule in rules():
        assert rule.keyword == rule.keyword.strip().join((b" ", b" "))


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("Licensed under LGPLv3", "lgpl"), ("released under 0BSD", "0bsd"), ("the FreeBSD license", "bsd-2-clause"),
        ("LGPLv2 code", "lgpl"), ("GPL2", "gpl-2"), ("GPL3", "gpl-3"), ("LGPL3", "lgpl-3"), ("LGPL2.1", "lgpl-2.1"),
        ("AGPL3", "agpl-3"), ("MPL2.0", "mpl-2.0"), ("MulanPSL v2", "mulanpsl-2.0"), ("OpenRAIL license", "openrail-m"),
        ("No copyright reserved.", "cc0-1.0"), ("CeCILL2.1", "cecill-2.1"),
        ("waived all copyright and related or neighboring rights", "cc0-1.0"),
    ],
)
def test_names_without_the_usual_word(text, label):
    assert [s["label"] for s in licenses.scan_text(text)["spans"]] == [label]


def samples(pattern: list, rng: random.Random | None) -> list[str]:
    """Texts of a parsed pattern: with and without every option, or one that ``rng`` draws."""
    parts: list[list[str]] = []
    for op, value in pattern:
        name = str(op)
        if name == "LITERAL":
            made = [chr(value)]
        elif name == "NOT_LITERAL":
            made = ["x"]
        elif name == "IN":
            made = [chr(v if str(k) == "LITERAL" else v[0]) for k, v in value]
        elif name == "BRANCH":
            made = [t for branch in value[1] for t in samples(branch, rng)]
        elif name == "SUBPATTERN":
            made = samples(value[3], rng)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, inner = value
            made = [t * n for n in {low, min(int(high), low + 1)} for t in samples(inner, rng)]
        else:
            assert name in ("ASSERT", "ASSERT_NOT"), name
            continue
        parts.append([rng.choice(made)] if rng else made)
    return ["".join(p) for p in product(*parts)]


def test_no_rule_matches_where_its_keywords_are_missing():
    rng, missed, tried = random.Random(5), [], 0
    for number, rule in enumerate(rules()):
        parsed = list(re._parser.parse(rule.pattern.pattern.decode()))
        many = rule.priority in (0, 3)  # a notice before a name, all whose forms are tried by itself
        for text in {samples(parsed, rng)[0] for _ in range(40)} if many else samples(parsed, None):
            words = f" {text} ".encode()
            tried += 1
            assert rule.pattern.search(words), text
            if number not in licenses.gated(words):
                missed.append((rule.label, text))
    assert tried > 5000 and missed == []


def test_repeated_rows_null_keys_and_no_rows(spark):
    assert licenses.scan(table(spark, [(1, "x"), (1, "x"), (None, None)])).count() == 3
    assert licenses.summarise(licenses.scan(table(spark, []))).collect() == []
