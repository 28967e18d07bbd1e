from __future__ import annotations

import hashlib
import random

from salesmart.llm import decontaminate
from tests.llm.helpers import by_key, plain_words, prose, table


def expected(docs, items):
    windows: dict[tuple, set] = {}
    for key, text in items:
        listed = plain_words(text)
        size = min(10, len(listed))
        for at in range(len(listed) - size + 1 if listed and key is not None else 0):
            windows.setdefault(tuple(listed[at : at + size]), set()).add(str(key))
    out = {}
    for key, text in docs:
        listed, hit, found = plain_words(text), set(), set()
        for size in {len(w) for w in windows}:
            for at in range(len(listed) - size + 1):
                if names := windows.get(tuple(listed[at : at + size])):
                    hit.update(range(at, at + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[key] = (len(listed), len(hit), len(found), digest, bool(hit))
    return out


def got(df):
    return {
        k: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"])
        for k, r in by_key(decontaminate.summarise(df)).items()
    }


ITEMS = "item_id long, text string"


def test_by_brute_force(spark):
    rng = random.Random(4)
    items = [(i, " ".join(prose(rng, rng.choice((10, 11, 15, 40))))) for i in range(12)]
    items += [(50, "Éa éb three, FOUR"), (51, "solo"), (52, ""), (53, None), (None, "w1 w2 w3"), (54, items[0][1]), (55, "go " * 30)]
    docs: list[tuple] = [(0, None), (1, ""), (2, "--"), (3, "x éb Éa éb THREE four y"), (4, "éa éb three four"), (5, "a solo b SOLO"), (6, "go " * 25)]
    for key in range(10, 60):
        listed = prose(rng, rng.randrange(60))
        for _ in range(rng.randrange(3)):
            words = plain_words(rng.choice(items[:12])[1])
            at = rng.randrange(len(words) - 8)
            part = words[at : at + rng.randrange(8, 14)]
            place = rng.randrange(len(listed) + 1)
            listed[place:place] = part
        docs.append((key, rng.choice((" ", "\n", ". ")).join(listed).upper()))
    found = got(decontaminate.scan(table(spark, docs), table(spark, items, ITEMS)))
    assert found == expected(docs, items)


def test_nothing_to_find(spark):
    docs = [(1, "a b c"), (None, "d")]
    for items in ([], [(1, None)]):
        found = got(decontaminate.scan(table(spark, docs), table(spark, items, ITEMS)))
        assert found == expected(docs, items)
    assert decontaminate.scan(table(spark, []), table(spark, [(1, "a")], ITEMS)).collect() == []


def test_repeated_rows_are_told_apart_by_text(spark):
    docs = [(1, "a b c"), (1, "x y"), (1, "a b c"), (None, "a b c")]
    found = decontaminate.scan(table(spark, docs), table(spark, [(1, "B c")], ITEMS)).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_hit) for r in found) == [(0, 3, 2), (1, 2, 0), (1, 3, 2), (1, 3, 2)]


def test_plan_has_no_python(spark):
    df = decontaminate.scan(table(spark, [(1, "a")]), table(spark, [(1, "a")], ITEMS))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
