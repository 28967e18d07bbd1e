from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa

from salesmart.llm import fingerprints
from tests.llm.helpers import by_key, prose, table, white_words


def jaccard(a: str, b: str) -> float:
    sets = []
    for text in (a, b):
        w = white_words(text)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def test_edits_and_likeness_by_brute_force(spark):
    rng = random.Random(8)
    texts: dict[int, str | None] = {5: None, 9: "", 11: " \n", 13: "one", 17: "é中🙂 two three four five six"}
    for key in rng.sample(range(100, 9000), 120):
        texts[key] = " ".join(prose(rng, rng.randrange(400)))
    texts[9500] = texts[min(k for k in texts if k > 100)]
    found = by_key(fingerprints.fingerprint_edits(table(spark, list(texts.items()))))
    order = sorted(texts, reverse=True)
    errors = []
    for at, key in enumerate(order):
        own, follower = texts[key] or "", texts[order[(at + 1) % len(order)]] or ""
        count = len(own) // 3
        changed = own[: len(own) - count] + follower[:count]
        row = found[key]
        assert row["n_chars"] == len(own)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        errors += [row["near_edited"] - jaccard(own, changed), row["near_next"] - jaccard(own, follower)]
    assert np.abs(errors).mean() < 0.03 and np.abs(errors).max() < 0.25 and abs(np.mean(errors)) < 0.01
    assert found[9500]["fingerprint"] == found[min(k for k in texts if k > 100)]["fingerprint"]
    assert found[5]["fingerprint"] == "" and found[5]["near_next"] in (0.0, 1.0)


def test_packing_and_bias():
    rng = np.random.default_rng(1)
    bins = rng.integers(0, 16, (50, fingerprints.BINS)).astype(np.uint8)
    assert (np.stack([fingerprints.unpack(p) for p in fingerprints.pack(bins)]) == bins).all()
    other = rng.integers(0, 16, bins.shape).astype(np.uint8)
    assert fingerprints.likeness(bins, other).mean() < 0.03 and (fingerprints.likeness(bins, bins) == 1).all()
    none = fingerprints.bins_of(pa.array(["", None, "x"]))
    assert fingerprints.likeness(none[:2], none[1:]).tolist() == [1.0, 0.0]


def test_short_texts_fill_all_bins_alike():
    found = fingerprints.bins_of(pa.array(["a b c d e f", "a b  c d e\nf", "a b c d e f g"]))
    assert (found[0] == found[1]).all() and 0.4 < fingerprints.likeness(found[:1], found[2:])[0] < 0.9


def test_ties_null_keys_and_no_rows(spark):
    rows = [(2, "b x y"), (2, "a x y"), (None, "last"), (7, "first one"), (2, "a x y")]
    found = fingerprints.fingerprint_edits(table(spark, rows)).collect()
    edits = [("first one", "a x y"), ("a x y", "a x y"), ("a x y", "b x y"), ("b x y", "last"), ("last", "first one")]
    digests = sorted(hashlib.sha256(fingerprints.edited(a, b).encode()).hexdigest() for a, b in edits)
    assert sorted(r.edited_sha256 for r in found) == digests
    assert fingerprints.fingerprint_edits(table(spark, [])).collect() == []
    alone = fingerprints.fingerprint_edits(table(spark, [(1, "abcdef")])).collect()[0]
    assert alone.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()


def test_plain_fingerprints(spark):
    found = by_key(fingerprints.fingerprint(table(spark, [(1, "x y z"), (2, "x  y\nz"), (3, None)])))
    assert found[1]["fingerprint"] == found[2]["fingerprint"] != "" and found[3]["fingerprint"] == ""
