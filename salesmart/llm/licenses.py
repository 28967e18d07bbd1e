"""License scans: ordered signature rules behind a keyword prefilter.

An automaton finds all keywords of a text in one pass; only the rules of keywords that occur
are tried. Detections are taken by priority, then length; one that lies within a detection
taken before it is dropped, so that a notice stands for the name inside it and a denied
license does not count.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import shared
from salesmart.llm.license_rules import Rule, rules

# Places that always count, whatever else is found there: label and phrase.
BASE = (
    ("mit", b" under the mit license "),
    ("apache-2", b" apache license version 2 "),
    ("cc-by-nc", b" cc by nc "),
)


def _normal_table() -> bytes:
    """Bytes to lower-case letters, digits and bytes of other scripts; all else to a space."""
    table = bytearray(range(256))
    for code in range(0x41, 0x5B):
        table[code] = code + 0x20
    for low, high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
        table[low : high + 1] = b" " * (high + 1 - low)
    return bytes(table)


NORMAL = _normal_table()


@lru_cache(maxsize=1)
def _matcher():
    import ahocorasick

    known = rules()
    by_keyword: dict[bytes, list[int]] = {}
    for number, rule in enumerate(known):
        for keyword in (rule.keyword, *rule.more_keywords):
            by_keyword.setdefault(keyword, []).append(number)
    automaton = ahocorasick.Automaton()
    for keyword, numbers in by_keyword.items():
        automaton.add_word(keyword.decode("latin-1"), numbers)
    automaton.make_automaton()
    return known, automaton


def gated(text: bytes) -> set[int]:
    """Numbers of the rules that have a keyword in ``text`` of words between single spaces."""
    _, automaton = _matcher()
    wanted: set[int] = set()
    for _, numbers in automaton.iter(text.decode("latin-1")):
        wanted.update(numbers)
    return wanted


def detections(text: bytes) -> list[tuple[int, int, Rule]]:
    """Start, end and rule of what stays, in ``text`` of words between single spaces."""
    known, wanted = _matcher()[0], gated(text)
    found = [
        (m.start(), m.end(), known[number]) for number in wanted for m in known[number].pattern.finditer(text)
    ]
    found.sort(key=lambda d: (d[2].priority, d[0] - d[1], d[0], d[2].label or ""))
    longest = max((end - start for start, end, _ in found), default=0)
    kept: list[tuple[int, int, Rule]] = []
    spans: list[tuple[int, int]] = []  # of kept, by start
    for start, end, rule in found:
        near = spans[bisect_left(spans, (end - longest, 0)) : bisect_right(spans, (start, len(text)))]
        if not any(a <= start and end <= b for a, b in near):
            kept.append((start, end, rule))
            insort(spans, (start, end))
    return [d for d in kept if d[2].label is not None]


def base_places(text: bytes) -> list[tuple[int, str]]:
    """Byte offset and label of each place where a base phrase stands."""
    places = []
    for label, phrase in BASE:
        at = text.find(phrase)
        while at >= 0:
            places.append((at, label))
            at = text.find(phrase, at + 1)
    return places


def scan_text(text: str | None) -> dict:
    """Findings of one text: base places by word number, detections as label and word span."""
    listed = (text or "").encode("utf-8", "surrogatepass").translate(NORMAL).split()
    words = b" " + b" ".join(listed) + b" "
    places, found = base_places(words), detections(words)
    if not places and not found:
        return {"n_words": len(listed), "base": [], "spans": []}
    gaps = np.flatnonzero(np.frombuffer(words, np.uint8) == 0x20)
    word_of = lambda offset: int(np.searchsorted(gaps, offset))
    base = [(word_of(at), label) for at, label in places]
    spans = [
        {"label": rule.label, "first": word_of(start) - 1, "last": word_of(end) - 1, "certainty": rule.certainty}
        for start, end, rule in found
    ]
    return {"n_words": len(listed), "base": base, "spans": spans}


FINDINGS = (
    "n_words long, base array<struct<word: long, label: string>>, "
    "detections array<struct<label: string, first: long, last: long, certainty: double>>"
)
_BASE_ARROW = pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())]))
_SPANS_ARROW = pa.list_(
    pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("certainty", pa.float64())])
)


def scan(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, base, detections`` of every row's whole text.

    ``base`` has the word number and label of each base place, ``detections`` the label, first
    and last word and certainty of each detection that no other contains. A NULL or empty text
    has no words and empty lists. Repeated rows and keys each give a row. No row is moved.
    """
    shared.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                found = [scan_text(t) for t in part["text"].to_pylist()]
                base = [[{"word": w, "label": b} for w, b in sorted(f["base"])] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        pa.array(np.array([f["n_words"] for f in found], np.int64)),
                        pa.array(base, _BASE_ARROW),
                        pa.array([f["spans"] for f in found], _SPANS_ARROW),
                    ],
                    ["key", "n_words", "base", "detections"],
                )

    return rows.mapInArrow(find, f"key {kind}, {FINDINGS}").withColumnRenamed("key", key)


def summarise(found: DataFrame) -> DataFrame:
    """One row of numbers and label lists for each row of ``scan``.

    ``score`` is the largest certainty of a detection, at least 0.7 where a base place stands,
    0 where nothing was found.
    """
    base, spans = F.col("base"), F.col("detections")
    labels = lambda c: F.array_sort(F.array_distinct(c))
    joined = lambda c: F.concat_ws(",", labels(c))
    certain = F.coalesce(F.array_max(F.col("detections.certainty")), F.lit(0.0))
    return found.select(
        *[c for c in found.columns if c not in ("base", "detections")],
        F.size(base).cast("long").alias("n_base"),
        F.array_min(F.col("base.word")).alias("first_word"),
        F.array_max(F.col("base.word")).alias("last_word"),
        joined(F.col("base.label")).alias("base_labels"),
        joined(F.concat(F.col("base.label"), F.col("detections.label"))).alias("labels"),
        F.greatest(certain, F.when(F.size(base) > 0, 0.7).otherwise(0.0)).alias("score"),
        F.size(spans).cast("long").alias("n_detections"),
    )
