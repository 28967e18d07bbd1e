"""Periodic runs of words, by enumeration of maximal pairs.

A maximal pair is two places of a text where the same words follow, as many as possible, and
different words stand before. Two places ``period`` words apart with ``length - period`` words
in common are the first and second word period of a stretch that no neighbour extends: so the
maximal pairs whose distance is short enough against their common words are the runs
themselves, and nothing is extended afterwards.

Suffixes are sorted by doubled ranks, and the tree of their LCP intervals is built from the
bottom up. Each interval holds the places of its suffixes in text order, filed with the word to
their left. Where two children meet, a place of the smaller one pairs only with places of the
other that are within reach and have another left word. Within reach of one another, places with
the same words ahead lie in one stretch of their period. There all but the first place have the
same left word, and all but the last the same word after: only the ends of the reach can pair,
and two look-ups find them, however many places lie between.

Only words near a short sequence that soon comes again enter the tree: every run is made of such.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import shared

MIN_LENGTH = 6
MIN_EXPONENT = 4
SLICE_BYTES = 1 << 20
_SIFTINGS = 8  # rounds of a filter that loses nothing, whenever it ends


def seed_words(min_length: int, min_exponent: int) -> int:
    """Words in common, at least, of a pair that is a run."""
    return min(max((min_exponent - 1) * q, min_length - q) for q in range(1, min_length + 1))


def gram_names(ids: np.ndarray, size: int) -> np.ndarray:
    """Numbers of every ``size`` consecutive ids, equal for equal ids; texts' edges not regarded."""

    def both(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        width = np.int64(max(one.max(initial=0), other.max(initial=0)) + 1)
        return np.unique(one * width + other, return_inverse=True)[1].astype(np.int64)

    names, reach = ids.astype(np.int64), 1
    if len(ids) < size:
        return np.empty(0, np.int64)
    while reach < size:
        step = min(reach, size - reach)
        names = both(names[: len(names) - step], names[step:])
        reach += step
    return names


def stretches(ids: np.ndarray, first: np.ndarray, size: int, share: int) -> list[tuple[int, int]]:
    """Stretches of words (begin, end) outside which no maximal pair of a run lies.

    ``first`` has the bounds of the texts. In a run every place but the last ones has its next
    ``size`` words again at most ``period`` later, and that is the ``share``-th part of the
    common words at most.
    """
    names = gram_names(ids, size)
    count = len(names)
    if not count:
        return []
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    own = owner[:count] == owner[size - 1 :]
    order = np.argsort(names, kind="stable")
    ahead = np.full(count, np.iinfo(np.int64).max)
    here, then = order[:-1], order[1:]
    again = (names[here] == names[then]) & own[here] & own[then] & (owner[here] == owner[then])
    ahead[here[again]] = then[again] - here[again]
    at = np.flatnonzero(ahead < count)
    for _ in range(_SIFTINGS):
        if not len(at):
            return []
        head = np.append(True, np.diff(at) > 1)
        length = np.diff(np.append(np.flatnonzero(head), len(at)))
        reach = np.repeat((length + size - 1) // share, length)
        stays = ahead[at] <= reach
        if stays.all():
            break
        at = at[stays]
    if not len(at):
        return []
    head = np.flatnonzero(np.append(True, np.diff(at) > 1))
    length = np.diff(np.append(head, len(at)))
    begin = at[head]
    stop = first[owner[begin] + 1]
    end = np.minimum(begin + length + size + (length + size - 1) // share, stop)
    found: list[tuple[int, int]] = []
    for low, high in zip(begin.tolist(), end.tolist()):
        if found and low <= found[-1][1] and owner[low] == owner[found[-1][0]]:
            found[-1] = (found[-1][0], max(high, found[-1][1]))
        else:
            found.append((low, high))
    return found


def suffix_array(ids: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes of all parts in order, part by part, and each suffix's rank."""
    count = len(ids)
    stop = np.searchsorted(part, part, side="right")
    rank = np.unique(part.astype(np.int64) * (np.int64(ids.max()) + 1) + ids, return_inverse=True)[1]
    reach = 1
    while rank.max() < count - 1:
        after = np.zeros(count, np.int64)
        inside = np.flatnonzero(np.arange(count) + reach < stop)
        after[inside] = rank[inside + reach] + 1
        rank = np.unique(rank * np.int64(count + 1) + after, return_inverse=True)[1]
        reach *= 2
    places = np.empty(count, np.int64)
    places[rank] = np.arange(count)
    return places, rank


def common_words(ids: np.ndarray, part: np.ndarray, places: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Words that each suffix in order has in common with the one before it."""
    common = np.zeros(len(ids), np.int32)
    stop = np.searchsorted(part, part, side="right").astype(np.int32)
    word, after, at, number = (
        memoryview(np.ascontiguousarray(a, np.int32)) for a in (ids, stop, places, rank)
    )
    out = memoryview(common)
    same = 0
    for here in range(len(ids)):
        row = number[here]
        before = at[row - 1] if row else here
        if not row or after[before] != after[here]:
            same = 0
            continue
        most = after[here] - max(here, before)
        while same < most and word[here + same] == word[before + same]:
            same += 1
        out[row] = same
        same = max(0, same - 1)
    return common


def close_pairs(
    places: np.ndarray, common: np.ndarray, left: np.ndarray, least: int, share: int
) -> Iterator[tuple[int, int, int]]:
    """Maximal pairs ``(place, later place, words in common)`` of ``least`` words or more.

    Their distance is at most the ``share``-th part, 2 or more, of the words in common.
    """
    at, same, word = (memoryview(np.ascontiguousarray(a, np.int32)) for a in (places, common, left))
    open_: list[tuple[int, list[int]]] = []  # intervals: words in common, places of the children so far

    def meet(one: list[int], other: list[int], length: int) -> Iterator[tuple[int, int, int]]:
        few, many = (one, other) if len(one) <= len(other) else (other, one)
        reach = length // share
        for place in few:
            low = bisect_left(many, place - reach)
            if low < len(many) and many[low] < place and word[many[low]] != word[place]:
                yield many[low], place, length
            high = bisect_right(many, place + reach) - 1
            if high >= 0 and many[high] > place and word[many[high]] != word[place]:
                yield place, many[high], length

    def merged(one: list[int], other: list[int]) -> list[int]:
        few, many = (one, other) if len(one) <= len(other) else (other, one)
        if few[0] > many[-1]:
            many.extend(few)
        elif 16 * len(few) < len(many):
            for place in few:
                insort(many, place)
        else:
            many += few
            many.sort()
        return many

    count = len(at)
    for row in range(count):
        following = same[row + 1] if row + 1 < count else 0
        if not open_ and following < least:
            continue
        done = [at[row]]
        while open_ and open_[-1][0] > following:
            length, held = open_.pop()
            yield from meet(held, done, length)
            done = merged(held, done)
        if following >= least:
            if open_ and open_[-1][0] == following:
                yield from meet(open_[-1][1], done, following)
                open_[-1] = (following, merged(open_[-1][1], done))
            else:
                open_.append((following, done))


def find(
    ids: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT
) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and period.

    ``ids`` has the texts' words as numbers, one text after the other, ``first`` the bounds of
    the texts, one more than there are.
    """
    share, least = min_exponent - 1, seed_words(min_length, min_exponent)
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(len(first) - 1)]
    bounds = stretches(ids, first, least, share)
    if not bounds:
        return runs
    begin, end = (np.array(edge, np.int64) for edge in zip(*bounds))
    size = end - begin
    part = np.repeat(np.arange(len(bounds)), size)
    origin = np.arange(len(part)) + np.repeat(begin - (np.cumsum(size) - size), size)
    inner = ids[origin].astype(np.int64)
    text = np.searchsorted(first, origin, side="right") - 1
    left = np.where(origin > first[text], ids[origin - 1].astype(np.int64), -1)
    places, rank = suffix_array(inner, part)
    common = common_words(inner, part, places, rank)
    shortest: dict[tuple[int, int, int], int] = {}
    for one, other, length in close_pairs(places, common, left, least, share):
        here, there, owner = int(origin[one]), int(origin[other]), int(text[one])
        after = there + length
        if after < first[owner + 1] and ids[after] == ids[here + length]:
            continue  # the stretch was cut here, the text was not: no maximal pair
        period = there - here
        if length + period >= min_length:
            key = (owner, here, after)  # multiples of a period span the same words
            shortest[key] = min(period, shortest.get(key, period))
    for (owner, here, after), period in shortest.items():
        runs[owner].append((here - int(first[owner]), after - here, period))
    for found in runs:
        found.sort(key=lambda run: (run[0], run[2]))
    return runs


def strongest(runs: list[tuple[int, int, int]]) -> int | None:
    """Which run has the greatest exact exponent; the first by start and period of equal ones."""
    if not runs:
        return None
    return min(range(len(runs)), key=lambda i: (-Fraction(runs[i][1], runs[i][2]), runs[i][0], runs[i][2]))


def collapsed(listed: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period, joined by spaces."""
    if runs:
        edge = np.zeros(len(listed) + 1, np.int64)
        start, length, period = (np.array(c) for c in zip(*runs))
        np.add.at(edge, start + period, 1)
        np.add.at(edge, start + length, -1)
        listed = [listed[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    return b" ".join(listed)


def find_runs(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_exponent: int = MIN_EXPONENT,
) -> DataFrame:
    """``key, n_words, runs, strongest, collapsed`` of every row, from its whole text.

    Words are what white space (blank, U+0009 to U+000D) separates. ``runs`` lists start, length
    and smallest period of every stretch of ``min_length`` words and ``min_exponent`` periods
    (3 or more) that no neighbouring word extends, by start and period. ``strongest`` is the
    place in that list of the run with most periods, NULL without runs; of equal ones the
    earliest, then that of the shortest period. ``collapsed`` is the text with one period left
    of each run, its words joined by single blanks.

    NULL, empty and wordless texts have no words, no runs and an empty ``collapsed``. Repeated
    rows and keys, NULL ones too, each give a row; an empty table gives an empty one; other
    columns are not read. A text is one task's work, however long it is: about 60 bytes of
    memory a word, and 60 more a word inside runs; time grows with its words and their runs.
    """
    if min_exponent < 3 or min_length < 2:
        raise ValueError("runs have three periods and two words at least")
    shared.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    entry = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text", SLICE_BYTES):
                listed = [(t or "").encode("utf-8", "surrogatepass").split() for t in part["text"].to_pylist()]
                counts = [len(words) for words in listed]
                first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
                names = pa.array([w for words in listed for w in words], pa.binary()).dictionary_encode()
                runs = find(names.indices.to_numpy(), first, min_length, min_exponent)
                del names
                kept = [collapsed(*pair).decode("utf-8", "surrogatepass") for pair in zip(listed, runs)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        pa.array(counts, pa.int64()),
                        pa.array(
                            [[dict(zip(("start", "length", "period"), r)) for r in found] for found in runs], entry
                        ),
                        pa.array([strongest(found) for found in runs], pa.int32()),
                        pa.array(kept, pa.string()),
                    ],
                    ["key", "n_words", "runs", "strongest", "collapsed"],
                )

    out = rows.mapInArrow(
        search,
        f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, "
        "strongest int, collapsed string",
    )
    return out.withColumnRenamed("key", key)


def with_periods(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, text`` with a tenth of the texts made periodic from some word on, by their key.

    With h the CRC-32 of the decimal key and g = h div 10, the words from a = g mod n on repeat
    the first 1 + (n - a) div (3 + g mod 8) of them, where h is a multiple of 10. Other texts,
    those without words and those of NULL keys stay as they are.
    """
    code = F.crc32(F.col("key").cast("string"))
    words = F.filter(F.split("text", r"[ \t-\r]+"), lambda w: w != "")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = rows.withColumn("words", F.when(code % 10 == 0, words))
    rows = rows.withColumn("n", F.greatest(F.size("words"), F.lit(0)).cast("long")).withColumn(
        "g", ((code - code % 10) / 10).cast("long")
    )
    rows = rows.withColumn("a", F.col("g") % F.greatest("n", F.lit(1)))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    period = F.transform(
        F.sequence(F.lit(0).cast("long"), F.greatest("n", F.lit(1)) - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    changed = F.when(F.col("n") > 0, F.array_join(period, " ")).otherwise(F.col("text"))
    return rows.select(F.col("key").alias(key), changed.alias(text))


def summarise(found: DataFrame) -> DataFrame:
    """Number of runs, the strongest one, and digests of all runs and of the collapsed text."""
    best = F.get("runs", F.col("strongest"))
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    digested = [c for c in found.columns if c not in ("runs", "strongest", "collapsed", "n_words")]
    return found.select(
        *digested,
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
