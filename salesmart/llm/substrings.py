"""Substring dedup by recompression: equal passages get equal symbols inside.

Words are named by their hashes; rounds then name runs of equal symbols and pairs of
neighbours. Which neighbours pair is told by one bit of each name, and a name is a hash of what
it stands for, so rounds in all tasks agree without meeting. With each symbol goes its context:
the words that decided it. A symbol whose context lies within a window of words is the same
wherever that window stands.

A window's anchor is its best such symbol, high ones before low. Anchors with equal contexts in
more than one place are looked up; all windows of such an anchor are one block. Equal blocks
repeat whole; where an anchor has several blocks, their windows are compared one by one.
Windows without an anchor, as within long runs, are compared directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import links, shared, words

WINDOW = 35
ROUNDS = 2
_A, _B, _C = (np.uint64(x) for x in (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5))


class Symbols:
    """Symbols of a sequence of names: what they cover, and the words that decided them."""

    def __init__(self, names: np.ndarray, rounds: int = ROUNDS):
        count = len(names)
        self.name = names.copy()
        self.begin = np.arange(count)
        self.end = self.begin + 1
        self.low, self.high = self.begin.copy(), self.end.copy()  # the context
        for number in range(rounds):
            if len(self.name):
                self._runs(count)
                self._pairs(np.uint64(number + 1), count)

    def _runs(self, count: int) -> None:
        new = np.ones(len(self.name), bool)
        new[1:] = self.name[1:] != self.name[:-1]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(self.name)) - 1
        length = last - first + 1
        name = self.name[first]
        self.name = np.where(length > 1, words.mix(name * _A + length.astype(np.uint64)), name)
        # That a run ends is seen from its neighbours; none at an edge could be any symbol.
        low = np.append(self.low, -1)[first - 1]
        low[first == 0] = -1
        high = np.append(self.high, count + 1)[last + 1]
        self.begin, self.end, self.low, self.high = self.begin[first], self.end[last], low, high

    def _pairs(self, number: np.uint64, count: int) -> None:
        left = words.mix(self.name ^ (number * _C)) & np.uint64(1) == 0
        pair = np.zeros(len(left), bool)
        pair[:-1] = left[:-1] & ~left[1:]
        second = np.zeros(len(left), bool)
        second[1:] = pair[:-1]
        after_name = np.append(self.name[1:], np.uint64(0))
        after_end = np.append(self.end[1:], count + 1)
        after_high = np.append(self.high[1:], count + 1)
        before_low = np.insert(self.low[:-1], 0, -1)
        name = np.where(pair, words.mix(self.name * _A + after_name * _B + number), self.name)
        end = np.where(pair, after_end, self.end)
        low = np.where(left, self.low, before_low)  # a right one alone has a right one before it
        high = np.where(left, after_high, self.high)
        kept = ~second
        self.name, self.end, self.low, self.high = name[kept], end[kept], low[kept], high[kept]
        self.begin = self.begin[kept]


def _lowest(rank: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The place of the least of ``rank[begin:end]``, the first of equals; ranges are not empty."""
    table = [np.arange(len(rank))]
    reach = 1
    while reach * 2 <= int((end - begin).max(initial=1)):
        one, two = table[-1][:-reach], table[-1][reach:]
        table.append(np.where(rank[two] < rank[one], two, one))
        reach *= 2
    level = np.frexp((end - begin).astype(float))[1] - 1
    out = np.empty(len(begin), np.int64)
    for k, places in enumerate(table):
        at = np.flatnonzero(level == k)
        one, two = places[begin[at]], places[end[at] - (1 << k)]
        out[at] = np.where(rank[two] < rank[one], two, one)
    return out


class Blocks:
    """The windows of a batch of texts, those of an anchor together.

    ``feature`` names the anchor's context, ``block`` all words of its windows; a window
    without an anchor is a block of its own, and ``feature`` its hash.
    """

    def __init__(self, texts: pa.Array, window: int = WINDOW):
        found = words.split(texts)
        names, counts = found.hashes, found.counts()
        self.first = found.first
        self.owner = self.start = self.size = np.empty(0, np.int64)
        self.feature = self.block = self.window = np.empty(0, np.uint64)
        self.anchored = np.empty(0, bool)
        starts = np.maximum(0, counts - window + 1)
        total = int(starts.sum())
        if not total:
            return
        owner = np.repeat(np.arange(len(counts)), starts)
        at = np.arange(total) - np.repeat(np.cumsum(starts) - starts, starts) + np.repeat(found.first[:-1], starts)
        spans, symbols = words.Spans(names), Symbols(names)
        low = np.searchsorted(symbols.low, at)
        high = np.searchsorted(symbols.high, at + window, side="right")
        some = low < high
        order = words.mix(symbols.name ^ _C) >> np.uint64(1)
        order |= (symbols.end - symbols.begin < 3).astype(np.uint64) << np.uint64(63)
        anchor = np.full(total, -1)
        if some.any():
            anchor[some] = _lowest(order, low[some], high[some])
        new = np.ones(total, bool)
        new[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1]) | ~some[1:]
        begin = np.flatnonzero(new)
        self.size = np.diff(np.append(begin, total))
        self.offset = begin
        self.owner, self.start = owner[begin], at[begin] - found.first[owner[begin]]
        self.window = spans(at, at + window)
        self.block = spans(at[begin], at[begin] + self.size + window - 1)
        self.anchored = some[begin]
        chosen = anchor[begin[self.anchored]]
        self.feature = self.window[begin].copy()
        self.feature[self.anchored] = words.mix(spans(symbols.low[chosen], symbols.high[chosen]) ^ _A)


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    shared.bound_batches(docs.sparkSession)
    return docs.select(
        F.col(key).alias("key"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("version"), F.col(text).alias("text")
    )


def _blocks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[pa.RecordBatch, Blocks]]:
    for batch in batches:
        for part in shared.by_bytes(batch, "text", 1 << 20):
            yield part, Blocks(part["text"], window)


def repeated_spans(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, version, spans``: the stretches of words (start, end) in windows that repeat.

    Rows without any are left out; ``version`` is a hash of the text.
    """
    spark = docs.sparkSession
    rows = _rows(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in _blocks(batches, window):
            name, n = np.unique(found.feature[found.anchored], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n.astype(np.int64))], ["id", "n"])

    several = (
        rows.select("text").mapInArrow(features, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).filter("n > 1")
    )
    wanted = links.id_filter(spark, shared.stored(several.select("id"), "features"))

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _blocks(batches, window):
            name = found.feature.view(np.int64)
            at = np.flatnonzero(~found.anchored | links.may_hold(wanted.value, name))
            if not len(at):
                continue
            size = found.size[at]
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(found.offset[at], size)
            offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
            owner = pa.array(found.owner[at])
            yield pa.RecordBatch.from_arrays(
                [
                    part["key"].take(owner),
                    part["version"].take(owner),
                    pa.array(found.start[at].astype(np.int32)),
                    pa.array(name[at]),
                    pa.array(found.block[at].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.window[place].view(np.int64))),
                ],
                ["key", "version", "start", "feature", "block", "windows"],
            )

    occurs = shared.stored(
        rows.mapInArrow(
            occurrences,
            f"key {kind}, version long, start int, feature long, block long, windows array<long>",
        ),
        "occurrences",
    )
    blocks = occurs.groupBy("feature", "block").agg(F.count("*").alias("n"), F.first("windows").alias("windows"))
    blocks = shared.stored(blocks, "blocks")
    # An anchor with one block only: the block repeats whole, or not at all.
    anchors = blocks.groupBy("feature").agg(F.count("*").alias("blocks"))
    mixed = blocks.join(anchors.filter("blocks > 1").select("feature"), "feature", "left_semi")
    windows = mixed.select("n", F.explode("windows").alias("window"))
    counts = windows.groupBy("window").agg(F.sum("n").alias("n")).filter("n > 1").select("window")
    inner = (
        mixed.filter("n = 1")
        .select("feature", "block", F.posexplode("windows").alias("place", "window"))
        .join(counts, "window", "left_semi")
        .groupBy("feature", "block")
        .agg(F.collect_set("place").alias("places"))
    )
    whole = blocks.filter("n > 1").select("feature", "block", F.lit(None).cast("array<int>").alias("places"))
    hits = occurs.select("key", "version", "start", "feature", "block", F.size("windows").alias("size")).join(
        whole.unionByName(inner), ["feature", "block"]
    )
    span = lambda first, last: F.struct(first.alias("start"), last.alias("end"))
    start = F.col("start")
    spans = F.when(
        F.col("places").isNull(), F.array(span(start, start + F.col("size") + (window - 1)))
    ).otherwise(F.transform("places", lambda p: span(start + p, start + p + window)))
    found = (
        hits.select("key", "version", F.explode(spans).alias("span"))
        .groupBy("key", "version")
        .agg(F.collect_list("span").alias("spans"))
    )
    out = shared.stored(found, "spans")
    shared.discard(occurs)
    shared.discard(blocks)
    return out


def remove_repeats(docs: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``key, n_words, n_removed, kept`` of every row: the text without words in repeated windows.

    A window is ``window`` consecutive words; it repeats if its words also stand in a row
    elsewhere, in the same document or another. All are judged on the input. ``kept`` has the
    other words joined by single spaces. NULL and wordless texts and texts of fewer words lose
    nothing. Rows that are repeated, even whole, repeat each other's windows. An empty table
    gives an empty one. Other columns are not read.
    """
    spans = repeated_spans(docs, key=key, text=text, window=window)
    rows = _rows(docs, key, text)
    kind = rows.schema["key"].dataType.simpleString()
    same = F.col("r.key").eqNullSafe(F.col("s.key")) & (F.col("r.version") == F.col("s.version"))
    both = rows.alias("r").join(spans.alias("s"), same, "left").select("r.key", "r.text", "s.spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                total, removed, kept = [], [], []
                for value, gone in zip(part["text"], part["spans"]):
                    listed = (value.as_py() or "").encode("utf-8", "surrogatepass").split()
                    total.append(len(listed))
                    if gone.is_valid:
                        edge = np.zeros(len(listed) + 1, np.int64)
                        ends = gone.values
                        np.add.at(edge, ends.field("start").to_numpy(), 1)
                        np.add.at(edge, ends.field("end").to_numpy(), -1)
                        stays = np.cumsum(edge[:-1]) == 0
                        listed = [listed[i] for i in np.flatnonzero(stays)]
                    removed.append(total[-1] - len(listed))
                    kept.append(b" ".join(listed).decode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays(
                    [part["key"], pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    ["key", "n_words", "n_removed", "kept"],
                )

    out = both.mapInArrow(cut, f"key {kind}, n_words long, n_removed long, kept string")
    return out.withColumnRenamed("key", key)


def summarise(removed: DataFrame) -> DataFrame:
    """The digest of the kept text in its place."""
    return removed.select(
        *[c for c in removed.columns if c != "kept"], F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )
