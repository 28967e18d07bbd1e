"""Exact classes of similar items from lists of items that share a token.

Two similar items share a list. A list is compared within tasks: items carry a sketch, whose
parity bits bound from below how much two items differ, so that no similar pair is lost. Of
the pairs that the sketches leave, a list first hands on only a spanning forest; these are
compared exactly and joined into components. Then all remaining pairs of items in different
components follow. Hence a group of many similar items costs about one exact comparison an
item, not one a pair. Long lists are split into blocks, each two of which are a task's unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import shared

SKETCH_BITS = 2048  # at least; sketches of powers of two times as many bits mix with these
SKETCH_BYTES = SKETCH_BITS // 8
BLOCK = 2_048
FILTER_BITS = 1 << 26  # of a Bloom filter, at most: 8 MB
SALTS = 64

#: Given sizes and least differing features of pairs, whether they may be similar.
Near = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def sketches(hashes: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` items the parity of its features in each bit, as bytes."""
    bits = np.bincount(
        owner * SKETCH_BITS + (hashes & np.uint64(SKETCH_BITS - 1)).astype(np.int64),
        minlength=count * SKETCH_BITS,
    )
    return np.packbits((bits & 1).astype(bool).reshape(count, SKETCH_BITS), axis=1)


def shared_lists(rows: DataFrame) -> DataFrame:
    """``token, id`` of the tokens that two ids or more have, from ``token, id, salt``.

    A token known to be frequent has its rows spread by ``salt`` (0 for all others) and is
    taken to be shared. Sorted rows are streamed; of a token only the last row is held.
    """
    shared.bound_batches(rows.sparkSession)
    dealt = rows.repartition("token", "salt").sortWithinPartitions("token", "id")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.empty(0, np.int64), np.empty(0, np.int64))
        emitted: tuple[int, int] | None = None  # the last row that went out
        for batch in batches:
            token, item = (np.concatenate([h, batch[c].to_numpy()]) for h, c in zip(held, ("token", "id")))
            hot = np.concatenate([np.zeros(len(held[0]), bool), batch["salt"].to_numpy() > 0])
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (item[1:] != item[:-1])
            if emitted is not None and len(token):
                fresh[0] &= (int(token[0]), int(item[0])) != emitted
            token, item, hot = token[fresh], item[fresh], hot[fresh]
            if not len(token):
                held = (token, item)
                continue
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.diff(np.append(start, len(token)))
            several = np.repeat(size > 1, size) | hot
            if emitted is not None:
                several |= token == emitted[0]
            last = not several[-1]
            held = (token[-1:], item[-1:]) if last else (token[:0], item[:0])
            if several.any():
                token, item = token[several], item[several]
                emitted = (int(token[-1]), int(item[-1]))
                yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(item)], ["token", "id"])

    return dealt.select("token", "id", "salt").mapInArrow(keep, "token long, id long")


def folded(sketch: bytes, width: int) -> np.ndarray:
    """A sketch's bits as those of a sketch of ``width`` bytes."""
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint64).reshape(-1, width // 8), axis=0)


class Unit:
    """The members of a list, or of two blocks of one, that a task compares."""

    def __init__(self, data: dict, sketches_: list[bytes]):
        self.id, self.size, self.group, self.side = (data[c] for c in ("id", "size", "grp", "side"))
        self.across = data["low"][0] != data["high"][0]
        self.width = np.array([len(s) for s in sketches_])
        self.tables = {}
        for width in np.unique(self.width):
            if (self.width == width).all():
                self.tables[width] = np.frombuffer(b"".join(sketches_), np.uint64).reshape(len(sketches_), -1)
                continue
            table = np.zeros((len(sketches_), width // 8), np.uint64)
            for row in np.flatnonzero(self.width >= width):
                table[row] = folded(sketches_[row], width)
            self.tables[width] = table

    def near(self, u: int, others: np.ndarray, near: Near) -> np.ndarray:
        """Which of ``others`` may be similar to ``u``."""
        differing = np.zeros(len(others), np.int64)
        widths = np.minimum(self.width[others], self.width[u])
        for width in np.unique(widths):
            at, table = widths == width, self.tables[width]
            differing[at] = np.bitwise_count(table[u] ^ table[others[at]]).sum(axis=1, dtype=np.int64)
        hit = near(self.size[u], self.size[others], differing)
        return hit & (self.side[others] != self.side[u]) if self.across else hit

    def forest(self, near: Near) -> list[tuple[int, int]]:
        """A spanning forest of the pairs that may be similar, found breadth first."""
        waiting = np.arange(len(self.id))
        edges: list[tuple[int, int]] = []
        while len(waiting) > 1:
            queue, waiting = [waiting[0]], waiting[1:]
            while queue and len(waiting):
                u = queue.pop()
                hit = self.near(u, waiting, near)
                found = waiting[hit]
                edges.extend((int(self.id[u]), int(self.id[v])) for v in found)
                queue.extend(found)
                waiting = waiting[~hit]
        return edges

    def between_groups(self, near: Near) -> list[tuple[int, int]]:
        """All pairs of different groups that may be similar."""
        edges: list[tuple[int, int]] = []
        for u in range(len(self.id) - 1):
            rest = u + 1 + np.flatnonzero(self.group[u + 1 :] != self.group[u])
            if len(rest):
                hit = self.near(u, rest, near)
                edges.extend((int(self.id[u]), int(self.id[v])) for v in rest[hit])
        return edges


def candidates(lists: DataFrame, items: DataFrame, near: Near, groups: DataFrame | None = None) -> DataFrame:
    """Distinct ``a, b`` (a < b) to be compared, of ``lists`` (token, id), ``items`` (id, size, sketch).

    Without ``groups`` a spanning forest for each list; with ``groups`` (id, component), all
    pairs of different components.
    """
    shared.bound_batches(lists.sparkSession)
    if groups is not None:
        members = lists.join(groups, "id", "left").select(
            "token", "id", F.coalesce("component", "id").alias("grp")
        )
    else:
        members = lists.select("token", "id", F.col("id").alias("grp"))
    same = [F.bit_xor(F.xxhash64("id", F.lit(seed))).alias(f"sum{seed}") for seed in (0, 1)]
    ends = [F.min("grp").alias("low"), F.max("grp").alias("high")]
    counts = members.groupBy("token").agg(F.count("*").alias("n"), *same, *ends).filter("low < high")
    # Similar items share many tokens: of lists with the same members one is compared.
    counts = counts.groupBy("n", "sum0", "sum1").agg(F.min("token").alias("token")).select("token", "n")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = (
        members.join(counts, "token")
        .withColumn("blocks", blocks)
        .withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    )
    units = placed.join(items, "id").select(
        "token", "id", "grp", "size", "side", "sketch",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    low, high = F.least("side", "other"), F.greatest("side", "other")
    dealt = (
        units.withColumns({"low": low, "high": high})
        .repartition("token", "low", "high")
        .sortWithinPartitions("token", "low", "high", "id")
        .select("token", "low", "high", "id", "grp", "size", "side", "sketch")
    )
    forest = groups is None

    columns = ("token", "low", "high", "id", "grp", "size", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict | None = None
        known: set[tuple[int, int]] = set()

        def out(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            if len(known) > 200_000:
                known.clear()
            fresh = {(min(p), max(p)) for p in found} - known
            known.update(fresh)
            if fresh:
                a, b = np.array(list(fresh), np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        def units_of(data: dict, bits: list[bytes], starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
            found: list[tuple[int, int]] = []
            plain = np.array([len(b) for b in bits]) == SKETCH_BYTES
            two = starts[ends - starts == 2]  # most lists, all at once
            two = two[plain[two] & plain[two + 1]]
            if len(two):
                one, other = (
                    np.frombuffer(b"".join([bits[i] for i in at]), np.uint64).reshape(len(two), -1)
                    for at in (two, two + 1)
                )
                distance = np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)
                hit = near(data["size"][two], data["size"][two + 1], distance)
                hit &= data["grp"][two] != data["grp"][two + 1]
                across = data["low"][two] != data["high"][two]
                hit &= ~across | (data["side"][two] != data["side"][two + 1])
                found.extend(zip(data["id"][two[hit]].tolist(), data["id"][two[hit] + 1].tolist()))
            done = set(two.tolist())
            for s, e in zip(starts.tolist(), ends.tolist()):
                if e - s > 1 and s not in done:
                    unit = Unit({k: v[s:e] for k, v in data.items()}, bits[s:e])
                    found.extend(unit.forest(near) if forest else unit.between_groups(near))
            return found

        held_bits: list[bytes] = []
        for batch in batches:
            if not len(batch):
                continue
            data = {c: batch[c].to_numpy() for c in columns}
            bits = held_bits + batch["sketch"].to_pylist()
            if held is not None:
                data = {k: np.concatenate([held[k], v]) for k, v in data.items()}
            new = np.zeros(len(data["token"]), bool)
            new[0] = True
            for c in ("token", "low", "high"):
                new[1:] |= data[c][1:] != data[c][:-1]
            starts = np.flatnonzero(new)
            yield from out(units_of(data, bits, starts[:-1], starts[1:]))
            held = {k: v[starts[-1] :].copy() for k, v in data.items()}
            held_bits = bits[starts[-1] :]
        if held is not None:
            yield from out(units_of(held, held_bits, np.array([0]), np.array([len(held_bits)])))

    return dealt.mapInArrow(compare, "a long, b long").distinct()


def confirmed(pairs: DataFrame, payload: DataFrame, same: Callable[[bytes, bytes], bool]) -> DataFrame:
    """Those of the ``a, b`` whose payloads (id, data) are similar."""
    shared.bound_batches(pairs.sparkSession)
    left = payload.select(F.col("id").alias("a"), F.col("data").alias("left"))
    right = payload.select(F.col("id").alias("b"), F.col("data").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = [same(a.as_py(), b.as_py()) for a, b in zip(batch["left"], batch["right"])]
            yield batch.select(["a", "b"]).filter(pa.array(hit, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (its smallest id) of every id in ``a, b``, by alternating stars.

    Each round links every node's larger neighbours to its smallest one, then its smaller
    neighbours, until nothing changes: logarithmically many rounds, each a stored table.
    Minima are combined before they are shuffled.
    """
    now = shared.stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u != v")
        .distinct(),
        "edges",
    )
    state = None
    while True:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            now.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = (
            both.filter("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        after = shared.stored(small, "edges")
        found = after.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.max("u"), F.min("v")
        ).first()
        shared.discard(now)
        now = after
        if found == state or not found[0]:
            break
        state = found
    roots = now.select(F.col("v").alias("id")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )


def classes(
    lists: DataFrame,
    items: DataFrame,
    payload_of: Callable[[DataFrame], DataFrame],
    near: Near,
    same: Callable[[bytes, bytes], bool],
    certain: DataFrame | None = None,
) -> DataFrame:
    """``id, component`` of all ids that are similar to another, directly or by way of others.

    ``payload_of`` gives ``id, data`` for a table of ids; ``certain`` has pairs known to be
    similar. Every pair that shares a list and may be similar by its sketches is either
    compared exactly or already in one component by way of others.
    """
    first = shared.stored(candidates(lists, items, near), "pairs")
    linked = _compared(first, payload_of, same)
    known = linked if certain is None else linked.unionByName(certain)
    groups = shared.stored(components(known), "groups")
    rest = candidates(lists, items, near, groups).join(first, ["a", "b"], "left_anti")
    rest = shared.stored(rest, "pairs")
    if rest.isEmpty():
        return groups
    more = _compared(rest, payload_of, same)
    if more.isEmpty():
        return groups
    return components(known.unionByName(more))


def _compared(pairs: DataFrame, payload_of, same) -> DataFrame:
    payload = shared.stored(payload_of(_ids(pairs)), "payload")
    linked = shared.stored(confirmed(pairs, payload, same), "links")
    shared.discard(payload)
    return linked


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()


# A filter of ids, of bounded size, so that a pass over texts hands on little that is not wanted.


def _probes(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    h = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h >> np.uint64(7)) + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(4)]


def id_filter(spark: SparkSession, ids: DataFrame) -> Broadcast:
    """A Bloom filter of the column ``id``, of at most ``FILTER_BITS`` bits however many ids."""
    count = ids.count()
    bits = min(FILTER_BITS, 1 << max(12, (16 * count).bit_length()))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(bits // 64, np.uint64)
        for batch in batches:
            for at in _probes(batch["id"].to_numpy(), bits):
                np.bitwise_or.at(held, (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used].view(np.int64))], ["word", "mask"])

    found = (
        ids.select("id").mapInArrow(words, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    ).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(table)


def may_hold(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    out = np.ones(len(ids), bool)
    for at in _probes(ids, len(table) * 64):
        out &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
    return out
