"""N-gram Jaccard join by size: subsets of small sets, inverted lists of large ones.

A document's set is its distinct five-word shingles. Sets that must share ``c`` shingles to be
similar share a subset of ``c``. For two small sets all such subsets are enumerated: an equal
one makes the pair similar, which is looked up in the sets themselves, as subsets go by hashes.
Larger sets have too many. Of them, the
``n - ceil(t * n) + 1`` shingles that come first in one order of all shingles are put into
inverted lists; similar sets share one of these. The order has the shingles known to be frequent
last, so that common passages seldom make lists. The boundary between small and large is the
size up to which a set's subsets cost less than scanning its lists.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import links, shared, words

SIZE = 5
PERCENT = 75
FREQUENT = 32_768  # shingles put last in the order, at most
LEAST_FREQUENT = 48
SEEN = 3  # times in a batch, from which on a shingle is reported as frequent
LARGEST_SMALL = 12
EQUAL, UNEQUAL = 0, 1  # whether a subset's two sizes are one


def overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Common elements that sets of these sizes need for the similarity."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(n: int, percent: int = PERCENT) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


@lru_cache(maxsize=64)
def subset_count(n: int, percent: int = PERCENT) -> int:
    return sum(comb(n, overlap(n, m, percent)) for m in partner_sizes(n, percent))


def boundary(list_length: float, percent: int = PERCENT) -> int:
    """The size up to which enumerating subsets costs no more rows than scanning lists."""
    size = 0
    while size < LARGEST_SMALL and subset_count(size + 1, percent) <= prefix_length(size + 1, percent) * max(1.0, list_length):
        size += 1
    return size


def _sets(texts: pa.Array) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted by hash."""
    hashes, owner = words.shingle_sets(words.split(texts, words.WHITE, lower=True), SIZE)
    if len(owner) and (owner[1:] < owner[:-1]).any():  # short texts come last
        order = np.argsort(owner, kind="stable")
        hashes, owner = hashes[order], owner[order]
    first = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    out = []
    for low, high in zip(first, first[1:]):
        own = np.sort(hashes[low:high])
        if high - low > 1 and not (fresh := own[1:] != own[:-1]).all():
            own = own[np.concatenate([[True], fresh])]
        out.append(own)
    return out


def _name(own: np.ndarray) -> int:
    """A 64-bit name of a set: equal sets have equal names."""
    total = words.mix(own ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(own))
    return int(words.mix(np.array([total]))[0].view(np.int64))


def _sketch(own: np.ndarray) -> bytes:
    """Parity bits of a set, at least two for each element."""
    bits = max(links.SKETCH_BITS, 1 << (2 * len(own) - 1).bit_length()) if len(own) else links.SKETCH_BITS
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    shared.bound_batches(docs.sparkSession)
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text"))


def sets_of(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, version, size, id, sketch`` of each row: its set's size, name and parity bits.

    Sets of ``LARGEST_SMALL`` shingles or fewer come along whole, as ``small``. One row of each
    batch also has the shingles ``often`` that the batch holds ``SEEN`` times or more, and their
    ``times``.
    """
    rows = _texts(docs, key, text).withColumn("version", F.coalesce(F.xxhash64("text"), F.lit(0)))
    kind = rows.schema["key"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                sets = _sets(part["text"])
                found, times = np.unique(np.concatenate(sets), return_counts=True)
                often = times >= SEEN
                none = [None] * (len(sets) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        part["version"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_name(s) for s in sets], pa.int64()),
                        pa.array([_sketch(s) for s in sets], pa.binary()),
                        pa.array([s.view(np.int64) if 0 < len(s) <= LARGEST_SMALL else None for s in sets], pa.list_(pa.int64())),
                        pa.array([found[often].view(np.int64), *none], pa.list_(pa.int64())),
                        pa.array([times[often].astype(np.int64), *none], pa.list_(pa.int64())),
                    ],
                    ["key", "version", "size", "id", "sketch", "small", "often", "times"],
                )

    return rows.mapInArrow(
        make,
        f"key {kind}, version long, size long, id long, sketch binary, small array<long>, "
        "often array<long>, times array<long>",
    )


def frequent_shingles(sets: DataFrame) -> tuple[np.ndarray, float]:
    """The most frequent shingles, sorted by hash, and the mean list length they make.

    Sums what the batches of all texts report. They order the shingles, which bears on cost, not
    on results. ``FREQUENT`` bounds what the driver gets.
    """
    seen = sets.filter("often IS NOT NULL").select(F.explode(F.arrays_zip("often", "times")).alias("x"))
    totals = seen.groupBy(F.col("x.often").alias("token")).agg(F.sum("x.times").alias("n"))
    top = totals.filter(F.col("n") >= LEAST_FREQUENT).orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    counts = top["n"].to_numpy().astype(float)
    length = 1.0 + float((counts**2).sum() / max(1.0, counts.sum())) if len(counts) else 1.0
    return np.sort(top["token"].to_numpy().view(np.uint64)), length


def _rank(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Whether each shingle is frequent."""
    if not len(frequent):
        return np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return frequent[at] == hashes


def _subsets(elements: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Names of the subsets that a similar set of some size must share, both sizes in them.

    With each goes ``EQUAL`` or ``UNEQUAL``: whether the other size is this set's own.
    """
    n = len(elements)
    for m in partner_sizes(n, percent):
        low, high = min(n, m), max(n, m)
        size = overlap(n, m, percent)
        for part in combinations(elements.tolist(), size):
            yield hash((low, high, *part)), EQUAL if low == high else UNEQUAL


def postings(docs: DataFrame, frequent: np.ndarray, small: int, *, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``token, id, salt`` of every set that may be similar to one of more than ``small``."""
    rows = _texts(docs, text, text).select("text")
    sent = docs.sparkSession.sparkContext.broadcast(frequent)
    least_listed = partner_sizes(small + 1, percent)[0]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                seen: set[int] = set()  # equal sets of a batch go out once
                tokens, names, salts = [], [], []
                sets = _sets(part["text"])
                often = _rank(np.concatenate(sets), sent.value)
                at = 0
                for own in sets:
                    at, begin = at + len(own), at
                    name = _name(own)
                    if len(own) < least_listed or name in seen:
                        continue
                    seen.add(name)
                    common = often[begin:at]
                    length = prefix_length(len(own), percent)
                    rare = own[~common][:length]
                    tokens += [rare, own[common][: length - len(rare)]]
                    names.append(np.full(length, name, np.int64))
                    salts.append(np.zeros(length, np.int32))
                    salts[-1][len(rare) :] = 1 + (name & (2**63 - 1)) % links.SALTS
                if names:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(tokens).view(np.int64)),
                            pa.array(np.concatenate(names)),
                            pa.array(np.concatenate(salts)),
                        ],
                        ["token", "id", "salt"],
                    )

    return rows.mapInArrow(make, "token long, id long, salt int")


def subsets(sets: DataFrame, small: int, percent: int = PERCENT) -> DataFrame:
    """``token, salt, id, size``: the subsets of each set of ``small`` shingles or fewer."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                named = list(_subsets(np.array(row["small"]), percent))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n for n, _ in named], pa.int64()),
                        pa.array([k for _, k in named], pa.int32()),
                        pa.array([row["id"]] * len(named), pa.int64()),
                        pa.array([row["size"]] * len(named), pa.int64()),
                    ],
                    ["token", "salt", "id", "size"],
                )

    rows = _small(sets, small).dropDuplicates(["id"])
    return rows.mapInArrow(make, "token long, salt int, id long, size long")


def _small(sets: DataFrame, most: int) -> DataFrame:
    return sets.filter((F.col("size") > 0) & (F.col("size") <= most)).select("id", "size", "small")


def _subset_links(subsets: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs ``a, b`` that connect the sets of equal subsets.

    Sets of one size that share such a subset are similar. Of two sizes, every set of the one is
    similar to every set of the other: each is linked to the first of the other size, which
    connects all. Each token gives stars, not all pairs. Of every pair the sets are compared.
    """
    stars = (
        subsets.groupBy("token", "salt")
        .agg(
            F.min(F.struct("size", "id")).alias("low"),
            F.min(F.struct((-F.col("size")).alias("less"), "id")).alias("high"),
            F.min("id").alias("first"),
            F.max("id").alias("last"),
        )
        .filter((F.col("first") < F.col("last")) & ((F.col("salt") == EQUAL) | (F.col("low.size") < -F.col("high.less"))))
        .select("token", "salt", F.col("low.id").alias("low"), F.col("low.size").alias("least"), F.col("high.id").alias("high"))
    )
    hub = F.when((F.col("size") == F.col("least")) & (F.col("salt") != EQUAL), F.col("high")).otherwise(F.col("low"))
    pairs = (
        subsets.join(stars, ["token", "salt"])
        .withColumn("hub", hub)
        .filter("id != hub")
        .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
        .distinct()
    )
    held = sets.select("id", "small").dropDuplicates(["id"])
    left, right = (held.select(F.col("id").alias(c), F.col("small").alias(f"set_{c}")) for c in ("a", "b"))
    common = F.size(F.array_intersect("set_a", "set_b"))
    similar = 100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)
    return pairs.join(left, "a").join(right, "b").filter(similar).select("a", "b")


def _near(percent: int) -> links.Near:
    def near(a, b, differing):
        # Similar sets differ in at most (100 - p) / (100 + p) of their elements together.
        return ((100 + percent) * differing <= (100 - percent) * (a + b)) & (
            100 * np.minimum(a, b) >= percent * np.maximum(a, b)
        )

    return near


def _same(percent: int):
    def same(a: bytes, b: bytes) -> bool:
        left, right = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        both = np.concatenate([left, right])
        both.sort()
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= percent * (len(both) - common)

    return same


def similar_sets(docs: DataFrame, sets: DataFrame, *, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``id, component`` of the named sets that are linked with another."""
    spark = docs.sparkSession
    frequent, length = frequent_shingles(sets)
    small = boundary(length, percent)
    rows = postings(docs, frequent, small, text=text, percent=percent)
    lists = shared.stored(links.shared_lists(rows), "lists")
    certain = None
    if small:
        certain = shared.stored(_subset_links(subsets(sets, small, percent), _small(sets, small), percent), "links")
    own = sets.filter("size > 0")
    items = own.select("id", "size", "sketch").dropDuplicates(["id"])

    def payload_of(ids: DataFrame) -> DataFrame:
        # One text of each set; the filter of text hashes spares the others their shingles.
        wanted = own.join(ids, "id", "left_semi").groupBy("id").agg(F.min("version").alias("version"))
        versions = shared.stored(wanted.select(F.col("version").alias("id")).distinct(), "versions")
        held = links.id_filter(spark, versions)
        rows = _texts(docs, text, text).select(F.coalesce(F.xxhash64("text"), F.lit(0)).alias("version"), "text")

        def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hold = links.may_hold(held.value, batch["version"].to_numpy())
                for part in shared.by_bytes(batch.filter(pa.array(hold)), "text"):
                    unique = np.unique(part["version"].to_numpy(), return_index=True)[1]
                    sets = [s for s in _sets(part["text"].take(pa.array(unique))) if len(s)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([_name(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                        ["id", "data"],
                    )

        return rows.mapInArrow(make, "id long, data binary").join(ids, "id", "left_semi").dropDuplicates(["id"])

    return links.classes(lists, items, payload_of, _near(percent), _same(percent), certain)


def join(docs: DataFrame, *, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``key, n_shingles, component_id, version, group_id`` of every row.

    Rows link when ``percent`` or more of their sets' union is common; ``component_id`` is the
    smallest ``key`` reachable by links. NULL and wordless texts have an empty set, no links and
    their own key. Rows of equal texts link. ``version`` is a hash of the row's text, ``group_id``
    numbers the components (also where repeated keys give two of them one name). A NULL key is never a component's name unless the
    component has no other. An empty table gives an empty one. Other columns are not read.

    Equal sets are one node from the start; every link between different sets is found or
    follows from others, so components are exact.
    """
    sets = shared.stored(sets_of(docs, key=key, text=text), "sets")
    linked = similar_sets(docs, sets, text=text, percent=percent)
    rows = sets.select("key", "version", "size", "id").join(linked, "id", "left")
    grouped = rows.withColumn("grp", F.coalesce("component", "id"))
    smallest = grouped.filter("size > 0").groupBy("grp").agg(F.min("key").alias("component_id"))
    return (
        grouped.join(smallest, "grp", "left")
        .select(
            F.col("key").alias(key),
            F.col("size").alias("n_shingles"),
            F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("key")).alias("component_id"),
            "version",
            F.col("grp").alias("group_id"),
        )
    )
