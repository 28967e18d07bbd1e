"""Importance resampling towards a target, with weights from bit slices.

Features (runs of words) fall into buckets by hash. A bucket's gain is the logarithm of its share
in the target texts against its share in all documents, in thousandths and rounded down. A
document's weight is the mean gain of its features.

The sum of gains is worked out in bit slices. A document's bucket counts become planes of one bit
for each bucket: plane k holds bit k of every count. The gains, of either sign, become planes of
their bits in the same way. Of a plane of counts and a plane of gains the common bits are counted:
times two to the power of both planes' numbers, added up over all pairs and signs, that is the
exact sum, in integers. Planes are held in words of 64 buckets, of which only those with a bit
are kept.

The draw takes the highest scores, a weight with Gumbel noise that the key decides, which samples
without replacement in proportion to the weights' exponentials.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm import shared
from salesmart.llm.numbering import numbered

BUCKETS = 10_000
ORDERS = (1, 1)
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
SCALE = 1000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_CELL = 64
_TOGETHER = 1 << 20  # features whose planes are worked on at once, or one text's


def features(text: bytes, orders: tuple[int, int]) -> tuple[int, list[bytes]]:
    """The number of words, and all runs of as many words as ``orders`` says, from and to."""
    listed = _WORD.findall(text.lower())
    low, high = orders
    if (low, high) == (1, 1):
        return len(listed), listed
    return len(listed), [
        b" ".join(listed[i : i + n]) for n in range(low, high + 1) for i in range(len(listed) - n + 1)
    ]


def bucketed(
    docs: DataFrame, *, key: str, text: str, buckets: int = BUCKETS, orders: tuple[int, int] = ORDERS, carry: Sequence[str] = ()
) -> DataFrame:
    """``key, n_words, n_features, buckets`` of every row; ``buckets`` has 16 bits for each feature."""
    if not 0 < buckets <= 1 << 16 or not 0 < orders[0] <= orders[1]:
        raise ValueError("up to 65536 buckets, and runs of one word or more")
    shared.bound_batches(docs.sparkSession)
    names = ["key", *(f"c{i}" for i in range(len(carry)))]
    rows = docs.select(*[F.col(c).alias(n) for c, n in zip((key, *carry), names)], F.col(text).alias("text"))
    fields = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text", 1 << 20):
                found = [features((t or "").encode("utf-8", "surrogatepass"), orders) for t in part["text"].to_pylist()]
                counts = [len(listed) for _, listed in found]
                encoded = pa.array([f for _, listed in found for f in listed], pa.binary()).dictionary_encode()
                known = np.array([crc32(f.as_py()) % buckets for f in encoded.dictionary], np.uint16)
                codes = known[encoded.indices.to_numpy()] if len(known) else known
                edges = np.concatenate([[0], np.cumsum(counts)])
                data = [codes[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[n] for n in names),
                        pa.array([n for n, _ in found], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array(data, pa.binary()),
                    ],
                    [*names, "n_words", "n_features", "buckets"],
                )

    return rows.mapInArrow(hashed, f"{fields}, n_words long, n_features long, buckets binary")


def totals(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows by bucket; the driver gets a number for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            for codes in batch["buckets"]:
                held += np.bincount(np.frombuffer(codes.as_buffer(), np.uint16), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], ["bucket", "n"])

    sums = rows.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in sums.collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths, rounded down; one is added to every count."""
    size = len(corpus)
    all_corpus, all_target = float(corpus.sum() + size), float(target.sum() + size)
    return np.array(
        [
            math.floor(SCALE * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


class GainPlanes:
    """The bits of all gains: for each sign and power of two a plane of cells of 64 buckets."""

    def __init__(self, gain: np.ndarray):
        cells = -(-len(gain) // _CELL)
        self.planes: list[tuple[int, np.ndarray]] = []  # signed power of two, bits
        for sign, size in ((1, np.maximum(gain, 0)), (-1, np.maximum(-gain, 0))):
            for power in range(int(size.max(initial=0)).bit_length()):
                bits = np.zeros(cells * _CELL, np.uint8)
                bits[: len(gain)] = (size >> power) & 1
                self.planes.append((sign << power if sign > 0 else -(1 << power), _cells(bits)))

    def sums(self, codes: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """The exact sum of the gains of each text's features."""
        total = np.zeros(texts, np.int64)
        if not len(codes) or not self.planes:  # no feature, or all gains are 0
            return total
        width = len(self.planes[0][1]) * _CELL
        pairs, times = np.unique(owner.astype(np.int64) * width + codes, return_counts=True)
        bit = np.uint64(1) << (pairs % _CELL).astype(np.uint64)
        cell = pairs // _CELL  # over all texts; pairs are in order, so equal cells are together
        for power in range(int(times.max()).bit_length()):
            in_plane = np.flatnonzero((times >> power) & 1)
            head = np.flatnonzero(np.append(True, np.diff(cell[in_plane]) > 0)) if len(in_plane) else in_plane
            if not len(head):
                continue
            counts = np.bitwise_or.reduceat(bit[in_plane], head)
            place = cell[in_plane[head]]
            text, at = place // (width // _CELL), place % (width // _CELL)
            first = np.flatnonzero(np.append(True, np.diff(text) > 0))
            for signed, plane in self.planes:
                common = np.bitwise_count(counts & plane[at]).astype(np.int64)
                total[text[first]] += np.add.reduceat(common, first) * (signed << power)
        return total


def _cells(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, bitorder="little").view(np.uint64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``rows`` with ``weight`` in place of ``buckets``: the mean gain, rounded down; 0 without features."""
    sent = rows.sparkSession.sparkContext.broadcast(gain)  # a number for each bucket
    names = [c for c in rows.columns if c != "buckets"]
    fields = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = GainPlanes(sent.value)
        for batch in batches:
            for part in shared.by_bytes(batch, "buckets", 2 * _TOGETHER):
                counts = part["n_features"].to_numpy()
                codes = np.frombuffer(b"".join(part["buckets"].to_pylist()), np.uint16)
                total = planes.sums(codes, np.repeat(np.arange(len(counts)), counts), len(counts))
                weight = np.where(counts > 0, total // np.maximum(counts, 1), 0)
                yield pa.RecordBatch.from_arrays([*(part[n] for n in names), pa.array(weight)], [*names, "weight"])

    return rows.mapInArrow(weigh, f"{fields}, weight long")


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, rounded down, from the SHA-256 of ``seed:key``."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    drawn = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.log(-F.log((drawn + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    orders: tuple[int, int] = ORDERS,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``key, n_features, weight, score, rank`` of every row, and the columns ``carry``.

    Words are runs of ASCII letters, lower-cased, digits and characters beyond ASCII. Of the N
    rows with ``min_words`` words or more the ``percent * N div 100`` with the highest scores are
    drawn and ranked from 1, ties by smaller key; ``rank`` is NULL for all others. All rows of
    both tables count for the gains.

    NULL and wordless texts have no features and weight 0; so has every row if neither table has
    features. A NULL key gets the noise of an empty one and comes last in ties. Repeated rows and keys each count and give a
    row; rows equal in score and key are ranked in any order. An empty table gives an empty one,
    an empty target equal shares of all buckets. A long text is one task's work, two bytes
    stored and about 40 bytes of memory a feature.
    """
    found = shared.stored(
        bucketed(docs, key=key, text=text, buckets=buckets, orders=orders, carry=carry), "buckets"
    )
    wanted = bucketed(target.select(target_text), key=target_text, text=target_text, buckets=buckets, orders=orders)
    gain = gains(totals(found, buckets), totals(wanted, buckets))
    scored = weighed(found, gain).withColumn("score", F.col("weight") + noise(F.col("key"), seed))
    eligible = F.col("n_words") >= min_words
    order = [eligible.desc(), F.col("score").desc(), F.col("key").asc_nulls_last()]
    placed = numbered(scored, order, "place")
    shared_out = placed.filter(eligible).count() * percent // 100
    drawn = F.when(F.col("place") < shared_out, F.col("place") + 1)
    return placed.select(
        F.col("key").alias(key),
        "n_features",
        "weight",
        "score",
        drawn.cast("long").alias("rank"),
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
    )
