"""Document fingerprints: one-permutation MinHash with optimal densification, packed bits.

Every shingle is hashed once: the high bits name a bin, the least hash of a bin is its value.
An empty bin takes the value of the first filled bin on a fixed random tour of the bins, its
own for each bin, so equal sets fill alike. Of each value the low ``BITS`` bits are stored.
Two unrelated values agree on them by chance with probability ``2**-BITS``, which
:func:`likeness` takes off.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import shared, words

WORDS = 5
BINS = 512
BITS = 4
_LOG = BINS.bit_length() - 1
_EMPTY = np.uint64(2**64 - 1)
_tours = np.argsort(np.random.Generator(np.random.PCG64(7)).random((BINS, BINS)), axis=1)
_turn = np.empty_like(_tours)  # when the tour of a bin comes to another
_salts = np.random.Generator(np.random.PCG64(9)).integers(1, 2**63, BINS, np.uint64)
np.put_along_axis(_turn, _tours, np.arange(BINS)[None, :].repeat(BINS, 0), axis=1)


def bins_of(texts: pa.Array) -> np.ndarray:
    """Stored values, a row of ``BINS`` for each text; a text without words has 255s."""
    found = words.split(texts)
    hashes, owner = words.shingle_sets(found, WORDS)
    table = np.full(len(texts) * BINS, _EMPTY, np.uint64)
    place = owner * BINS + (hashes >> np.uint64(64 - _LOG)).astype(np.int64)
    np.minimum.at(table, place, hashes & np.uint64(2 ** (64 - _LOG) - 1))
    table = table.reshape(len(texts), BINS)
    filled = table != _EMPTY
    taken = np.arange(BINS)[None, :].repeat(len(texts), 0)  # the bin whose value a bin has
    some = filled.any(axis=1)
    rows, cols = np.nonzero(~filled & some[:, None])
    for turn in range(24):
        if not len(rows):
            break
        source = _tours[cols, turn]
        hit = filled[rows, source]
        taken[rows[hit], cols[hit]] = source[hit]
        rows, cols = rows[~hit], cols[~hit]
    for row in np.unique(rows):  # texts of few shingles: the nearest of their filled bins
        held, empty = np.flatnonzero(filled[row]), cols[rows == row]
        taken[row, empty] = held[np.argmin(_turn[np.ix_(empty, held)], axis=1)]
    # Bits of a value differ from bin to bin, or two values with some bits in common by chance
    # would agree in every bin that takes them.
    values = np.take_along_axis(table, taken, axis=1) + _salts
    out = (words.mix(values) & np.uint64(2**BITS - 1)).astype(np.uint8)
    out[~some] = 255
    return out


def pack(bins: np.ndarray) -> list[str]:
    """Two bins a byte, as base64; empty for a text without words."""
    both = bins[:, 0::2] << 4 | bins[:, 1::2] & 15
    return ["" if e else base64.b64encode(b).decode() for e, b in zip(bins[:, 0] == 255, both)]


def unpack(fingerprint: str) -> np.ndarray:
    if not fingerprint:
        return np.full(BINS, 255, np.uint8)
    both = np.frombuffer(base64.b64decode(fingerprint), np.uint8)
    return np.stack([both >> 4, both & 15], axis=1).ravel()


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of rows, chance agreement of the stored bits removed."""
    chance = 2.0**-BITS
    none_a, none_b = a[:, 0] == 255, b[:, 0] == 255
    agreed = (a == b).mean(axis=1)
    value = np.clip((agreed - chance) / (1 - chance), 0, 1)
    return np.where(none_a | none_b, (none_a & none_b).astype(float), value)


def fingerprint(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint`` of every row; NULL and texts without words have an empty one."""
    shared.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part["key"], pa.array(pack(bins_of(part["text"])), pa.string())],
                    ["key", "fingerprint"],
                )

    return rows.mapInArrow(make, f"key {kind}, fingerprint string").withColumnRenamed("key", key)


def with_followers(docs: DataFrame, order: str, text: str) -> DataFrame:
    """``bucket, helper, place, text``: ranges of rows in which each row's follower is near.

    Rows are ordered by ``order`` descending, NULL last, then by text; after the last comes
    the first. Ranges have about equal row counts. The first row of a range also goes to the
    range before it, as a helper, so that within a bucket every row that is no helper is
    followed by its follower. The driver sees two numbers for each range, no rows.
    """
    spark = docs.sparkSession
    place = F.coalesce(F.col(order).cast("long"), F.lit(-(2**63)))
    rows = docs.select(
        F.col(order).alias("key"), place.alias("place"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    thin = rows.select(F.col("place").cast("double").alias("place"))
    cuts = thin.approxQuantile("place", [i / wanted for i in range(1, wanted)], 0.25 / wanted)
    cuts = sorted({int(c) for c in cuts})
    bucket = _bucket(F.col("place"), cuts)
    tops = {
        r.bucket: r.top
        for r in rows.select(bucket.alias("bucket"), "place")
        .groupBy("bucket")
        .agg(F.max("place").alias("top"))
        .collect()
    }
    if not tops:
        return rows.select(F.lit(0).alias("bucket"), F.lit(False).alias("helper"), *rows.columns)
    present = sorted(tops)
    above = dict(zip(present, present[1:] + present[:1], strict=True))
    top = F.array([F.lit(tops.get(b, 0)).cast("long") for b in range(len(cuts) + 1)])
    to = F.array([F.lit(above.get(b, -1)) for b in range(len(cuts) + 1)])
    placed = rows.withColumn("own", bucket)
    copy = F.col("place") == F.element_at(top, F.col("own") + 1)
    where = F.when(
        copy,
        F.array(
            F.struct(F.col("own").alias("bucket"), F.lit(False).alias("helper")),
            F.struct(F.element_at(to, F.col("own") + 1).alias("bucket"), F.lit(True).alias("helper")),
        ),
    ).otherwise(F.array(F.struct(F.col("own").alias("bucket"), F.lit(False).alias("helper"))))
    spread = placed.select("key", "place", "text", F.inline(where))
    return (
        spread.repartition(wanted // 4, "bucket")
        .sortWithinPartitions("bucket", "helper", F.col("place").desc(), "text")
        .select("bucket", "helper", "key", "place", "text")
    )


def _bucket(value, cuts: list[int]):
    """How many of the sorted ``cuts`` are <= ``value``, by halving."""
    if not cuts:
        return F.lit(0)
    array = F.array([F.lit(c).cast("long") for c in cuts])

    def halve(state, _):
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        above = F.element_at(array, F.least(middle + 1, F.lit(len(cuts)))) <= value
        open_ = state["low"] < state["high"]
        return F.struct(
            F.when(open_ & above, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(open_ & ~above, middle).otherwise(state["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    start = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))
    return F.aggregate(steps, start, halve)["low"]


def edited(text: str, follower: str) -> str:
    """The last third of the code points replaced by the follower's first as many, or all."""
    count = len(text) // 3
    return text[: len(text) - count] + follower[:count]


def fingerprint_edits(docs: DataFrame, *, order: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    Returns ``order, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The follower of a row is the next by descending ``order``; of rows of equal
    ``order`` the next by text; NULL ``order`` comes last; after the last comes the first, so
    a lone row follows itself. NULL texts are empty. An empty or wordless text has an empty
    fingerprint; two of these are alike (1), one of these and another are not (0). Other
    columns are not read.

    Texts are shuffled once, into ranges of the order; only range bounds reach the driver.
    """
    shared.bound_batches(docs.sparkSession)
    rows = with_followers(docs, order, text)
    kind = docs.schema[order].dataType.simpleString()
    names = (
        "key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )

    def rows_of(keys: pa.Array, texts: list[str], own: np.ndarray, followers: list[str], theirs: np.ndarray):
        changed = [edited(t, f) for t, f in zip(texts, followers, strict=True)]
        other = bins_of(pa.array(changed, pa.large_string()))
        columns = [
            keys,
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            pa.array(pack(own), pa.string()),
            pa.array(pack(other), pa.string()),
            pa.array(likeness(own, other), pa.float64()),
            pa.array(likeness(own, theirs), pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, list(names))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far: bucket, helper, key, text, bins
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                bucket = part["bucket"].to_pylist()
                helper = part["helper"].to_pylist()
                texts = part["text"].to_pylist()
                bins = bins_of(part["text"])
                keys = part["key"]
                if held is not None:
                    bucket.insert(0, held[0])
                    helper.insert(0, held[1])
                    texts.insert(0, held[3])
                    bins = np.concatenate([held[4], bins])
                    keys = pa.concat_arrays([held[2], keys])
                at = [i for i in range(len(texts) - 1) if not helper[i] and bucket[i] == bucket[i + 1]]
                if at:
                    after = [i + 1 for i in at]
                    yield rows_of(
                        keys.take(pa.array(at)), [texts[i] for i in at], bins[at], [texts[i] for i in after], bins[after]
                    )
                held = (bucket[-1], helper[-1], keys.slice(len(keys) - 1), texts[-1], bins[-1:].copy())

    schema = (
        f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return rows.mapInArrow(make, schema).withColumnRenamed("key", order)
