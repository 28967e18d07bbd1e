"""Best-fit packing in bulk-synchronous rounds.

Pieces and open sequences are range-sorted, pieces by length, sequences by gap, so that each row
knows its rank among its equals. A round sweeps the sizes downwards: every piece looks for its
successor, the smallest gap that holds it, and gaps and pieces of equal size are matched by rank.
A gap takes as many pieces of one length as it holds, then rests until the next round, when gaps
are sorted anew. Pieces whose only places are such gaps wait; where no gap is left, sequences are
opened, and as many as the pieces' total length calls for are opened without waiting. A round needs only how many pieces and gaps there are of each size, at most as many
numbers as a sequence has tokens; rows are matched by joins.

Matched in full each round, the rounds are fewer than the distinct lengths one sequence can hold.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import shared, tokens

CAPACITY = 2048
END = 0  # the id that follows every document


def pieces(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` of every row's ids with ``END`` after them.

    Longer documents are cut into pieces of ``capacity``, of which the first may be shorter.
    NULL texts are empty: one piece of ``END`` alone. Repeated rows each give their pieces.
    """
    shared.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    end = np.array([END], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.id_encoder(tokenizer)
        for batch in batches:
            for part in shared.by_bytes(batch, "text"):
                encoded = encoder.totals([t or "" for t in part["text"].to_pylist()], b"".join)
                owner, piece, start, length, crc = [], [], [], [], []
                for row, body in enumerate(encoded):
                    ids = memoryview(body + end)
                    total = len(ids) // 4
                    first = total % capacity or min(total, capacity)
                    begin, stop, number = 0, first, 0
                    while begin < total:
                        owner.append(row)
                        piece.append(number)
                        start.append(begin)
                        length.append(stop - begin)
                        crc.append(zlib.crc32(ids[4 * begin : 4 * stop]))
                        begin, stop, number = stop, stop + capacity, number + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"].take(pa.array(owner, pa.int64())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["key", "piece", "start", "length", "ids_crc32"],
                )

    return rows.mapInArrow(
        cut, f"key {kind}, piece int, start long, length long, ids_crc32 long"
    )


def _small(spark: SparkSession, rows: list[tuple[int, ...]], *columns: str) -> DataFrame:
    """A table of numbers whose size the planner knows, so that it can broadcast it if small."""
    values = zip(*rows) if rows else [()] * len(columns)
    return spark.createDataFrame(pa.table({c: pa.array(v, pa.int64()) for c, v in zip(columns, values)}))


def _ranked(rows: DataFrame, size: str, *ties: str) -> tuple[DataFrame, dict[int, int]]:
    """``rows`` with ``rank`` among rows of equal ``size``, and how many there are of each.

    Rows are range-sorted and stored; a row's rank follows from its place and from how many
    rows of its size the files before it hold, for which the driver gets a number for each
    file and size: about as many as there are files and sizes.
    """
    spark = rows.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = shared.stored(
        rows.repartitionByRange(count, size, *ties)
        .sortWithinPartitions(size, *ties)
        .withColumn("place", F.monotonically_increasing_id()),
        "sorted",
    )
    part = F.shiftright("place", 33)
    held = (
        sorted_.groupBy(part.alias("part"), F.col(size).alias("of"))
        .agg(F.count("*").alias("n"), F.min("place").alias("first"))
        .collect()
    )
    totals: dict[int, int] = {}
    bases = []
    for row in sorted(held, key=lambda r: (r.part, r.of)):
        before = totals.get(row.of, 0)
        bases.append((row.part, row.of, before - row.first))
        totals[row.of] = before + row.n
    shift = _small(spark, bases, "part", "of", "shift")
    ranked = (
        sorted_.withColumn("part", part)
        .join(shift.withColumnRenamed("of", size), ["part", size])
        .withColumn("rank", F.col("place") + F.col("shift"))
        .drop("part", "place", "shift")
    )
    ranked._stored_at = sorted_._stored_at
    return ranked, totals


@dataclass
class Sweep:
    """One round's matches, by sizes and ranks.

    ``into``: gap, first and last rank of gaps, length, pieces a gap, first piece, end of pieces.
    ``opened``: length, pieces a sequence, first piece, end of pieces, first sequence.
    """

    into: list[tuple[int, ...]] = field(default_factory=list)
    opened: list[tuple[int, ...]] = field(default_factory=list)
    sequences: int = 0


def sweep(left: dict[int, int], placed: dict[int, int], gaps: dict[int, int], capacity: int, sequences: int) -> Sweep:
    """Match pieces (``left`` of each length, after the ``placed`` ones) with gaps of each size."""
    out = Sweep(sequences=sequences)
    free = sorted(g for g, n in gaps.items() if n)
    used = dict.fromkeys(free, 0)
    resting = 0  # the largest gap that this round has made
    volume = sum(s * n for s, n in left.items()) - sum(g * n for g, n in gaps.items())
    sure = -(-volume // capacity)  # so many more sequences are needed in any case
    for length in sorted((s for s, n in left.items() if n), reverse=True):
        wanted, first = left[length], placed.get(length, 0)
        at = bisect_left(free, length)
        while wanted and at < len(free):
            gap = free[at]
            each = gap // length
            count = min(gaps[gap] - used[gap], -(-wanted // each))
            taken = min(wanted, count * each)
            out.into.append((gap, used[gap], used[gap] + count, length, each, first, first + taken))
            resting = max(resting, gap - length * (taken - (count - 1) * each))
            used[gap] += count
            wanted, first = wanted - taken, first + taken
            if used[gap] == gaps[gap]:
                free.pop(at)
        if not wanted:
            continue
        each = capacity // length
        count = -(-wanted // each)
        if resting >= length:  # wait for those gaps, but for the sequences that are due anyway
            count = min(count, sure)
        if count > 0:
            taken = min(wanted, count * each)
            out.opened.append((length, each, first, first + taken, out.sequences))
            out.sequences += count
            sure -= count
            resting = max(resting, capacity - length * (taken - (count - 1) * each))
    return out


def _round(spark: SparkSession, found: Sweep, items: DataFrame, open_: DataFrame | None, capacity: int) -> DataFrame:
    """All sequences after the round, with what was put into them (``count`` 0: nothing)."""
    opened = _small(spark, found.opened, "length", "each", "first", "stop", "base")
    started = items.select("length", "rank").join(opened, "length").filter(
        (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("stop"))
        & ((F.col("rank") - F.col("first")) % F.col("each") == 0)
    )
    count = F.least("each", F.col("stop") - F.col("rank"))
    after = started.select(
        (F.col("base") + F.floor((F.col("rank") - F.col("first")) / F.col("each"))).cast("long").alias("sequence_id"),
        (capacity - F.col("length") * count).alias("gap"),
        "length",
        F.lit(0).cast("long").alias("offset"),
        F.col("rank").alias("first"),
        count.alias("count"),
    )
    if open_ is None:
        return after
    into = _small(spark, found.into, "gap", "low", "high", "length", "each", "first", "stop")
    rows, match = open_.alias("o"), into.alias("m")
    fits = (F.col("o.gap") == F.col("m.gap")) & (F.col("o.rank") >= F.col("m.low")) & (F.col("o.rank") < F.col("m.high"))
    both = rows.join(match, fits, "left")
    first = F.col("m.first") + (F.col("o.rank") - F.col("m.low")) * F.col("m.each")
    count = F.coalesce(F.least(F.col("m.each"), F.col("m.stop") - first), F.lit(0))
    filled = both.select(
        "o.sequence_id",
        (F.col("o.gap") - F.coalesce(F.col("m.length") * count, F.lit(0))).alias("gap"),
        "m.length",
        (capacity - F.col("o.gap")).alias("offset"),
        first.alias("first"),
        count.alias("count"),
    )
    return filled.unionByName(after)


def place(items: DataFrame, counts: dict[int, int], capacity: int = CAPACITY) -> DataFrame:
    """``length, rank, sequence_id, offset`` for each of ``items`` (length, rank)."""
    spark = items.sparkSession
    left, placed = dict(counts), dict.fromkeys(counts, 0)
    open_, gaps, sequences, rounds = None, {}, 0, []
    while any(left.values()):
        found = sweep(left, placed, gaps, capacity, sequences)
        sequences = found.sequences
        for *_, length, _, first, stop in found.into:
            left[length] -= stop - first
            placed[length] = stop
        for length, _, first, stop, _ in found.opened:
            left[length] -= stop - first
            placed[length] = stop
        least = min((s for s, n in left.items() if n), default=capacity + 1)
        now = _round(spark, found, items, open_, capacity)
        ranked, totals = _ranked(now, "gap", "sequence_id")
        rounds.append(ranked)
        open_ = ranked.select("sequence_id", "gap", "rank").filter(F.col("gap") >= least)
        gaps = {g: n for g, n in totals.items() if g >= least}
    if not rounds:
        return spark.createDataFrame([], "length long, rank long, sequence_id long, offset long")
    placements = None
    for ranked in rounds:
        one = ranked.filter("count > 0").select("sequence_id", "length", "offset", "first", "count")
        placements = one if placements is None else placements.unionByName(one)
    step = F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("i")
    out = shared.stored(
        placements.select("*", step).select(
            "length",
            (F.col("first") + F.col("i")).alias("rank"),
            "sequence_id",
            (F.col("offset") + F.col("i") * F.col("length")).alias("offset"),
        ),
        "placed",
    )
    for ranked in rounds:
        shared.discard(ranked)
    return out


def pack(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Pieces as :func:`pieces` cuts them; ``sequence_id`` numbers the sequences from 0, ``offset``
    is a piece's place in its sequence, gapless from 0. An empty table gives an empty one.
    Other columns are not read.
    """
    # Stored first: a range sort reads its input twice, and this one is all the encoding.
    cut = shared.stored(pieces(docs, tokenizer, key=key, text=text, capacity=capacity), "pieces")
    items, counts = _ranked(cut, "length", "key", "piece", "ids_crc32")
    shared.discard(cut)
    where = place(items.select("length", "rank"), counts, capacity)
    return items.join(where, ["length", "rank"]).select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
