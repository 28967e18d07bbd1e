"""Shards of a reproducible shuffle: a Feistel permutation of the row numbers, with cycle walking.

A row number is written as two digits of mixed radix, ``high * width + low``. Each round adds to
one digit a keyed digest of the other, modulo its radix: that can be undone, so a pass permutes
all numbers below ``width * height``, the least such product that is not below the row count and
nearly square. Numbers that a pass carries beyond the rows are carried on until they are back.
These are fewer than ``width``, the root of the row count: their walks are worked out once, in a
table of their own, and looked up.

The permuted number is the place of a row in the shuffle; shard and slot are its remainder and
quotient by the number of shards. So the place of any row follows from its number, the row count
and the seed alone, and ``numbers`` goes the other way. Everything is Spark's own functions.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.numbering import numbered

SHARDS = 8
SEED = 2024
ROUNDS = 6
DIGITS = 15  # hexadecimal ones of a digest: 60 bits


def sides(rows: int) -> tuple[int, int]:
    """Radixes of the two digits: ``width * height >= rows``, by less than ``width``."""
    width = isqrt(max(rows, 1) - 1) + 1
    return width, -(-max(rows, 1) // width)


def _digest(digit: Column, number: Column, seed: int) -> Column:
    """SHA-256 of ``seed:round:digit``, its first 60 bits."""
    text = F.concat_ws(":", F.lit(str(seed)), number.cast("string"), digit.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, DIGITS), 16, 10).cast("long")


def one_pass(number: Column, rows: int, seed: int, rounds: int = ROUNDS, back: bool = False) -> Column:
    """A permutation of the numbers below ``width * height``; ``back`` undoes it."""
    width, height = (F.lit(side).cast("long") for side in sides(rows))
    low = number % width
    split = F.struct(low.alias("low"), ((number - low) / width).cast("long").alias("high"))

    def turn(digits: Column, step: Column) -> Column:
        low, high = digits["low"], digits["high"]
        moved_low = _digest(high, step, seed) % width
        moved_high = _digest(low, step, seed) % height
        if back:
            moved_low, moved_high = width - moved_low, height - moved_high
        even = step % 2 == 0
        return F.struct(
            F.when(even, (low + moved_low) % width).otherwise(low).alias("low"),
            F.when(even, high).otherwise((high + moved_high) % height).alias("high"),
        )

    steps = range(rounds - 1, -1, -1) if back else range(rounds)
    digits = F.aggregate(F.array(*[F.lit(s) for s in steps]), split, turn)
    return F.aggregate(F.array(digits), F.lit(0).cast("long"), lambda _, d: d["high"] * width + d["low"])


def permuted(
    df: DataFrame, number: str, rows: int, out: str, seed: int = SEED, rounds: int = ROUNDS, back: bool = False
) -> DataFrame:
    """``df`` with a column ``out``: the place of its ``number`` among ``rows`` in the shuffle.

    Numbers are from 0 to ``rows - 1``, each any number of times. ``back`` gives the number of
    a place. A walk beyond the rows meets no number twice, so it is over after as many passes as
    there are numbers out there.
    """
    width, height = sides(rows)
    beyond = width * height - rows

    def walk(at: Column) -> Column:
        once = lambda to, _: F.when(to < rows, to).otherwise(one_pass(to, rows, seed, rounds, back))
        return F.aggregate(F.sequence(F.lit(0), F.lit(beyond)), at, once)

    outside = df.sparkSession.range(rows, rows + beyond)
    walks = outside.select(F.col("id").alias("__from"), walk(F.col("id")).alias("__to")).filter(F.col("__to") < rows)
    moved = df.withColumn(out, one_pass(F.col(number).cast("long"), rows, seed, rounds, back))
    if not beyond:
        return moved
    # Fewer rows than the root of the row count, of two numbers each.
    both = moved.join(F.broadcast(walks), moved[out] == walks["__from"], "left")
    return both.withColumn(out, F.coalesce("__to", out)).drop("__from", "__to")


def numbers(places: DataFrame, rows: int, *, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``places`` (with ``shard`` and ``slot``) with the ``number`` of the row that lies there."""
    at = places.withColumn("__place", F.col("slot").cast("long") * shards + F.col("shard"))
    return permuted(at, "__place", rows, "number", seed, back=True).drop("__place")


def assign(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    seed: int = SEED,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``key, size, text_crc32, number, shard, slot`` of every row, and the columns ``carry``.

    Row numbers are places in the order of the key (NULL last), then of the text's CRC-32, size
    and hash; so the same table gives the same shuffle however its files are cut. Shards differ
    by one row at most, and slots count from 0 without a gap: the first shards have the extra
    rows. ``size`` is the text's bytes and 1. Texts are read where they are; only key, size and
    hashes are sorted, unless the text is among ``carry``.

    NULL texts have no bytes (size 1, CRC-32 0), like empty ones. Rows that are equal in key and
    text are placed one by one, in any order among them; equal texts of different rows are not
    kept together, as shards of equal counts could not hold a third of all rows. An empty table
    gives an empty one. The length of a text is of no account. Carried columns may not be called
    like those returned.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.xxhash64(content).alias("hash"),
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)],
    )
    order = [F.col("key").asc_nulls_last(), F.col("text_crc32"), F.col("size"), F.col("hash")]
    in_order = numbered(rows, order).drop("hash")
    count = in_order.count()
    at = F.col("place")
    return permuted(in_order, "number", count, "place", seed).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        "number",
        (at % shards).cast("int").alias("shard"),
        ((at - at % shards) / shards).cast("long").alias("slot"),
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)],
    )


def write_shards(docs: DataFrame, path: str, *, shards: int = SHARDS, seed: int = SEED, key: str = "doc_id", text: str = "text") -> None:
    """Write ``docs`` to one directory for each shard, in files that are in the order of the slots."""
    carried = [c for c in docs.columns if c != key]
    if taken := {"size", "text_crc32", "number", "shard", "slot"} & set(docs.columns):
        raise ValueError(f"rename the columns {sorted(taken)}")
    placed = assign(docs, key=key, text=text, shards=shards, seed=seed, carry=carried)
    dealt = placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.drop("size", "text_crc32", "number").write.partitionBy("shard").parquet(path)


def summarise(placed: DataFrame) -> DataFrame:
    """The law that holds: counts of rows at most one apart."""
    return placed.drop("number").withColumns(
        {"law": F.lit("rows"), "grown_shard": F.lit(None).cast("int")}
    )
