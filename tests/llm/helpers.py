"""Small tables and plain re-computations for the tests."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
# Names that the operators use themselves: they must neither be read nor get in the way.
CLASHING = "key string, id string, version string, size string, rank string, score string"


def table(spark: SparkSession, rows: list[tuple], schema: str = "doc_id long, text string") -> DataFrame:
    clash = ("x",) * len(CLASHING.split(", "))
    return spark.createDataFrame([(*r, *clash) for r in rows], f"{schema}, {CLASHING}")


def by_key(df: DataFrame, key: str = "doc_id") -> dict:
    rows = [r.asDict(recursive=True) for r in df.collect()]
    found = {r[key]: r for r in rows}
    assert len(found) == len(rows)
    return found


def white_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def ascii_lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


class Classes:
    """Union of items into classes named by their least."""

    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, a, b) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def prose(rng: random.Random, count: int, vocabulary: int = 4000) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def thue_morse(length: int, zero: str = "a", one: str = "b") -> tuple[str, str]:
    """A sequence of two letters, and the same with the letters swapped.

    Hashes that are polynomials modulo a power of two cannot tell them apart.
    """
    bits = [bin(i).count("1") % 2 for i in range(length)]
    return "".join((zero, one)[b] for b in bits), "".join((one, zero)[b] for b in bits)
