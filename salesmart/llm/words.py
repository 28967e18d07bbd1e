"""Words of UTF-8 texts and their 64-bit names, for a whole Arrow batch at once.

A word's name is 64 bits of its BLAKE2b digest, worked out once for each distinct word of a
batch. Sequences of words are named from halves: two names, the first and the last so many words,
are mixed into one, which no arithmetic pattern of words can cancel out. Names depend on the bytes
alone, so tasks and runs agree.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa

_FIRST, _LAST, _SIZE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def byte_table(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


WHITE = byte_table((0x20, 0x20), (0x09, 0x0D))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


@dataclass
class Words:
    """Words of a batch: byte bounds, hashes, and where each text's words begin."""

    data: np.ndarray  # the texts' bytes, one after the other
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each text, and one more

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes without a copy, and their n + 1 offsets; NULL is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(
        texts.buffers()[1], np.int64 if pa.types.is_large_string(texts.type) else np.int32
    )[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, separators: np.ndarray = WHITE, lower: bool = False) -> Words:
    data, offsets = buffers(texts)
    if lower:
        data = LOWER[data]
    size = len(data)
    inside = np.zeros(size + 1, bool)
    np.logical_not(separators[data], out=inside[:size])
    begins = inside[:size].copy()
    begins[1:] &= ~inside[: size - 1] if size else begins[1:]
    ends = inside[:size] & ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < size)]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    names = named(data[inside[:size]], end - start)  # the words' bytes alone
    return Words(data, start, end, names, np.searchsorted(start, offsets))


def named(letters: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of words that stand one after the other, without gaps, in ``letters``."""
    if not len(length):
        return np.empty(0, np.uint64)
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    listed = pa.Array.from_buffers(
        pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))]
    ).dictionary_encode()
    digests = b"".join([blake2b(word, digest_size=8).digest() for word in listed.dictionary.to_pylist()])
    return np.frombuffer(digests, np.uint64)[listed.indices.to_numpy()]


def joined(first: np.ndarray, last: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Names of sequences of ``size`` words from those of two parts that cover them."""
    return mix(first * _FIRST + last * _LAST + size * _SIZE)


def grams(hashes: np.ndarray, size: int, salt: int = 0) -> np.ndarray:
    """A name of every ``size`` consecutive words, texts' edges not regarded."""
    if len(hashes) < size:
        return np.empty(0, np.uint64)
    held, reach = hashes, 1
    while reach < size:
        step = min(reach, size - reach)
        reach += step
        held = joined(held[: len(held) - step], held[step:], np.full(1, reach, np.uint64))
    return mix(held ^ np.uint64(salt))


class Spans:
    """Names of stretches of words of any size, the same wherever they stand."""

    def __init__(self, hashes: np.ndarray):
        self.levels = [hashes]  # of 1, 2, 4 and so on words

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - begin
        level = np.frexp(size.astype(float))[1] - 1
        for k in range(len(self.levels), int(level.max(initial=0)) + 1):
            half = self.levels[-1]
            self.levels.append(joined(half[: -(1 << (k - 1))], half[1 << (k - 1) :], np.full(1, 1 << k, np.uint64)))
        out = np.empty(len(size), np.uint64)
        for k, held in enumerate(self.levels):
            at = np.flatnonzero(level == k)
            if len(at):
                out[at] = joined(held[begin[at]], held[end[at] - (1 << k)], size[at].astype(np.uint64))
        return out


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every ``size``-word shingle; shorter texts give one whole."""
    counts = words.counts()
    hashes = grams(words.hashes, size)
    owner = np.repeat(np.arange(len(counts)), counts)
    long = np.zeros(len(owner), bool)
    if len(hashes):
        long[: len(hashes)] = owner[: len(hashes)] == owner[size - 1 :]
    at = np.flatnonzero(long)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        whole = np.array(
            [
                grams(words.hashes[words.first[i] : words.first[i + 1]], int(counts[i]), 1 + int(counts[i]))[0]
                for i in short
            ],
            np.uint64,
        )
        return np.concatenate([hashes[at], whole]), np.concatenate([owner[at], short])
    return hashes[at], owner[at]
