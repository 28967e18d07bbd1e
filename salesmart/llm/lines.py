"""Line dedup: near-equal lines by segments and bit-parallel edit distance.

A line within ``EDITS`` edits of another keeps one of the other's ``EDITS + 1`` segments
unbroken. So the segments of every line are indexed by line length, number and content, and
every line probes, for each length it may match, the substrings at the places where an
unbroken segment can lie. Short lines are allowed fewer edits, in proportion to their length,
and so have fewer segments; where none is allowed, equal ids are all. Lines that meet in a list are sifted by sketches of their letter
pairs and verified by an edit distance computed in a band of bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm import links, shared, words

EDITS = 2
MIN_CHARS = 20  # shorter lines are allowed fewer edits; left out altogether without ``short``
_SALT = np.uint64(0xA24BAED4963EE407)
_BLANKS = "\t\v\f\r "
_BLANK = np.array([ord(c) for c in _BLANKS], np.uint32)
_BASE = 0x9E3779B97F4A7C15
_KEPT = 1 << 21  # powers that a worker keeps; those of longer texts are made anew
PIECE = 1 << 18  # characters of a text whose lines are worked on at once, or one line's
SLICE_BYTES = 1 << 19  # of texts that are; arrays of their characters take some 70 times as much
_powers: dict[int, np.ndarray] = {}


def _power(count: int, base: int = _BASE) -> np.ndarray:
    """Powers of ``base`` modulo 2**64."""
    made = _powers.get(base)
    if made is None or len(made) < count:
        made = np.multiply.accumulate(np.full(max(count, min(_KEPT, 2 * count)), np.uint64(base)))
        if len(made) <= _KEPT:
            _powers[base] = made
    return made[:count]


def _inverse_power(count: int) -> np.ndarray:
    return _power(count, pow(_BASE, -1, 2**64))


def within(a: str, b: str, most: int) -> bool:
    """Whether ``a`` becomes ``b`` by ``most`` edits or fewer.

    Columns of the distance table are bit vectors of the rows near the diagonal. ``score`` is
    the table's value at the band's lower end, which runs down the diagonal to the last row
    and then along it.
    """
    if a == b:
        return True
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > most:
        return False
    start, end = 0, 0
    while start < len(b) and a[start] == b[start]:
        start += 1
    while end < len(b) - start and a[len(a) - 1 - end] == b[len(b) - 1 - end]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not b:
        return len(a) <= most
    rows, columns = b, a  # rows are the shorter text
    if max(len(a), len(b)) <= most:
        return True
    width = 2 * most + 2
    mask, top = (1 << width) - 1, 1 << (width - 1)
    places: dict[str, int] = {}
    for at, letter in enumerate(rows):
        places[letter] = places.get(letter, 0) | 1 << at
    up, down = mask & ~((1 << (width - most - 1)) - 1), 0
    score, shift = most, most + 1 - width
    last = len(rows) - most  # columns until the band's end reaches the last row
    row_bit = top >> 1
    if last < 0:  # the band begins below the last row
        row_bit = top >> (1 - last)
        score = len(rows)
    for at, letter in enumerate(columns):
        found = places.get(letter, 0)
        equal = (found >> shift if shift >= 0 else found << -shift) & mask
        zero = ((((equal & up) + up) ^ up) | equal | down) & mask
        plus = (down | ~(zero | up)) & mask
        minus = zero & up
        if at < last:
            score += not zero & top
            if score > most + len(columns) - last:  # the last row may take off one a column
                return False
        else:
            score += bool(plus & row_bit) - bool(minus & row_bit)
            row_bit >>= 1
        up = (minus | ~((zero >> 1) | plus)) & mask
        down = (zero >> 1) & plus
        shift += 1
    return score <= most


def allowance(edits: int, min_chars: int, short: bool) -> np.ndarray:
    """Edits that the shorter line of a pair is allowed, by its length up to ``min_chars``.

    Below that, ``short`` lines are allowed their share of ``edits`` (one from 10 characters and
    none under these, by default), and always a segment of a character or more.
    """
    size = np.arange(min_chars + 1)
    most = np.minimum(edits * size // max(min_chars, 1), size - 1).clip(0) if short else np.zeros_like(size)
    most[min_chars] = edits
    return most


class _Lines:
    """The lines of a batch of texts: where they are, and which are long enough.

    A line's id is the XXH3 hash of its characters. Its parts, which only suggest pairs that are
    then compared, have polynomial hashes.
    """

    def __init__(self, texts: list[str]):
        joined = "\n".join(texts)
        data = joined.encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(data, np.uint32)
        breaks = np.flatnonzero(codes == 10)
        begin = np.concatenate([[0], breaks + 1])
        end = np.append(breaks, len(codes))
        counts = np.array([t.count("\n") + 1 for t in texts], np.int64)
        self.counts = counts
        self.owner = np.repeat(np.arange(len(texts)), counts)
        self.number = np.arange(len(begin)) - np.repeat(np.cumsum(counts) - counts, counts)
        solid = np.flatnonzero(~np.isin(codes, _BLANK) & (codes != 10))
        low, high = np.searchsorted(solid, begin), np.searchsorted(solid, end)
        some = high > low
        solid = np.append(solid, 0)
        self.start = np.where(some, solid[np.minimum(low, len(solid) - 1)], begin)
        self.size = np.where(some, solid[high - 1] + 1 - self.start, 0)
        self.codes, self.joined = codes, joined
        self.id = np.zeros(len(begin), np.int64)
        at = np.flatnonzero(self.size)
        bounds = zip((4 * self.start[at]).tolist(), (4 * (self.start[at] + self.size[at])).tolist())
        self.id[at] = np.array([xxhash.xxh3_64_intdigest(data[a:b]) for a, b in bounds], np.uint64).view(np.int64)

    def _prepare_parts(self) -> None:
        letters = words.mix(self.codes.astype(np.uint64) + _SALT)
        self.prefix = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(letters * _power(len(letters)), out=self.prefix[1:])
        self.undo = _inverse_power(len(letters) + 1)

    def part(self, start: np.ndarray, size: np.ndarray, salt: np.ndarray) -> np.ndarray:
        """Hashes of substrings, the same for the same content wherever it stands."""
        total = self.prefix[start + size] - self.prefix[start]
        return words.mix(total * self.undo[start] + words.mix(salt * np.uint64(2) + np.uint64(1)))

    def chosen(self, most: np.ndarray) -> np.ndarray:
        """The first of each distinct line that is long enough to be allowed an edit."""
        long = np.flatnonzero(most[np.minimum(self.size, len(most) - 1)] > 0)
        return long[np.unique(self.id[long], return_index=True)[1]]

    def tokens(self, at: np.ndarray, most: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Index and probe tokens of lines ``at``, with their ids."""
        self._prepare_parts()
        for edits, less in ((e, n) for e in np.unique(most[most > 0]).tolist() for n in range(e + 1)):
            other = self.size[at] - less  # the other line is so much shorter, and allowed ``edits``
            fit = (other >= 0) & (most[np.clip(other, 0, len(most) - 1)] == edits)
            start, size, name, other = self.start[at[fit]], self.size[at[fit]], self.id[at[fit]], other[fit]
            base, longer = other // (edits + 1), other % (edits + 1)
            for i in range(edits + 1):
                extra = np.maximum(0, i - (edits + 1 - longer))
                place = i * base + extra
                length = base + (i >= edits + 1 - longer)
                salt = (other * (int(most.max()) + 1) + i).astype(np.uint64)
                for move in range(max(-i, less - (edits - i)), min(i, less + edits - i) + 1):
                    first = place + move
                    fits = (first >= 0) & (first + length <= size) & (length > 0)
                    yield self.part((start + first)[fits], length[fits], salt[fits]).view(np.int64), name[fits]

    def sketch(self, at: np.ndarray) -> np.ndarray:
        count = self.size[at] - 1
        owner = np.repeat(np.arange(len(at)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.start[at], count)
        pair = self.codes[place].astype(np.uint64) << np.uint64(32) | self.codes[place + 1]
        return links.sketches(words.mix(pair), owner, len(at))

    def text(self, line: int) -> bytes:
        return self.joined[self.start[line] : self.start[line] + self.size[line]].encode("utf-8", "surrogatepass")


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, _Lines]]:
    for batch in batches:
        for part in shared.by_bytes(batch, "text", SLICE_BYTES):
            yield part, _Lines([t or "" for t in part["text"].to_pylist()])


def _pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE) -> Iterator[_Lines]:
    """The lines of all texts, whichever text they are of; long texts in pieces, cut between lines."""
    for batch in batches:
        for part in shared.by_bytes(batch, "text", SLICE_BYTES):
            texts = [t for t in part["text"].to_pylist() if t]
            for text in texts:
                if len(text) <= 2 * most:
                    continue
                start = 0
                while len(text) - start > most:
                    cut = text.rfind("\n", start, start + most)
                    cut = text.find("\n", start + most) if cut < 0 else cut
                    if cut < 0:
                        break
                    yield _Lines([text[start:cut]])
                    start = cut + 1
                yield _Lines([text[start:]])
            if texts := [t for t in texts if len(t) <= 2 * most]:
                yield _Lines(texts)


def _version(text: str):
    return F.coalesce(F.xxhash64(text), F.lit(0))


def lines_of(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """``key, version, n_lines, lines`` of each row; ``lines`` has number and id of the long ones."""
    shared.bound_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), _version(text).alias("version"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    entry = pa.list_(pa.struct([("number", pa.int32()), ("id", pa.int64())]))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _batches(batches):
            long = np.flatnonzero(found.size >= min_chars)
            offsets = np.searchsorted(found.owner[long], np.arange(len(part) + 1)).astype(np.int32)
            values = pa.StructArray.from_arrays(
                [pa.array(found.number[long].astype(np.int32)), pa.array(found.id[long])], ["number", "id"]
            )
            none = part["text"].is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    part["key"],
                    part["version"],
                    pa.array(np.where(none, 0, found.counts)),
                    pa.ListArray.from_arrays(pa.array(offsets), values).cast(entry),
                ],
                ["key", "version", "n_lines", "lines"],
            )

    return rows.mapInArrow(
        make, f"key {kind}, version long, n_lines long, lines array<struct<number: int, id: long>>"
    )


def _firsts(found: DataFrame) -> DataFrame:
    """``id, place`` of each distinct line of ``lines_of``: the first place that has it.

    Minima are combined before they are shuffled: a very common line is one row a task.
    """
    places = found.select("key", "version", F.explode("lines").alias("line"))
    place = F.struct("key", "version", F.col("line.number").alias("number"))
    return places.groupBy(F.col("line.id").alias("id")).agg(F.min(place).alias("place"))


def _texts_of(ids: DataFrame, firsts: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, data`` of the lines ``ids``, each taken from its first place.

    Of the texts about only those that hold such a place are shuffled, by a filter of bounded size.
    """
    spark = docs.sparkSession
    wanted = shared.stored(
        firsts.join(ids, "id", "left_semi")
        .groupBy(F.col("place.key").alias("key"), F.col("place.version").alias("version"))
        .agg(F.collect_list(F.struct(F.col("place.number").alias("number"), "id")).alias("wanted")),
        "wanted",
    )
    held = links.id_filter(spark, wanted.select(F.col("version").alias("id")))
    rows = docs.select(F.col(key).alias("key"), _version(text).alias("version"), F.col(text).alias("text"))

    def hold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(links.may_hold(held.value, batch["version"].to_numpy())))

    holding = rows.mapInArrow(hold, rows.schema)
    same = F.col("d.key").eqNullSafe(F.col("w.key")) & (F.col("d.version") == F.col("w.version"))
    # By merging, so that a shuffle parts ``hold`` from ``take``: a task that runs both has two Python
    # workers, which stay, and an executor then holds twice as many for all that follows.
    holding = holding.alias("d").join(wanted.hint("merge").alias("w"), same).select("d.text", "w.wanted")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "text", SLICE_BYTES):
                name, data = [], []
                for body, places in zip(part["text"], part["wanted"]):
                    all_lines = body.as_py().split("\n")
                    for place in places.as_py():
                        name.append(place["id"])
                        data.append(all_lines[place["number"]].strip(_BLANKS).encode("utf-8", "surrogatepass"))
                yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array(data, pa.binary())], ["id", "data"])

    # Rows equal in key and text each give the same lines.
    return holding.mapInArrow(take, "id long, data binary").dropDuplicates(["id"])


def similar_lines(
    docs: DataFrame,
    firsts: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    short: bool = True,
) -> DataFrame:
    """``id, component`` of distinct lines within their allowed edits of another, or by way of others.

    ``firsts`` has the first place of every line of ``docs`` that may be allowed an edit.
    """
    spark = docs.sparkSession
    most = allowance(edits, min_chars, short)
    shared.bound_batches(spark)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in _pieces(batches):
            found = list(piece.tokens(piece.chosen(most), most))
            if found:
                token, name = (np.concatenate(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(token), pa.array(name), pa.array(np.zeros(len(name), np.int32))],
                    ["token", "id", "salt"],
                )

    tokens = docs.select(F.col(text).alias("text")).mapInArrow(post, "token long, id long, salt int")
    lists = shared.stored(links.shared_lists(tokens), "lists")
    texts = shared.stored(_texts_of(lists.select("id").distinct(), firsts, docs, key, text), "texts")

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in shared.by_bytes(batch, "data", SLICE_BYTES):
                piece = _Lines([d.decode("utf-8", "surrogatepass") for d in part["data"].to_pylist()])
                bits = [b.tobytes() for b in piece.sketch(np.arange(len(part)))]
                yield pa.RecordBatch.from_arrays(
                    [part["id"], pa.array(piece.size), pa.array(bits, pa.binary())], ["id", "size", "sketch"]
                )

    items = shared.stored(texts.mapInArrow(sketch, "id long, size long, sketch binary"), "items")

    def near(a, b, differing):
        # An edit takes away and brings in two letter pairs at most.
        allowed = most[np.minimum(np.minimum(a, b), min_chars)]
        return (differing <= 4 * allowed) & (np.abs(a - b) <= allowed)

    def same(a: bytes, b: bytes) -> bool:
        one, other = a.decode("utf-8", "surrogatepass"), b.decode("utf-8", "surrogatepass")
        return within(one, other, int(most[min(len(one), len(other), min_chars)]))

    return links.classes(lists, items, lambda ids: texts.join(ids, "id", "left_semi"), near, same)


def repeated_lines(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    edits: int = EDITS,
    min_chars: int = MIN_CHARS,
    short: bool = True,
) -> DataFrame:
    """``key, version, n_lines, removed`` of every distinct row: numbers of its repeated lines.

    Lines end at line feeds and are compared without the blanks around them. Lines of
    ``min_chars`` characters or more are of one class if ``edits`` or fewer edits make one of the
    other, directly or by way of others. So are shorter ones but empty lines, a pair by the edits
    that ``allowance`` gives its shorter line: by default 2 from 20 characters, 1 from 10, and
    below that only equal lines. Without ``short`` these are left alone. Of a class the first
    line stays, by key (NULL first), text and number; all others are repeated. Rows equal in key and text are one document.
    ``version`` is a hash of the text. NULL texts have no lines, empty ones one, none repeated.
    Very long texts are worked on in pieces of whole lines; a line is one task's work however long.
    """
    least = min(1, min_chars) if short else min_chars
    found = shared.stored(lines_of(docs, key=key, text=text, min_chars=least).dropDuplicates(["key", "version"]), "lines")
    firsts = shared.stored(_firsts(found), "firsts")
    alike = similar_lines(docs, firsts, key=key, text=text, edits=edits, min_chars=min_chars, short=short)
    named = firsts.join(alike, "id", "left").select(F.coalesce("component", "id").alias("grp"), "place")
    # The places that stay are one a class; a class's other places never meet.
    stay = (
        named.groupBy("grp")
        .agg(F.min("place").alias("first"))
        .groupBy(F.col("first.key").alias("key"), F.col("first.version").alias("version"))
        .agg(F.collect_list("first.number").alias("numbers"))
    )
    same = F.col("f.key").eqNullSafe(F.col("s.key")) & (F.col("f.version") == F.col("s.version"))
    none = F.array().cast("array<int>")
    return found.alias("f").join(stay.alias("s"), same, "left").select(
        "f.key",
        "f.version",
        "f.n_lines",
        F.array_except("f.lines.number", F.coalesce("s.numbers", none)).alias("removed"),
    )


def summarise(repeated: DataFrame, key: str = "doc_id") -> DataFrame:
    return repeated.select(
        F.col("key").alias(key),
        "n_lines",
        F.size("removed").cast("long").alias("n_removed"),
        F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed_lines"),
    )


def drop_lines(docs: DataFrame, repeated: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that ``repeated`` names; all columns stay."""
    gone = repeated.filter(F.size("removed") > 0).select(
        F.col("key").alias("__key"), F.col("version").alias("__version"), F.col("removed").alias("__removed")
    )
    same = F.col(key).eqNullSafe(F.col("__key")) & (_version(text) == F.col("__version"))
    kept = F.array_join(
        F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains("__removed", i)), "\n"
    )
    return docs.join(gone, same, "left").withColumn(
        text, F.when(F.col("__removed").isNull(), F.col(text)).otherwise(kept)
    ).drop("__key", "__version", "__removed")
