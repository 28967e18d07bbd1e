"""Language ID by n-gram filters whose cells hold one bit for each language.

The model is a Bloom filter in bit slices: every cell is a mask of languages, an n-gram's
cells ANDed are all languages that contain it. A language contains an n-gram if enough of its
training documents do, compared with the language that has it most. A document's n-grams are
looked up at once; per language the hits are counted, the filter's own false-positive rate is
taken off, and the largest corrected share decides.

N-grams are of letters, lower case, every run of other characters being one space; spaces
stand only at an n-gram's ends, so none spans two words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm import shared, tokens
from salesmart.llm.words import mix

UNKNOWN = "und"
ORDERS = (2, 3, 4)
MIN_SHARE = 0.01  # of a language's documents, that contain an n-gram
MIN_RATIO = 0.2  # of the largest such share in any language
MIN_DOCS = 2  # that contain an n-gram, unless that is this share of the language's:
FEW = 0.05
CELLS_PER_GRAM = 16
PROBES = 3
PIECE = 1 << 17  # characters whose n-grams are worked on at once
SLICE_BYTES = 1 << 19
OWNER_BITS = 11  # of a 64-bit word for a text's number in its slice, the others for the n-gram's name
SCORE_PLACES = 6  # of the scores whose median is taken

_STEPS = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, 8, np.uint64) * np.uint64(2) + np.uint64(1)
_NAME = np.uint64((1 << (64 - OWNER_BITS)) - 1)
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """Code point to the lower-case letter's; 0 if it is no letter."""
    global _letters
    if _letters is None:
        table = np.zeros(0x110000, np.uint32)
        for code in range(0x110000):
            if (char := chr(code)).isalpha():
                table[code] = ord(low[0]) if (low := char.lower()) else code
        _letters = table
    return _letters


def gram_hashes(texts: list[str], orders: tuple[int, ...] = ORDERS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The n-grams' hashes (53 bits) and their text numbers, for each order of each piece of the texts.

    Every n-gram comes once. Pieces are of ``PIECE`` characters, wherever texts begin and end; the
    last letters of one are looked at again with the next.
    """
    joined = " " + " ".join(texts) + " "
    ends = np.cumsum([len(t) + 1 for t in texts])  # of each text, its space included
    table = _letter_table()
    before = 1  # the first space stays
    held, held_owner = np.empty(0, np.uint64), np.empty(0, np.int64)
    for start in range(0, len(joined), PIECE):
        piece = joined[start : start + PIECE].encode("utf-32-le", "surrogatepass")
        codes = table[np.frombuffer(piece, np.uint32)]
        kept = codes != 0
        kept[1:] |= codes[:-1] != 0
        kept[0] |= before != 0
        before = codes[-1]
        place = np.flatnonzero(kept)
        fresh = codes[place].astype(np.uint64)
        owner = np.minimum(np.searchsorted(ends, place + start, side="right"), len(texts) - 1)
        for order in orders:
            again = max(0, len(held) - order + 1)  # n-grams that end in this piece
            codes = np.concatenate([held[again:], fresh])
            owners = np.concatenate([held_owner[again:], owner])
            count = len(codes) - order + 1
            if count <= 0:
                continue
            valid = np.ones(count, bool)
            total = np.full(count, np.uint64(order))
            for j in range(order):
                if 0 < j < order - 1:
                    valid &= codes[j : j + count] != 0
                total += codes[j : j + count] * _STEPS[j]
            if order == 2:
                valid &= (codes[:count] != 0) | (codes[1:] != 0)
            at = np.flatnonzero(valid)
            middle = at + (codes[at] == 0)  # a leading space belongs to the text before
            yield mix(total[at]) & _NAME, owners[middle]
        held = np.concatenate([held, fresh])[-max(orders) :]
        held_owner = np.concatenate([held_owner, owner])[-max(orders) :]


def gram_documents(texts: list[str], langs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The distinct pairs of language (its number) and n-gram, and in how many texts.

    Texts go by language, so that one sort of (n-gram, text) also has each n-gram's languages together.
    """
    order = np.argsort(langs, kind="stable")
    bits = np.uint64(OWNER_BITS)
    for start in range(0, len(texts), 1 << OWNER_BITS):
        own = order[start : start + (1 << OWNER_BITS)]
        found = [hashes << bits | owner.astype(np.uint64) for hashes, owner in gram_hashes([texts[i] for i in own])]
        if not found:
            continue
        pairs = np.concatenate(found)
        del found
        pairs.sort()
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]  # an n-gram counts once a text
        lang = langs[own][(pairs & np.uint64((1 << OWNER_BITS) - 1)).view(np.int64)]
        grams = pairs >> bits
        first = np.flatnonzero(np.append(True, (grams[1:] != grams[:-1]) | (lang[1:] != lang[:-1])))
        yield lang[first], grams[first], np.diff(np.append(first, len(pairs)))


@dataclass
class Model:
    """``masks[cell, word]``: the languages of a cell, 64 in a word."""

    languages: list[str]
    masks: np.ndarray
    false_rate: np.ndarray  # of each language

    def cells(self, hashes: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(len(self.masks) - 1)
        step = (hashes >> np.uint64(33)) | np.uint64(1)
        return [((hashes + np.uint64(i) * step) & size).astype(np.int64) for i in range(PROBES)]

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language number (-1: no letter) and score of each text."""
        hits = np.zeros((len(texts), len(self.languages)))
        total = np.zeros(len(texts))
        for hashes, owner in gram_hashes(texts):
            total += np.bincount(owner, minlength=len(texts))
            cells = self.cells(hashes)
            for word in range(self.masks.shape[1]):
                found = self.masks[cells[0], word]
                for other in cells[1:]:
                    found = found & self.masks[other, word]
                for bit in range(min(64, len(self.languages) - 64 * word)):
                    here = owner[(found >> np.uint64(bit)) & np.uint64(1) != 0]
                    hits[:, 64 * word + bit] += np.bincount(here, minlength=len(texts))
        share = hits / np.maximum(total, 1)[:, None]
        share = np.clip((share - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1)
        best = share.argmax(axis=1) if len(self.languages) else np.zeros(len(texts), int)
        none = (total == 0) | (len(self.languages) == 0)
        score = share[np.arange(len(texts)), best] if len(self.languages) else total * 0
        return np.where(none, -1, best), np.where(none, 0.0, score)


def build(contained: dict[str, np.ndarray]) -> Model:
    """A model of each language's n-gram hashes; languages in the order given."""
    languages = list(contained)
    grams = len(np.unique(np.concatenate([*contained.values(), np.empty(0, np.uint64)])))
    size = 1 << max(10, int(np.ceil(np.log2(max(1, grams) * CELLS_PER_GRAM))))
    model = Model(languages, np.zeros((size, 1 + max(0, len(languages) - 1) // 64), np.uint64), np.zeros(len(languages)))
    for number, hashes in enumerate(contained.values()):
        bit = np.uint64(1) << np.uint64(number % 64)
        for cells in model.cells(hashes):
            model.masks[np.unique(cells), number // 64] |= bit
        filled = ((model.masks[:, number // 64] & bit) != 0).mean()
        model.false_rate[number] = filled**PROBES
    return model


@dataclass
class Sample:
    """Distinct texts of each language, and how many rows and distinct texts a language has."""

    texts: DataFrame  # lang, text
    rows: dict[str, int]
    drawn: dict[str, int]


def draw(labelled: DataFrame, *, text: str = "text", lang: str = "lang", sample: int | None = None) -> Sample:
    """All distinct texts of each language, or about ``sample`` of each at most if that is given.

    Rows with NULL text or language are left out. The distinct texts of a language go by their
    hash, however many rows have them, and each is drawn once.
    """
    rows = (
        labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
        .filter("lang IS NOT NULL AND text IS NOT NULL")
        .withColumn("hash", F.xxhash64("text"))
    )
    texts = rows.groupBy("lang", "hash").agg(F.count("*").alias("rows"))
    counts = texts.groupBy("lang").agg(F.sum("rows").alias("rows"), F.count("*").alias("texts")).collect()
    held = {r.lang: r["rows"] for r in counts}
    if sample is None:
        once = rows.groupBy("lang", "hash").agg(F.first("text").alias("text")).select("lang", "text")
        return Sample(once, held, {r.lang: r["texts"] for r in counts})
    most = F.lit(0)
    for r in counts:
        most = F.when(F.col("lang") == r.lang, F.lit(min(1.0, sample / r["texts"]))).otherwise(most)
    few = rows.filter(F.pmod("hash", F.lit(1_000_003)) < most * 1_000_003)
    once = few.groupBy("lang", "hash").agg(F.first("text").alias("text")).select("lang", "text")
    # By hash, so that each of several tasks gets its share of the sample, not of its bytes.
    spread = labelled.sparkSession.sparkContext.defaultParallelism
    drawn = shared.stored(once.repartition(max(16, 2 * spread), F.xxhash64("text")), "sample")
    return Sample(drawn, held, {r.lang: r["count"] for r in drawn.groupBy("lang").count().collect()})


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang", sample: int | None = None) -> Model:
    """A model of the rows' languages, learned from what ``draw`` gives of them."""
    return learn(draw(labelled, text=text, lang=lang, sample=sample))


def learn(sample: Sample) -> Model:
    """A model of the sample's languages.

    N-grams are counted per slice of texts before they are shuffled. What the driver
    gets is the n-grams that enough documents have: for each language at most the n-grams of a
    document over ``MIN_SHARE``.
    """
    if not sample.drawn:
        return build({})
    shared.bound_batches(sample.texts.sparkSession)
    names = list(sample.drawn)
    numbers = {name: number for number, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        for batch in batches:
            for part in shared.by_bytes(batch, "text", SLICE_BYTES):
                langs = np.array([numbers[name] for name in part["lang"].to_pylist()], np.int64)
                for number, grams, docs in gram_documents(part["text"].to_pylist(), langs):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(number), pa.array(grams.view(np.int64)), pa.array(docs.astype(np.int64))],
                        ["lang", "gram", "docs"],
                    )

    texts = F.array(*[F.lit(float(sample.drawn[name])) for name in names])
    shares = (
        sample.texts.mapInArrow(count, "lang long, gram long, docs long")
        .groupBy("lang", "gram")
        .agg(F.sum("docs").alias("docs"))
        .withColumn("share", F.col("docs") / F.get(texts, F.col("lang").cast("int")))
        .filter((F.col("share") >= MIN_SHARE) & ((F.col("docs") >= MIN_DOCS) | (F.col("share") >= FEW)))
    )
    table = shares.select("lang", "gram", "share").toPandas()
    table = table[table["share"] >= MIN_RATIO * table.groupby("gram")["share"].transform("max")]
    order = sorted(sample.drawn, key=lambda name: (-sample.rows[name], name))  # ties go to the commoner
    return build(
        {name: table.loc[table["lang"] == numbers[name], "gram"].to_numpy(np.int64).view(np.uint64) for name in order}
    )


def predict(docs: DataFrame, model: Model, *, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``key, lang_pred, score`` and the columns ``keep`` of every row, from its whole text.

    NULL texts and texts without a letter are ``und`` with score 0, as is all if no language
    was learned. Repeated rows and keys each give a row; an empty table gives an empty one. A long
    text is worked on piece by piece, which adds up to the same counts.
    """
    spark = docs.sparkSession
    shared.bound_batches(spark)
    carried = [c for c in dict.fromkeys((key, *keep)) if c != text]
    rows = docs.select(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)], F.col(text).alias("text")
    )
    names = [f"c{i}" for i in range(len(carried))]
    sent = spark.sparkContext.broadcast(model)  # of bounded size, see ``train``

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens.forget()
        model = sent.value
        known = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            for part in shared.by_bytes(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part["text"].to_pylist()]
                best, score = model.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[n] for n in names),
                        part["text"],
                        pa.array(known[best].tolist(), pa.string()),
                        pa.array(score, pa.float64()),
                    ],
                    [*names, "text", "lang_pred", "score"],
                )

    kept_text = text in keep
    fields = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    out = rows.mapInArrow(label, f"{fields}, text string, lang_pred string, score double")
    if not kept_text:
        out = out.drop("text")
    return out.withColumnsRenamed({f"c{i}": c for i, c in enumerate(carried)} | {"text": text})


def usual_scores(scored: DataFrame, *, text: str = "text", lang: str = "lang") -> dict[str, float]:
    """The median score of each language's distinct texts that are taken for it, to six places.

    ``scored`` has ``lang_pred`` and ``score`` beside the text and its label. Counts by score
    are added up, so that a language's window has a row for each score of so many places.
    """
    own = (
        scored.filter(F.col(text).isNotNull())
        .select(F.col(lang).cast("string").alias("lang"), F.xxhash64(text).alias("hash"), "lang_pred", "score")
        .filter(F.col("lang") == F.col("lang_pred"))
        .groupBy("lang", "hash")
        .agg(F.floor(F.max("score") * 10**SCORE_PLACES).alias("score"))
    )
    counts = own.groupBy("lang", "score").agg(F.count("*").alias("texts"))
    so_far = Window.partitionBy("lang").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    medians = (
        counts.withColumn("upto", F.sum("texts").over(so_far))
        .withColumn("all", F.sum("texts").over(Window.partitionBy("lang")))
        .filter(F.col("upto") * 2 >= F.col("all"))
        .groupBy("lang")
        .agg(F.min("score").alias("score"))
    )
    return {r.lang: r.score / 10**SCORE_PLACES for r in medians.collect()}


def held_out(key: Column) -> Column:
    """Documents that the model never learns from; NULL keys count as held out."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``key, held_out, lang_pred, score``; learned from the rows that are not held out."""
    model = train(docs.filter(~held_out(F.col(key))), text=text, lang=lang)
    return predict(docs, model, key=key, text=text).select(
        key, held_out(F.col(key)).alias("held_out"), "lang_pred", "score"
    )
