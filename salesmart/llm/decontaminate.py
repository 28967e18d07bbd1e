"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of the hashes of every ``k`` consecutive words, the least in each run of ``w`` is a
fingerprint. Two equal passages of ``k + w - 1`` words hold an equal run, so they share a
fingerprint: no shared passage of a benchmark window's length is missed. Fingerprints of
documents are joined with those of the items; a shared one is extended to the whole windows
it belongs to, which are compared as text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WINDOW = 10
# Of lower-cased text: everything but digits, a to z and other scripts' characters.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(lowered: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _parts(window: int) -> tuple[int, int]:
    k = (window + 1) // 2
    return k, window - k + 1


def _minima(rows: DataFrame, words: str, window: int, *carried: str) -> DataFrame:
    """``minima``: for each window of words its fingerprint; empty where there are too few.

    Each array is a column of its own before the next step reads it, so that none is computed
    once for each element of another.
    """
    k, w = _parts(window)
    hashed = rows.select(*carried, F.transform(words, lambda x: F.xxhash64(x)).alias("hashes"))
    size = F.size("hashes")
    grams = F.transform(
        F.when(size >= window, F.sequence(F.lit(0), size - k)).otherwise(F.array().cast("array<int>")),
        lambda i: F.xxhash64(*[F.get(F.col("hashes"), i + j) for j in range(k)]),
    )
    with_grams = hashed.select(*carried, grams.alias("grams"))
    count = F.size("grams") - (w - 1)
    minimum = F.least if w > 1 else (lambda x: x)
    minima = F.transform(
        F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: minimum(*[F.get(F.col("grams"), i + j) for j in range(w)]),
    )
    return with_grams.select(*carried, minima.alias("minima"))


def item_windows(items: DataFrame, *, window: int, key: str, text: str) -> DataFrame:
    """``item, length, passage`` of each distinct window of each item.

    An item of fewer words is one window; one without words, or with NULL key, has none.
    """
    words = items.select(
        F.col(key).cast("string").alias("item"), words_of(ascii_lower(F.col(text))).alias("words")
    ).filter(F.col("item").isNotNull() & (F.size("words") > 0))
    length = F.least(F.size("words"), F.lit(window))
    starts = words.select(
        "item", "words", length.alias("length"), F.explode(F.sequence(F.lit(1), F.size("words") - length + 1)).alias("at")
    )
    return starts.select(
        "item", "length", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("passage")
    ).distinct()


def hits(docs: DataFrame, windows: DataFrame, length: int) -> DataFrame:
    """``id, version, at, length, passage``: where documents hold a window of ``length`` words.

    ``docs`` has ``id, version, text``. Passages with equal fingerprints are compared as text.
    """
    passages = windows.filter(F.col("length") == length).select("passage").distinct()
    # The outer explode keeps Spark from filtering by the arrays' sizes beforehand, for which it
    # would put each array's expression into the next one's and compute it for each element.
    known = (
        _minima(passages.select(F.split("passage", " ").alias("words")), "words", length)
        .select(F.explode_outer("minima").alias("mark"))
        .filter("mark IS NOT NULL")
        .distinct()
    )
    listed = docs.select("id", "version", words_of(ascii_lower(F.col("text"))).alias("words"))
    marks = (
        _minima(listed, "words", length, "id", "version")
        .select("id", "version", F.explode_outer(F.array_distinct("minima")).alias("mark"))
        .filter("mark IS NOT NULL")
    )
    suspects = (
        marks.join(known, "mark").groupBy("id", "version").agg(F.collect_set("mark").alias("marks"))
    )
    same = F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.version") == F.col("s.version"))
    near = docs.alias("d").join(suspects.alias("s"), same).select(
        "d.id", "d.version", "s.marks", words_of(ascii_lower(F.col("d.text"))).alias("words")
    )
    # ``words`` and ``minima`` are each read twice, so that Spark keeps them as columns.
    exact = _minima(near, "words", length, "id", "version", "marks", "words")
    places = F.sequence(F.lit(0), F.least(F.size("minima"), F.size("words")) - 1)
    shared = F.filter(
        F.when(F.size("minima") > 0, places).otherwise(F.array().cast("array<int>")),
        lambda i: F.array_contains("marks", F.get("minima", i)),
    )
    passage = lambda i: F.array_join(F.slice("words", i + 1, length), " ")
    found = exact.select(
        "id",
        "version",
        F.explode_outer(
            F.transform(shared, lambda i: F.struct(i.alias("at"), passage(i).alias("passage")))
        ).alias("found"),
    ).select("id", "version", "found.at", F.lit(length).alias("length"), "found.passage")
    return found.filter("passage IS NOT NULL").join(passages, "passage")


def scan(
    docs: DataFrame,
    items: DataFrame,
    *,
    window: int = WINDOW,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key, version, n_words, n_hit, items`` of every document against every benchmark item.

    ``items`` has the ids, as sorted strings, of the items of which a window occurs; ``n_hit``
    counts the document's words within such occurrences; ``version`` is a hash of the text. NULL and wordless texts have no words
    and no hits. Repeated rows each give a row; rows of one key with different texts are told
    apart. An empty table of either kind gives no hits. Other columns are not read.

    The lengths of windows that occur are looked up first: at most ``window`` numbers.
    """
    own = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn(
        "version", F.coalesce(F.xxhash64("text"), F.lit(0))
    )
    windows = item_windows(items, window=window, key=item_key, text=item_text)
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())
    counted = own.select("id", "version", F.size(words_of(ascii_lower(F.col("text")))).cast("long").alias("n_words"))
    if not lengths:
        return counted.select(
            F.col("id").alias(key), "version", "n_words", F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items")
        )
    found = reduce(DataFrame.unionByName, [hits(own, windows, n) for n in lengths])
    by_doc = Window.partitionBy("id", "version").orderBy("at", "length")
    before = F.max(F.col("at") + F.col("length")).over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("at") + F.col("length")
    fresh = F.greatest(F.lit(0), end - F.greatest(F.col("at"), F.coalesce(before, F.lit(0))))
    covered = (
        found.withColumn("fresh", fresh).groupBy("id", "version").agg(F.sum("fresh").alias("n_hit"))
    )
    named = (
        found.select("id", "version", "passage")
        .distinct()
        .join(windows.select("passage", "item"), "passage")
        .groupBy("id", "version")
        .agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    result = counted.alias("d")
    for side, column in ((covered, "n_hit"), (named, "items")):
        same = F.col("d.id").eqNullSafe(F.col("s.id")) & (F.col("d.version") == F.col("s.version"))
        result = result.join(side.alias("s"), same, "left").select("d.*", f"s.{column}").alias("d")
    return result.select(
        F.col("id").alias(key),
        "version",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def summarise(scanned: DataFrame) -> DataFrame:
    """Counts and a digest of the items in place of their list."""
    return scanned.select(
        *[c for c in scanned.columns if c not in ("items", "version")],
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
