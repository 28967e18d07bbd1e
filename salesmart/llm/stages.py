"""The operators as filters and rewriters of a table of documents, one after the other.

Each takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``. Rows are
found again by key and a hash of their text, NULL keys included. Columns beside ``doc_id``,
``text`` and ``n_chars`` are carried along as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.llm import decontaminate, jaccard, language, lines, packing, shared

LEAST_SCORE = 0.5  # of the usual score of its language, that a document must reach


def _version() -> Column:
    return F.coalesce(F.xxhash64("text"), F.lit(0))


def _same(docs: str, other: str) -> Column:
    return F.col(f"{docs}.doc_id").eqNullSafe(F.col(f"{other}.__key")) & (
        F.col(f"{docs}.__version") == F.col(f"{other}.__version")
    )


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter or with too few n-grams of any learned language.

    The limit of a language is a share of its labelled texts' median score. Where nothing was
    learned, all documents with a letter stay.
    """
    model = language.train(docs)
    if not model.masks.any():
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    labels = ("lang_pred", "score")
    rows = docs.withColumnsRenamed({c: f"__{c}" for c in docs.columns if c in labels})
    found = shared.stored(language.predict(rows, model, keep=tuple(rows.columns)), "scored")
    least = F.lit(LEAST_SCORE)
    for name, usual in language.usual_scores(found).items():
        least = F.when(F.col("lang_pred") == name, F.lit(LEAST_SCORE * usual)).otherwise(least)
    kept = found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= least))
    return kept.select(*[F.col(f"__{c}" if c in labels else c).alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out lines that repeat an earlier one, and documents that are left with nothing."""
    repeated = lines.repeated_lines(docs)
    cut = lines.drop_lines(docs.withColumn("__had", F.col("text").rlike(r"\S")), repeated)
    left = cut.filter(F.col("text").rlike(r"\S") | ~F.coalesce("__had", F.lit(False))).drop("__had")
    return left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(
        docs.columns
    )


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their shingles keep that with the smallest key, and all unlinked."""
    found = jaccard.join(docs)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "version")
    wordless = F.when(F.col("n_shingles") == 0, F.struct("doc_id", "version"))
    kept = (
        found.groupBy("group_id", wordless.alias("own"))
        .agg(F.min(place).alias("first"))
        .select(F.col("first.doc_id").alias("__key"), F.col("first.version").alias("__version"))
    )
    rows = docs.withColumn("__version", _version()).alias("d")
    stay = rows.join(kept.alias("k"), _same("d", "k"), "left_semi")
    return stay.dropDuplicates(["doc_id", "__version"]).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    hit = decontaminate.scan(docs, items).filter("n_hit > 0")
    gone = hit.select(F.col("doc_id").alias("__key"), F.col("version").alias("__version")).distinct()
    rows = docs.withColumn("__version", _version()).alias("d")
    return rows.join(gone.alias("g"), _same("d", "g"), "left_anti").select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place what is left in token sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
