"""The operators' queries over the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.jaccard import join

    return join(_table(spark, sf_dir, "documents")).drop("version", "group_id")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.warc import archive_pages

    return archive_pages(_table(spark, sf_dir, "pages"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.decontaminate import scan, summarise

    return summarise(scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.language import identify

    return identify(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from salesmart.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.licenses import scan, summarise

    return summarise(scan(_table(spark, sf_dir, "documents")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.lines import repeated_lines, summarise

    return summarise(repeated_lines(_table(spark, sf_dir, "documents")))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.substrings import remove_repeats, summarise

    return summarise(remove_repeats(_table(spark, sf_dir, "documents")))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.fingerprints import fingerprint_edits

    return fingerprint_edits(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from salesmart.llm.token_counts import count_tokens

    path = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(_table(spark, sf_dir, "documents"), path)


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.runs import find_runs, summarise, with_periods

    return summarise(find_runs(with_periods(_table(spark, sf_dir, "documents"))))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.sharding import assign, summarise

    return summarise(assign(_table(spark, sf_dir, "documents")))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from salesmart.llm.resampling import resample

    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op2_warc": op2_warc,
    "op3_decontamination": op3_decontamination,
    "op4_language": op4_language,
    "op5_packing": op5_packing,
    "op6_licenses": op6_licenses,
    "op7_line_dedup": op7_line_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_token_counts": op10_token_counts,
    "op11_runs": op11_runs,
    "op12_sharding": op12_sharding,
    "op13_resampling": op13_resampling,
}
