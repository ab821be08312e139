"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tempora.llm.bag_minhash import near_duplicates
from tempora.llm.byte_cnn import identify_language
from tempora.llm.common import stored
from tempora.llm.host_paths import extract_text
from tempora.llm.pfair_mix import schedule
from tempora.llm.preference import format_pairs, neighbour_pairs
from tempora.llm.quality_hosts import quality_rules
from tempora.llm.segment_bpe import encode_decode
from tempora.llm.spelling_bits import spelling_groups
from tempora.llm.suffix_groups import remove_repeats
from tempora.llm.token_alignment import align_texts, vocabulary_size, with_pair_counts
from tempora.llm.topk_histogram import top_k
from tempora.llm.training_suffixes import is_clean, with_matches
from tempora.llm.url_rules import LEAST_BAD, STANDARD_ERRORS, judge_urls


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    kept = quality_rules(table(spark, sf, "documents"))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    found = extract_text(table(spark, sf, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """Class of each document; ``kept`` marks the one document of its class that stays."""
    classes = near_duplicates(table(spark, sf, "documents"))
    return classes.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


def op4_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    judged = judge_urls(table(spark, sf, "pages"), table(spark, sf, "labels"), least_bad=LEAST_BAD, standard_errors=STANDARD_ERRORS)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.col("repeat_bytes").alias("n_bytes"),
        F.aggregate("repeat_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_removed"),
        F.size("repeat_spans").cast("long").alias("n_spans"),
        F.sha2("repeat_kept", 256).alias("kept_sha256"),
    )


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = encode_decode(table(spark, sf, "documents"), vocabulary_path())
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_language(spark: SparkSession, sf: str) -> DataFrame:
    return identify_language(table(spark, sf, "documents"))


def op9_source_mix(spark: SparkSession, sf: str) -> DataFrame:
    return schedule(table(spark, sf, "documents"))


def op10_preference(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    return format_pairs(turns, neighbour_pairs(turns))


def op11_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    byte_vocabulary = vocabulary_path("byte_bpe_50k.json")
    aligned = align_texts(table(spark, sf, "documents"), byte_vocabulary, vocabulary_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return with_pair_counts(stored(aligned.withColumn("groups_sha256", digest).drop("groups"), "aligned"), vocabulary_size(byte_vocabulary))


def op12_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = with_matches(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"))
    return found.select(
        "doc_id",
        F.col("leak_words").alias("n_words"),
        F.aggregate("leak_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        F.size("leak_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("leak_items", ","), 256).alias("items_sha256"),
        (~is_clean()).alias("contaminated"),
    )


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling_groups(table(spark, sf, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_html_extraction,
        op3_minhash,
        op4_url_filters,
        op5_exact_topk,
        op6_suffix_dedup,
        op7_bpe,
        op8_language,
        op9_source_mix,
        op10_preference,
        op11_token_alignment,
        op12_decontamination,
        op13_spelling,
    )
}
