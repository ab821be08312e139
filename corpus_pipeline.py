"""The training-data pipeline over ``documents``: each stage reads what the stage before it wrote.

Language identification, one document of each group of near copies, removal of repeated passages, interleaving of the
sources by target weights, BPE encoding and decoding. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tempora.llm.bag_minhash import near_duplicates
from tempora.llm.byte_cnn import NO_LANGUAGE, fit_language, least_score, with_language
from tempora.llm.common import stored
from tempora.llm.pfair_mix import mix_sources
from tempora.llm.queries import vocabulary_path
from tempora.llm.segment_bpe import encode_decode
from tempora.llm.suffix_groups import remove_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose score is not below that of nearly all right predictions on held-out documents."""
    net = fit_language(docs)
    told = with_language(docs, net)
    return told.where((F.col("__lang_pred") != NO_LANGUAGE) & (F.col("__lang_score") >= least_score(docs, net))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near copies, once; rows without an id or a word stay."""
    gone = near_duplicates(docs).where(F.col("doc_id") != F.col("class_id")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(stored(gone, "near-copies"), F.col("doc_id") == F.col("__gone"), "left_anti")


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeated 200-byte strings cover; what a cut leaves of a character goes as well."""
    text = F.when(F.col("text").isNotNull(), F.col("repeat_text"))
    return remove_repeats(docs, as_text=True).withColumn("text", text).withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the schedule that gives each source its target weight."""
    return mix_sources(docs)


def with_place(docs: DataFrame) -> DataFrame:
    """``docs`` with ``mix_place``: by it, rows have the order in which they were written, whatever order files are read in.

    Part and file numbers of the name that Spark gave the file, then the row in the file. Rows that do not come from
    files are numbered as they lie in their partitions.
    """
    try:
        name = F.col("_metadata.file_name")
        number = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("long"), F.lit(0))
        place = F.shiftleft(number(r"^part-([0-9]+)"), 43) + F.shiftleft(number(r"-c([0-9]+)\."), 31) + F.col("_metadata.row_index")
        return docs.withColumn("mix_place", place)
    except AnalysisException:
        return docs.withColumn("mix_place", F.monotonically_increasing_id())


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, token_ids, decoded, mix_place) of every document; ordered by ``mix_place`` they follow the schedule."""
    placed = with_place(docs).select(F.struct("doc_id", "mix_place").alias("__row"), "text")
    return encode_decode(placed, vocabulary_path(), id_col="__row").select("__row.doc_id", "token_ids", "decoded", "__row.mix_place")


#: In this order: operators 8, 3, 6, 9 and 7.
STAGES = [("language", language), ("near_dedup", near_dedup), ("repeats", repeats), ("mix", mix), ("encode", encode)]

#: Learned language, signatures and schedules have no SQL counterpart; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
