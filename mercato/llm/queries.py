"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.decontaminate import contaminated_spans
from mercato.llm.jaccard import linked_components
from mercato.llm.langid import identify
from mercato.llm.maintext import extracted
from mercato.llm.negatives import hard_negatives
from mercato.llm.packing import pack
from mercato.llm.pii import personal_data
from mercato.llm.sharding import sharded
from mercato.llm.tokens import token_counts
from mercato.llm.topk import nearest
from mercato.llm.variants import variants
from mercato.llm.warc import archived
from mercato.llm.windows import windows

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), VOCABULARY)


def op2_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return linked_components(_table(spark, folder, "documents"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = (_table(spark, folder, name) for name in ("documents", "benchmark"))
    found = contaminated_spans(documents, benchmark, ["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op4_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(_table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(_table(spark, folder, "documents"))


def op6_histogram_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharded(_table(spark, folder, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_exact_topk(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(_table(spark, folder, "embeddings"))


def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"), VOCABULARY)


def op9_warc_records(spark: SparkSession, folder: str) -> DataFrame:
    return archived(_table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return extracted(_table(spark, folder, "pages"))


def op11_ordered_windows(spark: SparkSession, folder: str) -> DataFrame:
    return windows(_table(spark, folder, "documents"), VOCABULARY)


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants(_table(spark, folder, "documents"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives(_table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_decontamination": op3_decontamination,
    "op4_personal_data": op4_personal_data,
    "op5_language_id": op5_language_id,
    "op6_histogram_shards": op6_histogram_shards,
    "op7_exact_topk": op7_exact_topk,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_warc_records": op9_warc_records,
    "op10_main_text": op10_main_text,
    "op11_ordered_windows": op11_ordered_windows,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_hard_negatives": op13_hard_negatives,
}
