"""From raw documents to packed sequences: each stage reads what its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercato import scratch
from mercato.llm.decontaminate import decontaminated
from mercato.llm.jaccard import one_of_each
from mercato.llm.langid import recognised
from mercato.llm.packing import pack
from mercato.llm.pii import masked
from mercato.llm.queries import VOCABULARY
from mercato.session import narrow_batches

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told stay."""
    narrow_batches(spark)
    return recognised(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id."""
    narrow_batches(spark)
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark phrases are cut out; documents with nothing else go."""
    narrow_batches(spark)
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is masked; every document stays."""
    narrow_batches(spark)
    return masked(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's tokens, packed into sequences."""
    narrow_batches(spark)
    return pack(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

# Networks, tries and tokenizers are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again.

    Documents with a null or empty text, or without a letter, go in the first stage, as no language is
    told; of repeated rows one stays, of an id's different texts each is judged by itself; rows without an
    id are never removed as copies.  Nulls in other columns and further columns are passed on up to the
    last stage.  Empty tables give no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = scratch.materialize(docs, name)
    return docs
