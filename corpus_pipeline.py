"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, written as Parquet and read again, and calls one operator of the
library. All but the last return the columns of documents.

Nulls, empty and very long texts, repeated rows, ties, empty tables and further columns are treated as the operators' modules state;
an empty input gives empty results, and columns other than those of documents go along up to the last stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from concord.llm import packing, quality_classifier, rule_ledger, secret_links, simhash_dedup
from concord.session import discard, shared_path, table

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; trained on the labels of these documents."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy of the rule ledger."""
    return rule_ledger.keep_by_policy(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return simhash_dedup.keep_one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_links.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("quality rules", rules),
    ("near duplicates", near_duplicates),
    ("secret scans", secrets),
    ("packing", pack),
]

#: Trained models and the tokenizer's library have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written to the shared folder and read again. What only a later stage read goes at the end."""
    docs, paths = table(spark, sf_dir, "documents"), []
    for k, (_, stage) in enumerate(STAGES):
        paths.append(shared_path(spark, f"pipeline-stage{k}"))
        stage(spark, docs, sf_dir).write.parquet(paths[-1])
        docs = spark.read.parquet(paths[-1])
    discard(spark, *paths[:-1])
    return docs
