"""A corpus pipeline: quality, near duplicates, secrets, mixing, packing.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and gets what the stage
before kept, written as Parquet and read again. All but the last return the columns of
``documents``; ``run`` applies all of them. Null texts count as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablepact.llm.common import table, written
from tablepact.llm.mixing import mix, placed
from tablepact.llm.ngram_join import jaccard_join
from tablepact.llm.packing import pack
from tablepact.llm.quality import score, train
from tablepact.llm.secret_scan import redact


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the classifier rejects (score below 0.5). Empty texts have nothing that speaks
    against them and stay, as do all documents if ``labels`` lacks one of the classes."""
    model = train(docs, table(spark, sf_dir, "labels"))
    if {"score", "predicted"}.intersection(docs.columns):  # which the scores would replace
        kept = score(docs.select(F.struct("*").alias("doc"), F.col("text").alias("text")), model)
        return kept.filter("predicted = 1 OR text IS NULL OR text = ''").select("doc.*")
    # A batch holds each text once.
    return score(docs, model).filter("predicted = 1 OR text IS NULL OR text = ''").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one whose id names the group. Of several rows
    under one id one stays; rows without an id are in no group and all stay."""
    groups = written(jaccard_join(docs).filter("doc_id <> component_id").select("doc_id").distinct(), "others")
    rest = docs.join(groups, "doc_id", "left_anti").select(*docs.columns)
    repeated = written(rest.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 AND doc_id IS NOT NULL").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return rest
    first = rest.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.struct(F.xxhash64("text"), "text")).alias("doc"))
    return rest.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(first.select("doc.*"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text give way to a mark."""
    return redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: a row for each pass of a document that takes words, in training order."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in windows of 4096 ids, in training order: sequence ids ascend with it. The order is worked
    out anew from the mix's rows. Passes of one document are told apart by ``copy``."""
    return pack(placed(docs), vocabulary("word_bpe_49k.json"), order="position").drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("packing", packing),
]

#: Compression scores and tokenizers have no SQL; tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each one's result written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
