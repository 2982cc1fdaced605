"""A corpus from documents: five stages, each one of the operators, written and read again between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import verdigris
from verdigris.llm.compression_bands import keep_good
from verdigris.llm.markov_secrets import redact
from verdigris.llm.parity_join import jaccard_components
from verdigris.llm.queries import tokenizer_file
from verdigris.llm.sentencepiece_viterbi import encode_documents
from verdigris.llm.shared import stored
from verdigris.llm.winnowing import mark_contamination

# workers of a session started elsewhere do not have this folder on their path
cloudpickle.register_pickle_by_value(verdigris)

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the smallest id, once. Rows without id stay.

    Rows of one id are one document: the one with the least text stays (nulls last), and of equal texts the least of the other columns.
    """
    chosen = jaccard_components(docs).where("doc_id = component_id").select("doc_id").distinct()
    place = "_place"
    while place in docs.columns:
        place += "_"
    others = [F.col(c).cast("string").asc_nulls_last() for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_last(), *others)
    kept = docs.join(chosen, "doc_id", "left_semi").withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return kept.select(*docs.columns).union(docs.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with too many words of the benchmark go."""
    marked = mark_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where("NOT contaminated").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced; n_chars follows the text."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole texts as piece ids."""
    encoded = encode_documents(docs, tokenizer_file("piece_bpe_32k.model"))
    return encoded.select("doc_id", "lang", "source", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("long").alias("n_tokens"), "piece_ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Compression ratios, Markov models and piece ids can't be had in SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents`` of ``sf_dir``; all but the last are stored as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
