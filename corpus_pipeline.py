"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.lineage import checkpoint_dir
from tagloom.llm import jaccard, language, lines, mixing, packing
from tagloom.llm.common import small_batches

#: Texts whose language is less sure than this are rejected; no text in a known language comes near it.
LEAST_SCORE = 0.3


def stage(work):
    """A stage with Arrow batches that suit long documents."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return work(spark, docs, sf_dir)

    return run_stage


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; those without letters, or like no language, go."""
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs["text"].alias("text"))
    found = language.identify(rows, language.train(docs))
    return found.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("doc.*")


@stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that repeat another; n_chars follows the text. Those left without a line go."""
    out = lines.dedup_lines(docs).filter((F.col("n_dropped") < F.col("n_lines")) | (F.col("n_dropped") == 0))
    size = F.when(F.col("n_dropped") > 0, F.char_length("doc.text")).otherwise(F.col("doc.n_chars")).cast("long")
    return out.select(F.col("doc").withField("n_chars", size).alias("doc")).select("doc.*")


@stage
def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest doc_id."""
    return jaccard.keep_one(docs)


@stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix of their sources."""
    return mixing.in_mixed_order(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences in the order of the mix.

    Files that are read again lose their order, so it is found anew: it depends on the rows only. Partitions, the windows in
    them and so sequence_id follow it.
    """
    return packing.pack_documents(mixing.in_mixed_order(docs))


STAGES = [
    ("language_id", language_id), ("line_dedup", line_dedup), ("ngram_jaccard", jaccard_dedup),
    ("mixing", mix), ("packing", pack),
]

#: Language identification is learned, which SQL cannot express; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, over ``documents``; the last one's rows."""
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, work in STAGES:
        path = f"{folder}/{name}"
        work(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
