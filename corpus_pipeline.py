"""From raw documents to packed token ids: the stages and their run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floodledger.llm.decontaminate import without_items
from floodledger.llm.mixing import in_mixed_order, in_stretches
from floodledger.llm.ngram_join import similar_documents
from floodledger.llm.packing import packed
from floodledger.llm.quality import accepted
from floodledger.llm.store import cut, kept

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Every stage is a model or an array operation that SQL cannot express.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return accepted(docs.select(*COLUMNS), _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id stays, once."""
    groups = similar_documents(docs, 80, 5)
    gone = cut(groups.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    again = cut(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "again")
    return kept(docs.select(*COLUMNS), gone, again, "doc_id")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return without_items(docs.select(*COLUMNS), _table(spark, sf_dir, "benchmark"), 0.8, 5)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in an order in which every stretch has the sources' target weights."""
    return in_mixed_order(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in packed rows; by pack_id they follow the order of the mixture, whatever files the rows came in."""
    return packed(in_stretches(docs.select(*COLUMNS)), 2048, stretch="stretch")


STAGES = [
    ("quality_classifier", quality),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("token_packing", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
