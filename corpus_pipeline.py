"""Corpus pipeline: language ID, line dedup, n-gram join, decontamination, mixing to target weights.

Each stage works on all that the one before kept and is written as Parquet in between. All but
the last return the columns of documents. Null texts, texts without letters and texts of no
learned language go in the first stage. Rows with a null doc_id are never compared with others and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import decontaminate, language_id, lines, mixing, ngram_join
from tidewire.llm.common import materialise, table

#: Ids up to which those that go are broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 1 << 20


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    ids = materialise(ids.select("doc_id").distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, "doc_id", "left_anti").select(docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without a letter go, and those that no language explains."""
    return language_id.keep_identified(docs, language_id.fit(docs), rates=language_id.held_out_rates(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one; those left without words go."""
    kept = lines.without_repeated_lines(docs).where(F.col("text").rlike(r"\S"))
    return kept.withColumns({c: F.length("text").cast("long") for c in docs.columns if c == "n_chars"})


def join_ngrams(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document of the smallest doc_id."""
    return _without(docs, ngram_join.near_duplicates(docs).where("doc_id <> component_id"))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where(F.size("spans") > 0))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, in its order."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_join", join_ngrams),
    ("decontamination", decontaminate_benchmark),
    ("mixing", mix_sources),
]

#: Cross-parsing and MinHash are beyond SQL; tests hold the pipeline against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
