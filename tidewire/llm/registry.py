"""The corpus queries, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import collocations, conversations, decontaminate, embeddings, language_id, lines, mixing, ngram_join, packing, secrets, substrings, toxicity, url_filter
from tidewire.llm.common import table
from tidewire.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

#: (verdict, host/path) in the order given.
URL_RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document shares with the benchmark, exact windows only."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page; distrust_share is distrust / (trust + distrust) of its host, null where neither reaches it."""
    found = url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)
    both = F.col("trust") + F.col("distrust")
    return found.select("page_id", "host", "path", "rule", "verdict", F.round(F.when(both > 0, F.col("distrust") / both), 3).alias("distrust_share"))


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document; learned where crc32(doc_id) mod 5 is not 0."""
    documents = table(spark, sf_dir, "documents")
    models = language_id.fit(documents.where(_remainder(5) != 0).select("text", "lang"))
    found = language_id.identify(documents, models)
    return found.select("doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score", "phrase_rate")


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document; learned where crc32(doc_id) mod 4 is not 2."""
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels").where(_remainder(4) != 2))
    found = toxicity.score(documents, model)
    return found.select("doc_id", (_remainder(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def secret_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document, by the digest of its text."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", F.sha2("found", 256).alias("found_sha256"), "score", "secret", "claimed", "held_out")


def mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of the mix; positions_sha256 is of the places of its copies in billionths, comma-joined."""
    places = F.transform("positions", lambda p: F.round(p * 1e9).cast("long").cast("string"))
    found = mixing.mix(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "source", "n_tokens", "weight", "copies", F.sha2(F.concat_ws(",", places), 256).alias("positions_sha256"))


def embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at cosine 0.95."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 13 words that an earlier one has, by its digest."""
    found = substrings.remove_repeats(table(spark, sf_dir, "documents"), digest=True)
    return found.withColumnRenamed("kept", "kept_sha256")


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that repeat an earlier one, by its digest."""
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text"), 256).alias("kept_sha256"))


def shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share three quarters of their shingles of five words."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What it takes to repair every conversation once it is damaged; one that lost all its rows has no faults."""
    given = table(spark, sf_dir, "conversations")
    found = conversations.audit(conversations.damage(given)).withColumnRenamed("conv_id", "found_id")
    ids = given.select(F.col("conv_id").cast("long")).distinct()
    both = ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")) & F.col("audit").isNotNull(), "left")
    none = F.sha2(F.lit(""), 256)
    return both.select("conv_id", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in conversations.COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", none).alias("repaired_sha256"))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language by the score of their weakest cut."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4,096 tokens, by the digest of their ids."""
    import public_tokenizers

    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_embedding_dedup": embedding_groups,
    "op2_decontamination": contamination,
    "op3_line_dedup": line_dedup,
    "op4_toxicity": toxic,
    "op5_url_filter": url_verdicts,
    "op6_secret_scan": secret_findings,
    "op7_ngram_join": shingle_join,
    "op8_mixing": mixture,
    "op9_language_id": language,
    "op10_substring_dedup": substring_dedup,
    "op11_conversation_repair": repairs,
    "op12_collocations": phrases,
    "op13_packing": packed,
}
