"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Native throughout: DataFrame functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewire.llm.common import materialise

#: Documents of a block, about; blocks are permuted, and documents within them.
BLOCK_DOCUMENTS = 4096
#: Exponents tried in one pass over the sources: four steps of bisection at once.
WAYS = 16


def token_counts(documents: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens) of documents: runs of characters other than white space. Null source: ''."""
    words = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return documents.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"), F.length(F.translate(words, " \t\n\x0b\x0c\r", "")).cast("long").alias("n_tokens"))


def find_exponent(sources: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None, passes: int = 6) -> float:
    """The largest exponent in [0, 1] for which weights ~ share ** exponent meet the limits.

    sources: (source, tokens). target_entropy: at least this share of the largest entropy,
    log of the number of sources. max_repeats: no source is read more than so many times for
    `budget` tokens; this one asks for large exponents, so where both are given it wins, with
    the smallest exponent that keeps it if the entropy's exponent does not. Entropy falls and
    repetition of the smallest source falls as the exponent grows, so bisection applies; each
    pass halves the range four times with one aggregate over the sources.
    """
    total, n = sources.agg(F.sum("tokens"), F.count("*")).first()
    if not total or n < 2:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))

    def search(measure, holds, fits_low: bool, low: float, high: float) -> float:
        """Bisect between low and high; fits_low: the limit holds at the low end."""
        for _ in range(passes):
            tried = [low + (high - low) * k / WAYS for k in range(1, WAYS)]
            values = sources.agg(*(m.alias(f"m{i}_{k}") for k, e in enumerate(tried) for i, m in enumerate(measure(e)))).first()
            ok = [holds(values, k) for k in range(len(tried))]
            inside = sum(ok)
            if fits_low:
                low, high = ([low, *tried][inside], [*tried, high][inside])
            else:
                low, high = ([low, *tried][len(tried) - inside], [*tried, high][len(tried) - inside])
        return low if fits_low else high

    exponent = 1.0
    if target_entropy is not None:

        def entropy(e):
            p = F.pow(share, F.lit(e))
            return F.sum(p), F.sum(p * F.log(p))

        def wide_enough(values, k):
            z, plogp = values[f"m0_{k}"], values[f"m1_{k}"]
            return math.log(z) - plogp / z >= target_entropy * math.log(n)

        exponent = search(entropy, wide_enough, True, 0.0, 1.0)
    if max_repeats is not None:
        want = float(budget if budget is not None else total)

        def repeats(e):
            return F.sum(F.pow(share, F.lit(e))), F.max(F.pow(share, F.lit(e)) / F.col("tokens"))

        def seldom_enough(values, k):
            return want * values[f"m1_{k}"] / values[f"m0_{k}"] <= max_repeats

        least = search(repeats, seldom_enough, False, 0.0, 1.0)
        exponent = max(exponent, least)
    return exponent


def mix(documents: DataFrame, target_entropy: float | None = 0.95, max_repeats: float | None = 4.0, budget: int | None = None, seed: str = "mix") -> DataFrame:
    """(doc_id, source, n_tokens, weight, copies, positions) for documents (doc_id, text, source).

    A row for each document that the mix takes at least once, and how often. A source's quota
    is weight * budget tokens (default budget: all tokens there are). It is filled by whole
    passes over the source, then a last pass over its documents in permuted order: blocks in
    the order of a hash, documents in each by another; a document is in the last pass while the
    tokens before it are fewer than what the quota leaves. positions has a place
    in the mix from 0 to 1 for each copy, ascending: the share of its source's quota that comes
    before it, so that sources are interleaved and passes follow one another. Documents without
    tokens count as in the last pass while it lasts. Equal rows are permuted together and kept apart.

    Blocks hold some BLOCK_DOCUMENTS documents of a source, whatever its size, so no task sorts
    a whole source; only a row for each block is summed in order.
    """
    counted = materialise(token_counts(documents), "tokens")
    sources = materialise(counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n_docs")).where("tokens > 0"), "sources")
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = int(total if budget is None else budget)
    exponent = find_exponent(sources, target_entropy, max_repeats, budget)
    powered = sources.withColumn("power", F.pow(F.col("tokens") / F.lit(float(total or 1)), F.lit(exponent)))
    z = powered.agg(F.sum("power")).first()[0] or 1.0
    quotas = powered.withColumn("weight", F.round(F.col("power") / F.lit(float(z)), 9))
    quotas = quotas.withColumn("quota", F.floor(F.col("weight") * F.lit(float(budget))).cast("long"))
    quotas = quotas.withColumn("passes", F.floor(F.col("quota") / F.col("tokens")).cast("long"))
    quotas = quotas.select("source", "tokens", "weight", "quota", "passes", (F.col("quota") - F.col("passes") * F.col("tokens")).alias("left_over"), F.ceil(F.col("n_docs") / F.lit(BLOCK_DOCUMENTS)).cast("long").alias("n_blocks"))
    drawn = F.md5(F.concat_ws(":", F.lit(seed), "source", F.col("doc_id").cast("string")))
    placed = counted.join(quotas, "source").withColumn("draw", drawn)
    placed = placed.withColumn("block", F.pmod(F.conv(F.substring("draw", 1, 8), 16, 10).cast("long"), F.col("n_blocks")))
    blocks = placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("in_block"))
    drawn = F.md5(F.concat_ws(":", F.lit(seed), "source", F.lit("block"), F.col("block").cast("string")))
    order = Window.partitionBy("source").orderBy(drawn, "block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.withColumn("before_block", F.coalesce(F.sum("in_block").over(order), F.lit(0))).drop("in_block")
    inner = Window.partitionBy("source", "block").orderBy("draw", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("before_doc", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    done = placed.join(before, ["source", "block"]).withColumn("at", F.col("before_block") + F.col("before_doc"))
    copies = F.col("passes") + (F.col("at") < F.col("left_over")).cast("long")
    done = done.withColumn("copies", copies).where("copies > 0")
    positions = F.transform(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1), lambda k: F.round((k * F.col("tokens") + F.col("at")) / F.col("quota"), 9))
    return done.select("doc_id", "source", "n_tokens", "weight", "copies", positions.alias("positions"))
