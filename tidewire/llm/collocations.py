"""Phrase collocations from suffix subtrees, built apart for groups of word prefixes.

The corpus is scanned once for its words. Word prefixes are grouped so that the suffixes of a
group fit the memory budget; a prefix with more than that is extended by another word. A second
scan sends each suffix, truncated to the longest phrase, to its prefix's group, where a subtree
is built of them alone; the count of a phrase is the total of the leaves below its node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import materialise, trim, trimmed
from tidewire.llm.words import is_in, mixed, word_places

#: Suffixes of a group (28 bytes each): the memory budget. Also the words that a task has at hand.
BUDGET = 1 << 20
#: Parts of a task's words, by their hashes, whose suffixes are sorted one after the other.
PARTS = 4
#: Prefixes over the budget, about, at most: from 2^40 words on the budget grows with the corpus.
MOST_HOT = 1 << 20
#: Bits of the largest table that tells frequent words from most others.
MOST_BITS = 1 << 28
#: Parts of the hash range in which prefixes are weighed.
RANGES = 1 << 16

#: Words end at spaces and tabs, pieces at these.
BREAKS = b".,;:!?\n\x0b\x0c\r"


def _letters() -> bytes:
    """Lower-cases A-Z; what ends a piece becomes a newline."""
    out = bytearray(range(256))
    for b in range(ord("A"), ord("Z") + 1):
        out[b] = b + 32
    for b in BREAKS:
        out[b] = 10
    return bytes(out)


LETTERS = _letters()
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Chunk:
    """The words of some documents as hashes that tell languages apart, and the piece of each."""

    def __init__(self, langs: list[str], texts: list[bytes], words: list[tuple]):
        sizes = np.array([len(h) for h, _, _ in words])
        self.langs, self.texts, self.sizes = langs, texts, sizes
        self.first = [a for _, a, _ in words]
        self.last = [b for _, _, b in words]
        salts = np.array([int.from_bytes(hashlib.md5(x.encode()).digest()[:8], "little") for x in langs], np.uint64)
        self.hashes = np.maximum(mixed(np.concatenate([h for h, _, _ in words]) + np.repeat(salts, sizes)), np.uint64(1))
        pieces, base = [], 0
        for text, (_, start, _) in zip(texts, words, strict=True):
            breaks = np.cumsum(np.frombuffer(text, np.uint8) == 10)
            pieces.append(breaks[start] + base)
            base += int(breaks[-1]) + 1
        self.pieces = np.concatenate(pieces)

    def vocabulary(self, share: float) -> pa.RecordBatch:
        """Rows of _COUNTED: every word, every language's total, and the pairs that have `share` occurrences or more."""
        values, first, counts = np.unique(self.hashes, return_index=True, return_counts=True)
        text, begins = np.repeat(np.arange(len(self.texts)), self.sizes)[first], np.cumsum(self.sizes) - self.sizes
        at = first - begins[text]
        of_word = [self.texts[t][self.first[t][k] : self.last[t][k]].decode("utf-8", "replace") for t, k in zip(text.tolist(), at.tolist(), strict=True)]
        # Columns, not rows: a tuple for each word would take more than the chunk.
        langs = pa.DictionaryArray.from_arrays(pa.array(text), pa.array(self.langs, pa.string())).cast(pa.string())
        known = [langs, pa.array(of_word, pa.string()), pa.array(values.view(np.int64)), pa.array(np.zeros(len(values), np.int64)), pa.array(counts.astype(np.int64))]
        del of_word, first, at, text
        totals: dict[str, int] = {}
        for lang, n in zip(self.langs, self.sizes.tolist(), strict=True):
            totals[lang] = totals.get(lang, 0) + n
        rows = [(lang, None, 0, 0, n) for lang, n in totals.items()]
        everything = np.ones(len(self.hashes), bool)
        for part in range(PARTS):
            w1, w2, _, n = self.suffixes(everything, 2, part)
            often = n >= share
            rows += [(None, None, a, b, c) for a, b, c in zip(w1[often].view(np.int64).tolist(), w2[often].view(np.int64).tolist(), n[often].tolist(), strict=True)]
        more = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _COUNTED, strict=True)]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(known, more, strict=True)], schema=_COUNTED)

    def suffixes(self, frequent: np.ndarray, depth: int = 3, part: int | None = None) -> tuple[np.ndarray, ...]:
        """(w1, w2, w3, n): the distinct suffixes of two words or more, cut at `depth`, the piece's end and words that aren't frequent; 0 is no word.

        part: only those whose first word's hash is in this one of PARTS, so that less is sorted at once.
        """
        h, piece, n = self.hashes, self.pieces, len(self.hashes)
        at = np.flatnonzero(frequent[:-1] & frequent[1:] & (piece[:-1] == piece[1:])) if n > 1 else np.zeros(0, np.int64)
        if part is not None:
            at = at[h[at] % np.uint64(PARTS) == part]
        w1, w2, w3 = h[at], h[at + 1] if n > 1 else h[:0], np.zeros(len(at), np.uint64)
        if depth > 2:
            third = np.minimum(at + 2, n - 1)
            w3 = np.where((at + 2 < n) & frequent[third] & (piece[third] == piece[at]), h[third], np.uint64(0))
        if not len(at):
            return w1, w2, w3, np.zeros(0, np.int64)
        key = mixed(mixed(mixed(w1) + w2) + w3)
        order = np.argsort(key)
        w1, w2, w3, key = w1[order], w2[order], w3[order], key[order]
        change = lambda *x: np.concatenate(([True], np.logical_or.reduce([y[1:] != y[:-1] for y in x])))
        new = change(key)
        if (change(w1, w2, w3) & ~new).any():  # two suffixes of one key: sort the words themselves
            order = np.lexsort((w3, w2, w1))
            w1, w2, w3 = w1[order], w2[order], w3[order]
            new = change(w1, w2, w3)
        starts = np.flatnonzero(new)
        return w1[starts], w2[starts], w3[starts], np.diff(np.append(starts, len(w1)))


_COUNTED = pa.schema([("lang", pa.string()), ("word", pa.string()), ("w1", pa.int64()), ("w2", pa.int64()), ("n", pa.int64())])


def _chunks(batches) -> Iterator[Chunk]:
    """Chunks of batches (lang, text): some BUDGET words each, or a longer text."""
    langs, texts, words, size = [], [], [], 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "replace").translate(LETTERS)
            found = word_places(raw)
            if not len(found[0]):
                continue
            # Places fit 32 bits, as texts are under 2 GB.
            langs.append(lang), texts.append(raw), words.append((found[0], found[1].astype(np.int32), found[2].astype(np.int32)))
            size += len(found[0])
            if size >= BUDGET:
                chunk = Chunk(langs, texts, words)
                langs, texts, words, size = [], [], [], 0
                yield chunk
                del chunk  # nor may the caller hold it while the next is gathered
    if langs:
        yield Chunk(langs, texts, words)


class Subtree:
    """The suffixes of a group, sorted: leaves of depth three, and the nodes of depth two above them."""

    def __init__(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray, n: np.ndarray):
        order = np.lexsort((w3, w2, w1))
        self.w1, self.w2, self.w3, n = w1[order], w2[order], w3[order], n[order]
        pair = np.concatenate(([True], (self.w1[1:] != self.w1[:-1]) | (self.w2[1:] != self.w2[:-1])))
        leaf = pair | np.concatenate(([True], self.w3[1:] != self.w3[:-1]))
        self.leaves, self.nodes = np.flatnonzero(leaf), np.flatnonzero(pair)
        self.leaf_totals, self.node_totals = np.add.reduceat(n, self.leaves), np.add.reduceat(n, self.nodes)


class Groups:
    """Which group a prefix belongs to.

    weights: suffixes of the prefixes of each range of hashes. Neighbouring ranges are one group
    as long as they fit the budget; one that has more is split by further bits of the hash.
    """

    def __init__(self, weights: np.ndarray, budget: int, hot_words: np.ndarray, hot_pairs: np.ndarray):
        self.hot_words, self.hot_pairs = np.sort(hot_words), np.sort(hot_pairs)
        self.parts = np.maximum(1, -(-2 * weights // budget) * (weights > budget)).astype(np.uint64)
        self.base = np.zeros(len(weights), np.int64)
        group, held = 0, 0
        for k, (w, parts) in enumerate(zip(weights.tolist(), self.parts.tolist(), strict=True)):
            if held and (parts > 1 or held + w > budget):
                group, held = group + 1, 0
            self.base[k] = group
            if parts > 1:
                group += parts
            else:
                held += w

    def is_hot_pair(self, w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
        return is_in(mixed(mixed(w1) + w2), self.hot_pairs)

    def of(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> np.ndarray:
        """By the first word; by the first two if that is over the budget; by all three if those are."""
        pair = mixed(mixed(w1) + w2)
        prefix = np.where(is_in(w1, self.hot_words), np.where(is_in(pair, self.hot_pairs), mixed(pair + w3), pair), w1)
        at = (prefix >> np.uint64(48)).astype(np.int64)
        below = (prefix >> np.uint64(16)) & np.uint64(0xFFFFFFFF)
        return self.base[at] + ((below * self.parts[at]) >> np.uint64(32)).astype(np.int64)


_SENT = pa.schema([("group", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64()), ("n", pa.int32())])
_NODES = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("w3", pa.int64()), ("a", pa.int64()), ("part", pa.bool_())])


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().view(np.uint64)


def vocabulary(documents: DataFrame, least: int) -> tuple[DataFrame, int]:
    """Rows (lang, word, w1, w2, n), and the budget: words with `least` occurrences or more, totals (no word), pairs that may be over the budget (no lang)."""
    texts = _texts(documents)
    # A word takes two bytes at least.
    n_bytes = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    budget = max(BUDGET, n_bytes // 2 // MOST_HOT)

    def count(batches):
        for chunk in _chunks(batches):
            # What a chunk does not report of a pair sums to half the budget over all chunks.
            yield chunk.vocabulary(budget * sum(map(len, chunk.texts)) / (2 * n_bytes))
            del chunk

    counted = texts.mapInArrow(trimmed(count), "lang string, word string, w1 long, w2 long, n long").groupBy("lang", "word", "w1", "w2").agg(F.sum("n").alias("n"))
    kept = counted.where((F.col("n") >= least) & F.col("word").isNotNull() | (F.col("w1") == 0) | (F.col("w2") != 0) & (F.col("n") > budget // 2))
    return materialise(kept, "vocabulary"), budget


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))


def _frequent_bits(words: DataFrame) -> np.ndarray:
    """A table of bits, one of which each word's hash sets; few other hashes meet a set one."""
    n_bits = min(MOST_BITS, 1 << max(15, (32 * words.count()).bit_length()))
    place = F.col("w1").bitwiseAND(F.lit(n_bits - 1)) + 1
    blocks = words.groupBy(F.bitmap_bucket_number(place).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    table = np.zeros(n_bits // 8, np.uint8)
    for r in blocks.collect():  # of 4,096 bytes each
        table[(r["block"] - 1) * 4096 : r["block"] * 4096] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return table


def phrase_counts(documents: DataFrame, counted: DataFrame, budget: int, least: int) -> DataFrame:
    """(w1, w2, w3, a): phrases of two words (w3 is 0) and three with `least` occurrences or more."""
    sc = documents.sparkSession.sparkContext
    words = counted.where("word IS NOT NULL")
    hot_words = np.array([r["w1"] for r in words.where(F.col("n") > budget).select("w1").collect()], np.int64).view(np.uint64)
    hot = F.broadcast(words.where(F.col("n") > budget).select("w1"))
    pairs = counted.where("w2 <> 0").join(hot, "w1", "left_semi").select("w1", "w2").collect()
    pairs = np.array([tuple(r) for r in pairs], np.int64).reshape(-1, 2).view(np.uint64)
    weights = np.zeros(RANGES, np.int64)
    part = F.shiftrightunsigned("w1", 48).alias("part")
    for r in words.where(F.col("n") <= budget).groupBy(part).agg(F.sum("n").alias("n")).collect():
        weights[r["part"]] = r["n"]
    # Prefixes of two and three words lie anywhere.
    weights += -(-(words.where(F.col("n") > budget).agg(F.sum("n")).first()[0] or 0) // RANGES)
    groups = sc.broadcast(Groups(weights, budget, hot_words, mixed(mixed(pairs[:, 0]) + pairs[:, 1])))
    bits = sc.broadcast(_frequent_bits(words))

    def send(batches):
        table = bits.value
        mask = np.uint64(8 * len(table) - 1)
        for chunk in _chunks(batches):
            place = chunk.hashes & mask
            frequent = (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0
            del place
            for part in range(PARTS):
                w1, w2, w3, n = chunk.suffixes(frequent, part=part)
                group = groups.value.of(w1, w2, w3)
                for k in range(0, len(n), 1 << 17):
                    some = slice(k, k + (1 << 17))
                    yield pa.RecordBatch.from_arrays([pa.array(group[some]), *(pa.array(w[some].view(np.int64)) for w in (w1, w2, w3)), pa.array(n[some].astype(np.int32))], schema=_SENT)
                del w1, w2, w3, n, group
            del chunk, frequent

    def build(group: pa.Table) -> pa.Table:
        tree = Subtree(*(_unsigned(group[w]) for w in ("w1", "w2", "w3")), group["n"].to_numpy().astype(np.int64))
        leaf = tree.leaves[keep := (tree.leaf_totals >= least) & (tree.w3[tree.leaves] != 0)]
        hot = groups.value.is_hot_pair(tree.w1[tree.nodes], tree.w2[tree.nodes]) & is_in(tree.w1[tree.nodes], groups.value.hot_words)
        node = tree.nodes[stay := (tree.node_totals >= least) | hot]
        # The leaves of a pair over the budget are in several groups.
        part = np.concatenate((np.zeros(len(leaf), bool), hot[stay]))
        w3 = np.concatenate((tree.w3[leaf], np.zeros(len(node), np.uint64)))
        both = np.concatenate((leaf, node))
        found = pa.table([pa.array(tree.w1[both].view(np.int64)), pa.array(tree.w2[both].view(np.int64)), pa.array(w3.view(np.int64)), pa.array(np.concatenate((tree.leaf_totals[keep], tree.node_totals[stay]))), pa.array(part)], schema=_NODES)
        del tree
        trim()
        return found

    sent = _texts(documents).mapInArrow(trimmed(send), "group long, w1 long, w2 long, w3 long, n int")
    nodes = materialise(sent.groupBy("group").applyInArrow(build, "w1 long, w2 long, w3 long, a long, part boolean"), "nodes")
    whole = nodes.where("part").groupBy("w1", "w2", "w3").agg(F.sum("a").alias("a")).where(F.col("a") >= least)
    return nodes.where("NOT part").drop("part").unionByName(whole)


def collocations(documents: DataFrame, least: int = 10, top: int = 2000, covered: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of two and three words of each language.

    Texts of documents (lang, text), A-Z in lower case, are cut at BREAKS into pieces and those
    at spaces and tabs into words. n: words of the language; a: occurrences of the phrase within
    pieces, `least` or more. l and r: those of what stands before and behind the cut with the
    lowest score, a * a / (l * r) in millionths, rounded down; of equal ones, the first. A pair
    within a phrase of three that has `covered` hundredths of its occurrences or more is left
    out. Order: score, a, phrase in bytes. A null lang is `und`; null and empty texts have no
    words; repeated rows count as often as they stand there; other columns are left alone. Words
    are told apart by 64-bit hashes.
    """
    counted, budget = vocabulary(documents, least)
    phrases = materialise(phrase_counts(documents, counted, budget, least), "phrases")
    words = counted.where("word IS NOT NULL").select("w1", "lang", "word", "n")
    first, second = words.select("w1", "lang", F.col("n").alias("l")), words.select(F.col("w1").alias("w2"), F.col("n").alias("r"))
    pairs = materialise(phrases.where("w3 = 0").drop("w3").join(first, "w1").join(second, "w2"), "pairs")
    triples = phrases.where("w3 <> 0")
    head = pairs.select("w1", "w2", "lang", F.col("l").alias("f1"), F.col("a").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("f23"), F.col("r").alias("f3"))
    cut = lambda l, r: F.struct(_score("a", l, r).alias("score"), F.col(l).alias("l"), F.col(r).alias("r"))  # noqa: E731, E741
    both = triples.join(head, ["w1", "w2"]).join(tail, ["w2", "w3"]).withColumns({"one": cut("f1", "f23"), "two": cut("f12", "f3")})
    lowest = F.when(F.col("one.score") <= F.col("two.score"), F.col("one")).otherwise(F.col("two"))
    three = both.select("lang", "w1", "w2", "w3", "a", lowest.alias("cut")).select("lang", "w1", "w2", "w3", "a", "cut.l", "cut.r", "cut.score")
    longer = triples.select("w1", "w2", "a").unionByName(triples.select(F.col("w2").alias("w1"), F.col("w3").alias("w2"), "a")).groupBy("w1", "w2").agg(F.max("a").alias("longer"))
    alone = pairs.join(longer, ["w1", "w2"], "left").where(F.coalesce(100 * F.col("longer") < covered * F.col("a"), F.lit(True)))
    two = alone.select("lang", "w1", "w2", F.lit(0).cast("long").alias("w3"), "a", "l", "r", _score("a", "l", "r").alias("score"))
    # Those that may be among the first: ranks of which ties have the same. Only then are words looked up.
    order = [F.desc("score"), F.desc("a")]
    best = two.unionByName(three).withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top).drop("place")
    best = materialise(best, "best")
    for k in ("1", "2", "3"):
        best = best.join(words.select(F.col("w1").alias(f"w{k}"), F.col("word").alias(f"word{k}")), f"w{k}", "left")
    named = best.withColumn("phrase", F.concat_ws(" ", "word1", "word2", "word3"))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")).where(F.col("rank") <= top)
    totals = counted.where("w1 = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _score(a: str, l: str, r: str):  # noqa: E741
    """floor(1000000 * a * a / (l * r)), exactly, up to 10^15 occurrences."""
    whole = lambda x: f"CAST({x} AS DECIMAL(15,0))"
    return F.expr(f"({whole(a)} * {whole(a)} * CAST(1000000 AS DECIMAL(7,0))) div ({whole(l)} * {whole(r)})")
