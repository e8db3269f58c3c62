"""N-gram Jaccard join by T-occurrence search.

A set of tokens that links with another shares T of its inverted lists with it. Three filters,
each exact, leave few sets to search. Lists of one set link nothing: a set stays only if enough
of its first tokens, in the order of their hashes, have longer lists. Of what is left, lists are
counted again, and only the rarest tokens of a set, so many that one must be shared, give
candidate blocks. In a block, DivideSkip finds the members that reach T: a heap merges the short
lists, and binary search looks candidates up in the long ones. Equal lists are merged or probed
once.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right
from collections.abc import Callable
from itertools import groupby
from math import log2

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.blocks import link_blocks
from tidewire.llm.common import connected_components, join_copies, map_arrow, materialise
from tidewire.llm.words import distinct, grams, mixed, word_hashes

#: Words of a shingle.
SHINGLE = 5
#: Percent of a set's tokens, those of least hash, whose lists are gathered.
FIRST = 40
#: Rows up to which ids are broadcast, at some 60 bytes each; beyond, they are joined by shuffle.
BROADCAST_ROWS = 1 << 19
#: Bytes of text whose tokens one bucket of lists stands for.
BUCKET_BYTES = 1 << 22
#: Tokens that a task gathers before it sends them.
SEND_TOKENS = 1 << 20
#: Weight of a step of a long list's probe, which numpy takes for all candidates at once, against a merge step.
MU = 0.001

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lowered(text: str | None) -> bytes:
    return text.encode("utf-8", "replace").translate(_LOWER) if text else b""


def shingles_of(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of SHINGLE words each; of fewer words, one hash of them all."""
    words = word_hashes(text)
    return distinct(grams(words, min(SHINGLE, len(words)))) if len(words) else words


def unpack(packed: list[bytes]) -> list[np.ndarray]:
    """The sets of compressed texts, a third of their hashes' size, for link_blocks."""
    return [shingles_of(zstandard.decompress(x)) for x in packed]


def needed(a: int, b: int, percent: int) -> int:
    """Least intersection of sets of a and b elements for 100 * intersection >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def set_key(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def n_first(n: int, percent: int) -> int:
    """Tokens of a set of n whose lists are gathered: FIRST percent, and one more at least than may be unshared."""
    return max(n - (100 - FIRST) * n // 100, n - -(-percent * n // 100) + 1)


def n_shared(n, percent: int):
    """How many of those two linking sets share at least, n being the size of either.

    Of their common tokens all but percent - 100 + FIRST percent of the larger set may come later.
    n: a column.
    """
    return F.greatest(F.lit(1), F.ceil((percent - 100 + FIRST) * n / 100)).cast("int")


def divide_skip(percent: int) -> Callable[[list[np.ndarray]], Callable[[np.ndarray], list[int]]]:
    """index_of for link_blocks: DivideSkip over the inverted lists of a block.

    Sets stand in lists by size, so that those of a size that can link are one range. A set
    shares at most the tokens in lists of several sets and in lists of its own, which bounds the
    range from above: in a group of sets just below the threshold it mostly leaves no range at all.
    """

    def index_of(sets: list[np.ndarray]) -> Callable[[np.ndarray], list[int]]:
        by_size = sorted(range(len(sets)), key=lambda k: len(sets[k]))
        sizes = [len(sets[k]) for k in by_size]
        size_of = np.array(sizes, np.int64)
        tokens = np.concatenate([*(sets[k] for k in by_size), np.zeros(0, np.uint64)])
        owner = np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")  # places stay sorted within a list
        tokens, owner = tokens[order], owner[order]
        tokens, starts = np.unique(tokens, return_index=True)
        # Neighbouring shingles mostly have the same list: each list is kept once, and counts as
        # often as a query has shingles with it. Lists are told apart by a 64-bit hash.
        same = np.add.reduceat(mixed(owner.astype(np.uint64) + np.uint64(1)), starts) if len(starts) else tokens
        _, first, list_of = np.unique(same, return_index=True, return_inverse=True)
        low, high = starts[first], np.append(starts, len(owner))[first + 1]

        def cut(ids: np.ndarray, weights: np.ndarray, a: int, b: int) -> tuple[np.ndarray, ...]:
            """(begin, end, weight) of lists, of which places a to b are left."""
            if a == 0 and b == len(sizes):
                return low[ids], high[ids], weights
            begin = np.array([x + bisect_left(owner[x:y], a) for x, y in zip(low[ids], high[ids], strict=True)], np.int64)
            end = np.array([x + bisect_left(owner[x:y], b) for x, y in zip(begin, high[ids], strict=True)], np.int64)
            some = end > begin
            return begin[some], end[some], weights[some]

        def search(query: np.ndarray) -> list[int]:
            n = len(query)
            a, b = bisect_left(sizes, -(-percent * n // 100)), bisect_right(sizes, 100 * n // percent)
            if not n or a == b or not len(tokens):
                return []
            at = np.minimum(np.searchsorted(tokens, query), len(tokens) - 1)
            ids, weights = np.unique(list_of[at[tokens[at] == query]], return_counts=True)
            begin, end, weight = cut(ids, weights, a, b)
            single = end - begin == 1
            several = int(weight[~single].sum())
            # Sets over this size reach the overlap by lists of their own alone, or not at all.
            top = bisect_right(sizes, (100 + percent) * several // percent - n, a, b)
            own, place_of = np.unique(owner[begin[single]], return_inverse=True)
            alone = np.bincount(place_of, weight[single], len(own)).astype(np.int64) + several
            found = [p for p, most in zip(own.tolist(), alone.tolist(), strict=True) if p >= top and most >= (target := needed(n, sizes[p], percent)) and len(np.intersect1d(query, sets[by_size[p]], True)) >= target]
            if top > a:
                found += merged(n, *(cut(ids, weights, a, top) if top < b else (begin, end, weight)), needed(n, sizes[a], percent))
            return [by_size[p] for p in found]

        def merged(n: int, begin: np.ndarray, end: np.ndarray, weights: np.ndarray, least: int) -> list[int]:
            """Places of lists begin to end that reach the overlap, which is `least` or more."""
            if weights.sum() < least:
                return []
            by_length = np.argsort(end - begin, kind="stable")
            begin, end, weights = begin[by_length], end[by_length], weights[by_length]
            most = min(int(least / (MU * log2(int(end[-1] - begin[-1]) + 1) + 1)), least - 1)
            n_short = len(weights) - int(np.searchsorted(np.cumsum(weights[::-1]), most, "right"))
            rest = int(weights[n_short:].sum())
            # A place and its list's weight in one number, so that the heap compares integers.
            lists = list(zip(begin.tolist(), end.tolist(), weights.tolist(), strict=True))
            short = [((owner[x:y] << 32) + w).tolist() for x, y, w in lists[:n_short]]
            held = [(place, count) for place, of_place in groupby(heapq.merge(*short), lambda x: x >> 32) if (count := sum(x & 0xFFFFFFFF for x in of_place)) + rest >= least]
            place, count = np.array(held, np.int64).reshape(-1, 2).T
            target, found = -(-percent * (n + size_of[place]) // (100 + percent)), []
            # Each long list is probed for all candidates that are still open.
            for x, y, weight in lists[n_short:]:
                reached = count >= target
                found += place[reached].tolist()
                still = ~reached & (count + rest >= target)
                place, count, target = place[still], count[still], target[still]
                if not len(place):
                    return found
                count += weight * (owner[np.minimum(x + np.searchsorted(owner[x:y], place), y - 1)] == place)
                rest -= weight
            return found + place[count >= target].tolist()

        return search

    return index_of


_READ = pa.schema([("node", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.int64()), ("posted", pa.bool_()), ("bucket", pa.int64()), ("base", pa.int64()), ("tokens", pa.binary()), ("owners", pa.binary())])
_PAIRS = pa.schema([("node", pa.int64()), ("token", pa.int64())])
_TOKENS = pa.schema([("key", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary())])
#: Bucket of the lists that a task has found to be long by itself.
KNOWN = -1


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _postings(held: list[np.ndarray], numbers: list[int], base: int, n_buckets: int) -> list[tuple]:
    """Rows (bucket, base, tokens, owners) of the first tokens of some sets, whose nodes are base + numbers.

    A token is told by its bucket and 32 bits more. Of one that several of the sets have, the
    bucket gets a row without owner, and the sets are known to have a list of several.
    """
    mixed_up = np.concatenate(held) * np.uint64(0x9E3779B97F4A7C15)
    owner = np.repeat(np.array(numbers, np.uint32), [len(x) for x in held])
    token = (((mixed_up & np.uint64(0xFFFFFFFF)) * np.uint64(n_buckets)) & np.uint64(0xFFFFFFFF00000000)) | (mixed_up >> np.uint64(32))
    order = np.argsort(token)
    token, owner = token[order], owner[order]
    again = token[1:] == token[:-1]
    repeated = np.concatenate((again, [False])) | np.concatenate(([False], again))
    rows = [(KNOWN, base, token[repeated].tobytes(), owner[repeated].tobytes())]
    for mask, owned in ((~repeated, True), (repeated & np.concatenate(([True], ~again)), False)):
        some, own = token[mask], owner[mask]
        bucket = (some >> np.uint64(32)).astype(np.int64)
        ends = np.flatnonzero(np.concatenate((bucket[1:] != bucket[:-1], [True]))[: len(bucket)]) + 1
        start = 0
        for end in ends.tolist():
            rows.append((int(bucket[start]), base, some[start:end].astype(np.uint32).tobytes(), own[start:end].tobytes() if owned else None))
            start = end
    return rows


def _reader(percent: int, n_buckets: int):
    """Of batches (doc_id, text): rows of _READ, one for each document, and postings between them."""

    def read(batches):
        top, number = TaskContext.get().partitionId() << 32, 0
        seen: set[int] = set()
        held, numbers, size = [], [], 0
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tokens = shingles_of(lowered(text.as_py()))
                key = set_key(tokens) if len(tokens) else None
                # Of the copies in a task one has postings.
                posted = doc_id is not None and key is not None and key not in seen
                rows.append((top + number, doc_id, len(tokens), key, posted, None, None, None, None))
                if posted:
                    if len(seen) > 1 << 18:
                        seen.clear()
                    seen.add(key)
                    held.append(tokens[: n_first(len(tokens), percent)])
                    numbers.append(number)
                    size += len(held[-1])
                    if size >= SEND_TOKENS:
                        rows += [(None,) * 5 + row for row in _postings(held, numbers, top, n_buckets)]
                        held, numbers, size = [], [], 0
                number += 1
            yield _batch(rows, _READ)
        if held:
            yield _batch([(None,) * 5 + row for row in _postings(held, numbers, top, n_buckets)], _READ)

    return read


def _known(batches):
    for batch in batches:
        for base, tokens, owners in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            node = np.frombuffer(owners, np.uint32).astype(np.int64) + base
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.frombuffer(tokens, np.int64))], schema=_PAIRS)


def _long_lists(group: pa.Table) -> pa.Table:
    """(node, token) of a bucket for every token in several sets."""
    bases, bucket = group["base"].to_pylist(), group["bucket"][0].as_py()
    tokens = [np.frombuffer(x, np.uint32) for x in group["tokens"].to_pylist()]
    nodes = [np.full(len(t), -1, np.int64) if x is None else np.frombuffer(x, np.uint32).astype(np.int64) + base for x, base, t in zip(group["owners"].to_pylist(), bases, tokens, strict=True)]
    token, node = np.concatenate(tokens), np.concatenate(nodes)
    order = np.argsort(token)
    token, node = token[order], node[order]
    again = token[1:] == token[:-1]
    found = (np.concatenate((again, [False])) | np.concatenate(([False], again))) & (node >= 0)
    return pa.table([pa.array(node[found]), pa.array(token[found].astype(np.int64) | bucket << 32)], schema=_PAIRS)


def _near(read: DataFrame, owners: DataFrame, percent: int) -> DataFrame:
    """(key, n, tokens): sets that may have a partner, and their tokens with lists of several sets."""
    posted = read.where("bucket IS NOT NULL")
    pairs = posted.where(F.col("bucket") != KNOWN).select("bucket", "base", "tokens", "owners").groupBy("bucket").applyInArrow(_long_lists, "node long, token long")
    pairs = pairs.unionByName(map_arrow(posted.where(F.col("bucket") == KNOWN).select("base", "tokens", "owners"), _known, "node long, token long"))
    held = pairs.groupBy("node").agg(F.collect_set("token").alias("tokens")).join(owners.select("node", "key", "n"), "node")
    return held.where(F.size("tokens") >= n_shared(F.col("n"), percent)).select("key", "n", "tokens")


def _blocks(near: DataFrame, percent: int) -> DataFrame:
    """Distinct (lead, key): the sets of each list of rarest tokens, under the least of them."""
    postings = near.select("key", F.explode("tokens").alias("token"))
    length = postings.groupBy("token").agg(F.count("*").alias("length")).where("length > 1")
    ordered = postings.join(length, "token").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("length", "token"))).alias("tokens")).join(near.select("key", "n"), "key")
    left = F.size("tokens") - n_shared(F.col("n"), percent)
    lists = materialise(ordered.where(left >= 0).select("key", F.explode(F.slice("tokens", F.lit(1), left + 1)).alias("x")).select("key", F.col("x.token").alias("token")), "lists")
    heads = lists.groupBy("token").agg(F.min("key").alias("lead"), F.max("key").alias("last")).where("lead < last").select("token", "lead")
    blocks = materialise(lists.join(heads, "token").where("lead <> key").select("lead", "key").distinct(), "pairs")
    # A block whose lead and members are all in one other block needs no comparisons of its own. That
    # one's lead is smaller, so of blocks within blocks the outermost stays. A block that is only
    # partly there stays whole: its members there meet the rest of it nowhere else.
    sizes = materialise(blocks.groupBy("lead").agg(F.count("*").alias("n")), "sizes")
    of_lead = blocks.join(sizes.select(F.col("lead").alias("key")), "key", "left_semi").join(sizes, "lead").groupBy(F.col("key").alias("lead")).agg(F.max_by("lead", F.struct("n", "lead")).alias("top"))
    there = blocks.select(F.col("lead").alias("top"), "key")
    within = blocks.join(of_lead, "lead").join(there, ["top", "key"], "left_semi").groupBy("lead").agg(F.count("*").alias("n"))
    return blocks.join(within.join(sizes, ["lead", "n"], "left_semi"), "lead", "left_anti").select("lead", "key")


def near_duplicates(documents: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of documents (doc_id, text).

    A document's set: its distinct shingles of SHINGLE words, lower-cased A-Z, or all its words
    if fewer. Documents link when 100 * intersection >= percent * union. component_id: smallest
    doc_id reachable by links, itself included. Null and empty texts have an empty set and link
    with nothing. A null doc_id links with nothing and has a null component. Copies, and repeated
    rows, count as one set. Shingles and sets are told apart by 64-bit hashes; other columns are
    left alone.

    The texts are read twice: for the lists, and for the sets of those that meet in a block. A
    token goes to its bucket once from each SEND_TOKENS, so a very common one burdens no bucket.
    percent: above 100 - FIRST.
    """
    known = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n_bytes = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    schema = "node long, doc_id long, n long, key long, posted boolean, bucket long, base long, tokens binary, owners binary"
    read = materialise(map_arrow(known, _reader(percent, 1 + n_bytes // BUCKET_BYTES), schema), "read")
    sets = read.where("node IS NOT NULL").select("node", "doc_id", "n", "key", "posted")
    # Of a set, the smallest document stands for all.
    owners = sets.where("doc_id IS NOT NULL AND key IS NOT NULL").groupBy("key")
    owners = materialise(owners.agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.max("n").alias("n"), F.min(F.when(F.col("posted"), F.col("node"))).alias("node")), "owners")
    blocks = materialise(_blocks(materialise(_near(read, owners, percent), "near"), percent), "blocks")
    wanted = blocks.select("key").union(blocks.select("lead")).distinct()
    wanted = materialise(owners.join(wanted, "key", "left_semi").select("doc_id").distinct(), "wanted")

    def tokens_of(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1):
                text = lowered(text.as_py())
                tokens = shingles_of(text)
                if len(tokens):
                    rows.append((set_key(tokens), len(tokens), zstandard.compress(text)))
            if rows:
                yield _batch(rows, _TOKENS)

    picked = known.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, "doc_id", "left_semi")
    # A set comes twice only where a row does; blocks take no notice of that.
    tokens = materialise(map_arrow(picked, tokens_of, "key long, n long, tokens binary"), "tokens")
    components = connected_components(link_blocks(blocks, tokens, divide_skip(percent), unpack))
    joined = owners.join(components.withColumnRenamed("node", "key"), "key").select("key", "component", "doc_id")
    least = joined.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_key = joined.join(least, "component").select("key", "component_id")
    named = owners.select("key", "copies", F.col("doc_id").alias("owner")).join(of_key, "key", "left").select("key", "copies", F.coalesce("component_id", "owner").alias("component_id"))
    out = join_copies(sets.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("key")).alias("key")), named)
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
