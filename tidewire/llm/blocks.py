"""Links inside candidate blocks, found where a block's sets meet, without a row for each pair.

A block is a lead and the members that share a signature with it. The lead is compared with
every member. What it does not reach searches the whole block in turn, but for the members of
the largest component: they need no comparison among themselves, and all others look for them.
A large block is dealt to chunks. Each is first united by itself, with the lead; then each two
chunks meet in a tile, where what a chunk has united counts as one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import batches_of, map_arrow, materialise, runs

#: Elements of the sets that meet in one group, about; a larger block is dealt to chunks of half as many.
CHUNK_ELEMENTS = 1 << 20

_FOUND = pa.schema([("lead", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _unite(up: list[int], search: Callable[[int], list[int]], first: int | None = None) -> Iterator[tuple[int, int]]:
    """Links (a, b) of places that join whatever search links; up: a place's group, as a root. `first` searches in any case."""

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def ask(k: int) -> Iterator[tuple[int, int]]:
        for j in search(k):
            if root(j) != root(k):
                size[root(k)] += size[root(j)]
                up[root(j)] = root(k)
                yield k, j

    size = [0] * len(up)
    for k in range(len(up)):
        size[root(k)] += 1
    if first is not None:
        yield from ask(first)
    # Of two members in different components one at least is outside the largest: when all those
    # outside have searched, no link between components is left. Which is largest may change.
    largest, ahead, behind = max(range(len(up)), key=lambda k: size[k]), list(range(len(up))), []
    while ahead:
        for k in ahead:
            if root(k) == root(largest):
                behind.append(k)
                continue
            if k != first:
                yield from ask(k)
            if size[root(k)] > size[root(largest)]:
                largest = k
        ahead, behind = [k for k in behind if root(k) != root(largest)], [k for k in behind if root(k) == root(largest)]


def _search_block(queries: list[tuple[int, np.ndarray]], members: list[tuple[int, np.ndarray]], whole: bool, index_of: Callable, apart: set[int]) -> Iterator[tuple[int, int]]:
    """Links (a, b) that unite a block or chunk; of a chunk, each member and what stands for its component.

    The one query is the lead, which stands for its own component; `apart` are keys that are no members.
    """
    (lead, tokens), *_ = queries
    members = [m for m in members if m[0] not in apart]
    keys, index, main = [*(k for k, _ in members), lead], index_of([s for _, s in members]), len(members)
    up = list(range(main + 1))
    for a, b in _unite(up, lambda k: index(tokens if k == main else members[k][1]), main):
        if whole:
            yield keys[a], keys[b]
    if not whole:

        def root(x: int) -> int:
            while up[x] != x:
                x = up[x]
            return x

        roots = [root(k) for k in range(main + 1)]
        for k in range(main):
            yield keys[k], lead if roots[k] == roots[main] else keys[roots[k]]


def _search_tile(sides: list[list[tuple[int, int, np.ndarray]]], index_of: Callable) -> Iterator[tuple[int, int]]:
    """Links (a, b) that unite two chunks, given as members (key, group, tokens); each side is searched by the other."""
    members = [m for side in sides for m in side]
    border, made = len(sides[0]), {}

    def search(k: int) -> list[int]:
        at = int(k < border)
        if at not in made:
            made[at] = index_of([s for _, _, s in sides[at]])
        return [j + at * border for j in made[at](members[k][2])]

    head: dict[int, int] = {}
    up = [head.setdefault(group, k) for k, (_, group, _) in enumerate(members)]
    for a, b in _unite(up, search):
        yield members[a][0], members[b][0]


def _match(rows: DataFrame, index_of: Callable, unpack: Callable) -> DataFrame:
    """(lead, a, b) from rows (lead, chunk, role, whole, key, tokens): role 0 asks, role 1 is asked."""

    def search(batches):
        def found():
            for (lead, _), group in runs(batches, 2, unpack):
                queries = [(k, t) for role, _, k, t in group if role == 0]
                members = list({k: (k, t) for role, _, k, t in group if role == 1}.values())
                for a, b in _search_block(queries, members, group[0][1], index_of, {k for k, _ in queries}):
                    yield lead, a, b

        yield from batches_of(50_000, found(), _FOUND)

    dealt = rows.select("lead", "chunk", "role", "whole", "key", "tokens").repartition("lead", "chunk").sortWithinPartitions("lead", "chunk", "role", "key")
    return map_arrow(dealt, search, "lead long, a long, b long")


def _match_tiles(rows: DataFrame, index_of: Callable, unpack: Callable) -> DataFrame:
    """(lead, a, b) from rows (lead, low, high, chunk, key, group, tokens): the members of two chunks that may still link."""

    def search(batches):
        def found():
            for (lead, low, _), held in runs(batches, 3, unpack):
                sides: list[dict] = [{}, {}]
                for chunk, key, group, tokens in held:
                    if key not in sides[chunk != low]:
                        sides[chunk != low][key] = (key, group, tokens)
                for a, b in _search_tile([list(side.values()) for side in sides], index_of):
                    yield lead, a, b

        yield from batches_of(50_000, found(), _FOUND)

    dealt = rows.select("lead", "low", "high", "chunk", "key", "group", "tokens").repartition("lead", "low", "high").sortWithinPartitions("lead", "low", "high", "chunk", "key")
    return map_arrow(dealt, search, "lead long, a long, b long")


def packed_hashes(packed: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(tokens, np.uint64) for tokens in packed]


def link_blocks(blocks: DataFrame, sets: DataFrame, index_of: Callable[[list[np.ndarray]], Callable[[np.ndarray], list[int]]], unpack: Callable[[list[bytes]], list[np.ndarray]] = packed_hashes) -> DataFrame:
    """Edges (a, b) that join, within each block, whatever links of its sets join.

    blocks: distinct (lead, key), a lead with each of its members, lead <> key. sets: (key, n,
    tokens) for every key and lead: n elements, which unpack makes of the bytes in tokens, many
    rows at once, as sorted unsigned longs. index_of makes of a list of sets a function that gives the places of those linked with a set.

    A block of more than CHUNK_ELEMENTS elements is dealt to chunks; its lead goes to each of
    them. Then each two chunks meet, but for what the lead has reached in both.
    """
    sized = blocks.join(sets.select("key", "n"), "key")
    chunks = F.when(F.sum("n") < CHUNK_ELEMENTS, 1).otherwise(1 + F.floor(2 * F.sum("n") / CHUNK_ELEMENTS))
    totals = sized.groupBy("lead").agg(chunks.cast("long").alias("chunks"))
    totals = materialise(totals, "chunks")
    placed = materialise(blocks.join(totals, "lead").select("lead", "key", "chunks", F.pmod(F.xxhash64("key"), F.col("chunks")).alias("chunk")), "placed")
    whole = F.col("chunks") == 1
    members = placed.select("lead", "chunk", F.lit(1).alias("role"), whole.alias("whole"), "key")
    leads = totals.select("lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("role"), whole.alias("whole"), F.col("lead").alias("key"))
    found = materialise(_match(members.unionByName(leads).join(sets.select("key", "tokens"), "key"), index_of, unpack), "found")
    links = found.where("a <> b").select("a", "b")
    # Of dealt blocks there is a row (key, group) for each member, whose group is the lead if it is reached.
    dealt = totals.where("chunks > 1")
    if dealt.isEmpty():
        return links
    grouped = found.join(dealt, "lead").select("lead", F.col("a").alias("key"), F.col("b").alias("group"), "chunks", F.pmod(F.xxhash64("a"), F.col("chunks")).alias("chunk"))
    # Chunks with members that the lead has not reached; without any, the block is one component.
    open_chunks = grouped.where(F.col("group") != F.col("lead")).groupBy("lead").agg(F.collect_set("chunk").alias("open"))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda x: (x != F.col("chunk")) & ((F.col("group") != F.col("lead")) | F.array_contains("open", x)))
    meeting = grouped.join(materialise(open_chunks, "open"), "lead").select("lead", "chunk", "key", "group", F.explode(others).alias("other"))
    meeting = meeting.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    more = _match_tiles(meeting.join(sets.select("key", "tokens"), "key"), index_of, unpack)
    return links.unionByName(more.select("a", "b"))
