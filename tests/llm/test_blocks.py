"""Searches within blocks and inverted lists against brute force. Empty sets do not get there."""

import itertools
import random

import numpy as np
import pytest

from tidewire.llm import blocks, common
from tidewire.llm.blocks import _search_block
from tidewire.llm.ngram_join import divide_skip, needed
from tidewire.llm.words import word_hashes


def components(edges, nodes):
    up = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    return up


def some_sets(rng):
    """Sets in a few groups of near copies, some of which chain, and sets of their own."""
    sets = {}
    for _ in range(rng.randrange(1, 5)):
        base = rng.sample(range(2000), rng.randrange(8, 40))
        for _ in range(rng.randrange(1, 12)):
            held = set(rng.sample(base, len(base) - rng.randrange(0, 5))) | set(rng.sample(range(2000), rng.randrange(0, 4)))
            sets[len(sets)] = np.array(sorted(held), np.uint64)
            if rng.random() < 0.5 and len(held) > 7:
                base = sorted(held)
    return sets


def linked(a, b):
    return len(np.intersect1d(a, b)) >= needed(len(a), len(b), 75)


def test_divide_skip_finds_what_links():
    rng = random.Random(8)
    for _ in range(60):
        sets = list(some_sets(rng).values())
        search = divide_skip(75)(sets)
        for query in sets:
            assert sorted(search(query)) == [k for k, s in enumerate(sets) if linked(query, s)]


def test_divide_skip_at_the_edge_of_the_threshold():
    """Sets of one base whose overlaps lie about the least that links, in sizes from far below to far above; also asked by sets that are no members."""
    rng = random.Random(10)
    for _ in range(40):
        base = rng.sample(range(400), rng.randrange(1, 60))
        sets = []
        for _ in range(60):
            kept = rng.sample(base, rng.randrange(-(-6 * len(base) // 10), len(base) + 1))
            own = rng.sample(range(1000, 10**6), rng.randrange(0, len(base) // 2 + 2))
            sets.append(np.array(sorted({*kept, *own}), np.uint64))
        members, search = sets[:40], divide_skip(75)(sets[:40])
        for query in sets:
            assert sorted(search(query)) == [k for k, s in enumerate(members) if linked(query, s)]
    assert divide_skip(75)([])(sets[0]) == [] and divide_skip(75)(sets)(np.zeros(0, np.uint64)) == []


def test_whole_block_keeps_all_components():
    rng = random.Random(9)
    for _ in range(150):
        sets = some_sets(rng)
        keys = list(sets)
        rng.shuffle(keys)
        found = list(_search_block([(keys[0], sets[keys[0]])], [(k, sets[k]) for k in keys[1:]], True, divide_skip(75), {keys[0]}))
        want = [(a, b) for a, b in itertools.combinations(sets, 2) if linked(sets[a], sets[b])]
        assert all(linked(sets[a], sets[b]) for a, b in found)
        assert components(found, sets) == components(want, sets)


def test_dealt_block_emits_a_forest_and_bounds_what_meets(spark, monkeypatch):
    """Two large groups of near copies that share a lead: neither all pairs nor all unreached sets in one task."""
    monkeypatch.setattr(blocks, "CHUNK_ELEMENTS", 1000)
    n, sets = 120, {}
    for k in range(n):  # even keys like the lead, odd ones like each other; the last two link with nothing
        base = np.arange(40) + (0 if k % 2 == 0 else 1000)
        sets[k] = np.append(base if k < n - 2 else base + 5000 * k, 100_000 + k).astype(np.uint64)
    most = spark.sparkContext.accumulator(0, blocks_most())

    def index_of(members):
        most.add(sum(map(len, members)))
        return divide_skip(75)(members)

    table = spark.createDataFrame([(k, len(s), bytearray(s.tobytes())) for k, s in sets.items()], "key long, n long, tokens binary")
    pairs = spark.createDataFrame([(0, k) for k in range(1, n)], "lead long, key long")
    edges = [tuple(r) for r in blocks.link_blocks(pairs, table, index_of).collect()]
    want = [(a, b) for a, b in itertools.combinations(sets, 2) if linked(sets[a], sets[b])]
    assert components(edges, sets) == components(want, sets)
    chunks = 1 + 2 * n * 41 // 1000
    assert len(edges) <= 2 * n * chunks < len(want)
    assert most.value <= 1000


def blocks_most():
    from pyspark.accumulators import AccumulatorParam

    class Most(AccumulatorParam):
        def zero(self, value):
            return value

        def addInPlace(self, a, b):  # noqa: N802
            return max(a, b)

    return Most()


def test_word_hashes_follow_words_wherever_they_stand():
    rng = random.Random(4)
    words = [bytes(rng.choice([1, 28, 65, 97, 133, 200]) for _ in range(rng.choice([1, 2, 5, 9]))) for _ in range(30_000)] + [b"a" * 200_000, b"b"]
    rng.shuffle(words)
    found = None
    for gap in (b" ", b"\n\t ", b"\x0b\x0c\r"):
        hashes = word_hashes(gap + gap.join(words) + gap).tolist()
        assert found is None or hashes == found
        found = hashes
    of_word = dict(zip(words, found, strict=True))
    assert [of_word[w] for w in words] == found and len(set(found)) == len(of_word)
    assert not len(word_hashes(b"")) and not len(word_hashes(b" \n"))


@pytest.mark.parametrize("hot", [1, 4, 1000])
def test_join_copies_whatever_is_hot(spark, monkeypatch, hot):
    """At 1 no key is hot, at 4 the common one is, at 1000 all are."""
    monkeypatch.setattr(common, "HOT", hot)
    rows = [(k, "common") for k in range(40)] + [(k, f"rare {k % 10}") for k in range(40, 60)] + [(k, None) for k in range(60, 90)]
    named = [("common", 40, 7)] + [(f"rare {k}", 2, k) for k in range(10)]
    found = common.join_copies(spark.createDataFrame(rows, "id long, key string"), spark.createDataFrame(named, "key string, copies long, name long"))
    names = {key: name for key, _, name in named}
    assert sorted((r["id"], r["key"], r["name"]) for r in found.collect()) == sorted((k, key, names.get(key)) for k, key in rows)


def test_join_copies_of_nothing(spark):
    named = spark.createDataFrame([], "key string, copies long, name long")
    assert common.join_copies(spark.createDataFrame([], "id long, key string"), named).collect() == []


def test_sets_of_a_list_meet_in_a_block(spark):
    """Also those of a block that lies partly in another: 5 and 9 are both in 1's, 7 is not."""
    from tidewire.llm.ngram_join import _blocks

    planted = [(1, 1, [10, 11]), (5, 1, [10, 20]), (7, 1, [20]), (9, 1, [11, 20])]
    rng = random.Random(3)
    drawn = [(k, 1, rng.sample(range(60), rng.randrange(1, 5))) for k in range(80)]
    for near in (planted, drawn):
        found = _blocks(spark.createDataFrame(near, "key long, n long, tokens array<long>"), 75).collect()
        held = {}
        for lead, key in found:
            held.setdefault(lead, {lead}).add(key)
        meet = {pair for block in held.values() for pair in itertools.combinations(sorted(block), 2)}
        lists = {}
        for key, _, tokens in near:
            for t in tokens:
                lists.setdefault(t, []).append(key)
        assert {pair for keys in lists.values() for pair in itertools.combinations(sorted(keys), 2)} <= meet
