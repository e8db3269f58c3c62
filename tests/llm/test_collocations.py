"""Phrase collocations against a count of all phrases in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidewire.llm import collocations as C

DOCS = "doc_id long, text string, lang string, w1 int, n string"


def brute(docs, least, top):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = []
        covered = Counter()
        for p, a in f.items():
            if len(p) == 3 and a >= least:
                for q in (p[:2], p[1:]):
                    covered[q] = max(covered[q], a)
        for p, a in f.items():
            if len(p) > 1 and a >= least and not (len(p) == 2 and 100 * covered[p] >= 50 * a and covered[p]):
                score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, k + 1, p.decode(), -a, l, r, totals[lang], -s) for k, (s, a, p, l, r) in enumerate(sorted(found)[:top])]  # noqa: E741
    return sorted(out)


def random_docs(seed, n=150):
    rng = random.Random(seed)
    words = ["the", "The", "new", "york", "City", "a\x00b", "né", " ", "İx", "zz", "of", "q"] + [f"w{k}" for k in range(40)]
    for k in range(n):
        text = ""
        for _ in range(rng.randrange(60)):
            text += rng.choice(["new york city", "the the the", rng.choice(words), rng.choice(words[:6])]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"])
        yield k, text if k % 17 else rng.choice([None, "", " .,"]), rng.choice(["en", "de", None, "und"]), k, "x"


@pytest.mark.parametrize(("budget", "top"), [(1 << 20, 2000), (400, 2000), (60, 15)])
def test_random_documents(spark, monkeypatch, budget, top):
    """With small budgets words, and pairs, go over them and are extended."""
    monkeypatch.setattr(C, "BUDGET", budget)
    docs = list(random_docs(5))
    docs += docs[:9]
    found = C.collocations(spark.createDataFrame(docs, DOCS).repartition(3), least=4, top=top)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == brute(docs, 4, top)


def test_groups_keep_to_the_budget():
    rng = np.random.default_rng(1)
    weights = rng.integers(0, 300, C.RANGES) * (rng.random(C.RANGES) < 0.1)
    weights[5000] = 100_000
    none = np.zeros(0, np.uint64)
    groups = C.Groups(weights, 1000, none, none)
    total: dict = {}
    prefix = rng.integers(0, 1 << 64, 200_000, dtype=np.uint64)
    prefix[:50_000] = (np.uint64(5000) << np.uint64(48)) | (prefix[:50_000] >> np.uint64(16))
    of = groups.of(prefix, prefix, prefix)
    for k in range(C.RANGES):
        if groups.parts[k] == 1:
            total[int(groups.base[k])] = total.get(int(groups.base[k]), 0) + int(weights[k])
    assert max(total.values()) <= 1000
    assert len(set(of[:50_000].tolist())) == groups.parts[5000] == 200 and not set(of[:50_000].tolist()) & set(total)


def test_exact_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**12, 10**12 + 1, 10**12)], "a long, l long, r long")
    assert df.select(C._score("a", "l", "r")).first()[0] == 10**6 * 10**24 // ((10**12 + 1) * 10**12)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], DOCS)).collect() == []
    assert C.collocations(spark.createDataFrame([(1, None, None, 1, "")], DOCS)).collect() == []


def test_a_chunk_of_words_is_counted_in_parts():
    """The parts of a chunk are its suffixes, and none but one part of them is sorted at once."""
    import random

    import numpy as np

    from tidewire.llm import collocations
    from tidewire.llm.words import word_places

    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghijklm") + rng.choice(["", "", "."]) for _ in range(300)).encode().translate(collocations.LETTERS) for _ in range(3)]
    chunk = collocations.Chunk(["x", "y", "x"], texts, [word_places(t) for t in texts])
    everything = np.ones(len(chunk.hashes), bool)
    rows = lambda part: list(zip(*(x.tolist() for x in chunk.suffixes(everything, part=part)), strict=True))
    parts = [rows(k) for k in range(collocations.PARTS)]
    assert sorted(sum(parts, [])) == sorted(rows(None))
    assert max(map(len, parts)) < len(rows(None))


def test_a_task_trims_when_it_ends(monkeypatch):
    from tidewire.llm import common

    calls = []
    monkeypatch.setattr(common, "trim", lambda: calls.append(1))
    run = common.trimmed(lambda batches: iter(batches))([1, 2])
    assert next(run) == 1 and not calls
    assert list(run) == [2] and calls == [1]
