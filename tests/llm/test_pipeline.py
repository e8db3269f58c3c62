"""The pipeline against plain Python, stage by stage, each on what the one before kept.

Mixing is held to its contract: the plain temperature, and whole quotas of each source.
"""

import itertools
import math
import random

import numpy as np
import pytest

import corpus_pipeline
from tidewire.llm import lines

WORDS = {"aa": "abcdef", "bb": "ghijkl"}


def sentence(rng, lang, n):
    return " ".join("".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(3, 8))) for _ in range(n))


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(21)
    docs = []
    for k in range(60):
        lang = ("aa", "bb")[k % 2]
        docs.append([k, "\n".join(sentence(rng, lang, 12) for _ in range(rng.randrange(2, 6))), lang, ("web", "news", "code")[min(2, k // 25)]])
    docs[9][1] += "\n" + docs[3][1].split("\n")[0]  # a repeated line
    docs[12][1] += "\n" + docs[3][1].split("\n")[1][:-1] + "#"  # and one but for a character
    whole = docs[20][1].replace("\n", " ")
    docs[40][1] = whole  # near copies in one line, which line dedup does not see
    docs[41][1] = f"{whole} {sentence(rng, 'aa', 2)}"
    docs[50][1] = docs[31][1]  # all its lines repeat
    item = docs[15][1].split("\n")[1]
    docs += [[100, None, "aa", "web"], [101, "", "aa", "web"], [102, "12 34 !", None, "news"], [103, "abc", None, None]]
    return docs, [("1", item), ("2", "no such words anywhere"), ("3", None)]


def kept_languages(docs):
    """Any language will do: what has a letter stays."""
    return [d for d in docs if d[1] and any(c.isalpha() for c in d[1])]


def deduped(docs):
    at = [(d[0], k, lines.normal(x)) for d in docs for k, x in enumerate(d[1].split("\n")) if lines.normal(x)]
    shingles = [frozenset(x[i : i + 8] for i in range(max(1, len(x) - 7))) for _, _, x in at]
    up = list(range(len(at)))
    for _ in range(3):
        for a, b in itertools.combinations(range(len(at)), 2):
            if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                up[a] = up[b] = min(up[a], up[b])
    gone = {at[k][:2] for k in range(len(at)) if up[k] != k}
    out = []
    for d in docs:
        text = "\n".join(x for k, x in enumerate(d[1].split("\n")) if (d[0], k) not in gone)
        if text.strip():
            out.append([d[0], text, *d[2:]])
    return out


def joined(docs):
    sets = {d[0]: {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for d in docs for w in [d[1].lower().split()]}
    up = {k: k for k in sets}
    for _ in range(3):
        for a, b in itertools.combinations(sets, 2):
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                up[a] = up[b] = min(up[a], up[b])
    return [d for d in docs if up[d[0]] == d[0]]


def clean(docs, items):
    windows = {tuple(w[i : i + 10]) for _, t in items if t for w in [t.split()] for i in range(max(1, len(w) - 9))}
    holds = lambda w: any(tuple(w[i : i + len(x)]) == x for x in windows for i in range(len(w)))
    return [d for d in docs if not holds(d[1].replace("#", " ").split())]


def test_pipeline(spark, tables, tmp_path):
    docs, items = tables
    rows = [(*d[:4], len(d[1]) if d[1] is not None else None) for d in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want, found = docs, spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = found.columns
    plain = [kept_languages, deduped, joined, lambda kept: clean(kept, items)]
    for (name, stage), brute in zip(corpus_pipeline.STAGES, plain, strict=False):
        want, found = brute(want), stage(spark, found, str(tmp_path))
        got = sorted(tuple(r) for r in found.select("doc_id", "text", "lang", "source", "n_chars").collect())
        assert got == sorted((*d[:4], len(d[1])) for d in want), name
        assert found.columns == columns
        assert len(want) < len(docs)
        found = spark.createDataFrame(got, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by_source, read = {}, {}
    for d in want:
        by_source.setdefault(d[3] or "", {})[d[0]] = len(d[1].split())
    for r in mixed:
        assert r.n_tokens == by_source[r.source][r.doc_id]
        read[r.source] = read.get(r.source, 0) + r.n_tokens * r.copies
    total = sum(sum(s.values()) for s in by_source.values())
    weight = {r.source: r.weight for r in mixed}
    for s, w in weight.items():
        assert 0 <= read[s] - math.floor(w * total) < max(by_source[s].values())
    share = np.array([sum(by_source[s].values()) / total for s in weight])
    powers = np.log(np.array(list(weight.values())))
    slope = np.polyfit(np.log(share), powers, 1)[0]
    assert np.allclose(powers - slope * np.log(share), (powers - slope * np.log(share))[0], atol=1e-4) and 0 <= slope <= 1 + 1e-6


def test_language_stage_rejects_what_no_language_explains(spark):
    rng = random.Random(5)
    rows = [(k, sentence(rng, ("aa", "bb")[k % 2], 40), ("aa", "bb")[k % 2]) for k in range(60)]
    rows += [(100 + k, sentence(rng, ("aa", "bb")[k % 2], 40), None) for k in range(10)]  # learned, not labelled
    rows += [(200, "abc", None), (201, sentence(rng, "aa", 1), None)]  # too short to tell
    strange = [" ".join("".join(rng.choice(letters) for _ in range(5)) for _ in range(40)) for letters in ("mnopqr", "αβγδε", "abcdefghijklmnopqrstuvwxyz")]
    rows += [(300 + k, text, None) for k, text in enumerate(strange)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()}
    assert kept == {r[0] for r in rows if r[0] < 300}


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
