"""Packing: every token in one place, every sequence full, ids as the tokenizer gives them."""

import random

import numpy as np
import pytest

from tidewire.llm import packing

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("seed", range(6))
def test_plan_fills_every_sequence(seed):
    rng = np.random.default_rng(seed)
    length = (4096, 64, 100, 64, 64, 64)[seed]
    counts = rng.integers(0, 40, length + 1) * (rng.random(length + 1) < (1, 0.1, 1, 0.02, 1, 0.3)[seed])
    counts[0] = 0
    counts[3] += 5000 * (seed == 4)
    plan = packing.Plan(counts, length)
    filled: dict[int, list] = {}
    for size in np.flatnonzero(counts):
        ranks = np.arange(counts[size])
        done = np.zeros(len(ranks), np.int64)
        while len(ranks):
            step = plan.find(np.full(len(ranks), size), ranks, done)
            for s, o, t in zip(plan.first[step] + ranks - plan.lo[step], plan.offset[step], plan.take[step], strict=True):
                filled.setdefault(int(s), []).append((int(o), int(t)))
            done = done + plan.take[step]
            assert (done <= size).all()
            ranks, done = ranks[done < size], done[done < size]
    totals = []
    for pieces in filled.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        totals.append(at)
    total = int((np.arange(length + 1) * counts).sum())
    assert sorted(filled) == list(range(plan.sequences)) and sum(totals) == total
    assert sorted(t for t in totals if t != length) == [1 << k for k in range(16) if total % length >> k & 1]


def test_words_have_the_ids_of_the_text():
    from tokenizers import Tokenizer

    whole, encoder = Tokenizer.from_file(PATH), packing.Encoder(PATH, True)
    rng = random.Random(1)
    parts = ["a", "B", "é", "é", "́", " ", "\t", "\n", "\x0b", "\x1c", "\x85", " ", " ", "‍", "'s", "'LL", "1", "²", "<|endoftext|>", "<|ENDOFTEXT|>", "Σ", "İ", "字", "\U0001f600", "-", "\x00", "'", "ﬁ", "I", "\u0307", ".", ",", "?", "(", "×", "³", "Ł", "ab"]
    for _ in range(60):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(50)]
        for text, ids in zip(texts, encoder(texts), strict=True):
            assert np.frombuffer(ids, "<u2").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_words_of_one_hash_are_told_apart(monkeypatch):
    from tokenizers import Tokenizer

    places = packing.word_places
    monkeypatch.setattr(packing, "word_places", lambda text: (places(text)[0] % np.uint64(7), *places(text)[1:]))
    texts = ["one two three four five six seven", "", "nine two ten eleven", " twelve one. ONE!"]
    whole = Tokenizer.from_file(PATH)
    assert [np.frombuffer(x, "<u2").tolist() for x in packing.Encoder(PATH, True)(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize(("file", "by_word", "small"), [("word_bpe_49k.json", True, True), ("byte_bpe_50k.json", False, False)])
def test_round_trip(spark, monkeypatch, file, by_word, small):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "BROADCAST_ROWS", packing.BROADCAST_ROWS if small else 0)
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(["the", "of", "Sand", "x1", "né", "."]) for _ in range(int(rng.expovariate(1 / 40)))), 0, "t") for k in range(300)]
    rows += [(500, "long " * 3000, 0, "t"), (501, None, 1, None), (None, "no id", 1, None), (None, "no id", 1, None), (502, "", 1, ""), (7, "seven again", 1, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int, task string").repartition(5)
    pieces = packing.pack(df, P.path(file), length=128, by_word=by_word)
    found = sorted((r.doc_id is None, r.doc_id or 0, r.sequence_id, r.offset, r) for r in pieces.collect())
    whole = Tokenizer.from_file(P.path(file))
    wanted = [(i, [*whole.encode(t or "", add_special_tokens=False).ids, 2]) for i, t, _, _ in rows]
    assert sum(r.length for *_, r in found) == sum(len(x) for _, x in wanted)
    by: dict = {}
    for *_, r in found:
        assert len(r.ids) == 4 * r.length
        by.setdefault(r.doc_id, []).append((r.start, np.frombuffer(bytes(r.ids), "<u4").tolist(), r.doc_tokens))
    for i in {i for i, _ in wanted if i not in (None, 7)}:
        ids = next(x for k, x in wanted if k == i)
        assert [t for _, x, _ in sorted(by[i]) for t in x] == ids and {n for *_, n in by[i]} == {len(ids)}
    full = packing.sequences(pieces).collect()
    sizes = [len(r.ids) // 4 for r in full]
    assert sorted(r.sequence_id for r in full) == list(range(len(full))) and all(sum(r.lengths) == n for r, n in zip(full, sizes, strict=True))
    assert [n for n in sizes if n < 128] == list(dict.fromkeys(n for n in sizes if n < 128)) and all(n & (n - 1) == 0 for n in sizes)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
