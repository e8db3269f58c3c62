"""Corpus operators against brute force, on small tables with nulls, ties, repeats and clashing columns."""

import hashlib
import itertools
import math
import random
import zlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewire.llm import blocks, common, decontaminate, embeddings, language_id, lines, mixing, ngram_join, secrets, substrings, toxicity, url_filter
from tidewire.llm.common import connected_components

DOC = "doc_id long, text string, lang string, source string, n_words int, gone int"


def docs_of(spark, texts):
    return spark.createDataFrame([(k, t, "en", f"s{(k or 0) % 3}", 7, 1) for k, t in texts], DOC)


def corpus(seed=3, n=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(0, 80))] for _ in range(n // 2)]
    out = []
    for k in range(n):
        words = list(base[k % len(base)])
        if k >= len(base) and words and k % 3:
            words[rng.randrange(len(words))] = "changed"
        out.append((k, " ".join(words)))
    return [*out, (500, None), (501, ""), (502, "A."), (None, out[0][1]), (3, out[3][1])]


def components(edges, nodes):
    up = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    return up


def test_connected_components(spark):
    chain = [(k, k + 1) for k in range(0, 40) if k % 10] + [(5, 5), (None, 1)]
    found = dict(connected_components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {k: v for k, v in components([e for e in chain if None not in e], range(41)).items() if k in found}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_embeddings(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 16))
    x[30:50] = x[:20] + rng.normal(size=(20, 16)) * 0.22
    x[50:55] = x[0]
    rows = [(k, v.tolist(), "z") for k, v in enumerate(x)] + [(100, None, "z"), (101, [0.0] * 16, "z"), (102, [math.nan] * 16, "z"), (103, [1.0] * 3, "z"), (None, x[0].tolist(), "z")]
    found = {r.vec_id: r for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string")).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    pairs = [(a, b) for a, b in itertools.permutations(range(60), 2) if unit[a] @ unit[b] >= 0.95]
    up = components(pairs, range(60))
    assert [(found[k].n_links, found[k].component_id) for k in range(60)] == [(sum(a == k for a, _ in pairs), up[k]) for k in range(60)]
    assert all(found[k].n_links == 0 and found[k].kept for k in (100, 101, 102, 103)) and not found[None].kept


def test_embeddings_of_any_length(spark):
    """Vectors whose squares leave the range of doubles, and tiles that meet."""
    rows = [(1, [1e200, 1e200]), (2, [1e200, 1.01e200]), (3, [1e-200, 1e-200]), (4, [5e-324, 0.0]), (5, [1.0, 0.0]), (6, [0.0, -1e308])]
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert found == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_embedding_tiles(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", 20)
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(60, 8)), np.repeat(rng.normal(size=(1, 8)), 30, axis=0) + rng.normal(size=(30, 8)) * 0.2])
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    pairs = [(a, b) for a, b in itertools.permutations(range(len(x)), 2) if unit[a] @ unit[b] >= 0.95]
    up = components(pairs, range(len(x)))
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(table).collect()}
    assert found == {k: (sum(a == k for a, _ in pairs), up[k]) for k in range(len(x))} and len(pairs) > 100


def test_quantisation_bound():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    q, s, e = embeddings.quantise(x)
    about = (q.astype(float) * s[:, None]) @ (q.astype(float) * s[:, None]).T
    assert (np.abs(about - x @ x.T) <= e[:, None] + e + e[:, None] * e).all()


def test_ngram_join(spark):
    texts = corpus()
    sets = {k: frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else frozenset() for k, t in texts if k is not None}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    up = components(pairs, sets)
    found = ngram_join.near_duplicates(docs_of(spark, texts)).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_shingles, r.component_id) == ((len(sets[r.doc_id]), up[r.doc_id]) if r.doc_id is not None else (len(sets[0]), None))


def test_dealt_blocks(spark, monkeypatch):
    """A block in many chunks links what a whole one links."""
    monkeypatch.setattr(blocks, "CHUNK_ELEMENTS", 40)
    rng = np.random.default_rng(5)
    base = np.sort(rng.choice(10_000, 40, replace=False)).astype(np.uint64)
    sets = {k: np.sort(np.concatenate([base[k % 7 :], np.arange(k % 7) + np.uint64(20_000 + 10 * k)])).astype(np.uint64) for k in range(24)}
    table = spark.createDataFrame([(k, len(s), bytearray(s.tobytes())) for k, s in sets.items()], "key long, n long, tokens binary")
    pairs = spark.createDataFrame([(0, k) for k in range(1, 24)], "lead long, key long")
    edges = [tuple(r) for r in blocks.link_blocks(pairs, table, ngram_join.divide_skip(75)).collect()]
    want = [(a, b) for a, b in itertools.combinations(sets, 2) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))]
    assert components(edges, sets) == components(want, sets)


def test_substrings(spark):
    texts = corpus(4)
    first = {}
    for k, t in texts:
        for i in range(len(w := (t or "").split()) - 12) if k is not None else ():
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, k), k)
    found = substrings.remove_repeats(docs_of(spark, texts)).collect()
    assert len(found) == len(texts)
    for r in found:
        w = (next(t for k, t in texts if k == r.doc_id) or "").split()
        gone = {i + j for i in range(len(w) - 12) if r.doc_id is not None and first[tuple(w[i : i + 13])] < r.doc_id for j in range(13)}
        assert (r.n_words, r.n_removed, r.kept) == (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))


def test_substrings_of_few_words_spread(spark, monkeypatch):
    """Where every word is frequent, no bucket gets more than its share, and equal windows still meet."""
    rng = random.Random(12)
    texts = [(k, " ".join(rng.choice(["get", "put", "ok", "fail", "0", "1"]) for _ in range(60))) for k in range(120)]
    texts += [(200 + k, texts[k][1][20:] + " end") for k in range(40)]
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 1600)
    monkeypatch.setattr(substrings, "CHUNK_WORDS", 500)
    first = {}
    for k, t in texts:
        for i in range(len(w := t.split()) - 12):
            first.setdefault(tuple(w[i : i + 13]), k)
    for r in substrings.remove_repeats(docs_of(spark, texts)).collect():
        w = dict(texts)[r.doc_id].split()
        gone = {i + j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < r.doc_id for j in range(13)}
        assert (r.n_removed, r.kept) == (len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    table = {}
    for r in substrings._sent(docs_of(spark, texts), 13).where("packed IS NOT NULL").collect():
        table[r.bucket] = table.get(r.bucket, 0) + int(np.frombuffer(r.sizes, np.int32).sum())
    assert len(table) >= 15 and max(table.values()) < 5 * sum(table.values()) / len(table)


def test_windows_of_one_hash_are_told_apart(spark, monkeypatch):
    """Where all windows have one hash, their words are sorted."""
    monkeypatch.setattr(substrings, "grams", lambda hashes, n: np.zeros(max(0, len(hashes) - n + 1), np.uint64))
    texts = [(1, "a b c d e f"), (2, "x a b c d y"), (3, "p q r s t u")]
    chunk = lambda k: substrings.Chunk([k], [dict(texts)[k].encode()], [substrings.word_places(dict(texts)[k].encode())], 4, np.zeros(0, np.uint64))
    sent = [substrings._send(chunk(k), 1, substrings.zstandard.ZstdCompressor()) for k, _ in texts]
    assert substrings._resolve(substrings.pa.Table.from_batches(sent), 4).to_pylist() == [{"doc_id": 2, "start": 1, "end": 5}]


def test_decontamination(spark, monkeypatch):
    texts = corpus(6)
    words = texts[10][1].split()
    items = [("1", " ".join(words[:14])), ("2", "A."), ("3", None), ("4", ""), ("10", " ".join(words[2:12]))]
    table = spark.createDataFrame(items, "item_id string, text string")

    def digest(found):
        return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, sum(s.end - s.start for s in r.spans), tuple(r["items"])) for r in found.collect())

    want = []
    for k, t in texts:
        w, hit, got = [x.decode() for x in decontaminate.words_of(t)], set(), set()
        for item, text in items:
            v = [x.decode() for x in decontaminate.words_of(text)]
            for i in range(max(1, len(v) - 9) if v else 0):
                win = v[i : i + 10]
                for j in range(len(w) - len(win) + 1):
                    if w[j : j + len(win)] == win:
                        hit |= set(range(j, j + len(win)))
                        got.add(item)
        want.append((k if k is not None else -1, len(w), len(hit), tuple(sorted(got))))
    assert digest(decontaminate.decontaminate(docs_of(spark, texts), table)) == sorted(want)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)  # several blocks of items
    monkeypatch.setattr(decontaminate, "ANCHORS", 3)
    assert digest(decontaminate.decontaminate(docs_of(spark, texts), table)) == sorted(want)


def test_near_items(spark, monkeypatch):
    """Windows whose words lie close to their rarest one, in any order, against brute force over one shard."""
    monkeypatch.setattr(decontaminate, "ANCHORS", 5)
    rng = random.Random(15)
    texts = [(k, " ".join(rng.choice("abcdefgh") * 2 for _ in range(rng.randrange(0, 40)))) for k in range(30)]
    items = [(str(k), " ".join(rng.choice("abcdefghi") * 2 for _ in range(n))) for k, n in enumerate([2, 3, 4, 5, 6, 12])]
    words = {k: t.split() for k, t in texts}
    sizes = {}
    for w in itertools.chain.from_iterable(words.values()):
        sizes[w] = sizes.get(w, 0) + 1
    want = {k: set() for k in words}
    for k, w in words.items():
        for item, text in items:
            v = text.split()
            for win in (v[i : i + 10] for i in range(max(1, len(v) - 9))):
                rarest, reach = min(win, key=lambda x: sizes.get(x, 0)), len(win) + 4
                if any(x == rarest and set(win) <= set(w[max(0, p - reach) : p + reach + 1]) for p, x in enumerate(w)):
                    want[k].add(item)
    found = decontaminate.decontaminate(docs_of(spark, texts).coalesce(1), spark.createDataFrame(items, "item_id string, text string"), slop=4).collect()
    assert {r.doc_id: set(r["near_items"]) for r in found} == want and any(want.values())


def test_one_search_writes_no_shards(spark, monkeypatch):
    """Shards are searched where they are built; items of several blocks search a written index, with the same matches."""
    texts = [(k, t) for k, t in corpus(8, 80) if k is not None] + [(900, None), (901, "")]
    items = spark.createDataFrame([("a", " ".join(texts[3][1].split()[:30])), ("b", texts[7][1]), ("c", None)], "item_id string, text string")
    written, write = [], common.materialise
    monkeypatch.setattr(decontaminate, "materialise", lambda df, what, **options: written.append(what) or write(df, what, **options))
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 200)

    def rows():
        return sorted((r.doc_id, r.n_words, [tuple(x) for x in r.spans], sorted(r["items"])) for r in decontaminate.decontaminate(docs_of(spark, texts), items).collect())

    found = rows()
    assert written == [] and len(found) == len(texts) and any(spans for _, _, spans, _ in found)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40)
    assert rows() == found and "postings" in written


def test_batches_are_bounded_by_bytes(spark, monkeypatch):
    """Long texts reach a worker a few at a time, short ones many; a session's own limit holds."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    def most(chars):
        rows = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), chars).alias("text"))
        return [r.n for r in common.map_arrow(rows, sizes, "n long").collect()]

    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        long, short = most(20_000), most(10)
        assert sum(long) == sum(short) == 3000 and max(long) * 20_000 < 2 * common.BATCH_BYTES and max(short) == 3000
        spark.conf.set(name, "1m")
        assert max(most(20_000)) < 100 and spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_tasks_keep_what_they_ask_for_alone():
    """What a worker keeps for tasks of its kind stays from one to the next, and goes with the first task that has no use for it."""
    made = []

    def asks(batches):
        for batch in batches:
            yield common.kept("a", lambda: made.append(1) or "made"), batch

    common._kept.clear()
    for _ in range(2):
        assert list(common.trimmed(asks)([1, 2])) == [("made", 1), ("made", 2)] and list(common._kept) == ["a"]
    assert made == [1]
    language_id.automata([("en", b"the cat")])
    assert list(common._kept) == [(("en", b"the cat"),)]
    assert list(common.trimmed(iter)([3])) == [3] and not common._kept


def test_few_rows_are_read_at_once(spark, tmp_path):
    """Parquet's reader holds READ_ROWS rows in a task from the first map_arrow on; a session's own number holds."""
    name = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(name, None)
    try:
        for own, want in ((None, str(common.READ_ROWS)), ("64", "64")):
            spark.conf.unset(name) if own is None else spark.conf.set(name, own)
            assert [r.id for r in common.map_arrow(spark.range(3), lambda batches: batches, "id long").orderBy("id").collect()] == [0, 1, 2]
            assert spark.conf.get(name) == want
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_a_lead_asks_once():
    """A lead that reaches nothing is not asked again, and of a block's other members all but one are."""
    asked = []

    def index_of(sets):
        return lambda query: asked.append(int(query[0])) or []

    sets = [np.array([k], np.uint64) for k in range(3)]
    assert list(blocks._search_block([(0, sets[0])], [(k, sets[k]) for k in (1, 2)], True, index_of, {0})) == []
    assert sorted(asked) == [0, 2]


def test_jaccard_of_fitting_sizes():
    """Sets of a size that can link are searched, whatever their order: the same places as by plain sets, at the bounds too."""
    rng = random.Random(5)
    base = [rng.randrange(1 << 60) for _ in range(60)]
    sets = [np.array(sorted(set(base[: rng.randrange(1, 60)]) | {rng.randrange(1 << 60) for _ in range(rng.randrange(6))}), np.uint64) for _ in range(300)]
    sets += [np.array(sorted(base[:n]), np.uint64) for n in (40, 50, 32, 39, 49, 51)]
    search = lines.jaccard(0.8)(sets)
    plain = [set(s.tolist()) for s in sets]
    some = 0
    for k, query in enumerate(sets):
        want = [j for j, other in enumerate(plain) if 5 * len(plain[k] & other) >= 4 * len(plain[k] | other)]
        assert sorted(search(query)) == want
        some += len(want) > 1
    assert some and lines.jaccard(0.8)([])(sets[0]) == []


def test_filled_slots_bound_distinct_shingles():
    rng = np.random.default_rng(3)
    sizes = np.array([1, 128, 160, 161, 400, 5000])
    x = np.concatenate([rng.integers(0, 1 << 64, n, dtype=np.uint64) if n < 400 else np.repeat(rng.integers(0, 1 << 64, n // 4, dtype=np.uint64), 4) for n in sizes.tolist()])
    slots, n = lines._n_slots(x, sizes), lines._n_distinct(x, sizes)
    assert (slots <= n).all() and (slots > 0).all() and slots[5] > lines.LONG


def test_a_text_is_split_once(spark):
    """Splitting makes a row of each line; the last step does so for texts that lose lines, once, and only counts line ends of others."""
    docs = docs_of(spark, [(1, "a line\nanother line\n\n"), (2, "x\na line"), (3, None), (4, ""), (5, "\n")])
    out = lines.dedup_lines(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in out.collect()} == {1: (4, 0, "a line\nanother line\n\n"), 2: (2, 1, "x"), 3: (0, 0, None), 4: (1, 0, ""), 5: (2, 0, "\n")}


def test_shingle_sets_of_many_lines():
    """Lines hashed together have the sets that each has alone: short, empty, equal, non-ASCII and very long ones."""
    rng = random.Random(4)
    texts = ["", "a", "abcdefg", "abcdefgh", "abcdefgh", "aaaaaaaaaaaaaaaa", "ärger über öl", "x" * 40_000, "\U0001f600" * 9]
    texts += ["".join(rng.choices("abc ", k=rng.randrange(1, 300))) for _ in range(400)]
    packed = [t.encode() for t in texts]
    many = lines.shingle_sets(packed)
    assert len(many) == len(packed) and all(np.array_equal(lines.shingle_set(p), m) for p, m in zip(packed, many, strict=True))
    assert lines.shingle_sets([]) == []


def test_runs_unpacks_many_rows_at_once():
    """A run spans slices and batches; the last column is unpacked for many rows in one call."""
    sizes = []

    def unpack(values):
        sizes.append(len(values))
        return [v + 1 for v in values]

    batches = [pa.RecordBatch.from_arrays([pa.array([0] * n), pa.array(range(n))], names=["k", "v"]) for n in (common.SLICE_ROWS + 5, 3)]
    assert list(common.runs(batches, 1, unpack)) == [((0,), [(v + 1,) for n in (common.SLICE_ROWS + 5, 3) for v in range(n)])]
    assert sizes == [common.SLICE_ROWS, 5, 3]


def test_lines(spark):
    line = "the quick brown fox jumps over the lazy dog while seventeen other animals keep watching it quietly from afar"
    texts = [(1, f"{line}\nanother line of words that is different\n\nX"), (2, f"fresh\n{line}!"), (3, f"{line.upper()}\n\nx"), (4, None), (5, ""), (None, line)]
    found = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in lines.dedup_lines(docs_of(spark, texts)).collect()}
    assert found == {1: (4, 0, texts[0][1]), 2: (2, 1, "fresh"), 3: (3, 2, ""), 4: (0, 0, None), 5: (1, 0, ""), None: (1, 0, line)}
    kept = lines.without_repeated_lines(docs_of(spark, texts))
    assert kept.columns == docs_of(spark, []).columns and kept.count() == len(texts)


def meet(a, b):
    """Whether two lines share a band."""
    bands, sizes = lines.band_hashes([lines.normal(a), lines.normal(b)])
    return bool(set(bands[: sizes[0]].tolist()) & set(bands[sizes[0] :].tolist()))


def test_line_recall_near_the_threshold():
    """Lines of similarity 0.80 to 0.83 share a band in at least 99 of 100 cases, whatever their length."""
    rng, met, n = random.Random(17), 0, 0
    while n < 1000:
        size = rng.choice([90, 140, 165, 200, 400, 1000])
        a = "".join(rng.choice("abcdefghijklmnop ") for _ in range(size))
        b = list(a)
        for at in rng.sample(range(size), max(1, round(size * 0.0133))):
            b[at] = "#"
        x, y = (lines.shingle_set(lines.normal(t).encode()) for t in (a, "".join(b)))
        if 0.80 <= len(np.intersect1d(x, y)) / len(np.union1d(x, y)) <= 0.83:
            met, n = met + meet(a, "".join(b)), n + 1
    assert met >= 990


def test_shingles_of_many_lines_are_those_of_each():
    rng = random.Random(6)
    some = [lines.normal("".join(rng.choice("abc é\U0001f600") for _ in range(rng.choice([1, 3, 7, 8, 9, 30, 200])))) or "x" for _ in range(300)]
    hashes, sizes = lines.shingle_hashes(some)
    ends = np.cumsum(sizes)
    for line, at, end in zip(some, ends - sizes, ends, strict=True):
        shingles = [line[i : i + 8] for i in range(max(1, len(line) - 7))]
        assert len(shingles) == end - at and len({*zip(shingles, hashes[at:end].tolist(), strict=True)}) == len(set(shingles))
        assert hashes[at:end].tolist() == lines.shingle_hashes([line])[0].tolist()
    n = lines._n_distinct(hashes, sizes)
    assert n.tolist() == [len({line[i : i + 8] for i in range(max(1, len(line) - 7))}) for line in some]


@pytest.mark.parametrize("size", [150, 400])
def test_line_bands_meet(size):
    rng, met = random.Random(size), 0
    for _ in range(100):
        a = "".join(rng.choice("abcdefghij ") for _ in range(size))
        b = a[: size // 2] + "#" + a[size // 2 + 1 :]
        met += meet(a, b)
    assert met >= 98


@pytest.mark.parametrize("unit", ["|---", "=", "all rights reserved by the owner. "])
def test_repetitive_lines_meet_at_any_length(spark, unit):
    short, long = ((unit * 400)[:n] for n in (100, 400))
    a, b = (lines.shingle_set(lines.normal(x).encode()) for x in (short, long))
    assert len(np.intersect1d(a, b)) >= 0.8 * len(np.union1d(a, b))
    assert meet(short, long)
    found = {r.doc_id: r.n_removed for r in lines.dedup_lines(docs_of(spark, [(1, short), (2, long), (3, (unit * 400)[:200])])).collect()}
    assert found == {1: 0, 2: 1, 3: 1}


def test_language(spark):
    rng = random.Random(1)
    kinds = {"aa": "abcde", "bb": "efghi"}
    rows = [(k, " ".join("".join(rng.choice(kinds[x]) for _ in range(5)) for _ in range(30)), x) for k in range(60) for x in [("aa", "bb")[k % 2]]]
    docs = spark.createDataFrame([*rows, (100, None, "aa"), (101, "12 !", "bb"), (102, "", None)], "doc_id long, text string, lang string")
    models = language_id.fit(docs.where("doc_id < 30"))
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs, models).collect()}
    assert all(found[k][0] == x for k, _, x in rows if k >= 30) and all(found[k] == ("und", 0.0) for k in (100, 101, 102))
    assert language_id.keep_identified(docs, models).count() == 60
    assert {r.lang_pred for r in language_id.identify(docs, []).collect()} == {"und"}


def test_language_learns_beyond_a_common_opening(spark):
    rng = random.Random(3)
    header = " ".join("".join(rng.choice("mnopq") for _ in range(5)) for _ in range(40))
    body = lambda x: " ".join("".join(rng.choice({"aa": "abcde", "bb": "vwxyz"}[x]) for _ in range(5)) for _ in range(60))
    rows = [(k, f"{header} {body(x)}", x) for k in range(60) for x in [("aa", "bb")[k % 2]]] + [(90 + k, "1 2 3 " * 60 + "letters", "cc") for k in range(3)]
    models = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tests = [(k, body(x), x) for k in range(20) for x in [("aa", "bb")[k % 2]]] + [(20, "letters", "cc")]
    found = {r.doc_id: r.lang_pred for r in language_id.identify(spark.createDataFrame(tests, "doc_id long, text string, lang string"), models).collect()}
    assert found == {k: x for k, _, x in tests}


def test_phrases_against_plain_parsing(monkeypatch):
    """Whole texts, short and of many segments, whether or not the parses of two segments soon meet."""
    monkeypatch.setattr(language_id, "SEGMENT", 16)
    monkeypatch.setattr(language_id, "SIDE_BY_SIDE", 8)
    rng = random.Random(13)
    samples = ["abracadabra and a barn", "ab" * 60, "".join(rng.choice("abc ") for _ in range(80))]
    texts = ["a cadabran bark zz", "", None, "ab" * 40, "ba" * 33 + "c", "a" * 70, samples[2] * 3]
    texts += ["".join(rng.choice("abcdr z") for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    samples = [language_id.normalise(x) for x in samples]
    models = language_id.automata([(str(k), x.tobytes()) for k, x in enumerate(samples)])
    found, sizes = language_id.parse_counts(models, texts)
    for row, size, text in zip(found, sizes, texts, strict=True):
        raw = language_id.normalise(text or "")
        assert size == len(raw)
        for n, sample in zip(row, samples, strict=True):
            count, at, whole = 0, 0, sample.tobytes()
            while at < len(raw):
                k = 1
                while at + k < len(raw) and raw[at : at + k + 1].tobytes() in whole:
                    k += 1
                count, at = count + 1, at + k
            assert n == count


def test_toxicity_learns_pairs(spark):
    rng = random.Random(2)
    rows = []
    for k in range(400):
        words = rng.sample(["tree", "house", "river", "stone", "cloud", "field"], 3)
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["insultx"] * insult + ["groupx"] * group
        rows.append((k, " ".join(words), int(insult and group)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows] + [(900, None), (901, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k < 300], "doc_id long, toxic int")
    found = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert np.mean([(found[k] >= 0.5) == y for k, _, y in rows[300:]]) > 0.97
    assert 0 <= found[900] == found[901] <= 1
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()} == {0.5}


def test_secrets(spark):
    key = "AKIA" + "Q7ZP" * 4
    texts = [(k, f"some words here {key[:-2]}{k:02d} and\npassword=9f8e7d6c5b4a39281{k % 10} then averyveryverylongplainword{'x' * (k % 3)}") for k in range(40)] + [(50, None), (51, "")]
    found = secrets.scan(docs_of(spark, texts)).collect()
    by_id = {k: t for k, t in texts}
    assert len(found) == 120 and all(by_id[r.doc_id][r.start - 1 : r.start - 1 + r.length] == r.found for r in found)
    assert all(r.secret == (not r.found.startswith("avery")) for r in found)
    assert secrets.scan(docs_of(spark, [(1, None)])).collect() == []


def test_the_forest_overrules_the_pattern(spark):
    """What looks like prose is no secret though a credential's name stands before it; what looks like a key is one though none does."""
    rng = random.Random(31)
    key = lambda: "".join(rng.choice("0123456789abcdefXYZQ") for _ in range(24))
    words = ["please", "change", "this", "value", "before", "first", "start", "here", "again", "today"]
    prose = lambda: "-".join(rng.sample(words, 4))
    some = lambda: " ".join(rng.choices(words, k=rng.randrange(3, 7)))
    texts = [(k, f"{some()} password={key()} {some()} {prose()} {some()}") for k in range(200)]
    texts += [(200 + k, f"{some()} password={prose()} {some()}") for k in range(6)]
    texts += [(300 + k, f"{some()} {key()} {some()}") for k in range(6)]
    found = {(r.doc_id, r.found): r.secret for r in secrets.scan(docs_of(spark, texts)).collect()}
    assert all(v for (k, x), v in found.items() if k < 200 and "-" not in x) and not any(v for (k, _), v in found.items() if 200 <= k < 300)
    assert all(v for (k, _), v in found.items() if k >= 300) and not any(v for (k, x), v in found.items() if "-" in x)


def test_findings_of_held_out_documents(spark):
    """Where the patterns contradict one another or are silent, and in documents that teach nothing, the forest alone decides."""
    rng = random.Random(5)
    key = lambda: "".join(rng.choice("0123456789abcdefXYZQ") for _ in range(24))
    prose = lambda: "".join(rng.choice(["water", "stone", "river", "bridge", "garden"]) for _ in range(4))
    texts = [(k, f"we set token={key()} there and {prose()} here, not token={prose()}, nor {key()} there") for k in range(120)]
    found = secrets.scan(docs_of(spark, texts)).collect()
    held = {k for k, _ in texts if zlib.crc32(str(k).encode()) % 4 == 2}
    assert {r.doc_id for r in found if r.held_out} == held and len(held) > 15
    wrong = [r for r in found if r.secret != (not r.found.isalpha())]
    assert not wrong and {(r.claimed, r.secret) for r in found if r.held_out} == {(a, b) for a in (False, True) for b in (False, True)}


def test_features_by_plain_python(spark):
    rng, words = random.Random(8), ["stone", "river", "stones", "ver"]
    some = lambda n: "".join(rng.choice(["stone", "river", "Stones", "ver", " ", "A", "b9", "/", ".", "7", "é", ": ", "=", '"', "pass", "\n", "_"]) for _ in range(rng.randrange(n)))
    rows = [(k, some(8) + "x", some(9), some(9)) for k in range(400)]
    found = secrets.with_features(spark.createDataFrame(rows, "doc_id long, found string, before string, after string"), words)
    known = "|".join(sorted(words, key=len, reverse=True))

    def spoken(text):
        letters = re.sub("[^a-z]+", " ", text.lower())
        left = re.sub(rf"\b(?:{known})\b", "", letters)
        size = len(letters.replace(" ", ""))
        return 1 - len(left.replace(" ", "")) / size if size else 0.0

    for r in found.collect():
        n, earlier = len(r.found), re.sub(r"\S+[ \t\n\v\f\r]*[:=]?[ \t\n\v\f\r]*[\"']?$", "", r.before)
        kinds = re.sub("[0-9]+", "d", re.sub("[a-z]+", "l", re.sub("[A-Z]+", "U", r.found)))
        want = [n, len(re.findall("[0-9]", r.found)) / n, len(re.findall("[A-Z]", r.found)) / n, len(kinds) / n, 1 - len(re.sub(known, "", r.found.lower())) / n]
        want += [r.found.count("/") + r.found.count(".") + bool(re.search(r"(://|[/\\])\S*$", r.before)), spoken(earlier), spoken(r.after)]
        named = "pass|pwd|secret|token|key|auth|cred|bearer"
        want += [bool(re.search(named, earlier.lower()) or re.search(named, r.after.lower())), r.after[:1] in ('"', "'")]
        assert [r[f] for f in secrets.FEATURES] == pytest.approx([float(x) for x in want]), r


def test_many_candidates_in_one_text(spark):
    text = " ".join(f"{'ab' * 8}{k:05d}" for k in range(20_000))
    found = secrets.candidates(docs_of(spark, [(1, text)])).orderBy("start").collect()
    assert [r.start for r in found] == [1 + 22 * k for k in range(20_000)] and found[-1].found == f"{'ab' * 8}19999"


def test_secrets_given_to_a_credential(spark):
    """Short values and any characters, where the name of a credential stands before them."""
    texts = ["set password=hunter2, then", "passwd: 'S3cr3t!x' ok", "my_api_key = P@ss{w}ord$1", '"token": "two words" end', "/x?token=ab12cd&user=bob", "db_main_production_password=hunter2!", "secret=abc", "a word: hunter2", "SECRET=Zz9!\nlast"]
    want = [["hunter2"], ["S3cr3t!x"], ["P@ss{w}ord$1"], ["two words"], ["ab12cd"], ["hunter2!"], [], [], ["Zz9!"]]
    found = secrets.scan(docs_of(spark, list(enumerate(texts)))).collect()
    assert [[r.found for r in found if r.doc_id == k] for k in range(len(texts))] == want
    assert all(texts[r.doc_id][r.start - 1 : r.start - 1 + r.length] == r.found and r.secret for r in found)


def test_dictionary_goes_by_frequency(spark):
    words = ["".join(x) for x in itertools.product("abcde", repeat=4)]
    assert secrets.dictionary(docs_of(spark, [(1, " ".join(words)), (2, None)])) == sorted(words)


def test_mixing(spark):
    texts = [(k, "w " * (1 + k % 7)) for k in range(300)] + [(400, None)]
    docs = docs_of(spark, texts).selectExpr("doc_id", "text", "CASE WHEN doc_id < 250 THEN 'big' WHEN doc_id < 290 THEN 'mid' END AS source")
    rows = mixing.mix(docs, target_entropy=0.9, max_repeats=3.0).collect()
    tokens = {}
    for r in rows:
        tokens[r.source] = tokens.get(r.source, 0) + r.n_tokens * r.copies
    total = sum(len((t or "").split()) for _, t in texts)
    weight = {r.source: r.weight for r in rows}
    # Copies against a plain count: whole passes, then the last one in order of place.
    of_source = {}
    for k, t in texts:
        of_source.setdefault("" if k >= 290 else "big" if k < 250 else "mid", []).append((k, len((t or "").split())))
    for s, held in of_source.items():
        quota, size = int(weight[s] * total), sum(n for _, n in held)
        mine = {r.doc_id: r for r in rows if r.source == s}
        assert all(len(r.positions) == r.copies and r.positions == sorted(r.positions) and r.positions[-1] < 1 for r in mine.values())
        passes, rest = divmod(quota, size)
        order = sorted(mine, key=lambda k: (mine[k].positions[0], mine[k].n_tokens > 0))
        if passes:  # every document is there, with its tokens before the next
            assert len(order) == len(held)
        at = 0
        for k in order:
            assert abs(mine[k].positions[0] - at / quota) < 1e-8 and mine[k].copies == passes + (at < rest)
            at += mine[k].n_tokens
    assert all(0 <= tokens[s] - int(weight[s] * total) < 8 for s in weight) and abs(sum(weight.values()) - 1) < 1e-6
    sources = docs.withColumn("tokens", mixing.F.size(mixing.F.split("text", " ")) - 1).groupBy("source").agg(mixing.F.sum("tokens").alias("tokens"))
    e = mixing.find_exponent(sources, target_entropy=0.9)
    p = np.array([r.tokens for r in sources.collect()], float) ** e
    p /= p.sum()
    assert abs(-(p * np.log(p)).sum() / np.log(len(p)) - 0.9) < 1e-4
    assert mixing.mix(docs.limit(0)).collect() == []


def test_url_filter(spark):
    rules = [("block", "com/en/"), ("allow", "example.com/en/7"), ("block", "bad.org/")]
    html = '<a href="http://bad.org/x">x</a><a href="/own">y</a>'
    pages = [(1, "https://Example.COM/en/71?q#f", ""), (2, "http://a.com/en/1", None), (3, "http://friend.net/p", html), (4, "http://quiet.net", "<p>"), (5, None, html), (6, "no scheme", ""), (7, "http://bad.org/q", ""), (7, "http://bad.org/q", "")]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), rules).collect()}
    assert found == {1: ("example.com", "/en/71", "example.com/en/7", "allow"), 2: ("a.com", "/en/1", "com/en/", "block"), 3: ("friend.net", "/p", None, "block"), 4: ("quiet.net", "", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("bad.org", "/q", "bad.org/", "block")}


def test_distrust_goes_as_far_as_links_do(spark):
    pages = [(k, f"http://h{k}.net/", f"<a href=http://h{k + 1}.net/x>x</a>") for k in range(20)] + [(20, "http://h20.net/", "<a href='http://bad.org/'>x</a>"), (21, "http://bad.org/", "")]
    found = url_filter.judge(spark.createDataFrame(pages, "page_id long, url string, html string"), [("block", "bad.org/")]).collect()
    assert {r.page_id for r in found if r.verdict == "block"} == set(range(22))


def test_propagation_matches_plain_iteration(spark):
    edges = [("a", "b", 2), ("a", "c", 1), ("b", "c", 1), ("c", "a", 3), ("d", "c", 1)]
    found = {r.host: (r.trust, r.distrust) for r in url_filter.propagate(spark.createDataFrame(edges, "src string, dst string, links long"), spark.createDataFrame([("a", 1, 0), ("c", 0, 2)], "host string, trusted long, blocked long"), rounds=7).collect()}
    hosts = "abcd"
    for which, start, links in ((0, "a", edges), (1, "c", [(b, a, n) for a, b, n in edges])):
        rank = {h: float(h == start) for h in hosts}
        for _ in range(7):
            new = {h: 0.15 * (h == start) for h in hosts}
            for h in hosts:
                out = [(b, n) for a, b, n in links if a == h] or [(h, 1)]
                for b, n in out:
                    new[b] += 0.85 * rank[h] * n / sum(n for _, n in out)
            rank = new
        assert all(abs(found.get(h, (0, 0))[which] - rank[h]) < 1e-9 for h in hosts)


def test_empty_tables(spark):
    none = docs_of(spark, [])
    assert ngram_join.near_duplicates(none).collect() == [] and substrings.remove_repeats(none).collect() == []
    assert lines.dedup_lines(none).collect() == [] and decontaminate.decontaminate(none, spark.createDataFrame([], "item_id long, text string")).collect() == []
    assert embeddings.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


CLASHING = "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string, label int, row long, k int, found string, copies long, block long, toxic int"


def test_odd_rows_and_clashing_columns(spark):
    """Nulls everywhere, an empty and a very long text, repeated rows, and columns named as the operators' own."""
    extra = (9, 0.5, "x", 1, 2, 3, "y", 4, 5, 1)
    texts = [(k, f"some plain words of text number {k} and more", ("aa", None)[k % 2], ("s", None)[k % 2]) for k in range(8)]
    texts += [(50, None, "aa", "s"), (51, "", None, None), (52, "long words " * 60_000, "aa", "s"), (None, "some words", "aa", "s"), (3, texts[3][1], "aa", "s")]
    docs = spark.createDataFrame([(*t, *extra) for t in texts], CLASHING)
    ids = sorted((t[0] for t in texts), key=str)
    found = language_id.identify(docs, language_id.fit(docs)).collect()
    assert sorted((r.doc_id for r in found), key=str) == ids and {r.lang_pred for r in found} == {"aa", "und"}
    assert language_id.keep_identified(docs, language_id.fit(docs)).columns == docs.columns
    labels = spark.createDataFrame([(k, k % 2, "t", 0.0) for k in range(6)] + [(None, 1, None, None), (7, None, None, None)], "doc_id long, toxic int, text string, score double")
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert sorted((r.doc_id for r in scored), key=str) == ids and all(0 <= r.score <= 1 for r in scored)
    assert secrets.scan(docs).collect() == []
    mixed = mixing.mix(docs, None, None).collect()
    assert sorted((r.doc_id for r in mixed if r.n_tokens), key=str) == sorted((t[0] for t in texts if t[1]), key=str)
    assert lines.without_repeated_lines(docs).columns == docs.columns
    long = next(r for r in substrings.remove_repeats(docs).collect() if r.doc_id == 52)
    assert (long.n_words, long.n_removed) == (120_000, 0)
    assert next(r for r in ngram_join.near_duplicates(docs).collect() if r.doc_id == 52).n_shingles == 2
    pages = spark.createDataFrame([(1, "http://a.com/", "<p>" * 100_000, "h", "p", "r", 1.0), (None, None, None, None, None, None, None)], "page_id long, url string, html string, host string, path string, rule string, trust double")
    assert sorted((str(r.page_id), r.verdict) for r in url_filter.judge(pages, [("block", "b.com/")]).collect()) == [("1", "allow"), ("None", "allow")]


def test_empty_tables_of_the_rest(spark):
    none = spark.createDataFrame([], CLASHING)
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert language_id.identify(none, language_id.fit(none)).collect() == [] == secrets.scan(none).collect()
    assert language_id.held_out_rates(none) == {} and language_id.keep_identified(none, []).collect() == []
    assert toxicity.score(none, toxicity.fit(none, labels)).collect() == [] == mixing.mix(none).collect()
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string"), [("block", "b.com/")]).collect() == []


def test_forest_in_parts(spark, monkeypatch):
    """A partition that unites few nodes at once loses no connection."""
    from tidewire.llm import common

    monkeypatch.setattr(common, "FOREST_NODES", 3)
    edges = [(k, k + 1) for k in range(40) if k % 8]
    batches = [common.pa.RecordBatch.from_arrays([common.pa.array([a]), common.pa.array([b])], names=["a", "b"]) for a, b in edges]
    found = [(r["u"], r["v"]) for batch in common._forest(iter(batches)) for r in batch.to_pylist()]
    assert components(found, range(41)) == components(edges, range(41))


def test_factorization_machine_scores_are_its_formula():
    """Every pair of terms counts by the product of its factors."""
    rng = np.random.default_rng(4)
    place = np.array([0, -1, 1, 2, 3])
    model = toxicity.FactorizationMachine(place, 0.3, rng.normal(size=4), rng.normal(size=(4, 3)))
    for row in ([0, 2, 3, 4], [1, 2], [], [4]):
        held = [place[t] for t in row if place[t] >= 0]
        x = 0.3 + sum(model.weights[t] for t in held) + sum(model.factors[a] @ model.factors[b] for a, b in itertools.combinations(held, 2))
        assert abs(model.scores([np.array(row, np.int64)])[0] - 1 / (1 + math.exp(-x))) < 1e-12


def test_texts_without_letters_have_no_language(spark):
    docs = spark.createDataFrame([(k, "the water of the stone and the river " * 3, "en") for k in range(5)], "doc_id long, text string, lang string")
    texts = ["²", "½ Ⅳ", "\u0301\u0308", "_ 12 \u0663", "\U0001f600", "ª", "ʰ", "字", "x2"]
    found = language_id.identify(docs_of(spark, list(enumerate(texts))), language_id.fit(docs)).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == ["und"] * 5 + ["en"] * 4
