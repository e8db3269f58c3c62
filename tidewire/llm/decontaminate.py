"""Benchmark decontamination with a distributed positional inverted index.

A shard of the index holds whole documents and the postings of every term in them, sorted by
term and position, so that phrase search needs no shuffle: the benchmark's phrases go to the
shards, where offset-adjusted posting lists are intersected from the rarest term of each phrase
on. An index is a table of shards, to be searched many times; a single search takes each shard
where it is built.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import map_arrow, materialise

#: Words of a shard, but for a longer document, which is a shard of its own.
SHARD_WORDS = 1 << 19
#: Bytes of benchmark text that go to the shards at once; a larger benchmark goes in blocks. Its windows take some 80 times that.
BLOCK_BYTES = 2 << 20
#: Postings of rarest terms from which intersection starts at once.
ANCHORS = 1 << 20
#: Writer's options that bound a row group by bytes, looked at after every row; else all shards of a task are in memory at once.
SHARDS_APART = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


def _word_table() -> bytes:
    """Lower-cases A-Z; all ASCII but letters and digits becomes a space."""
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for b in range(128):
        if chr(b).isalnum():
            out[b] = ord(chr(b).lower())
    return bytes(out)


WORDS = _word_table()


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(WORDS).split() if text else []


INDEX = "shard string, doc_ids array<long>, starts array<long>, terms array<string>, term_starts array<int>, positions binary"
_INDEX = pa.schema([("shard", pa.string()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("terms", pa.list_(pa.string())), ("term_starts", pa.list_(pa.int32())), ("positions", pa.binary())])


def _postings(texts: list[list[bytes]]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
    """First words of the documents, terms, where the postings of each begin, and their positions."""
    number: dict[bytes, int] = defaultdict(count().__next__)
    sizes = [len(w) for w in texts]
    codes = np.fromiter((number[w] for words in texts for w in words), np.int32, sum(sizes))
    positions = np.argsort(codes, kind="stable").astype(np.int32)
    starts = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    term_starts = np.concatenate(([0], np.cumsum(np.bincount(codes, minlength=len(number)))))
    return starts, [w.decode("utf-8", "replace") for w in number], term_starts, positions


def _shard(ids: list, texts: list[list[bytes]]) -> pa.RecordBatch:
    starts, terms, term_starts, positions = _postings(texts)
    row = [uuid.uuid4().hex], [ids], [starts.tolist()], [terms], [term_starts.tolist()], [positions.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _INDEX, strict=True)], schema=_INDEX)


def _dealt(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[list[bytes]]]]:
    """The documents (doc_id, text) of a task as shards: ids, and the words of each text."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            words = words_of(text.as_py())
            if ids and size + len(words) > SHARD_WORDS:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(doc_id), texts.append(words)
            size += len(words)
    if ids:
        yield ids, texts


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def build_index(documents: DataFrame) -> DataFrame:
    """Postings of every token of documents (doc_id, text), a row for each shard, lazily.

    Documents are dealt to shards where they are read. A null text has no words; its document
    is in the index all the same. Write the index once and search it many times.
    """

    def build(batches):
        for ids, texts in _dealt(batches):
            yield _shard(ids, texts)

    return map_arrow(_texts(documents), build, INDEX)


class Phrases:
    """The distinct windows of a block of items, as arrays over the block's own vocabulary."""

    def __init__(self, items: list[tuple[str, str | None]], width: int):
        number: dict[bytes, int] = defaultdict(count().__next__)
        self.items = sorted({i for i, _ in items})
        rank = {x: k for k, x in enumerate(self.items)}
        owners: dict[tuple[int, ...], set[int]] = defaultdict(set)
        for item, text in items:
            codes = tuple(number[w] for w in words_of(text))
            for at in range(max(1, len(codes) - width + 1) if codes else 0):
                owners[codes[at : at + width]].add(rank[item])
        self.vocabulary = [w.decode("utf-8", "replace") for w in number]
        windows = list(owners)
        self.length = np.array([len(w) for w in windows], np.int64)
        self.codes = np.array([w + (-1,) * (width - len(w)) for w in windows], np.int64).reshape(-1, width)
        self.owner_starts = np.concatenate(([0], np.cumsum([len(owners[w]) for w in windows]))).astype(np.int64)
        self.owners = np.array([i for w in windows for i in sorted(owners[w])], np.int64)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each k, counts[k] rows: the row's k, and its number within k."""
    own = np.repeat(np.arange(len(counts)), counts)
    return own, np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)


def search(phrases: Phrases, starts: np.ndarray, terms: list[str], term_starts: np.ndarray, positions: np.ndarray, slop: int) -> tuple[np.ndarray, ...]:
    """(window, first position) of every exact match, and (window, position of the rarest word) of every near one.

    A window is near a position of its rarest word (in the shard; ties: the first) if each of its
    other words occurs within length + slop words of it, in the same document.
    """
    total = len(positions)
    local = {t: k for k, t in enumerate(terms)}
    known = np.array([local.get(t, -1) for t in phrases.vocabulary] + [-1], np.int64)  # the last is for padding
    term = known[phrases.codes]
    used = np.arange(phrases.codes.shape[1]) < phrases.length[:, None]
    open_ = np.flatnonzero(((term >= 0) | ~used).all(axis=1) & (phrases.length > 0))
    none = np.zeros(0, np.int64)
    if not len(open_) or not total:
        return none, none, none, none
    sizes = np.diff(term_starts)
    term, length = term[open_], phrases.length[open_]
    postings = np.where(used[open_], sizes[term], np.iinfo(np.int64).max)
    order = np.argsort(postings, axis=1, kind="stable")  # rarest first
    keys = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes) * total + positions
    first = order[:, 0]
    lead = term[np.arange(len(term)), first]

    def narrowed(own, anchor, low, high, holds):
        for k in range(1, order.shape[1]):
            if not len(own):
                break
            at = order[own, k]
            ok = (k >= length[own]) | holds(own, anchor, low, high, at)
            own, anchor, low, high = own[ok], anchor[ok], low[ok], high[ok]
        return own, anchor

    def exact(own, anchor, low, high, at):
        wanted = term[own, at] * total + anchor - first[own] + at
        found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[found] == wanted

    def near(own, anchor, low, high, at):
        reach = length[own] + slop
        wanted = np.maximum(anchor - reach, low)
        found = np.searchsorted(keys, term[own, at] * total + wanted)
        there = keys[np.minimum(found, len(keys) - 1)] - term[own, at] * total
        return (found < len(keys)) & (there >= wanted) & (there <= np.minimum(anchor + reach, high - 1))

    found = []
    # Windows in turn, so that the postings at hand are bounded; of one term a shard bounds them.
    part = np.cumsum(sizes[lead]) // ANCHORS
    for some in np.split(np.arange(len(lead)), np.flatnonzero(np.diff(part)) + 1):
        own, nth = _spread(sizes[lead[some]])
        own = some[own]
        anchor = positions[term_starts[lead[own]] + nth].astype(np.int64)
        document = np.searchsorted(starts, anchor, "right") - 1
        low, high = starts[document], starts[document + 1]
        begin = anchor - first[own]
        inside = (begin >= low) & (begin + length[own] <= high)
        hit, at = narrowed(own[inside], anchor[inside], low[inside], high[inside], exact)
        close, where = narrowed(own, anchor, low, high, near)
        found.append((open_[hit], at - first[hit], open_[close], where))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


MATCHES = "shard string, place int, doc_id long, n_words long, spans array<struct<start:int,end:int>>, items array<string>, near_items array<string>"
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_MATCHES = pa.schema([("shard", pa.string()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(_SPAN)), ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])


def _summary(phrases: Phrases, shard: str, ids: list, starts: np.ndarray, found: tuple) -> pa.RecordBatch:
    window, begin, close, where = found

    def items(window, at):
        own, nth = _spread(np.diff(phrases.owner_starts)[window])
        document = np.searchsorted(starts, at, "right")[own] - 1
        item = phrases.owners[phrases.owner_starts[window[own]] + nth]
        out: list[list[str]] = [[] for _ in ids]
        for d, i in np.unique(np.stack([document, item]), axis=1).T.tolist():
            out[d].append(phrases.items[i])
        return out

    spans: list[list[dict]] = [[] for _ in ids]
    if len(window):
        change = np.zeros(starts[-1] + 1, np.int64)
        np.add.at(change, begin, 1)
        np.add.at(change, begin + phrases.length[window], -1)
        covered = np.concatenate(([False], np.cumsum(change) > 0, [False]))
        edges = np.flatnonzero(covered[1:] != covered[:-1]).reshape(-1, 2)
        # Spans that touch at the border of two documents are one here.
        for a, b in edges.tolist():
            d = int(np.searchsorted(starts, a, "right")) - 1
            while a < b:
                stop = min(b, int(starts[d + 1]))
                if stop > a:
                    spans[d].append({"start": a - int(starts[d]), "end": stop - int(starts[d])})
                a, d = max(a, stop), d + 1
    columns = [shard] * len(ids), list(range(len(ids))), ids, np.diff(starts).tolist(), spans, items(window, begin), items(close, where)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MATCHES, strict=True)], schema=_MATCHES)


def _asked(items: DataFrame) -> tuple[DataFrame, int]:
    """The items (item_id, text) to search for, and in how many blocks they go."""
    asked = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return asked, 1 + size // BLOCK_BYTES


def find_matches(index: DataFrame, items: DataFrame, width: int = 10, slop: int = 10) -> DataFrame:
    """Matches of items (item_id, text) in an index: a row for each of its documents.

    doc_id, n_words, spans (the merged word ranges [start, end) covered by occurring windows),
    items (item_ids with such a window) and near_items (those with a window whose words lie
    close together), both as sorted strings without repeats. A window is `width` consecutive
    words of an item; an item of fewer words is one window, one without words or with a null
    text or id has none. Shards are searched where they lie. Some BLOCK_BYTES of items are broadcast
    at once; a larger benchmark is split into blocks, one of which after the other is searched,
    written and taken back, and their matches are merged by document.
    """
    spark = index.sparkSession
    asked, n_blocks = _asked(items)
    parts = []
    for k in range(n_blocks):
        block = asked if n_blocks == 1 else asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k)
        shared = spark.sparkContext.broadcast(Phrases([tuple(r) for r in block.collect()], width))

        def match(batches, shared=shared):
            for batch in batches:
                for k in range(batch.num_rows):
                    shard, ids, starts, terms, term_starts, positions = (c[k].as_py() if c.type != pa.binary() else c[k] for c in batch.columns)
                    starts, term_starts = np.array(starts), np.array(term_starts, np.int64)
                    raw = np.frombuffer(positions.as_buffer(), np.int32)
                    yield _summary(shared.value, shard, ids, starts, search(shared.value, starts, terms, term_starts, raw, slop))

        found = map_arrow(index, match, MATCHES)
        if n_blocks == 1:
            return found.drop("shard", "place")
        # One block is out at a time: its matches are written, of later blocks those that there are.
        parts.append(materialise(found if not k else found.where(F.size("spans") + F.size("near_items") > 0), "matches"))
        shared.destroy()
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    merged = rows.groupBy("shard", "place", "doc_id", "n_words").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"))
    joined = """aggregate(array_sort(spans), CAST(array() AS array<struct<start:int,end:int>>), (acc, x) ->
        CASE WHEN size(acc) > 0 AND element_at(acc, -1).end >= x.start
        THEN concat(slice(acc, 1, size(acc) - 1), array(named_struct('start', element_at(acc, -1).start, 'end', greatest(element_at(acc, -1).end, x.end))))
        ELSE concat(acc, array(x)) END)"""
    return merged.select("doc_id", "n_words", F.expr(joined).alias("spans"), "items", "near_items")


def decontaminate(documents: DataFrame, items: DataFrame, width: int = 10, slop: int = 10) -> DataFrame:
    """find_matches over an index of `documents` made for this search.

    Items of one block are searched for in each shard where it is built, and no shard is written.
    For more, the index is written to the shared folder, in row groups of few shards.
    """
    asked, n_blocks = _asked(items)
    if n_blocks > 1:
        return find_matches(materialise(build_index(documents), "postings", **SHARDS_APART), items, width, slop)
    shared = documents.sparkSession.sparkContext.broadcast(Phrases([tuple(r) for r in asked.collect()], width))

    def match(batches):
        for ids, texts in _dealt(batches):
            starts, *postings = _postings(texts)
            yield _summary(shared.value, "", ids, starts, search(shared.value, starts, *postings, slop))

    return map_arrow(_texts(documents), match, MATCHES).drop("shard", "place")
