"""Substring dedup by super-k-mers.

Consecutive windows of a document that share a minimiser travel as one packed string to the
minimiser's bucket, where sorting brings equal windows together. Windows of a minimiser that has
more text than a bucket should hold go by themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import materialise
from tidewire.llm.words import grams, is_in, mixed, word_hashes, word_places

#: Words of a minimiser: so many that few are frequent.
M = 4
#: Bytes of the corpus that a bucket stands for, and bytes of packed strings that make a minimiser hot.
BUCKET_BYTES = 3 << 20
#: Hot minimisers, about, at most: beyond so many buckets, larger ones are let be.
MOST_HOT = 1 << 20
#: Words that a task packs at once, but for a longer text.
CHUNK_WORDS = 1 << 20
#: Hits are broadcast to the texts up to this size; beyond it the texts are joined by shuffle.
BROADCAST_BYTES = 32 << 20


def split(text: str | None) -> list[bytes]:
    """Words: runs of anything but the ASCII white space 0x20 and 0x09 to 0x0D."""
    return text.encode("utf-8", "replace").split() if text else []


def _sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    return np.minimum(x[: len(x) - (width - span)], x[width - span :]) if width > span else x


def _runs_of(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin."""
    changes = np.zeros(max(len(keys[0]) - 1, 0), bool)
    for x in keys:
        changes |= x[1:] != x[:-1]
    return np.flatnonzero(np.concatenate(([True], changes))[: len(keys[0])])


class Chunk:
    """The super-k-mers of some documents, in order, as arrays.

    A window's minimiser follows from its words alone, so equal windows have the same: the least
    hash of M words, or of the whole window where that one is hot. done: what a smaller document
    of the chunk has as well, in a super-k-mer of the same windows; it is hit already.
    """

    def __init__(self, ids: list[int], texts: list[bytes], words: list[tuple], width: int, hot: np.ndarray):
        sizes = np.array([len(h) for h, _, _ in words])
        self.texts, begins = texts, np.cumsum(sizes) - sizes
        self.hashes, first, last = (np.concatenate(x) for x in zip(*words, strict=True))
        text_of = np.repeat(np.arange(len(texts)), sizes)
        at = np.flatnonzero(text_of[width - 1 :] == text_of[: len(text_of) - width + 1])
        windows = grams(self.hashes, width)[at]
        m = min(M, width)
        least = _sliding_minimum(grams(self.hashes, m), width - m + 1)[at]
        least = np.where(is_in(least, hot), windows, least)
        # Windows of two texts never stand side by side.
        starts = _runs_of(least, at - np.arange(len(at)))
        n = np.diff(np.append(starts, len(at)))
        nth = (np.arange(len(at)) - np.repeat(starts, n)).astype(np.uint64)
        strings = np.add.reduceat(mixed(windows + nth * np.uint64(0x9E3779B97F4A7C15)), starts)
        self.minimiser, begin, end = least[starts], at[starts], at[starts] + n + width - 1
        self.text = text_of[begin]
        self.doc = np.array(ids, np.int64)[self.text]
        self.start, self.size = (begin - begins[self.text]).astype(np.int32), (end - begin).astype(np.int32)
        self.low, self.high = first[begin], last[end - 1]
        order = np.lexsort((self.doc, strings))
        groups = _runs_of(strings[order])
        smallest = np.repeat(self.doc[order][groups], np.diff(np.append(groups, len(order))))
        self.done = np.zeros(len(order), bool)
        self.done[order] = self.doc[order] > smallest

    def packed(self, places: list[int]) -> list[bytes]:
        low, high, text = self.low[places].tolist(), self.high[places].tolist(), self.text[places].tolist()
        return [self.texts[t][a:b] for t, a, b in zip(text, low, high, strict=True)]


def _chunks(batches, width: int, hot: np.ndarray) -> Iterator[Chunk]:
    """Chunks of batches (doc_id, text); texts of fewer than `width` words and null ids have no windows."""
    ids, texts, words, size = [], [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "replace") if doc_id is not None else b""
            found = word_places(raw)
            if len(found[0]) < width:
                continue
            ids.append(doc_id), texts.append(raw), words.append(found)
            size += len(found[0])
            if size >= CHUNK_WORDS:
                yield Chunk(ids, texts, words, width, hot)
                ids, texts, words, size = [], [], [], 0
    if ids:
        yield Chunk(ids, texts, words, width, hot)


_COUNTED = pa.schema([("minimiser", pa.int64()), ("bytes", pa.int64())])


def _hot(texts: DataFrame, width: int, n_bytes: int) -> np.ndarray:
    """Minimisers, sorted, whose super-k-mers have more than a bucket's bytes, and maybe some of half as many.

    A chunk reports those that have half of the chunk's share of a bucket, or more: what it
    keeps to itself sums to half a bucket over all chunks. Strings sent once count once.
    """
    limit = max(BUCKET_BYTES, n_bytes // MOST_HOT)

    def tally(batches):
        for chunk in _chunks(batches, width, np.zeros(0, np.uint64)):
            values, place = np.unique(chunk.minimiser, return_inverse=True)
            size = np.bincount(place, (chunk.high - chunk.low) * ~chunk.done).astype(np.int64)
            share = limit * sum(map(len, chunk.texts)) / (2 * n_bytes)
            yield pa.RecordBatch.from_arrays([pa.array(values[size >= share].view(np.int64)), pa.array(size[size >= share])], schema=_COUNTED)

    sums = texts.mapInArrow(tally, "minimiser long, bytes long").groupBy("minimiser").agg(F.sum("bytes").alias("bytes"))
    found = sums.where(F.col("bytes") > limit // 2).select("minimiser").collect()
    return np.sort(np.array([r["minimiser"] for r in found], np.int64).view(np.uint64))


_SENT = pa.schema([("bucket", pa.int64()), ("packed", pa.binary()), ("docs", pa.binary()), ("starts", pa.binary()), ("sizes", pa.binary())])
_HITS = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _merged(doc: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, start, end) of ranges in order, those of one text that overlap or touch as one."""
    if not len(doc):
        return doc, start, end
    new = np.concatenate(([True], (text[1:] != text[:-1]) | (start[1:] > end[:-1])))
    return doc[new], start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(doc) - 1)]


def _send(chunk: Chunk, n_buckets: int, zstd: zstandard.ZstdCompressor) -> pa.RecordBatch:
    """Rows of _SENT: what goes to each bucket, and without a string what is hit already."""
    bucket = (mixed(chunk.minimiser) % np.uint64(n_buckets)).astype(np.int64)
    order = np.flatnonzero(~chunk.done)
    order = order[np.argsort(bucket[order], kind="stable")]
    packed, starts = chunk.packed(order), _runs_of(bucket[order])
    rows = []
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(order)).tolist(), strict=True):
        some = order[a:b]
        rows.append((int(bucket[some[0]]), zstd.compress(b" ".join(packed[a:b])), chunk.doc[some].tobytes(), chunk.start[some].tobytes(), chunk.size[some].tobytes()))
    done = np.flatnonzero(chunk.done)
    if len(done):
        doc, start, end = _merged(chunk.doc[done], chunk.text[done], chunk.start[done], chunk.start[done] + chunk.size[done])
        rows.append((int(doc[0]) % n_buckets, None, doc.tobytes(), start.tobytes(), (end - start).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SENT, strict=True)], schema=_SENT)


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _resolve(group: pa.Table, width: int) -> pa.Table:
    """Word ranges [start, end) of a bucket that are covered by windows of a smaller document."""
    known = group.filter(group["packed"].is_null())
    done = [_joined(known["docs"], np.int64), start := _joined(known["starts"], np.int32), start + _joined(known["sizes"], np.int32)]
    rows = group.filter(group["packed"].is_valid())
    if not rows.num_rows:
        return pa.table(list(map(pa.array, done)), schema=_HITS)
    doc, start, size = _joined(rows["docs"], np.int64), _joined(rows["starts"], np.int32), _joined(rows["sizes"], np.int32).astype(np.int64)
    hashes = np.concatenate([word_hashes(zstandard.decompress(x)) for x in rows["packed"].to_pylist()])
    windows = size - width + 1
    row = np.repeat(np.arange(len(doc)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = (np.cumsum(size) - size)[row] + offset
    key = grams(hashes, width)[at]
    order = np.argsort(key, kind="stable")
    begins = _runs_of(key[order])
    a, b = at[order][:-1], at[order][1:]
    same = np.ones(len(a), bool)
    same[begins[1:] - 1] = False
    if any((hashes[a[same] + k] != hashes[b[same] + k]).any() for k in range(width)):  # two windows of one hash: sort the words themselves
        order = np.lexsort([hashes[at + k] for k in range(width - 1, -1, -1)])
        begins = _runs_of(*(hashes[at[order] + k] for k in range(width)))
    least = np.repeat(np.minimum.reduceat(doc[row[order]], begins), np.diff(np.append(begins, len(order))))
    hit = np.zeros(len(row), bool)
    hit[order] = doc[row[order]] > least
    # Runs of hit windows of one row are one range.
    k = np.flatnonzero(hit)
    found = _merged(doc[row[k]], row[k], (start[row[k]] + offset[k]).astype(np.int32), (start[row[k]] + offset[k] + width).astype(np.int32))
    return pa.table([pa.array(np.concatenate(x)) for x in zip(done, found, strict=True)], schema=_HITS)


def _sent(documents: DataFrame, width: int) -> DataFrame:
    """Rows of _SENT: what goes to each bucket.

    Buckets follow the size of the corpus. Where there are several, hot minimisers are found
    first, in one pass more over the texts, and broken up. A string that several documents of a
    chunk have is sent once, so what very many documents share burdens no bucket.
    """
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = 1 + n_bytes // BUCKET_BYTES
    hot = documents.sparkSession.sparkContext.broadcast(_hot(texts, width, n_bytes) if n_buckets > 1 else np.zeros(0, np.uint64))

    def send(batches):
        zstd = zstandard.ZstdCompressor(level=1)
        for chunk in _chunks(batches, width, hot.value):
            yield _send(chunk, n_buckets, zstd)

    return texts.mapInArrow(send, "bucket long, packed binary, docs binary, starts binary, sizes binary")


def repeated_ranges(documents: DataFrame, width: int = 13) -> DataFrame:
    """(doc_id, ranges): for each doc_id with any, word ranges [start, end) covered by windows that also start in a smaller doc_id.

    ranges has the first and last places of each in turn, as 32-bit numbers; they do not
    overlap. See _sent for the buckets in which windows meet. Words are told apart by 64-bit
    hashes.
    """
    sent = _sent(documents, width)
    hits = sent.groupBy("bucket").applyInArrow(lambda group: _resolve(group, width), "doc_id long, start int, end int")
    return hits.repartition("doc_id").sortWithinPartitions("doc_id", "start").mapInArrow(_by_document, "doc_id long, ranges binary")


_RANGES = pa.schema([("doc_id", pa.int64()), ("ranges", pa.binary())])


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (doc_id, start, end) as a row for each document, in which ranges that touch are one."""

    def rows(doc, start, end, last: bool):
        """A batch of all documents but the last, which may go on, and that one's ranges."""
        group = np.repeat(np.arange(len(begins := _runs_of(doc))), np.diff(np.append(begins, len(doc))))
        reach = np.maximum.accumulate(group << 32 | end) & 0xFFFFFFFF
        doc, start, reach = _merged(doc, doc, start, reach)
        begins = _runs_of(doc)
        stop = len(begins) - (not last)
        pairs, ends = np.stack([start, reach], axis=1).astype(np.int32), np.append(begins[1:], len(doc))
        done = pa.RecordBatch.from_arrays([pa.array(doc[begins[:stop]]), pa.array([pairs[a:b].tobytes() for a, b in zip(begins[:stop].tolist(), ends[:stop].tolist(), strict=True)], pa.binary())], schema=_RANGES)
        return done, [x[begins[stop] :] if stop < len(begins) else x[:0] for x in (doc, start, reach)]

    held = [np.zeros(0, np.int64)] * 3
    for batch in batches:
        held = [np.concatenate((h, c.to_numpy().astype(np.int64))) for h, c in zip(held, batch.columns, strict=True)]
        if len(held[0]):
            done, held = rows(*held, last=False)
            yield done
    if len(held[0]):
        yield rows(*held, last=True)[0]


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def remove_repeats(documents: DataFrame, width: int = 13, digest: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept), a row for each row of documents (doc_id, text).

    Every word covered by a window of `width` words that also starts in a document of smaller
    doc_id is removed; windows are judged on the input. kept is the other words, joined by one
    space, or with `digest` its SHA-256 in hex. Null and empty texts have no words. A null
    doc_id is neither smaller nor larger than any: its document stays whole. Rows of one doc_id
    do not count against each other; a word of one is removed if the window covers its place
    in any of them. Other columns are left alone.
    """
    ranges = materialise(repeated_ranges(documents, width), "ranges")
    size = ranges.agg(F.coalesce(F.sum(F.octet_length("ranges") + 64), F.lit(0))).first()[0]
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    both = texts.join(F.broadcast(ranges) if size <= BROADCAST_BYTES else ranges, "doc_id", "left")

    def cut(batches):
        for batch in batches:
            rows = []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                words = split(text.as_py())
                n = len(words)
                if found:
                    change = np.zeros(n + 1, np.int64)
                    ends = np.frombuffer(found, np.int32).reshape(-1, 2)
                    np.add.at(change, np.minimum(ends[:, 0], n), 1)
                    np.add.at(change, np.minimum(ends[:, 1], n), -1)
                    kept = np.flatnonzero(np.cumsum(change[:n]) == 0).tolist()
                    words = [words[k] for k in kept]
                text = b" ".join(words)
                rows.append((doc_id, n, n - len(words), hashlib.sha256(text).hexdigest() if digest else text.decode()))
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _OUT, strict=True)], schema=_OUT)

    return both.mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")
