"""Packing of documents into sequences of one length, by shortest-pack-first over the length histogram.

Lengths are placed longest first, each into the packs with most room left, on counts alone: a
plan of a few thousand steps stands for any number of documents. Documents then find their
places by their rank among those of their length.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewire.llm.common import materialise
from tidewire.llm.words import word_places

#: Words whose ids a worker keeps, some 150 bytes each.
KEPT_WORDS = 1 << 20
#: Rows (24 bytes each) up to which the first ranks of the tasks are broadcast; beyond, they are joined by shuffle.
BROADCAST_ROWS = 1 << 20


class Plan:
    """Where the pieces of each length go.

    counts[n] is how many pieces have n tokens, n <= length. There are as many packs as the
    tokens fill, and one for each power of two in what is left over, so that no pack is padded.
    A piece goes to a pack with most room; one that is longer than that room is cut, fills the
    pack, and its rest waits among the pieces of the rest's length.

    A step is: the pieces of length `bin` whose ranks are lo, lo + 1, ... (n of them) put `take`
    tokens, from their token `start` on, at `offset` of the sequences first, first + 1, ...
    """

    def __init__(self, counts: np.ndarray, length: int):
        total = sum(n * int(c) for n, c in enumerate(counts))
        rooms: list[list[tuple[int, int, int]]] = [[] for _ in range(length + 1)]  # (first sequence, how many, offset)
        rooms[length].append((0, total // length, 0))
        self.sequences = total // length
        for k in range(length.bit_length()):
            if total % length >> k & 1:
                rooms[1 << k].append((self.sequences, 1, 0))
                self.sequences += 1
        waiting: list[list[tuple[int, int, int, int]]] = [[(n, 0, int(c), 0)] if c else [] for n, c in enumerate(counts)]
        steps, top = [], length
        for size in range(length, 0, -1):
            for bin_, lo, count, start in waiting[size]:
                while count:
                    while not rooms[top]:
                        top -= 1
                    first, packs, offset = rooms[top].pop()
                    n, take = min(count, packs), min(size, top)
                    if not n:
                        continue
                    if packs > n:
                        rooms[top].append((first + n, packs - n, offset))
                    if top > take:
                        rooms[top - take].append((first, n, offset + take))
                    if size > take:
                        waiting[size - take].append((bin_, lo, n, start + take))
                    steps.append((bin_, lo, n, start, take, first, offset))
                    lo, count = lo + n, count - n
            waiting[size] = []
        table = np.array(steps, np.int64).reshape(-1, 7)
        table = table[np.lexsort((table[:, 1], table[:, 3], table[:, 0]))]
        self.bin, self.lo, self.n, self.start, self.take, self.first, self.offset = table.T
        self.length = length
        # Steps of one bin and start share no rank; the last one whose lo is not above a rank has it.
        self.kinds, kind = np.unique(self.bin * (length + 1) + self.start, return_inverse=True)
        self.begins = np.searchsorted(kind, np.arange(len(self.kinds) + 1))

    def find(self, bins: np.ndarray, ranks: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The step that places token `starts` on of each piece."""
        kind = np.searchsorted(self.kinds, bins * (self.length + 1) + starts)
        low, high = self.begins[kind], self.begins[kind + 1] - 1
        while (open_ := low < high).any():  # bisection of all at once
            middle = (low + high + 1) // 2
            right = self.lo[middle] <= ranks
            low, high = np.where(open_ & right, middle, low), np.where(open_ & ~right, middle - 1, high)
        return low


class Encoder:
    """Token ids of texts as bytes, 2 a token where the vocabulary allows, else 4.

    by_word: the tokenizer lower-cases, drops ASCII white space, lets nothing reach across it,
    takes runs of letters and of marks apart, and marks the last token of each by </w>. The ids
    of a text are then those of its words, which are looked up; new ones are encoded together.
    """

    def __init__(self, path: str, by_word: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype(id_type(self.tokenizer.get_vocab_size()))
        self.by_word, self.known = by_word, {}
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.ends[k] = token.endswith("</w>")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)

    def _of_words(self, words: list[bytes]) -> list[bytes]:
        if not words:
            return []
        ids = self._ids(b" ".join(words).decode("utf-8", "replace"))
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):  # some word is several runs; none has no token
            half = len(words) // 2
            return self._of_words(words[:half]) + self._of_words(words[half:]) if half else [ids.tobytes()]
        raw, stops = ids.tobytes(), (stops * self.kind.itemsize).tolist()
        return [raw[i:j] for i, j in zip([0, *stops[:-1]], stops, strict=True)]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words that are not known; marks at the end, which are a run of their own, go apart."""
        missing = [w for w in words if w not in self.known]
        if len(self.known) + len(missing) > KEPT_WORDS:
            self.known, missing = {}, words
        cut = {w: (w[: m.start()], m[0]) for w in missing if (m := _TAIL.search(w))}
        new = {x for w in missing for x in cut.get(w, (w,))}.difference(self.known)
        plain = [w for w in new if _PLAIN.fullmatch(w)]
        for k in range(0, len(plain), 1000):
            self.known.update(zip(plain[k : k + 1000], self._of_words(plain[k : k + 1000]), strict=True))
        for w in new.difference(plain):
            self.known[w] = self._ids(w.decode("utf-8", "replace")).tobytes()
        self.known.update({w: self.known[a] + self.known[b] for w, (a, b) in cut.items()})

    def __call__(self, texts: list[str]) -> list[bytes]:
        if not self.by_word:
            return [self._ids(x).tobytes() for x in texts]
        raws = [x.encode("utf-8", "replace") for x in texts]
        # Case matters in special tokens alone.
        whole = b"\n".join(x if b"<|" in x else x.lower() for x in raws)
        hashes, start, end = word_places(whole)
        _, first, word = np.unique(hashes, return_index=True, return_inverse=True)
        size = end - start
        if not self._same(whole, start, size, first[word]):  # two words of one hash: tell them apart by themselves
            number: dict[bytes, int] = {}
            word = np.array([number.setdefault(w, len(number)) for w in whole.split()])
            first = np.unique(word, return_index=True)[1]
        words = [whole[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        self._learn(words)
        found = [self.known[w] for w in words]
        ids = np.frombuffer(b"".join(found), self.kind)
        n = np.array([len(x) for x in found], np.int64) // self.kind.itemsize
        counts = n[word]
        ids = ids[np.repeat((np.cumsum(n) - n)[word] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
        last = np.searchsorted(start, np.cumsum([len(x) + 1 for x in raws]))
        stops = np.concatenate(([0], np.cumsum(counts)))[last].tolist()
        return [ids[a:b].tobytes() for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    @staticmethod
    def _same(whole: bytes, start: np.ndarray, size: np.ndarray, like: np.ndarray) -> bool:
        """Whether each word has the bytes of the word `like`."""
        if (size != size[like]).any():
            return False
        raw, step = np.frombuffer(whole, np.uint8), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return bool((raw[np.repeat(start, size) + step] == raw[np.repeat(start[like], size) + step]).all())


#: Marks at the end of a word, which are a token run of their own behind a letter or digit.
_TAIL = re.compile(rb"(?<=[A-Za-z0-9])[.,;:!?]+\Z")
#: Words that are most likely one run: letters of ASCII and of other two-byte characters.
_PLAIN = re.compile(rb"(?:[A-Za-z]|[\xc3-\xc9][\x80-\xbf])+")


@functools.cache
def encoder(path: str, by_word: bool) -> Encoder:
    """One for a worker, which keeps its words from task to task."""
    return Encoder(path, by_word)


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


_IDS = pa.schema([("task", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("fulls", pa.int64()), ("bin", pa.int32()), ("nth", pa.int64())])


#: Bytes of text encoded together.
TOGETHER = 8 << 20


def _some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch (doc_id, text) in slices of some TOGETHER bytes."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + TOGETHER, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def tokenized(documents: DataFrame, tokenizer: str, length: int, end_id: int, by_word: bool) -> DataFrame:
    """A row for each document: its ids with end_id behind them, and its rank within its task.

    fulls: pieces of full length in earlier documents of the task. bin: tokens beyond its own
    full pieces; nth: earlier documents of the task with that bin.
    """

    def encode(batches):
        encoded = encoder(tokenizer, by_word)
        end, width = np.array([end_id], encoded.kind).tobytes(), encoded.kind.itemsize
        task, fulls, seen = TaskContext.get().partitionId(), 0, np.zeros(length, np.int64)
        for batch in batches:
            for some in _some(batch):
                rows = []
                for doc_id, ids in zip(some.column(0).to_pylist(), encoded([x or "" for x in some.column(1).to_pylist()]), strict=True):
                    n = len(ids) // width + 1
                    rows.append((task, doc_id, ids + end, n, fulls, n % length, int(seen[n % length])))
                    fulls += n // length
                    seen[n % length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _IDS, strict=True)], schema=_IDS)

    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(encode, "task int, doc_id long, ids binary, doc_tokens long, fulls long, bin int, nth long")


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _pieces(plan: Plan, batch: pa.RecordBatch, kind: np.dtype) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of (doc_id, ids, doc_tokens, full_rank, bin, rank)."""
    n, full_rank, bins, rank = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2, 6))
    fulls = n // plan.length
    whole = np.repeat(np.arange(len(n)), fulls)
    nth = np.arange(len(whole)) - np.repeat(np.cumsum(fulls) - fulls, fulls)
    rest = np.flatnonzero(bins)
    # What is to be placed: (row, its first token, length, rank).
    row = np.concatenate((whole, rest))
    base = np.concatenate((nth * plan.length, fulls[rest] * plan.length))
    size = np.concatenate((np.full(len(whole), plan.length), bins[rest]))
    ranks = np.concatenate((full_rank[whole] + nth, rank[rest]))
    done, parts = np.zeros(len(row), np.int64), []
    while len(row):
        step = plan.find(size, ranks, done)
        parts.append((row, base + done, plan.take[step], plan.first[step] + ranks - plan.lo[step], plan.offset[step]))
        done = done + plan.take[step]
        more = done < size
        row, base, size, ranks, done = (x[more] for x in (row, base, size, ranks, done))
    if not parts:
        return
    row, start, take, sequence, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((start, row))
    row, start, take, sequence, offset = (x[order] for x in (row, start, take, sequence, offset))
    ids, at = batch.column(1), 0
    while at < len(row):  # batches of some 2 million tokens
        stop = max(at + 1, int(np.searchsorted(np.cumsum(take[at:]), 1 << 21)) + at)
        held, pieces = (-1, b""), []
        for r, a, b in zip(row[at:stop].tolist(), start[at:stop].tolist(), (start + take)[at:stop].tolist(), strict=True):
            if held[0] != r:
                held = r, np.frombuffer(ids[r].as_buffer(), kind)
            pieces.append(held[1][a:b].astype("<u4").tobytes())
        some = pa.array(row[at:stop])
        columns = batch.column(0).take(some), start[at:stop], take[at:stop], pieces, batch.column(2).take(some), sequence[at:stop], offset[at:stop]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES)
        at = stop


def pack(documents: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, by_word: bool = True) -> DataFrame:
    """Pieces of documents (doc_id, text) in sequences of at most `length` tokens: see PIECES.

    tokenizer: the file of a vocabulary, at that path on every machine; by_word: see Encoder. A
    document's tokens are those of its text and end_id; a null text has end_id alone. Documents
    longer than `length` are cut into full pieces and a rest; further cuts fill sequences, all
    of which are full but for at most one of each smaller power of two. Every row is a document
    of its own, of whatever doc_id, null too. ids are 32-bit little-endian. An empty table has
    no pieces; other columns are left alone.
    """
    spark = documents.sparkSession
    kind = encoder(tokenizer, by_word).kind
    ids = materialise(tokenized(documents, tokenizer, length, end_id, by_word), "ids", compression="zstd")
    # Ranks over all tasks: what each task has of each length, summed over the tasks before it.
    rests = ids.where("bin > 0").groupBy("task", "bin").agg(F.count("*").alias("n"))
    fulls = ids.groupBy("task").agg(F.sum(F.floor(F.col("doc_tokens") / length)).alias("n")).select("task", F.lit(length).alias("bin"), "n")
    before = F.sum("n").over(Window.partitionBy("bin").orderBy("task")) - F.col("n")
    firsts = materialise(rests.unionByName(fulls).withColumn("first", before), "ranks")
    histogram = np.zeros(length + 1, np.int64)
    for r in firsts.groupBy("bin").agg(F.sum("n").alias("n")).collect():  # a row for each length
        histogram[r["bin"]] = r["n"]
    plan = spark.sparkContext.broadcast(Plan(histogram, length))
    small = firsts.count() <= BROADCAST_ROWS
    of_full = firsts.where(F.col("bin") == length).select("task", F.col("first").alias("first_full"))
    of_rest = firsts.where(F.col("bin") < length).select("task", "bin", F.col("first").alias("first_rest"))
    placed = ids.join(F.broadcast(of_full) if small else of_full, "task", "left").join(F.broadcast(of_rest) if small else of_rest, ["task", "bin"], "left")
    ranked = placed.select("doc_id", "ids", "doc_tokens", (F.col("first_full") + F.col("fulls")).alias("full_rank"), "bin", F.coalesce(F.col("first_rest") + F.col("nth"), F.lit(0)).alias("rank"))

    def place(batches):
        for batch in batches:
            yield from _pieces(plan.value, batch, kind)

    return ranked.mapInArrow(place, PIECES)


_SEQUENCES = pa.schema([("sequence_id", pa.int64()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))])


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, lengths): the sequences themselves, with the documents and lengths of their pieces in order."""

    def join(batches):
        held, rows = None, []
        for batch in batches:
            for sequence, _, doc_id, n, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held[0] != sequence:
                    if held is not None:
                        rows.append((held[0], b"".join(held[1]), held[2], held[3]))
                    held = (sequence, [], [], [])
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEQUENCES, strict=True)], schema=_SEQUENCES)
                        rows = []
                held[1].append(ids), held[2].append(doc_id), held[3].append(n)
        if held is not None:
            rows.append((held[0], b"".join(held[1]), held[2], held[3]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _SEQUENCES, strict=True)], schema=_SEQUENCES)

    dealt = pieces.select("sequence_id", "offset", "doc_id", "length", "ids").repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return dealt.mapInArrow(join, "sequence_id long, ids binary, doc_ids array<long>, lengths array<long>")
