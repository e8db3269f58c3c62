"""Fuzzy line dedup: MinHash over character shingles, exact Jaccard, union-find."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.blocks import link_blocks
from tidewire.llm.common import connected_components, map_arrow, materialise
from tidewire.llm.words import distinct, mixed

#: Characters of a shingle: so many that unrelated lines share next to none.
SHINGLE = 8
#: Bands of ROWS least hashes each. Lines of Jaccard 0.8 meet in a band with chance 0.995, of 0.9 with 0.9999.
BANDS, ROWS = 10, 4
#: Shingles from which a line fills the bins of one permutation.
LONG = 160
#: Keys that are broadcast to pick lines, at some 70 bytes each; beyond, lines are joined by shuffle.
BROADCAST_KEYS = 1 << 20
BROADCAST_BYTES = 32 << 20

_rng = np.random.default_rng(11)
_SCALE = (_rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def normal(line: str) -> str:
    """Lower case, white space as single spaces, none at the ends; lines compare in this form."""
    return " ".join(line.lower().split())


def key_of(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace")) - (1 << 63)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every SHINGLE characters of normal lines, one after another, and how many each has; a shorter line has one hash of it all."""
    lengths = np.array([len(x) for x in lines], np.int64)
    c = np.frombuffer("".join([*lines, " " * SHINGLE]).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    x = c[:-1] * np.uint64(0x9E3779B97F4A7C15) + c[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    x = x[:-2] * np.uint64(0x165667B19E3779F9) + x[2:]
    x = mixed(x[:-4] * np.uint64(0xD6E8FEB86659FD93) + x[4:])
    sizes = np.maximum(lengths - SHINGLE + 1, 1)
    starts = np.cumsum(sizes) - sizes
    out = x[np.arange(int(sizes.sum())) + np.repeat(np.cumsum(lengths) - lengths - starts, sizes)]
    short = np.flatnonzero(lengths < SHINGLE)
    out[starts[short]] = np.array([key_of(lines[k]) + (1 << 63) for k in short.tolist()], np.uint64)
    return out, sizes


def shingle_set(line: bytes) -> np.ndarray:
    return distinct(shingle_hashes([line.decode()])[0])


def shingle_sets(packed: list[bytes]) -> list[np.ndarray]:
    """shingle_set of each line, hashed many at a time."""
    lines, out = [x.decode() for x in packed], []
    for at, end in _blocks(lines):
        x, sizes = shingle_hashes(lines[at:end])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            x[a:b].sort()
        new = np.concatenate(([True], x[1:] != x[:-1]))
        new[starts] = True
        x, ends = x[new], np.cumsum(new)[ends - 1].tolist()
        out += [x[a:b] for a, b in zip([0, *ends], ends, strict=False)]
    return out


def _bands(least: np.ndarray, first: int) -> np.ndarray:
    """Hashes of ROWS least hashes each; `first` tells the bands of one scheme from another's."""
    out = np.zeros((len(least), BANDS), np.uint64)
    for band in range(BANDS):
        total = np.full(len(least), first + band + 1, np.uint64)
        for k in range(band * ROWS, (band + 1) * ROWS):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
        out[:, band] = total
    return out


def _permuted(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The least hash of each line under each of BANDS * ROWS permutations."""
    x, starts = (x >> np.uint64(32)).astype(np.uint32), np.cumsum(sizes) - sizes
    return np.stack([np.minimum.reduceat(x * scale, starts) for scale in _SCALE], axis=1)


def _one_permutation(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The least hash of each line in each of BANDS * ROWS bins of one permutation; an empty bin takes the next one's."""
    bins = BANDS * ROWS
    row = np.repeat(np.arange(len(sizes)), sizes)
    least = np.full(len(sizes) * bins, 1 << 32, np.uint64)
    np.minimum.at(least, row * bins + ((x & np.uint64(0xFFFFFFFF)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64), x >> np.uint64(32))
    least = least.reshape(-1, bins)
    for _ in range(bins):
        empty = least == 1 << 32
        if not empty.any():
            break
        least = np.where(empty, np.roll(least, -1, axis=1), least)
    return least


def _n_distinct(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Distinct shingles of each line, told apart by 48 bits; of fewer than 65,536 lines."""
    row = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
    both = np.sort(row << np.uint64(48) | x >> np.uint64(16))
    return np.bincount((both[np.concatenate(([True], both[1:] != both[:-1]))] >> np.uint64(48)).astype(np.int64), minlength=len(sizes))


#: Slots to which the shingles of a line are dealt.
SLOTS = 1 << 10


def _n_slots(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """In how many of SLOTS slots the shingles of each line fall: as many distinct shingles it has at least."""
    filled = np.zeros((len(sizes), SLOTS), bool)
    filled.ravel()[np.repeat(np.arange(len(sizes)) * SLOTS, sizes) + (x >> np.uint64(54)).astype(np.int64)] = True
    return filled.sum(axis=1)


def _blocks(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Consecutive lines whose hashes stay in cache, as (first, one after the last)."""
    at = 0
    while at < len(lines):
        end, size = at, 0
        while end < len(lines) and (end == at or size + len(lines[end]) <= 1 << 15):
            size += len(lines[end])
            end += 1
        yield at, end
        at = end


def band_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Band hashes of normal lines, one after another, and how many each has: BANDS, or twice as many.

    Lines of up to LONG distinct shingles are permuted BANDS * ROWS times; those of 0.8 LONG and
    more have one permutation in as many bins, which they fill. Lines of similarity 0.8 differ in
    size by no more than that, so any two share a scheme; lines between the two have both.
    """
    least: list[list[np.ndarray]] = [[], []]
    place: list[list[np.ndarray]] = [[], []]
    for at, end in _blocks(lines):
        x, sizes = shingle_hashes(lines[at:end])
        starts, n = np.cumsum(sizes) - sizes, sizes.copy()
        # Repeats do not change a least hash, but may change the scheme.
        long = np.flatnonzero(sizes >= 0.8 * LONG)
        if len(long):
            some = np.repeat(sizes >= 0.8 * LONG, sizes)
            n[long] = _n_slots(x[some], sizes[long])
            # Only of lines with few slots filled the number itself matters.
            close = long[n[long] <= LONG]
            if len(close):
                n[close] = _n_distinct(np.concatenate([x[starts[k] : starts[k] + sizes[k]] for k in close.tolist()]), sizes[close])
        for k, (scheme, fits) in enumerate(((_permuted, n <= LONG), (_one_permutation, n >= 0.8 * LONG))):
            if fits.any():
                least[k].append(scheme(x[np.repeat(fits, sizes)], sizes[fits]).astype(np.uint64))
                place[k].append(at + np.flatnonzero(fits))
    bands = [_bands(np.concatenate(rows), first) for rows, first in zip(least, (0, BANDS), strict=True) if rows]
    places = np.concatenate([np.concatenate(p) for p in place if p]) if bands else np.zeros(0, np.int64)
    order = np.argsort(places, kind="stable")
    found = np.concatenate([*bands, np.zeros((0, BANDS), np.uint64)])[order]
    return found.view(np.int64).ravel(), BANDS * np.bincount(places, minlength=len(lines))


def jaccard(threshold: float) -> Callable[[list[np.ndarray]], Callable[[np.ndarray], list[int]]]:
    """index_of for link_blocks: exact Jaccard with every set of a fitting size."""

    def index_of(sets: list[np.ndarray]) -> Callable[[np.ndarray], list[int]]:
        # By size, so that those of a size that can link are one range.
        by_size = sorted(range(len(sets)), key=lambda k: len(sets[k]))
        lengths = [len(sets[k]) for k in by_size]
        sizes = np.array(lengths, np.int64)
        tokens = np.concatenate([*(sets[k] for k in by_size), np.zeros(0, np.uint64)])
        starts = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)

        def search(query: np.ndarray) -> list[int]:
            n = len(query)
            # The least of two sizes is their largest intersection, and the greatest their smallest union.
            a, b = bisect_left(lengths, threshold * n - 1e-6), bisect_right(lengths, (n + 1e-6) / threshold)
            if a == b or not n:
                return []
            some, begin = tokens[starts[a] : starts[b]], starts[a:b] - starts[a]
            held = query[np.minimum(np.searchsorted(query, some), n - 1)] == some
            both = np.add.reduceat(held, begin, dtype=np.int64)
            return [by_size[a + k] for k in np.flatnonzero(both >= threshold * (sizes[a:b] + n - both) - 1e-9).tolist()]

        return search

    return index_of


_LINES = pa.schema([("doc_id", pa.int64()), ("line", pa.int32()), ("key", pa.int64()), ("bands", pa.list_(pa.int64())), ("normal", pa.string())])


def _lines(batches):
    """Lines that are not blank; the first of each key in a task has its bands and its normal form."""
    seen: set[int] = set()
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            ids, numbers, keys, new, place = [], [], [], [], []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                for k, line in enumerate(text.split("\n")) if text and doc_id is not None else ():
                    if line := normal(line):
                        key = key_of(line)
                        if key not in seen:
                            if len(seen) > 1_000_000:
                                seen.clear()
                            seen.add(key)
                            new.append(line), place.append(len(keys))
                        ids.append(doc_id), numbers.append(k), keys.append(key)
            bands, counts = band_hashes(new)
            texts: list = [None] * len(keys)
            sizes = np.zeros(len(keys), np.int32)
            sizes[place] = counts
            for p, line in zip(place, new, strict=True):
                texts[p] = line
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)), pa.array(bands))
            columns = [pa.array(c, f.type) for c, f in zip((ids, numbers, keys), _LINES, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, lists, pa.array(texts, pa.string())], schema=_LINES)


def repeated_lines(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, lines): the numbers, from 0, of lines that repeat an earlier one, for documents with any.

    Lines are compared in their `normal` form; blank lines never repeat. Two link at a Jaccard
    similarity of character shingles >= threshold. Of each component the line of the smallest
    (doc_id, number) stays.
    """
    known = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    lines = materialise(map_arrow(known, _lines, "doc_id long, line int, key long, bands array<long>, normal string"), "lines")
    banded = lines.where("normal IS NOT NULL").select("key", F.explode("bands").alias("band"))
    # The least key leads a band; a map-side minimum finds it, however many lines meet there.
    heads = banded.groupBy("band").agg(F.min("key").alias("lead"), F.max("key").alias("last")).where("lead <> last").drop("last")
    heads = materialise(heads, "heads")
    if heads.count() <= BROADCAST_KEYS:
        heads = F.broadcast(heads)
    blocks = materialise(banded.join(heads, "band").where("lead <> key").select("lead", "key").distinct(), "blocks")
    wanted = materialise(blocks.select("key").union(blocks.select("lead")).distinct(), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_KEYS else wanted
    texts = lines.where("normal IS NOT NULL").join(wanted, "key", "left_semi")
    texts = texts.select("key", F.length("normal").cast("long").alias("n"), F.col("normal").cast("binary").alias("tokens"))
    tokens = materialise(texts.dropDuplicates(["key"]), "tokens")
    components = connected_components(link_blocks(blocks, tokens, jaccard(threshold), shingle_sets))
    rooted = lines.select("doc_id", "line", "key").join(components.withColumnRenamed("node", "key"), "key", "left")
    rooted = rooted.select("doc_id", "line", F.coalesce("component", "key").alias("root"))
    at = F.struct("doc_id", "line")
    first = materialise(rooted.groupBy("root").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first <> last").drop("last"), "first")
    return rooted.join(first, "root").where(at != F.col("first")).groupBy("doc_id").agg(F.collect_set("line").alias("lines"))


def _with_removed(documents: DataFrame, threshold: float) -> tuple[DataFrame, str]:
    """documents beside the numbers of their repeated lines, in a column whose name none of them has."""
    removed = materialise(repeated_lines(documents, threshold), "removed")
    size = removed.agg(F.coalesce(F.sum(F.size("lines") * 4 + 24), F.lit(0))).first()[0]
    gone = "_".join(["gone", *documents.columns])
    removed = removed.select(F.col("doc_id").alias(f"{gone}_id"), F.col("lines").alias(gone))
    return documents.join(F.broadcast(removed) if size <= BROADCAST_BYTES else removed, F.col("doc_id") == F.col(f"{gone}_id"), "left"), gone


def _kept(gone: str):
    """The lines that stay, joined by newlines. The time is linear in the text."""
    at = F.array_sort(F.col(gone))
    gap = F.zip_with(at, F.concat(F.array(F.lit(-1)), at), lambda k, before: k - before)
    # Marks up to the last line that goes; each gap ends in one. Lines without a mark stay.
    marks = F.flatten(F.transform(F.slice(gap, 1, F.size(gone)), lambda n: F.concat(F.array_repeat(F.lit(False), n - 1), F.array(F.lit(True)))))
    # A text is split once: what stands beyond its last line, of another row's marks, is null and goes as well.
    return F.array_join(F.zip_with(F.split("text", "\n", -1), marks, lambda x, mark: F.when(F.coalesce(mark, F.lit(False)), F.lit(None)).otherwise(x)), "\n")


def without_repeated_lines(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows and columns of documents, each text without the lines that repeated_lines names.

    The lines that stay are joined by newlines; an emptied text is empty, a null one stays null.
    """
    both, gone = _with_removed(documents, threshold)
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(_kept(gone))
    return both.withColumn("text", text).select(documents.columns)


def dedup_lines(documents: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_lines, n_removed, text), a row for each row of documents (doc_id, text).

    text has the lines that stay, joined by newlines; the other columns count. A null text stays
    null, of 0 lines; an empty one has one blank line, and blank lines stay. Lines of a null
    doc_id are not compared. Rows of one doc_id count as one document: a line number removed in
    one goes in all. See repeated_lines for what repeats; an emptied document keeps an empty text.
    """
    both, gone = _with_removed(documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), threshold)
    # Line ends are counted, no line made.
    n = F.when(F.col("text").isNull(), 0).otherwise(1 + F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))))
    gone_here = F.when(F.col("text").isNull() | F.col(gone).isNull(), 0).otherwise(F.size(F.filter(gone, lambda k: k < n)))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(_kept(gone))
    return both.select("doc_id", n.cast("long").alias("n_lines"), gone_here.cast("long").alias("n_removed"), text.alias("text"))
