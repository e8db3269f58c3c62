"""Embedding near-dedup: Int8 tile products with rigorous error bounds.

A unit vector u is stored as s * q with q of 8 bits; e = |u - s q| is known exactly. The product
of two stored vectors is then within e_a + e_b + e_a e_b of their cosine. Pairs that could reach
the threshold within that bound, and only those, are computed again in double precision. Only
the 8-bit forms go to every tile; the vectors themselves follow where they may link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import connected_components, join_copies, materialise

#: Vectors of a tile, about. A product of two tiles runs in strips of STRIP rows.
TILE = 4096
STRIP = 512
#: Exact products at once.
PAIRS = 1 << 16


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(q, s, e) of unit vectors: 8-bit whole numbers, their scale, and the length of what is lost."""
    scale = np.abs(unit).max(axis=1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(unit - q * scale[:, None], axis=1) + 1e-12


class _Forest:
    """Union-find over the places of a pair of tiles."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def flat(self) -> np.ndarray:
        while (up := self.up[self.up]).tolist() != self.up.tolist():
            self.up = up
        return self.up

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        up = self.flat()
        both = np.unique(np.stack([up[a], up[b]]), axis=1)
        for x, y in both[:, both[0] != both[1]].T.tolist():
            x, y = self.root(x), self.root(y)
            self.up[max(x, y)] = min(x, y)


def candidates(q: np.ndarray, scale: np.ndarray, lost: np.ndarray, n_left: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b), a strip at a time, of all pairs of the first n_left with the others that may reach the threshold; with themselves if all are left.

    The product of two strips is compared once with the loosest bound of each row; what passes
    is held to the bound of its pair.
    """
    wide = np.float32 if q.shape[1] * 127**2 < 1 << 24 else np.float64  # sums of products stay exact
    q, n = q.astype(wide), len(q)
    alone = n_left == n
    first = 0 if alone else n_left
    q_right, s_right, e_right = q[first:].T.copy(), scale[first:].astype(wide), lost[first:]
    for at in range(0, n_left, STRIP):
        strip = slice(at, min(at + STRIP, n_left))
        about = q[strip] @ q_right
        about *= s_right
        loosest = lost[strip] + e_right.max() + lost[strip] * e_right.max() + 1e-5
        a, b = np.nonzero(about >= ((threshold - loosest) / scale[strip]).astype(wide)[:, None])
        e_a, e_b = lost[strip][a], e_right[b]
        ok = about[a, b] * scale[strip][a] >= threshold - (e_a + e_b + e_a * e_b) - 1e-5
        a, b = at + a[ok], first + b[ok]
        yield (a[b > a], b[b > a]) if alone else (a, b)


def link_tiles(ids: np.ndarray, copies: np.ndarray, raw: np.ndarray, n_left: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(links, root place) of each vector, from pairs of the first n_left with the others; with themselves if all are left.

    links counts the rows that the linked vectors stand for (`copies`).
    """
    norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
    n = len(ids)
    links, forest = np.zeros(n, np.int64), _Forest(n)
    for a, b in candidates(*quantise(raw / norm[:, None]), n_left, threshold):
        for k in range(0, len(a), PAIRS):
            x, y = a[k : k + PAIRS], b[k : k + PAIRS]
            exact = np.einsum("ij,ij->i", raw[x], raw[y]) / (norm[x] * norm[y]) >= threshold
            x, y = x[exact], y[exact]
            links += np.bincount(x, copies[y], n).astype(np.int64) + np.bincount(y, copies[x], n).astype(np.int64)
            forest.unite(x, y)
    return links, forest.flat()


def may_link(q: np.ndarray, scale: np.ndarray, lost: np.ndarray, n_left: int, threshold: float) -> np.ndarray:
    """Which vectors may link with another: of the first n_left with one of the others, or of all if all are left."""
    found = np.zeros(len(q), bool)
    for a, b in candidates(q, scale, lost, n_left, threshold):
        found[a] = found[b] = True
    return found


_PLAIN = pa.schema([("vec_id", pa.int64()), ("size", pa.int32()), ("raw", pa.binary()), ("q", pa.binary()), ("scale", pa.float64()), ("lost", pa.float64())])


def _plain(batches):
    """Vectors as bytes of doubles, and their 8-bit form; null where no cosine is defined."""
    for batch in batches:
        rows = []
        for vector in batch.column(1).to_pylist():
            x = np.array([np.nan if v is None else v for v in vector or [np.nan]], np.float64)
            if not np.isfinite(x).all() or not x.any():
                rows.append((None,) * 5)
                continue
            with np.errstate(over="ignore", under="ignore"):
                if not 1e-280 < x @ x < np.inf:  # the square leaves the range of doubles: the direction does not
                    x = x / np.abs(x).max()
            q, scale, lost = quantise((x / np.sqrt(x @ x))[None])
            rows.append((len(x), x.tobytes(), q.tobytes(), float(scale[0]), float(lost[0])))
        columns = zip(*rows, strict=True) if rows else [[]] * 5
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, f.type) for c, f in zip(columns, list(_PLAIN)[1:], strict=True))], schema=_PLAIN)


_LINKS = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row for each row of embeddings (vec_id, embedding).

    n_links: other rows with cosine >= threshold. component_id: smallest vec_id reachable by
    links, itself included. kept: vec_id = component_id. Vectors that are null, empty, zero, or
    hold null or non-finite parts link with nothing, as do vectors of different length, and rows
    with a null vec_id, which come back with a null component and kept false.

    Equal vectors are compared once, however many there are. The others are dealt to tiles of
    some TILE vectors, and every pair of tiles is one task's work: the 8-bit form of each vector
    goes to as many tasks as there are tiles, the vector itself to those where it may link. A
    task returns a row for each vector at most, never its pairs.
    """
    rows = materialise(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(_plain, "vec_id long, size int, raw binary, q binary, scale double, lost double").withColumn("key", F.md5("raw")), "vectors")
    kept = [F.min(c).alias(c) for c in ("raw", "size", "q", "scale", "lost")]  # equal in all rows of a key
    groups = rows.where("vec_id IS NOT NULL AND raw IS NOT NULL").groupBy("key").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), *kept)
    groups = materialise(groups, "distinct")
    n_tiles = -(-max(groups.count(), 1) // TILE)
    # A vector's pairs of tiles: its own with every tile, the smaller first.
    tile = F.pmod(F.xxhash64("id", "key"), F.lit(n_tiles))
    dealt = groups.select("id", "size", "q", "scale", "lost", tile.alias("tile")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1)).cast("array<long>")))
    dealt = dealt.withColumn("a", F.least("tile", "other")).withColumn("b", F.greatest("tile", "other"))

    def sides(group: pa.Table) -> tuple[np.ndarray, int] | None:
        """The rows of tile a before those of tile b, and how many; None if one side is empty."""
        left = group["tile"].to_numpy() == group["a"].to_numpy()
        n_left = int(left.sum())
        if n_left == len(left) and group["a"][0].as_py() != group["b"][0].as_py() or n_left == 0:
            return None
        return np.argsort(~left, kind="stable"), n_left

    def near(group: pa.Table) -> pa.Table:
        if not (both := sides(group)):
            return group.select(["id", "size", "tile", "a", "b"]).slice(0, 0)
        order, n_left = both
        q = np.frombuffer(b"".join(group["q"].to_pylist()), np.int8).reshape(group.num_rows, -1)
        found = may_link(q[order], group["scale"].to_numpy()[order], group["lost"].to_numpy()[order], n_left, threshold)
        return group.select(["id", "size", "tile", "a", "b"]).take(pa.array(order[found]))

    def links(group: pa.Table) -> pa.Table:
        if not (both := sides(group)):
            return pa.table([[], [], []], schema=_LINKS)
        order, n_left = both
        ids, copies = group["id"].to_numpy()[order], group["copies"].to_numpy()[order]
        raw = np.frombuffer(b"".join(group["raw"].to_pylist()), np.float64).reshape(len(ids), -1)[order]
        found, root = link_tiles(ids, copies, raw, n_left, threshold)
        # The smallest id of each local component stands for it.
        least = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(least, root, ids)
        some = np.flatnonzero(found)
        return pa.table([pa.array(ids[some]), pa.array(found[some]), pa.array(least[root[some]])], schema=_LINKS)

    met = materialise(dealt.select("id", "size", "q", "scale", "lost", "tile", "a", "b").groupBy("size", "a", "b").applyInArrow(near, "id long, size int, tile long, a long, b long"), "near")
    met = met.join(groups.select("id", "copies", "raw"), "id")
    found = materialise(met.groupBy("size", "a", "b").applyInArrow(links, "id long, links long, root long"), "links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.select("id", "root"))
    each = groups.select("key", "id", "copies").join(counts, "id", "left").join(components.withColumnRenamed("node", "id"), "id", "left")
    each = each.select("key", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    whole = join_copies(rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("key")).alias("key")), each)
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
