"""Hard negatives: candidates of another label whose inner product lies in a window below a positive's.

Anchors and candidates are dealt into cells of bounded size; a cell multiplies its tiles of whole
numbers by Strassen's recursion and keeps a heap of the best positives (first pass), then, when all
positives are known, a heap per window (second pass).  Heaps of two tiles, or of two cells, merge
into the heap of both, so no task sees all candidates of an anchor.

Arithmetic is exact: cells whose products may leave 64 bits are computed with Python's integers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import stored

#: Rows of a cell, and of the tiles that it multiplies at a time.
ANCHOR_CELL, CANDIDATE_CELL = 8192, 4096
ANCHOR_TILE, CANDIDATE_TILE = 512, 2048
#: Rows with components from here on have (smaller) cells of their own, so that the others stay with 64 bits.
LARGE, LARGE_CELL = 8192.0, 64
#: A side at which the recursion ends.
LEAF = 16
_ROOM = 1 << 62
#: Scores beyond 64 bits count as the nearest of these.
LEAST, MOST = -(1 << 63) + 1, (1 << 63) - 1


@dataclass(frozen=True)
class Settings:
    """``positives`` per anchor and ``negatives`` per positive; a negative's score lies between ``low`` and
    ``high`` percent of the positive's.  ``scale``: components become floor(scale * x)."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256


def quantised(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64, or Python integers if one doesn't fit; ``scale`` is a power of two, so nothing rounds before."""
    with np.errstate(over="ignore"):
        whole = np.floor(flat * scale)
    if not len(flat) or np.abs(whole).max() < _ROOM:
        return whole.astype(np.int64)
    return np.array([int(w) if np.isfinite(w) else int(x) * scale for w, x in zip(whole.tolist(), flat.tolist())], object)


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of small inner side: one outer product added after the other."""
    c = a[:, :1] * b[:1]
    for k in range(1, a.shape[1]):
        c += a[:, k, None] * b[k]
    return c


def _even(a: np.ndarray) -> np.ndarray:
    """With a row or column of zeros where a side is odd."""
    n, m = a.shape
    if n % 2 == 0 and m % 2 == 0:
        return a
    padded = np.zeros((n + n % 2, m + m % 2), a.dtype)
    padded[:n, :m] = a
    return padded


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` by seven products of halves; odd sides get a row or column of zeros."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= leaf:
        return _leaf(a, b) if k else np.zeros((n, m), a.dtype)
    a, b = _even(a), _even(b)
    i, j, l = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :l], b[:j, l:], b[j:, :l], b[j:, l:]
    c = np.empty((2 * i, 2 * l), a.dtype)
    c11, c12, c21, c22 = c[:i, :l], c[:i, l:], c[i:, :l], c[i:, l:]
    p = strassen(a11 + a22, b11 + b22, leaf)
    c11[:], c22[:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    c21[:] = p
    c22 -= p
    p = strassen(a11, b12 - b22, leaf)
    c12[:] = p
    c22 += p
    p = strassen(a22, b21 - b11, leaf)
    c11 += p
    c21 += p
    p = strassen(a11 + a12, b22, leaf)
    c11 -= p
    c12 += p
    c22 += strassen(a21 - a11, b11 + b12, leaf)
    c11 += strassen(a12 - a22, b21 + b22, leaf)
    return c[:n, :m]


def _none(dtype: np.dtype) -> int:
    """Smaller than every key."""
    return -(1 << 63) if dtype != object else -(1 << 200)


class Heaps:
    """The ``size`` largest keys of each row.  Heaps over two sets of candidates merge into those over both."""

    def __init__(self, rows: int, size: int, dtype: np.dtype):
        self.size, self.keys = size, np.full((rows, size), _none(dtype), dtype)

    def merge(self, at: slice, keys: np.ndarray) -> None:
        """Takes further keys of rows ``at``."""
        if keys.shape[1] > self.size and keys.dtype != object:
            keys = np.partition(keys, keys.shape[1] - self.size, axis=1)[:, -self.size :]
        both = np.concatenate([self.keys[at], keys], axis=1)
        both.sort(axis=1)
        self.keys[at] = both[:, -self.size :]


class Side:
    """Rows of one side of a cell; vectors of different length are padded with zeros."""

    def __init__(self, table: pa.Table, scale: int):
        self.table, column = table, table.column("vec").combine_chunks()
        self.flat = quantised(np.asarray(column.flatten(), np.float64), scale)
        self.lengths = np.diff(np.asarray(column.offsets)) if table.num_rows else np.zeros(0, np.int64)
        self.uid, self.label = table.column("uid").to_numpy(), table.column("label").to_numpy()
        self.most = max(abs(int(self.flat.max())), abs(int(self.flat.min()))) if len(self.flat) else 0

    def matrix(self, width: int, dtype: np.dtype) -> np.ndarray:
        out = np.zeros((len(self.lengths), width), dtype)
        out[np.arange(width) < self.lengths[:, None]] = self.flat
        return out


class Cell:
    """One cell: anchors against candidates, which lie in the order that decides among equal scores."""

    def __init__(self, anchors: pa.Table, candidates: pa.Table, scale: int):
        order = pc.sort_indices(candidates, sort_keys=[("id", "ascending"), ("uid", "ascending")], null_placement="at_end")
        self.left, self.right = Side(anchors, scale), Side(candidates.take(order), scale)
        width = int(max([1, *self.left.lengths, *self.right.lengths]))
        self.n, self.m = len(self.left.uid), len(self.right.uid)
        self.bound = width * self.left.most * self.right.most + 1  # above every score
        fits = self.bound * 2 * max(1, self.m) < _ROOM
        self.dtype = np.dtype(np.int64) if fits and object not in (self.left.flat.dtype, self.right.flat.dtype) else np.dtype(object)
        self.a, self.b = self.left.matrix(width, self.dtype), self.right.matrix(width, self.dtype).T

    def tiles(self):
        """Anchor rows, whether labels are equal, whether rows are, and the keys: score * m + what puts earlier candidates first."""
        for lo in range(0, self.n, ANCHOR_TILE):
            at = slice(lo, min(self.n, lo + ANCHOR_TILE))
            for start in range(0, self.m, CANDIDATE_TILE):
                there = slice(start, min(self.m, start + CANDIDATE_TILE))
                scores = strassen(self.a[at], self.b[:, there])
                if self.dtype == object:
                    scores = np.minimum(np.maximum(scores, LEAST), MOST)
                keys = scores * self.m + np.arange(self.m - 1 - start, self.m - 1 - there.stop, -1).astype(self.dtype)
                same = self.left.label[at][:, None] == self.right.label[there]
                yield at, same, self.left.uid[at][:, None] == self.right.uid[there], keys

    def found(self, heaps: Heaps) -> tuple[np.ndarray, pa.Table, pa.Array]:
        """Heap row, candidate and score of every entry."""
        row, entry = np.nonzero(heaps.keys != _none(self.dtype))
        key = heaps.keys[row, entry]
        place = (self.m - 1 - key % self.m).astype(np.int64) if self.m else np.zeros(0, np.int64)
        scores = (key // max(1, self.m)).astype(np.int64)
        return row, self.right.table.take(pa.array(place)), pa.array(scores)

    def positives(self, size: int) -> pa.Table:
        """Best candidates of the anchor's label, the anchor's own row left out."""
        heaps, none = Heaps(self.n, size, self.dtype), _none(self.dtype)
        for at, same, own, keys in self.tiles():
            keys[~same | own] = none
            heaps.merge(at, keys)
        row, found, scores = self.found(heaps)
        return pa.table({"anchor": pa.array(self.left.uid[row]), "uid": found.column("uid"), "id": found.column("id"), "score": scores})

    def window(self, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest negative score, one column per positive; what is missing has an empty window."""
        column = self.left.table.column("positives").combine_chunks()
        offsets, score = np.asarray(column.offsets), np.asarray(column.flatten().field("score"))
        counts = np.diff(offsets)
        part = lambda p, percent: p // 100 * percent + p % 100 * percent // 100  # noqa: E731  floor(percent * p / 100) within 64 bits
        low, high = (np.full((self.n, settings.positives), x, np.int64) for x in (1, 0))
        has = np.arange(settings.positives) < counts[:, None]
        low[has], high[has] = -part(-score, settings.low), part(score, settings.high)
        if self.dtype != object:  # scores of other cells may be far beyond those of this one
            low, high = (np.clip(x, -self.bound, self.bound) for x in (low, high))
        return low.astype(self.dtype), high.astype(self.dtype)

    def negatives(self, settings: Settings) -> pa.Table:
        """Best candidates of other labels in each window."""
        size, count, none = settings.negatives, settings.positives, _none(self.dtype)
        low, high = self.window(settings)
        heaps = [Heaps(self.n, size, self.dtype) for _ in range(count)]
        for at, same, _, keys in self.tiles():
            keys[same] = none
            keys.sort(axis=1)
            for k in range(count):
                upto = (keys <= high[at, k, None] * self.m + (self.m - 1)).sum(axis=1)
                place = upto[:, None] - np.arange(size, 0, -1)
                best = np.take_along_axis(keys, np.maximum(place, 0), axis=1)
                best[(place < 0) | (best < low[at, k, None] * self.m)] = none
                heaps[k].merge(at, best)
        parts = []
        for k in range(count):
            row, found, scores = self.found(heaps[k])
            parts.append(pa.table({
                "anchor": pa.array(self.left.uid[row]), "k": pa.array(np.full(len(row), k, np.int32)), "uid": found.column("uid"), "id": found.column("id"), "score": scores,
            }))
        return pa.concat_tables(parts)


def prepared(vectors: DataFrame, id_col: str, vector: str, label: str) -> DataFrame:
    """``uid, id, label, vec, large`` of the rows that take part; a written table, so that row numbers stay."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    large = F.exists("vec", lambda x: F.abs(x) >= LARGE)
    rows = own.where(F.col("label").isNotNull() & F.col("vec").isNotNull() & finite)
    return stored(rows.select(F.monotonically_increasing_id().alias("uid"), "*", large.alias("large")), "vectors")


def _dealt(rows: DataFrame, per_cell: int) -> tuple[Column, int]:
    """The cell of a row, and how many there are: evenly many rows in each, large rows apart."""
    n = {r["large"]: r["n"] for r in rows.groupBy("large").agg(F.count(F.lit(1)).alias("n")).collect()}
    small, large = max(1, -(-n.get(False, 0) // per_cell)), -(-n.get(True, 0) // min(per_cell, LARGE_CELL))
    spread = lambda parts: F.pmod(F.xxhash64("uid"), F.lit(max(1, parts))).cast("int")
    return F.when(F.col("large"), small + spread(large)).otherwise(spread(small)), small + large


def _everywhere(cells: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))


def _best(found: DataFrame, heap: list[str], size: int) -> DataFrame:
    """Merges the heaps of all cells; ``rank`` from 1."""
    order = Window.partitionBy(*heap).orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, settings: Settings = Settings(), id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` is a condition on the column ``id``.  Every anchor meets every row, cell by cell.  Rows
    with a null label or vector, or a component that is null or not finite, take no part.  Rows are told
    apart by their place in the table, so repeated or null identifiers are rows of their own; a null one comes
    last among equal scores.  Vectors of different length are padded with zeros, an empty one scores 0; scores
    beyond 64 bits count as the nearest number of 64 bits.  A negative positive score has an empty window.
    """
    rows = prepared(vectors, id_col, vector, label)
    anchors = rows.where(is_anchor)
    (own_a, n_a), (own_c, n_c) = _dealt(anchors, ANCHOR_CELL), _dealt(rows, CANDIDATE_CELL)
    candidates = rows.select("uid", "id", "label", "vec", own_c.alias("c"), _everywhere(n_a).alias("a")).groupBy("a", "c")

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        return Cell(left, right, settings.scale).positives(settings.positives)

    id_type = rows.schema["id"].dataType.simpleString()
    # columns of their own, so that both sides of a cell can come from one table
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    dealt = anchors.select("uid", "label", "vec", own_a.alias("a"), _everywhere(n_c).alias("c"))
    found = dealt.groupBy("a", "c").cogroup(candidates).applyInArrow(first, f"anchor bigint, uid bigint, id {id_type}, score bigint")
    positives = stored(_best(found, ["anchor"], settings.positives), "positives")

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        return Cell(left, right, settings.scale).negatives(settings)

    # heaps have a bounded size, and so has the list
    of_anchor = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("positives"))
    dealt = anchors.join(of_anchor, F.col("uid") == F.col("anchor")).select("uid", "label", "vec", "positives", own_a.alias("a"), _everywhere(n_c).alias("c"))
    found = dealt.groupBy("a", "c").cogroup(candidates).applyInArrow(second, f"anchor bigint, k int, uid bigint, id {id_type}, score bigint")
    best = _best(found, ["anchor", "k"], settings.negatives)
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id"))
    known = positives.select("anchor", (F.col("rank") - 1).alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return best.join(known, ["anchor", "k"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


SQL = """WITH e AS MATERIALIZED (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS HUGEINT)) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.uid AS au, a.vec_id AS anchor_id, c.uid AS cu, c.vec_id AS cid, a.label = c.label AS same, CAST(coalesce(list_sum(list_transform(list_zip(a.q, c.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0) AS HUGEINT) AS score
  FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.uid <> c.uid),
p AS (SELECT au, anchor_id, cid AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY au ORDER BY score DESC, cid NULLS LAST, cu) AS k FROM s WHERE same QUALIFY k <= 5),
n AS (SELECT p.anchor_id, positive_id, cid AS negative_id, positive_score, score AS negative_score, row_number() OVER (PARTITION BY p.au, k ORDER BY score DESC, cid NULLS LAST, cu) AS rank
  FROM p JOIN s ON p.au = s.au AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score QUALIFY rank <= 10)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, CAST(positive_score AS BIGINT) AS positive_score, CAST(negative_score AS BIGINT) AS negative_score FROM n"""
