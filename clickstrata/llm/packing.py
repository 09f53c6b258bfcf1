"""Best-fit decreasing packing of tokenised documents, planned on lengths and carried out by joins."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.llm.common import stored

#: Tokens of a sequence; id that ends every document.
LENGTH, END = 2048, 0
#: Documents encoded at once.
_ENCODE = 64


@lru_cache(maxsize=2)
def _encoder(path: str, added_path: str | None):
    """The byte-level BPE of ``path``, ranks as base64 and number per line, with the added tokens of the file ``added_path``."""
    import base64
    import json

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    added = {}
    if added_path is not None:
        with open(added_path, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in json.load(f).get("added_tokens", [])}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def added_tokens_path() -> str:
    """The file that names the vocabulary's added tokens."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    """The vocabulary of ``byte_bpe_50k.json`` in its form as ranks: the same ids in a quarter of the time."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(n_ids: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: full ones, but for the first."""
    first = n_ids % length or min(n_ids, length)
    starts = [0, *range(first, n_ids, length)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n_ids]) if b > a]


PIECE = "piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, text_col: str = "text", carry: Sequence[str] = ("doc_id",), length: int = LENGTH, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document: ``carry``, piece, start, length, ids_crc32 and, if asked, its ids.

    Null texts are empty; an empty text is one piece of the end id alone.  The vocabulary's added tokens are found
    anywhere in a text and stand for themselves; with a ``path`` of one's own there are none.  Other strings that look like control
    tokens are encoded as ordinary text.
    """
    added = added_tokens_path() if path is None else None
    path = path or ranks_path()
    rows = docs.select(*carry, F.coalesce(F.col(text_col), F.lit("")).alias("text__"))
    schema = T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL(PIECE).fields, *([T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if with_ids else [])])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, added)
        for batch in batches:
            for lo in range(0, batch.num_rows, _ENCODE):
                part = batch.slice(lo, _ENCODE)
                row, found, ids_of = [], [], []
                for i, text in enumerate(part.column(len(carry))):
                    ids = np.array([*encoder.encode(text.as_py(), allowed_special="all"), END], "<u4")
                    for k, (start, n) in enumerate(cut(len(ids), length)):
                        row.append(i)
                        found.append((k, start, n, zlib.crc32(ids[start : start + n].tobytes())))
                        ids_of.append(ids[start : start + n].astype(np.int32)) if with_ids else None
                taken = part.take(pa.array(row, pa.int64()))
                fresh = [pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([*taken.columns[:-1], *fresh, *([pa.array(ids_of, pa.list_(pa.int32()))] if with_ids else [])], schema.names)

    return rows.mapInArrow(per_batch, schema)


class OpenBins:
    """Open bins by remaining capacity, under a segment tree that says which capacities have any."""

    def __init__(self, most: int):
        self.size = 1 << (most + 1).bit_length()
        self.tree = np.zeros(2 * self.size, bool)
        #: per capacity, ranges (first bin, bins) of bins that are alike
        self.ranges: list[list[tuple[int, int]]] = [[] for _ in range(most + 1)]

    def _mark(self, capacity: int) -> None:
        i = capacity + self.size
        self.tree[i] = bool(self.ranges[capacity])
        while i > 1:
            i //= 2
            self.tree[i] = self.tree[2 * i] or self.tree[2 * i + 1]

    def add(self, capacity: int, first: int, bins: int) -> None:
        if bins and capacity:
            self.ranges[capacity].append((first, bins))
            self._mark(capacity)

    def take(self, capacity: int) -> tuple[int, int]:
        out = self.ranges[capacity].pop()
        self._mark(capacity)
        return out

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` with an open bin, in logarithmic time."""
        i = least + self.size
        if i >= 2 * self.size:
            return None
        while not self.tree[i]:
            while i & 1:  # what lies further right hangs below the next node after an ancestor
                i //= 2
            if i == 0:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.tree[2 * i] else 2 * i + 1
        return i - self.size


PLAN = "length bigint, first_rank bigint, end_rank bigint, per_bin bigint, first_bin bigint, offset bigint"


def best_fit_plan(counts: Iterable[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing for ``counts`` pieces of each length: rows of :data:`PLAN`.

    Bins of one capacity are alike, and so are pieces of one length, so a step
    places as many of them as fit the same way.  A piece goes into the tightest bin that holds it;
    the bin it leaves is tighter still, so the next of that length follows
    it while it fits.  The number of steps depends on ``length``, not on the pieces.
    """
    bins, plan, n_bins = OpenBins(length), [], 0
    for size, n in sorted(counts, reverse=True):
        rank = 0
        while rank < n:
            capacity = bins.tightest(size)
            if capacity is None:
                per = length // size
                first, number, capacity = n_bins, -(-(n - rank) // per), length
                n_bins += number
            else:
                first, number = bins.take(capacity)
                per = capacity // size
            full = min(number, (n - rank) // per)
            rest = min(n - rank - full * per, per) if full < number else 0
            end = rank + full * per + rest
            plan.append((size, rank, end, per, first, length - capacity))
            bins.add(capacity - per * size, first, full)
            if rest:
                bins.add(capacity - rest * size, first + full, 1)
            used = full + (rest > 0)
            if used < number:
                bins.add(capacity, first + used, number - used)
            rank = end
    return plan


def packed(piece_rows: DataFrame, order: Sequence[str] = ("doc_id", "piece", "ids_crc32"), length: int = LENGTH, rows_per_cell: int = 200_000) -> DataFrame:
    """``piece_rows`` with sequence_id and offset.

    ``piece_rows`` should be a stored table: it is read for the lengths and again for the
    places.  The driver sees one number per length, at most ``length`` of them.  Pieces get
    their rank among those of their length from cells of (length, salt), numbered on their
    own and shifted by the cells before, so that a common length is not one task's work.
    """
    spark = piece_rows.sparkSession
    counts = piece_rows.groupBy("length").count().collect()
    plan = best_fit_plan([(r["length"], r["count"]) for r in counts], length)
    # Bounded by the steps of the plan, which depend on the sequence length alone.
    steps = F.broadcast(spark.createDataFrame(plan, PLAN))
    salts = max(16, -(-max((r["count"] for r in counts), default=0) // rows_per_cell))
    rows = piece_rows.withColumn("salt__", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    cells = rows.groupBy("length", "salt__").count().withColumn(
        "before__", F.coalesce(F.sum("count").over(Window.partitionBy("length").orderBy("salt__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    ).drop("count")
    ranked = rows.withColumn("rank__", F.row_number().over(Window.partitionBy("length", "salt__").orderBy(*order)) - 1)
    ranked = ranked.join(cells, ["length", "salt__"]).withColumn("rank__", F.col("rank__") + F.col("before__"))
    placed = ranked.join(steps, (ranked["length"] == steps["length"]) & (F.col("rank__") >= steps["first_rank"]) & (F.col("rank__") < steps["end_rank"]))
    nth = F.col("rank__") - F.col("first_rank")
    return placed.select(
        *[ranked[c] for c in piece_rows.columns if c not in ("sequence_id", "offset")],
        (F.col("first_bin") + F.floor(nth / F.col("per_bin"))).cast("bigint").alias("sequence_id"),
        (steps["offset"] + nth % F.col("per_bin") * ranked["length"]).cast("bigint").alias("offset"),
    )


def pack_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", length: int = LENGTH, path: str | None = None) -> DataFrame:
    """Every piece of every document with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Repeated rows are packed as often as they occur; null identifiers are kept.
    """
    rows = stored(pieces(docs, text_col, [id_col], length, path), "pack-pieces")
    return packed(rows, (id_col, "piece", "ids_crc32"), length)


def sequences(placed: DataFrame) -> DataFrame:
    """Token ids of each sequence, from pieces with their ids and places; a group holds one sequence's tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
