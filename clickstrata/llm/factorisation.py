"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.llm.docstats import FEATURES, base_statistics, features, in_training_fold, labelled_sample
from clickstrata.llm.wordarrays import LOWER, Words, text_blocks

#: Hash cells for words; cells for the power of two of the text's length.
WORD_CELLS, LENGTH_CELLS = 1 << 15, 24
#: Latent factors; labelled rows the machine is fitted on, at most.
FACTORS, SAMPLE_ROWS = 8, 6000


@dataclass
class Machine:
    """bias, one weight and FACTORS factors per feature, and the scale of the statistics."""

    bias: float
    weight: np.ndarray
    factor: np.ndarray
    mean: np.ndarray
    spread: np.ndarray


@dataclass
class Sparse:
    """Rows of features: those of row i are bounds[i] to bounds[i + 1]."""

    index: np.ndarray
    value: np.ndarray
    bounds: np.ndarray


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches; empty ones are 0."""
    out = np.zeros((len(bounds) - 1, *values.shape[1:]), values.dtype)
    full = np.flatnonzero(bounds[1:] > bounds[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, bounds[:-1][full], axis=0)
    return out


def margins(m: Machine, x: Sparse) -> np.ndarray:
    """bias + sum of w x + half of (sum of v x)^2 less the sum of (v x)^2: all pairs in linear time."""
    vx = m.factor[x.index] * x.value[:, None]
    s, q = _sums(vx, x.bounds), _sums(vx * vx, x.bounds)
    return m.bias + _sums(m.weight[x.index] * x.value, x.bounds) + 0.5 * (s * s - q).sum(axis=1)


def word_features(words: Words) -> Sparse:
    """Hashed lower-case words of each row, log counts scaled to length 1."""
    lowered = Words.__new__(Words)
    lowered.__dict__.update(words.__dict__, data=LOWER[words.data])
    cell = (lowered.hashes() >> np.uint64(40)).astype(np.int64) % WORD_CELLS
    key = np.sort(words.row * WORD_CELLS + cell)
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate((first, [len(key)])))
    row = key[first] // WORD_CELLS
    value = (1 + np.log(counts)).astype(np.float32) if len(first) else np.zeros(0, np.float32)
    bounds = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=words.rows)))).astype(np.int64)
    norm = np.sqrt(np.maximum(_sums(value * value, bounds), 1e-12))
    return Sparse(key[first] % WORD_CELLS, value / norm[row] if len(first) else value, bounds)


def _length_cell(n_chars: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n_chars.astype(float) + 1).astype(np.int64), LENGTH_CELLS - 1)


def with_dense(words: Sparse, stats: np.ndarray, length: np.ndarray) -> Sparse:
    """Word features followed by standardised statistics and the length's cell."""
    rows, extra = len(length), stats.shape[1] + 1
    counts = np.diff(words.bounds)
    bounds = words.bounds + np.arange(rows + 1) * extra
    index, value = np.empty(len(words.index) + rows * extra, np.int64), np.empty(len(words.index) + rows * extra, np.float32)
    place = np.arange(len(words.index)) + np.repeat(np.arange(rows) * extra, counts)
    index[place], value[place] = words.index, words.value
    tail = bounds[1:, None] - extra + np.arange(extra)[None, :]
    index[tail[:, :-1]], value[tail[:, :-1]] = WORD_CELLS + np.arange(stats.shape[1]), stats
    index[tail[:, -1]], value[tail[:, -1]] = WORD_CELLS + stats.shape[1] + length, 1.0
    return Sparse(index, value, bounds)


def _standard(m_mean: np.ndarray, m_spread: np.ndarray, stats: np.ndarray) -> np.ndarray:
    return np.clip((stats - m_mean) / m_spread, -4, 4).astype(np.float32) / 2


def fit_machine(words: Sparse, stats: np.ndarray, length: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 128, rate: float = 0.08, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Logistic loss by adaptive gradient steps, ``steps`` batches at least, over shuffled rows.

    Without rows of both classes all weights stay 0 and every score is the smoothed share of ones.
    """
    size = WORD_CELLS + stats.shape[1] + LENGTH_CELLS
    rng = np.random.default_rng(seed)
    share = (y.sum() + 1) / (len(y) + 2)
    mean = stats.mean(axis=0) if len(y) else np.zeros(stats.shape[1])
    spread = np.maximum(stats.std(axis=0), 1e-6) if len(y) else np.ones(stats.shape[1])
    m = Machine(float(np.log(share / (1 - share))), np.zeros(size, np.float32), np.zeros((size, FACTORS), np.float32), mean, spread)
    if len(np.unique(y)) < 2:
        return m
    m.factor = rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32)
    x = with_dense(words, _standard(mean, spread, stats), length)
    past_w, past_v = np.full(size, 1e-3, np.float32), np.full((size, FACTORS), 1e-3, np.float32)
    for _ in range(max(6, -(-steps * batch // len(y)))):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), batch):
            rows = order[lo : lo + batch]
            counts = x.bounds[rows + 1] - x.bounds[rows]
            bounds = np.concatenate(([0], np.cumsum(counts)))
            at = np.arange(bounds[-1]) - np.repeat(bounds[:-1], counts) + np.repeat(x.bounds[rows], counts)
            part = Sparse(x.index[at], x.value[at], bounds)
            vx = m.factor[part.index] * part.value[:, None]
            s = _sums(vx, bounds)
            z = m.bias + _sums(m.weight[part.index] * part.value, bounds) + 0.5 * (s * s - _sums(vx * vx, bounds)).sum(axis=1)
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]).astype(np.float32)
            each = np.repeat(np.arange(len(rows)), counts)
            used, back = np.unique(part.index, return_inverse=True)
            gw = np.bincount(back, g[each] * part.value, len(used)).astype(np.float32) / len(rows)
            gv = np.zeros((len(used), FACTORS), np.float32)
            np.add.at(gv, back, (g[each] * part.value)[:, None] * (s[each] - vx))
            gw, gv = gw + decay * m.weight[used], gv / len(rows) + decay * m.factor[used]
            past_w[used] += gw * gw
            past_v[used] += gv * gv
            m.weight[used] -= rate * gw / np.sqrt(past_w[used])
            m.factor[used] -= rate * gv / np.sqrt(past_v[used])
            m.bias -= rate * float(g.mean())
    return m


def _described(texts: pa.Array) -> Iterator[tuple[int, int, Sparse, np.ndarray, np.ndarray]]:
    for lo, hi, data, offsets in text_blocks(texts):
        words = Words(data, offsets)
        hashes = words.hashes()
        chars = words.per_row((data < 0x80) | (data >= 0xC0))
        yield lo, hi, word_features(words), features(words, hashes, base_statistics(words, hashes)), chars


def _lengths(batch: pa.RecordBatch, column: int | None, chars: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """The length given as metadata, or the text's own where it is missing or negative."""
    if column is not None:
        given = batch.column(column).slice(lo, hi - lo).cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)
        chars = np.where(given >= 0, given, chars)
    return _length_cell(chars)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> Machine:
    """A machine fitted on at most ``rows`` labelled texts of the training fold.

    Features are made on the executors; the driver gets their sparse rows only.
    """
    length_col = length_col if length_col in docs.columns else None

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, value, stats, length = [], [], [], []
            for lo, hi, x, s, chars in _described(batch.column(2)):
                for a, b in zip(x.bounds[:-1].tolist(), x.bounds[1:].tolist()):
                    index.append(x.index[a:b].astype(np.int32).tobytes())
                    value.append(x.value[a:b].astype(np.float32).tobytes())
                stats += s.tolist()
                length += _lengths(batch, 3 if length_col else None, chars, lo, hi).tolist()
            columns = [batch.column(0), batch.column(1), pa.array(index, pa.binary()), pa.array(value, pa.binary()), pa.array(stats, pa.list_(pa.float64())), pa.array(length, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "y", "index", "value", "stats", "length"])

    chosen = labelled_sample(docs.select(*dict.fromkeys([id_col, text_col, *([length_col] if length_col else [])])), labels, label, rows, id_col)
    chosen = chosen.select(F.col(id_col).cast("bigint").alias("id"), F.col("label__").cast("double").alias("y"), F.col(text_col).alias("text"), *([F.col(length_col).cast("bigint")] if length_col else []))
    made = chosen.mapInArrow(per_batch, "id bigint, y double, index binary, value binary, stats array<double>, length bigint")
    got = made.orderBy("id", "length", "index").limit(rows).toArrow()
    index = [np.frombuffer(b, np.int32) for b in got["index"].to_pylist()]
    value = [np.frombuffer(b, np.float32) for b in got["value"].to_pylist()]
    bounds = np.concatenate(([0], np.cumsum([len(i) for i in index]))).astype(np.int64)
    words = Sparse(np.concatenate(index).astype(np.int64) if index else np.zeros(0, np.int64), np.concatenate(value) if value else np.zeros(0, np.float32), bounds)
    stats = np.array(got["stats"].to_pylist()).reshape(-1, len(FEATURES))
    return fit_machine(words, stats, got["length"].to_numpy(), got["y"].to_numpy())


RESULTS = ["held_out", "score", "predicted"]


def classified(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", threshold: float = 0.5, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with held_out, score and predicted, text by text, without a shuffle.

    Null texts are empty; an empty text is scored by the bias, its statistics and
    its length.  The score sees the text and its length only.  Repeated rows get equal
    scores.  Columns of ``docs`` with the names of results are replaced; ``carry`` names those to return, all by default.
    """
    model = docs.sparkSession.sparkContext.broadcast(machine)
    keep = [c for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    # a text that is returned anyway crosses to Python once
    inputs = [*([] if text_col in keep else [F.col(text_col).alias("text__")]), *([F.col(length_col).cast("bigint").alias("length__")] if length_col in docs.columns else [])]
    rows = docs.select(*keep, *inputs)
    text_at = keep.index(text_col) if text_col in keep else len(keep)
    length_at = len(keep) + len(inputs) - 1 if length_col in docs.columns else None
    schema = T.StructType([*rows.schema.fields[: len(keep)], T.StructField("score", T.DoubleType())])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            for lo, hi, x, stats, chars in _described(batch.column(text_at)):
                z = margins(m, with_dense(x, _standard(m.mean, m.spread, stats), _lengths(batch, length_at, chars, lo, hi)))
                score = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns[: len(keep)], pa.array(score)], schema.names)

    return rows.mapInArrow(per_batch, schema).select(
        *keep, (~in_training_fold(F.col(id_col))).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
