"""Quality rules: boosted trees over document statistics, scored from flat node arrays."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstrata.llm.docstats import BASE, FEATURES, base_statistics, features, labelled_sample
from clickstrata.llm.wordarrays import Words, text_blocks

#: Direction in which a feature may move the score; others are free.
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "shouts_per_word": -1}
#: Labelled rows that the trees are fitted on, at most.
SAMPLE_ROWS = 4000
#: A text fails outright with fewer words, or a larger share of its words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20


@dataclass
class Trees:
    """``trees`` complete binary trees of one depth as arrays: the children of node i are 2i+1 and 2i+2."""

    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes); rows above it go right
    value: np.ndarray  # (trees, leaves)
    bias: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row of ``x``, all trees at once, level by level."""
        out = np.full(len(x), self.bias)
        depth = int(np.log2(self.value.shape[1])) if len(self.value) else 0
        tree = np.arange(len(self.value))
        for lo in range(0, len(x), 4096):
            part = x[lo : lo + 4096]
            node = np.zeros((len(part), len(self.value)), np.int64)
            for _ in range(depth):
                right = part[np.arange(len(part))[:, None], self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            if depth:
                out[lo : lo + 4096] += self.value[tree, node - self.feature.shape[1]].sum(axis=1)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Second-order boosting of the logistic loss over feature histograms.

    A split on a constrained feature is refused when its leaf values are in the
    wrong order, and the middle between them bounds everything below, so the sum
    of trees is monotonic in that feature.  Without rows of both classes no
    tree is grown and every score is the smoothed share of ones.
    """
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    feature, threshold, value = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    if len(np.unique(y)) < 2:
        return Trees(feature[:0], threshold[:0], value[:0], bias)
    edges = [np.unique(np.quantile(f, np.linspace(0, 1, bins + 1)[1:-1])) for f in x.T]
    cell = np.stack([np.searchsorted(e, f, "left") for e, f in zip(edges, x.T)], axis=1)
    margin = np.full(len(y), bias)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        node, bound = np.zeros(len(y), np.int64), {0: (-np.inf, np.inf)}
        for n in range(inner):
            lo, hi = bound[n]
            rows = np.flatnonzero(node == n)
            best, split = 1e-6, None
            for f, e in enumerate(edges):
                if not len(e) or not len(rows):
                    continue
                gl = np.cumsum(np.bincount(cell[rows, f], g[rows], len(e) + 1))
                hl = np.cumsum(np.bincount(cell[rows, f], h[rows], len(e) + 1))
                nl = np.cumsum(np.bincount(cell[rows, f], minlength=len(e) + 1))
                gr, hr = gl[-1] - gl[:-1], hl[-1] - hl[:-1]
                vl, vr = np.clip(-gl[:-1] / (hl[:-1] + ridge), lo, hi), np.clip(-gr / (hr + ridge), lo, hi)
                gain = -(gl[:-1] * vl + 0.5 * (hl[:-1] + ridge) * vl**2 + gr * vr + 0.5 * (hr + ridge) * vr**2)
                v = np.clip(-gl[-1] / (hl[-1] + ridge), lo, hi)
                gain += gl[-1] * v + 0.5 * (hl[-1] + ridge) * v**2
                gain[(nl[:-1] < least) | (nl[-1] - nl[:-1] < least) | ((vr - vl) * monotone[f] < 0)] = -np.inf
                if gain.max() > best:
                    best, split = gain.max(), (f, int(gain.argmax()), vl[gain.argmax()], vr[gain.argmax()])
            left, right = 2 * n + 1, 2 * n + 2
            bound[left] = bound[right] = (lo, hi)
            if split is None:
                node[rows] = left
                continue
            f, b, vl, vr = split
            feature[t, n], threshold[t, n] = f, edges[f][b]
            middle = (vl + vr) / 2
            if monotone[f] > 0:
                bound[left], bound[right] = (lo, middle), (middle, hi)
            elif monotone[f] < 0:
                bound[left], bound[right] = (middle, hi), (lo, middle)
            node[rows] = np.where(cell[rows, f] > b, right, left)
        for leaf in range(leaves):
            rows = node == leaf + inner
            value[t, leaf] = rate * np.clip(-g[rows].sum() / (h[rows].sum() + ridge), *bound[leaf + inner])
        margin += value[t, node - inner]
    return Trees(feature, threshold, value, bias)


def _fields(names: list[str], kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names]


def _statistics(texts: pa.Array) -> Iterator[tuple[int, int, dict[str, np.ndarray], np.ndarray]]:
    for lo, hi, data, offsets in text_blocks(texts):
        words = Words(data, offsets)
        hashes = words.hashes()
        base = base_statistics(words, hashes)
        yield lo, hi, base, features(words, hashes, base)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees fitted on the statistics of at most ``rows`` labelled texts of the training fold."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for *_, x in _statistics(batch.column(2))]
            x = np.concatenate(found) if found else np.zeros((0, len(FEATURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *map(pa.array, x.T)], ["id", "y", *FEATURES])

    chosen = labelled_sample(docs.select(id_col, text_col), labels, label, rows, id_col)
    chosen = chosen.select(F.col(id_col).cast("bigint").alias("id"), F.col("label__").cast("double").alias("y"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("y", T.DoubleType()), *_fields(FEATURES, T.DoubleType())])
    got = chosen.mapInArrow(per_batch, schema).orderBy("id", *FEATURES).limit(rows).toArrow()
    x = np.stack([got[f].to_numpy() for f in FEATURES], axis=1) if got.num_rows else np.zeros((0, len(FEATURES)))
    return fit_trees(x, got["y"].to_numpy(), np.array([MONOTONE.get(f, 0) for f in FEATURES]))


RESULTS = [*BASE, "base_failed", "score", "kept"]


def quality_rules(docs: DataFrame, trees: Trees, text_col: str = "text", threshold: float = 0.5, carry: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with the counts of :data:`BASE`, base_failed, score and kept, text by text, without a shuffle.

    Null and empty texts have no words and fail.  The trees judge only what the
    base rules let through.  Repeated rows get equal verdicts.  Columns of
    ``docs`` with the names of results are replaced; ``carry`` names those to return, all by default.
    """
    model = docs.sparkSession.sparkContext.broadcast(trees)
    keep = [c for c in (docs.columns if carry is None else carry) if c not in RESULTS]
    rows = docs.select(*keep, F.col(text_col).alias("text__"))
    schema = T.StructType([
        *rows.schema.fields[:-1], *_fields(BASE, T.LongType()), T.StructField("base_failed", T.BooleanType()),
        T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType()),
    ])

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, base, x in _statistics(batch.column(len(keep))):
                score = model.value.scores(x)
                failed = (base["n_words"] < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * base["n_words"])
                part = batch.slice(lo, hi - lo)
                fresh = [pa.array(base[n].astype(np.int64)) for n in BASE]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *fresh, pa.array(failed), pa.array(score), pa.array(~failed & (score >= threshold))], schema.names)

    return rows.mapInArrow(per_batch, schema)
