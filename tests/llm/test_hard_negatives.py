"""Hard negatives against a plain search, Strassen's products against plain ones."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickstrata.llm import hard_negatives as H

SCHEMA = "vec_id bigint, embedding array<double>, label int"


@given(st.integers(1, 40), st.integers(0, 40), st.integers(1, 40), st.sampled_from([1, 4, 16]), st.integers(0, 2**32), st.booleans())
@limits(max_examples=60, deadline=None)
def test_strassen(n, k, m, leaf, seed, huge):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**20), 2**20, (n, k)), rng.integers(-(2**20), 2**20, (k, m))
    if huge:
        a, b = a.astype(object) * 10**30, b.astype(object) * 10**30
    assert (H.strassen(a, b, leaf) == (a @ b if k else np.zeros((n, m), a.dtype))).all()


def test_quantised_is_floor():
    x = np.array([0.1, -0.1, -0.0, 1 / 256, -1 / 256, 3e38, -3e38, 1e307])
    assert [int(v) for v in H.quantised(x, 256)] == [25, -26, 0, 1, -1, *(int(v) * 256 for v in x[5:].tolist())]
    assert H.quantised(x[:5], 256).dtype == np.int64


def plain(rows, anchor, s):
    """Output rows by full sorting, Python integers throughout."""
    part = [
        (i, vid, lab, [int(math.floor(x * s.scale)) if math.isfinite(x * s.scale) else int(x) * s.scale for x in vec])
        for i, (vid, vec, lab) in enumerate(rows)
        if lab is not None and vec is not None and all(x is not None and math.isfinite(x) for x in vec)
    ]
    out = []
    for i, vid, lab, q in part:
        if vid is None or not anchor(vid):
            continue
        scored = [(max(H.LEAST, min(H.MOST, sum(a * b for a, b in zip(q, r)))), cid, clab) for j, cid, clab, r in part if j != i]
        scored.sort(key=lambda t: (-t[0], t[1] is None, t[1] or 0))
        for p, pid, _ in [t for t in scored if t[2] == lab][: s.positives]:
            inside = [t for t in scored if t[2] != lab and s.low * p <= 100 * t[0] <= s.high * p]
            out += [(vid, pid, k, nid, p, n) for k, (n, nid, _) in enumerate(inside[: s.negatives], 1)]
    return sorted(out, key=repr)


def compare(spark, rows, every, s=H.Settings()):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3).selectExpr("*", "'mine' as uid", "'mine' as score", "'mine' as id", "'mine' as vec", "'mine' as rank")
    got = sorted((tuple(r) for r in H.hard_negatives(frame, F.col("id") % every == 0, s).collect()), key=repr)
    want = plain(rows, lambda v: v % every == 0, s)
    assert got == want
    return got


def vectors(n, dim=8, labels=3, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0.2, 0.3) for _ in range(dim)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("cells", [(8192, 4096), (4, 16)])
def test_one_and_many_cells(spark, monkeypatch, cells):
    for name, value in zip(("ANCHOR_CELL", "CANDIDATE_CELL"), cells):
        monkeypatch.setattr(H, name, value)
    assert len(compare(spark, vectors(120), 9)) > 100


def test_tiles_of_a_cell_give_what_one_tile_gives(monkeypatch):
    rng = np.random.default_rng(7)
    def side(n, first, **more):
        vec = pa.array(rng.normal(0.2, 0.3, (n, 6)).tolist())
        return pa.table({"uid": np.arange(first, first + n), "id": np.arange(first, first + n) % 11, "label": rng.integers(0, 3, n), "vec": vec, **more})

    windows = pa.array([[{"rank": 1, "score": 60_000}, {"rank": 2, "score": 30_000}]] * 25)
    left, right, s = side(25, 0, positives=windows), side(90, 10), H.Settings()
    def both():
        cell = H.Cell(left, right, 256)
        order = [("anchor", "ascending"), ("uid", "ascending")]
        return cell.positives(5).sort_by(order), cell.negatives(s).sort_by([("k", "ascending"), *order])

    whole = both()
    monkeypatch.setattr(H, "ANCHOR_TILE", 4)
    monkeypatch.setattr(H, "CANDIDATE_TILE", 7)
    assert all(a.equals(b) for a, b in zip(whole, both())) and whole[1].num_rows > 50


def test_hard_rows(spark, monkeypatch):
    monkeypatch.setattr(H, "CANDIDATE_CELL", 16)
    inf, nan = float("inf"), float("nan")
    rows = vectors(40, dim=4) + [
        (100, None, 1), (101, [0.1, None], 1), (102, [inf, 1.0], 1), (103, [nan], 1), (104, [0.5, 0.5], None),
        (None, [0.4, 0.4, 0.4, 0.4], 1), (None, [0.4, 0.4, 0.4, 0.4], 1), (None, [0.3, 0.4], 2), (200, [], 1), (200, [], 2),
        (10, [0.9] * 4, 0), (10, [0.9] * 4, 0), (10, [0.8] * 4, 1), (300, [-0.5] * 4, 2), (310, [0.2] * 9, 0),
    ]
    compare(spark, rows, 10)


def test_equal_vectors_go_by_identifier(spark):
    compare(spark, [(i, [0.5, 0.5], i % 2) for i in range(60)] + [(100 + i, [0.2, 0.3], 1) for i in range(60)], 10)


def test_scores_beyond_64_bits(spark, monkeypatch):
    monkeypatch.setattr(H, "CANDIDATE_CELL", 8)
    rng = random.Random(3)
    rows = vectors(20, dim=3) + [(30 + i, [rng.gauss(0.5, 1) * 10.0 ** rng.choice([3, 6, 7, 8, 30, 300]) for _ in range(3)], rng.randrange(3)) for i in range(30)]
    assert compare(spark, rows, 5)


@pytest.mark.parametrize("rows", [[], [(1, [0.1], 1)], [(100, [0.1], 1)], [(100, [0.1], 1), (1, [0.1], 2)]])
def test_few_rows(spark, rows):
    assert compare(spark, rows, 100) == []


def test_other_settings(spark):
    compare(spark, vectors(80), 7, H.Settings(positives=2, negatives=3, low=50, high=100, scale=64))
