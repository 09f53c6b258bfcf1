"""Collocations against counting everything in dictionaries."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from clickstrata.llm import collocations as C


def words_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n\x0b\x0c\r]", low)]


def all_counts(rows, longest):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in words_of(text):
            for k in range(1, longest + 1):
                for i in range(len(piece) - k + 1):
                    f[lang if lang is not None else "und"][tuple(piece[i : i + k])] += 1
    return f


def plain(rows, s):
    out = []
    for lang, f in all_counts(rows, s.longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: c for p, c in f.items() if len(p) >= 2 and c >= s.least}
        found = []
        for p, a in often.items():
            cuts = [(1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            inside = any(len(q) > len(p) and 100 * c >= s.covered * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in often.items())
            if not inside:
                score, k = min(cuts)
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[: s.top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(n, seed=5):
    rng = random.Random(seed)
    vocab = ["a", "b", "c", "d", "e", "f\x01", "f", "é", "漢字", "Ab"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice(vocab) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randrange(0, 60)))
        if rng.random() < 0.4:
            text += " the quick brown fox jumps over it; once upon a time there was"
        rows.append((text, rng.choice(["en", "en", "de", None, "und"])))
    return rows


HARD = [(None, "en"), ("", None), (" \t\n", "en"), ("...", "de"), ("one", "xx"), ("x " * 300, "fr"), ("X x\tx. " * 50, "fr"), ("w" * 200_000, "en"), ("same words here. " * 20, "")]


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(C, "BLOCK_BYTES", 256)


def result(spark, rows, s, parts=3):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id int, text string, lang string").repartition(parts)
    df = df.selectExpr("*", "'mine' as phrase", "'mine' as f", "'mine' as rank", "'mine' as words", "'mine' as key")
    return sorted(tuple(r) for r in C.collocations(df, s).collect())


@pytest.mark.parametrize("s", [C.Settings(least=5, top=2000), C.Settings(least=8, covered=60, top=7), C.Settings(least=3, longest=3), C.Settings(least=4, longest=2)])
def test_against_dictionaries(spark, small, s):
    rows = corpus(150) + HARD
    got = result(spark, rows, s)
    assert got == plain(rows, s) and len(got) > 10


def test_few_and_many_streams_agree(spark):
    rows, s = corpus(200, seed=9) + HARD * 2, C.Settings(least=4)
    want = plain(rows, s)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert result(spark, rows, s) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_full_field_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "bit_field", lambda phrases: np.full(C.FIELD_BITS // 8, 255, np.uint8))
    rows, s = corpus(80, seed=2), C.Settings(least=5)
    assert result(spark, rows, s) == plain(rows, s)


def test_empty_table(spark):
    assert result(spark, [], C.Settings(), 1) == [] and result(spark, [(None, None)], C.Settings(), 1) == []


@pytest.mark.parametrize("block", [7, 64, 1000, 1 << 20])
def test_long_texts_in_parts(block):
    rng = random.Random(block)
    text = "".join(rng.choice(["ab", "c", "dé", "efghijklmnop"]) + rng.choice([" ", "  ", " \t ", ".", ", ", "\n\n"]) for _ in range(700))
    texts = [text.encode(), b"", b"x y", text[:40].encode()]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    got = Counter()
    for part, bounds, lo, hi, owned in C.slices(data, offsets, 4, block):
        tokens = C.Tokens(part, bounds, np.zeros(hi - lo, np.int64), owned)
        for _, phrase, count in C.part_counts(tokens, ["en"], range(1, 2), []):
            got.update(dict(zip([tuple(p.decode().split(" ")) for p in phrase.to_pylist()], count.tolist())))
        fields = [np.full(C.FIELD_BITS // 8, 255, np.uint8)] * 2
        for orders in (range(2, 3), range(3, 6)):
            for _, phrase, count in C.part_counts(tokens, ["en"], orders, fields):
                for p, c in zip(phrase.to_pylist(), count.tolist()):
                    got[tuple(p.decode().split(" "))] += c
    assert got == all_counts([(t.decode(), "en") for t in texts], 5)["en"]


def test_bit_field_holds_every_phrase(spark):
    rows = [("en", f"phrase {i}") for i in range(500)] + [("é", "ñ ü"), ("", "x")]
    field = C.bit_field(spark.createDataFrame(rows, "lang string, phrase string").repartition(4))
    langs = ["en", "é", ""]
    known = C._known(field, langs, np.array([langs.index(g) for g, _ in rows]), pa.array([p.encode() for _, p in rows], pa.binary()))
    assert known.all() and np.unpackbits(field).sum() <= len(rows)


def test_products_beyond_64_bits():
    n, a = 2 * 10**13, 10**12
    assert C.weakest_cut(a, [n, a, a], [n, a, a]) == (1000 * n // a, a, a)
