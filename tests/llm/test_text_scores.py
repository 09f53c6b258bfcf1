"""Classifier, quality rules and license scan."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from clickstrata.llm import boosted_rules, factorisation, licenses
from clickstrata.llm.common import table
from clickstrata.llm.docstats import BASE, repeated_words
from clickstrata.llm.queries import QUERIES
from clickstrata.llm.wordarrays import Words, text_blocks

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    covered = {j for i, w in enumerate(windows) if w in twice for j in range(i, i + 5)}
    lines, seen, dup = [x for x in text.split("\n") if WORD.search(x)], set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_words_match_a_regex(hard):
    texts = [t or "" for _, t in hard]
    for lo, hi, data, offsets in text_blocks(pa.array(texts), 500):
        w = Words(data, offsets)
        got = [[bytes(data[a:b]).decode() for a, b in zip(w.starts[x:y], w.ends[x:y])] for x, y in zip(w.bounds, w.bounds[1:])]
        assert got == [WORD.findall(t) for t in texts[lo:hi]]


def test_equal_words_hash_alike_wherever_they_stand():
    (_, _, data, offsets), = text_blocks(pa.array(["alpha beta alpha", "beta  alpha"]))
    h = Words(data, offsets).hashes()
    assert h[0] == h[2] == h[4] and h[1] == h[3] != h[0]


def test_repeated_words_by_hand():
    assert repeated_words("a b c d e a b c d e".split()) == 10
    assert repeated_words(["x"] * 6) == 6
    assert repeated_words("a b c d e f".split()) == 0


def test_base_statistics(spark, frame, hard):
    trees = boosted_rules.fit_trees(np.zeros((0, 13)), np.zeros(0), np.zeros(13))
    got = boosted_rules.quality_rules(frame(hard), trees).collect()
    assert sorted(((r.doc_id, *(r[c] for c in BASE)) for r in got), key=repr) == sorted(((i, *base_by_hand(t)) for i, t in hard), key=repr)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept) and r.size == "mine"


def test_rules_over_the_tables(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    quality = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_boosted_rules"](spark, SF).collect()}
    assert set(got) == set(texts)
    for i in list(texts)[::7]:
        assert tuple(got[i][c] for c in BASE) == base_by_hand(texts[i])
    passed = [i for i in quality if not got[i].base_failed]
    assert np.mean([got[i].kept == bool(quality[i]) for i in passed]) > 0.97


def test_trees_are_monotonic_and_equal_their_nodes(rng=np.random.default_rng(3)):
    x = rng.random((900, 3))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) + 0.2 * rng.random(900)) > 0.7).astype(float)
    trees = boosted_rules.fit_trees(x, y, np.array([1, 0, -1]), trees=30)
    grid = np.linspace(0, 1, 60)
    for f, sign in ((0, 1), (2, -1)):
        for row in rng.random((25, 3)):
            line = np.repeat(row[None], 60, axis=0)
            line[:, f] = grid
            assert (np.diff(trees.margins(line)) * sign >= -1e-12).all()
    slow = []
    for row in x[:40]:
        total = trees.bias
        for f, t, v in zip(trees.feature, trees.threshold, trees.value):
            node = 0
            while node < len(f):
                node = 2 * node + 1 + bool(row[f[node]] > t[node])
            total += v[node - len(f)]
        slow.append(total)
    assert np.allclose(slow, trees.margins(x[:40]))
    assert np.mean((trees.scores(x) > 0.5) == y) > 0.9


def test_one_class_gives_a_constant(frame, hard):
    assert set(boosted_rules.fit_trees(np.random.rand(9, 2), np.ones(9), np.zeros(2)).scores(np.random.rand(5, 2)).round(3)) == {0.909}


def test_identity_equals_all_pairs(rng=np.random.default_rng(4)):
    size = 40
    m = factorisation.Machine(0.3, rng.normal(size=size), rng.normal(size=(size, 8)), np.zeros(1), np.ones(1))
    index = np.concatenate([rng.choice(size, 6, False), rng.choice(size, 9, False)])
    x = factorisation.Sparse(index, rng.normal(size=15), np.array([0, 6, 6, 15]))
    slow = []
    for a, b in zip(x.bounds, x.bounds[1:]):
        i, v = x.index[a:b], x.value[a:b]
        pairs = sum(m.factor[i[p]] @ m.factor[i[q]] * v[p] * v[q] for p in range(len(i)) for q in range(p))
        slow.append(m.bias + m.weight[i] @ v + pairs)
    assert np.allclose(factorisation.margins(m, x), slow)


def test_classifier_on_held_out_rows(spark):
    got = {r.doc_id: r for r in QUERIES["op1_factorisation"](spark, SF).collect()}
    quality = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [i for i in quality if got[i].held_out]
    assert np.mean([got[i].predicted == quality[i] for i in held]) > 0.95


def test_classifier_ignores_labels_source_and_identity(spark, frame, hard):
    labels = spark.createDataFrame([(i, i % 2) for i in range(4, 16)], "doc_id bigint, quality int")
    machine = factorisation.fit(frame(hard), labels)
    got = factorisation.classified(frame(hard), machine).collect()
    assert len(got) == len(hard) and {r.size for r in got} == {"mine"}
    by_text = {}
    for r in got:
        by_text.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())


def test_empty_tables(spark, frame):
    none = frame([]).limit(0)
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    assert factorisation.classified(none, factorisation.fit(none, labels)).count() == 0
    assert boosted_rules.quality_rules(none, boosted_rules.fit(none, labels)).count() == 0
    assert licenses.license_scan(none).count() == 0


def scan_by_hand(text, rules):
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
    numbered = "".join(f" {w}:{i} " for i, w in enumerate(words))
    base = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    hits = [(int(re.search(r":(\d+) ", m[0])[1]), int(re.search(r":(\d+) $", m[0])[1]), r) for r in rules for m in re.finditer(r.regex, numbered)]
    order = lambda h: (h[0], -h[1], -h[2].level, h[2].number)
    alone = [h for h in hits if not any(order(o) < order(h) and o[0] <= h[0] and o[1] >= h[1] and o[2].level >= h[2].level for o in hits)]
    starts, labels = [i for i, _ in base], {x for _, x in base}
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {h[2].label for h in alone})), max((h[2].certainty for h in alone), default=0.0))


def test_license_scan_by_hand(frame, hard):
    more = [(20, "Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: GPL-2.0-or-later"), (21, "mit der license"), (22, "CC-BY-SA-4.0 and cc by cc by"), (23, "émit license MIT\x00license"), (24, "(c) 2020. All rights reserved. The MIT License " * 50)]
    rows = [*hard, *more]
    rules = licenses.rules()
    assert len(rules) > 200
    got = licenses.license_scan(frame(rows)).collect()
    want = sorted(((i, *scan_by_hand(t, rules)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, *(r[c] for c in licenses.RESULTS)) for r in got), key=repr) == want
    assert "gpl-2.0" in next(r.labels for r in got if r.doc_id == 20) and next(r.labels for r in got if r.doc_id == 21) == ""


def test_roots_gate_every_rule():
    assert all(any(root in r.keyword or root in r.regex for root in licenses.ROOTS) for r in licenses.rules())


@pytest.mark.parametrize("phrase", list(licenses.BASE))
def test_base_phrases_pass_the_gate(phrase):
    assert any(root in phrase for root in licenses.ROOTS)
