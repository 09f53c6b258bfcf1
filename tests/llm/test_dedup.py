"""Exact, near and passage deduplication against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from clickstrata.llm import exact_dedup, near_dedup, repeats
from clickstrata.llm.common import table
from clickstrata.llm.components import components

SF = "/root/testdata/sf0.001"
SPACES = re.compile(r"[\x20\x09-\x0D]+")


def sorted_rows(rows):
    return sorted((tuple(r) for r in rows), key=repr)


# exact

def exact_by_hand(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACES.sub(" ", t or "")].append(i)
    out = []
    for body, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(body.encode()).hexdigest()) for i in ids]
    return sorted_rows(out)


def test_exact_duplicates(frame, hard):
    got = exact_dedup.exact_duplicates(frame(hard))
    assert {"lang", "source", "size", "score"} <= set(got.columns)
    assert sorted_rows(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == exact_by_hand(hard)


def test_exact_hot_group(frame):
    rows = [(i, "hot  text" if i % 3 else f"cold {i}") for i in range(600)]
    got = exact_dedup.exact_duplicates(frame(rows, clash=False))
    assert sorted_rows(got.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == exact_by_hand(rows)


def test_exact_empty(frame):
    assert exact_dedup.exact_duplicates(frame([])).count() == 0


@pytest.mark.parametrize("limit", [1 << 20, 300, 20])
def test_trie_with_and_without_spilling(limit):
    rng, trie, want = random.Random(5), exact_dedup.OwnerTrie(limit), {}
    for _ in range(3000):
        key, owner = bytes(rng.choice(b"ab") for _ in range(rng.randrange(12))), rng.choice([None, *range(50)])
        trie.insert(key, owner)
        best, n = want.get(key, (None, 0))
        want[key] = (owner if best is None else best if owner is None else min(best, owner), n + 1)
    got = list(trie.owners())
    assert len(got) == len(want) and {k: (o, n) for k, o, n in got} == want


# near

def sets_by_hand(rows, k):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(fold))
        out.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    return out


def near_by_hand(rows, s):
    sets, label = sets_by_hand(rows, s.words), {i: i for i, _ in rows if i is not None}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    where = defaultdict(set)
    for n, x in enumerate(sets):
        for y in x:
            where[y].add(n)
    for n, x in enumerate(sets):
        for m in {m for y in x for m in where[y] if m < n}:
            both = len(x & sets[m])
            if rows[n][0] is not None and rows[m][0] is not None and 100 * both >= s.percent * (len(x) + len(sets[m]) - both):
                a, b = find(rows[n][0]), find(rows[m][0])
                label[max(a, b)] = min(a, b)
    return sorted_rows((i, len(x), None if i is None else find(i), i is None or find(i) == i) for (i, _), x in zip(rows, sets))


@pytest.mark.parametrize("settings", [near_dedup.Settings(), near_dedup.Settings(words=3, percent=85, bands=24, rows=6)])
def test_near_duplicates_of_hard_rows(frame, hard, settings):
    assert sorted_rows(near_dedup.near_duplicates(frame(hard), settings).collect()) == near_by_hand(hard, settings)


def test_near_duplicates_of_a_large_group(frame):
    rng = random.Random(2)
    words = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(150):  # copies of one text with a few words changed, in which no single centre reaches all
        own = list(words)
        for _ in range(rng.randrange(1, 7)):
            own[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - i, " ".join(own)))
    rows += [(2000 + i, " ".join(words[:100] + [f"y{rng.randrange(10**6)}" for _ in range(200)])) for i in range(40)]
    s = near_dedup.Settings()
    assert sorted_rows(near_dedup.near_duplicates(frame(rows, clash=False), s).collect()) == near_by_hand(rows, s)


def test_near_duplicates_over_a_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    s = near_dedup.Settings()
    assert sorted_rows(near_dedup.near_duplicates(table(spark, SF, "documents"), s).collect()) == near_by_hand(rows, s)


def test_near_links_of_repeated_identifiers(frame):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, b + " end"), (3, a + " end"), (None, a), (7, "alone here"), (7, None)]
    s = near_dedup.Settings()
    assert sorted_rows(near_dedup.near_duplicates(frame(rows), s).collect()) == near_by_hand(rows, s)


def template_pages(n: int, rng: random.Random) -> list[tuple[int, str]]:
    """Pages of ten out of forty shared blocks: much alike, hardly any linked, no shingle rare."""
    blocks = [" ".join(f"b{b}w{i}" for i in range(12)) for b in range(40)]
    common = " ".join(f"c{i}" for i in range(260))
    return [(i, " ".join([common, *(blocks[b] for b in sorted(rng.sample(range(40), 10)))])) for i in range(n)]


@pytest.mark.parametrize("percent", [80, 85])
def test_prefix_places_lose_no_link_and_few_pairs_meet(spark, percent):
    rng = random.Random(percent)
    s = near_dedup.Settings(percent=percent)
    sets = []
    for base in range(12):  # sizes from 1 to 400 with links around the threshold
        size = rng.choice([1, 2, 7, 20, 31, 32, 33, 90, 400])
        body = rng.sample(range(10**6), size)
        for _ in range(25):
            own = set(rng.sample(body, rng.randrange(max(1, size * 3 // 4), size + 1)))
            sets.append(own | {rng.randrange(10**6) for _ in range(rng.randrange(1 + size // 10))})
    hot = rng.sample(range(10**6), 20)
    for _ in range(300):  # one word of many exchanged: three shingles of twenty are others
        at = rng.randrange(18)
        sets.append(set(hot[:at] + hot[at + 3 :]) | {10**7 + at * 1000 + rng.randrange(4) * 10 + j for j in range(3)})
    frame = spark.createDataFrame([(i, sorted(x)) for i, x in enumerate(sets)], "id bigint, shingles array<bigint>")
    members = frame.selectExpr("id", "cast(size(shingles) as bigint) as n", "id as component")
    places = near_dedup.prefix_places(members, frame, s).cache()
    got = {(r.a, r.b) for r in near_dedup._meeting(places, places, s).collect()}
    alike = lambda x, y: 100 * len(x & y) >= percent * len(x | y)
    want = {(i, j) for j in range(len(sets)) for i in range(j) if alike(sets[i], sets[j])}
    assert want <= got and len(want) > 100
    hot_ids = range(300, 600)
    meeting = sum(a in hot_ids and b in hot_ids for a, b in got)
    assert meeting < 300 * 299 / 2 / 8


def test_near_duplicates_of_template_pages(frame):
    rows = template_pages(120, random.Random(4))
    rows += [(500 + i, rows[i][1] + " end") for i in range(0, 120, 7)]
    s = near_dedup.Settings()
    assert sorted_rows(near_dedup.near_duplicates(frame(rows, clash=False), s).collect()) == near_by_hand(rows, s)


@pytest.mark.parametrize("bits, most", [(1 << 26, 120), (64, 3000)])
def test_texts_that_no_class_needs_are_left_out_before_the_join(spark, monkeypatch, bits, most):
    monkeypatch.setattr(near_dedup, "FIELD_BITS", bits)
    rows = near_dedup._narrow(spark.range(-1000, 2000).selectExpr("id as doc_id", "concat('text ', id % 700) as text"), "doc_id", "text").withColumnRenamed("id", "rep")
    rows = rows.union(rows.selectExpr("cast(null as bigint)", "mark", "text").limit(5))
    classes = rows.filter("rep % 30 = 0").select("rep", "mark")
    kept = near_dedup._needed(rows, classes)
    assert kept.columns == rows.columns
    kept = [tuple(r) for r in kept.collect()]
    wanted = {tuple(r) for r in rows.filter("rep % 30 = 0").collect()}
    assert len(wanted) == 100 and wanted <= set(kept) and len(kept) <= most
    assert near_dedup._needed(rows, classes.limit(0)).count() == 0


def test_near_duplicates_when_all_rows_pass_the_field(frame, hard, monkeypatch):
    monkeypatch.setattr(near_dedup, "FIELD_BITS", 1)
    s = near_dedup.Settings()
    assert sorted_rows(near_dedup.near_duplicates(frame(hard), s).collect()) == near_by_hand(hard, s)


def test_near_empty(frame):
    assert near_dedup.near_duplicates(frame([])).count() == 0


def test_posterior_bounds():
    s = near_dedup.Settings()
    t, grid = s.percent / 100, np.linspace(0, 1, 200_001)
    for n, least in s.least_matches():
        above = lambda m: ((d := grid**m * (1 - grid) ** (n - m))[grid >= t].sum()) / d.sum()  # noqa: B023, E731
        assert above(least) >= s.miss > above(least - 1)


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (3, 2), (500, 400)], "a bigint, b bigint")
    got = dict(map(tuple, components(links).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 400: 400, 500: 400}
    assert components(links.limit(0)).count() == 0


# passages

def repeats_by_hand(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(x[j : j + length] for _, x in texts for j in range(len(x) - length + 1))
    out = []
    for i, x in texts:
        gone = bytearray(len(x))
        for j in range(len(x) - length + 1):
            if count[x[j : j + length]] > 1:
                gone[j : j + length] = b"\1" * length
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted_rows(out)


def passages():
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefghijklmnop é\n") for _ in range(n))
    common, edge = prose(260), prose(199)
    rows = [(i, prose(rng.randrange(400)) + (common if i % 3 else edge) + prose(rng.randrange(300))) for i in range(60)]
    twice = prose(250)
    return [*rows, (70, twice + "|" + twice), (71, "ab" * 400), (72, "ab" * 130), (73, "z" * 500), (74, "z" * 200), (75, "z" * 199), (76, prose(200)), (77, common[:230]), (78, "x" + common[:200] + "y" + common[60:])]


@pytest.mark.parametrize("most", [repeats.MOST, 1])
def test_repeats(frame, hard, most):
    rows = [*passages(), *[(i, t) for i, t in hard if i not in (9, 10)]]
    assert sorted_rows(repeats.remove_repeats(frame(rows), most=most).collect()) == repeats_by_hand(rows, 200)


def test_repeats_of_long_texts(frame, hard):
    rows = [(i, t) for i, t in hard if i in (9, 10)]
    got = repeats.remove_repeats(frame(rows, clash=False), with_text=True).collect()
    assert all(r.n_removed == r.n_bytes > 300_000 and r.n_spans == 1 and r.kept_text == b"" for r in got)


def test_repeats_at_another_length(frame):
    assert sorted_rows(repeats.remove_repeats(frame(passages(), clash=False), length=50).collect()) == repeats_by_hand(passages(), 50)


def test_repeats_without_identifiers_are_apart(frame):
    rng = random.Random(3)
    prose = lambda n: "".join(rng.choice("abcdefghij klm") for _ in range(n))
    shared = prose(250)
    rows = [(None, prose(400)) for _ in range(40)] + [(None, prose(60) + shared), (None, shared + prose(70)), (None, None)]
    assert sorted_rows(repeats.remove_repeats(frame(rows)).collect()) == repeats_by_hand(rows, 200)


def test_repeats_empty(frame):
    assert repeats.remove_repeats(frame([])).count() == 0
