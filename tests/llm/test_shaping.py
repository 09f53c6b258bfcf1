"""Packing, chat formatting, mixing and WARC archives."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import struct
import zlib
from collections import defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickstrata.llm import chat, mixing, packing, warc
from clickstrata.llm.common import table
from clickstrata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# packing

def check_places(rows, length):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    return len(by)


def best_fit_by_hand(sizes, length):
    """Room left in each bin after best-fit decreasing, piece by piece."""
    bins = []
    for s in sorted(sizes, reverse=True):
        fit = [b for b in bins if b >= s]
        if fit:
            bins[bins.index(min(fit))] -= s
        else:
            bins.append(length - s)
    return sorted(bins)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=120))
def test_plan_is_best_fit_decreasing(sizes):
    counts = [(s, sizes.count(s)) for s in set(sizes)]
    filled = defaultdict(int)
    for size, first, end, per, bin_, offset in packing.best_fit_plan(counts, 64):
        for k in range(end - first):
            place = offset + k % per * size
            assert filled[bin_ + k // per] == place
            filled[bin_ + k // per] += size
    assert sorted(64 - v for v in filled.values()) == best_fit_by_hand(sizes, 64)


def test_tightest_capacity():
    rng, bins, held = random.Random(1), packing.OpenBins(100), set()
    for _ in range(500):
        c = rng.randrange(1, 101)
        if c in held:
            bins.take(c)
            held.discard(c)
        else:
            bins.add(c, 0, 1)
            held.add(c)
        least = rng.randrange(1, 101)
        assert bins.tightest(least) == min((h for h in held if h >= least), default=None)


def test_ids_equal_the_tokenizer_file(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    rows = QUERIES["op6_packing"](spark, SF).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert set(by) == set(texts)
    for i, text in texts.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 0], 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 2048)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{r.length}I", *ids[at : at + r.length]))
            at += r.length
        assert at == len(ids) and (len(ids) > 2048 or len(by[i]) == 1)
    bound = -(-sum(r.length for r in rows) // 2048)
    assert bound <= check_places(rows, 2048) <= bound + 2


def test_packing_hard_rows(frame, hard):
    rows = packing.pack_documents(frame(hard)).collect()
    check_places(rows, 2048)
    assert sum(r.piece == 0 for r in rows) == len(hard)
    assert all(r.length == 1 for r in rows if r.doc_id in (1, 2))
    assert packing.pack_documents(frame([])).count() == 0


def test_sequences_hold_the_ids(frame):
    rows = [(i, f"text number {i} " * (i % 50)) for i in range(80)]
    made = packing.pieces(frame(rows, clash=False), with_ids=True, length=64)
    from clickstrata.llm.common import stored

    placed = packing.packed(stored(made, "test-pieces"), length=64)
    whole = {r.sequence_id: r.ids for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert sum(map(len, whole.values())) == sum(r.length for r in placed.collect())


# chat

CONTROL = st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "<", "[", "/s>", "INST]", "a", "é", "\n", ""])
TEXT = st.lists(CONTROL, max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system"]) | TEXT, TEXT), max_size=5))
def test_template_round_trip(turns):
    text, spans = chat.format_turns(turns)
    assert chat.parse_turns(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_conversations(spark):
    conv = defaultdict(list)
    for r in table(spark, SF, "conversations").collect():
        conv[r.conv_id].append((r.turn, r.role, r.text or ""))
    conv[-1] = [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]
    got = {r.conv_id: r for r in QUERIES["op7_chat"](spark, SF).collect()}
    assert set(got) == set(conv)
    for i, turns in conv.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        want = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert (got[i].n_turns, got[i].turns_sha256, got[i].loss_chars, got[i].loss_sha256) == want


TREE = "tree bigint, node bigint, parent bigint, role string, text string, score double"


def test_reply_trees(spark):
    rows = [
        (1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "poor", 0.1), (1, 3, 1, "assistant", "good", 0.9), (1, 4, 3, "user", "deep", 0.5), (1, 5, 3, "user", "deeper", 0.5),
        (1, 6, 5, "assistant", "end", None), (None, 1, None, "user", None, 1.0), (2, 1, 99, "user", "orphan", 0.0), (2, 1, 99, "user", "orphan", 0.0),
        (3, 1, 2, "user", "circle", 0.0), (3, 2, 1, "user", "circle", 0.0), (3, 3, 2, "user", "below a circle", 0.0), (4, None, None, "user", "no number", 0.0), *[(5, n, n - 1 or None, "user", str(n), 0.0) for n in range(1, 38)],
    ]
    got = {(r.tree, r.place): (r.leaf, [t["text"] for t in r.turns]) for r in chat.reply_paths(spark.createDataFrame(rows, TREE), branches=2).collect()}
    assert got == {
        (1, 1): (4, ["root", "good", "deep"]), (1, 2): (6, ["root", "good", "deeper", "end"]), (None, 1): (1, [None]), (2, 1): (1, ["orphan"]), (5, 1): (37, [str(n) for n in range(1, 38)]),
    }
    assert chat.reply_paths(spark.createDataFrame([], TREE)).count() == 0


def test_hard_conversations(spark):
    rows = [(1, 0, None, None), (1, 0, None, None), (1, None, "user", "x"), (None, 1, "assistant", "</s>"), (2, 5, "assistant", "y" * 300_000)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'mine' as tree", "'mine' as node", "'mine' as score")
    got = {r.tree: r for r in chat.read_back(chat.formatted(chat.reply_paths(chat.chained(turns)))).collect()}
    assert {i: (r.n_turns, r.loss_chars) for i, r in got.items()} == {1: (3, 0), None: (1, 4), 2: (1, 300_000)}


# mixing

def targets_by_hand(sizes, total=1.5, most=2):
    """Shares by weight, those above their cap stopped and the excess shared anew, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    rest, open_, out = total * sum(sizes.values()), set(names), {}
    while open_:
        level = rest / sum(weight[s] for s in open_)
        above = [s for s in open_ if level * weight[s] > most * sizes[s]]
        if not above:
            out.update({s: level * weight[s] for s in open_})
            break
        for s in above:
            out[s] = most * sizes[s]
            rest -= out[s]
            open_.discard(s)
    return out


def mixed_rows(df):
    return mixing.mixed(df, mixing.mix_plan(df)).select("doc_id", "source", "size", "source_size", "target", "copies", "taken").collect()


def check_mix(got):
    sizes = defaultdict(int)
    for r in got:
        sizes[r.source] += r.size
    want, taken, largest = targets_by_hand(sizes), defaultdict(int), defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, r.target)
        assert r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6 for s in sizes)


def test_mix_of_uneven_sources(frame):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randrange(60), rng.choice(["a"] * 40 + ["b", "c", "d", "é", None])) for i in range(900)]
    got = mixed_rows(frame(rows, clash=False))
    assert len(got) == len(rows)
    check_mix(got)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixed_rows(frame(rows[::-1], clash=False))), key=repr)


def test_mix_of_hard_rows(frame, hard):
    rows = [(i, t, s) for (i, t), s in zip(hard, ["x", None, "y"] * 10)]
    got = mixed_rows(frame(rows))
    assert len(got) == len(rows) and all(r.taken <= 2 * r.size for r in got)
    assert mixed_rows(frame([])) == []


def test_longer_documents_are_likelier(frame):
    rows = [(i, "w " * (4 if i % 2 else 256), "abc"[i % 3]) for i in range(3000)]
    got = [r for r in mixed_rows(frame(rows, clash=False)) if r.source == "b"]
    share = lambda n: sum(r.copies for r in got if r.size == n) / sum(r.size == n for r in got)
    assert share(256) > share(4)


# archives

def payload_of(html):
    return (html or "").encode()


PAGE = "page_id bigint, url string, html string"


def test_archives_of_hard_pages(spark):
    pages = [(1, "http://a/1", "<p>é</p>"), (2, "http://a/2", "<p>é</p>"), (3, None, None), (4, "x\r\nWARC-Type: fake", ""), (5, "u", "a\r\n\r\nb" * 9), (None, "n", "alone"), (None, "n", "<p>é</p>"), (6, "long", "z" * 700_000), (7, "b", "tie"), (7, "b", "tie"), (8, "g", "\x1f\x8b\x08")]
    df = spark.createDataFrame(pages, PAGE).repartition(2).selectExpr("*", "'mine' as payload", "'mine' as error", "'mine' as archive")
    owner = {}
    for i, _, h in pages:
        if i is not None:
            owner[payload_of(h)] = max(owner.get(payload_of(h), i), i)
    want = []
    for i, _, h in pages:
        p = payload_of(h)
        refers = owner.get(p) if owner.get(p) != i else None
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if refers is not None else "response", refers, None))
    got = warc.archived(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_small_payloads_are_never_revisits(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxxx"), (4, "d", "xxxx")], PAGE)
    warc.write_archives(df, str(tmp_path / "w"), least=3)
    got = {r.page_id: (r.record_type, r.payload, r.url) for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
    assert got == {1: ("response", b"xx", "a"), 2: ("response", b"xx", "b"), 3: ("revisit", None, "c"), 4: ("response", b"xxxx", "d")}


def test_archives_are_plain_gzip(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([(1, "a", "one"), (2, "b", "two")], PAGE).coalesce(1), str(tmp_path / "w"))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "w").glob("part-*")))
    assert data.count(b"WARC/1.1\r\n") == 2 and b"\r\n\r\none\r\n\r\n" in data


def test_every_page_of_the_table(spark):
    pages = {r.page_id: payload_of(r.html) for r in table(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in QUERIES["op9_warc"](spark, SF).collect()}
    assert set(got) == set(pages) and all(r.error is None for r in got.values())
    assert all(r.payload_digest == warc.base32_sha1(pages[i]) and r.payload_bytes == len(pages[i]) for i, r in got.items())


def record_bytes(**changes):
    data = warc.record(7, "http://a", b"payload", None, 7, warc.base32_sha1(b"payload"))
    for old, new in changes.get("swap", []):
        data = data.replace(old, new)
    return data


@pytest.mark.parametrize(("swap", "error"), [
    ([(b"WARC/1.1", b"NOPE/1.1")], "no WARC version line"), ([(b"payload\r\n\r\n", b"payloaX\r\n\r\n")], "block digest differs"),
    ([(b"payload\r\n\r\n", b"pay\r\n\r\n")], "content length does not frame the block"), ([], None),
])
def test_damaged_records(swap, error):
    assert warc.parse(record_bytes(swap=swap)).error == error


def test_wrong_payload_digest():
    assert warc.parse(warc.record(7, "u", b"payload", None, 7, warc.base32_sha1(b"other"))).error == "payload differs from its length or digest"


@pytest.mark.parametrize("step", [1, 7, 1 << 20])
def test_members_fed_in_pieces(step):
    data = warc.member(b"one") + warc._BETWEEN.encode("latin-1") + warc.member(b"two" * 999) + warc.member(b"three")
    feed = lambda d: (d[i : i + step] for i in range(0, len(d), step))
    assert list(warc.members(feed(data))) == [(b"one", None), (b"two" * 999, None), (b"three", None)]
    cut = list(warc.members(feed(data[:-3])))
    assert [e for _, e in cut] == [None, None, "gzip: member is cut short"]
    assert list(warc.members(feed(warc.member(b"one") + b"junk")))[1][1].startswith("gzip")


def test_mix_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.sql(mixing.SQL).fetchall())
    assert sorted(map(tuple, QUERIES["op8_mixing"](spark, SF).collect())) == want


def test_added_tokens_are_found_anywhere(frame):
    import public_tokenizers
    import tokenizers

    mark = "<|endoftext|>"
    texts = [f"a {mark} b", mark, f"{mark}start", f"end {mark}", f"{mark}{mark} twice", f"x{mark}y<|endoftext|", "<|other|> plain", f"  {mark}  \n{mark}é"]
    plain = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.ids for r in packing.pieces(frame(list(enumerate(texts))), with_ids=True).collect()}
    assert got == {i: [*plain.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}


def test_mix_meets_targets_with_missing_and_repeated_identifiers(frame):
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"word{i} and nine more words of a text like all", "abc"[i % 3 if i % 2 else 0]) for i in range(6000)]
    taken, target = {}, {}
    for r in mixed_rows(frame(rows, clash=False)):
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 20 for s in target)
