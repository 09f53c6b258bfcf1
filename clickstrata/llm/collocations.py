"""Phrase collocations from count streams in prefix and suffix order.

Counts of phrases are kept as sorted streams, not in hash tables.  In suffix order (last word first) a
phrase comes after all its endings, in prefix order after all its beginnings, so one pass over a sorted
stream with a stack of at most ``longest`` entries gives the counts of all right parts, or of all left
parts, and the largest count of an extension to that side.  The output of the suffix pass is the input of
the prefix pass; the stream's root, the phrase of no words, carries the number of all words.

Only phrases with ``least`` occurrences can be candidates, and all their parts have as many.  So texts are
read three times: for words, for pairs of frequent words, for longer runs in which every pair is frequent.
What earlier readings found is known to the next one as a bit field of fixed size, which may let rare
phrases pass (they are counted and drop out) and never holds a frequent one back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import stored
from clickstrata.llm.wordarrays import LOWER

#: Bytes of text taken at once.
BLOCK_BYTES = 4 << 20
#: Bits of the field that holds the frequent phrases of one reading (8 MB): what the driver sees and sends out, whatever the input.
FIELD_BITS = 1 << 26
#: Bits of one row of Spark's bitmap aggregate.
_BITMAP = 1 << 15
NO_LANG = "und"

_BLANK, _BREAK = np.zeros(256, bool), np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True


@dataclass(frozen=True)
class Settings:
    """Phrases of 2 to ``longest`` words with ``least`` occurrences; one goes if a longer one has ``covered``
    percent of its occurrences; ``top`` per language."""

    longest: int = 5
    least: int = 100
    covered: int = 100
    top: int = 2000


def slices(data: np.ndarray, offsets: np.ndarray, ahead: int, block: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, int]]:
    """Bytes, row offsets, first row, end of the last row and bytes owned, of parts of about ``block`` bytes.

    Whole rows where they fit.  A longer row is cut behind a blank or break; a part then holds ``ahead`` more words
    than it owns, so that each phrase is counted where its first word lies.
    """
    lo, rows = 0, len(offsets) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + block, "right")) - 1)
        hi = min(hi, rows)
        a, b = int(offsets[lo]), int(offsets[hi])
        if b - a <= 2 * block:
            yield data[a:b], offsets[lo : hi + 1] - a, lo, hi, b - a
        else:
            gap = a + np.flatnonzero((_BLANK | _BREAK)[data[a:b]]) + 1
            while a < b:
                end = int(gap[i]) if (i := int(np.searchsorted(gap, a + block))) < len(gap) else b
                seen = end
                for _ in range(ahead):  # to the end of the next word: behind the first gap that isn't next to another
                    while i + 1 < len(gap) and gap[i + 1] == gap[i] + 1:
                        i += 1
                    i += 1
                    seen = int(gap[i]) if i < len(gap) else b
                yield data[a:seen], np.array([0, seen - a]), lo, hi, end - a
                a = end
        lo = hi


class Tokens:
    """Words of one part: their piece, and the number of their (language, word) pair in a dictionary of the part."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, row_lang: np.ndarray, owned: int):
        low = LOWER[data]
        breaks = _BREAK[data]
        ink = ~(breaks | _BLANK[data])
        first, last = ink.copy(), ink.copy()
        if len(data):
            first[1:] &= ~ink[:-1]
            last[:-1] &= ~ink[1:]
            edges = offsets[(offsets > 0) & (offsets < len(data))]
            first[edges] = ink[edges]
            last[edges - 1] = ink[edges - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        row = np.searchsorted(offsets, starts, "right") - 1
        self.piece = np.cumsum(breaks, dtype=np.int64)[starts] + row if len(starts) else starts
        self.owned = int(np.searchsorted(starts, owned))
        bounds = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
        column = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(low[ink]))])
        words = column.dictionary_encode()
        size = max(1, len(words.dictionary))
        pairs, self.word = np.unique(row_lang[row] * size + words.indices.to_numpy(), return_inverse=True)
        self.text, self.lang = words.dictionary.take(pa.array(pairs % size)), pairs // size


def _numbered(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of each different code, its number at every place, and how often it occurs; by sorting."""
    _, at, number, count = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    return at, number, count


def _bits(langs: Iterable[str], phrases: Iterable[bytes]) -> np.ndarray:
    """Places of phrases in the bit field."""
    seed = {}
    digest = xxhash.xxh64_intdigest
    out = [digest(p, seed[g] if g in seed else seed.setdefault(g, digest(g))) for g, p in zip(langs, phrases)]
    return (np.array(out, np.uint64) % np.uint64(FIELD_BITS)).astype(np.int64)


def _known(field: np.ndarray, langs: list[str], lang: np.ndarray, phrases: pa.Array) -> np.ndarray:
    """Whether phrases may be among those of the field."""
    at = _bits([langs[i] for i in lang.tolist()], phrases.to_pylist())
    return (field[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def part_counts(tokens: Tokens, langs: list[str], orders: range, fields: list[np.ndarray]) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Language number, phrase and count of the phrases of some orders; ``fields``: frequent words, frequent pairs."""
    word, n = tokens.word, len(tokens.word)
    if 1 in orders:
        count = np.bincount(word[: tokens.owned], minlength=len(tokens.text))
        some = np.flatnonzero(count)
        yield tokens.lang[some], tokens.text.take(pa.array(some)), count[some]
        return
    frequent = _known(fields[0], langs, tokens.lang, tokens.text) if n else np.zeros(0, bool)
    ok = frequent[word]
    at = np.flatnonzero(ok[:-1] & ok[1:] & (tokens.piece[:-1] == tokens.piece[1:]))
    size = max(1, len(tokens.text))
    for order in range(2, orders.stop):
        if order == 2:
            first, number, count = _numbered(word[at] * size + word[at + 1])
        else:
            first, number, count = _numbered(number * size + word[at + order - 1])
        if order in orders:
            mine, times = np.unique(number[at < tokens.owned], return_counts=True)
            begin = at[first[mine]]
            parts = [tokens.text.take(pa.array(word[begin + i])) for i in range(order)]
            yield tokens.lang[word[begin]], pc.binary_join_element_wise(*parts, b" "), times
        if order + 1 < orders.stop:
            if order == 2:
                begin = at[first]
                pair = pc.binary_join_element_wise(tokens.text.take(pa.array(word[begin])), tokens.text.take(pa.array(word[begin + 1])), b" ")
                good = np.zeros(n + 1, bool)
                good[at[_known(fields[1], langs, tokens.lang[word[begin]], pair)[number]]] = True
            # the run goes on if the pair at its end is frequent too
            on = good[at] & good[np.minimum(at + order - 1, n)]
            at, number = at[on], number[on]


def counted(texts: DataFrame, orders: range, fields: list[np.ndarray], settings: Settings, block: int = 0) -> DataFrame:
    """``lang, phrase, f`` of the phrases of some orders, words joined by a space."""
    sent = [texts.sparkSession.sparkContext.broadcast(f) for f in fields]
    block = block or BLOCK_BYTES

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [s.value for s in sent]
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            names, row_lang = lang.dictionary.to_pylist(), lang.indices.to_numpy().astype(np.int64)
            column = batch.column(1)
            width = np.int64 if pa.types.is_large_string(column.type) else np.int32
            _, offs, raw = column.buffers()
            if not len(column) or raw is None:
                continue
            offsets = np.frombuffer(offs, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            data = np.frombuffer(raw, np.uint8)
            for part, bounds, lo, hi, owned in slices(data, offsets, orders.stop - 2, block):
                for number, phrase, count in part_counts(Tokens(part, bounds, row_lang[lo:hi], owned), names, orders, known):
                    for i in range(0, len(count), 1 << 16):
                        here = slice(i, i + (1 << 16))
                        yield pa.RecordBatch.from_arrays([pa.array([names[k] for k in number[here].tolist()], pa.string()), phrase[here].cast(pa.string()), pa.array(count[here].astype(np.int64))], ["lang", "phrase", "f"])

    return texts.mapInArrow(per_batch, "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def bit_field(phrases: DataFrame) -> np.ndarray:
    """The bit field of ``lang, phrase`` rows: bitmaps made where the rows are, at most ``FIELD_BITS`` bits of them."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _bits(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(at)], ["at"])

    at = F.col("at")
    maps = phrases.select("lang", "phrase").mapInArrow(per_batch, "at bigint").groupBy(F.shiftright("at", 15).alias("row")).agg(F.bitmap_construct_agg(at % _BITMAP).alias("bits"))
    field = np.zeros(FIELD_BITS // 8, np.uint8)
    for r in maps.collect():
        bits = np.frombuffer(bytes(r["bits"]), np.uint8)
        field[r["row"] * (_BITMAP // 8) :][: len(bits)] = bits
    return field


def phrase_counts(texts: DataFrame, settings: Settings) -> DataFrame:
    """``lang, words, f`` of all phrases with at least ``least`` occurrences, and of the empty phrase: all words of the language."""
    frequent = F.col("f") >= settings.least
    words = stored(counted(texts, range(1, 2), [], settings), "word-counts")
    often = words.where(frequent)
    fields = [bit_field(often)]
    tables = [often]
    if settings.longest >= 2:
        pairs = stored(counted(texts, range(2, 3), fields, settings).where(frequent), "pair-counts")
        tables.append(pairs)
    if settings.longest >= 3:
        fields.append(bit_field(pairs))
        tables.append(stored(counted(texts, range(3, settings.longest + 1), fields, settings).where(frequent), "run-counts"))
    streams = [t.select("lang", F.split("phrase", " ", -1).alias("words"), "f") for t in tables]
    whole = words.groupBy("lang").agg(F.sum("f").alias("f")).select("lang", F.array().cast("array<string>").alias("words"), "f")
    for s in streams:
        whole = whole.union(s)
    return whole


def _in_streams(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` dealt in the order of (lang, key) to streams, each with the beginnings of its first key as ``header`` rows.

    A stream of the range partitioning may begin in the middle of the phrases with one beginning.  The
    missing entries of the stack, at most one per word, are put in front.
    """
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    ranged = rows.repartitionByRange(int(parts), "lang", "key").withColumn("stream", F.spark_partition_id())
    ranged = stored(ranged, label)
    first = ranged.groupBy("stream").agg(F.min(F.struct("lang", "key")).alias("at")).select("stream", "at.*")
    wanted = first.where(F.size("key") > 0).select("stream", "lang", F.explode(F.transform(F.sequence(F.lit(0), F.size("key") - 1), lambda i: F.slice("key", 1, i))).alias("key"))
    # a beginning that lies in the stream itself would sort first in it, so these are all in earlier ones
    headers = ranged.drop("stream").join(wanted.hint("merge"), ["lang", "key"]).select(*[F.col(c) for c in ranged.columns], F.lit(True).alias("header"))
    both = ranged.withColumn("header", F.lit(False)).union(headers)
    return both.repartitionByRange(int(parts), "stream").sortWithinPartitions("stream", "lang", "key")


class Entry:
    """A phrase on the stack and the largest count of its extensions so far."""

    __slots__ = ("key", "f", "extension", "header", "rights", "before")

    def __init__(self, key, f, header, rights=(), before=0):
        self.key, self.f, self.header, self.rights, self.before, self.extension = key, f, header, rights, before, 0


def walk(entries: Iterable[tuple[object, Entry]]) -> Iterator[tuple[object, Entry, list[int]]]:
    """Scope, phrase and counts of its beginnings (none, one word, ...), in one pass over sorted entries; each comes out when its extensions are through.

    Entries of one key, the parts of a phrase that two streams have seen, come one after the other and become one.
    """
    stack: list[Entry] = []
    scope = None

    def popped() -> Iterator[tuple[object, Entry, list[int]]]:
        entry = stack.pop()
        if stack and len(stack[-1].key) == len(entry.key) - 1:
            stack[-1].extension = max(stack[-1].extension, entry.f)
        yield scope, entry, [e.f for e in stack]

    for at, entry in entries:
        while stack and (at != scope or entry.key[: len(stack[-1].key)] != stack[-1].key):
            yield from popped()
        scope = at
        if stack and stack[-1].key == entry.key:
            top = stack[-1]
            top.before, top.rights, top.f = max(top.before, entry.before), top.rights or entry.rights, max(top.f, entry.f)
            top.header &= entry.header
        else:
            stack.append(entry)
    while stack:
        yield from popped()


def _batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)


def right_counts(counts: DataFrame) -> DataFrame:
    """The suffix pass: ``lang, key, f, rights, before``.

    ``rights`` has the counts of the endings of 0, 1, ... words, ``before`` the largest count of a phrase
    with one more word in front.  ``key`` are the words in their order again.  A row without ``rights`` adds to ``before`` of
    another one of its key.
    """
    types = [pa.string(), pa.list_(pa.string()), pa.int64(), pa.list_(pa.int64()), pa.int64()]

    def per_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            for batch in batches:
                for stream, lang, key, f, header in zip(*(c.to_pylist() for c in batch.columns)):
                    yield (stream, lang), Entry(key, f, header)

        rows = ((lang, e.key[::-1], e.f, None if e.header else ends, e.extension) for (_, lang), e, ends in walk(entries()))
        yield from _batches(rows, ["lang", "key", "f", "rights", "before"], types)

    streams = _in_streams(counts.select("lang", F.reverse("words").alias("key"), "f"), "suffix-order")
    return streams.select("stream", "lang", "key", "f", "header").mapInArrow(per_stream, "lang string, key array<string>, f bigint, rights array<bigint>, before bigint")


def weakest_cut(a: int, lefts: list[int], rights: list[int]) -> tuple[int, int, int]:
    """Score, left and right count of the lowest-scoring cut, the earliest of equal ones; ``lefts[k]`` counts the first k words, ``rights[k]`` the last k."""
    size, n = len(lefts), lefts[0]
    cuts = [(1000 * a * n // (lefts[k] * rights[size - k]), k) for k in range(1, size)]
    score, k = min(cuts)
    return score, lefts[k], rights[size - k]


def scored(rights: DataFrame, settings: Settings) -> DataFrame:
    """The prefix pass: ``lang, words, a, l, r, n, score, covered`` of every candidate.

    A stream that begins within the extensions of a phrase adds rows that say only whether these cover it.
    """
    types = [pa.string(), pa.list_(pa.string()), *[pa.int64()] * 5, pa.bool_()]

    def per_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            for batch in batches:
                for stream, lang, key, f, ends, before, header in zip(*(c.to_pylist() for c in batch.columns)):
                    yield (stream, lang), Entry(key, f, header, ends or (), before)

        def rows():
            for (_, lang), e, lefts in walk(entries()):
                if len(e.key) < 2:
                    continue
                covered = 100 * max(e.before, e.extension) >= settings.covered * e.f
                if not e.header:
                    score, left, right = weakest_cut(e.f, lefts, list(e.rights))
                    yield lang, e.key, e.f, left, right, lefts[0], score, covered
                elif covered:
                    yield lang, e.key, e.f, None, None, None, None, True

        yield from _batches(rows(), ["lang", "words", "a", "l", "r", "n", "score", "covered"], types)

    streams = _in_streams(rights, "prefix-order")
    columns = "lang string, words array<string>, a bigint, l bigint, r bigint, n bigint, score bigint, covered boolean"
    return streams.select("stream", "lang", "key", "f", "rights", "before", "header").mapInArrow(per_stream, columns)


def collocations(docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` of each language.

    Null texts are empty, a null language is ``und`` (with those that are called so).  Repeated rows count as
    often as they occur; other columns are left out.  Languages without a candidate have no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), F.col(text).alias("text")).where("text <> ''")
    found = stored(scored(right_counts(phrase_counts(texts, settings)), settings), "phrases")
    late = found.where("l IS NULL").select("lang", "words").distinct()
    kept = found.where("l IS NOT NULL AND NOT covered").join(late, ["lang", "words"], "left_anti").withColumn("phrase", F.array_join("words", " "))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= settings.top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def duckdb_sql(settings: Settings = Settings()) -> str:
    """The same over the table ``documents``: all phrases of all orders counted."""
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH pc AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, unnest(string_split_regex({low}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
wl AS MATERIALIZED (SELECT lang, list_filter(string_split_regex(p, '[ \\x09]+'), lambda x: x <> '') AS w FROM pc),
cnt AS (SELECT lang, sum(len(w)) AS n FROM wl GROUP BY lang),
g AS MATERIALIZED (SELECT lang, ph, count(*) AS f FROM (SELECT lang, w[i:i + k - 1] AS ph FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM wl, range(1, {settings.longest + 1}) t(k) WHERE len(w) >= k)) GROUP BY 1, 2 HAVING count(*) >= {settings.least}),
cut AS (SELECT c.lang, c.ph, c.f AS a, x.f AS l, y.f AS r, k, (1000 * CAST(c.f AS HUGEINT) * CAST(n AS HUGEINT)) // (CAST(x.f AS HUGEINT) * y.f) AS score
  FROM (SELECT *, unnest(range(1, len(ph))) AS k FROM g WHERE len(ph) >= 2) c JOIN cnt ON c.lang = cnt.lang JOIN g x ON x.lang = c.lang AND x.ph = c.ph[:k] JOIN g y ON y.lang = c.lang AND y.ph = c.ph[k + 1:]),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
sub AS (SELECT lang, ph[i:i + k - 1] AS ph, max(f) AS f FROM (SELECT lang, ph, f, k, unnest(range(1, len(ph) - k + 2)) AS i FROM g, range(2, {settings.longest}) t(k) WHERE len(ph) > k) GROUP BY 1, 2),
kept AS (SELECT low.* FROM low LEFT JOIN sub ON low.lang = sub.lang AND low.ph = sub.ph WHERE sub.f IS NULL OR 100 * sub.f < {settings.covered} * a)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank, array_to_string(ph, ' ') AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept k JOIN cnt ON k.lang = cnt.lang QUALIFY rank <= {settings.top}"""
