"""Repeated passages: windows of ``length`` bytes that occur twice, by depth-limited radix passes.

Every window is a suffix cut off at ``length`` bytes; two suffixes in one group after the
last digit are a repeated window.  The passes go from the most significant digit down, and what is
alone in its group drops out:

* The first digit is the window's anchor, the ``GRAM`` bytes with the smallest hash in it, at their
  offset.  It depends on the window's bytes alone and is shared by about ninety neighbours, so one row
  stands for all of them, and the rows that are shuffled are a hundredth of the bytes.
* The second digit takes all windows of an anchor at once: if the stretch they cover is
  found again, each of them is repeated.
* What remains are stretches at the ends of repeated passages.  Those of one anchor meet in a task, which
  sorts their windows by eight bytes at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import stored
from clickstrata.llm.wordarrays import _power_tables, mixed, text_blocks

#: Bytes that make a window's anchor.
GRAM = 24
#: Stretches of one anchor that a task sorts; anchors with more go by window digests.
MOST = 50_000
#: Bytes of stretches sorted at once, but for one anchor's.
_TOGETHER = 4 << 20


def anchors(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Row, gram hash, first and last window start and anchor of every run of windows with one anchor.

    Starts and anchors count from the beginning of the row.
    """
    n, width = len(data), length - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none.astype(np.uint64), none, none, none
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    gram = mixed((sums[GRAM:] - sums[: n - GRAM + 1]) * down[: n - GRAM + 1])
    # the position makes the leftmost of equal hashes the smallest
    value = (gram >> np.uint64(32) << np.uint64(32)) | np.arange(len(gram), dtype=np.uint64)
    padded = np.full(-(-len(value) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(value)] = value
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - length + 1
    least = np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])
    row = np.searchsorted(offsets, np.arange(m), "right") - 1
    starts = np.flatnonzero(np.arange(m) + length <= offsets[row + 1])
    if not len(starts):
        return none, none.astype(np.uint64), none, none, none
    chosen, row = least[starts], row[starts]
    new = np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (row[1:] != row[:-1])))
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(starts)])) - 1
    at, row = (chosen[first] & np.uint64(0xFFFFFFFF)).astype(np.int64), row[first]
    begin = offsets[row]
    return row, gram[at], starts[first] - begin, starts[last] - begin, at - begin


def _grams(docs: DataFrame, length: int) -> DataFrame:
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                gram, count = np.unique(anchors(data, offsets, length)[1].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(count.astype(np.int64))], ["gram", "n"])

    return docs.select("text").mapInArrow(per_batch, "gram bigint, n bigint")


def _places(docs: DataFrame, length: int) -> DataFrame:
    """One row per anchor: its gram, the digest of its stretch, its document and place."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(2)):
                row, gram, first, last, at = anchors(data, offsets, length)
                raw = memoryview(np.ascontiguousarray(data))
                begin = offsets[row]
                digest = np.empty(len(row), np.int64)
                for i, (a, b, off) in enumerate(zip((begin + first).tolist(), (begin + last + length).tolist(), (at - first).tolist())):
                    h = hashlib.blake2b(raw[a:b], digest_size=8, salt=off.to_bytes(2, "little"))
                    digest[i] = int.from_bytes(h.digest(), "little", signed=True)
                place = first << 16 | (at - first) << 8 | (last - first)
                part = batch.slice(lo, hi - lo).select([0, 1]).take(pa.array(row))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(gram.view(np.int64)), pa.array(digest), pa.array(place)], ["id", "sum", "gram", "digest", "place"])

    return docs.select("id", "sum", "text").mapInArrow(per_batch, "id bigint, sum bigint, gram bigint, digest bigint, place bigint")


def _of_document(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Joined on the two hashes that name a row."""
    return left.join(right, ["id", "sum"], how)


_START = lambda place: F.shiftright(place, 16)
_SPAN = lambda place: place.bitwiseAND(F.lit(255))


def _stretches(docs: DataFrame, needed: DataFrame, length: int) -> DataFrame:
    """``needed`` places with the bytes that their windows cover."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(2)):
                raw, wanted = text.as_buffer(), batch.column(3)[i].as_py()
                part = [raw[(a := x["place"] >> 16) : a + (x["place"] & 255) + length].to_pybytes() for x in wanted]
                rows = pa.RecordBatch.from_pylist(wanted)
                same = pa.array([i] * len(wanted), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(same), batch.column(1).take(same), *(rows.column(c) for c in ("gram", "place", "open", "hot")), pa.array(part, pa.binary())], names)

    names = ["id", "sum", "gram", "place", "open", "hot", "bytes"]
    lists = needed.groupBy("id", "sum").agg(F.collect_list(F.struct("gram", "place", "open", "hot")).alias("wanted"))
    return _of_document(docs.select("id", "sum", "text"), lists, "inner").mapInArrow(per_batch, "id bigint, sum bigint, gram bigint, place bigint, open boolean, hot boolean, bytes binary")


def repeated_windows(stretches: list[bytes], gram: np.ndarray, offset: np.ndarray, span: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretch and window of every window that two stretches of one gram share.

    A radix sort from the most significant digit: groups of equal gram and anchor offset are split by
    eight bytes of the windows after the other, and groups of one drop out.
    """
    data = np.frombuffer(b"".join(stretches) + bytes(8), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(s) for s in stretches])))[:-1]
    of = np.repeat(np.arange(len(stretches)), span + 1)
    window = np.arange(len(of)) - np.repeat(np.cumsum(span + 1) - (span + 1), span + 1)
    digit = (gram[of].astype(np.uint64) << np.uint64(8)) | (offset[of] - window).astype(np.uint64)  # the top byte of a hash can go
    group = np.zeros(len(of), np.int64)
    for done in range(-8, length, 8):
        if done >= 0:
            bytes_at = (begin[of] + window + done)[:, None] + np.arange(min(8, length - done))
            wide = np.zeros((len(of), 8), np.uint8)
            wide[:, : bytes_at.shape[1]] = data[bytes_at]
            digit = wide.view(">u8").ravel()
        order = np.lexsort((digit, group))
        group, digit = group[order], digit[order]
        new = np.concatenate(([True], (group[1:] != group[:-1]) | (digit[1:] != digit[:-1]))) if len(group) else np.zeros(0, bool)
        alone = new & np.concatenate((new[1:], [True])) if len(group) else new
        group, keep = np.cumsum(new), ~alone
        of, window, group = of[order][keep], window[order][keep], group[keep]
        if not len(of):
            break
    return of, window


_RANGE = "id bigint, sum bigint, lo bigint, hi bigint"


def _sorted_in_tasks(rows: DataFrame, length: int) -> DataFrame:
    """Ranges of repeated windows of open stretches, anchor by anchor."""
    def resolve(table: pa.Table) -> pa.RecordBatch:
        place = table["place"].to_numpy()
        stretches = table["bytes"].to_pylist()
        start, offset, span = place >> 16, place >> 8 & 255, place & 255
        of, window = repeated_windows(stretches, table["gram"].to_numpy().view(np.uint64), offset, span, length)
        flat = np.sort(of * 256 + window)
        new = np.concatenate(([True], np.diff(flat) != 1)) if len(flat) else np.zeros(0, bool)
        lo, hi = flat[new], flat[np.concatenate((new[1:], [True]))] if len(flat) else flat
        open_ = table["open"].to_numpy(zero_copy_only=False)[lo // 256]
        of, lo, hi = (lo // 256)[open_], (lo % 256)[open_], (hi % 256)[open_]
        at = pa.array(of, pa.int64())
        one = lambda c: table[c].combine_chunks().take(at) if table.num_rows else pa.array([], pa.int64())
        return pa.RecordBatch.from_arrays([one("id"), one("sum"), pa.array(start[of] + lo), pa.array(start[of] + hi)], ["id", "sum", "lo", "hi"])

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            gram = batch.column(2).to_numpy()
            edges = [0, *(np.flatnonzero(gram[1:] != gram[:-1]) + 1).tolist(), batch.num_rows]
            if held and held[-1].column(2)[-1].as_py() != gram[0] and size > _TOGETHER:
                yield resolve(pa.Table.from_batches(held))
                held, size = [], 0
            for a, b in zip(edges, edges[1:]):
                if a and size > _TOGETHER:
                    yield resolve(pa.Table.from_batches(held))
                    held, size = [], 0
                held.append(batch.slice(a, b - a))
                size += (b - a) * (length * 3 // 2)
        if held:
            yield resolve(pa.Table.from_batches(held))

    return rows.repartition("gram").sortWithinPartitions("gram").select("id", "sum", "gram", "place", "open", "bytes").mapInArrow(per_partition, _RANGE)


def _by_digest(rows: DataFrame, length: int) -> DataFrame:
    """The same for anchors of many stretches: windows are counted by digest, summed before they are shuffled."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                place, raw = batch.column(2)[i].as_py(), batch.column(4)[i].as_buffer().to_pybytes()
                start, span = place >> 16, place & 255
                digests = [hashlib.blake2b(raw[j : j + length], digest_size=16).digest() for j in range(span + 1)]
                same = pa.array([i] * (span + 1), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(c).take(same) for c in (0, 1, 3)] + [pa.array(range(start, start + span + 1), pa.int64()), pa.array(digests, pa.binary())], ["id", "sum", "open", "lo", "window"])

    made = rows.select("id", "sum", "place", "open", "bytes").mapInArrow(per_batch, "id bigint, sum bigint, open boolean, lo bigint, window binary")
    found = made.groupBy("window").count().filter("count > 1").select("window")
    return made.filter("open").join(found, "window", "left_semi").select("id", "sum", "lo", F.col("lo").alias("hi"))


def repeat_ranges(docs: DataFrame, length: int, most: int = MOST) -> DataFrame:
    """id, sum, lo, hi: ranges of window starts that occur again, for ``docs`` with id, sum (which name a row together) and text."""
    twice = _grams(docs, length).groupBy("gram").agg(F.sum("n").alias("n")).filter("n > 1").select("gram")
    places = stored(_places(docs, length).join(twice, "gram", "left_semi"), "repeat-places")
    kinds = stored(places.groupBy("gram", "digest").agg(F.count("*").alias("n"), F.min(F.struct("id", "sum", "place")).alias("any")), "repeat-kinds")
    whole = kinds.filter("n > 1").select("gram", "digest")
    full = places.join(whole, ["gram", "digest"], "left_semi").select("id", "sum", _START(F.col("place")).alias("lo"), (_START(F.col("place")) + _SPAN(F.col("place"))).alias("hi"))
    mixed_grams = kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).filter("kinds > 1 and least = 1").select("gram", (F.col("kinds") > most).alias("hot"))
    needed = kinds.join(mixed_grams, "gram").select("any.*", "gram", (F.col("n") == 1).alias("open"), "hot")
    bytes_of = stored(_stretches(docs, needed, length), "repeat-stretches")
    ends = _sorted_in_tasks(bytes_of.filter("not hot"), length).union(_by_digest(bytes_of.filter("hot"), length))
    return full.union(ends)


RESULTS = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"]


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", most: int = MOST, with_text: bool = False) -> DataFrame:
    """``doc_id`` with n_bytes, n_removed, n_spans and kept_sha256 of every row, and the remaining bytes if asked.

    Each byte under a string of ``length`` bytes that also starts elsewhere goes, in its own
    document too; strings overlap and are judged on the input.  Null texts are empty; texts shorter than
    ``length`` lose nothing.  Repeated rows repeat each other, so such rows lose all of a text of that length.
    Inside, two 64-bit hashes of identifier and text name a row, so rows of one identifier, or of
    none, are apart unless their texts are equal.  ``length`` lies between an anchor's and 255 bytes more.
    """
    if not GRAM <= length <= GRAM + 255:
        raise ValueError(f"length must lie between {GRAM} and {GRAM + 255}")

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                raw = text.as_buffer().to_pybytes()
                spans: list[list[int]] = []
                for r in sorted((x["lo"], x["hi"]) for x in ranges.as_py() or []):
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], r[1] + length)
                    else:
                        spans.append([r[0], r[1] + length])
                at, kept = 0, []
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                rest = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(rest), len(spans), hashlib.sha256(rest).hexdigest(), *([rest] if with_text else [])))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.binary()] if with_text else [])]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * len(kinds), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *RESULTS[: len(kinds)]])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # each hash starts from that of its first column, so what makes one collide leaves the other apart
    rows = rows.select("doc_id", F.xxhash64("doc_id", "text").alias("id"), F.xxhash64("text", "doc_id").alias("sum"), "text")
    ranges = repeat_ranges(rows, length, most).groupBy("id", "sum").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text binary" * with_text
    return _of_document(rows, ranges, "left").select("doc_id", "text", "ranges").mapInArrow(per_batch, schema)
