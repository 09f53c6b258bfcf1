"""Near duplicates: banded MinHash candidates, Bayesian pruning batch by batch, exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import stored
from clickstrata.llm.components import components
from clickstrata.llm.wordarrays import LOWER, Words, mixed, text_blocks


#: Bits of the field that says which rows' texts may be needed (8 MB): what the driver sends out, whatever the input.
FIELD_BITS = 1 << 26


@dataclass(frozen=True)
class Settings:
    """Two documents are linked when ``100 * intersection >= percent * union`` of their shingle sets.

    A pair at the threshold misses all bands with probability (1 - (percent/100)^rows)^bands,
    1.5e-5 here, and is pruned with probability ``miss`` at each batch.  ``typical`` members of a group's
    largest component are compared with the rest before all others are; it changes the work only.
    """

    words: int = 5
    percent: int = 80
    bands: int = 28
    rows: int = 5
    miss: float = 1e-6
    typical: int = 8
    seed: int = 1

    @property
    def hashes(self) -> int:
        return self.bands * self.rows

    def multipliers(self) -> np.ndarray:
        return np.random.default_rng(self.seed).integers(0, 1 << 63, self.hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def least_matches(self) -> list[tuple[int, int]]:
        """For the first n hashes: the fewest matches with which the pair may still be similar.

        With a uniform prior and m of n matches the similarity follows Beta(m + 1, n - m + 1), so it
        reaches t with the probability that n + 1 throws of chance t succeed at most m times.
        """
        t, out = self.percent / 100, []
        for n in range(self.bands, self.hashes + 1, self.bands):
            total, m = 0.0, -1
            while total < self.miss:
                m += 1
                total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            out.append((n, m))
        return out


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of every text.

    A-Z count as a-z; a text with fewer than ``k`` words is one shingle, without words it has none.
    """
    for _, _, data, offsets in text_blocks(texts):
        words = Words(LOWER[data], offsets)
        hashes = words.hashes()
        keys, at = words.windows(hashes, k)
        ends = np.searchsorted(words.row[at], np.arange(words.rows + 1)) if len(at) else np.zeros(words.rows + 1, np.int64)
        for i in range(words.rows):
            n = int(words.counts[i])
            if n >= k:
                yield np.unique(keys[ends[i] : ends[i + 1]])
            elif n:
                whole = np.full(1, n, np.uint64)
                for h in hashes[words.bounds[i] : words.bounds[i + 1]]:
                    whole = mixed(whole + h)
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """MinHash values: the smallest product with each multiplier, upper half."""
    least = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(shingles), 2048):
        np.minimum(least, (multipliers[:, None] * shingles[None, lo : lo + 2048]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    """One 64-bit key per band; keys of different bands differ."""
    parts = sig.reshape(bands, -1).astype(np.uint64)
    key = np.arange(bands, dtype=np.uint64)
    for column in parts.T:
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, mark (a hash of the text, which tells apart the texts of a repeated identifier) and text."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return rows.select("id", F.xxhash64("text").alias("mark"), "text")


def _digest(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(rows: DataFrame, s: Settings) -> DataFrame:
    """id, mark, n_shingles, digest of the shingle set and band keys of every row; the last two null without words."""
    multipliers = s.multipliers()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, keys = [], [], []
            for x in shingle_sets(batch.column(2), s.words):
                n.append(len(x))
                digest.append(_digest(x))
                keys.append(band_keys(signature(x, multipliers), s.bands) if len(x) else None)
            columns = [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["id", "mark", "n_shingles", "digest", "keys"])

    return rows.mapInArrow(per_batch, "id bigint, mark bigint, n_shingles bigint, digest binary, keys array<bigint>")


def _needed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` (rep, mark, text) without most of those that none of ``classes`` (rep, mark) is named after.

    They are told apart where they lie, by a bit field, so only texts that are read later are shuffled. It holds
    no row of a class back; rows whose bit is a class's too pass, the more, the fuller the field.
    """
    place = F.pmod(F.xxhash64("rep", "mark"), F.lit(FIELD_BITS))
    bit = {"bucket": F.bitmap_bucket_number(place), "bit": F.bitmap_bit_position(place).cast("int")}
    # dealt by bucket first, since a task's part of a bitmap is as large as all of it
    field = stored(classes.withColumns(bit).repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")), "near-field")
    octet = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright("bit", 3) + 1, F.lit(1))), 16, 10).cast("int")
    return rows.withColumns(bit).join(F.broadcast(field), "bucket").filter(F.getbit(octet, F.col("bit").bitwiseAND(7)) == 1).select(*rows.columns)


def _candidates(rows: DataFrame, classes: DataFrame, s: Settings) -> DataFrame:
    """node, signature and shingle set of ``classes`` (node, digest, and rep and mark of one of their rows)."""
    multipliers = s.multipliers()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(2), s.words))
            # a row of the same identifier and mark may still have another text
            own = pa.array([i for i, (x, digest) in enumerate(zip(sets, batch.column(1))) if _digest(x) == digest.as_py()], pa.int64())
            sets = [sets[i] for i in own.to_pylist()]
            columns = [pa.array([signature(x, multipliers).tobytes() for x in sets], pa.binary()), pa.array([x.view(np.int64) for x in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(own), *columns], ["id", "sig", "shingles"])

    found = _needed(rows.withColumnRenamed("id", "rep"), classes).join(classes.select("rep", "mark", "node", "digest"), ["rep", "mark"])
    made = found.select("node", "digest", "text").mapInArrow(per_batch, "id bigint, sig binary, shingles array<bigint>")
    return made.groupBy("id").agg(F.first("sig").alias("sig"), F.first("shingles").alias("shingles"))


def likely(pairs: DataFrame, candidates: DataFrame, s: Settings) -> DataFrame:
    """The pairs whose similarity may reach the threshold, judged on more and more of their signatures."""
    bounds = s.least_matches()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.stack([np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column(c)]) for c in (2, 3))
            alive, matches, done = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64), 0
            for n, least in bounds:
                matches = matches + (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive, matches, done = alive[matches >= least], matches[matches >= least], n
            yield batch.select([0, 1]).take(pa.array(alive))

    both = pairs.join(candidates.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a").join(candidates.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
    return both.select("a", "b", "sig_a", "sig_b").mapInArrow(per_batch, "a bigint, b bigint")


def verified(pairs: DataFrame, candidates: DataFrame, percent: int) -> DataFrame:
    """The pairs that are linked, by their full sets."""
    both = pairs.join(candidates.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b").join(candidates.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
    both = both.select("a", "b", F.size(F.array_intersect("set_a", "set_b")).alias("shared"), (F.size("set_a") + F.size("set_b")).alias("total"))
    return both.filter(100 * F.col("shared") >= percent * (F.col("total") - F.col("shared"))).select("a", "b")


def _pair(a, b):
    return F.least(a, b).alias("a"), F.greatest(a, b).alias("b")


def _size_class(n: Column) -> Column:
    """The smallest size of the class of ``n``: all but its five leading bits are zero, so sizes to 31 are classes of their own."""
    low = F.greatest(F.length(F.bin(n)) - 5, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", n, low), low)


def prefix_places(members: DataFrame, candidates: DataFrame, s: Settings) -> DataFrame:
    """key, id, n, component, at: the places under which ``members`` (id, n, component) meet all they may be linked to.

    Shingles have one order, the rarest among the members first.  If the first shingle that two sets of
    sizes n and m share is number ``at`` of the one, they share at most n - at, and a link takes
    percent / (100 + percent) of n + m.  So a set is entered under its first shingles only; fewer, the larger
    the partner.  The key holds the class of the smaller size, for which each set is entered
    under all classes it can have, so sets of one size meet under a few shingles, the rarest that they have.
    """
    p, n = F.lit(s.percent), F.col("n")
    tokens = candidates.join(members, "id").select("id", "n", "component", F.explode("shingles").alias("shingle"))
    held = tokens.join(tokens.groupBy("shingle").agg(F.count("*").alias("holders")), "shingle")
    held = held.withColumn("at", F.row_number().over(Window.partitionBy("id").orderBy("holders", "shingle")) - 1)
    # a shingle of one holder takes its number, but meets nothing
    least = F.ceil(p * n / 100).cast("bigint")
    step = _size_class(least)
    classes = F.array_distinct(F.transform(F.sequence(step, n, F.greatest(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.greatest(F.length(F.bin(least)) - 5, F.lit(0))), F.lit(1))), _size_class))
    near = F.filter(classes, lambda c: (100 + p) * (n - F.col("at")) >= p * (n + F.greatest(c, least)))
    held = held.filter("holders > 1").filter((100 + p) * (n - F.col("at")) >= p * (n + least))
    return held.select("id", "n", "component", "at", "shingle", F.explode(near).alias("sizes")).select(F.xxhash64("shingle", "sizes").alias("key"), "id", "n", "component", "at", "sizes")


def _meeting(places: DataFrame, others: DataFrame, s: Settings) -> DataFrame:
    """Pairs of places and ``others`` of another component under one key, as far as sizes and numbers allow a link."""
    others = others.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "at", "component")])
    needed = s.percent * (F.col("n") + F.col("n2"))
    possible = ((100 + s.percent) * (F.col("n") - F.col("at")) >= needed) & ((100 + s.percent) * (F.col("n2") - F.col("at2")) >= needed)
    possible &= F.col("sizes") == _size_class(F.least("n", "n2"))
    return places.join(others, "key").filter((F.col("component") != F.col("component2")) & possible).select(*_pair("id", "id2")).distinct()


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """``found`` components joined by further links; the components are nodes of a smaller graph."""
    of = lambda end: found.select(F.col("node").alias(end), F.col("component").alias(f"{end}2"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(*_pair(F.coalesce("a2", "a"), F.coalesce("b2", "b")))
    joined = components(between).select(F.col("node").alias("part"), F.col("component").alias("whole"))
    known = found.join(joined, F.col("component") == F.col("part"), "left").select("node", F.coalesce("whole", "component").alias("component"))
    lone = joined.join(found, F.col("part") == F.col("node"), "left_anti").select(F.col("part").alias("node"), F.col("whole").alias("component"))
    return stored(known.union(lone), "near-components")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of ``docs``.

    1. Texts with equal sets form a class, which is one node from here on, however many copies it has.
    2. Nodes meet in the buckets of their bands.  Each bucket has a centre, another in each
       band; members are compared with it, which costs as much as the bucket is large.
    3. What is linked so far joins into components.  Members of buckets that still hold several are entered
       under the first of their shingles, rarest first, so that no two that may be linked miss each
       other (``prefix_places``).  Where members of several components meet, those outside the largest one are
       compared with its most typical members.
    4. Where they are still not one component, those outside the largest one are compared with all
       of other components that sizes and numbers of shingles allow.

    A comparison prunes on signatures and verifies the rest on full sets.  So every pair that shares a
    bucket is compared, connected or ruled out.  Members that only resemble each other share a bucket but few
    of their rarest shingles, so buckets of many alike do not become pairs.

    Null texts, and texts without words, have no shingles and are linked with nothing.  Of rows that
    repeat an identifier, each is linked by its own text.  Rows with a null
    identifier are never dropped or linked; their component is null.
    """
    s, narrow = settings, _narrow(docs, id_col, text_col)
    rows = stored(signatures(narrow, s), "near-signatures")
    # equal sets have equal keys, so any row of a class has those of the others
    classes = rows.filter("digest is not null and id is not null").groupBy("digest").agg(F.min(F.struct("id", "mark")).alias("of"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("node"), "digest", F.col("of.id").alias("rep"), "of.mark", "n", "keys"), "near-classes")
    exploded = classes.select(F.col("node").alias("id"), "n", F.explode("keys").alias("key"))
    order = F.struct(F.xxhash64("id", "key"), "id", "n")
    centres = exploded.groupBy("key").agg(F.count("*").alias("members"), F.min(order).alias("centre")).filter("members > 1")
    members = stored(exploded.join(centres.select("key", F.col("centre.id").alias("centre"), F.col("centre.n").alias("centre_n")), "key"), "near-members")
    met = stored(classes.select("node", "digest", "rep", "mark").join(members.select(F.col("id").alias("node")).distinct(), "node", "left_semi"), "near-met")
    candidates = stored(_candidates(narrow, met, s), "near-candidates")

    def linked(pairs: DataFrame) -> DataFrame:
        return stored(verified(likely(pairs, candidates, s), candidates, s.percent), "near-links")

    similar = lambda n, m: 100 * F.least(n, m) >= s.percent * F.greatest(n, m)
    first = members.filter((F.col("id") != F.col("centre")) & similar(F.col("n"), F.col("centre_n"))).select(*_pair("id", "centre")).distinct()
    found = components(linked(first))

    def split_groups(members: DataFrame, found: DataFrame) -> DataFrame:
        """Members of groups (key) that hold several components, with their own and the group's largest one."""
        placed = stored(members.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id")), "near-placed")
        per = placed.groupBy("key", "component").count()
        split = per.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("count", "component")).alias("main")).filter("parts > 1")
        return placed.join(split.select("key", F.col("main.component").alias("main")), "key")

    left = stored(split_groups(members.select("key", "id", "n"), found).select("id", "n", "component").distinct(), "near-left")
    places = prefix_places(left, candidates, s).drop("component")
    places = stored(split_groups(places, found), "near-places")
    # few of a typical member's shingles are rarer than the one it is met by, and it has the most links
    order = Window.partitionBy("key").orderBy("at", F.xxhash64("id"), "id")
    typical = places.filter("component = main").withColumn("typical", F.row_number().over(order)).filter(F.col("typical") <= s.typical)
    second = linked(_meeting(places.filter("component != main"), typical, s))
    if not second.isEmpty():
        found = _merged(found, second)
        places = stored(split_groups(places.drop("component", "main"), found), "near-places")
    third = linked(_meeting(places.filter("component != main"), places, s))
    if not third.isEmpty():
        found = _merged(found, third)

    placed = classes.select("node", "digest", "rep").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = placed.join(placed.groupBy("component").agg(F.min("rep").alias("first_id")), "component").select("digest", "first_id")
    named = rows.select("id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("first_id", "id"))
    return named.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
