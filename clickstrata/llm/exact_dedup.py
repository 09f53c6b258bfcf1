"""Exact duplicates: compressed radix tries name the owner of every distinct text."""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import BATCH_BYTES, SPACE, text_of

#: Bytes of text one trie holds before its heaviest subtree is spilled.
TRIE_BYTES = 96 << 20


class _Node:
    """An edge label with what hangs below it; terminal when ``count`` is positive."""

    __slots__ = ("label", "children", "owner", "count", "spill")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.count, self.spill = label, {}, None, 0, None


def _smaller(a, b):
    """Smallest identifier; missing ones lose against any."""
    return b if a is None else a if b is None else min(a, b)


class OwnerTrie:
    """Maps byte strings to their smallest identifier and number of insertions.

    When the labels held exceed ``limit`` bytes, the heaviest subtree below the
    root moves to an unlinked temporary file of this task, as a sort's runs do;
    later strings under it are appended, and it is read back into a trie of its
    own, whose strings are shorter by the prefix, when the others are done.
    """

    def __init__(self, limit: int = TRIE_BYTES):
        self.root, self.limit, self.held = _Node(b""), limit, 0

    def insert(self, key: bytes, owner, count: int = 1) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                pickle.dump((key[at:], owner, count), node.spill)
                return
            if at == len(key):
                break
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                node.children[key[at]] = child
                self.held += len(child.label)
                node, at = child, len(key)
                break
            if key.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            part = len(os.path.commonprefix((child.label, key[at : at + len(child.label)])))
            upper = _Node(child.label[:part])
            child.label = child.label[part:]
            upper.children[child.label[0]] = child
            node.children[key[at]] = upper
            node, at = upper, at + part
        node.owner = _smaller(node.owner, owner) if node.count else owner
        node.count += count
        if self.held > self.limit:
            self._spill_heaviest()

    @staticmethod
    def _walk(top: _Node, prefix: bytes = b"") -> Iterator[tuple[bytes, _Node]]:
        stack = [(prefix, top)]
        while stack:
            path, node = stack.pop()
            path += node.label
            yield path, node
            stack.extend((path, child) for child in node.children.values())

    def _spill_heaviest(self) -> None:
        weights = {k: sum(len(n.label) for _, n in self._walk(c)) for k, c in self.root.children.items() if c.spill is None}
        heaviest = self.root.children[max(weights, key=weights.get)]
        out = tempfile.TemporaryFile()
        inner: list[tuple[object, list]] = []
        for path, node in self._walk(heaviest):
            rest = path[len(heaviest.label) :]
            if node.spill is not None:
                inner.append((node.spill, rest))
            elif node.count:
                pickle.dump((rest, node.owner, node.count), out)
        for other, rest in inner:
            for key, owner, count in self._records(other):
                pickle.dump((rest + key, owner, count), out)
        self.held -= weights[heaviest.label[0]]
        heaviest.children, heaviest.owner, heaviest.count, heaviest.spill = {}, None, 0, out

    @staticmethod
    def _records(spill) -> Iterator[tuple[bytes, object, int]]:
        spill.seek(0)
        while True:
            try:
                yield pickle.load(spill)
            except EOFError:
                spill.close()
                return

    def owners(self) -> Iterator[tuple[bytes, object, int]]:
        """Every distinct string with its owner and count."""
        later = []
        for path, node in self._walk(self.root):
            if node.spill is not None:
                later.append((path, node.spill))
            elif node.count:
                yield path, node.owner, node.count
        self.root = _Node(b"")
        for path, spill in later:
            below = OwnerTrie(self.limit)
            for record in self._records(spill):
                below.insert(*record)
            for rest, owner, count in below.owners():
                yield path + rest, owner, count


def normalised(text: Column) -> Column:
    """Every run of white space as one space; null as empty."""
    return F.regexp_replace(text, f"{SPACE}+", " ")


_ROW = "owner bigint, count bigint, size int, digest string, body binary"


def _emit(trie: OwnerTrie, digests: dict[bytes, str] | None, bodies: bool) -> Iterator[pa.RecordBatch]:
    import hashlib

    names = ["owner", "count", "size", "digest"] + ["body"] * bodies
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string()] + [pa.binary()] * bodies
    rows, held = [], 0

    def batch():
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    for body, owner, count in trie.owners():
        rows.append((owner, count, len(body), hashlib.sha256(body).hexdigest()) + (body,) * bodies)
        held += len(body) * bodies + 100
        if held > BATCH_BYTES:
            yield batch()
            rows, held = [], 0
    yield batch()


def _gather_local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within one input partition meet before anything is shuffled."""
    trie = OwnerTrie()
    for batch in batches:
        for owner, body in zip(batch.column(0).to_pylist(), batch.column(1)):
            trie.insert(body.as_buffer().to_pybytes(), owner)
    yield from _emit(trie, None, True)


def _gather_owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trie = OwnerTrie()
    for batch in batches:
        for owner, count, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            trie.insert(body.as_buffer().to_pybytes(), owner, count)
    yield from _emit(trie, None, False)


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per distinct normalised text: size, digest, keep_id, group_size.

    Tries of the input partitions fold copies where they lie, so that a text
    held by a third of all rows reaches the shuffle once per partition.  Then
    the distinct texts are dealt by length and content hash, and the trie of each
    partition compares full byte strings.  The digest is taken from the bytes at
    the terminal; two terminals never share one unless SHA-256 collides.
    """
    keyed = docs.select(F.col(id_col).cast("bigint").alias("owner"), normalised(text_of(text_col)).cast("binary").alias("body"))
    local = keyed.mapInArrow(_gather_local, _ROW)
    dealt = local.repartition("size", "digest").select("owner", "count", "body")
    return dealt.mapInArrow(_gather_owners, _ROW.rsplit(",", 1)[0]).select(
        "size", F.col("digest").alias("text_sha256"), F.col("owner").alias("keep_id"), F.col("count").alias("group_size"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256; every row stays.

    Texts are equal when identical after :func:`normalised`; null texts are empty
    and equal each other.  The smallest identifier owns a group; a null identifier
    owns one only where there is no other, and is kept only then.  Rows that repeat the owner's
    identifier share its verdict.  Columns of ``docs`` with the names of results
    are replaced.
    """
    fresh = ["keep_id", "group_size", "kept", "text_sha256", "size__"]
    body = normalised(text_of(text_col))
    rows = docs.drop(*fresh).withColumns({"text_sha256": F.sha2(body.cast("binary"), 256), "size__": F.octet_length(body)})
    found = owners(docs, id_col, text_col).withColumnRenamed("size", "size__")
    # Hot digests are split by adaptive execution: the owners' side is unique.
    return rows.join(found, ["text_sha256", "size__"]).select(
        *[rows[c] for c in docs.drop(*fresh).columns],
        "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), rows["text_sha256"],
    )


#: DuckDB form of :func:`exact_duplicates`.
SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""
