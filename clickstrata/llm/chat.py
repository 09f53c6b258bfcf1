"""Chat formatting: paths of reply trees by self-joins, each written as one conversation and read back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import stored

# The template's control strings.
BEGIN, END, USER, CLOSE, ROLE, ROLE_CLOSE = "<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"
_CONTROL = re.compile(r"</?s>|\[/?(?:INST|ROLE)\]")
_OPENING = r"(?:<(?=\\*/?s>)|\[(?=\\*/?(?:INST|ROLE)\]))"
_ESCAPE = re.compile(_OPENING)
_UNESCAPE = re.compile(rf"({_OPENING})\\")


def escape(text: str) -> str:
    """A backslash after the first character of every control string, one more if there are some already."""
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def format_turns(turns: Iterable[tuple[str | None, str | None]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation in the template, and the spans that a loss counts: the assistant's texts.

    Null roles and texts are empty.  Roles other than user and assistant are named.
    """
    out, spans, at = [BEGIN], [], len(BEGIN)
    for role, text in turns:
        body = escape(text or "")
        if role == "assistant":
            spans.append((at, at + len(body)))
            made = body + END
        elif role == "user":
            made = USER + body + CLOSE
        else:
            made = ROLE + escape(role or "") + ROLE_CLOSE + body + CLOSE
        out.append(made)
        at += len(made)
    return "".join(out), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns, at, role = [], len(BEGIN), "assistant"
    for m in _CONTROL.finditer(formatted, len(BEGIN)):
        body = unescape(formatted[at : m.start()])
        at = m.end()
        if m[0] == USER:
            role = "user"
        elif m[0] == ROLE_CLOSE:
            role = body
        elif m[0] in (END, CLOSE):
            turns.append((role, body))
            role = "assistant"
    return turns


def _join(left: DataFrame, right: DataFrame, here: str, there: str, how: str = "inner") -> DataFrame:
    """Rows of equal trees, null being one of its own, where column ``here`` equals ``there`` of the right side."""
    right = right.withColumnsRenamed({"tree": "tree__", there: "there__"})
    on = F.col("tree").eqNullSafe(F.col("tree__")) & (F.col(here) == F.col("there__"))
    return left.join(right, on, how).drop("tree__", "there__")


def _climb(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth and total score from the root of every node, and its ancestors 1, 2, 4 ... steps up.

    Each round joins the table with itself and so doubles the way covered; nodes that have arrived at a
    root leave it, so one deep tree costs rounds of its own nodes only.  It ends when no more
    nodes arrive: those left hang on circles.
    """
    way = F.col("up").isNotNull()
    here = stored(nodes.select("tree", "node", F.col("parent").alias("up"), F.col("parent").isNotNull().cast("bigint").alias("depth"), F.col("score").alias("total")), "tree-climb")
    arrived, jumps, before, under_way = here.filter(~way), [], None, here.filter(way).count()
    while under_way and under_way != before:
        walking = here.filter(way)
        jumps.append(walking.select("tree", "node", "up"))
        above = arrived.unionByName(walking).select("tree", "node", F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("add"))
        depth, total = F.col("depth") + F.col("more"), F.col("total") + F.col("add")
        here = stored(_join(walking, above, "up", "node").select("tree", "node", F.col("next").alias("up"), depth.alias("depth"), total.alias("total")), "tree-climb")
        arrived = arrived.unionByName(here.filter(~way))
        before, under_way = under_way, here.filter(way).count()
    return arrived.drop("up"), jumps


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The best ``branches`` root-to-leaf paths of every tree: tree, leaf, place, score, turns.

    ``messages`` has tree, node, parent (null for a root), role, text and score.
    Paths of a tree are ranked by mean score of their nodes, then by leaf; turns are
    the roles and texts from root to leaf.  A parent that doesn't exist makes its child a root;
    of rows that repeat a node the smallest counts; nodes without a number,
    and circles, which have no root, are on no path.  A null tree is a tree of its own.
    """
    one = messages.filter("node is not null").groupBy("tree", "node").agg(F.min(F.struct("parent", "role", "text", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))).alias("m"))
    nodes = stored(one.select("tree", "node", "m.*"), "tree-nodes")
    parents = nodes.select("tree", "node", F.col("node").alias("known"))
    nodes = stored(_join(nodes, parents, "parent", "node", "left").select("tree", "node", F.col("known").alias("parent"), "role", "text", "score"), "tree-nodes")
    depths, jumps = _climb(nodes)
    taken = nodes.filter("parent is not null").select("tree", "parent").distinct()
    leaves = _join(depths, taken, "node", "parent", "left_anti").withColumn("mean", F.col("total") / (F.col("depth") + 1))
    best = Window.partitionBy("tree").orderBy(F.col("mean").desc(), "node")
    chosen = leaves.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= branches)
    way = stored(chosen.select("tree", F.col("node").alias("leaf"), "place", F.col("mean").alias("score"), "node", "depth"), "tree-way")
    for k, jump in enumerate(jumps):
        up = _join(way, jump, "node", "node").select("tree", "leaf", "place", "score", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        way = stored(way.union(up), "tree-way")
    words = nodes.select("tree", "node", "role", "text")
    full = _join(way, words, "node", "node").select("tree", "leaf", "place", "score", "depth", "role", "text")
    turns = F.transform(F.array_sort(F.collect_list(F.struct("depth", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return full.groupBy("tree", "leaf", "place", "score").agg(turns.alias("turns"))


def formatted(paths: DataFrame) -> DataFrame:
    """tree, leaf, formatted conversation and loss spans (code points, end exclusive) of each path."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, masks = [], []
            for turns in batch.column(2):
                text, spans = format_turns((t["role"], t["text"]) for t in turns.as_py())
                texts.append(text)
                masks.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(masks, kind)], ["tree", "leaf", "formatted", "loss"])

    rows = paths.select("tree", "leaf", "turns")
    tree, leaf = rows.schema["tree"].dataType.simpleString(), rows.schema["leaf"].dataType.simpleString()
    return rows.mapInArrow(per_batch, f"tree {tree}, leaf {leaf}, formatted string, loss array<struct<start: bigint, end: bigint>>")


def read_back(conversations: DataFrame) -> DataFrame:
    """What :func:`formatted` conversations hold: n_turns, digests of turns and of the text under the loss mask."""
    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                turns = parse_turns(text)
                loss = "".join(unescape(text[m["start"] : m["end"]]) for m in mask)
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    names = ["tree", "leaf", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    tree, leaf = conversations.schema["tree"].dataType.simpleString(), conversations.schema["leaf"].dataType.simpleString()
    return conversations.mapInArrow(per_batch, f"tree {tree}, leaf {leaf}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def chained(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Conversations as trees for :func:`reply_paths`: each row answers the one before it.

    Rows of one turn follow each other by role and text, so repeated rows are turns of their own;
    a row without a turn comes first.
    """
    order = Window.partitionBy(id_col).orderBy(turn_col, role_col, text_col)
    rows = turns.select(F.col(id_col).alias("tree"), F.row_number().over(order).cast("bigint").alias("node"), F.col(role_col).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))
