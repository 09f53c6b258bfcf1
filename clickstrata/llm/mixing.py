"""Mixing sources to target weights by Pareto order sampling, with built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickstrata.llm.common import stored, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Words of the mix as a share of all words; copies of a document at most.
TOTAL, MOST = 1.5, 2
#: Equal cells of the rank scale among which a source's cut is searched.
CELLS = 4096


def source_targets(sizes: DataFrame, source: str = "source", weights: Sequence[float] = WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """One row per source: source, source_size, target.

    The targets share ``total`` of all words by weight; a source stops at ``most``
    times its size and the excess is shared anew among the others.  With sources
    in the order of size over weight, the first ones stop and the rest get one
    level times their weight, so running sums give the answer without a loop.
    The windows here see one row per source.
    """
    per = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col(source).isNull(), F.col(source))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    ranked = per.withColumn("weight__", pick).withColumn("cap__", (F.col("source_size") * most).cast("double"))
    by_ratio = Window.orderBy(F.col("cap__") / F.col("weight__"), F.col(source).isNull(), F.col(source))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.withColumns({
        "caps__": F.coalesce(F.sum("cap__").over(before), F.lit(0.0)),
        "rest__": F.sum("weight__").over(everything) - F.coalesce(F.sum("weight__").over(before), F.lit(0.0)),
        "all__": F.sum("source_size").over(everything) * total,
    })
    ranked = ranked.withColumn("level__", (F.col("all__") - F.col("caps__")) / F.col("rest__"))
    # the level that holds is that of the first source which doesn't stop
    stops = F.col("cap__") <= F.col("level__") * F.col("weight__")
    level = F.min(F.when(~stops, F.struct(F.col("cap__") / F.col("weight__"), "level__"))).over(everything)["level__"]
    target = F.when(stops | level.isNull(), F.col("cap__")).otherwise(F.least(F.col("cap__"), level * F.col("weight__")))
    return ranked.select(source, "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def row_key(id_col: Column, text: Column) -> Column:
    """What tells documents apart: identifier and text, since identifiers may be missing or repeated."""
    return F.concat(F.coalesce(id_col.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def random_odds(key: Column) -> Column:
    """Odds of a number in (0, 1) that depends on the key alone, so reruns agree."""
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("double")
    u = (bits + 0.5) / float(1 << 48)
    return u / (1 - u)


def size_odds(size: Column) -> Column:
    """Inclusion odds before scaling: the root of the size's power of two, so longer documents are likelier."""
    return F.sqrt(F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(size, F.lit(1))))))


def pareto_rank(key: Column, size: Column) -> Column:
    """Random odds over inclusion odds.

    A factor common to a source's odds changes no order and is fixed by the size of
    its sample, so the rank needs no pass over the data.
    """
    return random_odds(key) / size_odds(size)


def mix_plan(docs: DataFrame, id_col: str = "doc_id", source: str = "source", size: Column | None = None, text_col: str = "text", **shares) -> DataFrame:
    """One row per source: source_size, target, whole copies and the last (rank, key) that gets one more.

    ``target / source_size`` copies of each document are expected.  The whole ones
    are certain; the words that remain are a sample of fixed size in words: documents
    in the order of rank and id, as long as half of each fits.  The cut is found in
    cells of the rank scale, summed before they are shuffled; only the documents of the
    one cell where the words run out are put in order.
    """
    size = word_count(F.col(text_col)) if size is None else size
    sizes = stored(docs.select(row_key(F.col(id_col), F.col(text_col)).alias("id"), F.col(source).alias("source"), size.alias("size")), "mix-sizes")
    targets = source_targets(sizes, **shares).withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    targets = stored(targets.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")), "mix-targets")
    ranked = sizes.filter("size > 0").withColumn("rank", pareto_rank(F.col("id"), F.col("size")))
    ranked = ranked.withColumn("cell", F.floor(F.col("rank") / (1 + F.col("rank")) * CELLS))
    cells = ranked.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("before", F.coalesce(F.sum("words").over(along), F.lit(0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    edge = cells.join(targets, same(cells, targets)).filter((F.col("before") <= F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest")))
    edge = stored(edge.select(cells["source"], "cell", "before", "rest"), "mix-edges")
    inside = ranked.join(edge, same(ranked, edge) & (ranked["cell"] == edge["cell"])).select(ranked["source"], ranked["cell"], "id", "size", "rank", "before", "rest")
    w = Window.partitionBy("source").orderBy("rank", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = inside.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(w), F.lit(0)))
    last = inside.filter(F.col("before") + F.col("size") / 2 <= F.col("rest")).groupBy("source").agg(F.max(F.struct("rank", "id")).alias("last"))
    # no document of the edge cell fits: the cut is the lower end of the cell
    floors = edge.select("source", F.col("cell").alias("edge_cell"))
    plan = targets.join(floors, same(targets, floors), "left").select(targets["source"], "source_size", "target", "whole", "rest", "edge_cell")
    plan = plan.join(last, same(plan, last), "left").select(plan["source"], "source_size", "target", "whole", "rest", "edge_cell", F.col("last.rank").alias("last_rank"), F.col("last.id").alias("last_id"))
    return stored(plan, "mix-plan")


RESULTS = ["size", "source_size", "target", "copies", "taken"]


def mixed(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", source: str = "source", size: Column | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target, copies and taken, by ``plan`` of :func:`mix_plan`.

    Null texts have size 0.  A document without words gets no copy.  Rows that
    repeat both identifier and text in a source are ranked alike, and at the cut taken alike.  A null
    source is a source of its own; rows without an identifier go by their text.  Columns
    of ``docs`` with the names of results are replaced.
    """
    size = word_count(F.col(text_col)) if size is None else size
    rows = docs.withColumn("size__", size).drop(*RESULTS)
    p = plan.select(*[F.col(c).alias(f"{c}__p") for c in plan.columns])
    rows = rows.withColumn("key__", row_key(F.col(id_col), F.col(text_col)))
    rank = pareto_rank(F.col("key__"), F.col("size__"))
    cell = F.floor(rank / (1 + rank) * CELLS)
    # Below the edge cell all are taken; in it, up to the last that fits.  Without an edge cell the whole source fits.
    at_edge = (rank < F.col("last_rank__p")) | ((rank == F.col("last_rank__p")) & (F.col("key__") <= F.col("last_id__p")))
    more = F.when(F.col("rest__p") <= 0, F.lit(False)).when(F.col("edge_cell__p").isNull(), F.lit(True)).when(cell != F.col("edge_cell__p"), cell < F.col("edge_cell__p")).otherwise(F.coalesce(at_edge, F.lit(False)))
    copies = F.when(F.col("size__") > 0, F.col("whole__p") + more.cast("bigint")).otherwise(0).cast("bigint")
    out = rows.join(p, rows[source].eqNullSafe(p["source__p"])).withColumn("copies", copies)
    keep = [rows[c] for c in rows.columns if c not in ("size__", "key__")]
    return out.select(*keep, F.col("size__").alias("size"), F.col("source_size__p").alias("source_size"), F.col("target__p").alias("target"), "copies", (F.col("copies") * F.col("size__")).alias("taken"))


#: DuckDB form of the mix over ``documents``.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) AS key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), p AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS weight, (2 * source_size)::DOUBLE AS cap FROM p
), r AS (
  SELECT *, coalesce(sum(cap) OVER b, 0) AS caps, sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS rest, sum(source_size) OVER () * 1.5::DOUBLE AS everything
  FROM w WINDOW b AS (ORDER BY cap / weight, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT min((everything - caps) / rest) FILTER (WHERE cap > (everything - caps) / rest * weight) AS any_level,
         arg_min((everything - caps) / rest, cap / weight) FILTER (WHERE cap > (everything - caps) / rest * weight) AS level FROM r
), t AS (
  SELECT source, source_size, CASE WHEN level IS NULL OR cap <= (everything - caps) / rest * weight THEN cap ELSE least(cap, level * weight) END AS target FROM r, l
), x AS (
  SELECT d.doc_id, d.key, d.size, t.source_size, t.target, t.source, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         (('0x' || substr(md5(d.key), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), k AS (
  SELECT *, u / (1 - u) / sqrt(pow(2.0::DOUBLE, floor(log2(greatest(size, 1)::DOUBLE)))) AS rank, target - whole * source_size AS rest FROM x
), c AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM k
)
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE (whole + CASE WHEN rest > 0 AND before + size / 2.0 <= rest THEN 1 ELSE 0 END)::BIGINT * size END::BIGINT AS taken
FROM c
"""
