"""Documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm import exact_dedup, factorisation, mixing, near_dedup, packing
from clickstrata.llm.common import TEXT_CODEC, small_batches, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bundled(docs: DataFrame, *used: str) -> DataFrame:
    """``docs`` with its other columns in one, so that no name of theirs meets one of an operator's."""
    return docs.select(*used, F.struct(F.lit(True).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in used]).alias("others__"))


def _opened(bundled: DataFrame, columns: list[str]) -> DataFrame:
    return bundled.select(*[F.col(f"`{c}`") if c in bundled.columns else F.col(f"others__.`{c}`") for c in columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, scores at 0.5 or more stay.

    They are written here, since only jobs of the stage itself run in small batches.
    """
    rows = _bundled(docs, "doc_id", "text", "n_chars")
    with small_batches(spark):
        machine = factorisation.fit(docs, table(spark, sf_dir, "labels"))
        kept = stored(factorisation.classified(rows, machine).filter("predicted = 1").select(*rows.columns), "quality-kept", TEXT_CODEC)
    return _opened(kept, docs.columns)


def _numbered(docs: DataFrame, label: str) -> DataFrame:
    """``docs`` bundled, every row with a number of its own and a hash of its values; written, so that all jobs see the same numbers."""
    rows = _bundled(docs, "doc_id", "text")
    return stored(rows.withColumns({"row__": F.monotonically_increasing_id(), "tie__": F.xxhash64("text", F.col("others__").cast("string"))}), label, TEXT_CODEC)


def _first_of_groups(rows: DataFrame, members: DataFrame, label: str) -> DataFrame:
    """``rows`` without those of ``members`` (row__, group) that aren't the first of their group.

    The smallest doc_id is first, a missing one last; rows of one doc_id go by their values, so that
    reruns agree, and the number decides among equal rows.
    """
    members = stored(members, label)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "tie__", "row__")
    firsts = members.join(rows.select("row__", "doc_id", "tie__"), "row__").groupBy("group").agg(F.min(order).alias("first")).select("first.row__")
    return rows.join(members.join(firsts, "row__", "left_anti").select("row__"), "row__", "left_anti")


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, also where rows repeat a doc_id or have none."""
    rows = _numbered(docs, "exact-rows")
    members = exact_dedup.exact_duplicates(rows.select("row__", "text"), "row__").filter("group_size > 1").select("row__", F.col("keep_id").alias("group"))
    with small_batches(spark):
        firsts = _first_of_groups(rows, members, "exact-groups")
    return _opened(firsts, docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, by shingles of five words and a similarity of 0.8, whatever the rows' doc_id."""
    rows = _numbered(docs, "near-rows")
    with small_batches(spark):
        others = near_dedup.near_duplicates(rows, id_col="row__").filter("not kept").select(F.col("doc_id").alias("row__"), F.col("component_id").alias("group"))
        others = stored(others, "near-others")
    # the row that isn't among them is the one that its group is named after
    members = others.union(others.select(F.col("group").alias("row__"), "group").distinct())
    return _opened(_first_of_groups(rows, members, "near-groups"), docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix of sources takes."""
    rows = _bundled(docs, "doc_id", "source", "text")
    out = mixing.mixed(rows, mixing.mix_plan(docs)).filter("copies > 0")
    return _opened(out.withColumn("copy__", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*rows.columns), docs.columns)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mix with its place in a training sequence."""
    with small_batches(spark):
        return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

#: Learning, signatures and tokenisation have no SQL form; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}", TEXT_CODEC)
    return STAGES[-1][1](spark, docs, sf_dir)
