"""The corpus pipeline, stage by stage against brute force."""

from __future__ import annotations

import random
import time
import uuid
from collections import Counter
from pathlib import Path

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from clickstrata.llm import common, near_dedup
from clickstrata.llm.common import BATCH_BYTES, BATCH_SETTING, small_batches, stored, table
from pyspark.sql import functions as F

from .test_dedup import exact_by_hand, near_by_hand
from .test_shaping import check_places, targets_by_hand

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "near dedup", "mixing", "packing"]
    docs, seen = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-pipeline")
        seen.append(docs)
        if name != "packing":
            assert docs.columns == COLUMNS
    given = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    good, exact, near, mixed, packed = ([tuple(r) for r in s.collect()] for s in seen)
    assert all(tuple(given[r[0]]) == r for part in (good, exact, near, mixed) for r in part)
    quality = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = {r[0] for r in good}
    assert sum((i in kept) == bool(q) for i, q in quality.items()) >= 0.9 * len(quality)
    assert sorted(r[0] for r in exact) == sorted(r[0] for r in exact_by_hand([r[:2] for r in good]) if r[3])
    assert sorted(r[0] for r in near) == sorted(r[0] for r in near_by_hand([r[:2] for r in exact], near_dedup.Settings()) if r[3])
    size = {r[0]: len(r[1].split()) for r in near}
    copies = Counter(r[0] for r in mixed)
    assert max(copies.values()) <= 2 and set(copies) <= set(size)
    totals, taken = Counter(), Counter()
    for r in near:
        totals[r[3]] += size[r[0]]
        taken[r[3]] += size[r[0]] * copies[r[0]]
    largest = {s: max(size[r[0]] for r in near if r[3] == s) for s in totals}
    assert all(abs(taken[s] - t) <= largest[s] / 2 + 1e-6 for s, t in targets_by_hand(totals).items())
    places = seen[-1].collect()
    check_places(places, 2048)
    assert Counter(r.doc_id for r in places if r.piece == 0) == copies


def test_stages_keep_other_columns_and_hard_rows(spark, frame, hard):
    docs = frame(hard)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert {r.score for r in out.collect()} <= {"mine"}
    empty = frame([])
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, empty, SF).count() == 0, name


def test_quality_stage_on_hard_rows(spark, frame, hard):
    out = corpus_pipeline.STAGES[0][1](spark, frame(hard), SF)
    assert out.columns == frame(hard).columns and {r.predicted for r in out.collect()} <= {"mine"}
    assert corpus_pipeline.STAGES[0][1](spark, frame([]), SF).count() == 0


def test_dedup_stages_keep_one_row_per_group_whatever_the_ids(spark, frame):
    prose = " ".join(f"word{i}" for i in range(100))
    near = [f"{prose} end{i}" for i in range(4)]
    other = " ".join(f"other{i}" for i in range(100))
    shard = [(7, prose), (8, "short text"), (None, "short  text"), (None, "no id"), (None, "no id")]
    rows = shard + shard + [(5, near[0]), (5, near[1]), (5, other), (None, near[2]), (None, near[3])]
    want = sorted([(7, prose), (8, "short text"), (None, "no id"), (5, near[0]), (5, near[1]), (5, other), (None, near[2]), (None, near[3])], key=repr)
    tied = []
    for parts in (1, 5):
        exact = stored(corpus_pipeline.exact_stage(spark, frame(rows).repartition(parts), SF), "test-exact")
        assert sorted(((r.doc_id, r.text) for r in exact.collect()), key=repr) == want
        kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_stage(spark, exact, SF).collect()]
        assert sorted((i or 0, t in near) for i, t in kept) == [(0, False), (5, False), (5, True), (8, False)]
        tied.append(next(t for i, t in kept if t in near))
        # copies meet in the near stage too, if they come there
        alone = corpus_pipeline.near_stage(spark, frame([(None, prose), (None, prose), (3, other), (3, other)]), SF)
        assert sorted((r.doc_id or 0, r.text) for r in alone.collect()) == [(0, prose), (3, other)]
    assert tied[0] == tied[1]


def test_stages_hand_texts_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    """Both sides hold a batch at once; by default it is a whole partition of texts."""
    text = F.concat(F.lit("The quick brown fox looks for words in line "), F.col("id").cast("string"), F.lit("."))
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(text, F.lit("\n")), 40).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"), F.lit(1900).alias("n_chars"))
    frames, before = type(docs), spark.conf.get(BATCH_SETTING, None)
    plain = frames.mapInArrow

    def watched(df, func, *args, **kwargs):
        def noting(batches):
            def seen():
                for batch in batches:
                    with open(f"{folder}/sizes", "a") as f:
                        f.write(f"{batch.nbytes}\n")
                    yield batch

            yield from func(seen())

        return plain(df, noting, *args, **kwargs)

    monkeypatch.setattr(frames, "mapInArrow", watched)
    for name, stage in corpus_pipeline.STAGES:
        folder = tmp_path / name.replace(" ", "-")
        folder.mkdir()
        stage(spark, docs, SF).write.format("noop").mode("overwrite").save()
        assert spark.conf.get(BATCH_SETTING, None) == before
        if name != "mixing":
            sizes = [int(n) for n in (folder / "sizes").read_text().split()]
            assert sum(sizes) > 4 * BATCH_BYTES and max(sizes) < 1.5 * BATCH_BYTES, name


def test_small_batches_end_with_the_block(spark):
    before = spark.conf.get(BATCH_SETTING, None)
    rows = spark.range(0, 50, 1, 1).select(F.repeat(F.lit("x"), 200_000).alias("text"))

    def counted(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    found = rows.mapInArrow(counted, "n bigint")
    with pytest.raises(ValueError), small_batches(spark):
        inside = [r.n for r in found.collect()]
        raise ValueError
    assert sum(inside) == 50 and max(inside) <= BATCH_BYTES // 200_000 + 1
    assert spark.conf.get(BATCH_SETTING, None) == before


def test_copies_of_texts_take_less_disk_than_the_input(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(20_000)}" for _ in range(300)) for _ in range(1500)]
    spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint").coalesce(2).write.parquet(f"{tmp_path}/docs")
    monkeypatch.setattr(common, "scratch_path", lambda _, label: f"{tmp_path}/scratch/{label}-{uuid.uuid4().hex}")
    size = lambda folder: sum(p.stat().st_size for p in Path(folder).glob("*.parquet"))
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, SF)
        if name != "quality classifier":
            assert out.count() == len(texts)
    for label, rows in (("exact-rows", len(texts)), ("near-rows", len(texts)), ("quality-kept", None)):
        (folder,) = (tmp_path / "scratch").glob(f"{label}-*")
        assert all({pq.ParquetFile(p).metadata.row_group(0).column(1).compression} == {"ZSTD"} for p in folder.glob("*.parquet") if pq.ParquetFile(p).metadata.num_row_groups), label
        assert rows is None or size(folder) < 0.85 * size(tmp_path / "docs"), label


def test_shuffle_files_of_a_stored_table_go_with_its_job(spark):
    folders = [Path(d.getPath()) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    found = lambda: {p for d in folders for p in d.glob("*/shuffle_*")}
    key, before = common.CLEANUP_SETTING, found()
    setting = spark.conf.get(key, None)
    out = stored(spark.range(0, 1000, 1, 4).repartition(5, "id").groupBy((F.col("id") % 7).alias("k")).count(), "test-shuffled")
    end = time.time() + 20
    while found() - before and time.time() < end:
        time.sleep(0.2)
    assert not found() - before
    assert spark.conf.get(key, None) == setting
    assert sorted(r["count"] for r in out.collect()) == [142] + [143] * 6
