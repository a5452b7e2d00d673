"""The pipeline's stages against what the operators decide, on whole tables."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tidemark.llm import decontamination, quality, simhash

SF = "/root/testdata/sf0.001"


def test_stages_work_on_what_the_last_one_kept(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    read = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    state, kept = docs, []
    for _, stage in corpus_pipeline.STAGES[:3]:
        state = stage(spark, state, SF).cache()
        assert state.columns == docs.columns
        kept.append(read(state))
    good = read(quality.quality(docs).filter("kept"))
    assert kept[0] == good
    among = docs.filter(docs.doc_id.isin(sorted(good)))
    firsts = {r.component_id for r in simhash.near_duplicates(among).collect()}
    assert kept[1] == firsts
    leaked = read(decontamination.overlaps(among, spark.read.parquet(f"{SF}/benchmark.parquet")))
    assert kept[2] == firsts - leaked


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    counts = Counter(r.shard for r in out.select("shard").collect())
    assert out.count() > 0 and max(counts.values()) - min(counts.get(s, 0) for s in range(40)) <= 1


def test_empty_table_passes_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
