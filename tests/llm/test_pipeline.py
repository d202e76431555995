"""The pipeline, stage by stage and as a whole."""

from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from sunledger.llm import exact_dedup, simhash
from tests.llm.fixtures import clashing, empty
from tests.llm.test_dedup import brute_components, brute_exact
from tests.llm.test_mix_pack import whole_ids

FOLDER = "/root/testdata/sf0.001"


def test_run_matches_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    clean = corpus_pipeline.clean_stage(spark, docs, FOLDER)
    assert clean.count() >= 0.8 * docs.count()
    exact = corpus_pipeline.exact_stage(spark, clean, FOLDER)
    assert exact.count() == brute_exact([tuple(r) for r in clean.select("doc_id", "text").collect()])[1]
    near = corpus_pipeline.near_stage(spark, exact, FOLDER)
    assert near.count() == brute_components([tuple(r) for r in exact.select("doc_id", "text").collect()])[1]
    mixed = corpus_pipeline.mix_stage(spark, near, FOLDER)
    assert mixed.columns == docs.columns and mixed.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    assert mixed.where("n_chars <> char_length(text)").count() == 0
    final = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r["doc_id"] for r in final} == {r["doc_id"] for r in mixed.collect()}
    tokens = defaultdict(int)
    for r in mixed.collect():
        tokens[r["doc_id"]] += len(whole_ids(r["text"]))
    got = defaultdict(int)
    for r in final:
        got[r["doc_id"]] += r["length"]
    assert got == tokens
    again = corpus_pipeline.run(spark, FOLDER).collect()
    key = lambda r: repr((r["doc_id"], r["start"], r["length"], r["ids_crc32"]))
    assert sorted(map(key, again)) == sorted(map(key, final))


def test_stages_on_odd_tables(spark):
    for make in (clashing, empty):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, FOLDER)
            rows = out.count()
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
            assert (rows > 0) == (make is clashing)


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]
    assert exact_dedup.query and simhash.query
