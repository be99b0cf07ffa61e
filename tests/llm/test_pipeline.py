"""The whole pipeline against plain versions of its stages."""

import corpus_pipeline
from quayline.llm import mixing
from tests.llm.conftest import documents
from tests.llm.test_near_copies import plain_groups
from tests.llm.test_text_operators import check_contamination

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    one = corpus_pipeline.identify_language(spark, docs, SF_DIR)
    assert one.columns == columns and docs.count() * 0.97 <= one.count() < docs.count() + 1
    two = corpus_pipeline.drop_near_duplicates(spark, one, SF_DIR)
    rows = one.collect()
    groups = plain_groups([r.text for r in rows])
    first = {}
    for r, g in zip(rows, groups):
        first[g] = min(first.get(g, r.doc_id), r.doc_id)
    assert {r.doc_id for r in two.collect()} == set(first.values())
    three = corpus_pipeline.remove_benchmark_text(spark, two, SF_DIR)
    assert three.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    check_contamination(three, items)
    before = {r.doc_id: r.text for r in two.collect()}
    after = {r.doc_id: r.text for r in three.collect()}
    assert set(after) <= set(before) and sum(after[i] == before[i] for i in after) > 0.8 * len(before)
    four = corpus_pipeline.mix_sources(spark, three, SF_DIR)
    chances = {r.doc_id: r.selected for r in mixing.mix(three).collect()}
    assert {r.doc_id for r in four.collect()} == {i for i, kept in chances.items() if kept}


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    rows = sorted(map(tuple, out.select("doc_id", "start", "n_tokens").collect()))
    at = 0
    for _, start, n in rows:
        assert start == at
        at += n
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and len(rows) > 50


def test_awkward_documents(spark, docs, clashing, no_docs, tmp_path):
    for df in (docs, clashing, no_docs):
        for name, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF_DIR)
            path = f"{tmp_path}/{name}-{df.count()}"
            df.write.mode("overwrite").parquet(path)
            df = spark.read.parquet(path)
        assert df.count() <= len(documents())
