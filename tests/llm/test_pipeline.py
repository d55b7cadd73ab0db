import pytest

import corpus_pipeline
from tripwright.llm import decontamination, secret_scan, toxicity
from tripwright.llm.queries import op2_toxicity, toxic_model


def test_stages_apply_their_decisions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "ngram_jaccard", "decontamination", "secret_scan", "byte_bpe"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), name)
        assert docs.columns == before.columns and docs.dtypes == before.dtypes
        kept[name] = docs
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in kept.items()}
    all_docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = toxic_model(all_docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    clean = {r["doc_id"] for r in toxicity.score(all_docs, model).filter("score < 0.3").collect()}
    assert ids["toxicity"] == clean
    assert ids["ngram_jaccard"] <= clean and len(clean) > len(ids["ngram_jaccard"]) > 0
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    index = decontamination.build_index(kept["ngram_jaccard"], decontamination.asked_terms(benchmark))
    found = decontamination.contamination(index, decontamination.search(index, benchmark))
    assert ids["decontamination"] == {r["doc_id"] for r in found.filter("n_hit = 0").collect()}
    assert ids["secret_scan"] == ids["decontamination"]
    left = secret_scan.scan(kept["secret_scan"]).filter("size(findings) > 0")
    assert left.count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in last} == ids["secret_scan"]
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in last)
    assert {r["doc_id"]: r["ids_sha256"] for r in corpus_pipeline.run(spark, sf_dir).collect()} == {
        r["doc_id"]: r["ids_sha256"] for r in last
    }


def test_odd_rows(documents, tmp_path, spark):
    rows = [(1, "plain words that say nothing at all"), (1, "plain words that say nothing at all"), (None, None), (2, ""), (None, "x y z"),
            (3, "password=abcdefgh123")]
    docs = documents(*rows)
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "x y z"), (None, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    out = corpus_pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"] > 0) for r in out) == [(1, True), (2, False), (3, True)] or sorted(
        (r["doc_id"] or -1, r["n_tokens"] > 0) for r in out
    ) == [(-1, False), (1, True), (3, True)]


@pytest.mark.parametrize("labels", [[], [(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1)], [(1, 1, 0), (3, 1, 0)], [(1, 1, 1), (90, 1, 0), (91, 1, 0)]])
def test_without_both_classes_no_document_is_rejected(documents, tmp_path, spark, labels):
    folder = str(tmp_path)
    docs = documents(*[(i, f"text number {i}") for i in range(8)], (None, None))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.drop_toxic(spark, docs, folder).count() == 9
    assert {r["predicted"] for r in op2_toxicity(spark, folder).collect()} == {0}
