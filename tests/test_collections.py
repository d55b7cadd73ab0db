"""Stored collections: upserts touch their buckets only, a clustered search reads what it must."""

import os
import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tripwright.operators import collections as C
from tripwright.operators import retrieval as R
from tripwright.plans import answers

POINT = "id bigint, vector array<float>, payload struct<source:string>"


def points(spark, *rows):
    return spark.createDataFrame([(i, v, (s,)) for i, v, s in rows], POINT)


def files_of(path):
    out = {}
    for folder, _, names in os.walk(path):
        for name in names:
            if name.endswith(".parquet"):
                out.setdefault(folder.rsplit("=", 1)[-1], {})[name] = os.stat(f"{folder}/{name}").st_mtime_ns
    return out


def stored(spark, path):
    return sorted(((r["id"], r["payload"]["source"], tuple(r["vector"])) for r in C.read_collection(spark, path).collect()), key=repr)


def test_upsert_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "c")
    old = [(i, [float(i), 1.0], "old") for i in range(200)]
    C.create_collection(points(spark, *old), path, 2, buckets=16)
    before = files_of(path)
    assert len(before) == 16
    new = points(spark, (3, [0.5, 0.5], "new"), (3, [0.25, 0.5], "new"), (1000, [1.0, 2.0], "new"))
    touched = C.upsert(spark, path, new)
    after = files_of(path)
    assert 1 <= len(touched) <= 2
    for bucket, held in before.items():
        assert (after[bucket] == held) == (int(bucket) not in touched)
    expected = {i: ("old", tuple(v)) for i, v, _ in old} | {3: ("new", (0.5, 0.5)), 1000: ("new", (1.0, 2.0))}
    once = sorted(((i, s, v) for i, (s, v) in expected.items()), key=repr)
    assert stored(spark, path) == once
    assert C.upsert(spark, path, new) == touched and stored(spark, path) == once
    assert C.upsert(spark, path, new.limit(0)) == [] and stored(spark, path) == once
    assert C.read_collection(spark, path).schema["vector"].metadata == {"dim": 2, "metric": "cosine", "buckets": 16}


def test_upsert_takes_the_last_and_null_ids(spark, tmp_path):
    path = str(tmp_path / "c")
    C.create_collection(points(spark, (None, [1.0, 0.0], "a"), (1, [1.0, 0.0], "a")), path, 2, buckets=3)
    new = points(spark, (None, [0.0, 1.0], "x"), (1, [0.0, 3.0], "late"), (1, [9.0, 9.0], "early"))
    order = F.when(F.col("payload.source") == "late", 2).otherwise(1)
    for _ in range(2):
        C.upsert(spark, path, new.withColumn("at", order), "at")
        assert stored(spark, path) == [(1, "late", (0.0, 3.0)), (None, "x", (0.0, 1.0))]
    with pytest.raises(PySparkException, match="vector size is not 2"):
        C.upsert(spark, path, points(spark, (5, [1.0], "short")))
    assert len(stored(spark, path)) == 2


def grouped(spark, n_groups, per_group, dim=16, spread=0.05, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n_groups, dim))
    rows = [(c + rng.normal(size=dim) * spread).tolist() for c in centres for _ in range(per_group)]
    rows += [rows[0]] * 50 + [[0.0] * dim] * 3 + [None]
    corpus = [(i, v, (f"s{i}",)) for i, v in enumerate(rows)]
    queries = [(f"q{g}", (c + rng.normal(size=dim) * spread).tolist()) for g, c in enumerate(centres[:12])]
    queries += [("zero", [0.0] * dim), ("none", None)]
    return (
        spark.createDataFrame(queries, "query_id string, vector array<float>"),
        spark.createDataFrame(corpus, POINT).repartition(6),
    )


def same(a, b):
    columns = ("query_id", "rank", "id", F.round("score", 9).alias("score"), "payload.source")
    assert sorted(map(tuple, a.select(*columns).collect())) == sorted(map(tuple, b.select(*columns).collect()))


def test_clustered_search_is_exact_and_prunes(spark, tmp_path):
    queries, corpus = grouped(spark, 40, 50)
    path, read = str(tmp_path / "c"), []
    table = C.build_clusters(corpus, path, 16, clusters=40)
    assert table.agg(F.sum("points")).first()[0] == corpus.filter("vector IS NOT NULL").count()
    near = queries.filter("query_id <> 'zero'")
    same(C.clustered_topk(near, path, 5, read=read), R.vector_topk(near, corpus, 5))
    first, second, clusters = read[0]
    assert clusters >= 30 and first + second <= clusters * 2 // 3
    # one query reads a small part
    read.clear()
    one = queries.filter("query_id = 'q3'")
    same(C.clustered_topk(one, path, 5, read=read), R.vector_topk(one, corpus, 5))
    assert sum(read[0][:2]) <= 6
    # a query without a direction scores 0 everywhere: ids decide, and nothing can be left out
    same(C.clustered_topk(queries, path, 5), R.vector_topk(queries, corpus, 5))
    same(C.clustered_topk(near, path, 5, max_query_bytes=300), R.vector_topk(near, corpus, 5))


def test_clustered_search_filters_folders(spark, tmp_path):
    queries, corpus = grouped(spark, 10, 20)
    path = str(tmp_path / "c")
    C.build_clusters(corpus, path, 16, clusters=10)
    top = C.clustered_topk(queries.filter("query_id = 'q1'"), path)
    scans = re.findall(r"PartitionFilters: \[(.*?)\]", top._jdf.queryExecution().executedPlan().toString())
    assert any("cluster" in filters for filters in scans)


@pytest.mark.parametrize("n_groups, per_group, spread", [(1, 3, 0.0), (200, 1, 1.0), (3, 100, 2.0)])
def test_clustered_search_on_odd_shapes(spark, tmp_path, n_groups, per_group, spread):
    queries, corpus = grouped(spark, n_groups, per_group, spread=spread, seed=n_groups)
    path = str(tmp_path / "c")
    C.build_clusters(corpus, path, 16, clusters=7)
    same(C.clustered_topk(queries, path, 4), R.vector_topk(queries, corpus, 4))


def test_empty_collections(spark, tmp_path):
    path = str(tmp_path / "c")
    C.build_clusters(points(spark), path, 2)
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<float>")
    assert C.clustered_topk(queries, path).count() == 0


def test_search_chain(spark, tmp_path):
    path, encode = str(tmp_path / "docs"), answers.encoder()
    docs = spark.createDataFrame(
        [(1, "a.md", "the quick brown fox " * 200), (2, "b.md", "revenue by weekday and hour"), (3, "c.md", ""), (4, "d.md", None)],
        "doc_id bigint, source string, text string",
    )
    answers.index_documents(docs, path, encode)
    asked = spark.createDataFrame([(1, "Weekday REVENUE"), (2, "brown fox"), (3, None)], "query_id bigint, question string")
    top = answers.search(spark, asked, path, encode, 1)
    found = {r["query_id"]: r["payload"] for r in top.collect()}
    assert found[1]["source"] == "b.md" and found[1]["text"] == "revenue by weekday and hour" and found[1]["token_count"] == 5
    assert found[2]["source"] == "a.md" and found[2]["chunk_index"] in (0, 1)
    text = {r["query_id"]: r["prompt"] for r in answers.prompts(top, asked.filter("question IS NOT NULL")).collect()}
    assert "[Source 1: b.md (similarity: 0.632)]\nrevenue by weekday and hour" in text[1]
    # a changed document takes the place of its old chunks
    answers.add_documents(spark, docs.filter("doc_id = 2").withColumn("text", F.lit("brown fox brown fox")), path, encode)
    again = answers.search(spark, asked, path, encode, 1).filter("query_id = 2").first()
    assert again["payload"]["source"] == "b.md" and again["score"] == pytest.approx(1.0)


def test_chunk_totals(spark):
    chunks = spark.createDataFrame([("a", 5), ("a", 2), (None, 1)], "source string, token_count int")
    got = {(r["source"], r["is_total"]): tuple(r)[2:] for r in R.chunk_totals(chunks).collect()}
    assert got == {("a", False): (2, 7, 3), (None, False): (1, 1, 1), (None, True): (3, 8, 2)}
    assert R.chunk_totals(chunks.limit(0)).collect() == []
