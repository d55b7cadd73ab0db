"""Chunk windows, exact top-k on both paths, contexts and scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwright.operators import retrieval as R

LENGTHS = (0, 1, 50, 449, 450, 451, 500, 501, 900, 950, 951)


def brute_windows(n):
    return [(i, min(500, n - at)) for i, at in enumerate(range(0, n, 450))]


def test_chunk_windows(spark):
    docs = [(f"d{n}", "  " + " ".join(f"w{i}" for i in range(n)) + " ") for n in LENGTHS]
    chunks = R.chunk_docs(spark.createDataFrame(docs, "source string, text string")).collect()
    for n in LENGTHS:
        mine = sorted((c["chunk_index"], c["token_count"]) for c in chunks if c["source"] == f"d{n}")
        assert mine == brute_windows(n)
    second = next(c for c in chunks if c["source"] == "d951" and c["chunk_index"] == 1)
    assert second["text"].split()[0] == "w450" and second["text"].split()[-1] == "w949"


def test_chunk_sizes_are_parameters(spark):
    docs = spark.createDataFrame([("a", "1 2 3 4 5 6 7")], "source string, text string")
    texts = [c["text"] for c in R.chunk_docs(docs, size=3, overlap=1).orderBy("chunk_index").collect()]
    assert texts == ["1 2 3", "3 4 5", "5 6 7", "7"]


def test_embedding_has_unit_length(spark):
    docs = spark.createDataFrame([("a", "x y z"), ("b", "X  y")], "source string, text string")
    rows = {r["source"]: np.array(r["vector"]) for r in R.embed_batch(docs).collect()}
    assert all(len(v) == 384 and abs(np.linalg.norm(v) - 1) < 1e-5 for v in rows.values())
    assert rows["a"] @ rows["b"] == pytest.approx(2 / np.sqrt(6), abs=1e-4)


def test_embedding_with_a_model(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    docs = spark.createDataFrame([("a", "xyz")], "source string, text string")
    assert R.embed_batch(docs, model=load).first()["vector"] == [3.0, 1.0]


def vectors(spark, n_queries, n_corpus, seed=0):
    rng = np.random.default_rng(seed)
    q = rng.normal(size=(n_queries, 8)).astype("float32")
    c = rng.normal(size=(n_corpus, 8)).astype("float32")
    c[n_corpus // 2 : n_corpus // 2 + n_corpus // 3] = c[0]  # a third are copies
    c[1] = 0
    queries = spark.createDataFrame(
        [(f"q{i}", v.tolist()) for i, v in enumerate(q)], "query_id string, vector array<float>"
    )
    corpus = spark.createDataFrame(
        [(i, v.tolist(), (f"s{i % 7}", f"text {i}")) for i, v in enumerate(c)],
        "id bigint, vector array<float>, payload struct<source:string, text:string>",
    ).repartition(5)
    return q, c, queries, corpus


def brute_topk(q, c, k):
    out = set()
    for i, v in enumerate(q.astype("float64")):
        norms = np.linalg.norm(c.astype("float64"), axis=1) * np.linalg.norm(v)
        scores = np.round(np.divide(c @ v, norms, out=np.zeros(len(c)), where=norms > 0), R.SCORE_DECIMALS)
        for rank, j in enumerate(sorted(range(len(c)), key=lambda j: (-scores[j], j))[:k], 1):
            out.add((f"q{i}", rank, j, round(float(scores[j]), 5), f"s{j % 7}"))
    return out


@pytest.mark.parametrize("limit", [R.MAX_QUERY_BYTES, 128])
@pytest.mark.parametrize("k", [1, 5, 200])
def test_topk_is_exact_in_one_block_and_in_many(spark, limit, k):
    q, c, queries, corpus = vectors(spark, 4, 120)
    top = R.vector_topk(queries, corpus, k, max_query_bytes=limit)
    found = [(r["query_id"], r["rank"], r["id"], round(r["score"], 5), r["payload"]["source"]) for r in top.collect()]
    assert len(found) == 4 * min(k, 120)
    assert set(found) == brute_topk(q, c, k)


@pytest.mark.parametrize("limit", [R.MAX_QUERY_BYTES, 128])
def test_queries_taken_from_the_corpus(spark, limit):
    _, _, _, corpus = vectors(spark, 1, 60)
    queries = corpus.filter("id >= 54").select(F.col("id").alias("query_id"), "vector")
    top = R.vector_topk(queries, corpus, 1, max_query_bytes=limit).collect()
    assert sorted((r["query_id"], r["id"]) for r in top) == [(i, i) for i in range(54, 60)]


def test_close_scores_null_and_odd_vectors(spark):
    schema = "id bigint, vector array<float>, payload struct<source:string, text:string>"
    near = spark.createDataFrame([(1, [1.0, 0.0009], ("a", "")), (2, [1.0, 0.0], ("b", "")), (3, None, ("c", ""))], schema)
    queries = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None)], "query_id string, vector array<float>")
    assert [(r["query_id"], r["id"]) for r in R.vector_topk(queries, near, 1).collect()] == [("q", 2)]
    odd = near.unionByName(spark.createDataFrame([(4, [1.0], ("d", ""))], schema))
    with pytest.raises(Exception, match="id 4"):
        R.vector_topk(queries, odd, 1).collect()


def test_tokens_at_outer_blanks(spark):
    docs = spark.createDataFrame([("a", "# A b\n"), ("b", "\n\t\n"), ("c", None), ("d", "\tx\u00a0y  z\n")], "source string, text string")
    found = {r["source"]: (r["text"], r["token_count"]) for r in R.chunk_docs(docs).collect()}
    assert found == {"a": ("# A b", 3), "d": ("x\u00a0y z", 2)}


def test_cases_without_results_count(spark):
    top = spark.createDataFrame(
        [(1, 1, 10, 0.9, ("a.md", "first"))],
        "query_id int, rank int, id bigint, score double, payload struct<source:string, text:string>",
    )
    cases = spark.createDataFrame(
        [(1, "why?", "a.md", ["x"]), (2, "who?", "b.md", ["y"]), (3, "what?", "c.md", ["z"])],
        "query_id int, question string, expected_source string, expected_keywords array<string>",
    )
    report = {r["query_id"]: (r["hit"], r["top_source"], r["sources"]) for r in R.eval_report(top, cases).collect()}
    assert report == {1: (True, "a.md", ["a.md"]), 2: (False, None, []), 3: (False, None, [])}
    prompts = {r["query_id"]: r["prompt"] for r in R.build_prompt(R.build_context(top), cases).collect()}
    assert set(prompts) == {1, 2, 3} and "Context:\n\n\nQuestion: who?" in prompts[2]
    answers = spark.createDataFrame([(1, None), (2, "no")], "query_id int, answer string")
    assert tuple(R.answer_accuracy(answers, cases).first()) == (0, 3, 0.0)


def test_topk_without_queries_or_points(spark):
    _, _, queries, corpus = vectors(spark, 2, 12)
    assert R.vector_topk(queries.limit(0), corpus).count() == 0
    assert R.vector_topk(queries, corpus.filter("id < 0")).count() == 0


def test_context_prompt_and_scores(spark):
    top = spark.createDataFrame(
        [(1, 1, 10, 0.91265, ("a.md", "first")), (1, 2, 11, 0.5, ("b.md", "second")), (2, 1, 12, 0.1, ("c.md", "x"))],
        "query_id int, rank int, id bigint, score double, payload struct<source:string, text:string>",
    )
    contexts = {r["query_id"]: r["context"] for r in R.build_context(top).collect()}
    assert contexts[1] == (
        "[Source 1: a.md (similarity: 0.913)]\nfirst\n\n---\n\n[Source 2: b.md (similarity: 0.500)]\nsecond"
    )
    cases = spark.createDataFrame(
        [(1, "why?", "b.md"), (2, "who?", "a.md"), (3, "what?", "none.pdf")],
        "query_id int, question string, expected_source string",
    )
    prompt = R.build_prompt(R.build_context(top), cases).filter("query_id = 2").first()["prompt"]
    assert prompt.startswith("You are a helpful data analyst assistant") and prompt.endswith("Question: who?\n\nAnswer:")
    assert tuple(R.recall_at_k(top, cases).first()) == (1, 3, 33.33)
    report = {r["query_id"]: r for r in R.eval_report(top, cases).collect()}
    assert (report[1]["hit"], report[1]["top_source"], report[1]["top_score"]) == (True, "a.md", 0.91265)
    assert report[2]["hit"] is False


def test_every_keyword_must_occur(spark):
    cases = spark.createDataFrame(
        [(1, ["7,054,099", "7054099"]), (2, ["Flex", "fare"])], "query_id int, expected_keywords array<string>"
    )
    answers = spark.createDataFrame(
        [(1, "There are 7,054,099 rows"), (2, "a FLEX fare")], "query_id int, answer string"
    )
    rows = {r["query_id"]: (r["all_found"], r["missing"]) for r in R.answer_keywords(answers, cases).collect()}
    assert rows == {1: (False, ["7054099"]), 2: (True, [])}
    assert tuple(R.answer_accuracy(answers, cases).first()) == (1, 2, 50.0)
