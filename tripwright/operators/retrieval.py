"""Chunking, embedding, cosine top-k, contexts, prompts and retrieval scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Chunk size and overlap in tokens, vector size, results per question.
CHUNK_SIZE, CHUNK_OVERLAP = 500, 50
VECTOR_SIZE = 384
TOP_K = 5
SEPARATOR = "\n\n---\n\n"
PROMPT = (
    "You are a helpful data analyst assistant with expertise in NYC taxi data.\n"
    "Answer the question based on the context provided below.\n"
    "If the answer is not in the context, say so clearly.\n"
    "\n"
    "Context:\n"
    "%s\n"
    "\n"
    "Question: %s\n"
    "\n"
    "Answer:"
)

# Scores rank at full precision. This many decimals only drop the noise of double
# arithmetic, so that copies of a vector tie exactly.
SCORE_DECIMALS = 12
# Query vectors are sent to the tasks in blocks of this size.
MAX_QUERY_BYTES = 32 * 1024 * 1024
# Partial results of a query are merged in this many groups first.
MERGE_GROUPS = 64


def tokens(text: Column) -> Column:
    """Runs of characters that are no ASCII blanks."""
    return F.regexp_extract_all(text, F.lit("([^ \\t\\n\\x0B\\f\\r]+)"), F.lit(1))


def chunk_docs(
    docs: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    keys: Sequence[str] = ("source",),
    text: str = "text",
) -> DataFrame:
    """Windows of ``size`` tokens that share ``overlap`` with the window before.

    The windows are cut inside the row and exploded afterwards, so the token
    array is not copied once per window. A text without tokens gives none.
    """
    step = size - overlap
    words = docs.select(*keys, tokens(F.col(text)).alias("words")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(step))
    cuts = F.transform(starts, lambda at: F.slice("words", at + 1, size))
    return (
        words.select(*keys, F.posexplode(cuts).alias("chunk_index", "cut"))
        .withColumn("token_count", F.size("cut"))
        .select(*keys, "chunk_index", F.array_join("cut", " ").alias("text"), "token_count")
    )


def chunk_stats(chunks: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """Chunks, tokens and whole average tokens per document."""
    total = F.sum("token_count")
    return chunks.groupBy(*keys).agg(
        F.count("*").alias("chunks"),
        total.alias("total_tokens"),
        F.floor(total / F.count("*")).alias("avg_tokens"),
    )


def chunk_totals(chunks: DataFrame, keys: Sequence[str] = ("source",)) -> DataFrame:
    """``chunk_stats`` of every document and of the whole corpus (``is_total``), from one pass.

    The grouping sets are expanded before the partial sums, so the total is
    combined in each task first. Without chunks there are no rows.
    """
    total = F.sum("token_count")
    return chunks.groupingSets([list(keys), []], *keys).agg(
        (F.grouping_id() > 0).alias("is_total"),
        F.count("*").alias("chunks"),
        total.alias("total_tokens"),
        F.floor(total / F.count("*")).alias("avg_tokens"),
    )


def embed_batch(
    df: DataFrame,
    text_col: str = "text",
    dim: int = VECTOR_SIZE,
    model: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
) -> DataFrame:
    """Adds ``vector``: hashed word counts of unit length, or a model's output.

    ``model`` loads an encoder; it runs once per task, and the encoder maps a
    list of texts to a matrix. Texts reach it in Arrow batches.
    """
    if model is None:
        words = df.withColumn("_words", tokens(F.lower(text_col)))
        hashed = HashingTF(numFeatures=dim, inputCol="_words", outputCol="_counts").transform(words)
        unit = Normalizer(p=2.0, inputCol="_counts", outputCol="_unit").transform(hashed)
        return unit.withColumn("vector", vector_to_array("_unit", "float32")).drop(
            "_words", "_counts", "_unit"
        )

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = model()
        for texts in batches:
            yield pd.Series(list(np.asarray(encoder(texts.tolist()), dtype="float32")))

    return df.withColumn("vector", encode(F.col(text_col)))


def _schema(queries: DataFrame, corpus: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", corpus.schema["id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _sized_vectors(rows: DataFrame, id_col: str, dim: int) -> DataFrame:
    """Rows with a vector; one of another size than ``dim`` fails the job and names its id."""
    wrong = F.raise_error(F.concat(F.lit(f"the vector has not {dim} values: {id_col} "), F.col(id_col).cast("string")))
    checked = F.when(F.size("vector") == dim, F.col("vector")).otherwise(wrong)
    return rows.filter(F.col("vector").isNotNull()).select(id_col, checked.alias("vector"))


def _block_search(k: int, decimals: int):
    """The in-task part: best ``k`` of one corpus batch for a block of queries.

    A plain closure, so it reaches executors that lack this package.
    """

    def unit(column):
        flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        if not len(flat):
            return np.zeros((0, 0))
        matrix = np.asarray(flat.flatten(), dtype="float64").reshape(len(flat), -1)
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        return matrix / np.where(norms == 0, 1.0, norms)

    def keep_best(query_no, score, order):
        """Row numbers of the ``k`` best per query: by score, then by id."""
        ranked = np.lexsort((order, -score, query_no))
        q = query_no[ranked]
        first = np.searchsorted(q, q, side="left")
        return ranked[np.arange(len(q)) - first < k]

    def search(query_units, batch, floor=None):
        """(query number, score, row number in the batch) of the winners.

        ``floor`` holds the score each query's result must reach already.
        """
        corpus_units = unit(batch.column("vector"))
        n = len(corpus_units)
        order = np.argsort(np.argsort(np.asarray(batch.column("id")), kind="stable"))
        found = []
        for low in range(0, len(query_units), 256):
            scores = np.round(query_units[low : low + 256] @ corpus_units.T, decimals)
            if floor is not None:
                q, row = np.nonzero(scores >= floor[low : low + 256, None])
            elif n > k:
                kth = np.partition(scores, n - k, axis=1)[:, n - k]
                q, row = np.nonzero(scores >= kth[:, None])
            else:
                q, row = np.nonzero(np.ones_like(scores, dtype=bool))
            score = scores[q, row]
            best = keep_best(q, score, order[row])
            found.append((q[best] + low, score[best], row[best]))
        return tuple(np.concatenate(part) for part in zip(*found))

    return unit, keep_best, search


def _rank(partial: DataFrame, k: int) -> DataFrame:
    """Final rank of the partial winners; a query's rows are merged in groups first."""
    best_first = [F.desc("score"), F.asc("id")]
    grouped = Window.partitionBy("query_id", "merge_group").orderBy(*best_first)
    merged = (
        partial.withColumn("merge_group", F.pmod(F.xxhash64("id"), F.lit(MERGE_GROUPS)))
        .withColumn("rank", F.row_number().over(grouped))
        .filter(F.col("rank") <= k)
    )
    final = Window.partitionBy("query_id").orderBy(*best_first)
    return (
        merged.withColumn("rank", F.row_number().over(final))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def vector_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    max_query_bytes: int = MAX_QUERY_BYTES,
) -> DataFrame:
    """The ``k`` nearest corpus points per query by cosine, exact.

    ``queries`` has ``query_id`` and ``vector``, ``corpus`` has ``id`` (unique),
    ``vector`` and ``payload``. Equal scores rank by id; a zero vector scores 0. A
    NULL vector takes no part on either side, and a vector of another size than
    the first query's fails the job. Queries go to the tasks in blocks of
    ``max_query_bytes``; per block the corpus is read once, not shuffled, and each
    task gives at most ``k`` rows per query. Payloads join the final winners only.
    """
    spark = corpus.sparkSession
    schema = _schema(queries, corpus)
    wanted = queries.select("query_id", "vector").filter(F.col("vector").isNotNull())
    sample = wanted.select(F.size("vector").alias("dim")).first()
    partial = spark.createDataFrame([], schema)
    if sample is not None:
        dim = sample["dim"]
        points = _sized_vectors(corpus, "id", dim)
        for block in _query_blocks(_sized_vectors(wanted, "query_id", dim), max_query_bytes, dim):
            partial = partial.unionByName(_scan_topk(block, points, schema, k))
    return _rank(partial, k).join(corpus.select("id", "payload"), "id").select(
        "query_id", "rank", "id", "score", "payload"
    )


def _query_blocks(wanted: DataFrame, size: int, dim: int) -> Iterator[pa.Table]:
    """The queries as tables of bounded size, one at a time on the driver."""
    rows = max(1, size // (8 * max(1, dim)))
    kind = wanted.sparkSession.createDataFrame([], wanted.schema).toArrow().schema
    held = []
    for row in wanted.toLocalIterator():
        held.append(row.asDict(recursive=True))
        if len(held) == rows:
            yield pa.Table.from_pylist(held, kind)
            held = []
    if held:
        yield pa.Table.from_pylist(held, kind)


def _scan_topk(matrix: pa.Table, corpus: DataFrame, schema: T.StructType, k: int) -> DataFrame:
    unit, keep_best, search = _block_search(k, SCORE_DECIMALS)
    names = ["query_id", "id", "score"]
    shared = corpus.sparkSession.sparkContext.broadcast(
        (unit(matrix.column("vector")), matrix.column("query_id").combine_chunks())
    )

    def scan(batches):
        query_units, query_ids = shared.value
        held, floor = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            q, score, row = search(query_units, batch, floor)
            winners = pa.Table.from_arrays(
                [pa.array(q), batch.column("id").take(pa.array(row)), pa.array(score)], names=names
            )
            held = winners if held is None else pa.concat_tables([held, winners])
            ids = np.argsort(np.argsort(np.asarray(held.column("id")), kind="stable"))
            best = keep_best(np.asarray(held.column("query_id")), np.asarray(held.column("score")), ids)
            held = held.take(pa.array(best)).combine_chunks()
            if len(best) == k * len(query_units):
                # every query holds k results: the lowest of them is its floor
                floor = np.full(len(query_units), np.inf)
                np.minimum.at(floor, np.asarray(held.column("query_id")), np.asarray(held.column("score")))
        if held is not None:
            numbers = pa.array(np.asarray(held.column("query_id")))
            yield from held.set_column(0, "query_id", query_ids.take(numbers)).to_batches()

    return corpus.select("id", "vector").mapInArrow(scan, schema)


def build_context(topk: DataFrame) -> DataFrame:
    """Numbered sources of each query as one text. Expects source and text in the payload."""
    part = F.format_string(
        "[Source %d: %s (similarity: %.3f)]\n%s",
        F.col("rank"),
        F.col("payload.source"),
        F.col("score"),
        F.col("payload.text"),
    )
    # a query has at most k rows here
    parts = F.sort_array(F.collect_list(F.struct("rank", part.alias("part"))))
    context = F.array_join(F.transform(parts, lambda p: p["part"]), SEPARATOR)
    return topk.groupBy("query_id").agg(context.alias("context"))


def build_prompt(contexts: DataFrame, questions: DataFrame) -> DataFrame:
    """The prompt of each question around its context; without results the context is empty."""
    both = questions.select("query_id", "question").join(contexts, "query_id", "left")
    context = F.coalesce("context", F.lit(""))
    return both.select("query_id", F.format_string(PROMPT, context, F.col("question")).alias("prompt"))


def eval_report(topk: DataFrame, cases: DataFrame) -> DataFrame:
    """Per case: expected source, whether it was retrieved, the first result and all sources by rank.

    A case without results is no hit.
    """
    found = cases.select("query_id", "expected_source").join(topk, "query_id", "left").groupBy("query_id")
    source = F.col("payload.source")
    # a case has at most k results
    ranked = F.array_sort(F.collect_list(F.when(F.col("rank").isNotNull(), F.struct("rank", source.alias("source")))))
    return found.agg(
        F.first("expected_source").alias("expected_source"),
        F.coalesce(F.bool_or(source == F.col("expected_source")), F.lit(False)).alias("hit"),
        F.min_by(source, "rank").alias("top_source"),
        F.max("score").alias("top_score"),
        F.transform(ranked, lambda r: r["source"]).alias("sources"),
    )


def recall_at_k(topk: DataFrame, cases: DataFrame) -> DataFrame:
    """Cases whose expected source is among the results: count, total and percent."""
    hits = eval_report(topk, cases).filter("hit").select("query_id", F.lit(True).alias("hit"))
    return _percent(cases.join(hits, "query_id", "left"), F.coalesce("hit", F.lit(False)), "recall_pct")


def _percent(rows: DataFrame, right: Column, name: str) -> DataFrame:
    counted = rows.agg(F.count_if(right).alias("correct"), F.count("*").alias("total"))
    share = F.col("correct").cast("double") * 100 / F.nullif(F.col("total"), F.lit(0))
    return counted.withColumn(name, F.round(share, 2))


def answer_keywords(answers: DataFrame, cases: DataFrame) -> DataFrame:
    """Per case: whether every keyword occurs in the answer, case ignored, the missing and the found ones.

    A NULL answer and a case without an answer count as empty answers.
    """
    return _scored_keywords(cases.join(answers, "query_id", "left"))


def _scored_keywords(both: DataFrame) -> DataFrame:
    low = F.lower(F.coalesce("answer", F.lit("")))
    missing = F.filter("expected_keywords", lambda word: ~F.contains(low, F.lower(word)))
    found = F.filter("expected_keywords", lambda word: F.contains(low, F.lower(word)))
    return both.select("query_id", missing.alias("missing"), found.alias("found")).withColumn(
        "all_found", F.size("missing") == 0
    )


def answer_accuracy(answers: DataFrame, cases: DataFrame) -> DataFrame:
    return _percent(answer_keywords(answers, cases), F.col("all_found"), "accuracy_pct")
