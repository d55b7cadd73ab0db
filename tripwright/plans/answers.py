"""From documents to prompts: chunks, vectors, a stored collection, search, contexts."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.operators import collections, retrieval

Encoder = Callable[[DataFrame, str], DataFrame]

# Words whose slot an encoder remembers; beyond that it starts anew.
REMEMBERED = 1 << 20


def word_slots(dim: int = retrieval.VECTOR_SIZE) -> Callable[[], Callable[[list[str]], np.ndarray]]:
    """A model for ``embed_batch``: counts of the lower-cased words, dealt over ``dim`` slots by their MD5.

    Texts with the same words, in any order, have the same vector, on any engine
    that has this digest. A text without words has the zero vector.
    """

    def load():
        slots: dict[str, int] = {}
        blanks = re.compile(r"[^ \t\n\x0B\f\r]+")

        def slot(word: str) -> int:
            if word not in slots:
                if len(slots) >= REMEMBERED:
                    slots.clear()
                slots[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dim
            return slots[word]

        def encode(texts: list[str]) -> np.ndarray:
            out = np.zeros((len(texts), dim))
            for row, text in enumerate(texts):
                found = [slot(word) for word in blanks.findall((text or "").lower())]
                out[row] = np.bincount(np.array(found, int), minlength=dim)
            return out

        return encode

    return load


def encoder(dim: int = retrieval.VECTOR_SIZE, model=None) -> Encoder:
    """The one encoder that chunks and questions share."""
    return lambda rows, text: retrieval.embed_batch(rows, text, dim, model or word_slots(dim))


def points_of(docs: DataFrame, encode: Encoder, doc_id: str = "doc_id") -> DataFrame:
    """(id, vector, payload) per chunk of the documents (id, source, text); the payload holds what is shown."""
    chunks = retrieval.chunk_docs(docs, keys=(doc_id, "source"))
    vectors = encode(chunks, "text")
    payload = F.struct("source", "chunk_index", "text", "token_count")
    return vectors.select(F.concat_ws("-", doc_id, "chunk_index").alias("id"), "vector", payload.alias("payload"))


def index_documents(docs: DataFrame, path: str, encode: Encoder, dim: int = retrieval.VECTOR_SIZE, doc_id: str = "doc_id") -> DataFrame:
    """Replaces the collection at ``path`` by the chunks of ``docs``; document ids must be unique."""
    return collections.create_collection(points_of(docs, encode, doc_id), path, dim)


def add_documents(spark: SparkSession, docs: DataFrame, path: str, encode: Encoder, doc_id: str = "doc_id") -> list[int]:
    """Adds chunks to the collection, or puts them in place of the document's chunks of the same number."""
    return collections.upsert(spark, path, points_of(docs, encode, doc_id))


def search(spark: SparkSession, questions: DataFrame, path: str, encode: Encoder, k: int = retrieval.TOP_K) -> DataFrame:
    """The ``k`` best chunks per question (query_id, question): query_id, rank, id, score, payload.

    Exact, by cosine. A question without words scores 0 everywhere; a null
    question is read as empty.
    """
    asked = questions.withColumn("question", F.coalesce("question", F.lit("")))
    vectors = encode(asked.select("query_id", "question"), "question").select("query_id", "vector")
    points = collections.read_collection(spark, path).select("id", "vector", "payload")
    return retrieval.vector_topk(vectors, points, k)


def prompts(top: DataFrame, questions: DataFrame) -> DataFrame:
    """(query_id, prompt): each question with the chunks found for it."""
    return retrieval.build_prompt(retrieval.build_context(top), questions)
