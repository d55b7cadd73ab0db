"""Document fingerprints: a multiset hash of paragraphs that adds up.

Each paragraph is hashed to a wide vector, and a document's fingerprint is the
sum of its paragraphs' vectors, lane by lane and modulo a power of two. The sum
does not depend on the order of paragraphs, and a paragraph is inserted or
deleted by adding or subtracting its vector. Strong lanes (64 bits) decide
equality. Sketch lanes (32 bits) count the paragraph's word pairs with signs, so
the difference of two fingerprints tells how much of the texts differs.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import groups, mix64

STRONG_LANES, SKETCH_LANES = 8, 256
# Rows per range of ids that one task lines up (the edit query).
ROWS_PER_RANGE = 1_000
MAX_RANGES = 50_000


class Vector:
    """The sum of paragraph vectors: strong lanes modulo 2^64, sketch lanes modulo 2^32."""

    __slots__ = ("strong", "sketch")

    def __init__(self, strong: np.ndarray, sketch: np.ndarray):
        self.strong, self.sketch = strong, sketch

    def plus(self, other: "Vector") -> "Vector":
        return Vector(self.strong + other.strong, self.sketch + other.sketch)

    def minus(self, other: "Vector") -> "Vector":
        return Vector(self.strong - other.strong, self.sketch - other.sketch)

    def encoded(self) -> str:
        return base64.b64encode(self.strong.astype("<u8").tobytes() + self.sketch.astype("<u4").tobytes()).decode()


def decoded(fingerprint: str) -> Vector:
    data = base64.b64decode(fingerprint)
    cut = 8 * STRONG_LANES
    return Vector(np.frombuffer(data[:cut], "<u8").astype(np.uint64), np.frombuffer(data[cut:], "<u4").astype(np.uint32))


def hash_paragraphs(paragraphs: list[bytes]) -> Vector:
    """The sum of the paragraphs' vectors; an empty paragraph counts too.

    A paragraph's word pairs include its first and last word with the edge.
    """
    blocks = b"".join([hashlib.blake2b(p, digest_size=8 * STRONG_LANES).digest() for p in paragraphs])
    strong = np.frombuffer(blocks, "<u8").reshape(-1, STRONG_LANES).sum(axis=0, dtype=np.uint64)
    # the edge mark 0 stands before and after each paragraph
    words = [0]
    for paragraph in paragraphs:
        if paragraph:
            words += map(zlib.crc32, paragraph.split())
            words.append(0)
    codes = np.array(words, np.uint64)
    pairs = mix64((codes[:-1] << np.uint64(32)) + codes[1:])
    lanes = (pairs >> np.uint64(40)).astype(np.int64) % SKETCH_LANES
    signs = 1.0 - 2.0 * (pairs & np.uint64(1)).astype(np.float64)
    sketch = np.bincount(lanes, weights=signs, minlength=SKETCH_LANES).astype(np.int64)
    return Vector(strong, sketch.astype(np.uint32))


def fingerprint(text: bytes) -> Vector:
    """Paragraphs are the lines of a text; the empty text is one empty paragraph."""
    return hash_paragraphs(text.split(b"\n"))


def likeness(a: Vector, b: Vector) -> float:
    """0 to 1: how much of the word pairs the two texts share; 1 for equal fingerprints.

    The squared length of a sketch estimates the sum of squares of the pairs'
    counts, and that of a difference the same of what only one text has.
    """
    if np.array_equal(a.strong, b.strong):
        return 1.0
    x, y = a.sketch.view(np.int32).astype(np.float64), b.sketch.view(np.int32).astype(np.float64)
    both = x @ x + y @ y
    return float(min(1.0, max(0.0, 2.0 * (x @ y) / both))) if both else 0.0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``fingerprint`` (base64 of the lanes).

    Null reads as the empty text. Texts that differ only in the order of their
    lines have equal fingerprints. Other columns are ignored; no shuffle.
    """
    rows = docs.select(id_col, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    id_type = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(value).encoded() for value in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=[id_col, "fingerprint"])

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, fingerprint string")


def with_next(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows dealt into ranges of ids, each sorted and closed by the row that comes next.

    Columns: bucket, guest (the closing row, which belongs to another range),
    the id and ``text`` as bytes (null: empty). Ranges start at ids that exist, so
    the row that closes one range is the head of the following; the last range is
    closed by the first row of all. Rows of one id are ordered by text, null ids
    come first. One shuffle of the texts; the range edges are quantiles.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    count, low, nulls = ids.agg(F.count("*"), F.min("id"), F.count_if(F.col("id").isNull())).first()
    ranges = min(MAX_RANGES, max(1, count // ROWS_PER_RANGE))
    edges: list[int] = []
    if ranges > 1:
        shares = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
        found = ids.agg(F.percentile_approx("id", shares, 10 * ranges)).first()[0]
        edges = sorted({edge for edge in found or [] if edge > low})
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    starts, value = F.lit(edges).cast("array<bigint>"), F.col(id_col).cast("long")
    # how many edges are at or under the id, by halving
    steps = F.array(*(F.lit(1 << bit) for bit in reversed(range(max(1, len(edges).bit_length())))))
    own = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(starts, at + step - 1) <= value, at + step).otherwise(at),
    )
    # the first row of all has the least id, or none
    first = value.isNull() if nulls else value == low
    closes = F.when(first, len(edges)).when(F.get(starts, own - 1) == value, own - 1)
    places = F.array_compact(
        F.array(
            F.struct(own.alias("bucket"), F.lit(0).alias("guest")),
            F.when(closes.isNotNull(), F.struct(closes.alias("bucket"), F.lit(1).alias("guest"))),
        )
    )
    dealt = rows.select(F.inline(places), id_col, "text")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", id_col, "text")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    The edited text has the last quarter of code points (rounded down) replaced by
    as many of the next document's first ones; the document after the last is the
    first. The edited fingerprint is the text's, with the paragraphs that the edit
    touches taken out and the new ones put in. Columns: the id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Ids are whole numbers; null ids come first. Null texts read as empty, and an
    empty text is not edited; texts are whole, whatever their length. Repeated rows
    follow each other; other columns are ignored. Empty in, empty out.
    """
    dealt = with_next(docs, id_col, text)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def edit(value: bytes, own: Vector, following: bytes) -> tuple[int, bytes, Vector]:
        chars = value.decode("utf-8", "surrogatepass")
        n = len(chars)
        taken = n // 4
        if not taken:
            return n, value, own
        kept = chars[: n - taken].encode("utf-8", "surrogatepass")
        # code points have up to four bytes
        head = following[: 4 * taken + 4].decode("utf-8", "ignore")[:taken].encode("utf-8")
        line = kept.rfind(b"\n") + 1
        out, into = value[line:].split(b"\n"), (kept[line:] + head).split(b"\n")
        return n, kept + head, own.minus(hash_paragraphs(out)).plus(hash_paragraphs(into))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # bucket, id, text and fingerprint of the row before
        for batch in batches:
            texts = batch.column("text").to_pylist()
            buckets, guests = batch.column("bucket").to_pylist(), batch.column("guest").to_pylist()
            ids = batch.column(id_col).to_pylist()
            for low, high in groups(texts):
                out = []
                for at in range(low, high):
                    own = fingerprint(texts[at])
                    if held and held[0] == buckets[at]:
                        _, held_id, value, print_ = held
                        n, edited, vector = edit(value, print_, texts[at])
                        out.append((held_id, n, hashlib.sha256(edited).hexdigest(), print_.encoded(),
                                    vector.encoded(), likeness(print_, vector), likeness(print_, own)))
                    # a range ends with its first guest
                    held = None if guests[at] else (buckets[at], ids[at], texts[at], own)
                columns = list(zip(*out)) or [[]] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (batch.schema.field(id_col).type, pa.int64(), pa.string(),
                                                              pa.string(), pa.string(), pa.float64(), pa.float64()))],
                    names=names,
                )

    return dealt.mapInArrow(
        run,
        f"`{id_col}` {id_type}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
