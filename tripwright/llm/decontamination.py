"""Benchmark decontamination by a distributed positional inverted index.

The corpus is cut into shards of whole documents with a bounded number of words.
A shard's index holds, for each term a benchmark asks for, the positions at which
it stands in the shard. A phrase is found by intersecting the lists of its
terms, each shifted by the term's place in the phrase, from the rarest list on.
A gap between documents keeps matches inside one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import byte_texts, words_of, written

WINDOW = 10
# Words per shard (a longer document is a shard by itself), and the gap between documents.
SHARD_WORDS = 2_000_000
GAP = 64
# The benchmark is looked up in blocks of this many words, each broadcast.
BLOCK_WORDS = 500_000
# Bits of the flag table that says which terms are asked for (fixed size: 4 MB as bytes).
FLAG_BITS = 22
CACHE_ENTRIES = 500_000

INDEX = "shard long, term long, positions binary, doc_ids array<{id}>, lengths array<int>"


def term_codes(words: list[bytes], known: dict[bytes, int]) -> list[int]:
    """A 64-bit code per word; ``known`` is a bounded memory of codes."""
    if len(known) > CACHE_ENTRIES:
        known.clear()
    get = known.get
    out = []
    for word in words:
        code = get(word)
        if code is None:
            code = known[word] = xxhash.xxh64_intdigest(word) >> 1
        out.append(code)
    return out


def flag_places(codes: np.ndarray) -> np.ndarray:
    return codes & ((1 << FLAG_BITS) - 1)


def build_index(
    docs: DataFrame, flags: np.ndarray | None = None, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The index, written to the shared folder.

    Two sorts of rows: (shard, term, positions) with 32-bit positions in rising
    order, and one row per shard without a term that lists its documents and
    their numbers of words. ``flags`` leaves out terms that nobody asks for; it
    has a fixed size and may let through more. Null has no words, and every row
    of ``docs`` is a document of its own. No shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(flags)
    rows = docs.select(id_col, text)
    id_type = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, known, number = shared.value, {}, TaskContext.get().partitionId() << 32
        ids, lengths, codes, held = [], [], [], 0

        def shard(id_kind) -> pa.RecordBatch:
            ends = np.cumsum(np.array(lengths) + GAP)
            all_codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
            # where each word stands, gaps included
            at = np.arange(len(all_codes)) + np.repeat(ends - np.cumsum(lengths) - GAP, lengths)
            if wanted is not None:
                chosen = wanted[flag_places(all_codes)]
                all_codes, at = all_codes[chosen], at[chosen]
            order = np.argsort(all_codes, kind="stable")
            all_codes, at = all_codes[order], at[order].astype(np.int32)
            firsts = np.flatnonzero(np.diff(all_codes, prepend=-1))
            terms = all_codes[firsts].tolist()
            parts = [part.tobytes() for part in np.split(at, firsts[1:])] if terms else []
            n = len(terms)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * (n + 1), pa.int64()),
                    pa.array([None, *terms], pa.int64()),
                    pa.array([None, *parts], pa.binary()),
                    pa.array([ids, *[None] * n], pa.list_(id_kind)),
                    pa.array([lengths, *[None] * n], pa.list_(pa.int32())),
                ],
                names=["shard", "term", "positions", "doc_ids", "lengths"],
            )

        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for doc_id, value in zip(batch.column(0).to_pylist(), byte_texts(batch.column(1))):
                found = words_of(value)
                ids.append(doc_id)
                lengths.append(len(found))
                codes.append(np.array(term_codes(found, known), np.int64))
                held += len(found) + 1
                if held >= SHARD_WORDS:
                    yield shard(kind)
                    number += 1
                    ids, lengths, codes, held = [], [], [], 0
        if ids:
            yield shard(kind)

    return written(rows.mapInArrow(run, INDEX.format(id=id_type)), "postings")


class Shard:
    """One shard's lists: the documents, and the positions of each term."""

    def __init__(self, table: pa.Table):
        terms = table.column("term").to_pylist()
        blobs = table.column("positions").to_pylist()
        self.lists = {t: np.frombuffer(b, np.int32) for t, b in zip(terms, blobs) if t is not None}
        lengths = next((x for x in table.column("lengths").to_pylist() if x is not None), [])
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths + GAP) - self.lengths - GAP

    def counts(self, codes: np.ndarray) -> np.ndarray:
        return np.array([len(self.lists.get(code, ())) for code in codes.tolist()])

    def phrase(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Positions at which the terms stand in this order, one after the other."""
        found = None
        for place in np.argsort(counts, kind="stable").tolist():
            at = self.lists[int(codes[place])]
            if found is None:
                found = at - place
            else:
                seat = np.searchsorted(at, found + place)
                seat[seat == len(at)] = 0
                found = found[at[seat] == found + place]
            if not len(found):
                break
        return found

    def near(self, codes: np.ndarray, counts: np.ndarray, slack: int) -> np.ndarray:
        """Positions of the rarest term with every other term at most ``slack`` words away."""
        order = np.argsort(counts, kind="stable").tolist()
        found = self.lists[int(codes[order[0]])]
        for place in order[1:]:
            at = self.lists[int(codes[place])]
            after = np.minimum(np.searchsorted(at, found), len(at) - 1)
            before = np.maximum(after - 1, 0)
            distance = np.minimum(np.abs(at[after] - found), np.abs(at[before] - found))
            found = found[distance <= slack]
        return found

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, side="right") - 1


def blocks(items: DataFrame, id_col: str, text: str, size: int = BLOCK_WORDS) -> Iterator[list]:
    """(item id as text, term codes) of the items that have words, a bounded block at a time."""
    block, held, known = [], 0, {}
    for item, value in items.select(F.col(id_col).cast("string"), F.col(text)).toLocalIterator():
        codes = np.array(term_codes(words_of((value or "").encode()), known), np.int64)
        if len(codes):
            block.append((item if item is not None else "null", codes))
            held += len(codes)
        if held >= size:
            yield block
            block, held = [], 0
    if block:
        yield block


def asked_terms(items: DataFrame, id_col: str = "item_id", text: str = "text") -> np.ndarray:
    """Flags of the terms that stand in ``items``."""
    flags = np.zeros(1 << FLAG_BITS, bool)
    for block in blocks(items, id_col, text):
        for _, codes in block:
            flags[flag_places(codes)] = True
    return flags


def search(
    index: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    slack: int | None = None,
    id_col: str = "item_id",
    text: str = "text",
) -> DataFrame:
    """Where the items' windows stand in the indexed documents.

    A window is ``window`` consecutive words of an item, or the whole of a shorter
    one; an item without words has none. With ``slack`` a window matches where
    every term stands within that many words of the window's rarest term, in any
    order. Columns: shard, doc_no (its place in the shard), item, start, stop (words
    of the document, stop excluded). Overlapping matches of an item are one row.
    The items are the query set: they go to the shards in blocks of bounded size.
    """
    if slack is not None and not 0 <= slack < GAP:
        raise ValueError(f"slack must be under {GAP}")
    spark = index.sparkSession
    schema = "shard long, doc_no int, item string, start int, stop int"
    out = spark.createDataFrame([], schema)
    for block in blocks(items, id_col, text):
        shared = spark.sparkContext.broadcast(block)

        def look(table: pa.Table) -> pa.Table:
            shard, rows = Shard(table), [np.zeros((4, 0), np.int64)]
            for number, (_, codes) in enumerate(shared.value):
                length = min(window, len(codes))
                counts = shard.counts(codes)
                # windows without a term that the shard lacks
                lacking = np.concatenate(([0], np.cumsum(counts == 0)))
                for at in np.flatnonzero(lacking[length:] == lacking[:-length]).tolist():
                    terms, sizes = codes[at : at + length], counts[at : at + length]
                    if slack is None:
                        found = shard.phrase(terms, sizes)
                        low, high = found, found + length
                    else:
                        found = shard.near(terms, sizes, slack)
                        low, high = found - slack, found + slack + 1
                    doc = shard.doc_of(found)
                    low = np.maximum(low - shard.starts[doc], 0)
                    high = np.minimum(high - shard.starts[doc], shard.lengths[doc])
                    rows.append(np.stack([doc, np.full(len(doc), number), low, high]))
            found = np.concatenate(rows, axis=1)
            doc, item, low, high = found[:, np.lexsort((found[2], found[1], found[0]))]
            # matches of one item have one length, so their ends rise with their starts
            apart = np.ones(len(doc), bool)
            apart[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])
            firsts = np.flatnonzero(apart)
            lasts = np.append(firsts[1:], len(doc))[: len(firsts)] - 1
            names = [shared.value[number][0] for number in item[firsts].tolist()]
            shard_no = table.column("shard")[0].as_py() if table.num_rows else 0
            return pa.table(
                {
                    "shard": pa.array([shard_no] * len(firsts), pa.int64()),
                    "doc_no": pa.array(doc[firsts], pa.int32()),
                    "item": pa.array(names, pa.string()),
                    "start": pa.array(low[firsts], pa.int32()),
                    "stop": pa.array(high[lasts], pa.int32()),
                }
            )

        out = out.unionByName(index.groupBy("shard").applyInArrow(look, schema))
    return out


def contamination(index: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per indexed document: doc_id, n_words, n_hit, items.

    ``n_hit`` counts the document's words inside any match, ``items`` lists the
    distinct items, sorted as text. A document without matches has none.
    """
    docs = index.filter(F.col("term").isNull()).select(
        "shard", F.posexplode(F.arrays_zip("doc_ids", "lengths")).alias("doc_no", "doc")
    )
    # a document has no more spans per item than words
    spans = F.array_sort(F.collect_list(F.struct("start", "stop")))
    covered = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("hit")),
        lambda done, span: F.struct(
            F.greatest(done["reach"], span["stop"]).alias("reach"),
            (done["hit"] + F.greatest(span["stop"] - F.greatest(span["start"], done["reach"]), F.lit(0))).alias("hit"),
        ),
        lambda done: done["hit"],
    )
    hits = matches.groupBy("shard", "doc_no").agg(
        covered.alias("n_hit"), F.array_sort(F.collect_set("item")).alias("items")
    )
    return docs.join(hits, ["shard", "doc_no"], "left").select(
        F.col("doc.doc_ids").alias("doc_id"),
        F.col("doc.lengths").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
