"""N-gram Jaccard join with Bayesian candidate pruning.

Texts become sets of word shingles; equal sets are one node. Nodes that agree on
a band of MinHash values are candidates. A candidate pair's values are compared a
few at a time, and the pair is dropped once the posterior probability that its
similarity reaches the threshold is below a tolerance. Pairs that stay are
verified exactly on their shingles. Pairs are never rows: tasks compare blocks of
nodes and return links counted per node and edges enough to span what is linked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import byte_texts, free_name, groups, mix64, row_key, words_of, written
from tripwright.llm.components import components

SHINGLE_WORDS = 5
THRESHOLD = Fraction(4, 5)
# A pair at the threshold shares no band once in 350,000.
BANDS, BAND_VALUES = 42, 6
VALUES = BANDS * BAND_VALUES
# Values compared between two looks at the posterior, and its tolerance: all looks
# together drop a pair at the threshold once in 130 million, less than banding.
LOOK = 28
TOLERANCE = 1e-9
# Nodes and shingle bytes that one side of a compared block holds.
BLOCK_ROWS = 2_048
BLOCK_BYTES = 8 << 20
CACHE_ENTRIES = 500_000


def word_codes(words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
    if len(known) > CACHE_ENTRIES:
        known.clear()
    out = []
    for word in words:
        code = known.get(word)
        if code is None:
            code = known[word] = xxhash.xxh64_intdigest(word)
        out.append(code)
    return np.array(out, np.uint64)


def shingles(words: list[bytes], known: dict[bytes, int], size: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct 64-bit codes of runs of ``size`` words; a shorter text is one run."""
    codes = word_codes(words, known)
    n = max(0, min(len(codes), len(codes) - size + 1) if len(codes) >= size else min(1, len(codes)))
    run = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(min(size, len(codes))):
            run = mix64(run + codes[at : at + n] + np.uint64(at + 1))
    return np.unique(run)


def hash_family() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20_011)
    odd = draw.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
    return odd, draw.integers(0, 1 << 32, VALUES, dtype=np.uint32)


def signature(codes: np.ndarray, family: tuple[np.ndarray, np.ndarray]) -> bytes:
    """One byte of each MinHash value of a set that is not empty."""
    odd, shift = family
    x = (codes >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for low in range(0, len(x), 512):
        np.minimum(least, ((x[low : low + 512] ^ shift[:, None]) * odd[:, None]).min(axis=1), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()


def sketch(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """Per row: row_key, doc_id, set_id (128 bits), n_shingles, and the signature (null without words)."""
    rows = docs.select(
        F.unhex(row_key(id_col, text)).alias("row_key"), F.col(id_col).alias("doc_id"), F.col(text).alias("text")
    )
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, family = {}, hash_family()
        for batch in batches:
            texts = byte_texts(batch.column("text"))
            for low, high in groups(texts):
                set_ids, sizes, signatures = [], [], []
                for value in texts[low:high]:
                    codes = shingles(words_of(value), known)
                    # without words only equal texts are alike
                    named = codes.tobytes() if len(codes) else b"text:" + value
                    set_ids.append(hashlib.blake2b(named, digest_size=16).digest())
                    sizes.append(len(codes))
                    signatures.append(signature(codes, family) if len(codes) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row_key").slice(low, high - low),
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(set_ids, pa.binary()),
                        pa.array(sizes, pa.int32()),
                        pa.array(signatures, pa.binary()),
                    ],
                    names=["row_key", "doc_id", "set_id", "n_shingles", "signature"],
                )

    return rows.mapInArrow(
        run, f"row_key binary, doc_id {id_type}, set_id binary, n_shingles int, signature binary"
    )


def least_matches(threshold: float, tolerance: float) -> list[int]:
    """For n = 0..VALUES the fewest agreeing values with which a pair stays.

    With a uniform prior on the similarity, and byte values that agree by chance
    once in 256, the posterior is a truncated beta; its tail is integrated.
    """
    share = np.linspace(1 / 256, 1, 20_001)[:-1] + (1 - 1 / 256) / 40_000
    above = share >= threshold + (1 - threshold) / 256
    out = [0]
    for n in range(1, VALUES + 1):
        for agree in range(out[-1], n + 1):
            logs = agree * np.log(share) + (n - agree) * np.log1p(-share)
            mass = np.exp(logs - logs.max())
            if mass[above].sum() >= tolerance * mass.sum():
                break
        out.append(agree)
    return out


def survivors(one: np.ndarray, others: np.ndarray, least: list[int]) -> np.ndarray:
    """Places in ``others`` of the signatures that stay candidates of ``one``."""
    at, agree = np.arange(len(others)), np.zeros(len(others), np.int64)
    for low in range(0, VALUES, LOOK):
        seen = min(low + LOOK, VALUES)
        agree = agree + (others[at, low:seen] == one[low:seen]).sum(axis=1)
        stays = agree >= least[seen]
        at, agree = at[stays], agree[stays]
        if not len(at):
            break
    return at


def by_unit(rows: DataFrame, run_unit, schema: str, names: list[str]) -> DataFrame:
    """Rows with a column ``unit`` dealt by it; ``run_unit(rows of a unit)`` gives result columns.

    A task reads its units one after the other and holds one at a time.
    """
    kinds = [pa.binary() if "binary" in part else pa.int64() for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unit, results = [], None, []

        def flush():
            columns = [[value for part in parts for value in part] for parts in zip(*results)] or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            units = np.asarray(batch.column("unit"))
            cuts = np.flatnonzero(np.diff(units)) + 1
            for low, high in zip([0, *cuts], [*cuts, len(units)]):
                if low == high:
                    continue
                if held and units[low] != unit:
                    results.append(run_unit(pa.Table.from_batches(held)))
                    held = []
                unit = units[low]
                held.append(batch.slice(low, high - low))
            if len(results) >= 256:
                yield flush()
                results = []
        if held:
            results.append(run_unit(pa.Table.from_batches(held)))
        if results:
            yield flush()

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, schema)


def deal_blocks(rows: DataFrame, key: str, blocks) -> DataFrame:
    """Copies each row to the pairs of blocks of its key: ``unit``, ``block`` and ``cross``.

    With n blocks a row meets all rows of its key in n units, each pair once.
    """
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), (F.col("blocks") - 1).cast("int")))
    dealt = rows.withColumn("blocks", blocks).withColumn("block", block).withColumn("other", other)
    return dealt.withColumn(
        "unit", F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other"))
    ).withColumn("cross", F.col("block") != F.col("other"))


def candidate_edges(sets: DataFrame, threshold: Fraction, tolerance: float) -> DataFrame:
    """Edges (a, b) that span, per shared band, the pairs of sets that survive pruning."""
    least = least_matches(float(threshold), tolerance)
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda band: F.xxhash64(band, F.substring(F.col("signature"), band * BAND_VALUES + 1, F.lit(BAND_VALUES))),
    )
    dealt = sets.filter("signature IS NOT NULL").select("set_id", F.explode(bands).alias("band"))
    shared = dealt.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    members = dealt.join(shared, "band").join(sets.select("set_id", "signature"), "set_id")
    units = deal_blocks(members, "band", F.ceil(F.col("n") / BLOCK_ROWS))

    def link(table: pa.Table) -> tuple[list, list]:
        ids = table.column("set_id").to_pylist()
        if len(ids) < 2:
            return [], []
        values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, VALUES)
        block = np.asarray(table.column("block"))
        cross = bool(table.column("cross")[0].as_py())
        group, edges = np.arange(len(ids)), []
        for one in range(len(ids) - 1):
            # pairs already linked through others need no second look
            apart = group[one + 1 :] != group[one]
            if cross:
                apart &= block[one + 1 :] != block[one]
            rest = np.flatnonzero(apart) + one + 1
            for other in rest[survivors(values[one], values[rest], least)].tolist() if len(rest) else []:
                if group[other] != group[one]:
                    group[group == group[other]] = group[one]
                    edges.append((ids[one], ids[other]))
        return [a for a, _ in edges], [b for _, b in edges]

    columns = units.select("unit", "set_id", "signature", "block", "cross")
    return by_unit(columns, link, "a binary, b binary", ["a", "b"])


def verified_links(
    docs: DataFrame, sets: DataFrame, groups_: DataFrame, threshold: Fraction, tolerance: float, id_col: str, text: str
) -> DataFrame:
    """Per set and compared block: links to sets and documents, and an edge to what it is linked with."""
    least = least_matches(float(threshold), tolerance)
    numerator, denominator = threshold.numerator, threshold.denominator
    wanted = groups_.join(sets, F.col("node") == F.col("set_id")).select(
        "root", "set_id", "signature", "n_shingles", "n_copies", "sample_key"
    )
    wanted = written(wanted, "candidates")
    sizes = wanted.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("shingles"))
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("shingles") * 8 / BLOCK_BYTES)).cast("long")
    texts = docs.select(F.unhex(row_key(id_col, text)).alias("sample_key"), F.col(text).alias("text"))
    shingled = texts.join(wanted.select("sample_key", "set_id"), "sample_key").select("set_id", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {}
        for batch in batches:
            codes = [shingles(words_of(value), known).tobytes() for value in byte_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("set_id"), pa.array(codes, pa.binary())], names=["set_id", "codes"])

    # a row that the table repeats gives its set's shingles again
    codes = shingled.mapInArrow(cut, "set_id binary, codes binary").groupBy("set_id").agg(F.first("codes").alias("codes"))
    units = deal_blocks(wanted.join(sizes, "root").join(codes, "set_id"), "root", blocks)

    def verify(table: pa.Table) -> tuple:
        ids = table.column("set_id").to_pylist()
        values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(-1, VALUES)
        codes = [np.frombuffer(c, np.uint64) for c in table.column("codes").to_pylist()]
        lengths = np.array([len(c) for c in codes])
        copies = np.asarray(table.column("n_copies"))
        block = np.asarray(table.column("block"))
        cross = bool(table.column("cross")[0].as_py())
        n = len(ids)
        group, linked_sets, linked_docs = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for one in range(n - 1):
            rest = np.arange(one + 1, n)
            if cross:
                rest = rest[block[rest] != block[one]]
            rest = rest[survivors(values[one], values[rest], least)] if len(rest) else rest
            # the exact check, a bounded number of shingles at a time
            for part in np.array_split(rest, max(1, int(lengths[rest].sum()) >> 18)) if len(rest) else []:
                if not len(part):
                    continue
                joined = np.concatenate([codes[other] for other in part])
                seat = np.minimum(np.searchsorted(codes[one], joined), lengths[one] - 1)
                hits = np.add.reduceat((codes[one][seat] == joined).astype(np.int64), np.cumsum(lengths[part]) - lengths[part])
                alike = part[(numerator + denominator) * hits >= numerator * (lengths[one] + lengths[part])]
                linked_sets[one] += len(alike)
                linked_docs[one] += copies[alike].sum()
                linked_sets[alike] += 1
                linked_docs[alike] += copies[one]
                for other in alike[group[alike] != group[one]].tolist():
                    group[group == group[other]] = group[one]
        heads = [ids[head] for head in group.tolist()]
        return ids, heads, linked_sets.tolist(), linked_docs.tolist()

    columns = units.select("unit", "set_id", "signature", "n_copies", "codes", "block", "cross")
    names = ["set_id", "head", "linked_sets", "linked_docs"]
    return written(
        by_unit(columns, verify, "set_id binary, head binary, linked_sets long, linked_docs long", names), "links"
    )


def jaccard_join(
    docs: DataFrame,
    threshold: Fraction = THRESHOLD,
    tolerance: float = TOLERANCE,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: row_key, doc_id, class_id, n_copies, n_links, n_linked_texts.

    Two texts are linked if the Jaccard similarity of their sets of five-word
    shingles is at least ``threshold``; words are runs of digits, letters and
    everything outside ASCII, A-Z lowered. A text of fewer words is one shingle, a
    text without words is alike to equal texts only, and null reads as empty.
    ``class_id`` is the least id among all that links lead to. ``n_copies`` counts
    the rows with the same set, ``n_linked_texts`` the different sets linked, and
    ``n_links`` all other rows linked, copies included. Repeated rows are copies
    of each other. Other columns are ignored.
    """
    sketched = written(sketch(docs, id_col, text), "sketches")
    sets = written(
        sketched.groupBy("set_id").agg(
            F.first("signature").alias("signature"),
            F.first("n_shingles").alias("n_shingles"),
            F.count("*").alias("n_copies"),
            F.min("doc_id").alias("least_id"),
            F.min("row_key").alias("sample_key"),
        ),
        "sets",
    )
    near = components(candidate_edges(sets, threshold, tolerance))
    links = verified_links(docs, sets, near, threshold, tolerance, id_col, text)
    roots = components(links.select(F.col("set_id").alias("a"), F.col("head").alias("b")))
    counts = links.groupBy("set_id").agg(F.sum("linked_sets").alias("linked_sets"), F.sum("linked_docs").alias("linked_docs"))
    placed = (
        sets.select("set_id", "n_copies", "least_id")
        .join(roots.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("root", F.coalesce("root", "set_id"))
    )
    classes = placed.groupBy("root").agg(F.min("least_id").alias("class_id"))
    per_set = (
        placed.join(classes, "root")
        .join(counts, "set_id", "left")
        .select(
            "set_id",
            "root",
            "class_id",
            "n_copies",
            F.coalesce("linked_sets", F.lit(0)).alias("n_linked_texts"),
            (F.coalesce("linked_docs", F.lit(0)) + F.col("n_copies") - 1).alias("n_links"),
        )
    )
    # written, so that the join shuffles both sides itself and can split a set with very many copies
    per_set = written(per_set, "classes")
    return sketched.select("row_key", "doc_id", "set_id").join(per_set, "set_id").drop("set_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each class: that of the least id, then of the least row key.

    All columns are kept as they are, whatever their names. Of rows with one id
    and text the one with the least other columns, as JSON, stays.
    """
    joined = jaccard_join(docs, id_col=id_col, text=text)
    first = joined.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    key = free_name(docs, "kept_key")
    kept = first.select(F.col("first.row_key").alias(key))
    keyed = docs.withColumn(key, F.unhex(row_key(id_col, text))).join(kept, key, "left_semi")
    others = F.to_json(F.struct(*[c for c in docs.columns if c != text]))
    return keyed.groupBy(key).agg(F.min_by(F.struct(*docs.columns), others).alias("row")).select("row.*")
