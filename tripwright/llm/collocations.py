"""Phrase collocations counted in quotient filters.

Texts become streams of word ids, cut into shards of a bounded number of words.
A shard's two- and three-word phrases are packed word ids, which a Feistel
network permutes invertibly. The permuted number's upper part is the quotient
and its lower part the full remainder, so a filter loses nothing: it holds the
sorted entries as one bit string of quotients (a set bit per entry, a clear bit
per quotient), the remainders byte by byte, and counters of one byte that spill
over into long ones. Filters are cut into blocks of quotients; a block's filters
from all shards are merged as sorted runs in one task, whose memory is that of
the block's distinct phrases. Where words stand in fewer than the least number of
places, so does every phrase that holds them, and they get no id.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwright.llm.common import byte_groups, mix64, written

LEAST_COUNT = 10
# A longer phrase with this share (in hundredths) of a phrase's count replaces it.
COVERED = 50
TOP = 2_000
SCALE = 1_000_000
# Words of a shard, about; and phrases of a block of quotients, about.
SHARD_WORDS = 1 << 20
BLOCK_PHRASES = 1 << 18
# Texts are cut into words in slices of about so many bytes.
SLICE = 1 << 20
# Salts of the first of two steps of the ranking, so that no language is sorted in one task.
SALTS = 64
# What ends a piece, and what parts words; the constants of the rounds.
ENDS = b".,;:!?\n\x0b\x0c\r"
ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
TABLE = bytes(10 if b in ENDS else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
BREAK, NONE = -1, -2

SHARDS = "shard long, lang string, word string, local int, n long, stream binary"


class Numbers(dict):
    """Numbers words as they come, from a counter that several languages share."""

    def __init__(self, names: list[tuple[str, bytes]], lang: str):
        super().__init__({b"\n": BREAK, b"": NONE})
        self.names, self.lang = names, lang

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self.names)
        self.names.append((self.lang, word))
        return number


def numbered(text: bytes, numbers: Numbers) -> Iterator[np.ndarray]:
    """The text's words as numbers, with a break at the end of each piece; slices end between words."""
    text = text.translate(TABLE)
    low = 0
    while low < len(text):
        ends = [at for at in (text.find(b" ", low + SLICE), text.find(b"\n", low + SLICE)) if at >= 0]
        high = min(ends, default=len(text))
        tokens = text[low:high].replace(b"\n", b" \n ").split(b" ")
        found = np.fromiter(map(numbers.__getitem__, tokens), np.int32, len(tokens))
        yield found[found != NONE]
        low = high
    yield np.array([BREAK], np.int32)


def _shard_rows(shard: int, names: list[tuple[str, bytes]], parts: list[np.ndarray]) -> pa.RecordBatch:
    """One row per word of the shard, numbered by falling count, and one row with the stream."""
    stream = np.concatenate(parts)
    counts = np.bincount(stream[stream >= 0], minlength=len(names))
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(names) + 1, np.int32)
    rank[order] = np.arange(len(names), dtype=np.int32)
    rank[-1] = BREAK
    planes = rank[stream].view(np.uint8).reshape(-1, 4).T.tobytes()
    words = pa.array([names[at][1] for at in order] + [None], pa.binary()).cast(pa.string())
    langs = pa.array([names[at][0] for at in order] + [None], pa.string())
    none = np.arange(len(names) + 1) == len(names)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(names) + 1, shard)),
            langs,
            words,
            pa.array(np.arange(len(names) + 1, dtype=np.int32), mask=none),
            pa.array(np.append(counts[order], 0), mask=none),
            pa.array([None] * len(names) + [zlib.compress(planes, 1)], pa.binary()),
        ],
        names=["shard", "lang", "word", "local", "n", "stream"],
    )


def shards(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The corpus in shards: rows (shard, lang, word, local, n), and rows (shard, stream)."""

    def cut(batches):
        next_shard = TaskContext.get().partitionId() << 32
        names, by_lang, parts, size = [], {}, [], 0
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for low, _, texts in byte_groups(batch.column(1)):
                for at, body in enumerate(texts):
                    spoken = langs[low + at]
                    if spoken not in by_lang:
                        by_lang[spoken] = Numbers(names, spoken)
                    for part in numbered(body, by_lang[spoken]):
                        parts.append(part)
                        size += len(part)
                    if size >= SHARD_WORDS:
                        yield _shard_rows(next_shard, names, parts)
                        next_shard += 1
                        names, by_lang, parts, size = [], {}, [], 0
        if parts:
            yield _shard_rows(next_shard, names, parts)

    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return named.mapInArrow(cut, SHARDS)


def half_bits(id_bits: int) -> int:
    """Bits of each half of a permuted phrase, in whole bytes, four at least."""
    return max(32, -(-3 * id_bits // 16) * 8)


def permute(first: np.ndarray, second: np.ndarray, third: np.ndarray, id_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two halves of packed word ids after the rounds: one to one."""
    half, bits = np.uint64(half_bits(id_bits)), np.uint64(id_bits)
    mask = (np.uint64(1) << half) - np.uint64(1)
    low = (second << bits) | third
    # the packed number has 3 * id_bits bits; its upper part is first and what of low is beyond the half
    left = low >> half
    if 2 * id_bits > half:
        left = left | (first << (bits + bits - half))
    else:
        low = low | (first << (bits + bits))
        left = first >> (half - bits - bits)
    right = low & mask
    for salt in ROUNDS:
        left, right = right, left ^ (mix64(right + np.uint64(salt)) & mask)
    return left, right


def restore(left: np.ndarray, right: np.ndarray, id_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The word ids behind ``permute``."""
    half, bits = np.uint64(half_bits(id_bits)), np.uint64(id_bits)
    mask, one = (np.uint64(1) << half) - np.uint64(1), (np.uint64(1) << bits) - np.uint64(1)
    for salt in reversed(ROUNDS):
        left, right = right ^ (mix64(left + np.uint64(salt)) & mask), left
    third = right & one
    if 2 * id_bits > half:
        second = ((right >> bits) | (left << (half - bits))) & one
        return left >> (bits + bits - half), second, third
    second = (right >> bits) & one
    return ((right >> (bits + bits)) | (left << (half - bits - bits))) & one, second, third


def summed(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order, equal ones as one with the sum of their counts."""
    if half == 32:
        key = (left << np.uint64(32)) | right
        order = np.argsort(key, kind="stable")
    else:
        order = np.lexsort((right, left))
    left, right, counts = left[order], right[order], counts[order]
    if not len(left):
        return left, right, counts
    new = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
    return left[new], right[new], np.add.reduceat(counts, new)


def _bytes_of(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T).tobytes()


def _values_of(data: bytes, size: int, many: int) -> np.ndarray:
    out = np.zeros((many, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(size, many).T
    return out.view("<u8").ravel().astype(np.uint64)


def pack(left: np.ndarray, right: np.ndarray, counts: np.ndarray, half: int, taken: int) -> bytes:
    """A filter of sorted distinct entries that share the upper ``taken`` bits of ``left``."""
    many, free = len(left), half - taken
    # about one quotient per entry, and remainders of whole bytes
    rest = max(0, -(-(free - max(many.bit_length() - 1, 0)) // 8))
    rest = min(rest, free // 8)
    own = left & ((np.uint64(1) << np.uint64(free)) - np.uint64(1)) if free < 64 else left
    quotient = (own >> np.uint64(8 * rest)).astype(np.int64)
    bits = np.zeros(int(quotient[-1]) + many, np.uint8)
    bits[quotient + np.arange(many)] = 1
    upper = np.packbits(bits).tobytes()
    small = np.minimum(counts, 255).astype(np.uint8).tobytes()
    large = counts[counts >= 255].astype("<i8").tobytes()
    return b"".join(
        [struct.pack("<IBI", many, rest, len(upper)), upper, _bytes_of(own, rest), _bytes_of(right, half // 8), small, large]
    )


def unpack(data: bytes, half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries of a filter: the free bits of left, right, counts."""
    many, rest, upper = struct.unpack_from("<IBI", data)
    at = struct.calcsize("<IBI")
    set_bits = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, upper, at)))
    at += upper
    left = (set_bits - np.arange(many)).astype(np.uint64) << np.uint64(8 * rest)
    left |= _values_of(data[at : at + rest * many], rest, many)
    at += rest * many
    right = _values_of(data[at : at + half // 8 * many], half // 8, many)
    at += half // 8 * many
    counts = np.frombuffer(data, np.uint8, many, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", -1, at + many)
    return left, right, counts


def shard_filters(streams: DataFrame, ids: DataFrame, id_bits: int, block_bits: int) -> DataFrame:
    """(block, filter): the phrases of each shard, from (of_shard, stream) and (shard, local, id)."""
    half = half_bits(id_bits)

    def count(stream: pa.Table, known: pa.Table) -> pa.Table:
        blocks, filters = [], []
        for packed in stream.column("stream").to_pylist():
            local = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T.copy().view(np.int32).ravel()
            table = np.zeros(max(int(local.max(initial=0)), 0) + 2, np.uint64)
            table[known.column("local").to_numpy()] = known.column("id").to_numpy().astype(np.uint64)
            words = table[np.where(local < 0, len(table) - 1, local)]
            pairs, triples = words[:-1], words[:-2]
            two = (pairs > 0) & (words[1:] > 0)
            three = two[:-1] & (words[2:] > 0)
            left, right = permute(
                np.concatenate([pairs[two], triples[three]]),
                np.concatenate([words[1:][two], words[1:-1][three]]),
                np.concatenate([np.zeros(two.sum(), np.uint64), words[2:][three]]),
                id_bits,
            )
            left, right, counts = summed(left, right, np.ones(len(left), np.int64), half)
            block = (left >> np.uint64(half - block_bits)).astype(np.int64)
            starts = np.flatnonzero(np.append(True, block[1:] != block[:-1])) if len(block) else []
            for low, high in zip(starts, np.append(starts[1:], len(block))):
                blocks.append(block[low])
                filters.append(pack(left[low:high], right[low:high], counts[low:high], half, block_bits))
        return pa.table({"block": pa.array(blocks, pa.int64()), "filter": pa.array(filters, pa.binary())})

    return streams.groupBy("of_shard").cogroup(ids.groupBy("shard")).applyInArrow(count, "block long, filter binary")


def frequent_phrases(filters: DataFrame, id_bits: int, block_bits: int, least: int = LEAST_COUNT) -> DataFrame:
    """(first, second, third, a): phrases of ``least`` occurrences or more; third is 0 in phrases of two words.

    A block's filters come one after the other and are merged as they come, so a
    task holds the distinct phrases of one block and as many still to be merged.
    """
    half = half_bits(id_bits)

    def merge(batches):
        at, held, waiting, limit = None, [], 0, 0

        def result():
            left, right, counts = summed(*(np.concatenate(part) for part in zip(*held)), half)
            often = counts >= least
            left = left[often] | np.uint64(at << (half - block_bits))
            words = restore(left, right[often], id_bits)
            columns = [pa.array(w.astype(np.int64)) for w in words] + [pa.array(counts[often])]
            return pa.RecordBatch.from_arrays(columns, names=["first", "second", "third", "a"])

        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != at:
                    if held:
                        yield result()
                    at, held, waiting, limit = block, [], 0, BLOCK_PHRASES
                held.append(unpack(data.as_py(), half))
                waiting += len(held[-1][0])
                if waiting > limit:
                    held = [summed(*(np.concatenate(part) for part in zip(*held)), half)]
                    limit = 2 * len(held[0][0]) + BLOCK_PHRASES
                    waiting = len(held[0][0])
        if held:
            yield result()

    sent = filters.repartition(max(1, min(1 << block_bits, 100_000)), "block").sortWithinPartitions("block")
    return sent.mapInArrow(merge, "first long, second long, third long, a long")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)) in whole numbers of 38 digits."""
    wide = lambda c: c.cast("decimal(18,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(left) * wide(right))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", top: int = TOP) -> DataFrame:
    """Per language the ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Words end at blanks and tabs, phrases also at the signs in ``ENDS``; A-Z are
    lowered. A phrase of two or three words with ``LEAST_COUNT`` occurrences is
    scored by the cut of least score (the first of equal ones). A pair in a triple
    with ``COVERED`` % of its count is dropped. A null language is ``und``; null
    and empty texts have no words; repeated rows count each time; other columns are
    ignored. Without phrases there are no rows.
    """
    cut = written(shards(docs, text, lang), "collocation_shards")
    words = cut.filter("word IS NOT NULL")
    spoken = written(words.groupBy("lang", "word").agg(F.sum("n").alias("f")), "collocation_words")
    often = written(
        spoken.filter(F.col("f") >= LEAST_COUNT).withColumn("at", F.monotonically_increasing_id()), "collocation_often"
    )
    # ids: the number of the part times the largest part, and the place in it, from 1 on
    place = F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = often.agg(F.max(place), F.max(F.shiftright("at", 33))).first()
    total = spoken.agg(F.sum("f")).first()[0] or 0
    width, last = (sizes[0] or 0) + 1, sizes[1] or 0
    named = written(
        often.select("lang", "word", "f", (F.shiftright("at", 33) * width + place + 1).alias("id")), "collocation_ids"
    )
    id_bits = max(1, (width * (last + 1)).bit_length())
    if id_bits > 32:
        raise ValueError("more than 2^32 frequent words")
    block_bits = min(max(0, (2 * total // BLOCK_PHRASES).bit_length()), 30)
    ids = words.join(named, ["lang", "word"]).select("shard", "local", "id")
    streams = cut.filter("stream IS NOT NULL").select(F.col("shard").alias("of_shard"), "stream")
    filters = shard_filters(streams, ids, id_bits, block_bits)
    phrases = written(frequent_phrases(filters, id_bits, block_bits), "collocation_phrases")

    def word(name: str, number: str) -> DataFrame:
        return named.select(F.col("id").alias(name), F.col("word").alias(f"word{number}"), F.col("f").alias(f"f{number}"), *(["lang"] if number == "1" else []))

    pairs = phrases.filter("third = 0").drop("third").join(word("first", "1"), "first").join(word("second", "2"), "second")
    pairs = written(pairs, "collocation_pairs")
    triples = phrases.filter("third > 0")
    inside = written(
        triples.select("first", "second", "a").union(triples.select("second", "third", "a"))
        .groupBy("first", "second").agg(F.max("a").alias("longer")),
        "collocation_inside",
    )
    kept = pairs.join(inside, ["first", "second"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < COVERED * F.col("a"))
    )
    two = kept.select(
        "lang", F.concat_ws(" ", "word1", "word2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"),
        score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"),
    )
    begin = pairs.select("first", "second", "lang", "word1", "word2", "f1", F.col("a").alias("f12"))
    end = pairs.select(
        F.col("first").alias("second"), F.col("second").alias("third"), F.col("word2").alias("word3"),
        F.col("f2").alias("f3"), F.col("a").alias("f23"),
    )
    both = triples.join(begin, ["first", "second"]).join(end, ["second", "third"])
    cuts = [(score(F.col("a"), F.col(x), F.col(y)), k, x, y) for k, x, y in ((1, "f1", "f23"), (2, "f12", "f3"))]
    least = F.least(*(F.struct(s.alias("score"), F.lit(k).alias("k"), F.col(x).alias("l"), F.col(y).alias("r")) for s, k, x, y in cuts))
    three = both.withColumn("cut", least).select(
        "lang", F.concat_ws(" ", "word1", "word2", "word3").alias("phrase"), "a", "cut.l", "cut.r", "cut.score"
    )
    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = two.union(three).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    sums = spoken.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(sums, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
