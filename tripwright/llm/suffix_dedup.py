"""Removal of repeated strings with a blockwise suffix array.

Every 200-byte string has an anchor: the 50-gram of least hash in it. Equal
strings have equal anchors at equal places, so suffixes are bucketed by their
anchor's hash. Buckets with one member hold nothing repeated. For the others the
stretch of text that the suffixes of one anchor need is sent once. A task sorts
one block of buckets at a time: suffixes by their first bytes, long ties by the
ranks of a difference-cover sample of the block, worked out beforehand. Any two
suffixes meet sampled positions at the same distance within one period, so a tie
costs a few rank comparisons, not a walk along the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import byte_texts, groups, mix64, written

LENGTH = 200
ANCHOR = 50
# A difference cover: each difference modulo the period is that of two members (fixed values).
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
# Sampled ranks tell apart this many bytes: the period, doubled twice.
RANK_BYTES = 4 * PERIOD
# Bytes of stretches sorted at once, and rows of a bucket from which on each string is dealt by itself.
BLOCK_BYTES = 2 << 20
HOT_ROWS = 20_000
# Long texts are anchored in pieces of this many bytes.
PIECE = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
    with np.errstate(over="ignore"):
        up, down = np.full(n, base), np.full(n, inverse)
        up[0] = down[0] = 1
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Anchors:
    """Anchors of all 200-byte strings in joined texts."""

    def __init__(self):
        self.up, self.down = _powers(1 << 16)
        scramble = np.random.default_rng(7)
        self.code = scramble.integers(1, 1 << 63, 256, dtype=np.uint64)

    def runs(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        """Per run of neighbouring strings with one anchor: text number, first string,
        strings, anchor's place in the text, anchor's hash."""
        parts = []
        for number, text in enumerate(texts):
            if len(text) > PIECE:
                for low in range(0, len(text) - LENGTH + 1, PIECE):
                    piece = self._runs([text[low : low + PIECE + LENGTH - 1]])
                    parts.append((piece[0] + number, piece[1] + low, piece[2], piece[3] + low, piece[4]))
        short = [text if len(text) <= PIECE else b"" for text in texts]
        parts.append(self._runs(short))
        return tuple(np.concatenate(part) for part in zip(*parts))

    def _runs(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        lengths = np.array([len(text) for text in texts], np.int64)
        ends = np.cumsum(lengths)
        data = np.frombuffer(b"".join(texts), np.uint8)
        none = np.zeros(0, np.int64)
        if len(data) < LENGTH:
            return none, none, none, none, none
        if len(self.up) <= len(data):
            self.up, self.down = _powers(2 * len(data))
        with np.errstate(over="ignore"):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(self.code[data] * self.up[: len(data)], out=sums[1:])
            hashes = mix64((sums[ANCHOR:] - sums[:-ANCHOR]) * self.down[: len(data) - ANCHOR + 1])
        # the leftmost of equals: the place fills the low bits (a joined group stays under 2^24 bytes)
        low_bits = np.uint64((1 << 24) - 1)
        least = (hashes & ~low_bits) | np.arange(len(hashes), dtype=np.uint64)
        window, span = LENGTH - ANCHOR + 1, 1
        while 2 * span <= window:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < window:
            least = np.minimum(least[: len(least) - (window - span)], least[window - span :])
        at = (least & low_bits).astype(np.int64)
        starts = np.arange(len(at))
        owner = np.repeat(np.arange(len(texts)), lengths)[: len(at)]
        inside = starts + LENGTH <= ends[owner]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        firsts = np.flatnonzero(fresh)
        strings = np.add.reduceat(inside.astype(np.int64), firsts)
        firsts, strings = firsts[strings > 0], strings[strings > 0]
        owner, place = owner[firsts], at[firsts]
        begin = (ends - lengths)[owner]
        return owner, firsts - begin, strings, place - begin, hashes[place].view(np.int64)


class Block:
    """Stretches joined into one text, with ranks at its sampled positions."""

    def __init__(self, stretches: list[bytes]):
        self.offsets = np.cumsum([0] + [len(s) for s in stretches])[:-1]
        joined = b"".join(stretches) + bytes(LENGTH + 2 * RANK_BYTES)
        bytes_ = np.frombuffer(joined, np.uint8)
        # every eight bytes as one number
        self.words = np.zeros(len(bytes_) - 7, np.uint64)
        for offset in range(8):
            self.words = (self.words << np.uint64(8)) | bytes_[offset : len(bytes_) - 7 + offset]
        place = np.arange(len(bytes_) - LENGTH)
        member = np.isin(place % PERIOD, COVER)
        sample = np.flatnonzero(member)
        self.seat = np.cumsum(member) - 1
        rank = self._head_ranks(sample)
        for reach in (PERIOD, 2 * PERIOD):
            # sampled places are closed under steps of the period
            later = np.minimum(sample + reach, sample[-1])
            later = self.seat[later]
            rank = np.unique(rank * (len(sample) + 1) + rank[later], return_inverse=True)[1]
        self.rank = rank
        self.shift = np.zeros((PERIOD, PERIOD), np.int64)
        for a in range(PERIOD):
            for b in range(PERIOD):
                self.shift[a, b] = next(
                    d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER
                )

    def head(self, at: np.ndarray) -> list[np.ndarray]:
        """The first ``PERIOD`` bytes from each place, as four numbers."""
        return [self.words[at + offset] for offset in (0, 8, 16, PERIOD - 8)]

    def _head_ranks(self, at: np.ndarray) -> np.ndarray:
        keys = self.head(at)
        order = np.lexsort(keys[::-1])
        fresh = np.zeros(len(at), np.int64)
        for key in keys:
            fresh[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(fresh)
        return rank

    def compare(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1: how the strings at ``a`` sort to those at ``b``, whose first bytes agree."""
        shift = self.shift[a % PERIOD, b % PERIOD]
        out = self._by_rank(a + shift, b + shift)
        step = (LENGTH - RANK_BYTES - shift) // PERIOD * PERIOD
        out = np.where(out == 0, self._by_rank(a + shift + step, b + shift + step), out)
        # what the ranks leave at the end is shorter than a period
        for offset in range(LENGTH - 32, LENGTH, 8):
            x, y = self.words[a + offset], self.words[b + offset]
            out = np.where(out == 0, (x > y).astype(np.int8) - (x < y).astype(np.int8), out)
        return out

    def _by_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.sign(self.rank[self.seat[a]] - self.rank[self.seat[b]]).astype(np.int8)


def repeated_strings(stretches: list[bytes], anchor: np.ndarray, bucket: np.ndarray) -> list[np.ndarray]:
    """Per stretch a flag for each of its strings: whether it also stands in another stretch of the bucket.

    ``anchor`` is the anchor's place in the stretch. Strings of one bucket with
    the anchor at the same place are sorted; runs that tie in the first bytes
    are split about a pivot, all runs at once, until none is left.
    """
    block = Block(stretches)
    strings = np.array([len(s) - LENGTH + 1 for s in stretches])
    owner = np.repeat(np.arange(len(stretches)), strings)
    first = np.cumsum(strings) - strings
    local = np.arange(len(owner)) - first[owner]
    at = block.offsets[owner] + local
    keys = block.head(at)[::-1] + [anchor[owner] - local, bucket[owner]]
    order = np.lexsort(keys)
    tied = np.ones(len(at), bool)
    for key in keys:
        tied[1:] &= key[order][1:] == key[order][:-1]
    tied[0] = False
    run = np.cumsum(~tied)
    flags = np.zeros(len(at), bool)
    live = order
    while len(live):
        sizes = np.bincount(run, minlength=run[-1] + 1)
        more = sizes[run] > 1
        live, run = live[more], run[more]
        if not len(live):
            break
        begins = np.flatnonzero(np.diff(run, prepend=-1))
        number = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(run))))
        middle = (begins + np.append(begins[1:], len(run))) // 2
        side = block.compare(at[live], at[live[middle]][number])
        same = side == 0
        equal = np.bincount(number[same], minlength=len(begins))
        flags[live[same]] = equal[number[same]] > 1
        rest = np.flatnonzero(~same)
        branch = number[rest] * 2 + (side[rest] > 0)
        sort = np.argsort(branch, kind="stable")
        live, run = live[rest[sort]], np.unique(branch[sort], return_inverse=True)[1]
    return np.split(flags, first[1:])


def intervals(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """(anchor, text_key, place) of every run of strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            values, keys = byte_texts(batch.column("text")), batch.column("text_key")
            for low, high in groups(values):
                owner, _, _, place, hashes = anchors.runs(values[low:high])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes), keys.take(pa.array(owner + low)), pa.array(place, pa.int32())],
                    names=["anchor", "text_key", "place"],
                )

    return texts.mapInArrow(run, "anchor long, text_key binary, place int")


def _stretches(shared: DataFrame) -> DataFrame:
    """The stretches of text around repeated anchors."""
    schema = "bucket long, stretch_key binary, text_key binary, start int, anchor int, n_texts long, stretch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors()
        for batch in batches:
            values, keys = byte_texts(batch.column("text")), batch.column("text_key")
            counts = np.asarray(batch.column("n_texts"))
            places = batch.column("places")
            for low, high in groups(values, 1 << 18):
                owner, first, strings, place, hashes = anchors.runs(values[low:high])
                known = places.slice(low, high - low)
                lengths = np.asarray(known.value_lengths())
                marks = np.repeat(np.arange(high - low), lengths) << 40 | np.asarray(known.flatten())
                chosen = np.isin(owner << 40 | place, marks)
                owner, first, strings, place, hashes = (x[chosen] for x in (owner, first, strings, place, hashes))
                cut = [
                    values[low + o][s : s + n + LENGTH - 1]
                    for o, s, n in zip(owner.tolist(), first.tolist(), strings.tolist())
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(hashes),
                        pa.array([hashlib.blake2b(c, digest_size=16).digest() for c in cut], pa.binary()),
                        keys.take(pa.array(owner + low)),
                        pa.array(first, pa.int32()),
                        pa.array(place - first, pa.int32()),
                        pa.array(counts[owner + low], pa.int64()),
                        pa.array(cut, pa.binary()),
                    ],
                    names=["bucket", "stretch_key", "text_key", "start", "anchor", "n_texts", "stretch"],
                )

    return shared.select("text_key", "n_texts", "text", "places").mapInArrow(run, schema)


def _repeats(stretches: DataFrame) -> DataFrame:
    """(stretch_key, low, high): the strings of distinct stretches that stand in two places at least."""
    distinct = stretches.groupBy("stretch_key").agg(
        F.first("bucket").alias("bucket"),
        F.first("anchor").alias("anchor"),
        F.first("stretch").alias("stretch"),
        F.sum("n_texts").alias("n"),
    )
    distinct = written(distinct, "stretches")
    hot = distinct.groupBy("bucket").agg(F.count("*").alias("rows")).filter(F.col("rows") > HOT_ROWS)
    dealt = distinct.join(hot, "bucket", "left")
    # the strings of a hot bucket are dealt one by one: equal ones meet all the same
    strings = F.octet_length("stretch") - LENGTH + 1

    def one(at):
        string = F.substring(F.col("stretch"), at + 1, F.lit(LENGTH))
        return F.struct(
            F.xxhash64("bucket", F.col("anchor") - at, string).alias("unit"),
            at.alias("shift"),
            (F.col("anchor") - at).alias("anchor"),
            string.alias("stretch"),
        )

    whole = F.struct(F.col("bucket").alias("unit"), F.lit(0).alias("shift"), F.col("anchor"), F.col("stretch"))
    parts = F.when(F.col("rows").isNull(), F.array(whole)).otherwise(
        F.transform(F.sequence(F.lit(0), strings - 1), one)
    )
    rows = dealt.select("stretch_key", "n", F.inline(parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done(rows: list) -> pa.RecordBatch:
            units = np.array([r[0] for r in rows])
            flags = [np.zeros(len(r[4]) - LENGTH + 1, bool) for r in rows]
            # a stretch alone in its bucket has nothing to meet
            _, number, members = np.unique(units, return_inverse=True, return_counts=True)
            met = np.flatnonzero(members[number] > 1).tolist()
            if met:
                found = repeated_strings([rows[at][4] for at in met], np.array([rows[at][3] for at in met]), units[met])
                for at, flag in zip(met, found):
                    flags[at] = flag
            keys, lows, highs = [], [], []
            for row, flag in zip(rows, flags):
                low, high = intervals(flag | (row[2] > 1))
                keys += [row[1]] * len(low)
                lows += (low + row[5]).tolist()
                highs += (high + row[5]).tolist()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(lows, pa.int32()), pa.array(highs, pa.int32())],
                names=["stretch_key", "low", "high"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("unit", "stretch_key", "n", "anchor", "stretch", "shift")]
            for row in zip(*columns):
                if size >= BLOCK_BYTES and row[0] != held[-1][0]:
                    yield done(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield done(held)

    dealt = rows.repartition("unit").sortWithinPartitions("unit")
    return dealt.mapInArrow(run, "stretch_key binary, low int, high int")


def _cut(texts: DataFrame) -> DataFrame:
    """Per text: n_removed, n_spans and the bytes that stay, from its list of repeated strings."""
    schema = "text_key binary, n_removed long, n_spans long, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, spans in zip(*(batch.column(c).to_pylist() for c in ("text_key", "text", "spans"))):
                parts, at, removed, count, reach = [], 0, 0, 0, -1
                for low, high in sorted((s["low"], s["high"] - 1 + LENGTH) for s in spans):
                    if low > reach:
                        count += 1
                        parts.append(text[at:low])
                        reach, at = high, high
                        removed += high - low
                    elif high > reach:
                        removed += high - reach
                        reach = at = high
                out.append((key, removed, count, b"".join(parts) + text[at:]))
            columns = list(zip(*out)) or [[]] * 4
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["text_key", "n_removed", "n_spans", "kept"]
            )

    return texts.select("text_key", "text", "spans").mapInArrow(run, schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Which bytes of each row's text repeat, and what stays.

    A byte goes if a string of 200 bytes that covers it also starts at any other
    place of any row, the same row included; overlaps count. Strings do not cross
    rows. Returns two frames. Rows: one per row of ``docs``, with the id, text_key,
    n_bytes and ``same_sha256`` (of the whole text). Texts: one per distinct text
    that loses bytes, with text_key, n_removed, n_spans (runs removed) and
    ``kept`` (bytes). Null reads as empty; texts under 200 bytes keep all; a row
    whose text another row repeats loses all if it has 200 bytes. Other columns
    are ignored.
    """
    value = F.coalesce(F.col(text), F.lit("")).cast("binary")
    keyed = docs.select(F.col(id_col), value.alias("text")).withColumn("text_key", F.unhex(F.md5("text")))
    long = keyed.filter(F.octet_length("text") >= LENGTH)
    anchored = _anchor_rows(long.select("text_key", "text"))
    # rows of equal texts count as well: what they hold stands in several places
    twice = anchored.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    # written, so that the join shuffles both sides itself and can split a hot anchor
    twice = written(twice, "anchors")
    marked = (
        anchored.join(twice, "anchor", "left_semi")
        .groupBy("text_key")
        .agg(F.collect_set("place").alias("places"))
    )
    distinct = long.groupBy("text_key").agg(F.first("text").alias("text"), F.count("*").alias("n_texts"))
    shared = written(distinct.join(marked, "text_key"), "shared_texts")
    stretches = written(_stretches(shared), "stretch_rows")
    found = (
        stretches.select("stretch_key", "text_key", "start")
        .join(_repeats(stretches), "stretch_key")
        .groupBy("text_key")
        .agg(F.collect_list(F.struct((F.col("start") + F.col("low")).alias("low"), (F.col("start") + F.col("high")).alias("high"))).alias("spans"))
    )
    texts = _cut(shared.join(found, "text_key"))
    rows = keyed.select(
        id_col, "text_key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("same_sha256")
    )
    return rows, texts
