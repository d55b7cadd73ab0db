"""Scores by a class-based n-gram model (Brown).

Exchange clustering assigns words to classes so that class bigrams predict well.
The probability of a token is that of its class after the class before, times
that of the word in its class, both smoothed. It starts on the driver, on a
matrix of fixed size: frequent words each by itself, all others in groups by
their last two bytes, which gives every word a class without a lookup. Then a
distributed sweep takes every other training word out of its group and puts it
in the class that its own neighbours in the whole corpus make likeliest, and
class bigrams are counted anew. Only words that training lacks keep the class of
their group. Counts and classes of words stay a distributed table; only those of
the most frequent words are broadcast.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import slices, written

# Words clustered on the driver, groups the rest starts in, classes, and sweeps of exchange there.
CLUSTERED_WORDS = 1_000
TAILS = 64
CLASSES = 48
SWEEPS = 8
# Words whose counts and classes are broadcast; those of all others are joined.
BROADCAST_WORDS = 100_000
SMOOTHING = 0.5
# Tokens that a task numbers together, and bytes of texts (or one longer text); it cuts texts into tokens by fewer.
HELD_TOKENS = 4_000_000
HELD_BYTES = 1 << 26
GROUP_BYTES = 1 << 22
# Counts of a word's neighbours: by the class before, by the class after, and of itself before itself.
WIDTH = 2 * CLASSES + 1
CELL = np.dtype([("slot", "u1"), ("n", "<u4")])
# The token that ends a text. No word is empty.
END = b""


BLANKS = b"\t\n\x0b\x0c\r "
LOWER = bytes(range(256)).lower()
IS_WORD = bytes(b not in BLANKS for b in range(256))


def tokens_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of texts (runs of bytes other than ASCII blanks, A-Z lowered), each text closed by an end, and their number by text."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = pc.fill_null(texts, b"")
    cuts = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if cuts[0] < cuts[-1]:
        raw = texts.buffers()[2][cuts[0] : cuts[-1]].to_pybytes()
    else:
        raw = b""
    cuts = cuts - cuts[0]
    # words begin and end at blanks, and with their text
    inside = np.frombuffer(raw.translate(IS_WORD), bool)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = cuts[:-1][np.diff(cuts) > 0]
    first[edges] = inside[edges]
    last[edges[1:] - 1] = inside[edges[1:] - 1]
    starts = np.flatnonzero(first)
    n = np.diff(np.searchsorted(starts, cuts)) + 1
    is_word = np.ones(len(starts) + len(n), bool)
    is_word[np.cumsum(n) - 1] = False
    ends = np.zeros(len(is_word) + 1, np.int32)
    ends[1:][is_word] = np.flatnonzero(last) - starts + 1
    np.cumsum(ends, out=ends)
    data = raw.translate(LOWER, BLANKS)
    return pa.Array.from_buffers(pa.binary(), len(is_word), [None, pa.py_buffer(ends), pa.py_buffer(data)]), n


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Of some texts at a time the tokens as numbers, and the words that these stand for."""
    held, tokens, size = [], 0, 0

    def flush() -> tuple[np.ndarray, pa.Array]:
        coded = pa.concat_arrays(held).dictionary_encode()
        return coded.indices.to_numpy(), coded.dictionary

    for batch in batches:
        column = batch.column(0)
        for low, high in slices(column, GROUP_BYTES):
            words, _ = tokens_of(column.slice(low, high - low))
            if held and (tokens + len(words) > HELD_TOKENS or size + words.nbytes > HELD_BYTES):
                yield flush()
                held, tokens, size = [], 0, 0
            held.append(words)
            tokens += len(words)
            size += words.nbytes
    if held:
        yield flush()


class Tails(dict):
    """Group of a word by its last two bytes; fills itself, with 65,792 keys at most."""

    def __missing__(self, tail: bytes) -> int:
        self[tail] = zlib.crc32(tail) % TAILS
        return self[tail]


@cache
def _tail_table() -> np.ndarray:
    """``Tails`` of two bytes (as a big-endian number), then of one byte, then of none."""
    tails = [bytes(divmod(at, 256)) for at in range(1 << 16)] + [bytes([at]) for at in range(256)] + [b""]
    return np.array([zlib.crc32(tail) % TAILS for tail in tails], np.int32)


def tail_groups(words: pa.Array) -> np.ndarray:
    """``Tails`` of each word."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    length = np.diff(ends)
    tail = np.full(len(words), (1 << 16) + 256)
    if ends[0] < ends[-1]:
        data = np.frombuffer(words.buffers()[2], np.uint8)
        one, two = ends[1:][length == 1], ends[1:][length > 1]
        tail[length == 1] = data[one - 1].astype(np.int64) + (1 << 16)
        tail[length > 1] = data[two - 2].astype(np.int64) * 256 + data[two - 1]
    return _tail_table()[tail]


def places_in(words: pa.Array, known: pa.Array) -> np.ndarray:
    """The place of each word in ``known``, from 1; 0 for others."""
    found = pc.index_in(words, known)
    return pc.fill_null(found, -1).to_numpy() + 1


def items_of(words: pa.Array, items: dict[bytes, int]) -> np.ndarray:
    """The item of each word: its own, that of its group, or 0 for an end."""
    numbers = np.append(0, np.fromiter(items.values(), np.int64, len(items)))
    out = numbers[places_in(words, pa.array(list(items), pa.binary()))]
    other = np.flatnonzero(out == 0)
    rest = words.take(pa.array(other))
    out[other] = np.where(pc.binary_length(rest).to_numpy() > 0, tail_groups(rest) + 1, 0)
    return out


def tail_group(word: Column) -> Column:
    """``Tails`` as a column of a binary word."""
    cut = F.when(F.octet_length(word) > 2, F.substring(word, -2, 2)).otherwise(word)
    return F.crc32(cut) % TAILS


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all texts, one end per text, summed up in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for places, words in numbered(batches):
            n = np.bincount(places, minlength=len(words))
            yield pa.RecordBatch.from_arrays([words, pa.array(n)], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The words with at least the count that no more than ``limit`` words reach (in eighths of a power of two)."""
    step = F.floor(F.log2("n") * 8).cast("int")
    steps = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    total, least = 0, None
    for row in steps:
        total += row["count"]
        if total > limit:
            break
        least = row["step"]
    return counts.filter(step >= least if least is not None else F.lit(False))


@dataclass
class Model:
    items: dict[bytes, int]  # words clustered on the driver, numbered from TAILS + 1; END is item 0
    classes: np.ndarray  # of each item; item 1 + g is the group g of other words, where those training lacks stay
    steps: np.ndarray  # log10 P(class | class before)
    spread: np.ndarray  # log10 of what a class's smoothed counts sum to
    known: dict[bytes, int]  # place of a broadcast word in the next two, from 1
    counts: np.ndarray
    words_class: np.ndarray  # -1 at place 0
    tokens: int
    base_spread: float


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of items from their bigram counts. Item 0 keeps class 0 to itself.

    Each item in turn goes to the class that raises the likelihood of the class
    bigrams most, until a sweep moves none.
    """
    n = len(pairs)
    order = np.argsort(-(pairs.sum(axis=0) + pairs.sum(axis=1)), kind="stable")
    of = np.zeros(n, np.int64)
    others = order[order != 0]
    of[others] = np.arange(len(others)) % (classes - 1) + 1
    table = np.zeros((classes, classes))
    np.add.at(table, (of[:, None].repeat(n, 1), of[None, :].repeat(n, 0)), pairs)

    f = _f
    for _ in range(sweeps):
        moved = 0
        for item in others.tolist():
            was = of[item]
            after = np.bincount(of, weights=pairs[item], minlength=classes)
            before = np.bincount(of, weights=pairs[:, item], minlength=classes)
            self_ = pairs[item, item]
            table[was] -= after
            table[:, was] -= before
            table[was, was] += self_
            after[was] -= self_
            before[was] -= self_
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            gain = (f(table + after[None, :]) - f(table)).sum(axis=1)
            gain += (f(table + before[:, None]) - f(table)).sum(axis=0)
            at = np.arange(classes)
            own = table[at, at]
            gain += f(own + after + before + self_) + f(own) - f(own + after) - f(own + before)
            gain -= f(rows + after.sum() + self_) - f(rows) + f(columns + before.sum() + self_) - f(columns)
            gain[0] = -np.inf
            best = int(np.argmax(gain))
            if gain[best] <= gain[was] + 1e-9:
                best = was
            moved += best != was
            of[item] = best
            table[best] += after
            table[:, best] += before
            table[best, best] += self_
        if not moved:
            break
    return of


def count_pairs(texts: DataFrame, items: dict[bytes, int]) -> np.ndarray:
    """How often each item follows each; a text starts after an end. Fixed size."""
    size = 1 + TAILS + CLUSTERED_WORDS
    shared = texts.sparkSession.sparkContext.broadcast(items)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(size * size, np.int64)
        for batch in batches:
            column = batch.column(0)
            for low, high in slices(column, GROUP_BYTES):
                words, _ = tokens_of(column.slice(low, high - low))
                places = items_of(words, shared.value)
                pairs += np.bincount(np.append(0, places[:-1]) * size + places, minlength=size * size)
        seen = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(pairs[seen])], names=["pair", "n"])

    summed = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size)
    out[np.asarray(summed.column("pair"))] = np.asarray(summed.column("n"))
    return out.reshape(size, size)


def best_classes(table: np.ndarray, before: np.ndarray, after: np.ndarray, own: np.ndarray, was: np.ndarray) -> np.ndarray:
    """For each word the class that raises the likelihood of the class bigrams ``table`` most if it alone moves.

    ``before`` and ``after`` count a word's neighbours by class, without itself;
    ``own`` counts the word before itself. Each word has a neighbour on both sides.
    Only cells that the word touches differ between classes; ``was`` is kept unless
    another class is better. No word moves to class 0.
    """
    at, word = np.arange(len(table)), np.arange(len(was))
    gain = np.zeros((len(was), len(table)))
    for counts, cells in ((after, table.T), (before, table)):
        owner, cls = np.nonzero(counts)
        cells = cells[cls]
        gain += np.add.reduceat(_f(cells + counts[owner, cls][:, None]) - _f(cells), np.searchsorted(owner, word))
    # the cells shared with the class that the word leaves, and of the class before itself
    into, out, self_ = table[:, was].T, table[was], table[at, at]
    left, right, own = before[word, was][:, None], after[word, was][:, None], own[:, None]
    gain += _f(into - before + right) - _f(into - before) - _f(into + right) + _f(into)
    gain += _f(out - after + left) - _f(out - after) - _f(out + left) + _f(out)
    gain += _f(self_ + after + before + own) + _f(self_) - _f(self_ + after) - _f(self_ + before)
    n = after.sum(axis=1, keepdims=True) + own
    stay = _f(out) - _f(out - after) + _f(into) - _f(into - before)
    stay[word, was] = _f(self_[was]) - _f(self_[was] - (left + right + own)[:, 0])
    gain[word, was] = stay.sum(axis=1)
    for sums in (table.sum(axis=1), table.sum(axis=0)):
        sums = np.broadcast_to(sums, gain.shape).copy()
        sums[word, was] -= n[:, 0]
        gain -= _f(sums + n) - _f(sums)
    gain[:, 0] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[word, best] > gain[word, was] + 1e-9, best, was)


def count_contexts(texts: DataFrame, items: dict[bytes, int], classes: np.ndarray) -> DataFrame:
    """(word, cells): how often each word stands by words that start in each class, as packed ``CELL``; may repeat words."""
    shared = texts.sparkSession.sparkContext.broadcast((items, classes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, classes = shared.value
        for place, words in numbered(batches):
            # the texts before end with an end, whose class is 0
            cls = classes[items_of(words, items)].astype(np.int32)[place]
            same = place[1:] == place[:-1]
            # narrow keys are sorted faster, wide ones are for very many words
            key = place * np.array(WIDTH, np.int32 if len(words) * WIDTH < 1 << 31 else np.int64)
            before = np.append(np.int32(0), cls[:-1])
            before[1:][same] = WIDTH - 1
            keys, n = np.unique(np.concatenate([key + before, (key[:-1] + CLASSES + cls[1:])[~same]]), return_counts=True)
            cells = np.empty(len(keys), CELL)
            cells["slot"], cells["n"] = keys % WIDTH, n
            # every word has a cell
            ends = np.searchsorted(keys // WIDTH, np.arange(len(words) + 1)) * CELL.itemsize
            packed = pa.Array.from_buffers(
                pa.binary(), len(words), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(cells.tobytes())]
            )
            yield pa.RecordBatch.from_arrays([words, packed], names=["word", "cells"])

    return texts.mapInArrow(run, "word binary, cells binary")


def place_words(contexts: DataFrame, items: dict[bytes, int], classes: np.ndarray, table: np.ndarray) -> DataFrame:
    """(word, n, class) of each training word; words of ``items`` and ends keep the class they have.

    A task gets the rows of a word together and works through them batch by batch.
    """
    shared = contexts.sparkSession.sparkContext.broadcast((items, classes, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, classes, table = shared.value
        rest = None

        def place(rows: pa.Table) -> pa.RecordBatch:
            coded = rows.column("word").combine_chunks().dictionary_encode()
            words, cells = coded.dictionary, rows.column("cells").combine_chunks()
            low = pc.binary_length(cells).to_numpy() // CELL.itemsize
            packed = np.frombuffer(pc.binary_join(pa.LargeListArray.from_arrays([0, len(cells)], cells), b"")[0].as_buffer(), CELL)
            owner = np.repeat(coded.indices.to_numpy().astype(np.int64), low)
            sums = np.bincount(owner * WIDTH + packed["slot"], packed["n"], len(words) * WIDTH).reshape(-1, WIDTH)
            before, after, own = sums[:, :CLASSES], sums[:, CLASSES:-1], sums[:, -1]
            item = items_of(words, items)
            cls, free = classes[item], np.flatnonzero((item > 0) & (item <= TAILS))
            if len(free):
                cls[free] = best_classes(table, before[free], after[free], own[free], cls[free])
            n = (before.sum(axis=1) + own).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [words, pa.array(n), pa.array(cls.astype(np.int32))], names=["word", "n", "class"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            # the last word may go on in the next batch
            words = batch.column("word")
            last, cut = words[-1], rows.num_rows - batch.num_rows
            other = np.flatnonzero(~np.asarray(pc.equal(words, last)))
            if len(other):
                cut += int(other[-1]) + 1
            elif rest is not None and rest.column("word")[-1] == last:
                cut = 0
            if cut:
                yield place(rows.slice(0, cut))
            rest = rows.slice(cut)
        if rest is not None:
            yield place(rest)

    return contexts.repartition("word").sortWithinPartitions("word").mapInArrow(run, "word binary, n long, class int")


def count_classes(texts: DataFrame, placed: DataFrame, known: dict[bytes, int], words_class: np.ndarray) -> np.ndarray:
    """How often each class follows each.

    A task sums up what is broadcast. The classes of other words are joined, and
    once more where such a word follows such a word.
    """
    shared = texts.sparkSession.sparkContext.broadcast((known, words_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, words_class = shared.value
        known, pairs = pa.array(list(known), pa.binary()), np.zeros(CLASSES * CLASSES, np.int64)

        def rows(words, before, after, follower, times) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [words, pa.array(before.astype(np.int32)), pa.array(after.astype(np.int32)), follower, pa.array(times)],
                names=["word", "before", "after", "follower", "times"],
            )

        for batch in batches:
            column = batch.column(0)
            for low, high in slices(column, GROUP_BYTES):
                words, _ = tokens_of(column.slice(low, high - low))
                cls = words_class[places_in(words, known)]
                before, rare = np.append(0, cls[:-1]), np.flatnonzero(cls < 0)
                both = (before >= 0) & (cls >= 0)
                pairs += np.bincount(before[both] * CLASSES + cls[both], minlength=len(pairs))
                # an end follows the last word of a text
                after = cls[rare + 1]
                follower = words.take(pa.array(rare + 1, mask=after >= 0))
                yield rows(words.take(pa.array(rare)), before[rare], after, follower, np.ones(len(rare), np.int64))
        seen = np.flatnonzero(pairs)
        # their keys have a blank, as no word has, and are many, unlike null
        keys = pa.array([b" %d" % at for at in seen.tolist()], pa.binary())
        yield rows(keys, seen // CLASSES, seen % CLASSES, pa.nulls(len(seen), pa.binary()), pairs[seen])

    tokens = texts.mapInArrow(run, "word binary, before int, after int, follower binary, times long")
    joined = tokens.join(placed.select("word", "class"), "word", "left")
    summed = joined.groupBy("follower", "before", "class", "after").agg(F.sum("times").alias("times"))
    of_follower = placed.select(F.col("word").alias("follower"), F.col("class").alias("next"))
    # of rows without a follower there is one at most for each three classes
    found = (
        summed.join(of_follower, "follower", "left")
        .groupBy("before", "class", F.coalesce("next", "after").alias("after"))
        .agg(F.sum("times").alias("times"))
        .collect()
    )
    table = np.zeros((CLASSES, CLASSES))
    for before, cls, after, times in found:
        if cls is None:
            table[before, after] += times
            continue
        table[cls, after] += times
        # after a rare word it is counted as that word's follower
        if before >= 0:
            table[before, cls] += times
    return table


def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the table of all words' counts and classes, from one column of texts.

    Null reads as the empty text, repeated rows count each; without rows all words are unknown.
    """
    counts = written(count_words(texts), "word_counts")
    tokens, distinct, ends = counts.agg(
        F.sum("n"), F.count("*"), F.sum(F.when(F.octet_length("word") == 0, F.col("n")))
    ).first()
    # collected, so that each task's first are merged here and not shuffled to one task
    top = counts.filter(F.octet_length("word") > 0).orderBy(F.desc("n"), "word").limit(CLUSTERED_WORDS).collect()
    ranked = [(row["n"], bytes(row["word"])) for row in top]
    items = {word: 1 + TAILS + at for at, (_, word) in enumerate(ranked)}
    pairs = count_pairs(texts, items)
    classes = exchange(pairs)
    table = np.zeros((CLASSES, CLASSES))
    np.add.at(table, (classes[:, None].repeat(len(classes), 1), classes[None, :].repeat(len(classes), 0)), pairs)
    placed = written(place_words(count_contexts(texts, items, classes), items, classes, table), "word_classes")
    shared = most_frequent(placed, BROADCAST_WORDS).toArrow()
    often = dict(zip(shared.column("word").to_pylist(), zip(shared.column("n").to_pylist(), shared.column("class").to_pylist())))
    often |= {word: (n, int(classes[items[word]])) for n, word in ranked} | {END: (ends or 0, 0)}
    known = {word: at + 1 for at, word in enumerate(often)}
    words_class = np.array([-1, *(cls for _, cls in often.values())])
    table = count_classes(texts, placed, known, words_class)
    steps = np.log10((table + SMOOTHING) / (table.sum(axis=1, keepdims=True) + SMOOTHING * CLASSES))
    distinct_classes = np.zeros(CLASSES)
    for cls, n in placed.groupBy("class").count().collect():
        distinct_classes[cls] = n
    distinct_classes[0] = 1
    spread = np.log10(table.sum(axis=0) + SMOOTHING * (distinct_classes + 1))
    model = Model(
        items, classes, steps, spread, known, np.array([0, *(n for n, _ in often.values())]), words_class, tokens or 0,
        float(np.log10((tokens or 0) + SMOOTHING * ((distinct or 0) + 1))),
    )
    return model, placed


def _partial_scores(docs: DataFrame, model: Model, id_col: str, text: str) -> DataFrame:
    """Per row its sums over broadcast words, and a row for each other token of it.

    Both carry ``row``, a number per row of ``docs``. Steps between two broadcast
    words are in a row's sums already; those to and from other words are missing.
    ``pos`` numbers a row's tokens, -1 marks its own sums; ``before`` and ``after``
    are the neighbours' classes, -1 for those that are not broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))
    rows = docs.select(id_col, text)
    id_type = rows.schema[0].dataType.simpleString()
    schema = (
        f"row long, doc_id {id_type}, word binary, pos int, before int, after int, "
        "n_tokens long, n_known long, base double, score double"
    )
    names = ["row", "doc_id", "word", "pos", "before", "after", "n_tokens", "n_known", "base", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, number = Model(*shared.value), TaskContext.get().partitionId() << 40
        known_words = pa.array(list(model.known), pa.binary())
        logs = np.log10(model.counts + SMOOTHING)
        for batch in batches:
            column = batch.column(1)
            for low, high in slices(column, GROUP_BYTES):
                words, n = tokens_of(column.slice(low, high - low))
                firsts = np.cumsum(n) - n
                place = places_in(words, known_words)
                cls = model.words_class[place]
                before = np.append(0, cls[:-1])
                log = logs[place]
                known = cls >= 0
                log[~known] = 0.0
                score = np.where(known, log - model.spread[cls], 0.0)
                score += np.where(known & (before >= 0), model.steps[before, cls], 0.0)
                base = np.add.reduceat(log, firsts) - n * model.base_spread
                rare = np.flatnonzero(~known)
                owner = np.searchsorted(firsts, rare, side="right") - 1
                seen = np.add.reduceat((model.counts[place] > 0).astype(np.int64), firsts)
                numbers = number + np.arange(high - low)
                number += high - low
                k = len(rare)
                # the key of a row's own sums has a blank, as no word has
                own, none = [b" %d" % at for at in numbers.tolist()], np.full(high - low, -1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate((numbers, numbers[owner]))),
                        pa.concat_arrays([batch.column(0).slice(low, high - low), pa.nulls(k, batch.column(0).type)]),
                        pa.concat_arrays([pa.array(own, pa.binary()), words.take(pa.array(rare))]),
                        pa.array(np.concatenate((none, rare)).astype(np.int32)),
                        pa.array(np.concatenate((none, before[rare])).astype(np.int32)),
                        pa.array(np.concatenate((none, cls[rare + 1])).astype(np.int32)),
                        pa.array(np.concatenate((n, np.zeros(k, np.int64)))),
                        pa.array(np.concatenate((seen, np.zeros(k, np.int64)))),
                        pa.array(np.concatenate((base, np.zeros(k)))),
                        pa.array(np.concatenate((np.add.reduceat(score, firsts), np.zeros(k)))),
                    ],
                    names=names,
                )

    return rows.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_known, base_score, score.

    Log10 probabilities of the whole text: ``base_score`` by smoothed word counts,
    ``score`` by the class model. Null reads as the empty text, which is one end.
    Words that training lacks share one smoothed count per class, that of their
    last two bytes. Other columns are ignored. Counts and classes of words that are
    not broadcast are joined; such words are rare in training, so few keys are hot.
    """
    steps, spread, groups = (F.lit(x.tolist()) for x in (model.steps.ravel(), model.spread, model.classes[1 : 1 + TAILS]))
    tokens = _partial_scores(docs, model, id_col, text).join(counts, "word", "left")
    cls = F.coalesce("class", F.get(groups, tail_group(F.col("word")).cast("int")))
    # such a word's steps to and from broadcast words; other steps are between words in a chain
    rare, before, after = F.col("pos") >= 0, F.col("before"), F.col("after")
    step = F.when(before >= 0, F.get(steps, before * CLASSES + F.col("cls"))).otherwise(0.0) - F.get(spread, F.col("cls"))
    step += F.when(after >= 0, F.get(steps, F.col("cls") * CLASSES + after)).otherwise(0.0)
    link = F.when(rare & ((before < 0) | (after < 0)), F.col("pos").cast("long") * CLASSES + F.col("cls"))
    log = F.when(rare, F.log10(F.coalesce("n", F.lit(0)) + SMOOTHING)).otherwise(0.0)
    summed = tokens.withColumn("cls", cls).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(F.col("n").isNotNull(), 1).otherwise(0)).alias("n_known"),
        F.sum(F.col("base") + log).alias("base_score"),
        F.sum(F.col("score") + log + F.when(rare, step).otherwise(0.0)).alias("score"),
        F.sort_array(F.collect_list(link)).alias("chain"),
    )

    def chained(one: Column, two: Column) -> Column:
        left, right = one % CLASSES, two % CLASSES
        return F.when(two - right == one - left + CLASSES, F.get(steps, (left * CLASSES + right).cast("int"))).otherwise(0.0)

    most = F.greatest(F.size("chain") - 1, F.lit(0))
    links = F.zip_with(F.slice("chain", 1, most), F.slice("chain", 2, most), chained)
    total = F.col("score") + F.aggregate(links, F.lit(0.0), lambda done, one: done + one)
    return summed.select("doc_id", "n_tokens", "n_known", "base_score", total.alias("score"))
