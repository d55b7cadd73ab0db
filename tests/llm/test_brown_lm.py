import math
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tripwright.llm import brown_lm as lm

LANGS = (("ka", "ko", "ki", "ku"), ("zza", "zzo", "zzi", "zzu"))


def _texts(n, seed):
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        parts = draw.choice(LANGS)
        out.append(" ".join("".join(draw.choice(parts) for _ in range(draw.randint(1, 3))) for _ in range(draw.randint(0, 40))))
    return out


def _plain_base(train, text):
    counts = Counter(w for t in train for w in t.encode().lower().split() + [b""])
    total, distinct = sum(counts.values()), len(counts)
    tokens = text.encode().lower().split() + [b""]
    base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens)
    return len(tokens), sum(counts[w] > 0 for w in tokens), base


@pytest.mark.parametrize("broadcast", [100_000, 20])
def test_base_and_counts_match_a_plain_version(documents, monkeypatch, broadcast):
    monkeypatch.setattr(lm, "BROADCAST_WORDS", broadcast)
    train = _texts(200, 1)
    model, counts = lm.train(documents(*enumerate(train)).select("text"))
    test = _texts(50, 2) + ["", "never seen, words!", "KA ka\tKo\u2003ko\x0bki", "w" * 50_000, "ka " * 20_000]
    rows = list(enumerate(test)) + [(None, "ka"), (7, test[7])]
    docs = documents(*rows, (900, None)).withColumnRenamed("lang", "word").withColumnRenamed("source", "score")
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in lm.score(docs, model, counts).collect()), key=repr)
    want = sorted(((i, *_plain_base(train, t)) for i, t in [*rows, (900, "")]), key=repr)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    assert model.tokens == sum(len(t.split()) + 1 for t in train)


def test_probabilities_sum_to_one(documents):
    train = _texts(100, 3)
    model, counts = lm.train(documents(*enumerate(train)).select("text"))
    assert np.allclose((10.0**model.steps).sum(axis=1), 1)
    words = {bytes(r["word"]): r["n"] for r in counts.collect()}
    tails = lm.Tails()
    mass = np.zeros(lm.CLASSES)
    for word, n in words.items():
        item = 0 if word == lm.END else model.items.get(word) or tails[word[-2:]] + 1
        mass[model.classes[item]] += n + 0.5
    # one more share for what training lacks
    mass = (mass + 0.5) / 10.0**model.spread
    assert np.allclose(mass, 1)


def test_classes_beat_word_counts_on_held_out_text(documents):
    model, counts = lm.train(documents(*enumerate(_texts(400, 4))).select("text"))
    rows = lm.score(documents(*enumerate(_texts(100, 5))), model, counts).collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows) * 0.97


def test_broadcast_bound_does_not_change_scores(documents, monkeypatch):
    train, test = documents(*enumerate(_texts(150, 6))).select("text"), documents(*enumerate(_texts(40, 7)))
    found = []
    for size in (100_000, 10):
        monkeypatch.setattr(lm, "BROADCAST_WORDS", size)
        model, counts = lm.train(train)
        found.append(sorted((r["doc_id"], round(r["score"], 8)) for r in lm.score(test, model, counts).collect()))
    assert found[0] == found[1]


def test_exchange_raises_the_likelihood():
    draw = np.random.default_rng(1)
    pairs = draw.integers(0, 3, (60, 60)).astype(float)
    pairs[1:30, 1:30] += 20
    pairs[30:, 30:] += 20
    of = lm.exchange(pairs, classes=3)
    assert of[0] == 0 and len(set(of[1:30])) == 1 and len(set(of[30:])) == 1 and of[1] != of[30]


def test_empty_tables(documents):
    model, counts = lm.train(documents().select("text"))
    rows = lm.score(documents((1, "a b"), (2, None)), model, counts).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"]) for r in rows) == [(1, 3, 0), (2, 1, 0)]
    assert all(math.isfinite(r["score"]) for r in rows)
    assert lm.score(documents(), model, counts).count() == 0


def test_words_of_equal_count_are_clustered_up_to_the_limit(documents, monkeypatch):
    monkeypatch.setattr(lm, "CLUSTERED_WORDS", 20)
    words = [f"w{at:02d}" for at in range(30)]
    model, _ = lm.train(documents((1, " ".join(words)), (2, " ".join(words[::-1])), (3, "top top top")).select("text"))
    assert list(model.items) == [b"top", *(w.encode() for w in words[:19])]


def _likelihood(table):
    return sum(x * math.log(x) for x in table.ravel() if x) - sum(
        x * math.log(x) for sums in (table.sum(axis=0), table.sum(axis=1)) for x in sums if x
    )


def _recount(of, text, classes):
    table = np.zeros((classes, classes))
    np.add.at(table, ([of[w] for w in [0, *text[:-1]]], [of[w] for w in text]), 1)
    return table


def test_each_word_goes_to_the_class_of_the_best_likelihood():
    draw = np.random.default_rng(2)
    # word 0 is the end and closes the text
    text = [*draw.choice(25, 600, p=draw.dirichlet(np.ones(25))).tolist(), *range(24, 0, -1), 5, 5, 0]
    of = np.append(0, draw.integers(1, 6, 24))
    table = _recount(of, text, 6)
    pairs = _recount(np.arange(25), text, 25)
    words = np.arange(1, 25)
    before, after = np.zeros((24, 6)), np.zeros((24, 6))
    for word in words:
        for other in range(25):
            if other != word:
                before[word - 1, of[other]] += pairs[other, word]
                after[word - 1, of[other]] += pairs[word, other]
    got = lm.best_classes(table, before, after, pairs[words, words], of[1:])
    assert (got != of[1:]).any()
    for word in words:
        found = []
        for cls in range(1, 6):
            moved = of.copy()
            moved[word] = cls
            found.append(_likelihood(_recount(moved, text, 6)))
        assert math.isclose(found[got[word - 1] - 1], max(found), abs_tol=1e-6)


@pytest.mark.parametrize("broadcast", [100_000, 10])
def test_scores_match_a_plain_version(documents, monkeypatch, broadcast):
    monkeypatch.setattr(lm, "BROADCAST_WORDS", broadcast)
    monkeypatch.setattr(lm, "CLUSTERED_WORDS", 8)
    train = [*_texts(150, 8), "", None, "ka once", "ka once"]
    model, counts = lm.train(documents(*enumerate(train)).select("text").repartition(3))
    known = {bytes(r["word"]): (r["n"], r["class"]) for r in counts.collect()}
    plain = Counter(w for t in train for w in (t or "").encode().lower().split() + [b""])
    assert {word: n for word, (n, _) in known.items()} == plain and len(plain) > 2 * len(model.items)
    assert known[b""][1] == 0 and all(known[w][1] == model.classes[item] for w, item in model.items.items())
    tails = lm.Tails()

    def sequence(text):
        words = (text or "").encode().lower().split() + [b""]
        return words, [known[w][1] if w in known else model.classes[1 + tails[w[-2:]]] for w in words]

    table, mass = np.zeros((lm.CLASSES, lm.CLASSES)), np.zeros(lm.CLASSES)
    for text in train:
        _, classes = sequence(text)
        np.add.at(table, ([0, *classes[:-1]], classes), 1)
    for n, cls in known.values():
        mass[cls] += n + 0.5
    steps = (table + 0.5) / (table.sum(axis=1, keepdims=True) + 0.5 * lm.CLASSES)
    test = [*_texts(40, 9), "", None, "once once KA none nones ka", "ka\nnone none once", "ka " * 3_000 + "once " * 3_000]
    got = {r["doc_id"]: r["score"] for r in lm.score(documents(*enumerate(test)), model, counts).collect()}
    for at, text in enumerate(test):
        words, classes = sequence(text)
        want = sum(
            math.log10(steps[was, cls] * (known.get(w, (0,))[0] + 0.5) / (mass[cls] + 0.5))
            for was, cls, w in zip([0, *classes], classes, words)
        )
        assert math.isclose(got[at], want, rel_tol=1e-9), text


def test_words_beyond_the_limit_are_placed_by_their_neighbours(documents, monkeypatch):
    monkeypatch.setattr(lm, "CLUSTERED_WORDS", 120)
    draw, texts = random.Random(3), []
    for lang in "ab":
        # all end alike, and the rare ones are equally frequent
        rare = [f"{lang}r{at}zz" for at in range(100)] * 4
        draw.shuffle(rare)
        for word in rare:
            around = [f"{lang}{draw.randrange(60)}zz" for _ in range(12)]
            texts.append(" ".join([*around[:6], word, *around[6:]]))
    model, counts = lm.train(documents(*enumerate(texts)).select("text"))
    assert len(model.items) == 120 and not any(b"r" in word for word in model.items)
    pure = " ".join(f"a{at}zz ar{at}zz" for at in range(60))
    mixed = " ".join(f"a{at}zz br{at}zz" for at in range(60))
    got = {r["doc_id"]: r["score"] for r in lm.score(documents((1, pure), (2, mixed)), model, counts).collect()}
    assert got[1] > got[2] + 30


def test_a_word_is_placed_once_however_its_counts_are_cut(spark, documents):
    texts = documents(*enumerate([*_texts(120, 10), *("same " * 50, "other same") * 20])).select("text")
    items, size = {b"ka": 1 + lm.TAILS}, 1 + lm.TAILS + lm.CLUSTERED_WORDS
    classes = np.append(0, np.arange(size - 1) % (lm.CLASSES - 1) + 1)
    table = lm.count_pairs(texts, items)
    table = np.array([[table[np.ix_(classes == a, classes == b)].sum() for b in range(lm.CLASSES)] for a in range(lm.CLASSES)])
    found = []
    for parts, rows in ((1, 10_000), (40, 3)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
        contexts = lm.count_contexts(texts.repartition(parts), items, classes)
        found.append(sorted(tuple(r) for r in lm.place_words(contexts, items, classes, table).collect()))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found[0] == found[1]
    assert len({word for word, _, _ in found[0]}) == len(found[0])


def _odd_texts(seed):
    draw = random.Random(seed)
    parts = ["A", "b", "Zz", "\u00c9", "\u2003", "\x00", "\x1c", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "w" * 300]
    return [draw.choice([None, "", "".join(draw.choice(parts) for _ in range(draw.randrange(30)))]) for _ in range(200)]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_tokens_of_whole_columns_are_those_of_each_text(kind):
    for texts in ([], [None], ["", None], ["ab", "cd", " e", "f "], _odd_texts(21)):
        # also within a longer column
        column = pa.array(["before", *texts, "after"], kind).slice(1, len(texts))
        words, n = lm.tokens_of(column)
        want = [(t or "").encode().lower().split() + [lm.END] for t in texts]
        assert words.to_pylist() == [w for text in want for w in text] and n.tolist() == [len(text) for text in want]


def test_tokens_are_numbered_alike_however_they_are_held(monkeypatch):
    texts = [*_odd_texts(22), *_odd_texts(23)]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at : at + 50], pa.string())], names=["text"]) for at in range(0, len(texts), 50)]
    want = [w for t in texts for w in (t or "").encode().lower().split() + [lm.END]]
    for tokens, size, group in ((4_000_000, 1 << 26, 1 << 22), (100, 1 << 26, 64), (4_000_000, 1_000, 64)):
        monkeypatch.setattr(lm, "HELD_TOKENS", tokens)
        monkeypatch.setattr(lm, "HELD_BYTES", size)
        monkeypatch.setattr(lm, "GROUP_BYTES", group)
        got = []
        for places, words in lm.numbered(iter(batches)):
            distinct = words.to_pylist()
            assert len(set(distinct)) == len(distinct)
            got += [distinct[at] for at in places.tolist()]
        assert got == want


def test_items_of_words():
    tails = lm.Tails()
    items = {b"ka": 1 + lm.TAILS, b"\xc3\xa9": 2 + lm.TAILS}
    words = [b"", b"ka", b"x", b"xy", b"wxy", b"\xc3\xa9", b"\xff", b"", b"kaka"]
    want = [0 if w == lm.END else items.get(w) or tails[w[-2:]] + 1 for w in words]
    assert lm.items_of(pa.array([b"q", *words], pa.binary()).slice(1), items).tolist() == want
    assert lm.items_of(pa.array(words, pa.binary()), {}).tolist() == [0 if w == lm.END else tails[w[-2:]] + 1 for w in words]


def test_texts_are_cut_into_tokens_in_little_time():
    draw = random.Random(24)
    texts = pa.array([" ".join(f"w{draw.randrange(10**5)}" for _ in range(500)) for _ in range(2_000)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    took = []
    for _ in range(3):
        began = time.process_time()
        words = [w for text in texts.to_pylist() for w in text.encode().lower().split()]
        plain = Counter(words)
        middle = time.process_time()
        counts = [np.bincount(places) for places, _ in lm.numbered(iter([batch]))]
        took.append((time.process_time() - middle) / (middle - began))
        assert sum(c.sum() for c in counts) == plain.total() + len(texts)
    assert min(took) < 0.8
