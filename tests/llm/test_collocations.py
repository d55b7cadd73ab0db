import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwright.llm import collocations as col

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _plain(docs, top=col.TOP):
    counts = Counter()
    for text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOW)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                counts.update((lang or "und", tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    total = Counter()
    for (lang, phrase), n in counts.items():
        total[lang] += n * (len(phrase) == 1)
    chosen = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= 10}
    gone = {
        (lang, part)
        for (lang, phrase), longer in chosen.items()
        if len(phrase) == 3
        for part in (phrase[:2], phrase[1:])
        if 100 * longer >= 50 * chosen[lang, part]
    }
    rows = {}
    for (lang, phrase), a in chosen.items():
        if (lang, phrase) not in gone:
            cuts = [(counts[lang, phrase[:k]], counts[lang, phrase[k:]], k) for k in range(1, len(phrase))]
            score, _, left, right = min((1_000_000 * a * a // (x * y), k, x, y) for x, y, k in cuts)
            rows.setdefault(lang, []).append((-score, -a, " ".join(phrase).encode(), left, right))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, total[lang], -score)
        for lang, held in rows.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(held)[:top], 1)
    )


def _got(spark, docs, **more):
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("lang", T.StringType())])
    frame = spark.createDataFrame(docs, schema).withColumn("word", F.lit(1)).withColumn("shard", F.lit("x"))
    return sorted(tuple(r) for r in col.collocations(frame, **more).collect())


def _corpus(seed):
    draw = random.Random(seed)
    words = ["a", "b", "The", "THE", "é", "É", "c", "x\x0by", "d\te", "10", "ß#"]
    signs = [" ", " ", " ", "  ", ", ", ".", "\n", "\t", " ! "]
    docs = []
    for _ in range(150):
        text = "".join(draw.choice(words) + draw.choice(signs) for _ in range(draw.randint(0, 40)))
        docs.append((text, draw.choice(["en", "en", "fr", None, "und"])))
    return docs + [(None, "en"), ("", None), (" .,; ", "de"), ("w " * 9, "fr"), ("a b c " * 500, "en"), ("a b c", "en"), ("a b c", "en")]


@pytest.mark.parametrize("seed, shard, block", [(1, 1 << 20, 1 << 18), (2, 300, 64)])
def test_matches_a_plain_count(spark, monkeypatch, seed, shard, block):
    monkeypatch.setattr(col, "SHARD_WORDS", shard)
    monkeypatch.setattr(col, "BLOCK_PHRASES", block)
    monkeypatch.setattr(col, "SLICE", 64)
    docs = _corpus(seed)
    assert _got(spark, docs) == _plain(docs)
    assert _got(spark, docs, top=3) == _plain(docs, 3)


def test_long_text_without_signs_and_empty_tables(spark):
    docs = [("one two three four " * 100_000, "en"), ("x" * 3_000_000, None)]
    assert _got(spark, docs) == _plain(docs)
    assert _got(spark, []) == []
    assert _got(spark, [(None, None)]) == []


@pytest.mark.parametrize("bits", [1, 5, 10, 11, 12, 16, 17, 21, 22, 26, 27, 32])
def test_permutation_is_one_to_one(bits):
    draw = np.random.default_rng(bits)
    words = [np.append(draw.integers(0, 1 << bits, 999, np.uint64), np.uint64((1 << bits) - 1)) for _ in range(3)]
    left, right = col.permute(*words, bits)
    half = col.half_bits(bits)
    assert int(left.max()) >> half == int(right.max()) >> half == 0
    for word, back in zip(words, col.restore(left, right, bits)):
        assert (word == back).all()


@pytest.mark.parametrize("bits, taken", [(8, 0), (20, 0), (20, 9), (21, 30), (25, 7), (32, 12)])
def test_filters_lose_nothing(bits, taken):
    draw = np.random.default_rng(bits)
    half = col.half_bits(bits)
    for many in (1, 2, 1000):
        words = [draw.integers(0, 1 << bits, many, np.uint64) for _ in range(3)]
        left, right = col.permute(*words, bits)
        upper = np.uint64(5) & np.uint64((1 << taken) - 1)
        left = (left & np.uint64((1 << (half - taken)) - 1)) | (upper << np.uint64(half - taken))
        counts = draw.choice(np.array([1, 2, 254, 255, 256, 10**12]), many)
        left, right, counts = col.summed(left, right, counts, half)
        back = col.unpack(col.pack(left, right, counts, half, taken), half)
        assert (back[0] | (upper << np.uint64(half - taken)) == left).all()
        assert (back[1] == right).all() and (back[2] == counts).all()


def test_score_is_exact_beyond_64_bits(spark):
    rows = [(10**12, 10**12, 10**12 + 1), (3, 7, 9), (10**9 + 7, 10**13 + 3, 10**12 + 9), (10, 10, 10)]
    frame = spark.createDataFrame(rows, "a long, l long, r long")
    got = [r[0] for r in frame.select(col.score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [1_000_000 * a * a // (x * y) for a, x, y in rows]
