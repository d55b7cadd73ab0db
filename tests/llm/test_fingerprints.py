import hashlib
import zlib

import numpy as np

from tripwright.llm import fingerprints as fp


def _same(a, b):
    return a.encoded() == b.encoded()


def test_sum_of_paragraphs():
    text = b"one two three\nfour five\n\nsix"
    assert _same(fp.fingerprint(text), fp.fingerprint(b"\nsix\nfour five\none two three"))
    without = fp.fingerprint(text).minus(fp.hash_paragraphs([b"four five"]))
    assert _same(without, fp.fingerprint(b"one two three\n\nsix"))
    assert _same(without.plus(fp.hash_paragraphs([b"four five"])), fp.fingerprint(text))
    assert not _same(fp.fingerprint(b"a"), fp.fingerprint(b"a\na"))
    assert not _same(fp.fingerprint(b""), fp.fingerprint(b"\n"))
    assert _same(fp.decoded(fp.fingerprint(text).encoded()), fp.fingerprint(text))


def test_likeness():
    draw = np.random.default_rng(0)
    words = [b"w%d" % i for i in draw.integers(0, 10_000, 800)]
    a = fp.fingerprint(b" ".join(words))
    b = fp.fingerprint(b" ".join(words[:600] + [b"x%d" % i for i in range(200)]))
    c = fp.fingerprint(b" ".join(b"y%d" % i for i in range(800)))
    assert fp.likeness(a, a) == 1.0
    assert 0.6 < fp.likeness(a, b) < 0.9 and fp.likeness(a, c) < 0.25
    assert fp.likeness(fp.fingerprint(b""), fp.fingerprint(b"")) == 1.0
    assert 0 <= fp.likeness(fp.fingerprint(b""), a) <= 1


def _expected(rows):
    """Plain version over (id, text) rows in order."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    out = []
    for at, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(at + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        out.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.fingerprint(text.encode()).encoded(),
             fp.fingerprint(edited.encode()).encoded(), _near(text, edited), _near(text, following))
        )
    return out


def _lanes(text):
    """The signed counts of a text's word pairs, one pair at a time."""
    lanes = [0] * fp.SKETCH_LANES
    for paragraph in text.encode().split(b"\n"):
        codes = [0, *map(zlib.crc32, paragraph.split()), 0] if paragraph else []
        for one, two in zip(codes, codes[1:]):
            pair = int(fp.mix64(np.array([(one << 32) + two], np.uint64))[0])
            lanes[(pair >> 40) % fp.SKETCH_LANES] += 1 - 2 * (pair & 1)
    return lanes


def _near(a, b):
    if sorted(a.split("\n")) == sorted(b.split("\n")):
        return 1.0
    x, y = _lanes(a), _lanes(b)
    both = sum(v * v for v in x) + sum(v * v for v in y)
    return min(1.0, max(0.0, 2 * sum(v * w for v, w in zip(x, y)) / both)) if both else 0.0


def _got(df):
    return [tuple(r) for r in df.collect()]


def test_likeness_of_long_repetitive_texts():
    for n in (30_000, 40_000, 60_000, 80_000):
        text = b"a " * n
        edited = text[: -len(text) // 4] + b"b " * (n // 4)
        assert 0.8 < fp.likeness(fp.fingerprint(text), fp.fingerprint(edited)) < 1


def _key(rows):
    return sorted(rows, key=repr)


def test_edits_match_a_plain_version(documents):
    rows = [(i * 7 % 1009, f"line {i} é\n" * (i % 9) + "🙂" * (i % 5) + " tail") for i in range(700)]
    rows += [(None, "no id at all"), (3_000, None), (3_001, ""), (3_002, "x" * 50_000), (3_002, "x" * 50_000), (3_003, "abcd")]
    for rows_ in (rows, rows[:1], [(5, "only one, edited by itself")], [(1, "a" * 9), (1, "a" * 9)]):
        assert _key(_got(fp.edited_fingerprints(documents(*rows_)))) == _key(_expected(rows_))


def test_many_ranges(documents, monkeypatch):
    monkeypatch.setattr(fp, "ROWS_PER_RANGE", 7)
    rows = [(i // 2 if i % 5 else -i, f"text {i}\nmore {i * i}") for i in range(300)] + [(None, "a"), (None, "b b b b")]
    assert _key(_got(fp.edited_fingerprints(documents(*rows)))) == _key(_expected(rows))


def test_rows(documents):
    docs = documents((1, None), (2, ""), (None, "z"), (3, "same"), (3, "same")).withColumnRenamed("lang", "fingerprint")
    rows = [r["fingerprint"] for r in fp.fingerprints(docs).collect()]
    assert rows[0] == rows[1] and rows[3] == rows[4] and len(set(rows)) == 3
    assert fp.edited_fingerprints(documents()).count() == 0
