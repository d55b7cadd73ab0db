import random
from collections import Counter

import numpy as np
import pytest

from tripwright.llm import suffix_dedup as sd


def _plain(texts):
    """(bytes, removed, spans, kept) per text, by counting all strings."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + 200] for t in raw for i in range(len(t) - 199))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return out


def _texts(seed, n=40):
    draw = random.Random(seed)
    pool = ["".join(draw.choice("abcd é") for _ in range(600)) for _ in range(4)]

    def text():
        out = ""
        for _ in range(draw.randint(0, 4)):
            a = draw.randint(0, 500)
            out += draw.choice(pool)[a : a + draw.randint(0, 500)] + "".join(draw.choice("xyz") for _ in range(draw.randint(0, 60)))
        return out

    return [text() for _ in range(n)] + ["a" * 900, "ab" * 300, "x" * 205, "q" * 199, "", None, pool[0], pool[0], "z" * 200]


def _got(docs):
    rows, texts = sd.dedup(docs)
    cut = {bytes(r["text_key"]): r for r in texts.collect()}
    out = []
    for row in rows.collect():
        found = cut.get(bytes(row["text_key"]))
        out.append((row["doc_id"], row["n_bytes"], *((found["n_removed"], found["n_spans"], bytes(found["kept"])) if found else (0, 0, None))))
    return sorted(out, key=repr)


def _check(documents, texts):
    rows = list(enumerate(texts)) + [(None, "w" * 10)]
    plain = _plain([t for _, t in rows])
    want = sorted(((i, n, r, s, kept if r else None) for (i, _), (n, r, s, kept) in zip(rows, plain)), key=repr)
    assert _got(documents(*rows).withColumnRenamed("lang", "text_key").withColumnRenamed("source", "kept")) == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_matches_counting_all_strings(documents, seed):
    _check(documents, _texts(seed))


def test_hot_buckets_and_long_texts_are_cut_exactly(documents, monkeypatch):
    monkeypatch.setattr(sd, "HOT_ROWS", 2)
    monkeypatch.setattr(sd, "PIECE", 700)
    monkeypatch.setattr(sd, "BLOCK_BYTES", 1_000)
    _check(documents, _texts(4))


def test_very_long_text(documents):
    draw = random.Random(8)
    base = "".join(draw.choice("abcdefg ") for _ in range(150_000))
    _check(documents, [base, base[:75_000] + "!" + base[75_000:], base[1_000:1_300]])


def test_empty_table(documents):
    rows, texts = sd.dedup(documents())
    assert rows.count() == 0 and texts.count() == 0


def test_cover_has_a_shift_for_each_pair():
    block = sd.Block([b"a" * 300])
    assert all((a + block.shift[a, b]) % sd.PERIOD in sd.COVER and (b + block.shift[a, b]) % sd.PERIOD in sd.COVER
               for a in range(sd.PERIOD) for b in range(sd.PERIOD))


def test_block_compare_sorts_like_bytes():
    draw = random.Random(2)
    stretch = bytes(draw.choice(b"ab") for _ in range(60)) * 30
    stretch += bytes(draw.choice(b"ab") for _ in range(400)) + stretch[:900]
    block = sd.Block([stretch])
    at = np.array([draw.randrange(len(stretch) - 200) for _ in range(3_000)])
    to = (at + 60 * np.array([draw.randint(-20, 20) for _ in at])) % (len(stretch) - 200)
    tied = np.array([stretch[a : a + 31] == stretch[b : b + 31] for a, b in zip(at, to)])
    at, to = at[tied], to[tied]
    want = [(stretch[a : a + 200] > stretch[b : b + 200]) - (stretch[a : a + 200] < stretch[b : b + 200]) for a, b in zip(at, to)]
    assert len(at) > 100 and block.compare(at, to).tolist() == want
