import random

import public_tokenizers
import pytest
import tiktoken

from tripwright.llm import bpe

ALPHABET = ["a", "e", "th", " ", "  ", "\n", "\t", "\r\n", "é", "ß", "中", "🙂", "1", "23", "'s", "'", "?!", "\xa0", "　",
            "\x1c", "\x85", "​", "Z", "the", "ing", "-", "﻿", " ", "ſ", "²"]


@pytest.fixture(scope="module")
def ranks():
    return bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary(ranks):
    return bpe.Vocabulary(ranks)


@pytest.fixture(scope="module")
def peer(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _ids(data):
    return memoryview(data).cast("I").tolist()


def test_texts_encode_like_the_library(vocabulary, peer):
    draw = random.Random(5)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "\n" * 300, "a" * 5000, "==" * 700, "word " * 500]
    encode = bpe.text_encoder(vocabulary, public_tokenizers.PATTERN, entries=50)
    found = encode(texts)
    assert [_ids(x) for x in found] == [peer.encode_ordinary(t) for t in texts]
    assert [bpe.decode_ids(vocabulary, x) for x in found] == [t.encode() for t in texts]


def test_appends_and_edits_are_exact(vocabulary):
    draw = random.Random(6)
    for _ in range(300):
        piece = bytes(draw.choice(b"abcdeinghtr ") for _ in range(draw.randint(1, 300)))
        table = bpe.PrefixTable(vocabulary)
        for low in range(0, len(piece), 7):
            table.append(piece[low : low + 7])
        assert table.last == bpe.PrefixTable(vocabulary, piece).last
        a = draw.randint(0, len(piece))
        b = draw.randint(a, len(piece))
        new = bytes(draw.choice(b"abcdeing") for _ in range(draw.randint(0, 9)))
        table.replace(a, b, new)
        edited = piece[:a] + new + piece[b:]
        assert (table.piece, table.last) == (edited, bpe.PrefixTable(vocabulary, edited).last)
        other = edited[: len(edited) // 2] + b"another"
        table.move_to(other)
        assert table.ids() == bpe.PrefixTable(vocabulary, other).ids()


def test_an_edit_far_from_the_end_stops_early(vocabulary):
    draw = random.Random(1)
    piece = bytes(draw.choice(b"abcdeinght") for _ in range(20_000))
    table = bpe.PrefixTable(vocabulary, piece)
    assert table.replace(100, 101, b"zz") < 2_000
    assert table.last == bpe.PrefixTable(vocabulary, piece[:100] + b"zz" + piece[101:]).last


def test_rows(documents, ranks, peer):
    docs = documents((1, None), (2, ""), (None, "the cat"), (3, "the cat"), (3, "the cat"), (4, "x" * 100_000))
    docs = docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "decoded")
    rows = bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN).collect()
    assert [r["doc_id"] for r in rows] == [1, 2, None, 3, 3, 4]
    assert [_ids(r["ids"]) for r in rows] == [peer.encode_ordinary(t) for t in ("", "", *["the cat"] * 3, "x" * 100_000)]
    assert bytes(rows[5]["decoded"]) == b"x" * 100_000
    assert bpe.encode_decode(documents(), ranks, public_tokenizers.PATTERN).count() == 0


def test_query_matches_the_library(spark, sf_dir, peer):
    import hashlib
    import struct

    from tripwright.llm.queries import QUERIES

    texts = dict(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    for row in QUERIES["op4_byte_bpe"](spark, sf_dir).collect():
        ids = peer.encode_ordinary(texts[row["doc_id"]])
        data = struct.pack(f"<{len(ids)}I", *ids)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(data).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
