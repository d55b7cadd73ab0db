"""Byte-level BPE by prefix dynamic programming.

For each prefix of a piece the table holds the last token of that prefix's one
valid encoding. A token may follow a prefix only if merging would never have
joined across the seam, which two tokens decide between themselves. The
encoding of a piece is then read off backwards. Appending bytes extends the
table; an edit recomputes it from the edit until it agrees with the old one.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tripwright.llm.common import groups

# The blanks of Unicode's White_Space property (fixed values). A piece of the
# split pattern never runs from a character that is none into one that is.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Encodings remembered in each of two generations, so that frequent words are worked out once.
CACHE_ENTRIES = 300_000
GROUP_CHARS = 1 << 22
SEAM_ENTRIES = 500_000


def load_ranks(path: str) -> dict[bytes, int]:
    """The rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks with what the validity test needs: for each token the halves of its last merge."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.by_rank = [self.tokens.get(rank, b"") for rank in range(max(self.tokens) + 1)]
        self.longest = max(map(len, ranks))
        self.seams: dict[int, bool] = {}
        # the longest token that ends in these bytes (three, or the whole of a shorter one)
        self.reach: dict[bytes, int] = {}
        for token in ranks:
            self.reach[token[-3:]] = max(len(token), self.reach.get(token[-3:], 0))
        self.halves: dict[int, tuple[int, int]] = {}
        # shorter tokens first: a token's halves are shorter than itself
        for token, rank in sorted(ranks.items(), key=lambda item: (len(item[0]), item[1])):
            self.halves[rank] = self._last_merge(token, rank)

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int]:
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best = min(
                range(len(parts) - 1),
                key=lambda i: self.ranks.get(parts[i] + parts[i + 1], 1 << 60),
            )
            if parts[best] + parts[best + 1] not in self.ranks:
                return rank, rank
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        if len(parts) < 2:
            return rank, rank
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def fits(self, left: int, right: int) -> bool:
        """``_fits``, and remembers it: few pairs of tokens make up most seams."""
        if len(self.seams) >= SEAM_ENTRIES:
            self.seams.clear()
        known = self.seams[left << 32 | right] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        """Whether the encoding of the two tokens' bytes is just these two tokens.

        Walks the merges that touch the seam backwards, the later one first. The
        seam breaks if the pair beside it could merge before the merge undone last.
        """
        limit = 1 << 60
        while True:
            joined = self.ranks.get(self.tokens[left] + self.tokens[right])
            if joined is not None and joined < limit:
                return False
            inner_left, inner_right = self.halves[left][1], self.halves[right][0]
            if left > right and inner_left != left or inner_right == right:
                if inner_left == left:
                    return True
                limit, left = left, inner_left
            else:
                # of two merges with one rank the left one goes first
                limit, right = right + 1, inner_right


class PrefixTable:
    """``last[i]`` is the last token of the encoding of the first ``i + 1`` bytes."""

    def __init__(self, vocabulary: Vocabulary, piece: bytes = b""):
        self.vocabulary, self.piece, self.last = vocabulary, b"", []
        self.append(piece)

    def append(self, more: bytes) -> None:
        """Exact: the entries before stay as they are."""
        self.piece += more
        self._extend(self.last, len(self.piece))

    def _extend(self, last: list[int], stop: int) -> None:
        """Works out the entries up to ``stop`` bytes."""
        piece, vocabulary = self.piece, self.vocabulary
        rank_of, seam, reach = vocabulary.ranks.get, vocabulary.seams.get, vocabulary.reach.get
        for end in range(len(last) + 1, stop + 1):
            low = end - reach(piece[end - 3 : end] if end > 3 else piece[:end], 2)
            for start in range(low if low > 0 else 0, end):
                token = rank_of(piece[start:end])
                if token is not None:
                    if not start:
                        break
                    fits = seam(last[start - 1] << 32 | token)
                    if fits or fits is None and vocabulary.fits(last[start - 1], token):
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)

    def move_to(self, piece: bytes) -> None:
        """The table of another piece; entries of the common prefix stay."""
        shared, most = 0, min(len(self.piece), len(piece))
        while shared < most and self.piece[shared] == piece[shared]:
            shared += 1
        self.piece = piece[:shared]
        del self.last[shared:]
        self.append(piece[shared:])

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Puts ``new`` in place of bytes ``[start, stop)``; returns how many entries were worked out.

        An entry depends on the entries and bytes within one longest token before
        it. Once that many in a row agree with the old ones, the rest are kept.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.piece = self.piece[:start] + new + self.piece[stop:]
        last, agreed, end = old[:start], 0, start
        while end < len(self.piece):
            end += 1
            self._extend(last, end)
            same = end > start + len(new) and old[end - 1 - shift] == last[-1]
            agreed = agreed + 1 if same else 0
            if agreed == self.vocabulary.longest:
                last += old[end - shift :]
                break
        self.last = last
        return end - start

    def ids(self) -> list[int]:
        out, end = [], len(self.piece)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.tokens[out[-1]])
        return out[::-1]


def text_encoder(vocabulary: Vocabulary, pattern: str, entries: int = CACHE_ENTRIES):
    """Texts to ids as little-endian 32-bit values; each match of ``pattern`` apart.

    Texts are first cut where a blank follows a character that is none, where no
    match can continue. These cuts repeat, so their ids are remembered. New pieces
    are taken in sorted order, so that each extends what it shares with the one before.
    """
    pieces = regex.compile(pattern)
    cuts = re.compile(f"[{BLANKS}]*[^{BLANKS}]+|[{BLANKS}]+")
    known: dict[str, bytes] = {}
    older: dict[str, bytes] = {}
    encoded: dict[str, bytes] = {}

    def learn(new: set[str]) -> dict[str, bytes]:
        parts = {cut: pieces.findall(cut) for cut in new}
        if len(encoded) > entries:
            encoded.clear()
        raw = {
            piece.encode("utf-8", "surrogatepass"): piece
            for found in parts.values()
            for piece in found
            if piece not in encoded
        }
        table = PrefixTable(vocabulary)
        for data in sorted(raw):
            whole = vocabulary.ranks.get(data)
            if whole is None:
                table.move_to(data)
            encoded[raw[data]] = array("I", table.ids() if whole is None else [whole]).tobytes()
        return {cut: b"".join([encoded[piece] for piece in found]) for cut, found in parts.items()}

    def encode(texts: list[str]) -> list[bytes]:
        nonlocal known, older
        found = [cuts.findall(text) for text in texts]
        fresh = {cut for cut in set().union(*found) if cut not in known}
        again = {cut: older[cut] for cut in fresh if cut in older}
        known.update(again)
        known.update(learn(fresh.difference(again)))
        ids = [b"".join([known[cut] for cut in of_text]) for of_text in found]
        if len(known) > entries:
            known, older = {}, known
        return ids

    return encode


def decode_ids(vocabulary: Vocabulary, ids: bytes) -> bytes:
    return b"".join(map(vocabulary.by_rank.__getitem__, memoryview(ids).cast("I").tolist()))


class Codec:
    """Encoder and decoder of one vocabulary, with what it remembers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.encode = text_encoder(self.vocabulary, pattern)

    def decode(self, ids: bytes) -> bytes:
        return decode_ids(self.vocabulary, ids)


def encode_decode(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: the id, ``ids`` and ``decoded``.

    ``ids`` are the text's token ids as little-endian unsigned 32-bit values,
    ``decoded`` the bytes these ids stand for. A null or empty text has no ids.
    Repeated rows give repeated results; other columns are ignored. The ranks,
    a vocabulary of fixed size, are broadcast; there is no shuffle.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({"ranks": ranks, "pattern": pattern})
    rows = docs.select(id_col, text)
    id_type = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a worker keeps the broadcast dictionary between tasks, and so the codec in it
        held = shared.value
        if "codec" not in held:
            held["codec"] = Codec(held["ranks"], held["pattern"])
        codec = held["codec"]
        for batch in batches:
            texts = [value or "" for value in batch.column(1).to_pylist()]
            for low, high in groups(texts, GROUP_CHARS):
                ids = codec.encode(texts[low:high])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(ids, pa.binary()),
                        pa.array([codec.decode(value) for value in ids], pa.binary()),
                    ],
                    names=[id_col, "ids", "decoded"],
                )

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, ids binary, decoded binary")
