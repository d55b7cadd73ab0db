"""Secrets in texts and in what the texts encode.

A worklist starts with the text itself. Each layer on it is scanned; URL and
Unicode escapes give one further layer with the escapes replaced, each base64
run gives layers of its own, one for each of the four places a payload in it may
start at, decompressed where a known compression starts.
Layers seen before are not taken again, so the list runs dry. Every layer keeps
the original span of each of its characters, so a find maps to the given text.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwright.llm.common import groups

# The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LEAST, ACCESS_LEAST = 8, 16

# A text without these strings (A-Z lowered) has no assign find.
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE_RUN = re.compile(
    r"(?:\\u[0-9A-Fa-f]{4}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};)+"
)
ESCAPE = re.compile(r"\\u\{([0-9A-Fa-f]+)\}|\\[ux]([0-9A-Fa-f]+)|&#[xX]([0-9A-Fa-f]+);|&#([0-9]+);")
# Bytes of base64 before decoding; an encoded access key has at least 22.
BASE64_LEAST = 16
BASE64_RUN = re.compile(
    r"(?:[A-Za-z0-9+/]{60,}\r?\n)+[A-Za-z0-9+/]+={0,2}|[A-Za-z0-9+/_-]{%d,}={0,2}" % BASE64_LEAST
)
# Lines of nothing but base64, indented or not; where such text is wrapped, all lines but the last are equally long.
BASE64_LINES = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[\x20\t]*+\r?\n[\x20\t]*+[A-Za-z0-9+/_-]++)++={0,2}"
)
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# Where a compressed stream may start inside of decoded bytes.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|\x28\xb5\x2f\xfd|BZh[1-9]1AY|\xfd7zXZ\x00")
# Bytes with neither a find nor anything to decode match none of these.
FERTILE = re.compile(
    rb"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{32}|%%[0-9A-Fa-f]{2}|\\[ux]|&#|[A-Za-z0-9+/_-]{%d}" % BASE64_LEAST
    + rb"|[A-Za-z0-9+/_-][\x20\t]*\r?\n[\x20\t]*[A-Za-z0-9+/_-]"
)
IS_BASE64 = bytes(
    b if chr(b).isalnum() and b < 128 or chr(b) in "+/_-" else 32 for b in range(256)
)
IS_HEX = bytes(104 if chr(b) in "0123456789abcdef" else 32 for b in range(256))
# A layer that would decode to more bytes is reported as kind "oversize" and not scanned. A layer takes
# some six bytes of memory per byte.
MAX_LAYER_BYTES = 1 << 26
# Escapes inside of escapes are undone one by one this often, and then all at once.
ESCAPE_STEPS = 8
HEX_DIGITS = frozenset("0123456789abcdefABCDEF")
BRACED = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}$")
ENTITY = re.compile(r"&#(?:[xX]([0-9A-Fa-f]{1,6})|([0-9]{1,7}));$")

FINDING = "array<struct<kind:string,start:int,end:int,layer:int,path:string,value:string>>"


def base_finds(text: str, raw: bytes) -> list[tuple[str, int, int]]:
    """(kind, start, end) in one layer; ``raw`` is its UTF-8, for quick tests."""
    out = []
    lowered = raw.lower()
    if any(word in lowered for word in ASSIGN_WORDS):
        for found in ASSIGN.finditer(text):
            if len(found[2]) >= ASSIGN_LEAST:
                out.append(("assign", found.start(), found.end()))
    if b"AKIA" in raw:
        for found in ACCESS.finditer(text):
            if len(found[0]) >= ACCESS_LEAST:
                out.append(("access", found.start(), found.end()))
    if b"h" * 32 in raw.translate(IS_HEX):
        out += [("hex", found.start(), found.end()) for found in HEX.finditer(text)]
    return out


class Layer:
    """A text and the original span of each of its characters.

    Without ``starts`` the text is the given one, or all of it has the span
    ``fixed``. ``escapes`` counts the escape steps since the text or the run.
    """

    def __init__(self, text: str, starts=None, ends=None, path: str = "", fixed=None, escapes: int = 0):
        self.text, self.starts, self.ends, self.path = text, starts, ends, path
        self.fixed, self.escapes = fixed, escapes
        self.raw = text.encode("utf-8", "surrogatepass")

    def origin(self, start: int, end: int) -> tuple[int, int]:
        if self.fixed is not None:
            return self.fixed
        if self.starts is None:
            return start, end
        return int(self.starts[start:end].min()), int(self.ends[start:end].max())

    def key(self) -> bytes:
        digest = hashlib.blake2b(self.raw, digest_size=16)
        spans = [] if self.starts is None else [self.starts, self.ends]
        for part in (repr((self.fixed, len(self.raw))).encode(), *spans):
            digest.update(part)
        return digest.digest()

    def inner(self, text: str, start: int, end: int, step: str) -> "Layer":
        """What the run ``[start, end)`` decodes to, as a layer of its own."""
        return Layer(text, path=f"{self.path}/{step}", fixed=self.origin(start, end))

    def replaced(self, runs: list[tuple[int, int, str]], step: str) -> "Layer":
        """The layer with runs replaced by what they decode to."""
        path, escapes = f"{self.path}/{step}", self.escapes + 1
        if self.fixed is not None:
            parts, at = [], 0
            for start, end, new in runs:
                parts += [self.text[at:start], new]
                at = end
            return Layer("".join(parts) + self.text[at:], path=path, fixed=self.fixed, escapes=escapes)
        starts = np.arange(len(self.text)) if self.starts is None else self.starts
        ends = starts + 1 if self.ends is None else self.ends
        parts, low_parts, high_parts, at = [], [], [], 0
        for start, end, new in [*runs, (len(self.text), len(self.text), "")]:
            parts.append(self.text[at:start] + new)
            low_parts.append(starts[at:start])
            high_parts.append(ends[at:start])
            if new:
                low, high = self.origin(start, end)
                low_parts.append(np.full(len(new), low))
                high_parts.append(np.full(len(new), high))
            at = end
        return Layer("".join(parts), np.concatenate(low_parts), np.concatenate(high_parts), path, escapes=escapes)

    def settled(self) -> "Layer | None":
        """The layer with all escapes undone until none is left, in one walk; None if there is none.

        What is decoded goes back to the end of what was read so far, where it may
        complete another escape. Each one makes the text shorter, so the time is
        linear. Bytes of a character wait until they are all there.
        """
        out, low, high = [], [], []
        flat = self.fixed is not None or self.starts is None
        starts = range(len(self.text)) if flat else self.starts.tolist()
        ends = range(1, len(self.text) + 1) if flat else self.ends.tolist()
        changed = False

        def fold(width: int, value) -> None:
            low[-width:], high[-width:] = [min(low[-width:])], [max(high[-width:])]
            out[-width:] = [value]

        for char, start, end in zip(self.text, starts, ends):
            out.append(char)
            low.append(start)
            high.append(end)
            while (found := _escape_at_end(out)) is not None:
                changed = True
                fold(*found)
        if not changed:
            return None
        # bytes that are no character stay as they were
        parts = [value if isinstance(value, str) else value[1] for value in out]
        text, path = "".join(parts), f"{self.path}/escapes"
        if self.fixed is not None:
            return Layer(text, path=path, fixed=self.fixed, escapes=ESCAPE_STEPS + 1)
        sizes = [len(part) for part in parts]
        return Layer(text, np.repeat(low, sizes), np.repeat(high, sizes), path, escapes=ESCAPE_STEPS + 1)


def _escape_at_end(out: list) -> tuple[int, str | tuple[int, str]] | None:
    """How many of the last items are an escape, and what it stands for: a character, or a byte and how it was written."""
    last = out[-1]
    if isinstance(last, tuple):
        # a character of two to four bytes is complete
        for width in range(2, min(4, len(out)) + 1):
            if not all(isinstance(value, tuple) for value in out[-width:]):
                break
            try:
                return width, bytes(value for value, _ in out[-width:]).decode("utf-8")
            except UnicodeDecodeError:
                continue
        return None
    if last in HEX_DIGITS and len(out) > 2 and out[-2] in HEX_DIGITS:
        if out[-3] == "%":
            value = int(out[-2] + last, 16)
            return 3, chr(value) if value < 128 else (value, "".join(out[-3:]))
        if out[-4:-2] == ["\\", "x"]:
            return 4, chr(int(out[-2] + last, 16))
        if out[-6:-4] == ["\\", "u"] and out[-3] in HEX_DIGITS and out[-4] in HEX_DIGITS:
            return 6, chr(int("".join(out[-4:]), 16))
    elif last == ";" or last == "}":
        tail = "".join(value if isinstance(value, str) else "\0" for value in out[-11:])
        if found := (ENTITY if last == ";" else BRACED).search(tail):
            value = int(found[1], 16) if found[1] else int(found[2])
            return len(found[0]), chr(min(value, 0x10FFFF))
    elif "\udc00" <= last <= "\udfff" and len(out) > 1 and isinstance(out[-2], str) and "\ud800" <= out[-2] <= "\udbff":
        return 2, chr(0x10000 + ((ord(out[-2]) - 0xD800) << 10) + ord(last) - 0xDC00)
    return None


def _url(found: re.Match) -> str | None:
    data = bytes.fromhex(found[0].replace("%", ""))
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        return None


def _unescape(found: re.Match) -> str:
    units = [
        chr(min(int(a or b or c, 16) if a or b or c else int(d), 0x10FFFF))
        for a, b, c, d in ESCAPE.findall(found[0])
    ]
    # two halves of a pair become one character; a lone half stays
    return re.sub(
        "[\ud800-\udbff][\udc00-\udfff]",
        lambda pair: chr(0x10000 + ((ord(pair[0][0]) - 0xD800) << 10) + ord(pair[0][1]) - 0xDC00),
        "".join(units),
    )


def _inflate(data: bytes) -> bytes | None:
    """Decompressed by magic bytes, all members in a row; None if it is no such stream. May raise OverflowError."""
    parts, size = [], 0
    while True:
        if data[:2] == b"\x1f\x8b":
            stream = zlib.decompressobj(31)
        elif data[:1] == b"\x78" and len(data) > 2 and int.from_bytes(data[:2], "big") % 31 == 0:
            stream = zlib.decompressobj(15)
        elif data[:4] == b"\x28\xb5\x2f\xfd":
            stream = None
        elif data[:3] == b"BZh":
            stream = bz2.BZ2Decompressor()
        elif data[:6] == b"\xfd7zXZ\x00":
            stream = lzma.LZMADecompressor()
        else:
            break
        most = MAX_LAYER_BYTES + 1 - size
        try:
            if stream is None:
                stream = zstandard.ZstdDecompressor().decompressobj()
                out = _unzstd(data, most)
                if len(out) < most:
                    stream.decompress(data)
            else:
                out = stream.decompress(data, most)
        except (zlib.error, OSError, lzma.LZMAError, EOFError, zstandard.ZstdError):
            break
        parts.append(out)
        size += len(out)
        if size > MAX_LAYER_BYTES:
            raise OverflowError
        # zeros may pad the end of a member
        data = stream.unused_data.lstrip(b"\0") if stream.eof else b""
    return b"".join(parts) if parts else None


def _unzstd(data: bytes, most: int) -> bytes:
    """The first frame, ``most`` bytes of it at most."""
    with zstandard.ZstdDecompressor().stream_reader(data) as reader:
        return reader.read(most)


def _readable(data: bytes) -> str | None:
    """Text, if the bytes are UTF-8 without control characters but blanks."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and not re.search(r"[\x00-\x08\x0e-\x1f\x7f]", text) else None


def _opened(data: bytes, step: str) -> Iterator[tuple[str, str | None]]:
    """(step, text) of decoded bytes and of the streams in them; no text where it would be too large."""
    starts = [0, *(found.start() for found in MAGIC.finditer(data) if found.start())]
    for start in starts:
        inner, path = memoryview(data)[start:] if start else data, step
        try:
            while (more := _inflate(inner)) is not None:
                inner, path = more, f"{path}/inflate"
        except OverflowError:
            yield path, None
            continue
        if (not start or path != step) and FERTILE.search(inner):
            text = _readable(inner)
            yield path, inner.decode("latin-1") if text is None else text


def _base64(run: str) -> Iterator[tuple[str, str | None]]:
    """(step, text) of a base64 run that may start at any of its characters.

    Compressed streams inside are undone, layer by layer; bytes that are no clean
    UTF-8 read as Latin-1, so that what stands between them is found.
    """
    body = re.sub(r"[\s=]", "", run).replace("-", "+").replace("_", "/")
    for offset in range(4):
        part = body[offset:]
        part = part[: len(part) - (len(part) % 4 == 1)]
        if len(part) >= BASE64_LEAST:
            yield from _opened(base64.b64decode(part + "=" * (-len(part) % 4)), "base64")


def _wrapped(text: str) -> Iterator[tuple[int, int]]:
    """Spans of two and more lines of base64: equally long, the last one not longer."""
    for found in BASE64_LINES.finditer(text):
        lines = [m.span() for m in BASE64_LINE.finditer(text, found.start(), found.end())]
        first = 0
        for at in range(1, len(lines) + 1):
            width = lines[first][1] - lines[first][0]
            ends = at == len(lines) or lines[at][1] - lines[at][0] > width
            # a shorter line is the last of its block
            if not ends and at > first + 1:
                ends = lines[at - 1][1] - lines[at - 1][0] < width
            if ends:
                if at - first > 1:
                    yield lines[first][0], lines[at - 1][1]
                first = at


def next_layers(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    """The layers one step further in; a pair is the span of a run too large to decode."""
    single = layer.escapes < ESCAPE_STEPS
    if layer.escapes == ESCAPE_STEPS and (last := layer.settled()) is not None:
        yield last
    if single and b"%" in layer.raw:
        runs = [(m.start(), m.end(), new) for m in URL_RUN.finditer(layer.text) if (new := _url(m)) is not None]
        if runs:
            yield layer.replaced(runs, "url")
    if single and (b"\\u" in layer.raw or b"\\x" in layer.raw or b"&#" in layer.raw):
        runs = [(m.start(), m.end(), _unescape(m)) for m in ESCAPE_RUN.finditer(layer.text)]
        if runs:
            yield layer.replaced(runs, "unicode")
    runs = []
    if max(map(len, layer.raw.translate(IS_BASE64).split()), default=0) >= BASE64_LEAST:
        runs = [found.span() for found in BASE64_RUN.finditer(layer.text)]
    if b"\n" in layer.raw:
        known = set(runs)
        runs += [span for span in _wrapped(layer.text) if span not in known]
    for start, end in runs:
        for step, text in _base64(layer.text[start:end]):
            yield layer.origin(start, end) if text is None else layer.inner(text, start, end, step)


def _covered(out: list, kind: str, low: int, high: int, value: str) -> bool:
    """Whether a run inside ``[low, high)`` gave the same value."""
    return any(f[0] == kind and low <= f[1] and f[2] <= high and f[5] == value for f in out)


def find_secrets(text: str) -> list[tuple[str, int, int, int, str, str]]:
    """(kind, start, end, layer, path, value), by start, then kind, end and layer.

    ``start`` and ``end`` are code points of the given text, ``layer`` counts the
    decodings (0: the text itself), ``path`` names them, ``value`` is what stands
    in the layer. A find that maps to the kind and span of an outer one is left out;
    in what a base64 run decodes to, where all finds have the run's span, only if
    their values are equal as well. Escapes nested deeper than ``ESCAPE_STEPS`` are
    undone in one walk, so the time is linear in the length; what only stands in a
    layer between is not scanned.
    """
    out, spans, seen = [], set(), set()
    work = deque([(0, Layer(text))])
    while work:
        depth, layer = work.popleft()
        for kind, start, end in base_finds(layer.text, layer.raw):
            low, high = layer.origin(start, end)
            value = layer.text[start:end].encode("utf-8", "replace").decode()
            in_run = "base64" in layer.path
            if not (_covered(out, kind, low, high, value) if in_run else (kind, low, high) in spans):
                spans.add((kind, low, high))
                out.append((kind, low, high, depth, layer.path, value))
        for inner in next_layers(layer):
            if isinstance(inner, tuple):
                if ("oversize", *inner) in spans:
                    continue
                spans.add(("oversize", *inner))
                out.append(("oversize", *inner, depth + 1, f"{layer.path}/base64", ""))
            elif (key := inner.key()) not in seen:
                seen.add(key)
                work.append((depth + 1, inner))
    order = {kind: at for at, kind in enumerate((*KINDS, "oversize"))}
    return sorted(out, key=lambda f: (f[1], order[f[0]], f[2], f[3]))


def scan(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id and ``findings``, as ``find_secrets`` lists them.

    A null or empty text has none; repeated rows give repeated results; other
    columns are ignored. There is no shuffle; a task holds one batch of texts.
    """
    rows = docs.select(id_col, text)
    id_type = rows.schema[0].dataType.simpleString()
    names = ("kind", "start", "end", "layer", "path", "value")
    kind = pa.list_(
        pa.struct(
            [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
             ("layer", pa.int32()), ("path", pa.string()), ("value", pa.string())]
        )
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value or "" for value in batch.column(1).to_pylist()]
            for low, high in groups(texts):
                found = [
                    [dict(zip(names, row)) for row in find_secrets(value)]
                    for value in texts[low:high]
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(found, kind)],
                    names=[id_col, "findings"],
                )

    return rows.mapInArrow(run, f"`{id_col}` {id_type}, findings {FINDING}")


def span_list(findings: Column) -> Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(
        F.transform(
            findings,
            lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")),
        ),
        ",",
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; all other columns as they are.

    Spans that touch or overlap become one mark. A null text stays null.
    """
    schema = docs.schema

    def clean(value: str | None) -> str | None:
        if not value:
            return value
        parts, at = [], 0
        for _, start, end, *_ in find_secrets(value):
            if start > at or not parts and start == at:
                parts += [value[at:start], mark]
            elif start == at:
                parts.append("" if parts[-1] == mark else mark)
            at = max(at, end)
        return "".join(parts) + value[at:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = schema.fieldNames().index(text)
        for batch in batches:
            new = pa.array([clean(value) for value in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [new if i == at else batch.column(i) for i in range(batch.num_columns)], schema=batch.schema
            )

    return docs.mapInArrow(run, schema)
