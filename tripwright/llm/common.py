"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwright.session import scratch_dir

# Texts are worked through in groups of about this many bytes, which bounds a task's arrays.
GROUP_BYTES = 1 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` through a Parquet table in the shared folder: cuts its lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """One key for a row: equal for repeated rows only, never null.

    Lengths stand before the values, so no id and text read like another pair.
    """

    def part(name: str) -> Column:
        value = F.col(name).cast("string")
        return F.coalesce(F.concat(F.char_length(value).cast("string"), F.lit(":"), value), F.lit("null"))

    return F.md5(F.concat(part(doc_id), F.lit("|"), part(text)))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as ``df`` has such a column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def crc_mod(column: str, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; null stays null."""
    return F.crc32(F.col(column).cast("string")) % n


def byte_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes per row; null reads as empty."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def groups(texts: list, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Runs ``[low, high)`` of rows with about ``size`` bytes, one row at least."""
    low = held = 0
    for at, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield low, at + 1
            low, held = at + 1, 0
    if low < len(texts):
        yield low, len(texts)


def slices(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """``groups`` of a column, by the bytes of its texts."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    low = 0
    while low < len(lengths):
        done = ends[low - 1] if low else 0
        high = min(len(lengths), int(np.searchsorted(ends, done + size)) + 1)
        yield low, high
        low = high


def byte_groups(column: pa.Array, size: int = GROUP_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """``groups`` of a column with the UTF-8 texts of each, taken out one group at a time."""
    for low, high in slices(column, size):
        yield low, high, byte_texts(column.slice(low, high - low))


def mix64(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64, copy=True)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def word_table(keep: bytes) -> bytes:
    """For ``bytes.translate``: A-Z lowered, bytes outside ``keep`` and under 0x80 become blanks."""
    return bytes(
        b if b >= 0x80 or b in keep else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
    )


# Words are runs of digits, a-z (A-Z lowered) and everything outside ASCII.
WORDS = word_table(bytes(range(48, 58)) + bytes(range(97, 123)))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text: runs of digits, a-z (A-Z lowered) and all outside ASCII."""
    return text.translate(WORDS).split()
