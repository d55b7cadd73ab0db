"""Placement by a permutation-filled lookup table.

Every shard has its own permutation of the slots of a prime-sized table. The
shards take turns, each claiming the first slot of its permutation that is still
free, until the table is full. So shards own equal numbers of slots within one,
and a shard that leaves moves few slots of the others. A key's hash is its slot.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A prime, far above the number of shards: the more slots, the more even.
TABLE_SIZE = 65_537
SHARDS = tuple(f"shard-{number:03d}" for number in range(100))
# Tables over this size are refused: the table is sent to every task.
MAX_TABLE_SIZE = 1 << 20


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "little")


def fill(shards: list[str] | tuple[str, ...], size: int = TABLE_SIZE) -> list[int]:
    """For each slot the number of the shard that owns it, in the order of ``shards``.

    Shards must be distinct, one at least and at most ``size``; ``size`` a prime.
    """
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, one at least and no more than slots")
    if size > MAX_TABLE_SIZE or size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError(f"the table size must be a prime up to {MAX_TABLE_SIZE}")
    # a step prime to the size walks through all slots
    at = [_number(name, "offset") % size for name in shards]
    step = [_number(name, "skip") % (size - 1) + 1 for name in shards]
    owner, free = [-1] * size, size
    while True:
        for shard in range(len(shards)):
            slot = at[shard]
            while owner[slot] >= 0:
                slot = (slot + step[shard]) % size
            owner[slot] = shard
            at[shard] = (slot + step[shard]) % size
            free -= 1
            if not free:
                return owner


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    """The slot of a key; equal keys share it, and null has the slot of the empty text."""
    return F.pmod(F.xxhash64(F.coalesce(key.cast("string"), F.lit(""))), F.lit(size)).cast("int")


def assign(
    rows: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE, name: str = "shard"
) -> DataFrame:
    """``rows`` with the column ``name``: the shard of each row's key.

    The table, ``size`` rows of fixed bound, is broadcast and hashed by slot, so
    placement takes constant time and no shuffle. A column ``name`` that ``rows``
    already has is replaced. Null keys share one shard. A hot key lands in one
    shard, so place rows by what tells them apart, such as the row's id.
    """
    owners = pd.DataFrame({"_slot": range(size), "_owner": [shards[owner] for owner in fill(shards, size)]})
    table = rows.sparkSession.createDataFrame(owners, "_slot int, _owner string")
    placed = rows.withColumn("_slot", slot_of(F.col(key), size)).join(F.broadcast(table), "_slot", "left")
    return placed.withColumn(name, F.col("_owner")).drop("_slot", "_owner")


def write_shards(rows: DataFrame, key: str, path: str, shards: tuple[str, ...] = SHARDS, size: int = TABLE_SIZE) -> None:
    """Writes ``rows`` as one folder per shard, each split evenly into files."""
    placed = assign(rows, key, shards, size)
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
