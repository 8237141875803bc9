"""Shard placement by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a table of prime size
(offset and step from hashes of its name).  Shards take turns; at its turn a
shard claims the next free slot of its permutation, until the table is full.
Every shard then owns the same number of slots to within one turn, and when a
shard is added or removed few slots of the others change hands.  A row is
placed by its key's hash modulo the table size: one look-up in the broadcast
table, whose size is a checked parameter and does not depend on the data.

Defined results: a null key has one fixed slot; equal keys share a slot; empty
tables give empty results; a weight w gives a shard w turns in each round.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537
MAX_TABLE_SIZE = 1 << 22  # broadcast bound: 4 million rows of two integers


def is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n**0.5) + 1))


def fill_table(shards: list[str], size: int = TABLE_SIZE, weights: list[int] | None = None) -> np.ndarray:
    """Shard number of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be given and distinct")
    if not is_prime(size) or not len(shards) <= size <= MAX_TABLE_SIZE:
        raise ValueError(f"table size must be a prime between the number of shards and {MAX_TABLE_SIZE}")
    weights = weights or [1] * len(shards)
    if len(weights) != len(shards) or min(weights) < 1:
        raise ValueError("every shard needs a weight of at least 1")
    at = [xxhash.xxh64_intdigest(s.encode(), 1) % size for s in shards]
    step = [xxhash.xxh64_intdigest(s.encode(), 2) % (size - 1) + 1 for s in shards]
    table = np.full(size, -1, np.int32)
    owner = table.tolist()
    left = size
    turns = [k for k, w in enumerate(weights) for _ in range(w)]
    while left:
        for k in turns:
            slot = at[k]
            while owner[slot] >= 0:
                slot = (slot + step[k]) % size
            owner[slot], at[k] = k, (slot + step[k]) % size
            left -= 1
            if not left:
                break
    return np.array(owner, np.int32)


def slot_of(key: Column, size: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(size)).cast("int")


def slot_table(spark: SparkSession, shards: list[str], size: int = TABLE_SIZE, weights: list[int] | None = None) -> DataFrame:
    owner = fill_table(shards, size, weights)
    rows = [(slot, int(k), shards[k]) for slot, k in enumerate(owner)]
    return spark.createDataFrame(rows, "slot int, shard_no int, shard string")


def place(df: DataFrame, key_col: str, shards: list[str], size: int = TABLE_SIZE, weights: list[int] | None = None) -> DataFrame:
    """``df`` with ``slot, shard_no, shard`` (input columns of these names are
    replaced); no row moves."""
    table = slot_table(df.sparkSession, shards, size, weights)
    rest = df.drop("shard_no", "shard").withColumn("slot", slot_of(F.col(f"`{key_col}`"), size))
    return rest.join(F.broadcast(table), "slot", "left")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder per shard; tasks write what they hold, without a shuffle."""
    placed.write.partitionBy("shard").parquet(path)
