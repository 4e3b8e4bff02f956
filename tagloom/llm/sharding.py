"""Reproducible shuffle into shards: a Feistel permutation over global row numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import number_rows, text_of

SHARDS = 24
SEED = 20_240_117
ROUNDS = 6
PER_DOCUMENT = 8


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Feistel:
    """A keyed permutation of 0 .. rows - 1, computable for any number alone, and its inverse.

    A balanced Feistel network permutes the next power of four; numbers that leave the range walk on along
    their cycle until they are back in it, which takes fewer than four steps on average and keeps it a bijection.
    """

    def __init__(self, rows: int, seed: int = SEED, rounds: int = ROUNDS):
        self.rows = rows
        half = max(1, (max(rows - 1, 1).bit_length() + 1) // 2)
        self.shift, self.mask = np.uint64(half), np.uint64((1 << half) - 1)
        self.keys = _mix(np.arange(1, rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def _walk(self, x, once) -> np.ndarray:
        out = once(np.asarray(x, dtype=np.uint64))
        while (away := out >= np.uint64(self.rows)).any():
            out[away] = once(out[away])
        return out.astype(np.int64)

    def _forth(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.shift, x & self.mask
        for k in self.keys:
            left, right = right, left ^ (_mix(right + k) & self.mask)
        return (left << self.shift) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.shift, x & self.mask
        for k in self.keys[::-1]:
            left, right = right ^ (_mix(left + k) & self.mask), left
        return (left << self.shift) | right

    def position(self, row) -> np.ndarray:
        return self._walk(row, self._forth)

    def row(self, position) -> np.ndarray:
        return self._walk(position, self._back)


def shard_of(position, shards: int = SHARDS):
    """(shard, slot) of a position, a number or a column, of the shuffled order."""
    return position % shards, (position - position % shards) / shards


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, row_no, position, shard, slot of every row.

    The law is ``rows``: shards differ by one row at most. Rows get a global number by (hash bucket, doc_id, size,
    checksum); the permutation of the number is the position in the shuffled order, and shard and slot are its rest and
    quotient by the number of shards, so that any reader can compute where a row is, and which row is where.

    A null text has size 8 and the checksum of the empty text; a null doc_id is a value like any other; rows equal in
    doc_id, size and checksum are interchangeable and each gets its own slot; an empty table gives no rows; further
    columns are ignored.
    """
    rows = docs.select(
        F.col("doc_id"), (F.octet_length(text_of(docs)) + PER_DOCUMENT).cast("long").alias("size"),
        F.crc32(F.encode(text_of(docs), "UTF-8")).alias("text_crc32"),
    )
    n = docs.count()
    order = Feistel(n, seed)

    @F.pandas_udf("long")
    def position(row: pd.Series) -> pd.Series:
        return pd.Series(order.position(row.to_numpy()))

    placed = number_rows(rows, ["doc_id", "size", "text_crc32"], rows=n).withColumn("position", position("row_no"))
    shard, slot = shard_of(F.col("position"), shards)
    return placed.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")})


def write_shards(docs: DataFrame, placed: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents in a folder per shard, each file ordered by slot; ``placed`` as ``shard_documents`` gives it for them.

    Rows meet their places by their global number, which is found again, so rows without a doc_id and rows that repeat one
    each take their own slot. Columns named shard and slot are replaced.
    """
    rows = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"), docs["doc_id"].alias("doc_id"),
        (F.octet_length(text_of(docs)) + PER_DOCUMENT).cast("long").alias("size"),
        F.crc32(F.encode(text_of(docs), "UTF-8")).alias("text_crc32"))
    at = placed.select("row_no", "shard", "slot")
    whole = number_rows(rows, ["doc_id", "size", "text_crc32"]).select("row_no", "doc").join(at, "row_no")
    kept = [F.col("doc")[c].alias(c) for c in docs.columns if c not in ("shard", "slot")]
    whole = whole.select(*kept, "shard", "slot").repartitionByRange(shards * 4, "shard", "slot")
    whole.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
