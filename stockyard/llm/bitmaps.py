"""Bit maps of hashes, of a fixed size however many hashes there are."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A bit map has 2 to this power bits, 16 MB.
MAP_BITS = 27
#: Numbers of 64 bits of a bit map that travel together.
_MAP_BLOCK = 1 << 13
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits, each bit of which depends on all of the one given."""
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    x = (x ^ (x >> np.uint64(32))) * _FOLD
    return x ^ (x >> np.uint64(32))


class BitMap:
    """Which hashes may be in a set."""

    def __init__(self, words: np.ndarray):
        self.words, self.bits = words, 6 + int(len(words)).bit_length() - 1

    def __contains__(self, value: int) -> bool:
        at = value & ((1 << self.bits) - 1)
        return bool(int(self.words[at >> 6]) >> (at & 63) & 1)

    def holds(self, values: np.ndarray) -> np.ndarray:
        at = values & np.uint64((1 << self.bits) - 1)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def bit_map(hashes: DataFrame, column: str, bits: int = MAP_BITS) -> BitMap:
    """Bit map of a column of hashes; its ``2 ** (bits - 3)`` bytes reach the driver in blocks, however many hashes there are."""
    size = min(_MAP_BLOCK, 1 << (bits - 6))

    def packed(rows: pa.Table) -> pa.Table:
        words = np.zeros(size, np.uint64)
        words[rows.column("word").to_numpy() % size] = rows.column("set").to_numpy().view(np.uint64)
        return pa.table({"block": [rows.column("block")[0].as_py()], "words": pa.array([words.tobytes()], pa.binary())})

    word = F.shiftright(F.col(column).bitwiseAND((1 << bits) - 1), 6)
    bit = F.expr(f"shiftleft(1L, cast(`{column}` & 63 AS int))")
    filled = hashes.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("set"))
    blocks = filled.withColumn("block", F.floor(F.col("word") / size)).groupBy("block").applyInArrow(packed, "block long, words binary")
    words = np.zeros(1 << (bits - 6), np.uint64)
    for r in blocks.collect():
        words[r.block * size:(r.block + 1) * size] = np.frombuffer(r.words, np.uint64)
    return BitMap(words)
