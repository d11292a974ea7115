"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import scratch_path

#: A word: a run of characters other than space, tab, \n, \v, \f and \r.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared scratch folder and read it back: cuts
    lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BITS = 1 << 15             # of one row's bitmap


def among(rows: DataFrame, key: str, ids: DataFrame, most: int = 1 << 28) -> DataFrame:
    """``rows`` without most of those whose ``key`` (not null) is not in the
    one column of ``ids``; all others stay.  A bitmap of hashed ids, 16 bits
    each and ``most`` (32 MB) in all, is broadcast, so ``rows`` never move;
    past that size fewer rows leave."""
    one = ids.columns[0]
    slots = max(BITS, min(most, 1 << (16 * ids.count()).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(F.col(c)), F.lit(slots)) + 1
    bits = ids.select(place(one).alias("p")) \
        .groupBy(F.bitmap_bucket_number("p").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("__bits"))
    byte = "cast(conv(hex(substring(__bits, cast(__at div 8 as int) + 1, 1)), 16, 10) as int)"
    there = rows.withColumn("__p", place(key)).withColumn("__bucket", F.bitmap_bucket_number("__p")).withColumn("__at", F.bitmap_bit_position("__p"))
    there = there.join(F.broadcast(bits), "__bucket").filter(F.expr(f"shiftright({byte}, cast(__at % 8 as int)) & 1 = 1"))
    return there.select(*rows.columns)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Arrow batches of at most ``rows`` rows, since texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


# ---------------------------------------------------------------- hashing

_MULT = np.uint64(0x9E3779B97F4A7C15)      # odd, so invertible mod 2^64
_STEP = np.uint64(0xD6E8FEB86659FD93)
_PIECE = 1 << 20


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class WordHasher:
    """64-bit hashes of the words of a text, computed over all its bytes at
    once: a word's hash is sum(T[byte] * M^i), read off a running sum, so no
    Python code runs per word.  Long texts are hashed in pieces cut at white
    space, which bounds memory at about 40 bytes per byte of a piece.
    """

    def __init__(self, lower: bool = False):
        rng = np.random.default_rng(20)
        self.code = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if lower:
            self.code[65:91] = self.code[97:123]
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            inv = np.uint64(pow(int(_MULT), -1, 2**64))
            n = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _MULT))])
                self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, inv))])

    def _piece(self, raw: bytes) -> np.ndarray:
        a = np.frombuffer(raw, np.uint8)
        gap = np.concatenate([[True], self.space[a], [True]])
        edge = np.flatnonzero(gap[1:] != gap[:-1])
        start, end = edge[0::2], edge[1::2]
        self._powers(len(a) + 1)
        run = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(self.code[a] * self.up[:len(a)], out=run[1:])
        h = (run[end] - run[start]) * self.down[start]
        return _mix(h + (end - start).astype(np.uint64) * _STEP)

    def words(self, text: str | None) -> np.ndarray:
        raw = (text or "").encode("utf-8", "surrogatepass")
        if len(raw) <= _PIECE:
            return self._piece(raw)
        out, at = [], 0
        while at < len(raw):
            to = at + _PIECE
            while to < len(raw) and not self.space[raw[to]]:
                to += 1
            out.append(self._piece(raw[at:to]))
            at = to
        return np.concatenate(out)


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k consecutive words, by start position."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = out * _MULT + h[j:j + n]
    return _mix(out)
