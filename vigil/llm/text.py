"""Words, shingles and scratch tables shared by the operators."""

from __future__ import annotations

import ctypes
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.session import ensure_checkpoint_dir

#: the white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return
WS = r"[\x20\x09-\x0D]+"
_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so multiplication mod 2**64 is a bijection
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def words_of(text: Column) -> Column:
    """Array of the maximal runs without white space; null text gives an empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WS))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: lineage ends here and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Returns memory that Arrow and the C library keep for later to the system: workers share their executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's own
    if trim:
        trim(0)


class WordHashes(dict):
    """64-bit hash per word, remembered up to ``limit`` different words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser over uint64: spreads every input bit over the result."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)  # masks of the first k bytes
LONG_WORD = 64


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hash of each word of a text, eight bytes of all words at a time; words over ``LONG_WORD`` bytes one by one."""
    space = np.concatenate(([True], _SPACE[np.frombuffer(raw, dtype=np.uint8)], [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(raw) + 1, dtype="<u8", buffer=raw + b"\0" * 8, strides=(1,))
    out = mix(size.astype(np.uint64) * _MULT)
    live = np.arange(len(size))
    for j in range(0, min(int(size.max(initial=0)), LONG_WORD), 8):
        live = live[size[live] > j]
        out[live] = mix((out[live] ^ (eight[start[live] + j] & _LOW_BYTES[np.minimum(size[live] - j, 8)])) + _MULT)
    for k in np.flatnonzero(size > LONG_WORD):
        out[k] = xxhash.xxh3_64_intdigest(raw[start[k]: start[k] + size[k]])
    return out


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; with fewer words, of the whole run; without words, none."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    acc = words[: n - k + 1].copy()
    for j in range(1, k):
        acc = acc * _MULT + words[j: n - k + 1 + j]
    return mix(acc + np.uint64(k))
