"""Words of whole batches of texts as integer arrays (numpy, inside Arrow maps)."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline.session import lean

#: The six white-space bytes at which bytes.split() cuts are exactly \x20 and \x09-\x0D.
#: bytes.lower() changes A-Z alone.


class _Memo(dict):
    """word -> 64-bit hash; filled up to a limit, so memory stays bounded."""

    LIMIT = 50_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.LIMIT:
            self[word] = value
        return value


MEMO = _Memo()


def give_back() -> None:
    """What a task has freed goes back to the system: Spark keeps idle Python workers, and they keep their peaks."""
    MEMO.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # not glibc


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(f) over small batches, in workers that keep no memory between tasks."""
    lean(df.sparkSession)

    def run(batches):
        yield from f(batches)
        give_back()

    return df.mapInArrow(run, schema)


def raw(text_col: str) -> Column:
    """A text as UTF-8 bytes, null as empty: what these functions take."""
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


def sampled_texts(docs: DataFrame, most: int, seed: int, text_col: str = "text") -> DataFrame:
    """(t, h): about `most` distinct texts, those of smallest hash h; null counts as empty.

    How often a text occurs changes nothing: distinct hashes are counted by a sketch, and a hash
    bound that some twice `most` distinct texts meet keeps the sort small in every partition."""
    hashed = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t", F.lit(seed)))
    share = min(1.0, 2 * most / max(1, hashed.agg(F.approx_count_distinct("h", 0.02)).first()[0]))
    return hashed.where(F.col("h") <= int(-(2**63) + share * (2**64 - 2**12))).distinct().orderBy("h", "t").limit(most)


def texts_of(column: pa.Array):
    """Bytes of each value without a Python list of them all."""
    for value in column:
        yield value.as_py() or b""


def word_hashes(texts, table: bytes | None = None, most: int = 250_000):
    """Yield (first text, counts, hashes) for runs of texts with about `most` bytes each.

    table: bytes.translate table that replaces plain lower-casing.
    """
    words: list[bytes] = []
    counts: list[int] = []
    first = size = 0
    for i, text in enumerate(texts):
        own = (text.translate(table) if table else text.lower()).split()
        words += own
        counts.append(len(own))
        size += len(text)
        if size >= most:
            yield first, np.array(counts, np.int64), np.fromiter(map(MEMO.__getitem__, words), np.uint64, len(words))
            first, size, words, counts = i + 1, 0, [], []
    if counts:
        yield first, np.array(counts, np.int64), np.fromiter(map(MEMO.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer, in place."""
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h
