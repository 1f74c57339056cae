"""Repeated 100-byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered only as deep as the threshold, most significant digits
first; after the last digit, equal groups are exactly the repeated windows. A
group of one leaves at once, so each pass moves only what may still repeat.

Pass 1 takes a digit of GRAM bytes. It is not the window's first GRAM bytes but its
smallest GRAM-gram by hash (leftmost on ties): equal windows have it
at the same place, and neighbouring windows share it, so a run of windows [lo, hi]
around one anchor is one record, a thirty-seventh of the positions. Pass 2 refines the
runs that are left to at least 90 common bytes, pass 3 to all 100.

In each pass a run whose whole context is equal to an earlier one's is settled:
all its windows repeat. Only the first of equal contexts goes on, and only if its
digit is shared with another context. So copies, however many, cost one
record each and leave after one map-side combined aggregation.

Which digits repeat travels between passes as a bitmap of bounded size;
a set bit without a repeat costs time, never correctness. Contexts and windows are
compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressline.llm.bitmaps import bitmap, bits_for
from pressline.llm.words import arrow_map, mixed, raw, texts_of
from pressline.session import discard, release, stored

DEPTH, GRAM = 100, 28
#: Widest run of offsets in pass 2.
BIN = 10
#: Bytes that are hashed at once; a position must fit in 18 bits.
RUN, PIECE = 100_000, 131_072
#: Removed spans (16 bytes each) are broadcast up to this many, else joined by shuffle.
MAX_BROADCAST = 2_000_000

_SIZE = 1 << 18
_PLACE = np.uint64(_SIZE - 1)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers and inverse powers of both bases modulo 2**64."""
    if not _POWERS:
        for base in _BASES:
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(_SIZE + 1, b, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
            _POWERS.append((both[0], both[1]))
    return _POWERS


class Runs:
    """The runs of windows in a buffer of whole documents, or of a piece of a long one."""

    def __init__(self, texts: list[bytes], at: list[int]):
        """at: where in its document each text starts."""
        self.at = np.array(at, np.int64)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
        self.sums = []
        for power, _ in _powers():
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(data * power[: len(data)], out=total[1:])
            self.sums.append(total)
        empty = np.zeros(0, np.int64)
        self.lo, self.hi, self.anchor = empty, empty, empty
        if len(data) < DEPTH:
            return
        every = np.arange(len(data) - GRAM + 1)
        key = (self.hashed(0, every, every + GRAM) & ~_PLACE) | every.astype(np.uint64)
        width, need = 1, DEPTH - GRAM + 1
        while width * 2 <= need:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < need:
            key = np.minimum(key[: len(key) - (need - width)], key[need - width :])
        valid = np.ones(len(key), bool)
        for start, end in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            valid[max(start, end - DEPTH + 1) : end] = False
        window = np.flatnonzero(valid)
        if not len(window):
            return
        anchor = (key[window] & _PLACE).astype(np.int64)
        new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1] + 1)) + 1
        self.lo = window[np.concatenate(([0], new))]
        self.hi = window[np.concatenate((new - 1, [len(window) - 1]))]
        self.anchor = anchor[np.concatenate(([0], new))]

    def hashed(self, which: int, start: np.ndarray, end: np.ndarray, salt=0) -> np.ndarray:
        """Hash of the bytes start..end of each entry."""
        total, inverse = self.sums[which], _powers()[which][1]
        h = (total[end] - total[start]) * inverse[start]
        if not np.isscalar(salt):
            h ^= salt.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
        return mixed(h)

    def place(self, lo: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the text, offset in its document)"""
        text = np.searchsorted(self.ends, lo, "right")
        return text, lo - self.starts[text] + self.at[text]

    def keep(self, mask: np.ndarray) -> None:
        self.lo, self.hi, self.anchor = self.lo[mask], self.hi[mask], self.anchor[mask]

    def split(self, width: int) -> None:
        """Cut the runs at multiples of width of the offset anchor - window."""
        low, high = (self.anchor - self.hi) // width, (self.anchor - self.lo) // width
        n = high - low + 1
        of = np.repeat(np.arange(len(n)), n)
        bin_ = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        anchor, lo, hi = self.anchor[of], self.lo[of], self.hi[of]
        self.lo, self.hi, self.anchor = np.maximum(lo, anchor - bin_ * width - width + 1), np.minimum(hi, anchor - bin_ * width), anchor

    def digit(self, width: int | None) -> np.ndarray:
        """Hash of the bytes that all windows of the run's bin share."""
        if width is None:
            return self.hashed(0, self.anchor, self.anchor + GRAM)
        bin_ = (self.anchor - self.lo) // width
        first, last = self.anchor - bin_ * width, self.anchor - bin_ * width - width + 1
        return self.hashed(0, first, last + DEPTH, bin_ + 1000)

    def context(self) -> np.ndarray:
        """Hash of all bytes of the run's windows and where the anchor lies in them."""
        return self.hashed(1, self.lo, self.hi + DEPTH, (self.anchor - self.lo) * 256 + (self.hi - self.lo) + 1)


def runs_of(column: pa.Array):
    """Yield (Runs, row of each text) over a column of texts."""
    texts, rows, size = [], [], 0
    for row, text in enumerate(texts_of(column)):
        if len(text) > PIECE:
            for start in range(0, len(text) - DEPTH + 1, PIECE):
                yield Runs([text[start : start + PIECE + DEPTH - 1]], [start]), [row]
            continue
        texts.append(text)
        rows.append(row)
        size += len(text)
        if size >= RUN:
            yield Runs(texts, [0] * len(texts)), rows
            texts, rows, size = [], [], 0
    if texts:
        yield Runs(texts, [0] * len(texts)), rows


def _spots(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hash of a place, to pick its run again in the next pass."""
    return mixed(ids.astype(np.uint64) * np.uint64(_BASES[0]) ^ (at.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASES[1]))


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False)


def repeated_windows(base: DataFrame, total_bytes: int) -> list[DataFrame]:
    """Stored tables (id, lo, hi) of all window starts lo..hi whose 100 bytes start earlier too. base: id long, data."""
    spark = base.sparkSession
    # about a run for each 37 bytes, and half of them at most repeat
    bits = bits_for(total_bytes / 128)
    picks: list[tuple] = []
    found = []
    for width in (None, BIN, 1):
        # every pass replays the choices of the passes before on the same texts
        chosen = list(picks)

        def narrowed(batch, width=width, chosen=chosen):
            ids = _ids(batch)
            for runs, rows in runs_of(batch.column(1)):
                own = ids[np.array(rows)]
                for step, picked in chosen:
                    if step is not None:
                        runs.split(step)
                    text, at = runs.place(runs.lo)
                    runs.keep(picked.has(_spots(own[text], at)))
                if width is not None:
                    runs.split(width)
                yield runs, own

        repeats = None
        if width != 1:

            def digits(batches, narrowed=narrowed, width=width):
                for batch in batches:
                    for runs, _ in narrowed(batch):
                        yield pa.RecordBatch.from_arrays([pa.array(runs.digit(width).view(np.int64))], ["digit"])

            seen = arrow_map(base, digits, "digit long").groupBy("digit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            repeats = bitmap(seen, "digit", bits)
            release(spark)

        def records(batches, narrowed=narrowed, width=width, repeats=repeats):
            for batch in batches:
                for runs, own in narrowed(batch):
                    if repeats is not None:
                        runs.keep(repeats.has(runs.digit(width)))
                    text, at = runs.place(runs.lo)
                    columns = (runs.digit(width).view(np.int64), runs.context().view(np.int64), own[text], at)
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns), pa.array(runs.hi - runs.lo, pa.int32())], ["digit", "context", "id", "lo", "more"])

        # a digit and a context are hashes by different bases, so the pair is a 128-bit key
        rows = stored(arrow_map(base, records, "digit long, context long, id long, lo long, more int"), "records")
        if repeats is not None:
            repeats.destroy()
        release(spark)
        contexts = rows.groupBy("digit", "context").agg(F.min(F.struct("id", "lo")).alias("first"), F.count(F.lit(1)).alias("n"))
        contexts = stored(contexts.select("digit", "context", "first.*", "n"), "contexts")
        release(spark)
        copied = contexts.where("n > 1").select("digit", "context", F.col("id").alias("first_id"), F.col("lo").alias("first_lo"))
        again = rows.join(copied, ["digit", "context"]).where("id <> first_id or lo <> first_lo").select("id", "lo", (F.col("lo") + F.col("more")).alias("hi"))
        found.append(stored(again, "again"))
        discard(rows)
        release(spark)
        if width != 1:

            def spots(batches):
                for batch in batches:
                    ids, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                    yield pa.RecordBatch.from_arrays([pa.array(_spots(ids, at).view(np.int64))], ["spot"])

            shared = contexts.groupBy("digit").agg(F.count(F.lit(1)).alias("contexts")).where("contexts > 1").select("digit")
            picks.append((width, bitmap(arrow_map(contexts.join(shared, "digit").select("id", "lo"), spots, "spot long"), "spot", bits)))
            release(spark)
        discard(contexts)
    for _, picked in picks:
        picked.destroy()
    return found


def removed_spans(windows: DataFrame) -> DataFrame:
    """(id, start, end): the maximal runs of bytes that the windows cover, end exclusive."""
    line = Window.partitionBy("id").orderBy("lo", "hi")
    w = windows.withColumn("before", F.max(F.col("hi") + DEPTH).over(line.rowsBetween(Window.unboundedPreceding, -1)))
    w = w.withColumn("island", F.sum(F.when(F.col("lo") <= F.col("before"), 0).otherwise(1)).over(line.rowsBetween(Window.unboundedPreceding, 0)))
    return w.groupBy("id", "island").agg(F.min("lo").alias("start"), (F.max("hi") + DEPTH).alias("end")).drop("island")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text: also `kept` bytes.

    Every byte is removed that a string of DEPTH bytes covers which also starts
    earlier: in a row of smaller id, or earlier in the same row. A null text is
    empty; texts under DEPTH bytes lose nothing. Where ids are repeated, null or
    not integers, rows are ordered by (id, text), nulls last, and of rows
    equal in both one comes first. An empty table gives no rows; texts of any length are
    searched whole, in pieces that overlap. Only the two named columns are read, so other
    columns may have any name.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), raw(text_col).alias("data"))
    whole = base.agg(F.count(F.lit(1)).alias("rows"), F.count("doc_id").alias("ids"), F.coalesce(F.sum(F.octet_length("data")), F.lit(0)).alias("bytes")).first()
    simple = dict(base.dtypes)["doc_id"] in ("bigint", "int") and whole.ids == whole.rows and base.groupBy("doc_id").count().where("count > 1").isEmpty()
    if simple:
        base = base.select(F.col("doc_id").cast("long").alias("id"), "data", "doc_id")
    else:
        order = (F.col("doc_id").asc_nulls_last(), F.col("data"))
        base = stored(base.repartitionByRange(*order).sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias("id"), "data", "doc_id"), "numbered")
    windows = repeated_windows(base.select("id", "data"), whole.bytes)
    spans = stored(removed_spans(reduce(DataFrame.unionByName, windows)), "spans")
    discard(*windows)
    release(docs.sparkSession)
    n = spans.count()
    per = spans.groupBy(F.col("id").alias("of")).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    joined = base.join(F.broadcast(per) if n <= MAX_BROADCAST else per, F.col("id") == F.col("of"), "left").select("doc_id", "data", "spans")
    kind = dict(base.dtypes)["doc_id"]

    def cut(batches):
        for batch in batches:
            sizes, removed, counts, digests, texts = [], [], [], [], []
            for text, spans in zip(texts_of(batch.column(1)), batch.column(2), strict=True):
                spans = [(s["start"], s["end"]) for s in spans.as_py() or ()]
                parts, at = [], 0
                for start, end in spans:
                    parts.append(text[at:start])
                    at = end
                kept = b"".join([*parts, text[at:]])
                sizes.append(len(text))
                removed.append(len(text) - len(kept))
                counts.append(len(spans))
                digests.append(hashlib.sha256(kept).hexdigest())
                texts.append(kept)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.binary())] if with_text else columns, [*names, "kept"] if with_text else names)

    return arrow_map(joined, cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else ""))
