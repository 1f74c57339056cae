"""Benchmark decontamination by the q-gram lemma.

An item of m bytes has m // q q-grams that do not overlap. An occurrence with at most
k edits holds at least m // q - k of them, all on diagonals within k of its own.
Shared q-grams are counted in diagonal bands of width 2*(2k+1) that overlap by half, so
one band holds every occurrence whole; bands that reach the bound are
aligned with the item in a band of the same diagonals, and regions within the
edit budget are reported.

Documents and items are compared lower-cased, runs of white space as one space.
The benchmark goes to the executors in parts of at most PART_BYTES of text, as broadcast
arrays of some 3 bytes for each byte of text. Documents are read in one narrow pass for
each part, never shuffled, and searched in pieces, so that memory does not grow with
a text or with how often it repeats itself.
"""

from __future__ import annotations

import math
import re
from bisect import bisect
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.llm.words import arrow_map, raw, texts_of
from pressline.session import stored

Q = 10
#: Edits allowed for each byte of an item.
EDIT_RATE = 0.07
#: Most bytes of benchmark text sent to the executors at once; a longer item is a part of its own.
PART_BYTES = 16_000_000
BLOOM_BITS = 22
#: Bytes of a text whose q-grams are looked up at once, and shared q-grams that are counted at once.
PIECE, HITS = 262_144, 1_000_000


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


def qgram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the q-gram that starts at each byte."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    one = data.astype(np.uint64)
    two = (one[:-1] << np.uint64(8)) | one[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    eight = (four[:-4] << np.uint64(32)) | four[4:]
    return (eight[: len(data) - Q + 1] * np.uint64(0x9E3779B97F4A7C15)) ^ ((two[8:] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))


_WORD = np.array([chr(c).isalnum() and c < 128 or c == 95 or c >= 128 for c in range(256)])


#: Stands for a null id among the ids of short items.
NO_ID = -(1 << 63)
#: What an item takes besides its bytes, on the driver and in what is sent.
ITEM_BYTES = 48


class Index:
    """Every Q-th q-gram of some items, sorted, with the place where it occurs; items under Q bytes as they are."""

    def __init__(self, items: list[tuple[int, bytes]]):
        """items: (id, normalised text), none empty"""
        # items under Q bytes by length: sorted, with their ids
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n in {len(t) for _, t in items if len(t) < Q}:
            own = sorted((t, NO_ID if i is None else i) for i, t in items if len(t) == n)
            self.short[n] = np.array([t for t, _ in own], f"S{n}"), np.array([i for _, i in own], np.int64)
        items = [(i, t) for i, t in items if len(t) >= Q]
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        hashes = [qgram_hashes(np.frombuffer(t, np.uint8))[::Q] for t in self.texts]
        sizes = np.array([len(h) for h in hashes], np.int64)
        every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.grams = every[order]
        self.item = np.repeat(np.arange(len(items), dtype=np.int32), sizes)[order]
        self.offset = ((np.arange(len(every)) - np.repeat(np.cumsum(sizes) - sizes, sizes)) * Q)[order].astype(np.int32)
        self.length = np.array([len(t) for t in self.texts], np.int64)
        # as many edits as leave a q-gram whole: none under 20 bytes, one under 30, from there on the rate is less
        self.edits = np.minimum(np.floor(self.length * EDIT_RATE), self.length // Q - 1).astype(np.int64)
        self.bound = self.length // Q - self.edits
        self.width = 2 * self.edits + 1
        self.bloom = np.zeros(1 << BLOOM_BITS, bool)
        self.bloom[self.grams >> np.uint64(64 - BLOOM_BITS)] = True

    def nbytes(self) -> int:
        """Of the arrays and texts that are sent."""
        return sum(a.nbytes for a in (self.grams, self.item, self.offset, self.length, self.edits, self.bound, self.width, self.bloom, *(a for pair in self.short.values() for a in pair))) + sum(map(len, self.texts))

    def hits(self, text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(position, item, offset) of every shared q-gram, some HITS at a time."""
        for start in range(0, max(1, len(text) - Q + 1), PIECE):
            h = qgram_hashes(np.frombuffer(text[start : start + PIECE + Q - 1], np.uint8))
            at = np.flatnonzero(self.bloom[h >> np.uint64(64 - BLOOM_BITS)])
            if not len(at):
                continue
            first, last = np.searchsorted(self.grams, h[at]), np.searchsorted(self.grams, h[at], "right")
            true = last > first
            at, first, n = at[true] + start, first[true], (last - first)[true]
            ends = np.cumsum(n)
            cuts = [0, *np.searchsorted(ends, np.arange(HITS, int(ends[-1]) if len(ends) else 0, HITS)).tolist(), len(n)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                own = n[a:b]
                flat = np.repeat(first[a:b] - (np.cumsum(own) - own), own) + np.arange(own.sum())
                yield np.repeat(at[a:b], own), self.item[flat].astype(np.int64), self.offset[flat]

    def bands(self, text: bytes) -> list[tuple[int, int]]:
        """(item, band) whose count of shared q-grams reaches the lemma's bound."""
        keys, counts = [], []
        for at, item, offset in self.hits(text):
            # diagonals start at -length; a hit lies in band b and b - 1 of width 2w
            shift = (at - offset + self.length[item]) // self.width[item]
            key = (item << 40) | (shift + 1)
            key, n = np.unique(np.concatenate([key, key - 1]), return_counts=True)
            keys.append(key)
            counts.append(n)
        if not keys:
            return []
        key, own = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(own, np.concatenate(counts))
        item = key >> 40
        full = n >= self.bound[item]
        return [(int(i), int(b) - 1) for i, b in zip(item[full], key[full] & ((1 << 40) - 1), strict=True)]

    def aligned(self, text: bytes) -> Iterator[tuple[int, tuple[int, int, int]]]:
        """(item, (edits, start, end)) of each band that holds the item."""
        for item, band in self.bands(text):
            w, m = int(self.width[item]), int(self.length[item])
            low = band * w - m
            found = align(self.texts[item], text, low, low + 2 * w - 1, int(self.edits[item]))
            # without edits an item is short: it counts only as whole words
            if found and (w > 1 or on_borders(text, *found[:2])):
                yield item, (found[2], *found[:2])

    def whole_words(self, text: bytes) -> Iterator[tuple[int, int, int]]:
        """(item id, start, end) of the items under Q bytes, where no word goes on over their ends."""
        if not self.short or not text:
            return
        word = _WORD[np.frombuffer(text, np.uint8)]
        inside = word[1:] & word[:-1]
        begins, ends = np.append(True, ~inside), np.append(~inside, True)
        for n, (items, ids) in self.short.items():
            if n > len(text):
                continue
            every = np.flatnonzero(begins[: len(text) - n + 1] & ends[n - 1 :])
            windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(text, np.uint8), n)
            for k in range(0, len(every), PIECE):
                places = every[k : k + PIECE]
                words = np.ascontiguousarray(windows[places]).view(f"S{n}").ravel()
                at = np.minimum(np.searchsorted(items, words), len(items) - 1)
                for i, start in zip(ids[at[hit := items[at] == words]].tolist(), places[hit].tolist(), strict=True):
                    yield None if i == NO_ID else i, start, start + n

    def search(self, text: bytes) -> list[tuple[int, int, int, int]]:
        """(item id, start, end, edits) of every region of each item in the normalised text.

        Of regions that overlap by more bytes than they have edits, the best counts."""
        regions: dict[int, set[tuple[int, int, int]]] = {}
        for item, region in self.aligned(text):
            if item not in regions:
                # one band gives one region, so runs of a repeated item are taken apart here
                regions[item] = {(0, at.start(), at.end()) for at in re.finditer(re.escape(self.texts[item]), text)} if self.width[item] > 1 else set()
            regions[item].add(region)
        found = [(self.ids[i], *r) for i, every in sorted(regions.items()) for r in apart(every)]
        small: dict[int, set[tuple[int, int, int]]] = {}
        for i, start, end in self.whole_words(text):
            small.setdefault(i, set()).add((0, start, end))
        return found + [(i, *r) for i, every in small.items() for r in apart(every)]

    def leaks(self, text: bytes) -> bool:
        return next(self.aligned(text), None) is not None or next(self.whole_words(text), None) is not None


def apart(regions) -> list[tuple[int, int, int]]:
    """(start, end, edits) by start. regions (edits, start, end) are taken best first, if they share
    no more bytes with those taken before than they have edits."""
    kept: list[tuple[int, int, int]] = []
    for edits, start, end in sorted(regions):
        at = bisect(kept, (start, end, edits))
        if (not at or kept[at - 1][1] - start <= edits) and (at == len(kept) or end - kept[at][0] <= edits):
            kept.insert(at, (start, end, edits))
    return kept


WORD = re.compile(rb"[0-9a-z_\x80-\xff]")


def on_borders(text: bytes, start: int, end: int) -> bool:
    """No word of text goes on over the start or the end of the region."""
    inner = [bool(WORD.match(text, i)) for i in (start, end - 1)]
    return not (inner[0] and start and WORD.match(text, start - 1)) and not (inner[1] and WORD.match(text, end))


def align(item: bytes, text: bytes, low: int, high: int, most: int):
    """(start, end, edits) of item in text on diagonals low..high, or None beyond `most` edits.

    Banded edit distance, free ends in the text. Cell x of a row is diagonal low + x.
    """
    exact = text.find(item, max(0, low), max(0, high + len(item)))
    if exact >= 0:
        return exact, exact + len(item), 0
    if not most:
        return None
    width, far = high - low + 1, most + 1
    padded = np.full(len(item) + width + 1, 256, np.int16)
    begin, end = max(0, low), min(len(text), high + len(item) + 1)
    if begin >= end:
        return None
    padded[begin - low : end - low] = np.frombuffer(text[begin:end], np.uint8)
    diagonal = np.arange(low, high + 1)
    inside = (diagonal >= 0) & (diagonal <= len(text))
    cost = np.where(inside, 0, far).astype(np.int64)
    start = diagonal.copy()
    steps = np.arange(width)
    for i, byte in enumerate(item):
        # substitution or match keeps the diagonal; a deleted item byte comes from the diagonal to the right
        down = cost + (padded[i : i + width] != byte)
        skip = np.append(cost[1:], far) + 1
        take = skip < down
        new = np.where(take, skip, down)
        src = np.where(take, np.append(start[1:], 0), start)
        # an inserted text byte comes from the left: running minimum of cost - position
        key = (new - steps) * (width + 1) + steps
        best = np.minimum.accumulate(key)
        pos = best % (width + 1)
        cost = np.minimum(new[pos] + steps - pos, far)
        start = src[pos]
        if cost.min() >= far:
            return None
    x = int(np.argmin(cost))
    if cost[x] > most:
        return None
    return int(start[x]), min(len(text), int(diagonal[x]) + len(item)), int(cost[x])


def _parts(benchmark: DataFrame, id_col: str, text_col: str, least: int = 1) -> Iterator:
    """Broadcast Index of each part of at most about PART_BYTES, ITEM_BYTES an item included; duplicates of a text once, smallest id."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), raw(text_col).alias("data")).groupBy("data").agg(F.min("item_id").alias("item_id"))
    total = items.agg(F.sum(F.octet_length("data") + ITEM_BYTES)).first()[0] or 0
    n = max(1, math.ceil(total / PART_BYTES))
    for part in range(n):
        # one part at a time is on the driver
        rows = items.where(F.pmod(F.xxhash64("data"), F.lit(n)) == part).collect()
        named: dict[bytes, int | None] = {}
        for r in sorted(rows, key=lambda r: (r.item_id is None, r.item_id or 0)):
            if len(t := normal(bytes(r.data))) >= least:
                named.setdefault(t, r.item_id)
        index = Index([(i, t) for t, i in named.items()])
        limit = 4 * PART_BYTES + 4 * max(map(len, index.texts), default=0) + (1 << BLOOM_BITS) + 32 * len(index.texts)
        if index.nbytes() > limit:
            raise ValueError(f"a part of the benchmark takes {index.nbytes()} bytes; {limit} were expected at most")
        yield spark.sparkContext.broadcast(index)


def unsearched(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id of the items that hold nothing to search for: null, empty or white space."""
    blank = F.coalesce(F.regexp_replace(F.col(text_col), r"[\x20\x09-\x0D]+", ""), F.lit("")) == ""
    return benchmark.where(blank).select(F.col(id_col).cast("long").alias("item_id"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each region of an item in a document: doc_id, item_id, start, end, edits.

    start and end are bytes of the normalised text. Regions of one item overlap
    by no more bytes than they have edits, where the border of two is open.
    Items under 2 * Q bytes are found as they are, as whole words; blank ones never,
    see unsearched(). Empty and null texts, empty tables and an empty benchmark hold nothing;
    rows that repeat an id are searched each, a null id is reported as it is; items equal
    after normalising count under their smallest id. A text of any length is searched whole.
    Columns beside the named ones are not looked at, so clashing names do no harm.
    """
    kind = dict(docs.dtypes)[id_col]
    base = docs.select(F.col(id_col).alias("doc_id"), raw(text_col).alias("data"))

    def found_in(part) -> DataFrame:
        def searched(batches):
            for batch in batches:
                rows, found = [], []
                for i, text in enumerate(texts_of(batch.column(1))):
                    for hit in part.value.search(normal(text)):
                        rows.append(i)
                        found.append(hit)
                columns = [pa.array([f[k] for f in found], t) for k, t in ((0, pa.int64()), (1, pa.int64()), (2, pa.int64()), (3, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *columns], ["doc_id", "item_id", "start", "end", "edits"])

        return arrow_map(base, searched, f"doc_id {kind}, item_id long, start long, end long, edits int")

    return reduce(DataFrame.unionByName, map(found_in, _parts(benchmark, item_col, item_text_col)))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", least: int = Q) -> DataFrame:
    """docs without the rows that hold a benchmark item within its edit budget; narrow passes, no join.

    Items under `least` bytes don't decide: an answer of one word is in most texts. Columns and
    the other rows stay as they are, null and empty texts among them. Of a benchmark in several
    parts each but the first starts from a stored table, so a worker holds one part at a time.
    """
    place = docs.columns.index(text_col)

    def without(docs: DataFrame, part) -> DataFrame:
        def clean(batches):
            for batch in batches:
                texts = ((v.as_py() or "").encode() for v in batch.column(place))
                yield batch.filter(pa.array([not part.value.leaks(normal(t)) for t in texts], pa.bool_()))

        return arrow_map(docs, clean, docs.schema)

    for k, part in enumerate(_parts(benchmark, "item_id", "text", least)):
        docs = without(stored(docs, "left") if k else docs, part)
    return docs
