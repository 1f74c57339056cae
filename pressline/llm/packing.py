"""Best-fit packing of tokenized documents into sequences, planned on the histogram of lengths.

Documents are tokenized once, where they are read; what is kept of a piece is its
length and checksum. Best-fit decreasing then runs over the counts of the
histogram, at most `capacity` of them, so the plan does not grow with the data:
it says for each run of ranks within a length which sequences they go to. Pieces
get a rank within their length and meet the plan on (length, rank).

Ranks are counted on two levels (buckets of some RANK_ROWS rows, then inside a
bucket), so a length that a third of all pieces have is no sort of one task.
"""

from __future__ import annotations

import os
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from tokenizers import Tokenizer

from pressline.llm.words import arrow_map, raw, texts_of
from pressline.session import stored

CAPACITY = 2048
#: The id behind the last token of each document.
END_ID = 0
#: Rows of one length that are ranked in one sort group, on average.
RANK_ROWS = 10_000
#: Words whose ids a task keeps at most; beyond it starts anew.
MEMO_WORDS = 500_000
#: Bytes of text that are tokenized at once.
RUN_BYTES = 1_000_000
#: Ranks of one length stay below this, so that (length, rank) is one 64-bit key.
RANK_SPAN = 1 << 44


class _Ids:
    """Token ids of whole texts through a memo of words.

    Where the tokenizer drops white space, a text's ids are those of its words, one after the other;
    where it does not, a text counts as one word. Words of Latin-1 letters, with at most one
    stop or comma, go to the merges at once where the tokenizer lower-cases and cuts them that way.
    Both are asked of the tokenizer by PROBES.
    """

    LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
    PLAIN = re.compile(f"[{LETTERS}]+[.,]?")
    PROBES = ["word", "Word", "WORDS.", "some,", "x.", "antidisestablishmentarianism,", "\u00c9t\u00c9,", "".join(map(chr, [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))]

    def __init__(self, tokenizer: str):
        self.model = Tokenizer.from_str(tokenizer)
        # byte-level tokenizers write a byte that is no printable Latin-1 character as the next code point from 256 on
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(other)}
        coded = {w: self.model.encode(w, add_special_tokens=False).ids for w in self.PROBES}
        whole = "\n\t ".join(self.PROBES) + " \r" + " ".join(self.PROBES) + " "
        self.words = self.model.encode(whole, add_special_tokens=False).ids == [i for _ in range(2) for w in self.PROBES for i in coded[w]]
        self.plain = self.words and all(self.merged(w) == ids for w, ids in coded.items())
        self.clear()

    def merged(self, word: str) -> list[int]:
        """Ids of a plain word by the merges alone."""
        word = word.lower()
        parts = [word[:-1], word[-1]] if word[-1] in ".," else [word]
        if not word.isascii():
            parts = ["".join(map(self.letters.__getitem__, p.encode())) for p in parts]
        tokenize = self.model.model.tokenize
        return [t.id for part in parts for t in tokenize(part)]

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def cut(self, text: bytes) -> list[bytes]:
        return text.split() if self.words else [text]

    def learn(self, texts: list[bytes]) -> None:
        words = {w for t in texts for w in self.cut(t)}
        new = [w for w in words if w not in self.known]
        if not new:
            return
        if len(self.known) + len(new) > MEMO_WORDS:
            self.clear()
            new = list(words)
        texts_of_new = [w.decode("utf-8", "replace") for w in new]
        coded = [self.merged(w) if self.plain and self.PLAIN.fullmatch(w) else None for w in texts_of_new]
        rest = [i for i, ids in enumerate(coded) if ids is None]
        for i, e in zip(rest, self.model.encode_batch_fast([texts_of_new[i] for i in rest], add_special_tokens=False)):
            coded[i] = e.ids
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        flat = np.fromiter((i for ids in coded for i in ids), np.uint32, int(sizes.sum()))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.ids, self.sizes = np.concatenate([self.ids, flat]), np.concatenate([self.sizes, sizes])

    def of(self, text: bytes) -> np.ndarray:
        """The ids of one text whose words were learned."""
        words = self.cut(text)
        at = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        size = self.sizes[at]
        ends = np.cumsum(size)
        return self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - size), size)]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for each run of at most `capacity` ids of a document.

    tokenizer: path of a tokenizer file, read on the driver and sent as a broadcast of its size.
    A document's ids end with END_ID, so a null or empty text is one piece of one id.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text(encoding="utf-8"))
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    def cut(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        memo = _Ids(model.value)
        for batch in batches:
            rows: list[tuple[int, int, int, int, int]] = []
            for first, texts in _runs(batch.column(1)):
                memo.learn(texts)
                for i, text in enumerate(texts):
                    ids = np.append(memo.of(text), np.uint32(END_ID)).astype("<u4")
                    rows += [(first + i, a // capacity, a, min(capacity, len(ids) - a), zlib.crc32(ids[a : a + capacity])) for a in range(0, len(ids), capacity)]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(columns[0], pa.int64()))] + [pa.array(c, k) for c, k in zip(columns[1:], kinds)], names=schema.names)

    schema = StructType([StructField("doc_id", docs.schema[id_col].dataType), StructField("piece", IntegerType()), *(StructField(c, LongType()) for c in ("start", "length", "ids_crc32"))])
    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), raw(text_col).alias("text")), cut, schema)


def _runs(column: pa.Array):
    """(first row, texts) for runs of about RUN_BYTES."""
    texts: list[bytes] = []
    first = size = 0
    for i, text in enumerate(texts_of(column)):
        texts.append(text)
        size += len(text)
        if size >= RUN_BYTES:
            yield first, texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield first, texts


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Best-fit decreasing over counts of lengths: rows (length, first rank, first sequence, per sequence, offset).

    Ranks from `first rank` on, up to the next row of that length, go `per sequence` at a time to
    consecutive sequences, from `offset` on. Sequences of equal content are one group, so a step
    places a whole group. A length makes three groups at most and a group takes at most 63 different
    lengths, so there are at most 3 * capacity * 64 rows, whatever the counts.
    """
    open_groups: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by space left: (first sequence, sequences)
    rows, sequences = [], 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def fill(first: int, n: int, space: int) -> int:
            """Put what is left into n sequences from `first` on; how many of them got some."""
            nonlocal left, rank
            per = space // length
            full, rest = min(n, left // per), 0
            if full:
                rows.append((length, rank, first, per, capacity - space))
                open_groups[space - per * length].append((first, full))
                rank, left = rank + full * per, left - full * per
            if full < n and left:
                rest = left
                rows.append((length, rank, first + full, rest, capacity - space))
                open_groups[space - rest * length].append((first + full, 1))
                rank, left = rank + rest, 0
            return full + (rest > 0)

        for space in range(length, capacity + 1):
            groups, open_groups[space] = open_groups[space], []
            for first, n in groups:
                used = fill(first, n, space) if left else 0
                if used < n:
                    open_groups[space].append((first + used, n - used))
            if not left:
                break
        if left:
            sequences += fill(sequences, -(-left // (capacity // length)), capacity)
    return np.array(rows, np.int64).reshape(-1, 5)


def ranked(rows: DataFrame, group: str, order: str) -> DataFrame:
    """rows with `rank`, from 0 within each value of group, counted on two levels.

    order must be unique; group is never null.
    """
    counts = rows.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / RANK_ROWS).alias("buckets"))
    rows = rows.join(F.broadcast(counts), group).withColumn("bucket", F.pmod(F.xxhash64(order), F.col("buckets"))).drop("buckets")
    held = rows.groupBy(group, "bucket").agg(F.count(F.lit(1)).alias("held"))
    ahead = held.withColumn("ahead", F.sum("held").over(Window.partitionBy(group).orderBy("bucket")) - F.col("held")).drop("held")
    rows = rows.withColumn("within", F.row_number().over(Window.partitionBy(group, "bucket").orderBy(order)) - 1)
    return rows.join(ahead, [group, "bucket"]).withColumn("rank", F.col("ahead") + F.col("within")).drop("bucket", "ahead", "within")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset, beside the columns of pieces().

    Only documents longer than `capacity` are cut; all their pieces but the last fill a sequence.
    Null and empty texts are one piece of one id. Rows that repeat an id, and rows without one, are
    documents of their own. Ties of length go by the order in which the pieces were written, so
    a rerun over other files may deal the same lengths to other documents; the number of sequences
    stays. An empty table gives no rows. Only the named columns are read, so others may have any name.
    """
    spark = docs.sparkSession
    made = stored(pieces(docs, tokenizer, capacity, id_col, text_col).withColumn("written", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    slots = plan(counts, capacity)
    slots = spark.sparkContext.broadcast(slots[np.lexsort((slots[:, 1], slots[:, 0]))])

    def place(batches):
        length, first, sequence, per, offset = slots.value.T
        keys = length * RANK_SPAN + first
        for batch in batches:
            size, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = np.searchsorted(keys, size * RANK_SPAN + rank, "right") - 1
            nth = rank - first[at]
            places = [pa.array(sequence[at] + nth // per[at]), pa.array(offset[at] + nth % per[at] * size)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + places, names=schema.names)

    rows = ranked(made, "length", "written").select(*made.columns[:-1], "rank")
    schema = StructType([*made.schema.fields[:-1], StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return rows.mapInArrow(place, schema)
