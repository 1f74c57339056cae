"""Ranked lexical search: an inverted index in shards, searched by variable-block-max WAND.

A shard is a run of documents of bounded size, indexed where they are read. Its posting
lists hold document numbers and impacts (what a posting adds to a score, but for its term's
weight). Dynamic programming cuts each list into blocks so that the bound error, the sum of
(block maximum - impact) over postings, plus a fixed price per block is least.

A search joins the query's terms to the index and takes each shard by itself. The block ends of a
query's lists cut the shard into intervals in which every list has one maximum. Intervals whose
maxima sum to less than the score to beat are skipped; in the others a document is scored only
once a list is met (largest maximum first) from which on the maxima still reach that score. All is in whole
numbers and skips only what is strictly below, so results are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from pressline.llm.words import arrow_map, raw, texts_of
from pressline.session import stored

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What cuts terms becomes a blank, A-Z lower case; bytes of other characters stay.
FOLD = bytes(b if b >= 128 or chr(b) in LOWER + "0123456789" else b + 32 if chr(b) in UPPER else 32 for b in range(256))
#: A shard ends at so many bytes of text or documents.
SHARD_BYTES, SHARD_DOCS = 16_000_000, 1 << 16
#: Postings that are cut into blocks together, and what a block costs in units of bound error.
CHUNK, BLOCK_COST = 256, 1_000_000
#: Shards that are searched first, for scores that the others have to reach.
FIRST_SHARDS = 8
#: Bytes of query terms, with their weights, that one pass over the index takes.
QUERY_BYTES = 8_000_000
K = 50


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def corpus_size(docs: DataFrame, text_col: str = "text") -> tuple[int, int]:
    """Documents that hold a term, and all their terms."""
    n = docs.select(F.coalesce(F.regexp_count(F.col(text_col), F.lit(TERM)), F.lit(0)).cast("long").alias("n")).where("n > 0")
    row = n.agg(F.count("n").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return row["docs"], row["terms"]


def block_ends(impacts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Positions behind each block of the lists impacts[offsets[i]:offsets[i + 1]].

    Within a run of CHUNK postings the cut is the cheapest of all: best[j] is the least of
    best[i] + BLOCK_COST + (j - i) * max(impacts[i:j]). Runs of like length are solved side by side.
    """
    sizes = np.diff(offsets)
    runs = -(-sizes // CHUNK)
    starts = np.repeat(offsets[:-1], runs) + CHUNK * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    lengths = np.minimum(np.repeat(offsets[1:], runs) - starts, CHUNK)
    found = [(starts + lengths)]  # a run ends a block
    width = 1
    while width < CHUNK:
        low, width = width, 2 * width
        own = np.flatnonzero((lengths > low) & (lengths <= width))
        for part in np.array_split(own, -(-len(own) * width // 500_000) or 1):
            if len(part):
                found.append(_cheapest(impacts, starts[part], lengths[part], width))
    return np.unique(np.concatenate(found))


def _cheapest(impacts: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    at = np.arange(width)
    values = np.where(at < lengths[:, None], impacts[np.minimum(starts[:, None] + at, len(impacts) - 1)], 0)
    best, came = np.zeros((len(starts), width + 1), np.int64), np.zeros((len(starts), width + 1), np.int16)
    top = np.zeros((len(starts), width), np.int64)
    for j in range(1, width + 1):
        np.maximum(top[:, : j - 1], values[:, j - 1 : j], out=top[:, : j - 1])
        top[:, j - 1] = values[:, j - 1]
        # top[:, i] is now max(values[i:j]) for i < j
        cost = best[:, :j] + top[:, :j] * (j - at[:j])
        i = cost.argmin(1)
        came[:, j], best[:, j] = i, cost[np.arange(len(i)), i] + BLOCK_COST
    ends, row, pos = [], np.arange(len(starts)), lengths.astype(np.int64)
    while len(row):
        ends.append(starts[row] + pos)
        pos = came[row, pos].astype(np.int64)
        row, pos = row[pos > 0], pos[pos > 0]
    return np.concatenate(ends)


class _Numbers(dict):
    """term -> its number in the shard."""

    def __missing__(self, term: bytes) -> int:
        self[term] = len(self)
        return self[term]


class _Shard:
    def __init__(self):
        self.numbers, self.parts, self.counts, self.ids, self.bytes = _Numbers(), [], [], [], 0

    def add(self, ids: pa.Array, texts) -> None:
        words: list[bytes] = []
        counts, first = [], sum(map(len, self.counts))
        for text in texts:
            own = text.translate(FOLD).split()
            words += own
            counts.append(len(own))
            self.bytes += len(text)
        term = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        key, tf = np.unique(term << 20 | np.repeat(first + np.arange(len(counts)), counts), return_counts=True)
        self.parts.append((key, tf))
        self.counts.append(np.array(counts, np.int64))
        self.ids.append(ids)

    def rows(self, shard: int, size: tuple[int, int], names: list[str], kind: pa.DataType):
        """Record batches of the shard: its ids in order, then its lists."""
        docs, total = size
        ids = pa.chunked_array(self.ids).combine_chunks()
        order = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        key, tf = (np.concatenate(x) for x in zip(*self.parts))
        doc = key & (1 << 20) - 1
        n = np.concatenate(self.counts)
        m = 50 + 50 * n * docs // max(total, 1)
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
        sort = np.argsort((key >> 20) << 20 | place[doc])
        term, doc, impact = key[sort] >> 20, place[doc[sort]], impact[sort]
        offsets = np.concatenate([np.searchsorted(term, np.arange(len(self.numbers))), [len(term)]])
        ends = block_ends(impact, offsets)
        blocks = np.searchsorted(ends, offsets, "right")
        tops = np.maximum.reduceat(impact, np.concatenate([[0], ends[:-1]])) if len(ends) else impact
        lasts = doc[ends - 1] if len(ends) else doc

        def batch(words, columns, own_ids, held=None):
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(words), shard)), pa.array(words, pa.binary()), *columns, own_ids, pa.array([held] * len(words), pa.int64())], names=names)

        none = pa.nulls(1, pa.list_(pa.int32()))
        own = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order)))
        yield batch([None], [none] * 4, own, int((n > 0).sum()))
        words, step = list(self.numbers), 20_000
        for a in range(0, len(words), step):
            o, k = offsets[a : a + step + 1], blocks[a : a + step + 1]

            def lists(values, at):
                return pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(values[at[0] : at[-1]], pa.int32()))

            part = words[a : a + step]
            yield batch(part, [lists(doc, o), lists(impact, o), lists(lasts, k), lists(tops, k)], pa.nulls(len(part), pa.list_(kind)))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(shard, term, docs, impacts, lasts, tops, ids, held), written as a table.

    One row per shard and term: document numbers, impacts, and the last number and the largest impact
    of each block. One row per shard without a term: its ids, by number, and how many of
    its documents hold a term. Every row of docs is
    indexed, a shard lies in one task, and nothing is shuffled. The impacts hold for these documents
    (their number and mean length): a changed corpus is indexed anew.
    """
    size = corpus_size(docs, text_col)
    id_type = docs.schema[id_col].dataType
    numbers = ArrayType(IntegerType())
    schema = StructType([StructField("shard", LongType()), StructField("term", BinaryType()), *(StructField(c, numbers) for c in ("docs", "impacts", "lasts", "tops")), StructField("ids", ArrayType(id_type)), StructField("held", LongType())])

    def index(batches):
        task, done, shard = TaskContext.get().partitionId(), 0, _Shard()
        kind = to_arrow_type(id_type)
        for batch in batches:
            ids, texts, first, held = batch.column(0), [], 0, 0
            for i, text in enumerate(texts_of(batch.column(1))):
                texts.append(text)
                held += len(text)
                if held < 1_000_000 and i + 1 < len(ids):
                    continue
                shard.add(ids[first : i + 1], texts)
                texts, first, held = [], i + 1, 0
                if shard.bytes >= SHARD_BYTES or sum(map(len, shard.counts)) >= SHARD_DOCS:
                    yield from shard.rows(task << 24 | done, size, schema.names, kind)
                    done, shard = done + 1, _Shard()
        if shard.counts:
            yield from shard.rows(task << 24 | done, size, schema.names, kind)

    return stored(arrow_map(docs.select(F.col(id_col), raw(text_col)), index, schema), "index")


def weighted_terms(index: DataFrame, queries: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, term, weight) for each term of each item that some document holds.

    Rows of one item count together; a null item is an item.
    """
    asked = queries.select(F.col(item_col).alias("item_id"), F.explode(terms(F.col(text_col)).cast("array<binary>")).alias("term")).distinct()
    lists = index.where("term is not null").select("term", F.size("docs").alias("n")).join(asked.select("term").distinct(), "term", "left_semi")
    df = lists.groupBy("term").agg(F.sum("n").alias("df"))
    n = index.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    weight = F.floor(1000 * F.ln(F.lit(2 * n + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("long")
    return asked.join(df, "term").select("item_id", "term", weight.alias("weight"))


class _Lists:
    """The lists of one shard that a query touches, as flat arrays."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        held = table.filter(pc.is_valid(table["term"])).combine_chunks()
        self.ids = pc.list_flatten(table.filter(pc.is_null(table["term"]))["ids"]).combine_chunks()
        self.at = {t: i for i, t in enumerate(held["term"].to_pylist())}
        flat = lambda c: (np.asarray(pc.list_flatten(held[c]).combine_chunks(), np.int64), np.concatenate([[0], np.cumsum(pc.list_value_length(held[c]).to_numpy())]))
        (self.docs, self.offsets), (self.impacts, _), (self.lasts, self.blocks), (self.tops, _) = map(flat, ("docs", "impacts", "lasts", "tops"))

    def search(self, query: list[tuple[bytes, int]], floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(document numbers, scores) of the k best with a score above 0 and of at least floor."""
        own = [(self.at[t], w) for t, w in query if w > 0 and t in self.at]
        none = np.empty(0, np.int64)
        if not own:
            return none, none
        cuts = [self.lasts[self.blocks[i] : self.blocks[i + 1]] for i, _ in own]
        ends = np.unique(np.concatenate(cuts))
        bounds = np.zeros((len(own), len(ends)), np.int64)
        for row, (i, w), lasts in zip(bounds, own, cuts):
            row[: np.searchsorted(ends, lasts[-1]) + 1] = w * np.repeat(self.tops[self.blocks[i] : self.blocks[i + 1]], np.diff(np.searchsorted(ends, lasts, "right"), prepend=0))
        order = np.argsort(-bounds.max(1), kind="stable")
        reach = np.cumsum(bounds[order[::-1]], 0)[::-1]  # what the lists from this one on can add, by interval
        widths = np.diff(ends, prepend=-1)
        interval = np.repeat(np.arange(len(ends)), widths)
        queue = np.argsort(-reach[0], kind="stable")
        best, scores, beat, size = none, none, max(floor, 1), 2 * k
        while len(queue):
            queue = queue[: np.searchsorted(-reach[0][queue], -beat, "right")]  # the others are below the score to beat
            taken = np.searchsorted(np.cumsum(widths[queue]), size) + 1
            live = np.zeros(len(ends), bool)
            live[queue[:taken]] = True
            queue, size = queue[taken:], 4 * size
            score, met = np.zeros(len(interval), np.int64), np.zeros(len(interval), bool)
            pivot = live & (reach >= beat)
            for place, nth in enumerate(order):
                i, w = own[nth]
                docs = self.docs[self.offsets[i] : self.offsets[i + 1]]
                use = pivot[place][interval[docs]] | met[docs]
                docs = docs[use]
                met[docs] = True
                score[docs] += w * self.impacts[self.offsets[i] : self.offsets[i + 1]][use]
            new = np.flatnonzero(score >= beat)
            best, scores = np.concatenate([best, new]), np.concatenate([scores, score[new]])
            if len(best) > k:
                keep = np.lexsort((best, -scores))[:k]
                best, scores = best[keep], scores[keep]
            if len(best) == k:
                beat = max(beat, int(scores.min()))
        return best, scores


def search(index: DataFrame, queries: DataFrame, k: int = K, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item, scores above 0 only.

    Equal scores go by ascending id, null last. Null and empty texts have no terms: such items give no
    rows and such documents are never found. Rows that repeat a doc_id are documents of their own,
    rows that repeat an item_id one item with the terms of all. Empty tables give no rows. Other columns
    may have any name. Queries go in blocks of about QUERY_BYTES of terms (an item is not
    split), each a pass over their lists. FIRST_SHARDS shards are searched first: a k-th best score among
    them is one that every other shard has to reach, so shards send few rows.
    """
    spark = index.sparkSession
    weighted = stored(weighted_terms(index, queries, item_col, text_col), "query")
    per_item = weighted.groupBy("item_id").agg(F.sum(F.length("term") + 16).alias("bytes"))
    blocks = -(-(per_item.agg(F.sum("bytes")).first()[0] or 0) // QUERY_BYTES)
    schema = StructType([weighted.schema["item_id"], StructField("doc_id", index.schema["ids"].dataType.elementType), StructField("score", LongType())])
    first = [r["shard"] for r in index.where("term is null").select("shard").orderBy(F.xxhash64("shard"), "shard").limit(FIRST_SHARDS).collect()]
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    found = spark.createDataFrame([], schema)
    for block in range(blocks):
        own = weighted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        lists = own.select("term").distinct()
        kept = index.join(F.broadcast(lists), "term", "left_semi").unionByName(index.where("term is null"))
        asked: dict = {}
        for r in own.collect():  # QUERY_BYTES, about
            asked.setdefault(r["item_id"], []).append((bytes(r["term"]), r["weight"]))
        in_first = F.col("shard").isin(first)
        head = stored(_search_shards(kept.where(in_first), asked, {}, k, schema), "first")
        worst = head.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k)
        floors = {r["item_id"]: r["score"] for r in worst.collect()}  # a row per item of the block
        found = found.union(head).union(_search_shards(kept.where(~in_first), asked, floors, k, schema))
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _search_shards(lists: DataFrame, asked: dict, floors: dict, k: int, schema: StructType) -> DataFrame:
    sent = lists.sparkSession.sparkContext.broadcast((asked, floors))

    def run(table: pa.Table) -> pa.Table:
        shard, (queries, least) = _Lists(table), sent.value
        items, docs, scores = [], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for item, query in queries.items():
            own, score = shard.search(query, least.get(item, 0), k)
            items += [item] * len(own)
            docs.append(own)
            scores.append(score)
        ids = shard.ids.take(pa.array(np.concatenate(docs)))
        return pa.table([pa.array(items, to_arrow_type(schema[0].dataType)), ids, pa.array(np.concatenate(scores))], names=schema.names)

    return lists.groupBy("shard").applyInArrow(run, schema)


SEARCH_SQL = r"""
with q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
d as (select row_number() over () as row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
total as (select count(*) filter (len(w) > 0) as docs, sum(len(w))::bigint as words from d),
p as (select row, doc_id, n, term, count(*) as tf from (select row, doc_id, len(w) as n, unnest(w) as term from d) where term in (select term from q) group by row, doc_id, n, term),
f as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as weight from p, total group by term, docs),
s as (select item_id, row, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::bigint as score from q join p using (term) join f using (term), total group by item_id, row, doc_id),
r as (select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 50
"""
