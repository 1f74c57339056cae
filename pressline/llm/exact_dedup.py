"""Exact deduplication by deterministic block naming.

Every text is cut into fixed-size byte blocks. The distinct blocks are sorted
and named by integers; then adjacent pairs of names are sorted and named again,
level by level, until one integer is left for each document. Two documents get
the same integer at the same level exactly when their texts are equal.

Blocks are sorted on their 64-bit hash first and on their bytes second. The
bytes are compared for all blocks (one distinct aggregation); only where one
hash stands for several blocks does the second key differ from 0, so the text
is shuffled once, combined on the map side, and all later steps move integers.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressline.session import discard, discard_paths, noting, release, stored

BLOCK_BYTES = 4096
#: Colliding hashes are broadcast up to this many (8 bytes each), else joined by shuffle.
MAX_BROADCAST_COLLISIONS = 100_000
#: Dropped rows (32 bytes each) are broadcast up to this many, so texts are not shuffled; beyond, by shuffle.
MAX_BROADCAST_GONE = 1_000_000


def _blocks(data: F.Column, size: int) -> F.Column:
    """Array of the byte blocks of data; one empty block for an empty text."""
    last = F.greatest(F.lit(0), F.ceil(F.octet_length(data) / size).cast("int") - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _named(keys: DataFrame, label: str) -> DataFrame:
    """Distinct (a, b) with integer names that follow their sort order."""
    ranked = keys.distinct().repartitionByRange("a", "b").sortWithinPartitions("a", "b")
    return stored(ranked.withColumn("name", F.monotonically_increasing_id()), label)


def _collisions(blocks: DataFrame) -> DataFrame:
    """Hashes that stand for more than one block."""
    return blocks.groupBy("h", "block").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")


def name_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, hash_of=None) -> DataFrame:
    """One row per input row: (row_id, id, sha256, level, name).

    (level, name) is the document's identity. A null text counts as empty; null
    ids and repeated rows are kept as they are; an empty table gives no rows.
    hash_of replaces xxhash64 (tests use a poor hash to force collisions).
    """
    hash_of = hash_of or F.xxhash64
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).alias("id"), data.alias("data"))
    cut = base.select(F.explode(_blocks(F.col("data"), block_bytes)).alias("block")).select(hash_of(F.col("block")).alias("h"), "block")
    clashing = stored(_collisions(cut), "clashing")
    n_clashing = clashing.count()
    rows = base.withColumn("row_id", F.monotonically_increasing_id())
    if n_clashing == 0:
        hashed = F.transform(_blocks(F.col("data"), block_bytes), lambda b: hash_of(b))
        rows = stored(rows.select("row_id", "id", F.sha2("data", 256).alias("sha256"), hashed.alias("hs")), "rows")
        parts = rows.select("row_id", F.size("hs").alias("parts"), F.posexplode("hs").alias("pos", "a")).withColumn("b", F.lit(0).cast("long"))
    else:
        small = F.broadcast(clashing) if n_clashing <= MAX_BROADCAST_COLLISIONS else clashing
        variants = cut.join(small, "h", "left_semi").distinct()
        variants = stored(variants.withColumn("b", F.row_number().over(Window.partitionBy("h").orderBy("block"))), "variants")
        blocks = _blocks(F.col("data"), block_bytes)
        cut = rows.select("row_id", "id", F.sha2("data", 256).alias("sha256"), F.size(blocks).alias("parts"), F.posexplode(blocks).alias("pos", "block"))
        cut = cut.withColumn("h", hash_of(F.col("block"))).join(small.withColumn("clash", F.lit(True)), "h", "left")
        cut = cut.withColumn("block", F.when(F.col("clash"), F.col("block"))).join(variants, ["h", "block"], "left")
        cut = stored(cut.select("row_id", "id", "sha256", "parts", "pos", F.col("h").alias("a"), F.coalesce("b", F.lit(0)).cast("long").alias("b")), "rows")
        parts, rows = cut.select("row_id", "parts", "pos", "a", "b"), cut.where("pos = 0")
    longest = parts.agg(F.max("parts")).first()[0] or 1
    done = []
    for level in range(math.ceil(math.log2(longest)) + 1):
        names = _named(parts.select("a", "b"), f"names{level}")
        named = parts.join(names, ["a", "b"]).select("row_id", "parts", "pos", "name")
        named = stored(named, f"level{level}")
        discard(names)
        done.append(named.where("parts = 1").select("row_id", F.lit(level).alias("level"), "name"))
        if 2**level >= longest:
            break
        pair = named.where("parts > 1").groupBy("row_id", F.expr("cast(ceil(parts / 2) as int)").alias("parts"), F.expr("cast(pos div 2 as int)").alias("pos"))
        # a name is never negative, so -1 marks an odd last part
        parts = pair.agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"), F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1).cast("long")).alias("b"))
        parts = stored(parts, f"pairs{level}")
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return rows.select("row_id", "id", "sha256").join(whole, "row_id")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. Rows that repeat one id
    and text count in group_size; all rows of the largest id are marked kept.
    A null id never wins over another id; a null text is empty, and empty texts are equal. An
    empty table gives no rows. A text of any length is compared whole, in blocks. Only the two
    named columns are read, so other columns may have any name.
    """
    with noting() as made:
        lazy = name_documents(docs, id_col, text_col, **options)
    named = stored(lazy, "named")
    discard_paths(docs.sparkSession, made)
    release(docs.sparkSession)
    groups = named.groupBy("level", "name").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # stored, so that both sides of the join are plain shuffles and a hot group's rows can be split
    groups = stored(groups, "groups")
    out = named.join(groups, ["level", "name"])
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha256").alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the rows whose text another row with a larger id holds.

    Columns stay as they are. Rows that repeat one id and text are reduced to
    one; rows with a null id stay unless another id holds their text. Columns may have any name.
    """
    with noting() as made:
        lazy = exact_groups(docs, id_col, text_col)
    groups = stored(lazy, "groups")
    discard_paths(docs.sparkSession, made)
    # the hash only tells apart texts under one repeated id
    gone = groups.where(~F.col("kept")).select(F.col("doc_id").alias("__gone"), F.substring("text_sha256", 1, 16).alias("__sha")).distinct()
    sha = F.substring(F.sha2(F.coalesce(docs[text_col], F.lit("")).cast("binary"), 256), 1, 16)
    gone = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_GONE else gone
    left = docs.join(gone, docs[id_col].eqNullSafe(gone["__gone"]) & (sha == gone["__sha"]), "left_anti")
    total = groups.where("kept").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.struct(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_sha256"))).alias("d")).first()
    return left if total.n == total.d else left.dropDuplicates([id_col, text_col])
