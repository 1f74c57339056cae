"""Exact set-similarity join on word n-grams by vertical partitioning.

The global order of n-grams is the order of their hashes. It is cut into m
fragments, so every document is cut into m segments. Two sets of Jaccard t or
more, the smaller of at most `top` n-grams, differ in at most d = top*(1-t)/t
n-grams, and each of those spoils one fragment. So of a set's segments all but d
are equal in any linked set, and of its d + 1 rarest segments one at least is:
candidates meet on (fragment, segment hash) of these. m is 1.5 d, so a set of
which most segments are unique meets nobody, however common its other passages.
m depends on the size class of the smaller set, so a document emits
its segments for its own class and, near a class border, for the one below.

A set with so many empty fragments that this could fail also emits its single
n-grams, to meet its like. How frequent a segment is, bitmaps say in a few tiers:
any order will do that is the same for all sets.

Documents connected by equal segments form families. A family that outgrows one
block is measured against one pivot set: the n-grams of most of SAMPLE members that met
the same hub (which sample decides the work, never the result). Jaccard distance obeys
the triangle inequality, so members within half the distance of a link (the core) are
all linked with each other and counted without being paired, and members beyond
three halves of it are linked with none of the core. What is left is dealt out in blocks of bounded size; for each pair of blocks the partial
overlaps are counted fragment by fragment, as small matrix products, and summed
per pair. Only the verified links leave a block, as a spanning forest and link counts.

Documents with equal sets are one class from the start and are never paired.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressline.functions.components import connected_components
from pressline.llm.bitmaps import bitmap, bits_for
from pressline.llm.words import arrow_map, mixed, raw, texts_of, word_hashes
from pressline.session import discard, discard_paths, noting, release, stored

#: Ratio of neighbouring size classes.
CLASS_RATIO = 1.5
#: A block holds about this many documents and n-grams.
BLOCK_DOCS, BLOCK_GRAMS = 1024, 1_000_000
#: About the vocabulary of one fragment in the verification.
FRAGMENT = 2048
#: Keys in more than so many sets count as ever more frequent.
TIERS = (1, 8, 100)
#: As many differing segments as a set has.
ALL = 2**31 - 2
#: The pivot of a large family is made of so many members.
SAMPLE = 32
#: Ids of family members (8 bytes each) are broadcast up to this many, else joined by shuffle.
MAX_BROADCAST = 1_000_000

_BOUNDS = [1]
while _BOUNDS[-1] < 1 << 40:
    _BOUNDS.append(max(_BOUNDS[-1] + 1, int(_BOUNDS[-1] * CLASS_RATIO)))
BOUNDS = np.array(_BOUNDS)
SALTS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingle_sets(texts, words: int):
    """The sorted distinct hashes of each text's word n-grams; of all its words where there are fewer."""
    for _, counts, h in word_hashes(texts):
        grams = np.zeros(0, np.uint64)
        if len(h) >= words:
            with np.errstate(over="ignore"):
                grams = h[: len(h) - words + 1] * SALTS[0]
                for k in range(1, words):
                    grams = (grams ^ (grams >> np.uint64(29))) * SALTS[k % len(SALTS)] + h[k : len(h) - words + 1 + k]
            grams = mixed(grams)
        ends = np.cumsum(counts)
        for start, end in zip((ends - counts).tolist(), ends.tolist(), strict=True):
            if end - start >= words:
                s = np.sort(grams[start : end - words + 1])
                yield s if len(s) == 1 else s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif end > start:
                # the length goes in, so that a short text never equals an n-gram
                yield np.array([xxhash.xxh3_64_intdigest(h[start:end].tobytes(), end - start)], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def segment_keys(s: np.ndarray, num: int, den: int) -> list[tuple[int, np.ndarray]]:
    """For each size class (spoiled, hashes of (class, fragment, segment)): beside any set linked
    with s at most `spoiled` segments differ. Single n-grams, should all differ, with spoiled ALL."""
    n = len(s)
    if not n:
        return []
    high = int(np.searchsorted(BOUNDS, n, "right")) - 1
    low = int(np.searchsorted(BOUNDS, -(-n * num // den), "right")) - 1
    out, strong = [], mixed(s.copy())
    for k in range(low, high + 1):
        top = int(BOUNDS[k + 1]) - 1
        most = top * (den - num) // num
        m = most + 1 + most // 2
        fragment = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], fragment[1:] != fragment[:-1])))
        total = np.add.reduceat(strong, starts)
        # the most n-grams that can differ: s is the smaller set, or the larger beside one of at most top
        spoiled = n * (den - num) // num if n <= top else (n + top) * (den - num) // (den + num)
        with np.errstate(over="ignore"):
            out.append((spoiled, mixed(total ^ (fragment[starts] * SALTS[0] + np.uint64(k)))))
            if len(starts) <= spoiled:
                out.append((ALL, mixed(strong ^ (SALTS[1] + np.uint64(k)))))
    return out


def _profile(docs: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int) -> DataFrame:
    """doc_id, n, digest of the set (two longs), segment keys of all classes, and for each class their number and `spoiled`."""
    kind = dict(docs.dtypes)[id_col]

    def profiled(batches):
        for batch in batches:
            n, d1, d2, flat, sizes, per, spoiled, classes = [], [], [], [], [0], [], [], [0]
            for s in shingle_sets(texts_of(batch.column(1)), words):
                digest = xxhash.xxh3_128_digest(s.tobytes())
                n.append(len(s))
                d1.append(int.from_bytes(digest[:8], "big", signed=True))
                d2.append(int.from_bytes(digest[8:], "big", signed=True))
                own = segment_keys(s, num, den)
                flat += [k for _, k in own]
                per += [len(k) for _, k in own]
                spoiled += [x for x, _ in own]
                sizes.append(sizes[-1] + sum(len(k) for _, k in own))
                classes.append(classes[-1] + len(own))
            keys = np.concatenate(flat) if flat else np.zeros(0, np.uint64)
            lists = lambda ends, values: pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in (n, d1, d2)), lists(sizes, pa.array(keys.view(np.int64))), lists(classes, pa.array(per, pa.int32())), lists(classes, pa.array(spoiled, pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "d1", "d2", "keys", "per", "spoiled"])

    return arrow_map(docs.select(F.col(id_col).alias("doc_id"), raw(text_col).alias("data")), profiled, f"doc_id {kind}, n long, d1 long, d2 long, keys array<long>, per array<int>, spoiled array<int>")


def _keys(voices, tiers=()):
    """Arrow function: (id, key) of the rows that speak for a class.

    With tiers, bitmaps of ever more frequent keys, only of the keys that a partner can need: of a
    class's keys in order of frequency the first spoiled + 1, because one of these is equal; and of
    them only those that the first tier calls shared."""

    def run(batches):
        for batch in batches:
            ids, voice = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            flat, sizes, per, spoiled = *_flat(batch.column(2)), _flat(batch.column(3))[0], _flat(batch.column(4))[0]
            row = np.repeat(np.arange(len(ids)), sizes)
            use = voices.has(voice)[row]
            if tiers:
                tier = sum(t.has(flat).astype(np.int64) for t in tiers)
                part = np.repeat(np.arange(len(per)), per)
                order = np.lexsort((flat, tier, part))
                rank = np.empty(len(flat), np.int64)
                rank[order] = np.arange(len(flat)) - np.repeat(np.cumsum(per) - per, per)
                use &= (tier > 0) & (rank <= np.repeat(spoiled, per))
            yield pa.RecordBatch.from_arrays([pa.array(ids[row][use]), pa.array(flat[use])], ["id", "key"])

    return run


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """(all values, number of values in each list)"""
    ends = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]], np.diff(ends)


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of all intersections, summed over the fragments of the vocabulary. right None: left with itself."""
    sets = left + (right or [])
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    grams = np.concatenate(sets)
    order = np.argsort(grams, kind="stable")
    grams, rows = grams[order], rows[order]
    new = np.concatenate(([True], grams[1:] != grams[:-1]))
    ids = np.cumsum(new) - 1
    shared = np.bincount(ids)[ids] > 1
    grams, rows = grams[shared], rows[shared]
    out = np.zeros((len(left), len(right if right is not None else left)), np.float64)
    # the global order, all hashes, is cut into equal fragments of about FRAGMENT n-grams of this vocabulary
    fragments = max(1, -(-len(np.unique(grams)) // FRAGMENT))
    cuts = np.array([(k << 64) // fragments for k in range(fragments)], np.uint64)
    bounds = [*np.searchsorted(grams, cuts).tolist(), len(grams)]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        _, own = np.unique(grams[a:b], return_inverse=True)
        part = np.zeros((len(sets), int(own.max(initial=-1)) + 1), np.float32)
        part[rows[a:b], own] = 1
        out += part[: len(left)] @ (part if right is None else part[len(left) :]).T
    return out


def _counted(hit: np.ndarray, ids: np.ndarray, others: np.ndarray, weight: np.ndarray) -> dict[int, int]:
    """id -> documents linked with any of its sets. hit has a row for each set of ids and a column for each of others."""
    rows, own = np.unique(ids, return_inverse=True)
    if len(rows) < len(ids):
        merged = np.zeros((len(rows), len(others)), bool)
        np.logical_or.at(merged, own, hit)
        hit = merged
    else:
        hit = hit[np.argsort(ids)]
    links = hit @ weight
    columns, of = np.unique(others, return_inverse=True)
    if len(columns) < len(others):
        # an id met by several of its sets is one document
        met = np.zeros((len(columns), len(rows)), np.int64)
        np.add.at(met, of, hit.T)
        links = links - np.maximum(met - 1, 0).sum(axis=0)
    return {int(rows[i]): int(links[i]) for i in np.flatnonzero(hit.any(axis=1))}


def _common(table: pa.Table) -> pa.Table:
    """The n-grams of more than half of a family's sample."""
    sets = {(x, y): np.frombuffer(g.as_py(), np.uint64) for x, y, g in zip(table.column("d1").to_pylist(), table.column("d2").to_pylist(), table.column("grams"), strict=True)}
    grams, seen = np.unique(np.concatenate(list(sets.values())), return_counts=True)
    return table.select(["family"]).slice(0, 1).append_column("grams", pa.array([grams[2 * seen > len(sets)].tobytes()], pa.binary()))


def _shared(table: pa.Table) -> pa.Table:
    """For a part of a family and its pivot: (id, d1, d2, family, n-grams shared with the pivot, size of the pivot)."""
    leads = table.column("lead").to_numpy()
    grams = table.column("grams")
    pivot = np.concatenate([np.zeros(0, np.uint64)] + [np.frombuffer(grams[int(i)].as_py(), np.uint64) for i in np.flatnonzero(leads)])
    rows = np.flatnonzero(~leads)
    both = [np.intersect1d(pivot, np.frombuffer(grams[int(i)].as_py(), np.uint64), assume_unique=True).size for i in rows]
    out = table.select(["id", "d1", "d2", "family"]).take(pa.array(rows))
    return out.append_column("both", pa.array(both, pa.int64())).append_column("of", pa.array(np.full(len(rows), len(pivot)), pa.int64()))


def _links(num: int, den: int):
    """Function for a group of one or two blocks: (id, root, links) of every document with a link."""

    def linked(table: pa.Table) -> pa.Table:
        ids, d1, d2, sizes, sides = (table.column(c).to_pylist() for c in ("id", "d1", "d2", "copies", "side"))
        alone = all(table.column(p)[0] == table.column(q)[0] for p, q in (("a", "b"), ("x", "y")))
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("grams")]
        place = {}
        for i, key in enumerate(zip(sides, ids, d1, d2, strict=True)):
            place.setdefault(key, i)
        first = [i for (side, *_), i in place.items() if side == 0]
        second = [i for (side, *_), i in place.items() if side == 1]
        if not first or not (alone or second):
            # hashing left one of the two blocks empty
            return table.select(["id"]).slice(0, 0).append_column("root", pa.array([], pa.int64())).append_column("links", pa.array([], pa.int64()))
        n = np.array([len(s) for s in sets])
        count = overlaps([sets[i] for i in first], None if alone else [sets[i] for i in second])
        other = first if alone else second
        union = n[first][:, None] + n[other][None, :] - count
        hit = (count > 0) & (den * count >= num * union)
        name = np.array(ids, np.int64)
        # the sets of one id are one node, not linked with itself
        hit &= name[first][:, None] != name[other][None, :]
        weight = np.array(sizes)
        found = _counted(hit, name[first], name[other], weight[other])
        if not alone:
            found |= _counted(hit.T, name[second], name[first], weight[first])
        root: dict = {}

        def find(x):
            while root.setdefault(x, x) != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        for x, y in zip(*np.nonzero(hit), strict=True):
            a, b = find(ids[first[x]]), find(ids[other[y]])
            if a != b:
                root[max(a, b)] = min(a, b)
        keep = sorted(found)
        return pa.table({"id": pa.array(keep, pa.int64()), "root": pa.array([find(x) for x in keep], pa.int64()), "links": pa.array([found[x] for x in keep], pa.int64())})

    return linked


def _sets(docs: DataFrame, ids: DataFrame, n_ids: int, words: int) -> DataFrame:
    """(id, d1, d2, grams) of the rows with one of the ids; another text under the same id has another digest."""
    texts = docs.join(F.broadcast(ids) if n_ids <= MAX_BROADCAST else ids, docs["doc_id"] == ids["id"], "left_semi").select("doc_id", raw("text").alias("data"))

    def cut(batches):
        for batch in batches:
            d1, d2, grams = [], [], []
            for s in shingle_sets(texts_of(batch.column(1)), words):
                data = s.tobytes()
                digest = xxhash.xxh3_128_digest(data)
                d1.append(int.from_bytes(digest[:8], "big", signed=True))
                d2.append(int.from_bytes(digest[8:], "big", signed=True))
                grams.append(data)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(grams, pa.binary())], ["id", "d1", "d2", "grams"])

    return arrow_map(texts, cut, "id long, d1 long, d2 long, grams binary")


def _banded(members: DataFrame, large: DataFrame, sampled: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Members of large families and their band around the pivot:
    0 up to half the distance of a link, 2 beyond three halves, 1 between. An id with several sets
    is never in band 0, so its sets meet the others in one block and count as one document.

    A family is measured in as many parts as it has blocks, each with a copy of the pivot."""
    picked = sampled.join(large, "family").join(members.select("id", "d1", "d2"), "id").join(sets, ["id", "d1", "d2"])
    leads = picked.groupBy("family").applyInArrow(_common, "family long, grams binary").join(large, "family")
    leads = leads.select(*(F.lit(None).cast("long").alias(c) for c in ("id", "d1", "d2")), "family", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.lit(True).alias("lead"), "grams")
    part = F.pmod(F.xxhash64("id", "d1", "d2"), F.col("blocks")).cast("int").alias("part")
    asked = members.select("id", "d1", "d2", "family", part, F.lit(False).alias("lead")).join(sets, ["id", "d1", "d2"])
    both = asked.unionByName(leads).groupBy("family", "part").applyInArrow(_shared, "id long, d1 long, d2 long, family long, both long, of long").distinct()
    own = members.groupBy("id").agg(F.count(F.lit(1)).alias("own"))
    apart = members.join(both, ["id", "d1", "d2", "family"]).join(own, "id")
    union = F.col("n") + F.col("of") - F.col("both")
    far = 2 * den * (union - F.col("both"))
    band = F.when((far <= (den - num) * union) & (F.col("own") == 1), 0).when(far <= 3 * (den - num) * union, 1).otherwise(2)
    return apart.select("id", "d1", "d2", "family", "copies", band.alias("band"))


def _dealt(members: DataFrame, banded: DataFrame, blocks, num: int, den: int) -> DataFrame:
    """(id, d1, d2, family, copies, spots): where each member is compared.

    A spot (a, b, x, y, side) is a pair of blocks: block x of cell a beside block y of cell b. A cell
    is a size class and band of a large family; a small family is one block. Linked sets are of the same or
    neighbouring size classes; core beside core and core beside far need no comparison."""
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(den / num)))).cast("int")
    placed = members.join(banded.select("id", "d1", "d2", "band"), ["id", "d1", "d2"], "left").withColumn("size_class", size_class)
    placed = placed.withColumn("cell", F.col("size_class") * 3 + F.col("band"))
    cells = placed.where("band is not null").groupBy("family", "cell").agg(blocks)
    layout = cells.groupBy("family").agg(F.map_from_entries(F.collect_list(F.struct("cell", "blocks"))).alias("layout"))
    placed = placed.join(layout, "family", "left").withColumn("block", F.pmod(F.xxhash64("id"), F.col("layout")[F.col("cell")]).cast("int"))
    beside = """filter(flatten(transform(array(-1, 0, 1), d ->
        transform(CASE band WHEN 0 THEN array(1) WHEN 1 THEN array(0, 1, 2) ELSE array(1, 2) END, o -> (size_class + d) * 3 + o))),
        t -> map_contains_key(layout, t))"""
    spots = """flatten(transform(beside, t -> transform(sequence(0, layout[t] - 1), i ->
        CASE WHEN t > cell OR (t = cell AND i >= block) THEN named_struct('a', cell, 'b', t, 'x', block, 'y', i, 'side', 0)
        ELSE named_struct('a', t, 'b', cell, 'x', i, 'y', block, 'side', 1) END)))"""
    one = "array(named_struct('a', -1, 'b', -1, 'x', 0, 'y', 0, 'side', 0))"
    placed = placed.withColumn("beside", F.expr(beside)).withColumn("spots", F.expr(f"CASE WHEN layout IS NULL THEN {one} ELSE {spots} END"))
    return placed.select("id", "d1", "d2", "family", "copies", "spots").where("size(spots) > 0")


def _core_links(banded: DataFrame) -> DataFrame:
    """(id, root, links) of the members of a core: each is linked with all the others."""
    core = banded.where("band = 0")
    whole = core.groupBy("family").agg(F.sum("copies").alias("all"), F.count(F.lit(1)).alias("docs"), F.min("id").alias("root"))
    return core.join(whole.where("docs > 1"), "family").select("id", "root", (F.col("all") - F.col("copies")).alias("links"))


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, n_links.

    Two documents link when den * intersection >= num * union of their sets of
    word n-grams. component_id is the smallest id that links reach, n_links
    the number of other documents linked directly, equal sets included.
    Without words or text a set is empty and linked with nothing; with
    fewer words than an n-gram, the whole sequence is one n-gram. Rows that
    repeat an id are one node. A null id links nobody; its component is that of
    its equal sets, or null. Ids must be integers. An empty table gives no rows; texts of any
    length are compared whole. Links of exactly the threshold count. Only the two named
    columns are read, so other columns may have any name.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    profile = stored(_profile(docs, "doc_id", "text", words, num, den), "profile")
    light = stored(profile.select("doc_id", "n", "d1", "d2"), "light")
    classes = light.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes, "classes")

    # one document of each class speaks for it; a copy that gets past the bitmap only costs time
    voices = bitmap(classes.select(F.xxhash64("id", "d1", "d2").alias("voice")), "voice", bits_for(classes.count()))
    speaking = profile.where("n > 0 and doc_id is not null").select("doc_id", F.xxhash64("doc_id", "d1", "d2").alias("voice"), "keys", "per", "spoiled")
    keys = arrow_map(speaking, _keys(voices), "id long, key long")
    shared = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("seen")).where("seen > 1"), "shared")
    release(spark)
    tiers = [bitmap(own, "key", bits_for(own.count())) for own in (shared.where(F.col("seen") > least) for least in TIERS)]
    meets = stored(arrow_map(speaking, _keys(voices, tiers), "id long, key long").join(shared.select("key"), "key").distinct(), "meets")
    for own in (voices, *tiers):
        own.destroy()
    discard(profile, shared)
    release(spark)
    hubs = meets.groupBy("key").agg(F.min("id").alias("hub"))
    edges = meets.join(hubs, "key").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    families = connected_components(edges).select("id", F.col("component").alias("family"))
    met = edges.groupBy(F.col("b").alias("id")).agg(F.count(F.lit(1)).alias("met")).join(families, "id")
    hot = met.groupBy("family").agg(F.min(F.struct((-F.col("met")).alias("fewer"), "id")).alias("most")).where(F.col("most.fewer") < -1)
    of_hub = edges.join(hot.select("family", F.col("most.id").alias("b")), "b").select("family", F.col("a").alias("id"))
    sampled = of_hub.withColumn("place", F.row_number().over(Window.partitionBy("family").orderBy(F.xxhash64("id"), "id"))).where(F.col("place") <= SAMPLE)
    sampled = stored(sampled.select("family", "id"), "sampled")
    discard(meets)
    release(spark)

    # (id, n, copies) of the family members; a repeated id keeps each of its sets
    members = stored(families.join(classes, "id").select("id", "family", "n", "copies", "d1", "d2"), "members")
    n_members = members.count()
    if n_members:
        sets = stored(_sets(docs, members.select("id").distinct(), n_members, words), "sets")
        blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n") / BLOCK_GRAMS)).cast("int").alias("blocks")
        large = members.groupBy("family").agg(blocks).where("blocks > 1")
        banded = stored(_banded(members.join(large, "family"), large, sampled, sets, num, den), "banded")
        dealt = stored(_dealt(members, banded, blocks, num, den), "dealt")
        discard(members, sampled)
        paired = sets.join(dealt, ["id", "d1", "d2"]).select("id", "family", "copies", "d1", "d2", F.explode("spots").alias("spot"), "grams").select("id", "family", "copies", "d1", "d2", "spot.*", "grams")
        paired = paired.groupBy("family", "a", "b", "x", "y").applyInArrow(_links(num, den), "id long, root long, links long")
        links = stored(paired.unionByName(_core_links(banded)), "links")
        discard(dealt, sets, banded)
        release(spark)
        groups = connected_components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
        counts = links.groupBy("id").agg(F.sum("links").alias("links"))
        classes = stored(classes.join(groups, "id", "left").join(counts, "id", "left"), "linked")
    else:
        classes = classes.withColumns({"component": F.lit(None).cast("long"), "links": F.lit(None).cast("long")})
    of = classes.select("d1", "d2", "n", F.coalesce("component", "id").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = light.where("n > 0").join(of, ["d1", "d2", "n"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id", "n_links")
    return out.unionByName(light.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """docs with one row of each group of linked documents, the one of smallest id.

    Columns stay as they are and may have any name. Empty texts and null ids are linked with
    nothing and stay; of rows that repeat an id all stay or all go.
    """
    with noting() as made:
        groups = jaccard_join(docs, id_col, text_col, words, num, den)
    gone = stored(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "gone")
    discard_paths(docs.sparkSession, made)
    release(docs.sparkSession)
    # ids of 8 bytes: texts are shuffled only where too many of them go
    small = F.broadcast(gone) if gone.count() <= MAX_BROADCAST else gone
    return docs.join(small, docs[id_col] == small["__gone"], "left_anti")
