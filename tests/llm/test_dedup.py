"""Exact, near and substring deduplication against brute force."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pressline.llm import exact_dedup, jaccard_join, substring_dedup

DOCS = "doc_id long, text string, name string"


def rows_of(spark, texts, ids=None):
    return spark.createDataFrame([(i if ids is None else ids[i], t, "x") for i, t in enumerate(texts)], DOCS)


def random_texts(seed, n=60):
    r = random.Random(seed)
    parts = ["".join(r.choice("ab ") for _ in range(k)) for k in (1, 7, 64, 100, 300)]
    return [None, "", ""] + ["".join(r.choice(parts) for _ in range(r.randint(0, 6))) for _ in range(n)]


def check_exact(spark, texts, **options):
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    got = {r.doc_id: r for r in exact_dedup.exact_groups(rows_of(spark, texts), **options).collect()}
    for t, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(ids), len(ids), i == max(ids)), (t, got[i])
            assert got[i].text_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_exact_over_many_levels(spark):
    check_exact(spark, random_texts(1), block_bytes=16)


def test_exact_with_colliding_hashes(spark):
    check_exact(spark, random_texts(2, 30), block_bytes=16, hash_of=lambda c: F.length(F.rtrim(c.cast("string"))).cast("long") % 3)


def test_exact_long_text_umlauts_and_order(spark):
    check_exact(spark, ["ü" * 20000, "ü" * 20000, "ü" * 19999 + "u", "a" * 4096, "a" * 4097, "a" * 4096 + "\0"])


def test_exact_nulls_repeats_empty(spark):
    df = spark.createDataFrame([(1, "t", "a"), (1, "t", "b"), (None, "t", "c"), (2, "u", "d"), (1, "u", "e")], DOCS)
    got = sorted((r.doc_id or 0, r.text_sha256[:4], r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect())
    t, u = (hashlib.sha256(x).hexdigest()[:4] for x in (b"t", b"u"))
    assert got == sorted([(1, t, 1, 3, True), (1, t, 1, 3, True), (0, t, 1, 3, False), (2, u, 2, 2, True), (1, u, 2, 2, False)])
    left = exact_dedup.drop_copies(df)
    assert left.columns == ["doc_id", "text", "name"] and sorted((r.doc_id, r.text) for r in left.collect()) == [(1, "t"), (2, "u")]
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0 and exact_dedup.drop_copies(df.limit(0)).count() == 0


def brute_jaccard(texts, words, num, den):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    links = [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            inter = len(sets[i] & sets[j])
            if inter and den * inter >= num * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i), links[i]) for i, s in enumerate(sets)}


def near_texts(seed, n, length, edits):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    base = [[r.choice(vocab) for _ in range(length)] for _ in range(3)]
    out = []
    for _ in range(n):
        w = list(r.choice(base))
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = r.choice(vocab)
        out.append(" ".join(w[r.randint(0, 2) :]))
    return out + [None, "", "one", "One", "one two", "x " * 500, "X\t" * 400]


def check_near(spark, texts, words, num, den):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.jaccard_join(rows_of(spark, texts), words=words, num=num, den=den).collect()}
    assert got == brute_jaccard(texts, words, num, den)


def test_near_both_thresholds(spark):
    texts = near_texts(1, 60, 60, 5) + near_texts(2, 40, 12, 2)
    check_near(spark, texts, 3, 90, 100)
    check_near(spark, texts, 5, 8, 10)


def test_near_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 4)
    monkeypatch.setattr(jaccard_join, "FRAGMENT", 16)
    check_near(spark, near_texts(3, 50, 50, 6), 3, 8, 10)


def group_of_copies(seed, n, length, most):
    r = random.Random(seed)
    base = [r.choice("abcdefghijklmnopqrstuvwxyz") + str(r.randrange(500)) for _ in range(length)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randint(0, most)):
            own[r.randrange(length)] = f"x{r.randrange(50)}"
        out.append(" ".join(own + [f"y{r.randrange(9)}"] * r.randint(0, 3)))
    return out


def bands_of(spark, monkeypatch):
    """Counts of members by band, noted while jaccard_join runs."""
    dealt, bands = jaccard_join._dealt, {}

    def noted(members, banded, *rest):
        bands.update({r.band: r["count"] for r in banded.groupBy("band").count().collect()})
        return dealt(members, banded, *rest)

    monkeypatch.setattr(jaccard_join, "_dealt", noted)
    return bands


@pytest.mark.parametrize(("words", "num", "den", "most"), [(3, 90, 100, 3), (5, 8, 10, 8)])
def test_near_group_larger_than_a_block(spark, monkeypatch, words, num, den, most):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 8)
    bands = bands_of(spark, monkeypatch)
    check_near(spark, group_of_copies(most, 90, 150, most) + near_texts(4, 20, 60, 4)[:20], words, num, den)
    assert bands[0] > 5 and bands[1] > 5


def test_near_group_shares_of_the_work(spark, monkeypatch):
    """Copies close to the pivot are counted, not paired: what is dealt grows with the table."""
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 16)
    spots, dealt = [], jaccard_join._dealt

    def noted(*args):
        out = dealt(*args)
        spots.append(sum(len(r.spots) for r in out.select("spots").collect()))
        return out

    monkeypatch.setattr(jaccard_join, "_dealt", noted)
    for n in (100, 400):
        texts = [t + f" end{i}" for i, t in enumerate(group_of_copies(1, n, 200, 0))]
        got = jaccard_join.jaccard_join(rows_of(spark, texts)).collect()
        assert {(r.component_id, r.n_links) for r in got} == {(0, n - 1)}
    assert spots[1] <= 4 * spots[0]


def test_near_repeated_ids_in_a_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 8)
    texts = group_of_copies(8, 40, 150, 3)
    rows = [(i if i % 4 else i // 8, t, "n") for i, t in enumerate(texts)]
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(spark.createDataFrame(rows, DOCS)).collect()}
    plain = brute_jaccard(texts, 5, 8, 10)
    root = {}
    for i, (_, component, _) in plain.items():
        root.setdefault(component, set()).add(rows[i][0])
    groups = []
    for own in root.values():
        touching = [g for g in groups if g & own]
        groups = [g for g in groups if not g & own] + [own.union(*touching)]
    assert got == {i: min(g) for g in groups for i in g}


def test_near_keep_one_nulls_and_empty(spark):
    text = "a b c d e f g h i j"
    df = spark.createDataFrame([(5, text, "a"), (3, text, "b"), (None, text, "c"), (7, None, "d"), (8, "", "e"), (9, "other words are here now", "f")], DOCS)
    got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_join(df).collect()}
    assert got == {5: 3, 3: 3, None: 3, 7: 7, 8: 8, 9: 9}
    kept = jaccard_join.keep_one(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {3, None, 7, 8, 9}
    assert jaccard_join.jaccard_join(df.limit(0)).count() == 0


def test_near_repeated_id_keeps_each_text(spark):
    say = lambda c, k=20: " ".join(f"{c}{i}" for i in range(k))
    a, b, c = say("a"), say("b"), say("c")
    # 1: two texts, each with a near copy; 5: two texts near each other, both near 6; 9 is on its own
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (5, c), (5, c + " x"), (6, c + " y"), (9, say("d"))]
    df = spark.createDataFrame([(i, t, "n") for i, t in rows], DOCS).repartition(4)
    got = sorted((r.doc_id, r.component_id, r.n_links) for r in jaccard_join.jaccard_join(df).collect())
    assert got == [(1, 1, 2), (1, 1, 2), (2, 1, 1), (3, 1, 1), (5, 5, 1), (5, 5, 1), (6, 5, 1), (9, 9, 0)]


def brute_substrings(rows):
    seen, out = set(), {}
    for i, t in rows:
        b = (t or "").encode()
        hit = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                hit[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, h in zip(b, hit, strict=True) if not h)
        out[i] = (len(b), sum(hit), sum(1 for j, h in enumerate(hit) if h and (j == 0 or not hit[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


def repeat_texts(seed, n):
    r = random.Random(seed)
    parts = ["".join(r.choice("abü ") for _ in range(k)) for k in (60, 99, 100, 101, 130, 300)]
    return [None, "", "x" * 700, "ab" * 300] + ["".join(r.choice([r.choice(parts), r.choice(parts)[: r.randint(40, 130)], "".join(r.choice("cd") for _ in range(r.randint(0, 80)))]) for _ in range(r.randint(0, 7))) for _ in range(n)]


def shown(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_substrings_equal_brute_force(spark):
    texts = repeat_texts(5, 80)
    assert shown(substring_dedup.cut_repeats(rows_of(spark, texts).repartition(3))) == brute_substrings(list(enumerate(texts)))


def test_substrings_in_pieces_of_long_texts(spark, monkeypatch):
    texts = ["".join(random.Random(7).choice("abc") for _ in range(900)) * 3, "z" * 2500]
    monkeypatch.setattr(substring_dedup, "PIECE", 512)
    monkeypatch.setattr(substring_dedup, "RUN", 300)
    assert shown(substring_dedup.cut_repeats(rows_of(spark, texts))) == brute_substrings(list(enumerate(texts)))


def test_substrings_repeated_ids_and_empty(spark):
    a, b = "a1" * 60, "b2" * 60
    df = spark.createDataFrame([(1, a, ""), (1, a, ""), (2, b + a, ""), (None, b, "")], DOCS)
    got = sorted((r.doc_id or 99, r.n_bytes, r.n_removed) for r in substring_dedup.cut_repeats(df).collect())
    want = brute_substrings([(0, a), (1, a), (2, b + a), (3, b)])
    assert got == [(1, 120, want[0][1]), (1, 120, want[1][1]), (2, 240, want[2][1]), (99, 120, want[3][1])]
    assert substring_dedup.cut_repeats(df.limit(0)).count() == 0
    text = substring_dedup.cut_repeats(df, with_text=True).where("n_removed = n_bytes").first()
    assert bytes(text.kept) == b""
