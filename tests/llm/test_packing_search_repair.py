"""Packing, ranked search and conversation repair against brute force."""

import heapq
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pressline.llm import conversation_repair as C
from pressline.llm import packing, queries, ranked_search

SF, TOKENS = "/root/testdata/sf0.001", public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, length long, piece int"


def placed(plan, counts):
    """sequence -> (offset, length) of every piece that a plan places."""
    filled: dict[int, list] = {}
    for length, n in counts.items():
        own = sorted((tuple(map(int, p)) for p in plan if p[0] == length), key=lambda p: p[1])
        for rank in range(n):
            _, first, start, per, offset = max((p for p in own if p[1] <= rank), key=lambda p: p[1])
            filled.setdefault(start + (rank - first) // per, []).append((offset + (rank - first) % per * length, length))
    return filled


@pytest.mark.parametrize("capacity", [10, 64, 2048])
def test_plan_is_best_fit_decreasing(capacity):
    r = random.Random(capacity)
    for _ in range(20):
        counts = {r.randint(1, capacity): r.randint(1, 40) for _ in range(r.randint(1, 60))}
        filled = placed(packing.plan(counts, capacity), counts)
        assert sorted(filled) == list(range(len(filled)))
        for own in filled.values():
            own.sort()
            assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(n for _, n in own) <= capacity
        spaces: list[int] = []
        for length in sorted((n for n, k in counts.items() for _ in range(k)), reverse=True):
            fitting = [i for i, s in enumerate(spaces) if s >= length]
            if fitting:
                spaces[min(fitting, key=spaces.__getitem__)] -= length
            else:
                spaces.append(capacity - length)
        assert len(spaces) == len(filled)


def test_plan_does_not_grow_with_the_counts():
    few = {n: 1 for n in range(1, 2049)}
    assert len(packing.plan({n: 10**9 + n for n in few})) <= 3 * 2048 * 64


TEXTS = [None, "", " \n", "One two, three.", "don't <|endoftext|> x's 12,345", "É́t\xa0é ΑΣ ẞ ﬁ", "naïve façade. Ünï" * 5, "a" * 5000, "word " * 3000, "Plain words and more. " * 400, "x\x1cy z", "한글 漢字 🙂🙂"]


def test_packing_places_every_piece(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 7)
    rows = [(i, t, 1, 2) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 1, 2), (None, "no id", 1, 2)] + [(100 + i, "same length here", 1, 2) for i in range(60)]
    got = packing.pack(spark.createDataFrame(rows, DOCS), TOKENS, 64).collect()
    model = Tokenizer.from_file(TOKENS)
    want, total = [], 0
    for i, text, *_ in rows:
        ids = np.array([*model.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        total += len(ids)
        want += [(i, a // 64, a, min(64, len(ids) - a), zlib.crc32(ids[a : a + 64].tobytes())) for a in range(0, len(ids), 64)]
    key = lambda x: (x[0] is None, x)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == sorted(want, key=key)
    sequences: dict[int, list] = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0, *(n for _, n in own)])[:-1]) and sum(own[-1]) <= 64
    assert len(sequences) <= -(-total // 64) * 11 / 9 + 1
    assert packing.pack(spark.createDataFrame([], DOCS), TOKENS).count() == 0


def test_packing_without_the_memo_of_words(monkeypatch):
    memo = packing._Ids(open(TOKENS, encoding="utf-8").read())
    assert memo.words and memo.plain
    whole = packing._Ids(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read())
    assert not whole.words  # white space matters there: texts are tokenized whole
    monkeypatch.setattr(packing, "MEMO_WORDS", 3)
    texts = [t.encode() for t in TEXTS if t]
    for model in (memo, whole):
        for text in texts:
            model.learn([text])
            assert model.of(text).tolist() == model.model.encode(text.decode(), add_special_tokens=False).ids


def cost_of(values, ends):
    return sum(ranked_search.BLOCK_COST + (b - a) * max(values[a:b]) for a, b in zip([0, *ends[:-1]], ends))


def test_blocks_have_the_least_bound_error():
    r = np.random.default_rng(1)
    for _ in range(20):
        offsets = np.concatenate([[0], np.cumsum(r.integers(1, 60, 6))])
        values = r.integers(1, 10**6, offsets[-1])
        ends = ranked_search.block_ends(values, offsets).tolist()
        assert set(offsets[1:].tolist()) <= set(ends)
        best = 0
        for a, b in zip(offsets, offsets[1:]):
            least = [0]
            for j in range(1, b - a + 1):
                least.append(min(least[i] + ranked_search.BLOCK_COST + (j - i) * values[a + i : a + j].max() for i in range(j)))
            best += least[-1]
        assert cost_of(values.tolist(), ends) == best
    assert ranked_search.block_ends(np.zeros(0, np.int64), np.array([0])).tolist() == []


def search_sql(docs, items):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", items)
    return [tuple(r) for r in con.sql(ranked_search.SEARCH_SQL).order("item_id nulls last, rank").fetchall()]


def search_spark(spark, docs, items):
    index = ranked_search.build_index(spark.createDataFrame([(i, t, 5, "t") for i, t in docs], "doc_id long, text string, held long, term string"))
    found = ranked_search.search(index, spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, shard int"))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return [tuple(r) for r in found.orderBy(F.col("item_id").asc_nulls_last(), "rank").collect()]


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", 40)
    monkeypatch.setattr(ranked_search, "FIRST_SHARDS", 2)
    monkeypatch.setattr(ranked_search, "BLOCK_COST", 300_000)
    r = random.Random(5)
    words = ["the", "of", "Über", "naïve", "x1", "日本", *("".join(r.choice("abc") for _ in range(k)) for k in (2, 3, 4) for _ in range(12))]
    weights = [1 / (i + 1) for i in range(len(words))]
    text = lambda most: r.choice(" ,-\n").join(w.upper() if r.random() < 0.2 else w for w in r.choices(words, weights, k=r.randint(0, most)))
    docs = [(i, text(r.choice((3, 30, 200)))) for i in range(400)] + [(1000 + i, "the same text of all") for i in range(80)] + [(2000, None), (2001, ""), (2002, "?!"), (None, "the null id naïve"), (7, "the naïve repeat of 7")]
    items = [(i, text(12)) for i in range(12)] + [(90, None), (91, ""), (92, "nothing of this occurs"), (93, "the"), (None, "naïve x1"), (93, "of")]
    want = search_sql(docs, items)
    assert search_spark(spark, docs, items) == want and len(want) > 400
    monkeypatch.setattr(ranked_search, "QUERY_BYTES", 200)  # several blocks of queries
    assert search_spark(spark, docs, items) == want


def test_search_of_empty_tables(spark):
    assert search_spark(spark, [], [(1, "a")]) == [] and search_spark(spark, [(1, "a")], []) == [] and search_spark(spark, [(1, None)], [(1, "a")]) == []


def cheapest(rows):
    """Least (cost, audit, rows) over all edit strings, in order of cost and then of letters."""
    heap, seen, done = [(0, "", 0, "", ())], set(), None
    while heap:
        cost, audit, i, roles, kept = heapq.heappop(heap)
        if done and cost > done[0]:
            break
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles) and (done is None or (cost, audit) < done[:2]):
            done = (cost, audit, kept)
        if (i, roles[-1:], audit) in seen or not re.fullmatch(r"s?(ua)*u?", roles):
            continue
        seen.add((i, roles[-1:], audit))
        both = (("u", "user"), ("a", "assistant"))
        if audit.count("I") < len(rows) + 2:
            for initial, role in both:
                heapq.heappush(heap, (cost + 5, audit + "I", i, roles + initial, (*kept, (role, ""))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, roles, kept))
            if rows[i].fault not in ("blank", "duplicate"):
                more = cost + (5 if rows[i].fault == "truncated" else 0)
                heapq.heappush(heap, (more, audit + "K", i + 1, roles + (rows[i].role[:1] or "-"), (*kept, (rows[i].role, rows[i].text))))
                for initial, role in both:
                    heapq.heappush(heap, (more + 1, audit + "R", i + 1, roles + initial, (*kept, (role, rows[i].text))))
    return done


def test_repair_equals_exhaustive_search():
    r = random.Random(3)
    for _ in range(250):
        rows = [C.Row(i, r.choice(["user", "assistant", "system", "tool", "", "user", "assistant"]), r.choice(["Hi.", "Yes", "", "No!", "ok?", " \t"]) + (f"{i}." if r.random() < 0.5 else "")) for i in range(r.randint(0, 5))]
        C.find_faults(rows)
        done = C.repair(rows)
        assert (done.cost, done.audit, tuple(done.rows)) == cheapest(rows)


CHATS = "conv_id long, turn long, role string, text string, dropped int, cost string"


def repaired(spark, rows, damaged=False):
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], CHATS)
    if damaged:
        d = C.damage(df)
        return C.repair_conversations(d, dropped=d["dropped"])
    return C.repair_conversations(df)


def test_repair_equals_sql_with_odd_rows(spark):
    r = random.Random(9)
    texts = ["Hello there.", "And now", "Why?", None, "", " \n", "Done!", "Hello there.", "üñ. "]
    rows = [(c, r.choice([None, *range(9)]) if c % 7 == 0 else t, r.choice(["user", "assistant", "system", None, "tool"] if c % 3 == 0 else ["user", "assistant"]), r.choice(texts)) for c in range(60) for t in range(r.randint(1, 9))]
    rows += [(None, t, "user", "null id.") for t in range(3)] + [(5, 1, "user", "Twice.")] * 2
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = con.sql(C.REPAIR_SQL)
    got = repaired(spark, rows, damaged=True)
    assert got.columns == want.columns
    assert sorted(map(repr, (tuple(x) for x in got.collect()))) == sorted(map(repr, want.fetchall()))


def test_repair_of_one_long_conversation_and_empty_table(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"Text {t}.") for t in range(3000)] + [(2, 0, "user", "Only this.")]
    got = {x.conv_id: x for x in repaired(spark, rows).collect()}
    assert (got[1].cost, got[1].audit, got[1].n_repaired) == (0, "K" * 3000, 3000) and (got[2].cost, got[2].audit) == (2, "D")
    assert repaired(spark, []).count() == 0


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_conversation_repair"])
def test_new_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    assert sorted(repr([r[c] for c in order]) for r in got.collect()) == sorted(repr([dict(zip(want.columns, r))[c] for c in order]) for r in want.fetchall())


def test_packing_query(spark):
    rows = queries.QUERIES["op11_best_fit_packing"](spark, SF).collect()
    tokens = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= -(-tokens // 2048) + 2
