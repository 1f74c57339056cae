"""Chats, urls, mixing, toxicity, decontamination and the pipeline."""

import math
import random
import re
import zlib

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pressline.llm import chat_format, decontaminate, mixing, toxicity, url_filter
from pressline.llm.queries import ORACLE, QUERIES
from test_dedup import brute_jaccard

SF = "/root/testdata/sf0.001"
TABLES = "documents labels pages conversations benchmark".split()


@pytest.mark.parametrize("name", ["op3_jaccard_join", "op4_chat_formatting", "op5_source_mixing", "op7_url_filter", "op9_exact_dedup"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df, want = QUERIES[name](spark, SF), con.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(want.columns)
    show = lambda r: repr([round(r[c], 6) if isinstance(r[c], float) else r[c] for c in sorted(df.columns)])
    assert sorted(map(show, df.collect())) == sorted(show(dict(zip(want.columns, r, strict=True))) for r in want.fetchall())


CHATS = "conv_id long, turn long, role string, text string, formatted string"


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] x [/INST]", "\\", "\\[INST]", "<<SYS>>\\\\", "<role:user>hi</role>", "a\nb", "", None, "é😀" * 50, "[" * 2000, "\\" * 3001]
    rows = [(c, t, role, text, "") for c, role in enumerate(("user", "assistant", "system", "tool", "we<ird>", None)) for t, text in enumerate(nasty)]
    got = {r.conv_id: r for r in chat_format.format_chats(spark.createDataFrame(rows, CHATS)).withColumn("back", chat_format.read_back(F.col("formatted"))).collect()}
    for c, role in enumerate(("user", "assistant", "system", "tool", "we<ird>", "")):
        assert [(b.role, b.text) for b in got[c].back] == [(role, t or "") for t in nasty]
    digest = {r.conv_id: r for r in chat_format.chat_digest(chat_format.format_chats(spark.createDataFrame(rows, CHATS))).collect()}
    assert digest[1].loss_chars == sum(len(t or "") for t in nasty) and digest[0].loss_chars == 0


def test_chat_state_machine_ties_and_empty(spark):
    orders = {0: "user,assistant", 1: "system,user", 2: "assistant", 3: "user,user", 4: "system,assistant", 5: "user,assistant,user,assistant", 6: "system", 7: "user,tool"}
    rows = [(c, t, role, "t", "") for c, o in orders.items() for t, role in enumerate(o.split(","))]
    df = spark.createDataFrame(rows, CHATS)
    want = {0: True, 1: True, 2: False, 3: False, 4: False, 5: True, 6: True, 7: False}
    assert {r.conv_id: r.valid for r in chat_format.format_chats(df.repartition(3)).collect()} == want
    tie = spark.createDataFrame([(1, 0, "user", "b", ""), (1, 0, "user", "a", ""), (1, None, "user", "n", ""), (None, 0, "user", "z", "")], CHATS)
    assert {r.conv_id: sorted(t.text for t in r.turns) for r in chat_format.format_chats(tie).collect()} == {1: ["a", "b", "n"], None: ["z"]}
    assert chat_format.chat_digest(chat_format.format_chats(df.limit(0))).count() == 0


def test_chat_null_turn_comes_first(spark):
    rows = [(1, 1, "user", "b", ""), (1, None, "user", "n", ""), (1, 0, "assistant", "a", "")]
    got = chat_format.format_chats(spark.createDataFrame(rows, CHATS).repartition(3)).first()
    assert [t.text for t in got.turns] == ["n", "a", "b"]
    con = duckdb.connect()
    con.sql("create table conversations as select * from (values (1, 1, 'user', 'b'), (1, null, 'user', 'n'), (1, 0, 'assistant', 'a')) t(conv_id, turn, role, text)")
    want = con.sql(f"select turns_sha256 from ({ORACLE['op4_chat_formatting']}) where conv_id = 1").fetchall()[0][0]
    assert chat_format.chat_digest(chat_format.format_chats(spark.createDataFrame(rows, CHATS))).first().turns_sha256 == want


def test_url_rules_of_equal_length_and_long_urls(spark):
    rules = [("a.com", "/xx/", "block"), ("b.a.com", "/x", "allow"), ("c.com", "/p", "allow"), ("c.com", "/p", "block")]
    long = "http://" + "s." * 3000 + "c.com/p" + "/q" * 20000
    urls = ["http://b.a.com/xx/1", "http://c.com/p", long, "http://b.a.com/x", None, "no url", "://"]
    pages = spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(urls)], "page_id long, url string, rule string, verdict string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect()}
    # equal length: the shorter host; equal rules: the first
    assert got == {0: ("a.com/xx/", "block"), 1: ("c.com/p", "allow"), 2: ("c.com/p", "allow"), 3: ("b.a.com/x", "allow"), 4: (None, "allow"), 5: (None, "allow"), 6: (None, "allow")}
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_urls(spark):
    cases = {
        "http://Example.COM/en/7817?x": ("example.com", "/en/7817", "example.com/en/7", "allow"),
        "https://a.example.com/en/6": ("a.example.com", "/en/6", "com/en/", "block"),
        "http://notexample.com/en/7": ("notexample.com", "/en/7", "com/en/", "block"),
        "x://com/en/": ("com", "/en/", "com/en/", "block"),
        "http://com/en": ("com", "/en", None, "allow"),
        "http://a.net/de/8?": ("a.net", "/de/8", "net/de/", "allow"),
        "http://m.example.net/de/80": ("m.example.net", "/de/80", "example.net/de/8", "block"),
        "http://a.org#/es/": ("a.org", "", None, "allow"),
        "a.org/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    rows = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)] + [(None, "http://x.org/es/", "h"), (0, "http://x.org/es/", "h")], "page_id long, url string, host string")
    got = url_filter.judge_urls(rows).collect()
    assert len(got) == len(cases) + 2
    by_id = {}
    for r in got:
        by_id.setdefault(r.page_id, []).append((r.host, r.path, r.rule, r.verdict))
    for i, want in enumerate(cases.values()):
        assert want in by_id[i]
    assert by_id[None] == [("x.org", "/es/", "org/es/", "block")]
    assert url_filter.judge_urls(rows.limit(0)).count() == 0


def test_trie_equals_plain_rules():
    r = random.Random(4)
    hosts, paths = ["com", "a.com", "b.a.com", "net"], ["/", "/x", "/x/", "/x/y", "/xy", ""]
    rules = [(h, p, v) for h in hosts for p in paths for v in ("allow", "block") if r.random() < 0.3]
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    trie = url_filter.build_trie(rules)
    for host in ["a.com", "c.b.a.com", "xa.com", "net", ""]:
        for path in ["", "/", "/x", "/x/y/z", "/xyz", "/x/"]:
            fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
            want = max(fits, key=lambda f: len(f[0]), default=None)
            assert (url_filter.lookup(trie, host, path) or (None,))[0] == (want or (None,))[0]


def test_mixing_by_plain_loop(spark):
    r = random.Random(5)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 40))), r.choice(["a", "b", "c", "d", None]), i) for i in range(400)] + [(999, None, "empty", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = {x.doc_id: x for x in mixing.mix(docs).collect()}
    size = {i: len((t or "").split()) for i, t, *_ in rows}
    source = {i: s for i, _, s, _ in rows}
    names = sorted({s for s in source.values() if s is not None}) + [None]
    total = {s: sum(size[i] for i in size if source[i] == s) for s in names}
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(total.values()))
    while True:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= 3 * total[s]]
        if not over:
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= target[s]
            open_.discard(s)
    target |= {s: level * weight[s] for s in open_}
    for s in names:
        own = [i for i in size if source[i] == s]
        taken = sum(got[i].taken for i in own)
        assert abs(taken - target[s]) <= max((size[i] for i in own), default=0) / 2 + 1e-6
        for i in own:
            assert abs(got[i].target - target[s]) < 1e-6 and got[i].size == size[i] and got[i].source_size == total[s]
            assert got[i].taken <= 3 * size[i] and (size[i] == 0 or got[i].taken % size[i] == 0)
    assert {x.doc_id: x.taken for x in mixing.mix(docs.repartition(7)).collect()} == {i: x.taken for i, x in got.items()}
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_spreads_documents_without_id(spark):
    docs = spark.createDataFrame([(None, f"w{i} x", "s" if i < 600 else "t") for i in range(660)], "doc_id long, text string, source string")
    rows = mixing.mix(docs).collect()
    some = [r.taken for r in rows if r.source_size == 1200]
    # s holds a tenth too much: its documents are told apart by their texts
    assert len(rows) == 660 and 0 < sum(t == 0 for t in some) < 600 and abs(sum(some) - next(r.target for r in rows if r.source_size == 1200)) <= 2


def test_mixing_prefers_quality(spark):
    # t takes three epochs of its 200 documents, s some six tenths of one
    docs = spark.createDataFrame([(i, "a b", "s" if i < 1000 else "t") for i in range(1200)], "doc_id long, text string, source string")
    quality = spark.createDataFrame([(i, i % 2) for i in range(1200)], "doc_id long, quality int")
    rows = [x for x in mixing.mix(docs, quality).collect() if x.doc_id < 1000]
    high = sum(x.taken > 0 for x in rows if x.doc_id % 2)
    low = sum(x.taken > 0 for x in rows if x.doc_id % 2 == 0)
    assert 500 < high + low < 700 and high > 1.3 * low


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, labels)
    assert scored.count() == docs.count()
    held = scored.join(labels, "doc_id").where("held_out").select("score", "toxic").collect()
    toxic, clean = [r.score for r in held if r.toxic], [r.score for r in held if not r.toxic]
    auc = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.9
    assert sum(s >= 0.5 for s in clean) <= 0.02 * len(clean)


def plain_ftrl(rows):
    """FTRL-proximal with features kept apart by name. rows: (text, label) in order. Function text -> score."""
    def features(text):
        w = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()
        return {(a,) for a in w} | {(1, a, b) for a, b in zip(w, w[1:])} | {(2, a, b) for a, b in zip(w, w[2:])} | {()}

    z, n = {}, {}

    def weight(f):
        if abs(z.get(f, 0.0)) <= (toxicity.L1 if f else 0.0):
            return 0.0
        sign = 1 if z[f] > 0 else -1
        return -(z[f] - sign * (toxicity.L1 if f else 0.0)) / ((toxicity.BETA + n[f] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for text, label in rows:
            own = {f: weight(f) for f in features(text)}
            g = 1 / (1 + math.exp(-sum(own.values()))) - label
            for f, w in own.items():
                old = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - ((old + g * g) ** 0.5 - old**0.5) / toxicity.ALPHA * w
                n[f] = old + g * g
    return lambda text: 1 / (1 + math.exp(-sum(map(weight, features(text)))))


def test_toxicity_equals_plain_ftrl(spark):
    r = random.Random(12)
    say = lambda bad: " ".join(r.choice(["you", "are", "a", "day", "tree", "River,", "blue"] + ["idiot!", "fool"] * bad) for _ in range(r.randint(3, 12)))
    texts = [(i, say(i % 3 == 0)) for i in range(300)] + [(300, ""), (301, "idiot"), (302, "nothing known Here")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    order = {x.id: x.order for x in docs.select(F.col("doc_id").alias("id"), F.xxhash64("doc_id", F.lit(7)).alias("order")).collect()}
    learn = sorted((i for i in range(300) if zlib.crc32(str(i).encode()) % 5), key=lambda i: (order[i], i))
    score = plain_ftrl([(texts[i][1], int(i % 3 == 0)) for i in learn])
    got = {x.doc_id: x for x in toxicity.score_toxicity(docs, labels).collect()}
    for i, t in texts:
        assert abs(got[i].score - score(t)) < 1e-5 and got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0), (i, t)
    assert {got[i].predicted for i, _ in texts} == {0, 1}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "idiot"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert all(r.predicted == 0 and 0 < r.score < 0.5 for r in got) and toxicity.drop_toxic(docs, labels).count() == 2


def test_toxicity_odd_rows(spark):
    docs = spark.createDataFrame([(i, "a bad idiot here" if i % 2 else "a fine day here", "") for i in range(200)] + [(500, None, ""), (501, "", ""), (None, "idiot", ""), (1, "a bad idiot here", ""), (502, "idiot " * 50000, "")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(docs, labels).collect()
    assert len(got) == 205 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.predicted == r.doc_id % 2 for r in got if r.doc_id is not None and r.doc_id < 200)
    left = toxicity.drop_toxic(docs, labels)
    assert left.columns == docs.columns and left.where("text like '%fine%'").count() == 100 and left.where("text like '%bad%'").count() == 0
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == 205 and toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def edit_distance_in(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_decontamination_equals_edit_distance(spark):
    r = random.Random(6)
    alphabet = "abcdefghij klmno "
    items = [" ".join("".join(r.choice(alphabet) for _ in range(r.randint(60, 200))).split()) for _ in range(8)]
    texts = []
    for k in range(60):
        passage = list(r.choice(items))
        for _ in range(r.randint(0, 14)):
            at = r.randrange(len(passage))
            passage[at : at + 1] = r.choice([[], ["z"], [passage[at], "q"]])
        texts.append("".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) + "".join(passage).upper() + "  \n" + "".join(r.choice(alphabet) for _ in range(r.randint(0, 80))))
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate([*texts, None, "", "x" * 50000])], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(i, t) for i, t in enumerate([*items, items[0], "too short", None])], "item_id long, text string")
    want = set()
    for i, t in enumerate(texts):
        for k, item in enumerate(items):
            a, b = decontaminate.normal(item.encode()), decontaminate.normal(t.encode())
            if len(a) >= decontaminate.Q and edit_distance_in(a, b) <= int(len(a) * decontaminate.EDIT_RATE):
                want.add((i, k))
    got = {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs, bench).collect()}
    assert got == want and 10 < len(want) < 60
    left = decontaminate.drop_leaks(docs, bench)
    assert left.columns == docs.columns and {x.doc_id for x in left.collect()} == set(range(63)) - {i for i, _ in want}
    assert decontaminate.drop_leaks(docs, bench.limit(0)).count() == 63 and decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_decontamination_short_items(spark):
    items = ["seven plus five is what", "name the red planet of mars now", "what is a quark", "+ 12 is how much?", "tiny", "", "what is the capital of old france"]
    texts = ["x Seven  plus five is what y", "x seven plus fibe is what y", "x seven plus fibe is whot y", "name the rd planet of marz now", "So: what is a QUARK?", "what is a quarks", "awhat is a quark", "what is a qvark", "9+ 12 is how much?so", "tiny", "what is a quarks what is a quark", "what is teh capital of old france"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(0, 0), (1, 0), (3, 1), (4, 2), (8, 3), (10, 2), (11, 6)}
    assert {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs, bench).collect()} == want | {(9, 4)}
    assert {x.doc_id for x in decontaminate.drop_leaks(docs, bench).collect()} == set(range(12)) - {i for i, _ in want}
    assert {x.doc_id for x in decontaminate.drop_leaks(docs, bench, least=1).collect()} == set(range(12)) - {i for i, _ in want} - {9}
    assert [x.item_id for x in decontaminate.unsearched(bench).collect()] == [5]


def test_decontamination_items_of_any_length():
    r = random.Random(8)
    word = lambda c: c.isalnum() or c == "_"
    for n in [*range(1, 61), 75, 120]:
        item = "".join(r.choice("abcdefghijklmnop") for _ in range(n))
        most = min(int(n * decontaminate.EDIT_RATE), max(0, n // decontaminate.Q - 1))
        index = decontaminate.Index([(n, item.encode())])
        for _ in range(12):
            own = list(item)
            for _ in range(r.randint(0, most + 2)):
                at = r.randrange(len(own)) if own else 0
                own[at : at + 1] = r.choice([[], ["z"], [*own[at : at + 1], "y"]])
            left, right = (r.choice(["", " q ", " ", "x", "7.", "ww w"]) for _ in range(2))
            text = decontaminate.normal((left + "".join(own) + right).encode()).decode()
            if most:
                want = edit_distance_in(item, text) <= most
            else:
                starts = [i for i in range(len(text)) if text.startswith(item, i)]
                want = any((not i or not word(text[i - 1])) and (i + n == len(text) or not word(text[i + n])) for i in starts)
            assert bool(index.search(text.encode())) == want == index.leaks(text.encode()), (n, item, text)


def test_decontamination_of_a_text_that_repeats_itself(monkeypatch):
    index = decontaminate.Index([(1, b"a" * 200), (2, b"ab" * 60), (3, b"c" * 300)])
    assert index.nbytes() < 2 * (1 << decontaminate.BLOOM_BITS)
    text = b"a" * 1_000_000
    assert sum(len(at) <= decontaminate.HITS + 200 for at, *_ in index.hits(text)) == sum(1 for _ in index.hits(text))
    found = index.search(text)
    assert len(found) == 5000 and index.leaks(text) and not index.leaks(b"d" * 1_000_000)
    whole = index.search(b"x" + b"a" * 1500 + b"y")
    monkeypatch.setattr(decontaminate, "PIECE", 64)
    monkeypatch.setattr(decontaminate, "HITS", 50)
    assert index.search(b"x" + b"a" * 1500 + b"y") == whole


def test_decontamination_finds_every_region(spark):
    item = "the quick brown fox jumps over the lazy dog and runs away from the farm"
    near = item.replace("jumps", "jumpt")
    texts = [f"a {item} b {near} c {item}", near + item, item + item, f"{item[:40]} {item[30:]}", "x" * 1000, "why not, why not ask and  why not ask"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(0, item), (1, "x" * 100), (2, "why not ask")], "item_id long, text string")
    got = [tuple(x) for x in decontaminate.find_leaks(docs, bench).collect()]
    n = len(item)
    want = [(0, 0, 2, n + 2, 0), (0, 0, n + 5, 2 * n + 5, 1), (0, 0, 2 * n + 8, 3 * n + 8, 0), (1, 0, 0, n, 1), (1, 0, n, 2 * n, 0), (2, 0, 0, n, 0), (2, 0, n, 2 * n, 0)]
    want += [(4, 1, 100 * i, 100 * i + 100, 0) for i in range(10)] + [(5, 2, 9, 20, 0), (5, 2, 25, 36, 0)]
    assert sorted(got) == want


def test_decontamination_in_parts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "PART_BYTES", 150)
    items = [f"item {c} " + c * 60 for c in "abcd"]
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in enumerate(items)] + [(9, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in decontaminate.find_leaks(docs, bench).collect()} == {(i, i) for i in range(4)}
    assert [x.doc_id for x in decontaminate.drop_leaks(docs, bench).collect()] == [9]


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]
    rows = {r.doc_id: r for r in docs.collect()}
    left = docs
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    for name, stage in P.STAGES[:-1]:
        before = {r.doc_id for r in left.collect()}
        left = stage(spark, left, SF)
        after = {r.doc_id for r in left.collect()}
        assert left.columns == docs.columns and after <= before
        if name == "toxicity":
            assert toxic and after == before - toxic
        if name == "ngram_jaccard_join":
            ids = sorted(before)
            near = brute_jaccard([rows[i].text for i in ids], 5, 8, 10)
            assert after == {i for k, i in enumerate(ids) if near[k][1] == k}
        if name == "exact_dedup":
            last = {}
            for i in before:
                last[rows[i].text] = max(i, last.get(rows[i].text, i))
            assert after == set(last.values())
        if name == "benchmark_decontamination":
            items = [re.sub(r"\s+", " ", r.text.lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            exact = {i for i in before if any(t in re.sub(r"\s+", " ", rows[i].text.lower()) for t in items)}
            assert exact and not exact & after and len(before) - len(after) <= len(exact) + 1
    mixed = {r.doc_id: r.taken for r in P.run(spark, SF).collect()}
    con = duckdb.connect()
    con.register("kept", pa.table({"doc_id": pa.array([r.doc_id for r in left.collect()], pa.int64())}))
    con.sql(f"create view documents as select * from '{SF}/documents.parquet' where doc_id in (select doc_id from kept)")
    con.sql(f"create view labels as select * from '{SF}/labels.parquet'")
    assert mixed == dict(con.sql(f"select doc_id, taken from ({mixing.MIX_SQL})").fetchall()) and sum(mixed.values()) > 0


def test_pipeline_stages_take_odd_rows(spark):
    import corpus_pipeline as P

    schema = "doc_id long, text string, lang string, source string, n_chars int, __gone string, spans string, id int"
    say = " ".join(f"w{i}" for i in range(40))
    odd = [(1, None), (2, ""), (None, None), (None, say), (3, say), (3, say), (4, say + " x"), (5, "idiot " * 30000), (6, "é" * 50000), (7, " \t\n"), (8, "short")]
    docs = spark.createDataFrame([(i, t, None, None if (i or 0) % 2 else "s", 1, "g", "s", 9) for i, t in odd], schema)
    for empty in (False, True):
        left = docs.limit(0) if empty else docs
        for name, stage in P.STAGES:
            left = stage(spark, left, SF)
            if name != "source_mixing":
                assert left.columns == docs.columns, name
        got = [(r.doc_id, r.size) for r in left.collect()]
        if empty:
            assert not got
        else:
            # equal texts: the largest id; near copies: the smallest; blanks are no words
            assert {(3, 40), (2, 0), (7, 0), (8, 1), (6, 1)} <= set(got) and not {1, 4} & {i for i, _ in got} and got.count((3, 40)) == 1
