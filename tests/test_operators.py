"""Operators on small pages; expected values by hand."""

import random

import pytest
from pyspark.sql import functions as F

from pressline.functions import headers, similarity
from pressline.functions.components import connected_components
from pressline.operators import articles as A
from pressline.operators import blocks as B
from pressline.operators import arrivals, corpus, correct, fusion, identity, issues, reports
from pressline.operators.names import alike_words, matching_names, word_candidates
from pressline.sources import providers, readers, writers
from pressline.sources import schemas as S
from pressline.streaming.index_table import IndexTable

WORDS = f"array<{S.WORD}>"


def lines_df(spark, rows):
    """rows: (line_no, text, confidence, x0, y0, x1, y1, words, source)"""
    return spark.createDataFrame([("i", 1, *r) for r in rows], f"issue_id string, page_number int, line_no int, text string, confidence double, x0 double, y0 double, x1 double, y1 double, words {WORDS}, source string")


def boxes_df(spark, rows):
    """rows: (box_no, label, position, x0, y0, x1, y1)"""
    return spark.createDataFrame([("i", 1, n, label, p, 0.5, *map(float, b), []) for n, label, p, *b in rows], S.LAYOUT_BOXES)


def line(n, x0, y0, x1, y1, words=None, text=None, source="surya", confidence=0.9):
    return (n, text or f"line {n}", confidence, float(x0), float(y0), float(x1), float(y1), words or [], source)


def test_j3_j4_words_and_no_box(spark):
    boxes = B.numbered_boxes(boxes_df(spark, [(0, "Text", 1, 0, 0, 100, 100), (1, "Picture", 2, 0, 0, 100, 100), (2, "Text", 0, 200, 0, 300, 100)]), S.PAGE_KEY)
    wide = [("w", [0.0, 0.0, 160.0, 10.0], 0.9)]
    rows = [line(0, 0, 0, 100, 10), line(1, 500, 500, 600, 510), line(2, 0, 20, 100, 30, wide), line(3, 210, 0, 290, 10), line(4, 60, 50, 140, 60)]
    got = {r.line_no: r.box_seq for r in B.assign_lines(lines_df(spark, rows), boxes, S.PAGE_KEY).collect()}
    # 0: text beats picture; 1: no box; 2: its words bleed; 3: box of position 0; 4: bleeds by 40 of 100
    assert got == {0: 2, 1: None, 2: None, 3: 1, 4: None}


def test_q1_block_id_collision_and_unassigned(spark):
    boxes = boxes_df(spark, [(0, "Text", 0, 0, 0, 100, 20), (1, "Text", 1, 0, 30, 100, 50), (2, "Text", 2, 0, 60, 100, 80)])
    rows = [line(0, 0, 30, 90, 40, source="embedded"), line(1, 0, 60, 90, 70), line(2, 0, 70, 90, 80, source="embedded"), line(3, 500, 500, 600, 510)]
    got = B.build_blocks(lines_df(spark, rows), boxes).orderBy("block_seq").collect()
    assert [(b.block_id, b.label, b.source) for b in got] == [("p1b002", "Text", "embedded"), ("p1b003", "Text", "mixed"), ("p1b003", "Unassigned", "surya")]
    assert got[1].text_original == "line 1\nline 2" and got[1].text_normalized == "line 1 line 2" and got[2].reading_order == 3


def test_f6_f7_relabel(spark):
    boxes = boxes_df(spark, [(0, "Picture", 0, 0, 0, 100, 100), (1, "Figure", 1, 200, 0, 300, 100), (2, "Caption", 2, 400, 0, 500, 100)])
    got = B.build_blocks(lines_df(spark, [line(i, 0, 10 * i, 90, 10 * i + 9) for i in range(4)]), boxes).orderBy("block_seq").collect()
    assert [(b.label, b.relabeled, len(b.lines)) for b in got] == [("Text", True, 4), ("Figure", False, 0)]


def page(spark, rows):
    """rows: (reading_order, label, text, x0, y0, x1, y1)"""
    data = [("i", 1, n, f"p1b{n:03d}", label, o, *map(float, b), t) for n, (o, label, t, *b) in enumerate(rows)]
    return spark.createDataFrame(data, "issue_id string, page_number int, block_seq int, block_id string, label string, reading_order int, x0 double, y0 double, x1 double, y1 double, text_normalized string")


def test_w1_segmentation_and_a6(spark):
    blocks = page(spark, [(0, "PageHeader", "head", 0, 0, 9, 9), (1, "SectionHeader", " Title ", 0, 0, 100, 20), (2, "Text", "a b", 0, 25, 100, 60), (3, "Text", "", 0, 90, 100, 120), (4, "Text", "far", 0, 300, 100, 320), (5, "Text", "next column", 200, 0, 300, 20)])
    rows = A.article_rollup(A.segment_blocks(blocks)).orderBy("article_seq").collect()
    assert [(r.article_id, r.title, r.text_normalized, r.word_count) for r in rows] == [("p1a001", "Title", "Title \n\na b".replace("Title ", " Title "), 3), ("p1a002", "Untitled", "far", 1), ("p1a003", "Untitled", "next column", 2)]
    assert rows[0].label_counts == {"SectionHeader": 1, "Text": 2} and rows[0].bbox == [0.0, 0.0, 100.0, 120.0]


def test_ties_keep_input_order_and_partitioning_does_not_matter(spark):
    blocks = page(spark, [(1, "Text", t, 0, 0, 100, 20) for t in "cab"])
    for df in (blocks, blocks.repartition(3, "block_seq")):
        assert A.article_rollup(A.segment_blocks(df)).first().text_normalized == "c\n\na\n\nb"


def test_j6_continuations(spark):
    rows = [("i", 1, 1, "p1a001", 2, None), ("i", 2, 1, "p2a001", None, 1), ("i", 1, 2, "p1a002", 2, None), ("i", 1, 3, "p1a003", 9, None), ("i", 3, 1, "p3a001", 4, None), ("i", 4, 1, "p4a001", None, 3), ("i", 4, 2, "p4a002", None, 3), ("j", 2, 1, "p2a001", None, 1)]
    df = spark.createDataFrame(rows, "issue_id string, page_number int, article_seq int, article_id string, continued_on_page int, continued_from_page int")
    got = {(r.issue_id, r.article_id): (r.continues_in_article_id, r.continues_from_article_id) for r in A.link_continuations(df).collect()}
    assert got[("i", "p1a001")] == ("p2a001", None) and got[("i", "p1a002")] == ("p2a001", None)
    assert got[("i", "p2a001")] == (None, "p1a002")  # both claim it, the later one is its source
    assert got[("i", "p3a001")] == (None, None) and got[("j", "p2a001")] == (None, None)


def fused_by_loops(slots, read, region):
    """Fusion of one page, line by line and slot by slot. Boxes are the last four of each (line_no, text, confidence, box)."""
    middle = lambda b, i: (b[i] + b[i + 2]) / 2
    upper = lambda v: sorted(v)[len(v) // 2]
    meet = lambda a, b: min(a[2], b[2]) > max(a[0], b[0]) and min(a[3], b[3]) > max(a[1], b[1])
    if len(slots) < 10:
        return [(t, "surya", *b) for _, t, _, b in sorted(read)]
    cap = max(1.5 * upper([b[3] - b[1] for *_, b in slots]), 30.0)
    wide = upper([b[2] - b[0] for *_, b in slots])
    slots = sorted(slots, key=lambda s: (s[3][1], s[3][0], s[0]))
    owner, kept = {}, []
    for _, text, _, b in sorted(read):
        best = None
        for i, (*_, e) in enumerate(slots):
            height, width = max(min(e[3] - e[1], cap), 20.0), max(e[2] - e[0], 30.0)
            if i not in owner and abs(middle(b, 1) - middle(e, 1)) <= 0.6 * height and abs(middle(b, 0) - middle(e, 0)) <= 0.5 * width and b[2] - b[0] <= 1.5 * width:
                best = min(best or (9e9, 0), ((b[2] - b[0]) / max(e[2] - e[0], 1.0), i))
        if best:
            owner[best[1]] = text
        if b[2] - b[0] <= 1.5 * wide and region[0] <= middle(b, 0) <= region[1] and not any(meet(b, s[3]) for s in slots) and not any(meet(b, k[1]) for k in kept):
            kept.append((text, b))
    rows = [(owner.get(i, t), "surya" if i in owner else "embedded", *b) for i, (_, t, _, b) in enumerate(slots)] + [(t, "surya", *b) for t, b in kept]
    return sorted(rows, key=lambda r: (r[3], r[2]))


def test_fusion_equals_loops(spark):
    r = random.Random(11)
    slots, read, want = [], [], {}
    for p in range(1, 13):
        n = 4 if p == 1 else r.randint(12, 40)
        columns = lambda: (r.choice((0, 220, 440)) + r.randint(-9, 9), r.randint(0, 40) * 12 + r.choice((0, 0, 3)))  # noqa: B023, E731
        there, own = [], []
        for into, count, word in ((there, n, "slot"), (own, r.randint(10, 60), "read")):
            for i in range(count):
                x, y = columns()
                into.append((i, f"{word} of {p} number {i} here", 0.9, (float(x), float(y), float(x + r.choice((60, 180, 200, 210, 420))), float(y + r.choice((8, 11, 20, 70))))))
        slots += [("i", p, i, t, c, *b) for i, t, c, b in there]
        read += [("i", p, i, t, c, *b, []) for i, t, c, b in own]
        widths = sorted(b[2] - b[0] for *_, b in there)
        long = [b for *_, b in there if b[2] - b[0] > 0.5 * widths[len(widths) // 2]]
        region = (min(b[0] for b in long) - 40, max(b[2] for b in long) + 40)
        inside = [s for s in there if region[0] <= (s[3][0] + s[3][2]) / 2 <= region[1]]
        want[p] = fused_by_loops(inside, own, region)
    read.append(("i", 99, 0, "a page of its own", 0.9, 0.0, 0.0, 100.0, 10.0, []))
    want[99] = [("a page of its own", "surya", 0.0, 0.0, 100.0, 10.0)]
    ocr, embedded = spark.createDataFrame(read, S.OCR_LINES), spark.createDataFrame(slots, S.EMBEDDED_LINES)
    got: dict = {}
    for x in fusion.fuse_lines(ocr, embedded).orderBy("page_number", "line_no").collect():
        got.setdefault(x.page_number, []).append((x.text, x.source, x.x0, x.y0, x.x1, x.y1))
    assert got == want and {s for rows in want.values() for _, s, *_ in rows} == {"surya", "embedded"}


def test_fusion_is_greedy_and_sees_earlier_appends(spark):
    slots = [("i", 1, n, f"slot number {n} here", 0.9, 0.0, 40.0 * n, 200.0, 40.0 * n + 20) for n in range(10)]
    read = [("i", 1, 0, "first one", 0.9, 0.0, 0.0, 200.0, 20.0, []), ("i", 1, 1, "second one", 0.8, 0.0, 2.0, 150.0, 22.0, []), ("i", 1, 2, "free one", 0.9, 0.0, 500.0, 100.0, 520.0, []), ("i", 1, 3, "free two", 0.9, 0.0, 510.0, 100.0, 530.0, [])]
    ocr, embedded = spark.createDataFrame(read, S.OCR_LINES), spark.createDataFrame(slots, S.EMBEDDED_LINES)
    out = [r.text for r in fusion.fuse_lines(ocr, embedded).orderBy("line_no").collect()]
    assert out[:2] == ["first one", "slot number 1 here"]  # one slot, one line, in order of lines; the second overlaps it
    assert out[-1] == "free one" and len(out) == 11
    assert [r.text for r in fusion.fuse_lines(ocr, embedded.where("line_no < 9")).orderBy("line_no").collect()] == ["first one", "second one", "free one", "free two"]  # too few slots


def test_fusion_without_text_layer_has_no_python(spark):
    ocr = spark.createDataFrame([("i", 1, 4, "some words", 0.9, 0.0, 0.0, 9.0, 9.0, [])], S.OCR_LINES)
    plan = fusion.fuse_lines(ocr)
    assert [(r.line_no, r.source) for r in plan.collect()] == [(0, "surya")]
    assert not any(word in plan._jdf.queryExecution().toString() for word in ("Arrow", "Pandas", "Python"))


def test_a1_a2_median_region(spark):
    rows = spark.createDataFrame([(1, 0.0, w, 0.0, 1.0) for w in (1.0, 2.0, 3.0, 4.0)], "p int, x0 double, x1 double, y0 double, y1 double")
    r = fusion.text_region(rows, ["p"]).first()
    assert (r.med, r.left, r.right) == (3.0, -40.0, 44.0)


def test_a7_coverage(spark):
    df = spark.createDataFrame([(1, 49, 100), (2, 3, 0), (3, 0, 10)], "p int, surya_chars int, embedded_chars int")
    assert [(r.ratio, r.low) for r in B.with_ratio(df).orderBy("p").collect()] == [(0.49, True), (1.0, False), (0.0, True)]


def issue(i, name, source, city=None, province=None, masthead=None):
    return (i, name, source, city, province, None, None, masthead)


ISSUE = "issue_id string, newspaper string, newspaper_source string, city string, province string, country string, place_source string, masthead string"


def test_a13_backfill_needs_one_value(spark):
    m = "alpha bravo charlie delta"
    rows = spark.createDataFrame([issue("1", "", "fallback", masthead=m), issue("2", "Gleaner", "page_headers", "Saint John", "N.B.", m), issue("3", "Gleaner", "page_headers", "Boston", None, m), issue("4", "Other", "fallback", "X", None, "none of these words")], ISSUE)
    got = {r.issue_id: r for r in identity.backfill(rows).collect()}
    assert (got["1"].newspaper, got["1"].newspaper_source, got["1"].city, got["1"].province, got["1"].country, got["1"].filled) == ("Gleaner", "cross_issue", None, "N.B.", "Canada", ["newspaper", "province"])
    assert got["4"].filled == []


def test_j9_j14_a14(spark):
    rows = spark.createDataFrame([issue("1", "The Daily Gleaner", "page_headers"), issue("2", "Daily Gleaner", "page_headers"), issue("3", "Daily Gleanfr", "page_headers"), issue("4", "Bad Read", "fallback", masthead="alpha bravo charlie delta"), issue("5", "Herald", "page_headers", masthead="alpha bravo extra words"), issue("6", "", "fallback")], ISSUE)
    assert {(r.a, r.b) for r in identity.same_publication(rows).collect()} == {("2", "3"), ("4", "5")}
    assert {r.issue_id: r.canonical for r in identity.canonical_names(rows).collect()} == {"1": "The Daily Gleaner", "2": "The Daily Gleaner", "3": "The Daily Gleaner", "4": "Herald", "5": "Herald"}


def test_j9_equals_brute_force(spark):
    words = ["alpha", "bravo", "charlie", "delta", "echoes", "foxtrot", "golfing", "hotel"]
    rows = [issue(str(k), None, "fallback", masthead=" ".join(w for i, w in enumerate(words) if (k >> i) & 1)) for k in range(0, 256, 3)]
    sets = {r[0]: set(r[7].split()) for r in rows if len(r[7].split()) >= 4}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.5 * min(len(sets[a]), len(sets[b]))}
    assert {(r.a, r.b) for r in identity.masthead_pairs(spark.createDataFrame(rows, ISSUE)).collect()} == want


def test_a8_a9_a10_votes(spark):
    texts = ["EVENING TELEGRAPH", "EVENING TELEGRAPM", "EVENING TELEGRAPH", "POOR DOCUMENT", "SECTION TWO"]
    blocks = spark.createDataFrame([("i", n, "PageHeader", 0, t) for n, t in enumerate(texts)], "issue_id string, page_number int, label string, block_seq int, text_normalized string")
    fallback = spark.createDataFrame([("i", 9, "EVENING TELEGRAPH"), ("i", 0, "IGNORED NAME")], "issue_id string, page_number int, fallback string")
    clusters = identity.cluster_phrases(identity.header_votes(blocks, fallback))
    assert {(r.phrase, r.votes) for r in clusters.collect()} == {("EVENING TELEGRAPH", 4), ("SECTION", 1)}
    assert [tuple(r) for r in identity.refine_newspaper(clusters).collect()] == [("i", "Evening Telegraph")]


def test_j8_place_and_exact(spark):
    index = spark.createDataFrame([issue("d1", "Evening Telegraph", "page_headers", "Saint John", "N.B."), issue("d2", "Times", "page_headers", "X", "Y")], ISSUE)
    asking = spark.createDataFrame([issue("a", "x", "fallback", "SAINT JOHN", "NB"), issue("b", "x", "fallback"), issue("c", "x", "fallback")], ISSUE)
    clusters = spark.createDataFrame([("a", "EVENING TELEGRAPM", 1, 0), ("b", "EVENING TELEGRAPH", 1, 0), ("c", "TIMES", 1, 0)], "issue_id string, phrase string, votes long, rank int")
    # c: exact, but under six letters
    assert {tuple(r) for r in identity.cross_issue_names(asking, clusters, index).collect()} == {("a", "Evening Telegraph"), ("b", "Evening Telegraph")}


def test_j8_of_alike_names_the_one_nearest_in_length(spark):
    index = spark.createDataFrame([issue(n, f"Evening Telegraph {n}", "page_headers", "Saint John", "N.B.") for n in ("1256", "256")], ISSUE)
    asking = spark.createDataFrame([issue("a", "x", "fallback", "Saint John", "N.B.")], ISSUE)
    clusters = spark.createDataFrame([("a", "EVENING TELEGRAPM 256", 1, 0)], "issue_id string, phrase string, votes long, rank int")
    assert all(similarity.words_match("EVENING TELEGRAPM 256", f"Evening Telegraph {n}") for n in ("1256", "256"))
    assert [tuple(r) for r in identity.cross_issue_names(asking, clusters, index).collect()] == [("a", "Evening Telegraph 256")]


def most_rows(df, of):
    """The most rows that one node of a plan makes, of those whose kind ends so."""
    df.collect()

    def nodes(plan):
        kind = plan.getClass().getSimpleName()
        inner = [plan.executedPlan()] if kind == "AdaptiveSparkPlanExec" else [plan.plan()] if kind.endswith("QueryStageExec") else [plan.children().apply(i) for i in range(plan.children().size())]
        yield kind, plan
        for p in inner:
            yield from nodes(p)

    return max((plan.metrics().apply("numOutputRows").value() for kind, plan in nodes(df._jdf.queryExecution().executedPlan()) if kind.endswith(of)), default=0)


def test_j8_names_of_one_phrase_are_not_paired_with_all_who_ask(spark):
    """60 names that read as one phrase and 120 issues that ask for it; ten misreadings of a name and 120 issues of their place."""
    place = ("Saint John", "N.B.")
    names = [("Evening Telegraph " + str(n), None, None) for n in range(60)] + [("Advertisementshee" + c, *place) for c in "abcdefghij"]
    index = spark.createDataFrame([issue(f"d{k}", name, "page_headers", *where) for k, (name, *where) in enumerate(names)], ISSUE)
    asking = spark.createDataFrame([issue(f"a{k}", "x", "fallback", *(place if k < 120 else ())) for k in range(240)], ISSUE)
    clusters = spark.createDataFrame([(f"a{k}", "ADVERTISEMENTSHEEX" if k < 120 else "EVENING TELEGRAPH", 1, 0) for k in range(240)], "issue_id string, phrase string, votes long, rank int")
    found = identity.cross_issue_names(asking, clusters, index)
    assert {tuple(r) for r in found.collect()} == {(f"a{k}", "Advertisementsheea" if k < 120 else "Evening Telegraph 0") for k in range(240)}
    assert most_rows(found, "JoinExec") <= 240


def test_j9_numbers_that_gain_a_digit_are_alike(spark):
    """The ratio of 128 and 1281 is 6/7, so papers past the thousandth are alike by the reference's rule."""
    rows = spark.createDataFrame([issue(n, f"Evening Telegraph {n}", "page_headers") for n in ("128", "1281", "12")], ISSUE)
    assert [tuple(r) for r in identity.same_publication(rows).collect()] == [("128", "1281")]


def test_c3_reconcile_and_unrelated_issue(spark):
    rows = [issue("1", "x", "fallback", "Saint John", "N.B."), issue("2", "Evening Telegraph", "page_headers", "Saint John", "N.B.")]
    clusters = spark.createDataFrame([("1", "EVENING TELEGRAPH", 1, 0)], "issue_id string, phrase string, votes long, rank int")
    for more in ([], [issue("9", "Elsewhere", "page_headers", "Z", "Z")]):
        got = {r.issue_id: (r.newspaper, r.newspaper_source) for r in identity.reconcile(spark.createDataFrame(rows + more, ISSUE), clusters).collect()}
        assert got["1"] == ("Evening Telegraph", "cross_issue") and got["2"] == ("Evening Telegraph", "page_headers")


def test_c3_reconcile_fills_a_whole_chain(spark):
    # the masthead of an issue overlaps by half with its neighbours' only
    words = [f"{a}{b}stuvw" for a in "abcde" for b in "fghij"]
    rows = [issue(f"i{i:02d}", "x", "fallback", *(("Saint John", "N.B.") if i == 0 else (None, None)), masthead=" ".join(words[2 * i : 2 * i + 4])) for i in range(10)]
    clusters = spark.createDataFrame([], "issue_id string, phrase string, votes long, rank int")
    got = {r.issue_id: (r.city, r.province) for r in identity.reconcile(spark.createDataFrame(rows, ISSUE), clusters).collect()}
    assert got == {f"i{i:02d}": ("Saint John", "N.B.") for i in range(10)}


def test_pairs_equal_brute_force_on_a_hot_masthead(spark):
    hot = "incorporated morning journal established weekly review"
    mastheads = [hot] * 90 + ["incorporated morning journal founded", "morning journal printed daily evening pages", "short title", None, "review weekly other words entirely different"]
    names = ["Evening Telegraph", "Evening Telegrapm", "Daily Gleaner", "Daily Gleanor", "Morning Chronicle"]
    places = [("Saint John", "N.B."), ("SAINT JOHN", "NB"), ("Boston", "Mass."), (None, None)]
    rows = [issue(f"i{k:03d}", names[k % 5], ("page_headers", "page_headers", "fallback")[k % 3], *places[k % 4], m) for k, m in enumerate(mastheads)]
    df = spark.createDataFrame(rows, ISSUE)

    prints = {r[0]: set(r[1]) for r in df.select("issue_id", headers.fingerprint(F.col("masthead"))).collect()}
    ids = sorted(prints)
    pairs = {(a, b, len(prints[a] & prints[b])) for a in ids for b in ids if a < b and prints[a] and prints[b] and prints[a] & prints[b] and 2 * len(prints[a] & prints[b]) >= min(len(prints[a]), len(prints[b]))}
    got = [tuple(r) for r in identity.masthead_pairs(df).select("a", "b", "shared").collect()]
    assert len(got) == len(set(got)) and set(got) == pairs and len(pairs) > 90 * 89 / 2

    read = {r[0]: r[1] for r in rows if r[2] == "page_headers"}
    alike = {(a, b) for a in read for b in read if a < b and similarity.words_match(read[a], read[b])}
    assert any(read[a] != read[b] for a, b in alike)
    same = [tuple(r) for r in identity.same_publication(df).collect()]
    assert len(same) == len(set(same)) and set(same) == alike | {p[:2] for p in pairs}

    key = {"Saint John": 1, "SAINT JOHN": 1, "Boston": 2, None: None}
    asking = [r for r in rows if r[2] == "fallback"]
    clusters = spark.createDataFrame([(r[0], r[1].upper(), 2, 0) for r in asking], "issue_id string, phrase string, votes long, rank int")
    want = {}
    for r in asking:
        fit = sorted(d[1] for d in rows if d[2] == "page_headers" and (key[d[3]] == key[r[3]] and similarity.words_match(r[1], d[1]) if r[3] else d[1] == r[1]))
        if fit:
            want[r[0]] = fit[0]
    assert {tuple(x) for x in identity.cross_issue_names(df.where("newspaper_source = 'fallback'"), clusters, df).collect()} == set(want.items())
    assert any(want[r[0]] != r[1] for r in asking if r[0] in want)

    root = {i: i for i in ids}
    for a, b in sorted(p[:2] for p in pairs):
        low, high = sorted((root[a], root[b]))
        root = {i: low if x == high else x for i, x in root.items()}
    paired = {i for p in pairs for i in p[:2]}
    assert {r.id: r.component for r in connected_components(identity.masthead_pairs(df).select("a", "b")).collect()} == {i: root[i] for i in paired}


def test_pairs_of_a_hot_kind_are_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(identity, "PAIR_BLOCK", 16)
    members = spark.createDataFrame([(f"i{k:03d}", "a" if k < 120 else "b") for k in range(160)], "issue_id string, kind string").coalesce(1)
    linked = spark.createDataFrame([("a", "a"), ("b", "b"), ("b", "a")], "a string, b string")
    rows = identity._pairs(members, linked).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.a, r.b) for r in rows) == [(f"i{i:03d}", f"i{j:03d}") for i in range(160) for j in range(i + 1, 160)]
    tasks = [r.task for r in rows]
    assert max(map(tasks.count, set(tasks))) < len(rows) / 2


def test_pairs_are_handed_on_before_a_block_is_done(spark):
    """Spark holds what generators make of one row, so for the first pair of a block only some of its million are made."""
    members = spark.createDataFrame([(f"i{k:04d}", "a") for k in range(1000)], "issue_id string, kind string")
    first = identity._pairs(members, spark.createDataFrame([("a", "a")], "a string, b string")).limit(1)
    assert most_rows(first, "GenerateExec") <= 100 * 1000


def test_same_publication_equals_brute_force_without_telling_pairs_apart(spark):
    """Pairs by name, by masthead and by both; then with a row that the index has twice."""
    r = random.Random(5)
    words = ["alpha", "bravo", "charlie", "delta", "echoes", "foxtrot", "golfing", "hotel"]
    names = ["Evening Telegraph", "Evening Telegraqh", "Evening Telegrath", "Daily Gleaner", "Daily Gleanor", "Morning Chronicle", None]
    mastheads = [" ".join(r.sample(words, r.choice((4, 4, 5, 7)))) for _ in range(8)] + ["short title"]
    rows = [issue(f"i{k:03d}", r.choice(names), r.choice(("page_headers", "override", "fallback")), masthead=r.choice(mastheads + mastheads[:1] * 8)) for k in range(120)]
    # three alone: a masthead and a name that no other issue has, or that one other has
    rows += [issue("j1", "Halifax Courier", "override", masthead="unlike every other masthead"), issue("j2", "Halifax Courier", "override", masthead="nothing shared anywhere else"), issue("j3", "Truro Standard", "override", masthead="yankee xray whisky victor")]

    def alike(x, y):
        named = all(z[1] and z[2] in identity.CONFIDENT for z in (x, y)) and (similarity.words_match(x[1], y[1]) or similarity.words_match(y[1], x[1]))
        a, b = ({w for w in z[7].split() if len(w) > 3} for z in (x, y))
        return named, min(len(a), len(b)) >= 4 and 2 * len(a & b) >= min(len(a), len(b))

    for index in (rows, rows + rows[:2]):
        ways = {(x[0], y[0], alike(x, y)) for x in index for y in index if x[0] < y[0]}
        assert {w[2] for w in ways} == {(True, True), (True, False), (False, True), (False, False)}
        found = identity.same_publication(spark.createDataFrame(index, ISSUE))
        got = [tuple(p) for p in found.collect()]
        assert len(got) == len(set(got)) and set(got) == {w[:2] for w in ways if any(w[2])} and len(got) > 1000
        if index is rows:
            assert most_rows(found, "HashAggregateExec") < 1000


def test_masthead_stars_equal_pairs(spark):
    """Components and sibling values by stars are those of all pairs; short and long mastheads, each size beside each."""
    r = random.Random(11)
    words = [f"{a}{b}word" for a in "abcdefgh" for b in "xy"]
    mastheads = [" ".join(r.sample(words, r.choice((2, 3, 4, 5, 7, 8)))) + " ".join(f" alone{k}n{j}" for j in range(r.choice((0, 0, 3, 6)))) for k in range(60)]
    mastheads += [" ".join(r.sample(words, n)) for n in (9, 10, 12, 14, 16, 16)]
    rows = [issue(f"i{k:03d}", f"Paper {k % 3}", "page_headers" if k % 3 else "fallback", *r.choice([("Truro", "N.S."), ("Boston", "Mass."), (None, None)]), m) for k, m in enumerate(mastheads)]
    df = spark.createDataFrame(rows, ISSUE)
    space = identity.masthead_space(df)
    pairs = identity.masthead_pairs(df).select("a", "b")
    parts = lambda edges: {(x.id, x.component) for x in connected_components(edges).collect()}
    assert parts(identity.publication_edges([space])) == parts(pairs)
    lacks = {x[0] for x in rows if x[3] is None}
    values = lambda got: {x.issue_id: (x.sibling_city, x.sibling_province) for x in got.collect() if x.issue_id in lacks and (x.sibling_city or x.sibling_province)}
    # few siblings each: values agree only where an issue has hardly any
    for low in (0, 55):
        some = df.where(F.col("issue_id").between(f"i{low:03d}", f"i{low + 10:03d}"))
        assert values(identity.sibling_values_by_kind(some, [identity.masthead_space(some)])) == values(identity.sibling_values(some, identity.masthead_pairs(some).select("a", "b")))


def test_misread_variants_of_one_masthead_are_stars(spark):
    """Variants of one masthead with a misread word each: some rows a variant, no links, one component."""
    for n in (200, 2000):
        rows = [issue(f"i{k:05d}", "x", "fallback", None, None, f"incorporated morning journal estab{k} weekly review") for k in range(n)]
        space = identity.masthead_space(spark.createDataFrame(rows, ISSUE))
        assert space.links.count() == 0 and space.stars.count() <= 32 * n
        edges = identity.publication_edges([space])
        assert edges.count() <= 3 * n and {x.component for x in connected_components(edges).collect()} == {"i00000"}


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (7, 7)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def art(spark, rows):
    full = [(i, 1, 1, a, "T", ["b"], 0, 0, {"Text": 1}, t, n, None, None, [0.0] * 4, None, None) for i, a, t, n in rows]
    return spark.createDataFrame(full, S.ARTICLES)


def test_export_q20_j12_f11(spark):
    issues = spark.createDataFrame([(i, "N", "page_headers", "C", "P", None, None, None, "1950", None, None) for i in ("1", "2", "3")], ISSUE + ", date string, day_of_week string, date_precision string")
    arts = art(spark, [("1", "a", "w " * 20, 20), ("1", "b", "short", 1)])
    blocks = spark.createDataFrame([("b1", i, "N", "1950", 1, "Text", 0, [0.0] * 4, 0.5, 0.5, "surya", "", "", "t", "w " * 16) for i in ("1", "2", "3")], S.FLAT_BLOCKS)
    has_file = spark.createDataFrame([("1",), ("3",)], "issue_id string")  # 3 has an empty article file
    fixed = spark.createDataFrame([("1", "a", "new text", "m", "t")], S.CORRECTIONS)
    rows = corpus.export_corpus(issues, arts, blocks, has_file, fixed).collect()
    assert sorted((r.type, r.issue_id, r.word_count, r.corrected, r.text_normalized.strip()) for r in rows) == [("article", "1", 2, True, "new text"), ("block", "2", 16, None, ("w " * 16).strip())]
    s = corpus.export_stats(issues, arts, blocks, has_file, fixed).first()
    assert tuple(s) == (3, 1, 1, 18, 1, 2)


def test_k6_k7_upsert(spark):
    index = spark.createDataFrame([("1", "A", None), ("2", "B", None)], "issue_id string, newspaper string, processed_at string")
    new = spark.createDataFrame([("2", "C", "t1"), ("2", "D", "t2"), ("3", "E", None)], "issue_id string, newspaper string, processed_at string")
    assert {(r.issue_id, r.newspaper) for r in writers.upsert_index(index, new).collect()} == {("1", "A"), ("2", "D"), ("3", "E")}


def test_f12_j11_x28_x32_correct(spark):
    arts = art(spark, [("1", "a", "w " * 20, 20), ("1", "b", "w " * 20, 20), ("1", "c", "x", 1)])
    old = spark.createDataFrame([("1", "b", "kept", "m", "t"), ("1", "c", "stale", "m", "t")], S.CORRECTIONS)

    def make():
        def ask(text, secondary):
            return "Sure, here:\n```x" if secondary else "Corrected text:\n" + text

        return ask

    got = {r.article_id: r.corrected_text for r in correct.correct(arts, make, "model", corrections=old).collect()}
    assert got == {"a": ("w " * 20).strip(), "b": "kept"}
    cases = spark.createDataFrame([("```text\nabc def\n```", "abc dxf"), ("Output:\nHere is\nabcdefg", "abcdefg"), ("ab", "abcdefghijkl"), ("x" * 200, "y" * 100)], "r string, t string")
    assert [r.v for r in cases.select(correct.sanitize(F.col("r"), F.col("t")).alias("v")).collect()] == ["abc def", "abcdefg", None, None]


def test_reports(spark):
    rows = spark.createDataFrame([("1", "A", "1950", "C", "P", None, 1, 2, 3, 0.5), ("2", "B", "1951", None, None, None, 1, 2, 3, 1.0)], "issue_id string, newspaper string, date string, city string, province string, country string, page_count int, block_count int, article_count int, coverage_min_ratio double")
    names = spark.createDataFrame([("1", "A"), ("2", "A")], "issue_id string, canonical string")
    got = {r.issue_id: (r.publication, r.issues, r.place, r.read_as) for r in reports.group_report(rows, names).collect()}
    assert got == {"1": ("A", 2, "C, P", ""), "2": ("A", 2, "", "  [read as: B]")}
    total = reports.stats_report(rows).where("is_total = 1").first()
    assert (total.issues, total.blocks, total.articles) == (2, 4, 6)


def test_sources_and_sinks(spark, tmp_path):
    folder = tmp_path / "1950" / "pages" / "page_002"
    folder.mkdir(parents=True)
    (folder / "layout.json").write_text('{"ocr": {"text_lines": [{"text": "a", "bbox": [1, 2, 3, 4], "words": [{"text": "w"}]}, {}]}, "layout": {"bboxes": [{"bbox": [0, 0, 9, 9]}]}}')
    layouts = readers.read_layouts(spark, f"file://{tmp_path}/*/pages/*/layout.json")
    got = readers.ocr_lines(layouts).orderBy("line_no").collect()
    assert [(r.issue_id, r.page_number, r.line_no, r.text, r.x0, r.confidence) for r in got] == [("1950", 2, 0, "a", 1.0, 0.0), ("1950", 2, 1, "", 0.0, 0.0)]
    assert [(r.label, r.position) for r in readers.layout_boxes(layouts).collect()] == [("Text", 0)]
    assert readers.read_index(spark, f"file://{tmp_path}/none.json").count() == 0
    assert readers.read_ndjson(spark, f"file://{tmp_path}/none.ndjson", S.ARTICLES) is None
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "corrections.json").write_text('{"p1a001": {"corrected_text": "x", "model": "m", "corrected_at": "t"}}')
    assert [tuple(r) for r in readers.read_corrections(spark, f"file://{tmp_path}/c/corrections.json").collect()] == [("c", "p1a001", "x", "m", "t")]
    back = writers.corrections_json(readers.read_corrections(spark, f"file://{tmp_path}/c/corrections.json")).first()
    assert back.json == '{"p1a001":{"corrected_text":"x","model":"m","corrected_at":"t"}}'
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    assert [r.issue_id for r in readers.find_pdfs(spark, f"file://{tmp_path}").collect()] == ["a"]


def test_providers_process(spark, tmp_path):
    """S2-S10 behind fakes: one PDF with one page to an issue."""
    from pressline.plans.documents import process

    (tmp_path / "news_19500102.pdf").write_bytes(b"%PDF")

    def parser():
        return lambda issue_id, content: [{"issue_id": issue_id, "page_number": 1, "pt_width": 72.0, "pt_height": 72.0, "text": "hello", "image": "x.png", "lines": []}]

    def ocr():
        return lambda image: [{"text": "hello world", "confidence": 0.9, "bbox": [0.0, 0.0, 100.0, 20.0], "words": []}]

    def layout():
        return lambda image: [{"label": "Text", "position": 0, "confidence": 0.9, "bbox": [0.0, 0.0, 110.0, 30.0], "polygon": [[0.0, 0.0]]}]

    done = process(spark, f"file://{tmp_path}", parser, ocr, layout)
    row = done.issues.first()
    assert (row.issue_id, row.date, row.date_source, row.newspaper, row.newspaper_source, row.block_count, row.article_count) == ("news_19500102", "1950-01-02", "filename", "News", "fallback", 1, 1)
    assert done.articles.first().text_normalized == "hello world"
    assert providers.fitz_parser  # needs PyMuPDF only when it is called


def test_model_objects_become_rows():
    class Thing:
        def __init__(self, **fields):
            self.__dict__ |= fields

    found = Thing(text_lines=[Thing(text="a line", confidence=None, bbox=(1, 2, 3, 4), words=[Thing(text="a", bbox=[1, 2, 3, 4], confidence=0.123456)]), Thing(text="b", confidence=0.5, bbox=[0, 0, 1, 1], words=None)], bboxes=[Thing(label="Text", position=2, confidence=None, bbox=(0, 0, 9, 9), polygon=[(0, 0), (9, 9)])])
    asked = []

    def predict(images):
        asked.extend(images)
        return [found]

    assert providers.recognition(predict, str.upper)("page.png") == [
        {"text": "a line", "confidence": 0.0, "bbox": [1.0, 2.0, 3.0, 4.0], "words": [{"text": "a", "bbox": [1.0, 2.0, 3.0, 4.0], "confidence": 0.1235}]},
        {"text": "b", "confidence": 0.5, "bbox": [0.0, 0.0, 1.0, 1.0], "words": []},
    ]
    assert providers.layout(predict, str.upper)("p.png") == [{"label": "Text", "position": 2, "confidence": 0.0, "bbox": [0.0, 0.0, 9.0, 9.0], "polygon": [[0.0, 0.0], [9.0, 9.0]]}]
    assert asked == ["PAGE.PNG", "P.PNG"]


def test_embedded_lines_are_scaled(spark):
    pages = spark.createDataFrame([("i", 1, 100.0, 100.0, "t", None, [("ab", 1.0, 2.0, 3.0, 4.0), (" ", 0.0, 0.0, 1.0, 1.0)])], S.PDF_PAGES)
    got = [tuple(r) for r in readers.embedded_lines(pages, F.lit(2.0)).select("line_no", "text", *S.SIDES).collect()]
    assert got == [(0, "ab", 2.0, 4.0, 6.0, 8.0)]


def test_rebuild_with_text_layer_and_index_then_batch(spark):
    """Fusion, blocks, a name from the index and a batch in one plan."""
    from pressline.plans.documents import batch, rebuild

    texts = [f"line number {k} of the text layer here" for k in range(12)]
    layer = [(t, 10.0, 20.0 + 10 * k, 110.0, 28.0 + 10 * k) for k, t in enumerate(texts)]
    pdf = spark.createDataFrame([("paper_19500102", 1, 200.0, 300.0, "\n".join(texts), None, layer)], S.PDF_PAGES)
    ocr = spark.createDataFrame([("paper_19500102", 1, 0, "DAILY HERALD", 0.9, 20.0, 0.0, 220.0, 20.0, []), ("paper_19500102", 1, 1, "Read by the model", 0.9, 21.0, 61.0, 221.0, 77.0, [])], S.OCR_LINES)
    boxes = spark.createDataFrame([("paper_19500102", 1, 0, "PageHeader", 0, 0.9, 0.0, 0.0, 400.0, 30.0, []), ("paper_19500102", 1, 1, "Text", 1, 0.9, 0.0, 30.0, 400.0, 600.0, [])], S.LAYOUT_BOXES)
    sizes = spark.createDataFrame([("paper_19500102", 1, 400, 600, "")], S.PAGE_SIZES)
    names = [c.split(" ")[0] for c in S.ISSUE_INDEX.split(", ")]
    index = spark.createDataFrame([tuple({"issue_id": "old", "newspaper": "Daily Herald", "newspaper_source": "page_headers", "date": "1949-01-01", "city": "Boston", "province": "Mass."}.get(c) for c in names)], S.ISSUE_INDEX)
    done = rebuild(ocr, boxes, sizes, pdf, index)
    body = next(r for r in done.blocks.collect() if r.label == "Text")
    assert body.source == "mixed" and "Read by the model" in body.text_original and texts[1] not in body.text_original and texts[2] in body.text_original
    row = done.issues.first()
    assert (row.newspaper, row.newspaper_source, row.date, row.coverage_min_ratio > 0.9) == ("Daily Herald", "cross_issue", "1950-01-02", True) and row.processed_at
    after = {r.issue_id: r for r in batch(done, index).collect()}
    assert set(after) == {"old", "paper_19500102"} and after["paper_19500102"].newspaper == "Daily Herald" and after["old"].city == "Boston"


def test_corpus_and_manifest_are_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("article", "1", "words é", None)], "type string, issue_id string, text_normalized string, corrected boolean")
    stats = spark.createDataFrame([(3, 1, 0, 2, 4, 1)], "issues long, articles long, blocks long, words long, skipped long, row_count long")
    writers.write_corpus(rows, stats, f"file://{tmp_path}/out")
    back = readers.read_ndjson(spark, f"file://{tmp_path}/out/corpus.jsonl", "type string, issue_id string, text_normalized string, corrected boolean")
    assert [tuple(r) for r in back.collect()] == [("article", "1", "words é", None)]
    manifest = spark.read.json(f"file://{tmp_path}/out/manifest.json").first()
    assert manifest.row_count == 1 and manifest.stats.asDict() == {"issues": 3, "articles": 1, "blocks": 0, "words": 2, "skipped": 4} and manifest.generated_at
    (tmp_path / "bad.ndjson").write_text('{"type": "a"}\n\n{"type": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_ndjson(spark, f"file://{tmp_path}/bad.ndjson", "type string").collect()


def test_failed_corrections_are_reported(spark):
    def make():
        def ask(text, secondary):
            if text.startswith("bad"):
                raise TimeoutError("too slow")
            return text

        return ask

    rows = art(spark, [("1", "a", "w " * 20, 20), ("1", "b", "bad " + "w " * 20, 21)])
    with pytest.warns(UserWarning, match="1 articles stay uncorrected: TimeoutError"):
        got = correct.correct(rows, make, "model")
    assert [r.article_id for r in got.collect()] == ["a"]


def test_streams_of_layouts_and_uncorrected_articles(spark, tmp_path):
    from pressline.streaming.incremental import layout_stream, uncorrected_stream

    folder = tmp_path / "in" / "1950" / "pages" / "page_002"
    folder.mkdir(parents=True)
    (folder / "layout.json").write_text('{"ocr": {"text_lines": [{"text": "a"}]}, "layout": {"bboxes": []}}')
    out = lambda n: {"path": f"file://{tmp_path}/{n}", "checkpointLocation": f"file://{tmp_path}/{n}-point"}
    layout_stream(spark, f"file://{tmp_path}/in/*/pages/*").writeStream.format("parquet").options(**out("layouts")).trigger(availableNow=True).start().awaitTermination()
    assert [(r.issue_id, r.page_number) for r in spark.read.parquet(f"file://{tmp_path}/layouts").collect()] == [("1950", 2)]
    art(spark, [("1", "a", "w " * 20, 20), ("1", "b", "w " * 20, 20)]).select("issue_id", "article_id", "text_normalized", "word_count").write.parquet(f"file://{tmp_path}/arts")
    arriving = spark.readStream.schema("issue_id string, article_id string, text_normalized string, word_count int").parquet(f"file://{tmp_path}/arts")
    done = spark.createDataFrame([("1", "b", "kept", "m", "t")], S.CORRECTIONS)
    uncorrected_stream(arriving, done).writeStream.format("parquet").options(**out("todo")).trigger(availableNow=True).start().awaitTermination()
    assert [r.article_id for r in spark.read.parquet(f"file://{tmp_path}/todo").collect()] == ["a"]


def test_streaming_upsert(spark, tmp_path):
    from pressline.streaming.incremental import latest_index, upsert_stream

    src, index, point = (f"file://{tmp_path}/{x}" for x in ("src", "index", "point"))
    names = [c.split(" ")[0] for c in S.ISSUE_INDEX.split(", ")]

    def put(rows, point=point):
        data = [tuple({"issue_id": i, "newspaper": n, "processed_at": t}.get(c) for c in names) for i, n, t in rows]
        spark.createDataFrame(data, S.ISSUE_INDEX).coalesce(1).write.mode("append").parquet(src)
        upsert_stream(spark.readStream.schema(S.ISSUE_INDEX).parquet(src), index, point).awaitTermination()

    put([("1", "A", "t1"), ("2", "B", "t1")])
    put([("2", "C", "t2"), ("3", "D", "t2")])
    assert {(r.issue_id, r.newspaper) for r in latest_index(spark, index).collect()} == {("1", "A"), ("2", "C"), ("3", "D")}
    # a new checkpoint reads the source again, on top of the index that is there
    put([("4", "E", "t3")], point + "-new")
    assert {(r.issue_id, r.newspaper) for r in latest_index(spark, index).collect()} == {("1", "A"), ("2", "C"), ("3", "D"), ("4", "E")}


def index_rows(spark, rows):
    names = [c.split(" ")[0] for c in S.ISSUE_INDEX.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], S.ISSUE_INDEX)


def test_index_table_rewrites_touched_buckets_only(spark, tmp_path):
    names = [c.split(" ") for c in S.ISSUE_INDEX.split(", ")]
    table = IndexTable(spark, f"file://{tmp_path}/index", buckets=64, keep=2)
    many = spark.range(200_000).select(*(F.col("id").cast("string").alias(c) if c == "issue_id" else F.lit(None).cast(t).alias(c) for c, t in names))
    assert len(table.upsert(many, 0)) == 64
    new = index_rows(spark, [{"issue_id": str(199_995 + i), "newspaper": "New", "processed_at": "t"} for i in range(10)])
    for _ in range(2):  # the second time stands for a batch that is run again
        touched = IndexTable(spark, f"file://{tmp_path}/index").upsert(new, 1)
        assert 0 < len(touched) <= 10 and {int(p.name[7:]) for p in (tmp_path / "index/data/v1").glob("bucket=*")} == touched
        rows = table.read()
        assert rows.count() == 200_005 and rows.where("newspaper = 'New'").count() == 10 and table.buckets == IndexTable(spark, f"file://{tmp_path}/index").buckets == 64
    assert table.read(0).count() == 200_000  # the version before stays
    for version in (2, 3):
        table.upsert(new.withColumn("newspaper", F.lit(f"New {version}")), version)
    assert sorted(table.versions()) == [2, 3]
    held = {(int(p.name[7:]), p.parent.name) for p in (tmp_path / "index/data").glob("v*/bucket=*")}
    assert held == {(b, f"v{v}") for n in (2, 3) for b, v in table.manifest(n).items()}
    assert table.read().where("newspaper = 'New 3'").count() == 10 and table.read().count() == 200_005


def test_index_table_with_reconcile_and_empty_batches(spark, tmp_path):
    table = IndexTable(spark, f"file://{tmp_path}/index", buckets=32)
    table.upsert(index_rows(spark, []), 0)
    assert table.read().count() == 0 and IndexTable(spark, f"file://{tmp_path}/index").buckets == 32
    rows = [{"issue_id": str(i), "newspaper": f"Paper {i % 3}", "newspaper_source": "page_headers", "processed_at": "t"} for i in range(30)]
    table.upsert(index_rows(spark, rows), 1)
    fill = lambda df: df.withColumn("city", F.when(F.col("newspaper") == "Paper 1", F.lit("Truro")).otherwise(F.col("city")))
    touched = table.upsert(index_rows(spark, [{"issue_id": "99", "newspaper": "Paper 2", "processed_at": "t"}]), 2, fill)
    got = {r.issue_id: r.city for r in table.read().collect()}
    assert len(got) == 31 and all((c == "Truro") == (i != "99" and int(i) % 3 == 1) for i, c in got.items())
    assert len(touched) <= 11
    assert table.upsert(index_rows(spark, []), 3, fill) == set()  # nothing changes, nothing is written


def misread(r: random.Random, word: str) -> str:
    """word with one letter changed, lost or added."""
    i, kind = r.randrange(len(word)), r.randrange(3)
    return word[:i] + ("" if kind == 0 else r.choice("aeioqz")) + word[i + (kind != 2) :]


def random_names(r: random.Random, n: int, words: int = 2) -> list[str]:
    known = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k)) for k in (3, 4, 5, 7, 8, 9, 12, 15, 21, 30)]
    return [" ".join(w.title() if r.random() < 0.5 else misread(r, w) for w in r.choices(known, k=words)) for _ in range(n)]


def test_matching_names_equal_brute_force(spark):
    r = random.Random(7)
    left = [(r.choice("xy"), n) for k in (1, 2, 3) for n in random_names(r, 60, k)] + [("x", None), ("x", " "), (None, "Abc"), ("x", "The  Sun\t"), ("y", "ÉCLAIREUR de"), ("x", "a" * 80)]
    right = [(r.choice("xy"), n) for k in (1, 2, 3) for n in random_names(random.Random(7), 60, k)] + left[-5:] + [("x", "the sun"), ("y", "éclaireur du"), ("x", "a" * 79 + "b")]
    asking, answering = spark.createDataFrame(left, "p string, a_name string"), spark.createDataFrame(right, "p string, b_name string")
    want = {(p, a, b) for p, a in left for q, b in right if p == q and p and a and b and a.strip() and similarity.words_match(a, b)}
    assert {tuple(x) for x in matching_names(asking, answering, ["p"]).collect()} == want and len(want) > 60
    assert matching_names(asking.limit(0), answering, ["p"]).count() == 0
    everywhere = {(a, b) for _, a in left for _, b in right if a and b and a.strip() and similarity.words_match(a, b)}
    assert {tuple(x) for x in matching_names(asking, answering).collect()} == everywhere


def test_many_names_share_few_candidates(spark):
    """10 000 distinct names of two words, all of one first word: fewer than 20 pairs of words a name are compared."""
    r = random.Random(3)
    second = list({"".join(r.choice("etaoinshrdlucm") for _ in range(r.randint(4, 12))) for _ in range(11_000)})[:10_000]
    words = spark.createDataFrame([(w,) for w in [*second, "evening"]], "word string")
    assert word_candidates(words).count() < 20 * len(second)
    names = spark.createDataFrame([(f"Evening {w}", w) for w in second], "a_name string, w string")
    asked = matching_names(names, names.select(F.col("a_name").alias("b_name")))
    want = {(a, b) for a, b in ((r.word, r.other) for r in alike_words(words).collect()) if "evening" not in (a, b)}
    assert {(x.a_name[8:], x.b_name[8:]) for x in asked.collect()} == want


def test_hot_place_is_spread_over_words(spark):
    """One city that holds all phrases and donors: rows meet by word, so no key holds many of them."""
    r = random.Random(4)
    donors = random_names(r, 200)
    rows = [("x", f"Daily {d}") for d in donors for _ in range(5)]
    asking = spark.createDataFrame(rows, "p string, a_name string").distinct()
    got = matching_names(asking, asking.withColumnRenamed("a_name", "b_name"), ["p"])
    names = sorted({n for _, n in rows})
    assert {(a, b) for _, a, b in got.collect()} == {(a, b) for a in names for b in names if similarity.words_match(a, b)}


def test_reconcile_as_issues_arrive(spark):
    """Random issues in random batches, some read again: after each batch what a run over the whole index says."""
    r = random.Random(17)
    names = ["Evening Telegraph", "Evening Telegraqh", "Daily Gleaner", "Morning Herald", "Morning Heralds Weekly", ""]
    places = [("Truro", "N.S."), ("Boston", "Mass."), (None, None), (None, None), ("Truro", None)]
    words = ["incorporated", "morning", "journal", "founded", "weekly", "review", "shipping", "gazette"]
    rows = []
    for i in range(60):
        source = r.choice(["page_headers", "fallback", "fallback", "cross_issue"])
        masthead = " ".join(r.sample(words, r.choice((2, 4, 5)))) + (f" alone{i} apart{i} single{i} lonely{i}" if r.random() < 0.5 else "")
        rows.append({"issue_id": f"{i:02d}", "newspaper": r.choice(names) if source != "fallback" else f"File {i}", "newspaper_source": source, "city": (p := r.choice(places))[0], "province": p[1], "masthead": masthead, "processed_at": "t1"})
    phrases = [(f"{i:02d}", r.choice(["EVENING TELEGRAPH", "DAILY GLEANFR", "MORNING HERALD", "NOTHING KNOWN"]), 2, 0) for i in range(60)]
    clusters = spark.createDataFrame(phrases, "issue_id string, phrase string, votes long, rank int")
    r.shuffle(rows)
    batches = [rows[:35], [{**rows[3], "newspaper": "Daily Gleaner", "newspaper_source": "page_headers", "city": "Boston", "province": "Mass.", "processed_at": "t2"}, *rows[35:]]]
    index, whole, kept = index_rows(spark, []), index_rows(spark, []), arrivals.no_publications(spark)
    shown = lambda df: sorted(((x.issue_id, x.newspaper, x.newspaper_source, x.city, x.province, x.country) for x in df.collect()), key=repr)
    for batch in batches:
        new = index_rows(spark, batch)
        index, kept = arrivals.reconcile_arrivals(index, new, kept, clusters)
        whole = identity.reconcile(writers.upsert_index(whole, new), clusters)
        assert shown(index) == shown(whole)
    given = {x["issue_id"]: x["newspaper_source"] for x in rows}
    assert sum(given[i] == "fallback" and s == "cross_issue" for i, _, s, *_ in shown(index)) > 3
    alone = index_rows(spark, [{"issue_id": "99", "newspaper": "Quite Alone", "newspaper_source": "page_headers", "masthead": "", "processed_at": "t"}])
    grown = arrivals.with_arrivals(kept, alone)
    assert [x.issue_id for x in arrivals.hanging_together(grown, alone).collect()] == ["99"]  # a stranger moves no other issue


def test_blocks_are_made_once_for_boxed_and_loose_lines(spark):
    boxes = spark.createDataFrame([("d", 1, 0, "Text", 0, 0.5, 0.0, 0.0, 100.0, 100.0, []), ("d", 1, 1, "Text", 1, 0.5, 0.0, 500.0, 100.0, 600.0, []), ("d", 1, 2, "Table", 2, 0.5, 0.0, 700.0, 100.0, 800.0, []), ("e", 1, 0, "Text", 0, 0.5, 0.0, 0.0, 9.0, 9.0, [])], S.LAYOUT_BOXES)
    lines = spark.createDataFrame([(d, 1, i, t, 0.9, 0.0, y, 90.0, y + 9, None, "surya") for d, i, t, y in (("d", 0, "in a box", 10.0), ("d", 1, "loose", 300.0), ("f", 0, "no boxes", 10.0))], S.OCR_LINES + ", source string")
    blocks = B.build_blocks(lines, boxes)
    got = [tuple(r) for r in blocks.orderBy("issue_id", "block_seq").select("issue_id", "block_id", "label", "reading_order", "text_normalized", "relabeled").collect()]
    # the empty text box is dropped, but counts for the place of what is loose; its number follows those kept
    assert got == [("d", "p1b001", "Text", 0, "in a box", False), ("d", "p1b003", "Table", 2, "", False), ("d", "p1b003", "Unassigned", 3, "loose", False), ("f", "p1b001", "Unassigned", 0, "no boxes", False)]
    assert blocks._jdf.queryExecution().optimizedPlan().toString().count("collect_list(struct(y0") == 1


def test_a_header_is_read_once_and_a_pair_of_headlines_judged_once(spark, monkeypatch):
    blocks = spark.createDataFrame([(str(i), 1, 1, "PageHeader", "THE DAILY TIMES 5 BOSTON, Mass., Monday, Jan 2, 1911") for i in range(6)] + [("6", 1, 1, "PageHeader", "PAGE 2")], "issue_id string, page_number int, block_seq int, label string, text_normalized string")
    votes = identity.header_votes(blocks)
    assert {r["phrase"] for r in votes.collect()} == {"THE DAILY TIMES"} and votes.count() == 6
    assert votes._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all(upper") == 1

    seen = spark.sparkContext.accumulator(0)

    def ratio(a, b):
        @F.pandas_udf("double")
        def judge(x, y):
            seen.add(len(x))
            return x.str.len() * 0 + 0.9

        return judge(a, b)

    monkeypatch.setattr(issues.similarity, "ratio", ratio)
    pages = spark.createDataFrame([(str(i), 1, "Fish and Farm Journal\nGazette") for i in range(6)], "issue_id string, page_number int, masthead_band string")
    titles = spark.createDataFrame([(str(i), 1, "Fish and Form Journals") for i in range(6)], "issue_id string, page_number int, title string")
    assert {r["masthead_text"] for r in issues._unlike_headlines(pages, titles).collect()} == {"Gazette"}
    assert seen.value == 1


def test_corpus_texts_are_dealt_by_the_issue_alone(spark):
    issues = spark.createDataFrame([(i, "N", "page_headers", "C", "P", None, None, None, "1950", None, None) for i in ("1", "2")], ISSUE + ", date string, day_of_week string, date_precision string").withColumn("newspaper_canonical", F.lit("N"))
    arts = art(spark, [("1", "a", "w " * 20, 20), ("1", "b", "v " * 20, 20), ("2", "a", "u " * 20, 20)])
    fixed = spark.createDataFrame([("1", "a", "new text", "m", "t"), ("1", "a", "new text", "m", "u"), ("1", "b", None, "m", "t"), ("1", None, "lost", "m", "t"), ("3", "a", "of no issue", "m", "t")], S.CORRECTIONS)
    rows = corpus.article_rows(arts, issues, fixed)
    got = sorted((r.issue_id, r.article_id, r.word_count, r.corrected, r.text_normalized[:8]) for r in rows.collect())
    assert got == [("1", "a", 2, True, "new text"), ("1", "b", 20, None, "v v v v "), ("2", "a", 20, None, "u u u u ")]
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for c, v in zip(before, ("-1", "false"), strict=True):
            spark.conf.set(c, v)
        plan = corpus.article_rows(arts, issues, fixed)._jdf.queryExecution().executedPlan().toString()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    # the corrections alone are dealt by the article, to be distinct
    assert len([x for x in plan.split("\n") if "Exchange hashpartitioning(issue_id" in x and "article_id" in x.split("), ")[0]]) == 1
