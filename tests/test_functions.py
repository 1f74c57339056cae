"""Scalar rules: expected values by hand from the rules, one row per branch."""

import pytest
from pyspark.sql import functions as F

from pressline.functions import dates, headers, regions, similarity, text


def apply(spark, f, *values):
    rows = spark.createDataFrame([(i, *v) if isinstance(v, tuple) else (i, v) for i, v in enumerate(values)], ["i", *(f"c{k}" for k in range(len(values[0]) if isinstance(values[0], tuple) else 1))])
    n = len(rows.columns) - 1
    return [r.v for r in rows.select("i", f(*(F.col(f"c{k}") for k in range(n))).alias("v")).orderBy("i").collect()]


def test_x1_normalize_line(spark):
    cases = {
        "a­b x\x18y": "ab xy", "a b": "ab", "one<br/>two<BR>": "one two", "<b>bold</b> <EM>x</em>": "bold x", r"\text{abc} \frac{1}{2}": "abc 1/2",
        r"\bullet go": "• go", r"a\quad b\;c": "a b c", r"a\\b": "a b", "<math>7</math>": "7", "Co-Operate|To": "Co-Operate To", "  a \t b ": "a b", "": "",
    }
    assert apply(spark, text.normalize_line, *cases) == list(cases.values())


def test_x1_is_idempotent_on_plain_text(spark):
    plain = ["Plain words, as printed.", "Zahlen 12 und mehr"]
    assert apply(spark, text.normalize_line, *plain) == plain


def test_x2_join_lines(spark):
    lines = [["news-", "paper is", "read", "By all", "", "|", "end"], ["well-", "Known"], ["stop.", "then"], [], ["a-"]]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, c array<string>").select("i", text.join_lines(F.col("c")).alias("v")).orderBy("i").collect()
    assert [r.v for r in rows] == ["newspaper is read\nBy all end", "well-\nKnown", "stop.\nthen", "", "a-"]


def test_x3_x4_x5_x7(spark):
    assert apply(spark, text.strip_urls, "see www.a.b/c now", "at news.example.com/x?y end", "no.url") == ["see now", "at end", "no.url"]
    assert apply(spark, text.alpha_proxy, "", "....", "ab.d") == [0.0, 0.3, 0.75]
    assert apply(spark, text.alpha_ratio, "", "a1", "ab") == [0.0, 0.5, 1.0]
    assert apply(spark, text.word_count, "a b  c\n", "", " ") == [3, 0, 0]


def test_f2_f3_a17(spark):
    loop = "one two three " * 4
    assert apply(spark, text.is_repetitive, loop, "one two three", "a b c d e f g h i") == [True, False, False]
    assert apply(spark, text.is_garbage, "..ab..", "12345 678", "ab cd ef gh", "@@##$$%% abc", loop, "plain words here") == [True, True, True, True, True, False]


def test_f18_x20_x24(spark):
    assert apply(spark, lambda c: text.ellipsis(c, 4), "abcd", "abcde") == ["abcd", "abc…"]
    assert apply(spark, headers.name_case, "DAILY GLEANER") == ["Daily Gleaner"]
    assert apply(spark, headers.name_from_file, "the_daily-news_19500102", "o'brien_3rd", "") == ["The Daily News", "O'Brien 3Rd", "Unknown"]


def test_x8_x9_x10_x11(spark):
    assert apply(spark, dates.date_from_filename, "a_19500102", "a_1950-01-02_b", "a_1950.01.02", "a_1950_01_02", "a_1950-01-02x", "none") == ["1950-01-02"] * 4 + [None, None]
    assert apply(spark, dates.day_of_week, "2024-01-01", "2024-99-99", "2024-01", "unknown") == ["Monday", None, None, None]
    assert apply(spark, dates.date_precision, "2024-99-99", "2024-01", "unknown") == ["day", "month", None]
    assert apply(spark, dates.denoise_year, ", Tl954", "I95O", "none") == ["1954", "1950", None]


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("SAINT JOHN, N. B., Monday, Jan. 5, 1950", ("SAINT JOHN", "N.B.", "1950-01-05")),
        ("Boston, Mass., 5th March, l951", ("Boston", "Mass.", "1951-03-05")),
        ("Boston, Mass., March 45, 1951", None),
        ("Boston, Monday, Jan 5, 1950", None),
        ("Monday, Ohio, Jan 5, 1950", None),
        ("Boston, New  York, Jan 5 Price", ("Boston", "New York", None)),
        ("x\nBad, Ohio, Jan 50, 1950\nGood, Ohio, Jan 5, 1950", ("Good", "Ohio", "1950-01-05")),
        ("", None),
    ],
)
def test_x12_x13_dateline(spark, line, want):
    got = apply(spark, dates.parse_dateline, line)[0]
    assert (tuple(got) if got else None) == want


def test_x14_suffix(spark):
    lines = ["GLEANER Boston, Ohio, Jan 5, 1950", "plain"]
    assert apply(spark, dates.strip_dateline_suffix, *lines) == ["", "plain"]
    assert apply(spark, dates.dateline_suffix, "1: Boston, Ohio, Jan 5, 1950", "plain") == ["Boston, Ohio, Jan 5, 1950", ""]
    assert apply(spark, dates.strip_dateline_suffix, "1: Boston, Mon, Jan 5, 1950") == ["1: Boston, "]


def test_x15(spark):
    assert apply(spark, dates.date_from_text, "x\nmarching 12, 1950", "March 1950", "jan. 3rd 1950", "none", "\n" * 25 + "jan 3 1950") == ["1950-03-12", "1950-03", "1950-01-03", None, None]


def test_x16_x17_x18_x19(spark):
    assert [tuple(x) if x else None for x in apply(spark, headers.parse_imprint, "12 Main, Saint John, NB 04101", "Ottawa, ON K1A 0B1", "on Monday, NB 04101", "none")] == [("Saint John", "NB"), ("Ottawa", "ON"), None, None]
    assert [tuple(x) if x else None for x in apply(spark, headers.parse_volume, "VOL. XI NO. 5", "No. 12 - 41 ST YEAR", "YOL. 3.4", "none")] == [("XI", "5"), ("41", "12"), ("3", "4"), None]
    assert apply(spark, headers.extract_masthead, "THE DAILY NEWS\nTHE LONGER DAILY NEWS\nPOOR DOCUMENT", "The Daily News Paper", "SHORT", "JANUARY 5, 1950 EDITION") == ["THE LONGER DAILY NEWS", None, None, None]
    assert apply(spark, lambda c: headers.extract_masthead(c, True), "The Daily News Paper") == ["The Daily News Paper"]
    assert apply(spark, headers.header_tokens, "The Page of 5 Evening NEWS", "SECTION TWO") == [["THE", "EVENING", "NEWS"], ["SECTION"]]


def test_f9_f10_w8(spark):
    assert apply(spark, headers.is_artifact, "Poor Document", "First  Section", "PART 2", "presorted", "SECTION") == [True, True, True, True, False]
    assert apply(spark, dates.is_weekday, "Mon.", "mo", "Sunday,", "Sundays") == [True, False, True, False]
    assert apply(spark, headers.lead_headline, "Untitled", "short", "A headline of some length", "") == [False, False, True, False]


def test_x21_x22_x25_a18(spark):
    assert apply(spark, headers.place_key, "N. B.", "New Brunswick") == ["nb", "newbrunswick"]
    assert apply(spark, headers.variant_key, "The  Daily-News!", "An Era", "Theatre") == ["daily news", "era", "theatre"]
    assert apply(spark, headers.page_number, "7", "Twelve", "ninety") == [7, 12, None]
    said = "Continued on page two, continued on Page 5 continued  FROM page ninety"
    assert apply(spark, lambda c: headers.continuation(c, "on"), said) == [5]
    assert apply(spark, lambda c: headers.continuation(c, "from"), said, "continued from page 3") == [None, 3]


def test_w7_first_nonempty(spark):
    assert apply(spark, headers.first_nonempty, ("", "b"), (None, ""), ("a", "b")) == ["b", None, "a"]


def test_j7_s15_regions(spark):
    table = regions.region_table(spark, {"A": ["North", "Shared"], "B": ["Shared", "St. X"], "_note": ["Z"]})
    assert {r.region_key: r.country for r in table.collect()} == {"NORTH": "A", "SHARED": None, "STX": "B"}
    rows = spark.createDataFrame([("N.B.",), ("Bavaria",), (None,)], "province string")
    assert {r.province: r.country for r in regions.with_country(rows).collect()} == {"N.B.": "Canada", "Bavaria": None, None: None}


def test_similarity(spark):
    assert similarity.words_match("EVENING TELEGRAPH", "Evening Telegrapm")
    assert not similarity.words_match("EVENING", "EVENING NEWS")
    assert not similarity.words_match("tide", "diet")
    rows = spark.createDataFrame([("Daily Gleaner", "DAILY GLEANFR"), ("a b", "a")], "a string, b string")
    assert [r.v for r in rows.select(similarity.phrases_match(F.col("a"), F.col("b")).alias("v")).collect()] == [True, False]


def test_an_item_occurs_k_times_by_few_probes(spark):
    import random

    from pressline.functions.text import _occurs

    r = random.Random(3)
    rows = [([r.choice("abcd") for _ in range(r.randint(4, 12))], r.randint(2, 4)) for _ in range(400)]
    got = [x.o for x in spark.createDataFrame(rows, "w array<string>, k int").select(_occurs(F.col("w"), F.col("k")).alias("o")).collect()]
    assert got == [max(map(w.count, w)) >= k for w, k in rows] and len(set(got)) == 2


def test_plain_texts_are_told_by_at_most_two_ranges_and_odd_ones_counted_alike(spark):
    # three ranges and more are looked through some ten times slower
    for known in (text.UNUSUAL, text.NOT_PLAIN):
        assert known.startswith("[^") and known.count("-") <= 2
    cases = ["a b", "a\nb", "a\n\nb", "a \n\n b\n", "\na", " a", "a ", "a  b", "a\tb", "a\xa0b", "a  b", "\xe9t\xe9 d\xe9j\xe0", "中 文", "\n \n", "a\x1cb", "　"]
    assert apply(spark, text.word_count, *cases) == [len(c.split()) for c in cases]
    assert apply(spark, text.normalize_line, "a\xadb\xbb c", "x​  y", "p|q", "•  r", "■s", "a\x7fb", "<u>t") == ["ab\xbb c", "x y", "p q", "• r", "s", "ab", "t"]
