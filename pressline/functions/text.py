"""Text expressions. Everything takes and returns Columns and stays in codegen.

Patterns are written in the syntax that Java and RE2 share. Text classes follow
Unicode strings: white space is SPACE below, letters are \\p{L}, digits \\p{N}.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Inside of a character class: all Unicode white space.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: The same characters one by one.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
WORD_CHAR = r"\p{L}\p{N}_"

# How recognised text is cleaned, in this order.
CLEANING = [
    (r"[\x{ad}\x{200b}\x{feff}\x{a0}\x{25a0}]", ""),
    (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]", ""),
    (rf"(?i)<br[{SPACE}]*/?>", " "),
    (r"(?i)</?(?:b|i|u|em|strong|s)>", ""),
    (r"\\text\{([^{}]*)\}", "$1"),
    (r"\\frac\{([^{}]*)\}\{([^{}]*)\}", " $1/$2"),
    (r"\\bullet", "\u2022"),
    (r"\\quad|\\qquad|\\,|\\;", " "),
    (r"\\\\", " "),
    (r"(?i)</?math>", ""),
    (r"\|", " "),
    (r"[ \t]+", " "),
]
#: One of the characters without which no rule of CLEANING but the last can match.
MARKED = r"[\\<|\x{ad}\x{200b}\x{feff}\x{a0}\x{25a0}\x00-\x08\x0b\x0c\x0e-\x1f\x7f-\x{9f}]"
#: Two ranges at most, as Java looks through three some ten times slower: characters outside may be MARKED, or white space other than a blank.
UNUSUAL, NOT_PLAIN = r"[^\x20-\x7e\x{ae}-\x{1fff}]", r"[^\x20-\x7e\x{a1}-\x{167f}]"
URL = (
    rf"(?i)\b(?:https?://|www\.)[^{SPACE}]+"
    r"|\b[A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)*"
    rf"\.(?:com|org|net|edu|gov|info|biz|uk|ca|us|au|nz|ie)\b(?:/[^{SPACE}]*)?"
)
# Limits of the text tests.
MIN_GARBAGE_LENGTH, MIN_ALPHA, MAX_SPECIAL = 4, 0.25, 0.3
MIN_REPEAT_WORDS, MIN_REPEATS, REPEAT_SHARE = 8, 3, 0.3


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def collapse(text: Column) -> Column:
    """White space runs as one blank, none at the ends; most texts have single blanks already."""
    runs = lambda t: F.contains(t, F.lit("  ")) | t.rlike(NOT_PLAIN)
    return let(text, lambda t: F.when(runs(t), strip(F.regexp_replace(t, rf"[{SPACE}]+", " "))).otherwise(F.trim(t)))


def count_class(text: Column, inside: str) -> Column:
    """How many characters of a class a text has."""
    return F.length(F.regexp_replace(text, f"[^{inside}]+", ""))


def normalize_line(text: Column) -> Column:
    """X1. Drop artifacts, tags and simple markup; collapse blanks; strip.

    Most lines hold none of the characters that all rules but the last begin with."""
    blanks, marked = F.when(F.contains(text, F.lit("\t")) | F.contains(text, F.lit("  ")), F.regexp_replace(text, *CLEANING[-1])).otherwise(text), text
    for pattern, replacement in CLEANING:
        marked = F.regexp_replace(marked, pattern, replacement)
    may = F.contains(text, F.lit("\\")) | F.contains(text, F.lit("<")) | F.contains(text, F.lit("|")) | text.rlike(UNUSUAL)
    return strip(F.when(may & text.rlike(MARKED), marked).otherwise(blanks))


def join_lines(lines: Column) -> Column:
    """X2. One paragraph text of an array of raw lines."""
    return join_normalized(F.transform(lines, normalize_line))


def join_normalized(lines: Column) -> Column:
    """join_lines() of lines that are normalized already.

    A line that starts in lower case is glued to a preceding hyphen or joined by
    a blank to a preceding letter or digit; all others start a new line. Only the
    neighbours matter, so this is linear in the text.
    """

    def joined(clean: Column) -> Column:
        def piece(line: Column, i: Column) -> Column:
            lower = F.left(line, F.lit(1)).rlike(r"[\p{Ll}\x{aa}\x{ba}]")
            before, after = F.get(clean, i - 1), F.get(clean, i + 1)
            gap = F.when(i == 0, "").when(lower & F.endswith(before, F.lit("-")), "").when(lower & F.right(before, F.lit(1)).rlike(r"[\p{L}\p{N}]"), " ").otherwise("\n")
            glued = F.endswith(line, F.lit("-")) & F.coalesce(F.left(after, F.lit(1)).rlike(r"[\p{Ll}\x{aa}\x{ba}]"), F.lit(False))
            return F.concat(gap, F.when(glued, F.left(line, F.length(line) - 1)).otherwise(line))

        return F.array_join(F.transform(clean, piece), "")

    return let(F.filter(lines, lambda x: x != ""), joined)


def strip_urls(text: Column) -> Column:
    """X3. Urls and bare domains as blanks."""
    return collapse(F.when(F.contains(text, F.lit(".")) | F.contains(text, F.lit("://")), F.regexp_replace(text, URL, " ")).otherwise(text))


def alpha_proxy(text: Column) -> Column:
    """X4. Share of letters and digits, 0.3 at least, as a confidence; 0 for an empty text."""
    return F.when(text == "", F.lit(0.0)).otherwise(F.round(F.greatest(F.lit(0.3), count_class(text, r"\p{L}\p{N}") / F.length(text)), 4))


def alpha_ratio(text: Column) -> Column:
    """X5. Share of letters."""
    return F.when(text == "", F.lit(0.0)).otherwise(count_class(text, r"\p{L}") / F.length(text))


def words(text: Column) -> Column:
    return F.filter(F.split(text, rf"[{SPACE}]+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    """X7. How many words() has, without looking at each.

    In most texts single blanks, line ends or empty lines part the words, and are counted by bytes."""

    def count(t: Column) -> Column:
        held = strip(t)
        single = ~(F.contains(t, F.lit("  ")) | F.startswith(t, F.lit(" ")) | F.endswith(t, F.lit(" ")) | t.rlike(NOT_PLAIN))
        blanks = F.octet_length(t) - F.octet_length(F.replace(t, F.lit(" "), F.lit("")))
        return F.when(t == "", 0).when(single, blanks + 1).when(held == "", 0).otherwise(F.size(F.split(held, rf"[{SPACE}]+")))

    return let(F.replace(F.replace(text, F.lit("\n\n"), F.lit(" ")), F.lit("\n"), F.lit(" ")), count)


def split_lines(text: Column) -> Column:
    """Lines without their ends; no empty piece after a final line end. Most texts have no ends but \\n."""
    unix = ~F.replace(text, F.lit("\n"), F.lit(" ")).rlike(NOT_PLAIN)
    whole = F.when(F.endswith(text, F.lit("\n")), F.left(text, F.length(text) - 1)).otherwise(text)
    return F.when(text == "", F.array().cast("array<string>")).when(unix, F.split(whole, "\n")).otherwise(F.split(F.regexp_replace(text, rf"(?:{LINE_END})\z", ""), LINE_END))


def top_trigram(text: Column) -> Column:
    """A17. (most, all): how often the commonest word trigram occurs and how many there are.

    Sorted trigrams are folded into run lengths: n log n, no shuffle."""
    zero = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, t: Column) -> Column:
        run = F.when(a["last"] == t, a["run"] + 1).otherwise(F.lit(1))
        return F.struct(t.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    def count(w: Column) -> Column:
        tris = F.when(F.size(w) > 2, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))))
        most = F.aggregate(F.sort_array(tris), zero, step, lambda a: a["best"])
        return F.struct(F.coalesce(most, F.lit(0)).alias("most"), F.greatest(F.size(w) - 2, F.lit(0)).alias("all"), F.size(w).alias("words"))

    return let(F.regexp_extract_all(text, F.lit("[A-Za-z]+"), 0), count)


def is_repetitive(text: Column) -> Column:
    """F3. Whether a word trigram occurs MIN_REPEATS times and makes up REPEAT_SHARE of all.

    A trigram is only looked for where a word occurs as often."""

    def judge(w: Column) -> Column:
        all_ = F.size(w) - 2
        k = F.greatest(F.lit(MIN_REPEATS), F.ceil(REPEAT_SHARE * all_).cast("int"))
        tris = F.transform(F.sequence(F.lit(0), all_ - 1), lambda i: F.concat_ws(" ", F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return F.when(F.size(w) < MIN_REPEAT_WORDS, False).when(_occurs(w, k), _occurs(tris, k)).otherwise(False)

    return F.when(text.isNotNull(), let(F.regexp_extract_all(text, F.lit("[A-Za-z]+"), 0), judge))


def _occurs(items: Column, k: Column) -> Column:
    """Whether an item occurs k times. Among sorted items such a run holds one of the places k, 2k and so on."""

    def at(s: Column) -> Column:
        run = lambda x: F.get(s, F.array_position(s, x).cast("int") + k - 2) == x
        return F.exists(F.sequence(k - 1, F.size(s) - 1, k), lambda i: F.coalesce(let(F.get(s, i), run), F.lit(False)))

    return let(F.sort_array(items), at)


def is_garbage(text: Column) -> Column:
    """F2. Cheap tests first."""

    def judge(s: Column) -> Column:
        special = F.length(F.regexp_replace(s, rf"[{WORD_CHAR}{SPACE}.,;:'\x22\-()]+", ""))
        return (F.length(s) < MIN_GARBAGE_LENGTH) | ~s.rlike("[A-Za-z]{3,}") | (alpha_ratio(s) < MIN_ALPHA) | (special > MAX_SPECIAL * F.length(s)) | is_repetitive(s)

    return let(F.btrim(text, F.lit("." + SPACES)), judge)


def ellipsis(text: Column, width: int) -> Column:
    """F18."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.length(text) <= width, text).otherwise(F.concat(F.left(text, F.lit(width - 1)), F.lit("\u2026")))


def title_case(text: Column) -> Column:
    """Letters after a non-letter upper, others lower: "o'brien 3rd" -> "O'Brien 3Rd"."""
    return let(F.split(text, ""), lambda chars: F.array_join(F.transform(chars, lambda c, i: F.when((i == 0) | ~F.get(chars, i - 1).rlike(r"\p{L}"), F.upper(c)).otherwise(F.lower(c))), ""))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once.

    Inside the lambdas of array functions an outer expression is computed again for
    each element; a lambda's own argument is not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
