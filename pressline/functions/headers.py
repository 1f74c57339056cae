"""Page headers, nameplates, volume lines and page references, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressline.functions.dates import MONTHS, STEMS, WEEKDAYS, is_weekday
from pressline.functions.text import SPACE, collapse, count_class, let, normalize_line, null_if_empty, split_lines, strip, strip_urls, title_case

# Words and phrases that headers carry beside a paper's name.
CARDINALS = ["one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen", "nineteen", "twenty"]
ORDINALS = ["first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth"]
STOPWORDS = sorted({"of", "and", "for", "vol", "no", "num", "number", "page", "edition", "price", "cents", "weather", *WEEKDAYS, *MONTHS, *STEMS, *CARDINALS, *ORDINALS})
ARCHIVAL = ["poor document"]
POSTAL = ["presorted", "standard", "first-class", "first class", "presorted standard", "presorted first-class"]
SECTION = rf"(?i)^(?:FIRST|SECOND|THIRD|FOURTH|FIFTH|SIXTH|[0-9]+|ONE|TWO|THREE|FOUR|FIVE|SIX)[{SPACE}]+SECTION\z|^(?:SECTION|PART)[{SPACE}]+(?:ONE|TWO|THREE|FOUR|FIVE|SIX|[0-9]+)\z"
MASTHEAD_DATE = rf"(?i)\b(?:{'|'.join(MONTHS + STEMS)})[a-z]*\.?,?[{SPACE}]+(?:\d{{1,2}}(?:st|nd|rd|th)?,?[{SPACE}]+)?\d{{4}}\b"
IMPRINT = rf"\b([A-Z][A-Za-z.'\-]*(?:[{SPACE}]+[A-Z][A-Za-z.'\-]*){{0,3}})[{SPACE}]*,[{SPACE}]*([A-Z]{{2}})[{SPACE}]+(?:\d{{5}}(?:-\d{{4}})?|[A-Z]\d[A-Z][{SPACE}]?\d[A-Z]\d)\b"
_NO = r"(?:N[EO]?O\.?|NUM\.?|NUMBER)"
VOLUME = [
    (rf"(?i)[VY]OL\.?[{SPACE}]*([0-9]+|[IVXLCDM]+)[{SPACE}]*[,.{SPACE}]*{_NO}[{SPACE}]*([0-9]+)", 1, 2),
    (rf"(?i)N[EO]?O\.?[{SPACE}]*([0-9]+)[{SPACE}]*[\x{{2014}}\x{{2013}}-]+[{SPACE}]*([0-9]+)[{SPACE}]*(?:ST|ND|RD|TH)[{SPACE}]*YEAR", 2, 1),
    (rf"(?i)[VY]OL\.?[{SPACE}]*([0-9]+)\.([0-9]+)\b", 1, 2),
]
MASTHEAD_LENGTH, MASTHEAD_ALNUM, MASTHEAD_UPPER = (8, 110), 0.8, 0.7
MIN_HEADLINE = 12
CONTINUATION = rf"(?i)continued[{SPACE}]+(on|from)[{SPACE}]+page[{SPACE}]+([a-z]+|\d+)"
FINGERPRINT_STOPWORDS = ["the", "and", "for", "its", "with", "from", "that", "this"]
FINGERPRINT_WORDS = 4


def is_artifact(text: Column) -> Column:
    """F9. A scan stamp, a postal mark or a section label."""
    return let(strip(text), lambda t: F.lower(t).isin(ARCHIVAL + POSTAL) | t.rlike(SECTION))


def header_tokens(text: Column) -> Column:
    """X19. Upper-case words of two letters or more that are not stopwords."""
    found = F.regexp_extract_all(F.upper(text), F.lit("[A-Za-z]{2,}"), 0)
    return F.filter(found, lambda w: ~w.isin([s.upper() for s in STOPWORDS]))


def extract_masthead(text: Column, mixed_case: bool = False) -> Column:
    """X18. The longest line that reads like a nameplate, the first on ties; null without one."""
    # step by step, as a lambda's argument is computed once and any other expression for each use
    clean = F.transform(F.transform(let(text, split_lines), normalize_line), strip_urls)
    ends = lambda line: F.left(line, F.lit(1)).rlike("[A-Za-z0-9]") & F.right(line, F.lit(1)).rlike("[A-Za-z0-9]")
    clean = F.transform(clean, lambda line: F.when(ends(line), line).otherwise(F.regexp_replace(line, r"^[^A-Za-z0-9]+|[^A-Za-z0-9]+\z", "")))
    clean = F.transform(clean, lambda line: F.when(F.left(line, F.lit(1)).rlike(r"\d"), F.regexp_replace(line, rf"^\d{{1,3}}[{SPACE}]+", "")).otherwise(line))

    def fits(line: Column) -> Column:
        n = F.length(line)
        case = F.lit(True) if mixed_case else count_class(line, rf"\p{{Lu}}{SPACE}") > MASTHEAD_UPPER * n
        return n.between(*MASTHEAD_LENGTH) & line.rlike(r"^[\p{Lu}\p{Nd}]") & (count_class(line, r"\p{L}\p{N}") > MASTHEAD_ALNUM * n) & case & ~is_artifact(line) & ~line.rlike(MASTHEAD_DATE)

    ranked = F.transform(clean, lambda line, i: F.when(fits(line), F.struct(F.length(line).alias("n"), (-i).alias("i"), line.alias("line"))))
    return F.array_max(F.filter(ranked, lambda x: x.isNotNull()))["line"]


def parse_imprint(text: Column) -> Column:
    """X16. Struct (city, province) of the first publisher's address, or null."""
    city = F.regexp_replace(collapse(F.regexp_extract(text, IMPRINT, 1)), r"^,+|,+\z", "")
    judged = lambda c: F.when((c != "") & ~is_weekday(F.regexp_extract(c, r"([^ ]+)\z", 1)), F.struct(c.alias("city"), F.regexp_extract(text, IMPRINT, 2).alias("province")))
    return F.when(F.contains(text, F.lit(",")) & text.rlike(IMPRINT), let(city, judged))


def parse_volume(text: Column) -> Column:
    """X17. Struct (volume, issue) by the first of three forms that occurs, or null."""
    return F.coalesce(*(F.when(text.rlike(p), F.struct(F.regexp_extract(text, p, v).alias("volume"), F.regexp_extract(text, p, i).alias("issue"))) for p, v, i in VOLUME))


def place_key(place: Column) -> Column:
    """X21."""
    return F.lower(F.regexp_replace(F.coalesce(place, F.lit("")), rf"[.{SPACE}]+", ""))


def variant_key(name: Column) -> Column:
    """X22. A name without case, marks and a leading article."""
    n = F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9 ]", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(n, " +", " ")), r"^(?:the|a|an) +", "")


def name_from_file(issue_id: Column) -> Column:
    """X24."""
    stem = F.regexp_replace(issue_id, r"_\d{8}\z", "")
    return F.when(stem == "", "Unknown").otherwise(title_case(strip(F.regexp_replace(stem, r"[_\-]+", " "))))


def name_case(phrase: Column) -> Column:
    """X20. For phrases of header tokens, which hold letters and blanks only."""
    return F.initcap(F.lower(strip(phrase)))


def fingerprint(masthead: Column) -> Column:
    """Sorted distinct long words of a masthead; empty if they are too few to tell papers apart."""
    found = F.regexp_extract_all(F.lower(F.coalesce(masthead, F.lit(""))), F.lit("[a-z0-9]+"), 0)
    kept = F.array_sort(F.array_distinct(F.filter(found, lambda w: (F.length(w) > 3) & ~w.isin(FINGERPRINT_STOPWORDS))))
    return F.when(F.size(kept) >= FINGERPRINT_WORDS, kept).otherwise(F.array().cast("array<string>"))


def page_number(token: Column) -> Column:
    """X25. Digits or a number word up to twenty, else null."""
    word = F.array_position(F.array(*map(F.lit, CARDINALS)), F.lower(token)).cast("int")
    return F.when(token.rlike(r"^\d+\z"), token.try_cast("int")).when(word > 0, word)


def continuation(text: Column, direction: str) -> Column:
    """A18. Page of the last resolvable "continued on/from page" marker of a direction, or null."""
    ways = F.regexp_extract_all(text, F.lit(CONTINUATION), 1)
    pages = F.transform(F.regexp_extract_all(text, F.lit(CONTINUATION), 2), page_number)
    pairs = F.filter(F.arrays_zip(ways.alias("way"), pages.alias("page")), lambda p: (F.lower(p["way"]) == direction) & p["page"].isNotNull())
    # few texts hold the word at all; the letters of long texts are slow to lower
    return F.when(text.rlike("(?i)continued"), let(pairs, lambda p: F.get(p, F.size(p) - 1)["page"]))


def lead_headline(title: Column) -> Column:
    """W8. Whether a title can be an issue's lead headline."""
    flat = strip(F.regexp_replace(title, "\n", " "))
    return title.isNotNull() & (title != "") & (title != "Untitled") & (F.length(flat) >= MIN_HEADLINE) & ~is_artifact(flat)


def first_nonempty(*texts: Column) -> Column:
    """W7. The first text that is neither null nor empty."""
    return F.coalesce(*map(null_if_empty, texts))
