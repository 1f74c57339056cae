"""Dates and datelines of printed pages, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressline.functions.text import SPACE, let, split_lines, strip

# Names of months and weekdays and their stems.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
STEMS = [m[:3] for m in MONTHS]
WEEKDAYS = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
DAY_STEM = "mon|tues|wednes|thurs|fri|satur|sun"
FIRST_YEAR, LAST_YEAR = 1900, 2100
TOP_LINES = 25

_S = f"[{SPACE}]"
CITY = r"((?-i:[A-Z])[A-Za-z .\-]{2,})"
PROVINCE = r"((?-i:[A-Z])[A-Za-z .\-]{1,20})"
_DAY_NAME = rf"(?:(?:{DAY_STEM})[a-z]*{_S}*,?{_S}*)?"
_MONTH = "(" + "|".join(STEMS) + ")"
_AFTER_MDY = rf"{_S}*,{_S}*{_DAY_NAME}{_MONTH}[a-z]*\.?{_S}+(\d{{1,2}})([^\n]*)"
_AFTER_DMY = rf"{_S}*,{_S}*{_DAY_NAME}(\d{{1,2}})(?:st|nd|rd|th)?{_S}+{_MONTH}[a-z]*\.?,?{_S}*([^\n]*)"
MDY = rf"{CITY}{_S}*,{_S}*{PROVINCE}{_AFTER_MDY}"
DMY = rf"{CITY}{_S}*,{_S}*{PROVINCE}{_AFTER_DMY}"
#: Text before the first dateline anywhere, its city part, and its province.
SUFFIX = rf"(?is)^(.*?)({CITY}{_S}*,{_S}*){PROVINCE}{_AFTER_MDY}".replace(CITY, "(?:" + CITY[1:-1] + ")")
TEXT_DAY = rf"\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[.,]?{_S}+(\d{{1,2}})(?:st|nd|rd|th)?,?{_S}+(\d{{4}})\b"
TEXT_MONTH = rf"\b({'|'.join(MONTHS)})\.?,?{_S}+(\d{{4}})\b"
FILE_DATE = [rf"(\d{{4}}){sep}(\d{{2}}){sep}(\d{{2}})(?:_[a-zA-Z]+)?\z" for sep in ("", "-", r"\.", "_")]


def date_from_filename(issue_id: Column) -> Column:
    """X8. YYYY MM DD at the end of an id, separators tried in order; not checked against the calendar."""
    tries = [F.when(issue_id.rlike(p), F.concat_ws("-", *(F.regexp_extract(issue_id, p, g) for g in (1, 2, 3)))) for p in FILE_DATE]
    return F.coalesce(*tries)


def day_of_week(date: Column) -> Column:
    """X9. English weekday of a real, complete date, else null."""
    return F.date_format(F.try_to_date(date, "yyyy-MM-dd"), "EEEE")


def date_precision(date: Column) -> Column:
    """X10."""
    return F.when(date.rlike(r"^\d{4}-\d{2}-\d{2}\z"), "day").when(date.rlike(r"^\d{4}-\d{2}\z"), "month")


def denoise_year(token: Column) -> Column:
    """X11. First four digits after reading look-alike letters as digits."""
    return F.nullif(F.regexp_extract(F.translate(token, "lLI|Oo", "111100"), r"(\d{4})", 1), F.lit(""))


def is_weekday(token: Column) -> Column:
    """F10. A weekday, whole or cut to three letters or more."""
    t = F.lower(F.regexp_replace(strip(token), r"[.,]+\z", ""))
    return let(t, lambda x: (F.length(x) >= 3) & F.exists(F.array(*map(F.lit, WEEKDAYS)), lambda d: F.startswith(d, x)))


def month_number(stem: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, STEMS)), F.lower(F.left(stem, F.lit(3)))).cast("int")


def _dateline(city: Column, province: Column, day: Column, month: Column, rest: Column) -> Column:
    """X13. Struct (city, province, date), or null where the parts make no dateline."""

    def known(r: Column) -> Column:
        last = F.get(r["parts"], F.size(r["parts"]) - 1)
        cut = F.when((F.size(r["parts"]) > 0) & is_weekday(F.coalesce(last, F.lit(""))), F.array_join(F.slice(r["parts"], 1, F.greatest(F.size(r["parts"]) - 1, F.lit(0))), " ")).otherwise(r["province"])
        return let(cut, lambda p: judged(r, p))

    def judged(r: Column, p: Column) -> Column:
        bad = ~r["day"].between(1, 31) | F.lower(r["city"]).isin(WEEKDAYS) | (p == "") | is_weekday(p)
        shown = F.when(F.contains(p, F.lit(".")), F.regexp_replace(p, f"{_S}+", "")).otherwise(F.regexp_replace(p, f"{_S}+", " "))
        date = F.when(r["year"].between(FIRST_YEAR, LAST_YEAR), F.format_string("%d-%02d-%02d", r["year"], r["month"], r["day"]))
        return F.when(~bad, F.struct(r["city"].alias("city"), shown.alias("province"), date.alias("date")))

    parts = F.filter(F.split(province, f"{_S}+"), lambda w: w != "")
    read = F.struct(strip(city).alias("city"), strip(province).alias("province"), parts.alias("parts"), day.cast("int").alias("day"), month_number(month).alias("month"), denoise_year(rest).cast("int").alias("year"))
    return let(read, known)


def parse_dateline(text: Column) -> Column:
    """X12. The first valid dateline at a line start, month-day forms before day-month forms.

    Matches become an array; each is taken apart on its own, and the first one
    that passes X13 counts."""

    def first(pattern: str, order: tuple[int, ...]) -> Column:
        found = F.regexp_extract_all(text, F.lit("(?dim)^" + pattern), 0)
        # one match for all groups; only the last, the rest of the line, may hold the mark itself
        groups = F.transform(found, lambda m: F.split(F.regexp_replace(m, "(?di)^" + pattern, "$1\0$2\0$3\0$4\0$5"), r"\x00", 5))
        read = F.transform(groups, lambda g: _dateline(*(F.get(g, F.lit(n - 1)) for n in order)))
        return F.get(F.filter(read, lambda d: d.isNotNull()), F.lit(0))

    # city, province, day, month, rest
    return F.coalesce(first(MDY, (1, 2, 4, 3, 5)), first(DMY, (1, 2, 3, 4, 5)))


def _may(text: Column) -> Column:
    """A comma with a month behind it, without which there is no dateline: a cheap test for most texts."""
    return F.contains(text, F.lit(",")) & text.rlike(rf"(?is),.*{_MONTH}")


def _has_dateline(text: Column) -> Column:
    return _may(text) & text.rlike("(?i)" + MDY)


def dateline_suffix(text: Column) -> Column:
    """X14. The text from its first dateline on; empty without one."""
    return F.when(_has_dateline(text), F.substring(text, F.length(F.regexp_extract(text, SUFFIX, 1)) + 1, F.length(text))).otherwise("")


def strip_dateline_suffix(text: Column) -> Column:
    """X14. The text before its first dateline; its city stays where a weekday stands for the province."""

    def cut(t: Column) -> Column:
        before, city, province = (F.regexp_extract(t, SUFFIX, g) for g in (1, 2, 3))
        return F.when(~_has_dateline(t), t).when(is_weekday(province), F.concat(before, city)).otherwise(before)

    return let(text, cut)


def parse_dateline_anywhere(text: Column) -> Column:
    # no dateline anywhere means none at a line start either
    may = _may(text) & (text.rlike("(?i)" + MDY) | text.rlike("(?dim)^" + DMY))
    return F.when(may, let(dateline_suffix(text), lambda s: F.coalesce(parse_dateline(s), parse_dateline(text))))


def date_from_text(text: Column) -> Column:
    """X15. A written date in the first lines: a day, else a month."""

    def read(top: Column) -> Column:
        day = [F.regexp_extract(top, TEXT_DAY, g) for g in (1, 2, 3)]
        month = [F.regexp_extract(top, TEXT_MONTH, g) for g in (1, 2)]
        return F.when(day[0] != "", F.format_string("%s-%02d-%02d", day[2], month_number(day[0]), day[1].cast("int"))).when(month[0] != "", F.format_string("%s-%02d", month[1], month_number(month[0])))

    return let(F.lower(F.array_join(F.slice(split_lines(text), 1, TOP_LINES), "\n")), read)
