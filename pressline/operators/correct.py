"""Optional correction of article texts by a language model."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline.functions.geometry import bands, box, x_center, y_center
from pressline.functions.text import SPACE, split_lines, strip
from pressline.sources import schemas as S
from pressline.session import stored
from pressline.sources.providers import Corrector

# Which answers count as corrections of their text.
PREAMBLE = rf"(?i)^(?:here(?:'s| is| are| you go)|below is|the corrected|corrected text|output:?|response:?|sure(?:, here|,)?|ok(?:ay)?|result:?)[:\-]?[{SPACE}]*\z"
SHORTEST, LONGEST, LONGEST_FLOOR = 5, 1.4, 80
MIN_WORDS, MIN_SECONDARY, MARGIN = 15, 20, 10


def candidates(articles: DataFrame, corrections: DataFrame | None = None, force: bool = False, min_words: int = MIN_WORDS) -> DataFrame:
    """F12. Articles with enough text that are not corrected yet."""
    rows = articles.where((F.coalesce("word_count", F.lit(0)) >= min_words) & (strip(F.coalesce("text_normalized", F.lit(""))) != ""))
    return rows if force or corrections is None else rows.join(corrections, ["issue_id", "article_id"], "left_anti")


def prune(corrections: DataFrame, articles: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """F12. Corrections of articles that still qualify."""
    return corrections.join(candidates(articles, min_words=min_words), ["issue_id", "article_id"], "left_semi")


def secondary_reading(articles: DataFrame, blocks: DataFrame, embedded: DataFrame) -> DataFrame:
    """J11. (issue_id, page_number, article_id, secondary): lines of the text layer whose centre lies in
    one of the article's boxes, by position, as an interval join. embedded is in pixels of the page."""
    own = articles.select("issue_id", "page_number", "article_id", F.explode("block_ids").alias("block_id"))
    area = blocks.where("label <> 'Unassigned'").select(*S.PAGE_KEY, "block_id", *(F.col(s).alias(f"b_{s}") for s in S.SIDES))
    line = embedded.select(*S.PAGE_KEY, "line_no", "text", *S.SIDES)
    a, b = box(), box("b_")
    inside = x_center(a).between(b("x0") - MARGIN, b("x1") + MARGIN) & y_center(a).between(b("y0") - MARGIN, b("y1") + MARGIN)
    boxes = own.join(area, [*S.PAGE_KEY, "block_id"]).withColumn("band", F.explode(bands(b("y0") - MARGIN, b("y1") + MARGIN)))
    hits = boxes.join(line.withColumn("band", F.explode(bands(y_center(a), y_center(a)))), [*S.PAGE_KEY, "band"]).where(inside)
    lines = hits.select(*S.PAGE_KEY, "article_id", F.struct("y0", "x0", "line_no", "text").alias("l")).distinct()
    return lines.groupBy(*S.PAGE_KEY, "article_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["text"]), "\n").alias("secondary"))


def sanitize(answer: Column, text: Column) -> Column:
    """X28. The corrected text of a model's answer; null if too short or too long to be one."""
    s = F.regexp_replace(strip(answer), rf"(?i)^```(?:text|txt)?[{SPACE}]*", "")
    s = strip(F.regexp_replace(s, rf"[{SPACE}]*```\z", ""))
    lines = split_lines(s)
    # how many leading lines are preamble: the fold stops counting at the first that is not
    lead = F.aggregate(lines, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda a, x: F.struct((a["n"] + (a["on"] & strip(x).rlike(PREAMBLE)).cast("int")).alias("n"), (a["on"] & strip(x).rlike(PREAMBLE)).alias("on")), lambda a: a["n"])
    clean = strip(F.array_join(F.slice(lines, lead + 1, F.greatest(F.size(lines), F.lit(1))), "\n"))
    n, m = F.length(clean), F.length(text)
    low, high = F.greatest(F.lit(SHORTEST), F.floor(m / 3)), F.greatest(F.lit(LONGEST_FLOOR), F.floor(m * F.lit(LONGEST)))
    return F.when((n >= low) & (n <= high), clean)


def correct(articles: DataFrame, make_corrector: Callable[[], Corrector], model: str, secondary: DataFrame | None = None, corrections: DataFrame | None = None, force: bool = False, min_words: int = MIN_WORDS) -> DataFrame:
    """C4, X32. All corrections after a run: kept ones and new ones.

    A failed call leaves its article uncorrected, a candidate of the next run; how many failed, and of what,
    is warned of. Answers are written out, so no model is asked twice."""
    todo = candidates(articles, corrections, force, min_words).select("issue_id", "page_number", "article_id", "text_normalized")
    if secondary is not None:
        todo = todo.join(secondary, ["issue_id", "page_number", "article_id"], "left")
    else:
        todo = todo.withColumn("secondary", F.lit(""))
    long = F.length(strip(F.coalesce("secondary", F.lit("")))) >= MIN_SECONDARY
    todo = todo.withColumn("secondary", F.when(long, F.col("secondary")).otherwise(""))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = make_corrector()
        for batch in batches:
            answers: list[str | None] = []
            errors: list[str | None] = []
            for text, other in zip(batch["text_normalized"], batch["secondary"], strict=True):
                answer = error = None
                try:
                    answer = ask(text, other)
                except Exception as e:  # one failed call is not the run's end
                    error = type(e).__name__
                answers.append(answer)
                errors.append(error)
            yield batch.drop(columns=["secondary"]).assign(answer=answers, error=errors)

    answered = stored(todo.mapInPandas(run, "issue_id string, page_number int, article_id string, text_normalized string, answer string, error string"), "answers")
    for r in answered.where("error is not null").groupBy("error").count().orderBy("error").limit(20).collect():
        warnings.warn(f"{r['count']} articles stay uncorrected: {r['error']}", stacklevel=2)
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    new = answered.withColumn("corrected_text", sanitize(F.col("answer"), F.col("text_normalized"))).where("corrected_text is not null")
    new = new.select("issue_id", "article_id", "corrected_text", F.lit(model).alias("model"), stamp.alias("corrected_at"))
    if corrections is None:
        return new
    old = prune(corrections, articles, min_words)
    if force:
        old = old.limit(0)
    return old.select(*new.columns).unionByName(new)
