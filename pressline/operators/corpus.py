"""The exported corpus and its manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pressline.functions.text import word_count
from pressline.operators.identity import canonical_names

MIN_WORDS = 15
_META = ["newspaper", "newspaper_canonical", "city", "province", "country", "date", "day_of_week", "date_precision"]


def with_canonical(issues: DataFrame, names: DataFrame | None = None) -> DataFrame:
    names = canonical_names(issues) if names is None else names
    return issues.join(names, "issue_id", "left").withColumn("newspaper_canonical", F.coalesce("canonical", "newspaper")).drop("canonical")


def _image() -> F.Column:
    return F.format_string("pages/page_%03d/page.png", "page_number")


def _long(rows: DataFrame, count: F.Column, min_words: int, counted: bool) -> DataFrame:
    """F11. The rows with enough words; with `counted` all of them, and whether they are long in `__kept`."""
    kept = F.coalesce(count, F.lit(0)) >= min_words
    return rows.withColumn("__kept", kept) if counted else rows.where(kept)


def _beside(texts: DataFrame, issues: DataFrame, how: str = "inner") -> DataFrame:
    """texts joined with a row for each issue, which is what is hashed: long texts are not sorted."""
    return texts.join(issues.hint("shuffle_hash"), "issue_id", how)


def article_rows(articles: DataFrame, issues: DataFrame, corrections: DataFrame | None = None, min_words: int = MIN_WORDS, counted: bool = False) -> DataFrame:
    """X30, J12, J13, F11. Corpus rows of articles; the word limit looks at the text before correction."""
    meta = issues.select("issue_id", *_META)
    if corrections is not None:
        # an issue's corrections come with its other fields, so that texts are dealt by the issue alone
        fixed = corrections.where("article_id is not null").select("issue_id", "article_id", "corrected_text").dropDuplicates(["issue_id", "article_id"])
        fixed = fixed.groupBy("issue_id").agg(F.map_from_entries(F.collect_list(F.struct("article_id", "corrected_text"))).alias("__fixed"))
        meta = meta.join(fixed, "issue_id", "left")
    rows = _beside(_long(articles, F.col("word_count"), min_words, counted), meta)
    if corrections is not None:
        rows = rows.withColumn("corrected_text", F.try_element_at("__fixed", F.col("article_id"))).withColumn("corrected", F.when(F.col("corrected_text").isNotNull(), F.lit(True)))
        rows = rows.withColumn("word_count", F.when(F.col("corrected"), word_count(F.col("corrected_text"))).otherwise(F.col("word_count"))).withColumn("text_normalized", F.coalesce("corrected_text", "text_normalized"))
    else:
        rows = rows.withColumn("corrected", F.lit(None).cast("boolean"))
    return rows.select(
        F.lit("article").alias("type"), "article_id", "issue_id", "newspaper", "newspaper_canonical", "city", "province", F.coalesce("country", F.lit("")).alias("country"), "date", "day_of_week", "date_precision", "page_number",
        "title", "text_normalized", "word_count", "block_ids", "bbox", _image().alias("image"), F.lit("surya").alias("source"), "continues_in_article_id", "continues_from_article_id", "continued_on_page", "continued_from_page", "corrected", *(["__kept"] if counted else []),
    )


def block_rows(blocks: DataFrame, issues: DataFrame, article_issues: DataFrame, min_words: int = MIN_WORDS, counted: bool = False) -> DataFrame:
    """X30, F11. Corpus rows of the blocks of issues that have no article file (Q20)."""
    meta = issues.select("issue_id", "newspaper_canonical", "city", "province", "country")
    rows = _beside(_beside(blocks, article_issues.select("issue_id"), "left_anti"), meta).withColumn("word_count", word_count(F.coalesce("text_normalized", F.lit(""))))
    return _long(rows, F.col("word_count"), min_words, counted).select(
        F.lit("block").alias("type"), "block_id", "issue_id", "newspaper", "newspaper_canonical", "city", "province", F.coalesce("country", F.lit("")).alias("country"), F.col("issue_date").alias("date"), "page_number",
        F.col("article_title").alias("title"), "label", "text_normalized", "word_count", "bbox", _image().alias("image"), F.coalesce("source", F.lit("surya")).alias("source"), *(["__kept"] if counted else []),
    )


def export_corpus(issues: DataFrame, articles: DataFrame, blocks: DataFrame, article_issues: DataFrame | None = None, corrections: DataFrame | None = None, min_words: int = MIN_WORDS, names: DataFrame | None = None) -> DataFrame:
    """C5, U3, K8. One DAG from the tables to the corpus.

    article_issues: issues with an article file, empty ones too; by default those with articles."""
    issues = with_canonical(issues, names)
    present = articles.select("issue_id").distinct() if article_issues is None else article_issues.select("issue_id").distinct()
    return article_rows(articles, issues, corrections, min_words).unionByName(block_rows(blocks, issues, present, min_words), allowMissingColumns=True)


def observed_corpus(issues: DataFrame, articles: DataFrame, blocks: DataFrame, article_issues: DataFrame | None = None, corrections: DataFrame | None = None, min_words: int = MIN_WORDS, names: DataFrame | None = None) -> tuple[DataFrame, Observation]:
    """C5, A12, K8, K9. export_corpus' rows, and an observation that holds export_stats' counts once they are written.

    What is too short, and a mark for each issue, goes through the same plan as far as the count and is
    dropped behind it, so the manifest costs no second pass over the texts."""
    known = with_canonical(issues, names)
    present = articles.select("issue_id").distinct() if article_issues is None else article_issues.select("issue_id").distinct()
    there = present.unionByName(blocks.select("issue_id")).distinct()
    marks = issues.select("issue_id").distinct().join(there, "issue_id", "left_semi").select("issue_id", F.lit("issue").alias("type"), F.lit(False).alias("__kept"))
    rows = article_rows(articles, known, corrections, min_words, True).unionByName(block_rows(blocks, known, present, min_words, True), allowMissingColumns=True).unionByName(marks, allowMissingColumns=True)
    kept, kind, seen = F.col("__kept"), F.col("type"), Observation()
    rows = rows.observe(
        seen, F.count_if(kind == "issue").alias("issues"), F.count_if(kept & (kind == "article")).alias("articles"), F.count_if(kept & (kind == "block")).alias("blocks"),
        F.coalesce(F.sum(F.when(kept, F.col("word_count"))), F.lit(0)).cast("long").alias("words"), F.count_if(~kept & (kind != "issue")).alias("skipped"), F.count_if(kept).alias("row_count"),
    )
    return rows.where(kept).drop("__kept"), seen


def export_stats(issues: DataFrame, articles: DataFrame, blocks: DataFrame, article_issues: DataFrame | None = None, corrections: DataFrame | None = None, min_words: int = MIN_WORDS) -> DataFrame:
    """A12, K9. One row: issues, articles, blocks, words, skipped, row_count.

    One pass over each table with conditional counts, no second export."""
    present = articles.select("issue_id").distinct() if article_issues is None else article_issues.select("issue_id").distinct()
    known = issues.select("issue_id").distinct()
    a = articles.select("issue_id", "article_id", F.coalesce("word_count", F.lit(0)).alias("n")).join(known, "issue_id", "left_semi")
    a = a.withColumn("final", F.col("n"))
    if corrections is not None:
        fixed = corrections.select("issue_id", "article_id", word_count(F.col("corrected_text")).alias("__n")).dropDuplicates(["issue_id", "article_id"])
        a = a.join(fixed, ["issue_id", "article_id"], "left").withColumn("final", F.coalesce("__n", "n"))
    b = blocks.join(present, "issue_id", "left_anti").join(known, "issue_id", "left_semi").select("issue_id", word_count(F.coalesce("text_normalized", F.lit(""))).alias("n"))
    both = a.select("issue_id", "n", "final", F.lit(1).alias("is_article")).unionByName(b.select("issue_id", "n", F.col("n").alias("final"), F.lit(0).alias("is_article")))
    kept = F.col("n") >= min_words
    counted = both.agg(F.count_if(kept & (F.col("is_article") == 1)).alias("articles"), F.count_if(kept & (F.col("is_article") == 0)).alias("blocks"), F.coalesce(F.sum(F.when(kept, F.col("final"))), F.lit(0)).cast("long").alias("words"), F.count_if(~kept).alias("skipped"))
    there = known.join(present.unionByName(blocks.select("issue_id")).distinct(), "issue_id", "left_semi").agg(F.count(F.lit(1)).alias("issues"))
    # two one-row aggregates side by side
    one = F.lit(1).alias("one")
    return there.select("issues", one).join(counted.select("*", one), "one").select("issues", "articles", "blocks", "words", "skipped", (F.col("articles") + F.col("blocks")).alias("row_count"))
