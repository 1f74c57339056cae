"""Blocks to articles: segmentation by gaps and islands, rollup, continuation links."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressline.functions.geometry import GAP_RATIO, MIN_GAP, box, gap_ok, same_column
from pressline.functions.headers import continuation
from pressline.functions.text import let, strip, word_count
from pressline.sources import schemas as S

# Page furniture that is part of no article.
FURNITURE = ["PageHeader", "PageFooter", "Unassigned"]


def segment_blocks(blocks: DataFrame, key: list[str] | None = None, ratio: float = GAP_RATIO, least: float = MIN_GAP) -> DataFrame:
    """W1-W3, F8. Eligible blocks with article_seq, the number of their article on the page.

    An article starts at the first block, a section header, a change of column
    or a large gap; each test looks at the block before, so this is one sort per page.
    Ties in reading order keep the order of block_seq.
    """
    key = key or S.PAGE_KEY
    order = Window.partitionBy(*key).orderBy("reading_order", "y0", "x0", "block_seq")
    rows = blocks.where(~F.col("label").isin(FURNITURE))
    rows = rows.withColumn("__first", F.row_number().over(order) == 1).withColumns({f"__p_{s}": F.lag(s).over(order) for s in S.SIDES})
    before, here = box("__p_"), box()
    starts = F.col("__first") | (F.col("label") == "SectionHeader") | ~same_column(before, here) | ~gap_ok(before, here, ratio, least)
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("article_seq", F.sum(starts.cast("int")).over(running).cast("int")).drop("__first", *(f"__p_{s}" for s in S.SIDES))


def article_rollup(segmented: DataFrame, key: list[str] | None = None) -> DataFrame:
    """A5, A6, A18, W4. One row per article."""
    key = key or S.PAGE_KEY
    entry = F.struct("reading_order", "y0", "x0", "block_seq", "block_id", "label", "text_normalized")
    a = segmented.groupBy(*key, "article_seq").agg(
        F.sort_array(F.collect_list(entry)).alias("own"), F.min("reading_order").alias("reading_order_start"), F.max("reading_order").alias("reading_order_end"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")
    )
    labels = F.transform("own", lambda b: b["label"])
    counts = let(labels, lambda all_: F.transform(F.array_distinct(all_), lambda n: F.struct(n.alias("key"), F.size(F.filter(all_, lambda m: m == n)).alias("value"))))
    text = F.array_join(F.filter(F.transform("own", lambda b: b["text_normalized"]), lambda t: t != ""), "\n\n")
    page = F.col("page_number") if "page_number" in key else F.lit(1)
    first = F.get("own", F.lit(0))
    a = a.withColumn("text_normalized", text)
    return a.select(
        *key, "article_seq", F.format_string("p%da%03d", page, F.col("article_seq")).alias("article_id"), F.when(first["label"] == "SectionHeader", strip(first["text_normalized"])).otherwise("Untitled").alias("title"),
        F.transform("own", lambda b: b["block_id"]).alias("block_ids"), "reading_order_start", "reading_order_end", F.map_from_entries(counts).alias("label_counts"), "text_normalized", word_count(F.col("text_normalized")).alias("word_count"),
        continuation(F.col("text_normalized"), "on").alias("continued_on_page"), continuation(F.col("text_normalized"), "from").alias("continued_from_page"), F.array("x0", "y0", "x1", "y1").alias("bbox"),
    )


def annotate_blocks(blocks: DataFrame, segmented: DataFrame, articles: DataFrame) -> DataFrame:
    """Blocks with article_id and article_title; null for furniture."""
    names = articles.select(*S.PAGE_KEY, "article_seq", "article_id", F.col("title").alias("article_title"))
    own = segmented.select(*S.PAGE_KEY, "block_seq", "article_seq").join(names, [*S.PAGE_KEY, "article_seq"]).drop("article_seq")
    return blocks.join(own, [*S.PAGE_KEY, "block_seq"], "left")


def link_continuations(articles: DataFrame) -> DataFrame:
    """J6. Articles with both link columns.

    A story goes on in the only article of its target page that says it comes from
    this page; with several there is no link. Where two stories claim one
    article, both keep their link and the later one gets the back link (Q9).
    """
    key = ["issue_id", "page_number", "article_seq"]
    a = articles.where("continued_on_page is not null").select("issue_id", "page_number", "article_seq", "article_id", "continued_on_page")
    b = articles.where("continued_from_page is not null").select(F.col("issue_id").alias("__issue"), F.col("page_number").alias("to_page"), F.col("article_seq").alias("to_seq"), F.col("article_id").alias("to_id"), F.col("continued_from_page").alias("from_page"))
    pairs = a.join(b, (a["issue_id"] == b["__issue"]) & (a["continued_on_page"] == b["to_page"]) & (a["page_number"] == b["from_page"]))
    forward = pairs.groupBy(*key, "article_id").agg(F.count(F.lit(1)).alias("n"), F.min("to_page").alias("to_page"), F.min("to_seq").alias("to_seq"), F.min("to_id").alias("continues_in_article_id")).where("n = 1").drop("n")
    back = forward.groupBy("issue_id", F.col("to_page").alias("page_number"), F.col("to_seq").alias("article_seq")).agg(F.max_by("article_id", F.struct("page_number", "article_seq")).alias("continues_from_article_id"))
    return articles.join(forward.select(*key, "continues_in_article_id"), key, "left").join(back, key, "left")
