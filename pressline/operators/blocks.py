"""Lines to layout boxes, boxes to blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressline.functions.geometry import MIN_OVERLAP, PICTURE_LEAD, PICTURES, TEXT_WINS, bands, bleeds, box, first_shared, overlap_fraction
from pressline.functions.text import join_normalized, normalize_line
from pressline.session import stored
from pressline.sources import schemas as S

# Labels that stay without text, and lines that make a picture a text.
NON_TEXT = ["Picture", "Figure", "Table", "Equation", "Form", "Code"]
RELABEL_LINES = 4
UNASSIGNED = "Unassigned"


def numbered_boxes(boxes: DataFrame, key: list[str]) -> DataFrame:
    """W5. Boxes with box_seq, their place by position before any is dropped, from 1."""
    return boxes.withColumn("box_seq", F.row_number().over(Window.partitionBy(*key).orderBy("position", "box_no")))


def assign_lines(lines: DataFrame, boxes: DataFrame, key: list[str]) -> DataFrame:
    """J3, J4. lines with box_seq and fraction of the box they go to; null where none takes them.

    An interval join on bands of the page, in which a pair counts where it first meets; the best
    text box and the best picture of a line come from one aggregation over its few candidates,
    the choice from a CASE.
    A line that bleeds out of its box goes to no other.
    """
    area = boxes.select(*key, "box_seq", "label", *(F.col(s).alias(f"b_{s}") for s in S.SIDES))
    fraction = overlap_fraction(box(), box("b_"))
    by_band = lambda df, low, high, name: df.withColumn(name, bands(F.col(low), F.col(high))).withColumn("band", F.explode(name))
    met = by_band(lines.select(*key, "line_no", *S.SIDES), "y0", "y1", "own").join(by_band(area, "b_y0", "b_y1", "other"), [*key, "band"])
    met = met.where(F.col("band") == first_shared(F.col("own"), F.col("other"))).drop("own", "other", "band")
    near = met.withColumn("fraction", fraction).where(F.col("fraction") >= MIN_OVERLAP)
    candidate = F.struct("fraction", (-F.col("box_seq")).alias("order"), *(f"b_{s}" for s in S.SIDES))
    picture = F.col("label").isin(PICTURES)
    best = near.groupBy(*key, "line_no").agg(F.max(F.when(~picture, candidate)).alias("text"), F.max(F.when(picture, candidate)).alias("picture"))
    use_text = F.col("text").isNotNull() & (F.col("picture").isNull() | (F.col("text.fraction") >= TEXT_WINS) | (F.col("text.fraction") >= F.col("picture.fraction") - PICTURE_LEAD))
    best = best.select(*key, "line_no", F.when(use_text, F.col("text")).otherwise(F.col("picture")).alias("best"))
    joined = lines.join(best, [*key, "line_no"], "left")
    extent = lambda pick, i, side: F.coalesce(pick(F.transform("words", lambda w: F.get(w["bbox"], F.lit(i)))), F.col(side))
    out = bleeds(extent(F.array_min, 0, "x0"), extent(F.array_max, 2, "x1"), lambda s: F.col(f"best.b_{s}"))
    kept = F.when(F.col("best").isNotNull() & ~out, F.col("best"))
    return joined.withColumn("box_seq", -kept["order"]).withColumn("fraction", kept["fraction"]).drop("best")


def _rollup(key: list[str]) -> list:
    """Aggregates of the lines of one block, in reading order of the lines."""
    entry = F.struct("y0", "x0", "line_no", "text", "confidence", "x1", "y1", "words")
    return [
        F.sort_array(F.collect_list(entry)).alias("own"),
        F.avg("confidence").alias("mean"),
        F.when(F.min("source") < F.max("source"), "mixed").when(F.max("source") == "embedded", "embedded").otherwise("surya").alias("source"),
        *(F.min(s).alias(f"u_{s}") for s in S.SIDES[:2]),
        *(F.max(s).alias(f"u_{s}") for s in S.SIDES[2:]),
    ]


def build_blocks(lines: DataFrame, boxes: DataFrame, key: list[str] | None = None) -> DataFrame:
    """J3-J5, F6, F7, W5, W6, U2, A3-A5. Blocks of every page with block_seq in reading order.

    A text box without lines is dropped, a picture with RELABEL_LINES lines is
    text. Lines that no box takes make one Unassigned block for the page, numbered
    after the kept ones, so its id can repeat a box's (Q1); block_seq is the key.
    Lines and boxes are written once, as each is read several times; so is no block made twice: lines that
    no box takes come out of the same join, and the page's counts from windows over it.
    """
    key = key or S.PAGE_KEY
    lines, boxes = stored(lines, "lines"), stored(numbered_boxes(boxes, key), "boxes")
    placed = assign_lines(lines, boxes, key)
    own = placed.groupBy(*key, "box_seq").agg(*_rollup(key))
    both = boxes.withColumnRenamed("confidence", "layout_confidence").join(own, [*key, "box_seq"], "full")
    boxed = F.col("box_seq").isNotNull()
    count = F.when(F.col("own").isNull(), 0).otherwise(F.size("own"))
    relabel = boxed & F.col("label").isin(PICTURES) & (count >= RELABEL_LINES)
    both = both.withColumn("relabeled", relabel).withColumn("label", F.when(~boxed, UNASSIGNED).when(relabel, "Text").otherwise(F.col("label")))
    keep, on_page = boxed & ((count > 0) | F.col("label").isin(NON_TEXT)), Window.partitionBy(*key)
    both = both.withColumns({"keep": keep, "kept": F.count_if(keep).over(on_page), "total": F.count("box_seq").over(on_page)}).where(F.col("keep") | ~boxed)
    either = lambda box, loose, name: F.when(boxed, box).otherwise(loose).alias(name)
    blocks = both.select(
        *key, either(F.col("box_seq"), F.col("kept") + 1, "number"), "label", either(F.col("position"), F.col("total"), "reading_order"), *(either(F.col(s), F.col(f"u_{s}"), s) for s in S.SIDES),
        either(F.col("polygon"), F.array().cast("array<array<double>>"), "polygon"), either(F.round("layout_confidence", 4), F.lit(0.0), "layout_confidence"), "mean", F.coalesce("source", F.lit("surya")).alias("source"), "own", "relabeled",
    )
    page = F.col("page_number") if "page_number" in key else F.lit(1)
    raw = F.transform("own", lambda x: x["text"])
    words = lambda x: F.coalesce(x["words"], F.array().cast(f"array<{S.WORD}>")).alias("words")
    line = lambda x: F.struct(x["text"].alias("text"), normalize_line(x["text"]).alias("normalized"), F.round(x["confidence"], 4).alias("confidence"), F.array(x["x0"], x["y0"], x["x1"], x["y1"]).alias("bbox"), words(x))
    # the Unassigned block is made last, so it comes last among equals
    order = Window.partitionBy(*key).orderBy("reading_order", "y0", "x0", F.col("label") == UNASSIGNED, "number")
    blocks = blocks.select(
        *key, F.row_number().over(order).alias("block_seq"), F.format_string("p%db%03d", page, F.col("number")).alias("block_id"), "label", "reading_order", *S.SIDES, "polygon", "layout_confidence",
        F.round(F.coalesce("mean", F.lit(0.0)), 4).alias("ocr_confidence"), "source", F.coalesce(F.array_join(raw, "\n"), F.lit("")).alias("text_original"),
        F.coalesce(F.transform("own", line), F.array().cast(f"array<{S.LINE}>")).alias("lines"), "relabeled",
    )
    # each line is normalized once
    joined = F.coalesce(join_normalized(F.transform("lines", lambda x: x["normalized"])), F.lit("")).alias("text_normalized")
    return blocks.select(*[c for c in blocks.columns if c not in ("lines", "relabeled")], joined, "lines", "relabeled")


def coverage(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """A7. (page, surya_chars, embedded_chars, ratio, low): text found against the text layer."""
    from pressline.functions.text import strip

    text = blocks.groupBy(*S.PAGE_KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_seq", "text_normalized"))), lambda b: b["text_normalized"]), " ").alias("text"))
    # lengths meet, not texts
    found, there = F.length(strip("text")), F.length(strip(F.coalesce("embedded_text", F.lit(""))))
    joined = sizes.select(*S.PAGE_KEY, there.alias("embedded_chars")).join(text.select(*S.PAGE_KEY, found.alias("surya_chars")), S.PAGE_KEY, "left")
    return with_ratio(joined.select(*S.PAGE_KEY, F.coalesce("surya_chars", F.lit(0)).alias("surya_chars"), "embedded_chars"))


def with_ratio(df: DataFrame) -> DataFrame:
    """ratio to three places and low, which looks at the ratio before it is rounded."""
    ratio = F.when(F.col("embedded_chars") > 0, F.col("surya_chars") / F.col("embedded_chars")).otherwise(F.lit(1.0))
    return df.withColumn("ratio", F.round(ratio, 3)).withColumn("low", ratio < 0.5)
