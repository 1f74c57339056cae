"""Issue metadata from the pages of an issue, by precedence of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressline.functions import dates, headers, similarity
from pressline.functions.regions import with_country
from pressline.functions.text import join_lines, let, normalize_line, split_lines, strip
from pressline.sources import schemas as S

# Bands of the page height that hold nameplates and headers.
TOP_BAND, MASTHEAD_BAND, INNER_BAND, MASTHEAD_BLOCK = 0.26, 0.18, 0.05, 200


def _joined(text: Column, keep: Column, gap: str = "\n") -> Column:
    """Aggregate: texts of the blocks that are kept, in block order."""
    entries = F.array_sort(F.collect_list(F.when(keep, F.struct("block_seq", text.alias("t")))))
    return F.array_join(F.transform(entries, lambda x: x["t"]), gap)


def page_texts(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """F14-F16, S7-like bands: (page, header, n_headers, top_band, masthead_band, fallback, page_text)."""
    rows = blocks.join(sizes.select(*S.PAGE_KEY, "height"), S.PAGE_KEY, "left")
    text = F.col("text_normalized")
    high = F.col("height") > 0
    full = (text != "") & (F.col("label") != "Unassigned")
    return rows.groupBy(*S.PAGE_KEY).agg(
        _joined(text, F.col("label") == "PageHeader").alias("header"),
        F.count_if(F.col("label") == "PageHeader").alias("n_headers"),
        _joined(text, high & full & (F.col("y0") <= F.col("height") * TOP_BAND)).alias("top_band"),
        _joined(text, high & full & (F.col("y0") <= F.col("height") * MASTHEAD_BAND) & (F.length(text) <= MASTHEAD_BLOCK)).alias("masthead_band"),
        _joined(text, high & (text != "") & (F.col("label") == "Text") & (F.col("y0") <= F.col("height") * INNER_BAND)).alias("fallback"),
        join_lines(F.transform(F.array_sort(F.collect_list(F.struct("block_seq", text.alias("t")))), lambda x: x["t"])).alias("page_text"),
    )


def embedded_top_band(pdf_pages: DataFrame) -> DataFrame:
    """S7. (issue_id, embedded_first, embedded_band): page 1 of the text layer and its top band."""
    first = pdf_pages.where("page_number = 1")
    band = F.filter("lines", lambda ln: (ln["y0"] <= F.col("pt_height") * TOP_BAND) & (strip(ln["text"]) != ""))
    return first.select("issue_id", F.coalesce("text", F.lit("")).alias("embedded_first"), F.array_join(F.transform(band, lambda ln: ln["text"]), "\n").alias("embedded_band"))


def _unlike_headlines(pages: DataFrame, articles: DataFrame) -> DataFrame:
    """(issue_id, masthead_text): lines of the masthead band of page 1 that no headline resembles (X23)."""
    lines = pages.where("page_number = 1").select("issue_id", F.posexplode(split_lines(F.col("masthead_band"))).alias("i", "line"))
    titles = articles.where("page_number = 1 and title <> '' and title <> 'Untitled'").select(F.col("issue_id").alias("of"), "title").distinct()
    flat = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    pairs = lines.join(titles, lines["issue_id"] == titles["of"], "left").withColumns({"a": flat(F.col("line")), "b": flat(F.coalesce("title", F.lit("")))})
    both = (F.col("a") != "") & (F.col("b") != "")
    inside = both & (F.contains("a", F.col("b")) | F.contains("b", F.col("a")))
    # 2*min/(m+n) bounds the ratio, so most pairs never reach Python
    bound = 2 * F.least(F.length("a"), F.length("b")) > similarity.HEADLINE_SIMILARITY * (F.length("a") + F.length("b"))
    open_ = pairs.where(both & ~inside & bound).select("a", "b").distinct()
    # no filter on what Python says: it would be moved before the distinct, and each pair judged as often as it occurs
    alike = open_.withColumn("alike", similarity.ratio(F.col("a"), F.col("b")) > similarity.HEADLINE_SIMILARITY)
    judged = pairs.withColumn("inside", inside).join(alike, ["a", "b"], "left").groupBy("issue_id", "i", "line").agg(F.max(F.coalesce("inside", F.lit(False)) | F.coalesce("alike", F.lit(False))).alias("bad"))
    return judged.where(~F.col("bad")).groupBy("issue_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "line"))), lambda x: x["line"]), "\n").alias("masthead_text"))


def issue_metadata(pages: DataFrame, articles: DataFrame, embedded: DataFrame | None = None, newspaper: str | None = None, regions: DataFrame | None = None) -> DataFrame:
    """X29, W7, W8. One row per issue; pages as page_texts gives them.

    Candidates of each field are read from the texts of page 1 and of the inner
    headers, and the first non-empty one wins, in the order of SURVEY 3.4.
    """
    empty = F.lit("")
    first = pages.where("page_number = 1").select("issue_id", "header", "top_band", "page_text")
    inner = pages.where("page_number > 1 and header <> ''").select("issue_id", "page_number", dates.parse_dateline_anywhere(F.col("header")).alias("d"), let(dates.strip_dateline_suffix(F.col("header")), lambda t: headers.extract_masthead(t, True)).alias("m"), headers.parse_volume(F.col("header")).alias("v"))
    pick = lambda c: F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col("page_number"))).alias(f"inner_{c}")
    inner = inner.groupBy("issue_id").agg(pick("d"), pick("m"), pick("v"))
    lead = articles.where("page_number = 1").where(headers.lead_headline(F.col("title"))).groupBy("issue_id").agg(F.min_by("title", "article_seq").alias("lead"))
    issues = pages.groupBy("issue_id").agg(F.count(F.lit(1)).alias("page_count")).join(first, "issue_id", "left").join(inner, "issue_id", "left").join(lead, "issue_id", "left").join(_unlike_headlines(pages, articles), "issue_id", "left")
    issues = issues.join(embedded, "issue_id", "left") if embedded is not None else issues.withColumns({"embedded_first": empty, "embedded_band": empty})
    issues = issues.fillna("", ["header", "top_band", "page_text", "embedded_first", "embedded_band", "masthead_text"])
    header, band, first_text, layer, layer_band = (F.col(c) for c in ("header", "top_band", "page_text", "embedded_first", "embedded_band"))
    issues = issues.withColumn("dateline", F.coalesce(*(dates.parse_dateline_anywhere(t) for t in (header, layer_band, band)), F.col("inner_d")))
    file_date, line_date = dates.date_from_filename(F.col("issue_id")), F.col("dateline.date")
    text_date = F.coalesce(dates.date_from_text(layer), dates.date_from_text(first_text), F.lit("unknown"))
    mast = F.coalesce(headers.extract_masthead(header, True), F.col("inner_m"), headers.extract_masthead(F.col("masthead_text"), True), headers.extract_masthead(layer), headers.extract_masthead(first_text), empty)
    volume = F.coalesce(*(headers.parse_volume(t) for t in (layer_band, layer, first_text)), F.col("inner_v"))
    imprint = F.coalesce(*(headers.parse_imprint(t) for t in (header, band, layer_band)))
    place = F.coalesce(F.when(F.col("dateline").isNotNull(), F.struct(F.col("dateline.city").alias("city"), F.col("dateline.province").alias("province"))), imprint)
    issues = issues.withColumns({
        "newspaper": F.lit(newspaper) if newspaper is not None else headers.name_from_file(F.col("issue_id")),
        "newspaper_source": F.lit("override" if newspaper is not None else "filename"),
        "date": F.coalesce(file_date, line_date, text_date),
        "date_source": F.when(file_date.isNotNull(), "filename").when(line_date.isNotNull(), "dateline").otherwise("text"),
        "masthead": mast,
        "volume_issue": volume,
        "title": F.coalesce("lead", F.when(layer != "", let(F.coalesce(F.get(split_lines(layer), F.lit(0)), empty), normalize_line)), empty),
        "place": place,
        "place_source": F.when(F.col("dateline").isNotNull(), "dateline").when(imprint.isNotNull(), "imprint"),
    })
    out = issues.select(
        "issue_id", "newspaper", "newspaper_source", "date", "date_source", dates.date_precision(F.col("date")).alias("date_precision"), dates.day_of_week(F.col("date")).alias("day_of_week"), "masthead",
        F.coalesce("volume_issue.volume", empty).alias("volume"), F.coalesce("volume_issue.issue", empty).alias("issue"), "title", F.concat("issue_id", F.lit(".pdf")).alias("source_pdf"), F.col("place.city").alias("city"), F.col("place.province").alias("province"), "place_source",
    )
    return with_country(out, regions=regions)


def issue_rollup(issues: DataFrame, sizes: DataFrame, blocks: DataFrame, articles: DataFrame, coverage: DataFrame) -> DataFrame:
    """A11, K5. Issues with counts, page list, coverage and time of processing."""
    count = lambda df, name: df.groupBy("issue_id").agg(F.count(F.lit(1)).alias(name))
    cover = coverage.groupBy("issue_id").agg(F.array_sort(F.collect_list(F.struct("page_number", "ratio", "low"))).alias("coverage_pages"), F.round(F.min("ratio"), 3).alias("coverage_min_ratio"))
    out = issues
    for part in (count(sizes, "page_count"), count(blocks, "block_count"), count(articles, "article_count"), cover):
        out = out.join(part, "issue_id", "left")
    out = out.fillna(0, ["page_count", "block_count", "article_count"]).fillna(1.0, ["coverage_min_ratio"])
    pages = F.when(F.col("page_count") > 0, F.transform(F.sequence(F.lit(1), F.col("page_count").cast("int")), lambda i: F.format_string("pages/page_%03d", i))).otherwise(F.array().cast("array<string>"))
    return out.withColumns({"pages": pages, "output_dir": F.concat(F.lit("output/"), "issue_id"), "processed_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")})
