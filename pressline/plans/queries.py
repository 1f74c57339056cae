"""The engine's queries over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline.functions import dates, headers, text
from pressline.functions.components import connected_components
from pressline.functions.regions import with_country
from pressline.operators import articles as A
from pressline.operators import blocks as B
from pressline.operators import corpus, correct, fusion, identity, issues, reports
from pressline.plans.documents import rebuild, unprocessed
from pressline.plans.fixtures import fixture
from pressline.session import scratch_root
from pressline.sources import schemas as S
from pressline.sources import writers
from pressline.streaming.index_table import IndexTable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
DOC = ["doc_id"]


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _page_blocks(spark: SparkSession, sf: str) -> DataFrame:
    b = fixture(spark, sf, "blocks")
    return b.select("issue_id", "doc_id", F.col("i").alias("reading_order"), F.col("i").alias("block_seq"), F.format_string("p1b%03d", F.col("i") + 1).alias("block_id"), "label", "text_normalized", *S.SIDES)


def _articles(spark: SparkSession, sf: str) -> DataFrame:
    return A.article_rollup(A.segment_blocks(_page_blocks(spark, sf), DOC), DOC)


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "ln").withColumn("words", F.lit(None).cast(f"array<{S.WORD}>"))


def _boxes(spark: SparkSession, sf: str) -> DataFrame:
    none = F.array().cast("array<array<double>>")
    return fixture(spark, sf, "boxes").withColumns({"confidence": F.lit(0.5), "polygon": none})


@query
def segment_articles(spark: SparkSession, sf: str) -> DataFrame:
    return _articles(spark, sf).select("doc_id", "article_seq", "article_id", "title", "text_normalized", "word_count", F.size("block_ids").alias("n_blocks"))


@query
def article_label_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _articles(spark, sf).select("doc_id", "article_id", F.explode("label_counts").alias("label", "n"))


@query
def article_bbox_and_order(spark: SparkSession, sf: str) -> DataFrame:
    return _articles(spark, sf).select("doc_id", "article_id", "reading_order_start", "reading_order_end", *(F.get("bbox", F.lit(i)).alias(s) for i, s in enumerate(S.SIDES)))


@query
def assign_lines_to_boxes(spark: SparkSession, sf: str) -> DataFrame:
    placed = B.assign_lines(_lines(spark, sf), B.numbered_boxes(_boxes(spark, sf), DOC), DOC)
    return placed.where("box_seq is not null").select("doc_id", "line_no", "box_seq", F.round("fraction", 6).alias("fraction"))


@query
def bleed_rejection(spark: SparkSession, sf: str) -> DataFrame:
    placed = B.assign_lines(_lines(spark, sf), B.numbered_boxes(_boxes(spark, sf), DOC), DOC)
    return placed.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count("box_seq").alias("n_assigned"), F.count_if(F.col("box_seq").isNull()).alias("n_rejected"))


@query
def build_blocks(spark: SparkSession, sf: str) -> DataFrame:
    b = B.build_blocks(_lines(spark, sf), _boxes(spark, sf), DOC)
    return b.select("doc_id", "block_seq", "block_id", "label", "reading_order", *S.SIDES, "ocr_confidence", "source", "text_original", "text_normalized", F.size("lines").alias("n_lines"), "relabeled")


@query
def normalize_html_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "pages").select("page_id", F.posexplode(F.split("html", "\n")).alias("line_no", "line"))
    return rows.select("page_id", "line_no", text.normalize_line(F.col("line")).alias("normalized"))


@query
def strip_urls(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", text.strip_urls(F.concat(F.lit("see "), "url", F.lit(" or mail.example.org for more"))).alias("stripped"))


@query
def join_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "breaks").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("own"))
    return rows.select("doc_id", text.join_lines(F.transform("own", lambda x: x["line"])).alias("joined"))


@query
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", text.word_count(F.col("text")).alias("word_count"))


@query
def alpha_shares(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "l").select("doc_id", "i", text.alpha_proxy(F.col("line")).alias("proxy"), F.round(text.alpha_ratio(F.col("line")), 6).alias("ratio"))


@query
def garbage_lines(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "noise").select("doc_id", "i", text.is_garbage(F.col("line")).alias("garbage"))


@query
def repetitive_lines(spark: SparkSession, sf: str) -> DataFrame:
    top = text.top_trigram(F.col("line"))
    return fixture(spark, sf, "noise").select("doc_id", "i", text.is_repetitive(F.col("line")).alias("repetitive"), top["most"].alias("most"))


@query
def upper_median_region(spark: SparkSession, sf: str) -> DataFrame:
    return fusion.text_region(fixture(spark, sf, "blocks"), DOC).select("doc_id", "med", F.col("left").alias("region_left"), F.col("right").alias("region_right"))


@query
def slot_candidates(spark: SparkSession, sf: str) -> DataFrame:
    pairs = fusion.slot_candidates(_lines(spark, sf), fixture(spark, sf, "emb"), DOC)
    return pairs.select("doc_id", "o_line_no", "e_line_no", F.round("width_ratio", 6).alias("width_ratio"))


def _fused(ocr: DataFrame, embedded: DataFrame) -> DataFrame:
    page = lambda df: df.select(F.col("doc_id").cast("string").alias("issue_id"), F.lit(1).alias("page_number"), *[c for c in df.columns if c != "doc_id"])
    return fusion.fuse_lines(page(ocr), page(embedded).withColumn("confidence", text.alpha_proxy(F.col("text")))).select("issue_id", "line_no", "text", "source", *S.SIDES)


@query
def fuse_lines(spark: SparkSession, sf: str) -> DataFrame:
    return _fused(_lines(spark, sf).drop("source"), fixture(spark, sf, "emb"))


@query
def fuse_noisy_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Fusion of lines of which the rules reject some, with long, loose and meeting ones."""
    return _fused(fixture(spark, sf, "read2").withColumn("words", F.lit(None).cast(f"array<{S.WORD}>")), fixture(spark, sf, "emb2"))


@query
def article_text_sources(spark: SparkSession, sf: str) -> DataFrame:
    page = lambda df: df.withColumns({"issue_id": F.col("doc_id").cast("string"), "page_number": F.lit(1)})
    found = correct.secondary_reading(page(_articles(spark, sf)), page(_page_blocks(spark, sf)), page(fixture(spark, sf, "emb")))
    return found.select("issue_id", "article_id", "secondary")


@query
def dateline(spark: SparkSession, sf: str) -> DataFrame:
    d = dates.parse_dateline_anywhere(F.col("header_text"))
    rows = fixture(spark, sf, "heads").withColumn("d", d)
    return rows.select("o_orderkey", F.col("d.city").alias("city"), F.col("d.province").alias("province"), F.col("d.date").alias("date"))


@query
def dateline_suffix(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("header_text")
    return fixture(spark, sf, "heads").select("o_orderkey", dates.strip_dateline_suffix(c).alias("before"), dates.dateline_suffix(c).alias("suffix"))


@query
def imprint_place(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "heads").withColumn("p", headers.parse_imprint(F.col("header_text")))
    return rows.select("o_orderkey", F.col("p.city").alias("city"), F.col("p.province").alias("province"))


@query
def volume_issue(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "heads").withColumn("p", headers.parse_volume(F.col("header_text")))
    return rows.select("o_orderkey", F.col("p.volume").alias("volume"), F.col("p.issue").alias("issue"))


@query
def date_from_text(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "heads").select("o_orderkey", dates.date_from_text(F.col("header_text")).alias("date"))


@query
def date_from_filename(spark: SparkSession, sf: str) -> DataFrame:
    d = F.date_format("o_orderdate", "yyyyMMdd")
    sep = F.element_at(F.array(*map(F.lit, ["", "-", ".", "_"])), (F.col("o_orderkey") % 4 + 1).cast("int"))
    name = F.concat(F.lit("The_paper_"), F.left(d, F.lit(4)), sep, F.substring(d, 5, 2), sep, F.right(d, F.lit(2)), F.when(F.col("o_orderkey") % 3 == 0, "_city").when(F.col("o_orderkey") % 5 == 0, "x9").otherwise(""))
    return table(spark, sf, "orders").select("o_orderkey", dates.date_from_filename(name).alias("date"), headers.name_from_file(name).alias("newspaper"))


@query
def day_of_week(spark: SparkSession, sf: str) -> DataFrame:
    d = F.when(F.col("o_orderkey") % 7 == 0, F.date_format("o_orderdate", "yyyy-MM")).when(F.col("o_orderkey") % 11 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", dates.day_of_week(d).alias("day_of_week"), dates.date_precision(d).alias("date_precision"))


@query
def masthead_lines(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("header_text")
    return fixture(spark, sf, "heads").select("o_orderkey", headers.extract_masthead(c).alias("upper_only"), headers.extract_masthead(c, True).alias("mixed"))


@query
def region_country(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "heads").select("o_orderkey", F.trim(F.split("place", ",")[1]).alias("province"))
    return with_country(rows).select("o_orderkey", "province", "country")


@query
def header_votes(spark: SparkSession, sf: str) -> DataFrame:
    return identity.header_votes(fixture(spark, sf, "heads6")).select("issue_id", "phrase", "votes")


@query
def refine_newspaper(spark: SparkSession, sf: str) -> DataFrame:
    return identity.refine_newspaper(identity.cluster_phrases(identity.header_votes(fixture(spark, sf, "heads6"))))


@query
def masthead_similarity(spark: SparkSession, sf: str) -> DataFrame:
    return identity.masthead_pairs(fixture(spark, sf, "issues"))


@query
def sibling_backfill(spark: SparkSession, sf: str) -> DataFrame:
    filled = identity.backfill(fixture(spark, sf, "issues"))
    return filled.select("issue_id", "newspaper", "newspaper_source", "city", "province", "country", "place_source", F.array_join("filled", ",").alias("filled"))


@query
def canonical_names(spark: SparkSession, sf: str) -> DataFrame:
    return identity.canonical_names(fixture(spark, sf, "issues"))


@query
def same_publication(spark: SparkSession, sf: str) -> DataFrame:
    return identity.same_publication(fixture(spark, sf, "issues"))


@query
def cross_issue_names(spark: SparkSession, sf: str) -> DataFrame:
    index = fixture(spark, sf, "issues")
    # issues of a known place ask with a misread name of their group, others with an exact one
    number = F.col("issue_id").cast("int")
    group = F.when(F.floor(number / 40) % 3 == 0, "0").otherwise(F.floor(number / 40).cast("string"))
    phrase = F.when(F.col("city").isNotNull(), F.concat(F.lit("EVENING TELEGRAPM "), group)).when(number % 2 == 0, "EVENING TELEGRAPH").otherwise("THE EVENING TELEGRAPH")
    asking = index.where("newspaper_source <> 'page_headers'")
    clusters = asking.select("issue_id", phrase.alias("phrase"), F.lit(2).cast("long").alias("votes"), F.lit(0).alias("rank"))
    return identity.cross_issue_names(asking, clusters, index)


@query
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    index = fixture(spark, sf, "issues")
    clusters = index.select("issue_id", F.array_join(headers.header_tokens("newspaper"), " ").alias("phrase"), F.lit(2).cast("long").alias("votes"), F.lit(0).alias("rank")).where("phrase <> ''")
    return identity.reconcile(index, clusters).select("issue_id", "newspaper", "newspaper_source", "city", "province", "country")


@query
def continuation_links(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "stories")
    rows = rows.withColumns({"continued_on_page": headers.continuation(F.col("text_normalized"), "on"), "continued_from_page": headers.continuation(F.col("text_normalized"), "from")})
    return A.link_continuations(rows).drop("text_normalized")


@query
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    page = lambda df: df.withColumns({"issue_id": F.col("doc_id").cast("string"), "page_number": F.lit(1)})
    sizes = page(table(spark, sf, "documents").select("doc_id", F.col("text").alias("embedded_text")))
    found = B.coverage(page(_page_blocks(spark, sf).where("label <> 'PageFooter'")), sizes)
    return found.select(F.col("issue_id").cast("long").alias("doc_id"), "surya_chars", "embedded_chars", "ratio", "low")


def _issue_articles(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(issues, articles, blocks) of one issue per document; every fourth has no article file."""
    index = fixture(spark, sf, "issues").withColumns({"day_of_week": dates.day_of_week(F.col("date")), "date_precision": dates.date_precision(F.col("date"))})
    # by the key of the issue from the start, so that articles are not dealt again
    key, pages = ["issue_id"], _page_blocks(spark, sf).withColumn("issue_id", F.col("doc_id").cast("string")).drop("doc_id")
    own = A.article_rollup(A.segment_blocks(pages, key), key).withColumns({"page_number": F.lit(1), "continues_in_article_id": F.lit(None).cast("string"), "continues_from_article_id": F.lit(None).cast("string")})
    blocks = _page_blocks(spark, sf).withColumns({"issue_id": F.col("doc_id").cast("string"), "page_number": F.lit(1), "article_id": F.lit(""), "article_title": F.lit(""), "layout_confidence": F.lit(0.5), "ocr_confidence": F.lit(0.5), "source": F.lit("surya"), "text_original": F.col("text_normalized")})
    return index, own.where("cast(issue_id as bigint) % 4 <> 3"), writers.flat_blocks(blocks, index)


def _corrections(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("issue_id"), F.lit("p1a001").alias("article_id"), F.concat(F.lit("corrected words of "), F.col("doc_id").cast("string")).alias("corrected_text"))


@query
def export_corpus(spark: SparkSession, sf: str) -> DataFrame:
    index, articles, blocks = _issue_articles(spark, sf)
    out = corpus.export_corpus(index, articles, blocks, corrections=_corrections(spark, sf))
    return out.select("type", "issue_id", "article_id", "block_id", "newspaper", "newspaper_canonical", "city", "country", "date", "day_of_week", "date_precision", "page_number", "title", "label", "text_normalized", "word_count", "image", "source", "corrected")


@query
def export_stats(spark: SparkSession, sf: str) -> DataFrame:
    index, articles, blocks = _issue_articles(spark, sf)
    return corpus.export_stats(index, articles, blocks, corrections=_corrections(spark, sf))


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared scratch, gone when the driver ends."""
    path = f"{scratch_root(spark)}/pressline-{uuid.uuid4().hex}/{name}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(folder)
    system.deleteOnExit(folder)
    return path


@query
def corpus_files(spark: SparkSession, sf: str) -> DataFrame:
    """The manifest that is counted while the corpus is written, read back beside the rows of the files."""
    index, articles, blocks = _issue_articles(spark, sf)
    folder = _scratch(spark, "corpus")
    writers.write_corpus(*corpus.observed_corpus(index, articles, blocks, corrections=_corrections(spark, sf)), folder)
    manifest = spark.read.schema("stats struct<issues:long,articles:long,blocks:long,words:long,skipped:long>, row_count long").json(f"{folder}/manifest.json").select("stats.*", "row_count")
    rows = spark.read.schema("type string, word_count long, text_normalized string").json(f"{folder}/corpus.jsonl")
    read = rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("word_count").alias("words_read"), F.sum(F.length("text_normalized")).alias("chars_read"))
    # one row each; without a partner the counts would differ, and the row be missing
    return manifest.join(read, "row_count").withColumn("rows_read", F.col("row_count"))


@query
def page_files(spark: SparkSession, sf: str) -> DataFrame:
    """articles.ndjson and the nested page documents, written and read back."""
    page = lambda df: df.withColumns({"issue_id": F.col("doc_id").cast("string"), "page_number": F.lit(1)}).drop("doc_id")
    # by the key of the page from the start, so that a page's articles are not dealt again
    blocks, folder = page(_page_blocks(spark, sf)), _scratch(spark, "pages")
    articles = A.article_rollup(A.segment_blocks(blocks))
    sizes = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("issue_id"), F.lit(1).alias("page_number"), F.lit(1600).alias("width"))
    writers.write_json(articles, f"{folder}/articles.ndjson")
    writers.write_table(writers.page_json(sizes, blocks, articles), f"{folder}/pages")
    shape = "schema_version int, page_number int, blocks array<struct<block_seq:int,text_normalized:string>>, articles array<struct<article_seq:int,title:string>>"
    pages = spark.read.parquet(f"{folder}/pages").select("issue_id", F.from_json("json", shape).alias("p"))
    own = spark.read.schema("issue_id string, article_id string, title string, word_count int").json(f"{folder}/articles.ndjson")
    own = own.groupBy("issue_id").agg(F.count(F.lit(1)).alias("n_articles"), F.sum("word_count").alias("words"), F.min_by("title", "article_id").alias("first_title"))
    text = F.array_join(F.transform("p.blocks", lambda b: b["text_normalized"]), "\n")
    found = pages.select("issue_id", F.coalesce(F.size("p.blocks"), F.lit(0)).alias("n_blocks"), F.coalesce(F.length(text), F.lit(0)).alias("chars"), F.coalesce(F.size("p.articles"), F.lit(0)).alias("nested"))
    return found.join(own, "issue_id", "left").select("issue_id", "n_blocks", "chars", "nested", "n_articles", "words", "first_title")


@query
def index_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The index in hash buckets after a first batch and an upsert."""
    records, new = _index_batches(spark, sf)
    held = IndexTable(spark, _scratch(spark, "index"), buckets=32)
    held.upsert(records, 0)
    held.upsert(new, 1)
    return held.read().select("issue_id", "newspaper", "date", "year", "month", "day", "masthead", "processed_at")


def _index_batches(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(index, new): what the old index lacks, and some of what it has."""
    rows = fixture(spark, sf, "issues").withColumns({c: F.lit(None).cast("string") for c in ("source_pdf", "output_dir", "day_of_week", "date_precision")})
    records = writers.index_record(rows)
    number = F.col("issue_id").cast("int")
    new = records.where((number % 2 == 1) | (number % 3 == 0)).withColumn("newspaper", F.concat(F.lit("New "), "newspaper"))
    return records.where(number % 2 == 0), new


@query
def index_upsert(spark: SparkSession, sf: str) -> DataFrame:
    out = writers.upsert_index(*_index_batches(spark, sf))
    return out.select("issue_id", "newspaper", "date", "year", "month", "day", "masthead", "processed_at")


@query
def unprocessed_issues(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "issues")
    return unprocessed(rows, rows.where("newspaper_source = 'fallback'")).select("issue_id")


@query
def group_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = fixture(spark, sf, "issues")
    return reports.group_report(rows, rows.where("newspaper <> ''").select("issue_id", headers.name_case("newspaper").alias("canonical")))


@query
def stats_report(spark: SparkSession, sf: str) -> DataFrame:
    return reports.stats_report(fixture(spark, sf, "issues"))


@query
def clean_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("issue_id"), F.col("turn").cast("string").alias("article_id"), F.col("text").alias("text_normalized"), text.word_count(F.col("text")).alias("word_count"))
    done = rows.where("article_id = '1'").select("issue_id", "article_id")
    return correct.candidates(rows, done).select("issue_id", "article_id", "word_count")


@query
def sanitize_response(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "answers").select("conv_id", "turn", correct.sanitize(F.col("resp"), F.col("text")).alias("corrected"))


@query
def name_keys(spark: SparkSession, sf: str) -> DataFrame:
    return fixture(spark, sf, "issues").select("issue_id", headers.variant_key(F.col("newspaper")).alias("variant_key"), headers.place_key(F.col("province")).alias("place_key"), text.title_case(F.concat("newspaper", F.lit(" o'brien 3rd st-john"))).alias("title_case"), text.ellipsis(F.col("masthead"), 20).alias("shown"))


@query
def page_texts(spark: SparkSession, sf: str) -> DataFrame:
    page = lambda df: df.withColumns({"issue_id": F.col("doc_id").cast("string"), "page_number": F.lit(1)})
    blocks = page(_page_blocks(spark, sf))
    sizes = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("issue_id"), F.lit(1).alias("page_number"), F.lit(1600).alias("width"), F.lit(900).alias("height"))
    return issues.page_texts(blocks, sizes).select("issue_id", "header", "n_headers", "top_band", "masthead_band", "fallback")


@query
def rebuild_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The whole model-free plan from lines and boxes to issue rows."""
    page = lambda df: df.withColumns({"issue_id": F.col("doc_id").cast("string"), "page_number": F.lit(1)}).drop("doc_id")
    sizes = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("issue_id"), F.lit(1).alias("page_number"), F.lit(1600).alias("width"), F.lit(900).alias("height"), F.col("text").alias("embedded_text"))
    done = rebuild(page(_lines(spark, sf).drop("source")), page(_boxes(spark, sf)), sizes)
    return done.issues.select("issue_id", "newspaper", "newspaper_source", "date", "masthead", "title", "block_count", "article_count", "coverage_min_ratio")


@query
def issue_fronts(spark: SparkSession, sf: str) -> DataFrame:
    """The model-free plan with a text layer and an index: each field from the first of its sources."""
    pieces, ids = fixture(spark, sf, "fronts"), fixture(spark, sf, "flags").select("issue_id", "doc_id")
    sides = [F.lit(0.0).alias("x0"), F.col("y").cast("double").alias("y0"), F.lit(600.0).alias("x1"), (F.col("y") + 12).cast("double").alias("y1")]
    read, layer = pieces.where("label <> 'Layer'"), pieces.where("label = 'Layer'")
    lines = read.select("issue_id", "page_number", F.col("y").alias("line_no"), "text", F.lit(0.9).alias("confidence"), *sides, F.lit(None).cast(f"array<{S.WORD}>").alias("words"))
    boxes = read.select("issue_id", "page_number", F.col("y").alias("box_no"), "label", F.col("y").alias("position"), F.lit(0.5).alias("confidence"), *sides, F.array().cast("array<array<double>>").alias("polygon"))
    pages = ids.select("issue_id", F.explode(F.array(*map(F.lit, (1, 2, 3)))).alias("page_number"))
    sizes = pages.select("*", F.lit(1000).alias("width"), F.lit(1000).alias("height"), F.lit("").alias("embedded_text"))
    own = layer.groupBy("issue_id", "page_number").agg(F.array_sort(F.collect_list(F.struct("y", F.struct("text", *sides).alias("line")))).alias("own"))
    held = F.coalesce(F.transform("own", lambda x: x["line"]), F.array().cast("array<struct<text:string,x0:double,y0:double,x1:double,y1:double>>"))
    layers = pages.join(own, ["issue_id", "page_number"], "left").select("issue_id", "page_number", F.lit(1000.0).alias("pt_width"), F.lit(1000.0).alias("pt_height"), F.array_join(F.transform(held, lambda x: x["text"]), "\n").alias("text"), F.lit("").alias("image"), held.alias("lines"))
    old = ids.where("doc_id % 50 = 0").select(F.concat(F.lit("old_"), "issue_id").alias("issue_id"), (F.col("doc_id") % 100 == 0).alias("first"))
    either = lambda a, b, name: F.when(F.col("first"), a).otherwise(b).alias(name)
    index = old.select("issue_id", either("The Morning Herald News", "Eastern Gazete Weekly", "newspaper"), F.lit("page_headers").alias("newspaper_source"), either("Boston", "Montreal", "city"), either("Mass.", "Que.", "province"), F.lit(None).cast("string").alias("masthead"))
    done = rebuild(lines, boxes, sizes, layers, index)
    return done.issues.select("issue_id", "newspaper", "newspaper_source", "date", "date_source", "date_precision", "day_of_week", "masthead", "volume", "issue", "title", "city", "province", "place_source", "country", "page_count", "block_count", "coverage_min_ratio")


@query
def components(spark: SparkSession, sf: str) -> DataFrame:
    return connected_components(identity.publication_edges([identity.masthead_space(fixture(spark, sf, "issues"))]))
