"""The composed plans: rebuild from cached layouts, process from PDFs, batch, export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline.operators import articles as A
from pressline.operators import blocks as B
from pressline.operators import identity, issues
from pressline.operators.fusion import fuse_lines
from pressline.session import discard, discard_paths, noting, stored
from pressline.sources import readers
from pressline.sources import schemas as S
from pressline.sources.providers import ImageModel, PageParser, detect, parse_pdfs
from pressline.sources.writers import index_record


@dataclass
class Documents:
    """The tables of a run."""

    blocks: DataFrame
    articles: DataFrame
    coverage: DataFrame
    issues: DataFrame
    clusters: DataFrame


def rebuild(ocr: DataFrame, boxes: DataFrame, sizes: DataFrame, pdf_pages: DataFrame | None = None, index: DataFrame | None = None, newspaper: str | None = None, honor_override: bool = False) -> Documents:
    """C1, X31 and stages 5 to 12: from lines and boxes to documents, without a model.

    sizes: schemas.PAGE_SIZES. pdf_pages: schemas.PDF_PAGES of the same issues, or None
    where the PDF is not there (Q3). index: issues seen before, donors of names and places.
    honor_override keeps a given name, which header votes would replace (Q2).
    """
    if pdf_pages is None:
        lines, embedded = fuse_lines(ocr), None
    else:
        scaled = pdf_pages.join(sizes.select(*S.PAGE_KEY, "width"), S.PAGE_KEY)
        factor = F.when((F.col("pt_width") > 0) & (F.col("width") > 0), F.col("width") / F.col("pt_width")).otherwise(F.lit(1.0))
        lines = fuse_lines(ocr, readers.embedded_lines(scaled, factor))
        embedded = issues.embedded_top_band(pdf_pages)
        text = pdf_pages.select(*S.PAGE_KEY, F.col("text").alias("__text"))
        sizes = sizes.join(text, S.PAGE_KEY, "left").withColumn("embedded_text", F.coalesce("__text", "embedded_text")).drop("__text")
    with noting() as made:
        blocks = B.build_blocks(lines, boxes)
    plain = stored(blocks, "blocks")
    discard_paths(plain.sparkSession, made)
    segmented = A.segment_blocks(plain)
    # links read the articles four times
    unlinked = stored(A.article_rollup(segmented), "unlinked")
    articles = stored(A.link_continuations(unlinked), "articles")
    discard(unlinked)
    blocks = A.annotate_blocks(plain, segmented, articles)
    coverage = B.coverage(plain, sizes)
    pages = stored(issues.page_texts(plain, sizes), "page_texts")
    meta = issues.issue_metadata(pages, articles, embedded, newspaper)
    clusters = stored(identity.cluster_phrases(identity.header_votes(plain, pages.select(*S.PAGE_KEY, "fallback"))), "clusters")
    named = _name(stored(meta, "meta"), clusters, index, honor_override and newspaper is not None)
    return Documents(blocks, articles, coverage, issues.issue_rollup(named, sizes, plain, articles, coverage), clusters)


def _name(meta: DataFrame, clusters: DataFrame, index: DataFrame | None, keep: bool) -> DataFrame:
    """Stage 10 and 11: the name from the headers, else from confirmed issues, then gaps from siblings."""
    if keep:
        return meta
    own = identity.refine_newspaper(clusters).select("issue_id", F.col("newspaper").alias("__own"))
    named = meta.join(own, "issue_id", "left")
    if index is not None:
        cross = identity.cross_issue_names(meta, clusters, index).select("issue_id", F.col("newspaper").alias("__cross"))
        named = named.join(cross, "issue_id", "left")
    else:
        named = named.withColumn("__cross", F.lit(None).cast("string"))
    named = named.withColumns({"newspaper": F.coalesce("__own", "__cross", "newspaper"), "newspaper_source": F.when(F.col("__own").isNotNull(), "page_headers").when(F.col("__cross").isNotNull(), "cross_issue").otherwise("fallback")}).drop("__own", "__cross")
    if index is None:
        return named
    named = stored(named, "named")
    both = named.unionByName(index.join(named, "issue_id", "left_anti"), allowMissingColumns=True)
    filled = identity.backfill(both).drop("filled")
    return filled.join(named.select("issue_id"), "issue_id", "left_semi").select(*named.columns)


def unprocessed(pdfs: DataFrame, index: DataFrame | None, force: bool = False) -> DataFrame:
    """F17. The PDFs whose issue is not in the index; all of them with force."""
    return pdfs if index is None or force else pdfs.join(index.select("issue_id"), "issue_id", "left_anti")


def process(spark: SparkSession, folder: str, make_parser: Callable[[], PageParser], make_ocr: Callable[[], ImageModel], make_layout: Callable[[], ImageModel], index: DataFrame | None = None, force: bool = False, dpi: int = 300, newspaper: str | None = None) -> Documents:
    """Stages 0 to 12 from a folder of PDFs; issues in the index are skipped unless force (F17)."""
    pdfs = unprocessed(readers.find_pdfs(spark, folder), index, force)
    pages = stored(parse_pdfs(pdfs, make_parser), "pdf_pages")
    layouts = stored(detect(pages, make_ocr, make_layout), "layouts")
    pixels = lambda c: F.round(F.col(c) * dpi / 72).cast("int")
    sizes = pages.select(*S.PAGE_KEY, pixels("pt_width").alias("width"), pixels("pt_height").alias("height"), F.col("text").alias("embedded_text"))
    return rebuild(readers.ocr_lines(layouts), readers.layout_boxes(layouts), sizes, pages, index, newspaper)


def batch(documents: Documents, index: DataFrame) -> DataFrame:
    """The index after a batch: new issues put in, then names and places reconciled (C3, Q18)."""
    from pressline.sources.writers import upsert_index

    return identity.reconcile(upsert_index(index, index_record(documents.issues)), documents.clusters)
