"""Sources: cached layouts, embedded text, indexes, corrections and PDF discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressline.functions.text import alpha_proxy, strip
from pressline.sources import schemas as S


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(folder))


def find_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """S1. (path, issue_id, content) of the PDFs of a folder; the issue id is the file's stem."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    return files.select("path", F.regexp_extract("path", r"([^/]*)\.pdf$", 1).alias("issue_id"), "content")


def _sides(bbox: Column) -> list[Column]:
    return [F.coalesce(F.get(bbox, F.lit(i)), F.lit(0.0)).alias(s) for i, s in enumerate(S.SIDES)]


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """S11. The cached layout.json files under <issue>/pages/page_NNN/, one row each."""
    raw = spark.read.schema(S.LAYOUT_JSON).option("multiLine", True).json(path)
    at = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(at, r"([^/]+)/pages/page_(\d+)/", 1).alias("issue_id"), F.regexp_extract(at, r"/page_(\d+)/", 1).cast("int").alias("page_number"), "ocr", "layout")


def ocr_lines(layouts: DataFrame) -> DataFrame:
    """S10, S11. Recognised lines with their ordinals; missing values get their defaults."""
    rows = layouts.select(*S.PAGE_KEY, F.posexplode("ocr.text_lines").alias("line_no", "l"))
    word = lambda w: F.struct(F.coalesce(w["text"], F.lit("")).alias("text"), F.coalesce(w["bbox"], F.array(*[F.lit(0.0)] * 4)).alias("bbox"), F.round(F.coalesce(w["confidence"], F.lit(0.0)), 4).alias("confidence"))
    words = F.coalesce(F.transform("l.words", word), F.array().cast(f"array<{S.WORD}>"))
    return rows.select(*S.PAGE_KEY, "line_no", F.coalesce("l.text", F.lit("")).alias("text"), F.coalesce("l.confidence", F.lit(0.0)).alias("confidence"), *_sides(F.col("l.bbox")), words.alias("words"))


def layout_boxes(layouts: DataFrame) -> DataFrame:
    """S10, S11. Layout boxes with their ordinals; missing values get their defaults."""
    rows = layouts.select(*S.PAGE_KEY, F.posexplode("layout.bboxes").alias("box_no", "b"))
    none = F.array().cast("array<array<double>>")
    return rows.select(
        *S.PAGE_KEY, "box_no", F.coalesce("b.label", F.lit("Text")).alias("label"), F.coalesce("b.position", F.lit(0)).alias("position"), F.coalesce("b.confidence", F.lit(0.0)).alias("confidence"), *_sides(F.col("b.bbox")), F.coalesce("b.polygon", none).alias("polygon")
    )


def embedded_lines(pdf_pages: DataFrame, scale: Column | None = None) -> DataFrame:
    """S5, S16. Non-blank lines of the text layer, scaled to pixels (points by default)."""
    scale = F.lit(1.0) if scale is None else scale
    rows = pdf_pages.withColumn("scale", scale).select(*S.PAGE_KEY, "scale", F.posexplode("lines").alias("line_no", "l")).where(strip(F.col("l.text")) != "")
    lines = rows.select(*S.PAGE_KEY, "line_no", F.col("l.text").alias("text"), alpha_proxy(F.col("l.text")).alias("confidence"), *(F.col(f"l.{s}").alias(s) for s in S.SIDES), "scale")
    return scale_lines(lines, F.col("scale")).drop("scale")


def scale_lines(lines: DataFrame, factor: Column) -> DataFrame:
    """S6."""
    return lines.withColumns({s: F.col(s) * factor for s in S.SIDES})


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """S12. The issue index; a missing one is empty, a corrupt one fails (Q22)."""
    if not _exists(spark, path):
        return spark.createDataFrame([], S.ISSUE_INDEX)
    return spark.read.schema(S.ISSUE_INDEX).option("mode", "FAILFAST").json(path)


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """S13. Line-delimited JSON; blank lines are skipped, malformed ones fail. None where no file is there (Q20)."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path) if _exists(spark, path) else None


def read_corrections(spark: SparkSession, path: str) -> DataFrame:
    """S14. corrections.json files under <issue>/: maps from article id; missing or corrupt ones are empty."""
    if not _exists(spark, path):
        return spark.createDataFrame([], S.CORRECTIONS)
    text = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+$", 1).alias("issue_id"), "value")
    entries = F.from_json("value", "map<string,struct<corrected_text:string,model:string,corrected_at:string>>", {"mode": "PERMISSIVE"})
    return text.select("issue_id", F.explode(entries).alias("article_id", "c")).select("issue_id", "article_id", "c.*")
