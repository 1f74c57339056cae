"""Sinks: the tables as Parquet, and the JSON forms other tools read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pressline.sources import schemas as S


def write_table(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None) -> None:
    """K2. Parquet; `by` partitions the folders, for few and large values."""
    writer = df.write.mode(mode)
    (writer.partitionBy(by) if by else writer).parquet(path)


def page_json(pages: DataFrame, blocks: DataFrame, articles: DataFrame) -> DataFrame:
    """K2. The nested page documents: (issue_id, page_number, json)."""
    b = blocks.groupBy(*S.PAGE_KEY).agg(F.sort_array(F.collect_list(F.struct("block_seq", *[c for c in blocks.columns if c not in (*S.PAGE_KEY, "block_seq")]))).alias("blocks"))
    a = articles.groupBy(*S.PAGE_KEY).agg(F.array_sort(F.collect_list(F.struct("article_seq", *[c for c in articles.columns if c not in (*S.PAGE_KEY, "article_seq", "label_counts")]))).alias("articles"))
    joined = pages.join(b, S.PAGE_KEY, "left").join(a, S.PAGE_KEY, "left")
    return joined.select(*S.PAGE_KEY, F.to_json(F.struct(F.lit(2).alias("schema_version"), *joined.columns)).alias("json"))


def flat_blocks(blocks: DataFrame, issues: DataFrame) -> DataFrame:
    """K3. blocks.ndjson: block rows with the columns of their issue."""
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    meta = issues.select("issue_id", F.col("newspaper").alias("__paper"), F.col("date").alias("__date"))
    # texts are not sorted for it
    joined = blocks.join(meta.hint("shuffle_hash"), "issue_id", "left")
    return joined.select(
        "block_id", "issue_id", F.coalesce("__paper", F.lit("")).alias("newspaper"), F.coalesce("__date", F.lit("")).alias("issue_date"), "page_number", "label", "reading_order", F.array(*S.SIDES).alias("bbox"),
        "layout_confidence", "ocr_confidence", F.coalesce("source", F.lit("surya")).alias("source"), empty("article_id"), empty("article_title"), "text_original", "text_normalized",
    )


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K3, K4, K8, K9. Line-delimited JSON with nulls written out; UTF-8."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_corpus(rows: DataFrame, stats: DataFrame | Observation, folder: str, mode: str = "overwrite") -> None:
    """K8, K9. corpus.jsonl and manifest.json under folder, each as Spark writes JSON.

    stats: what corpus.observed_corpus counts while rows are written, or export_stats' row from a plan of its own."""
    write_json(rows, f"{folder}/corpus.jsonl", mode)
    if isinstance(stats, Observation):
        names = ["issues", "articles", "blocks", "words", "skipped", "row_count"]
        stats = rows.sparkSession.createDataFrame([tuple(int(stats.get[c]) for c in names)], ", ".join(f"{c} long" for c in names))
    counts = F.struct(*[c for c in stats.columns if c != "row_count"]).alias("stats")
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("generated_at")
    write_json(stats.select(now, counts, "row_count").coalesce(1), f"{folder}/manifest.json", mode)


def index_record(issues: DataFrame) -> DataFrame:
    """K7. The index projection of issues, with the parts of the date."""
    part = lambda start, n: F.when(F.col("date") == "unknown", "").otherwise(F.substring("date", start, n))
    columns: list[Column | str] = ["issue_id", "newspaper", "newspaper_source", "date", "source_pdf", "page_count", "block_count", "article_count", "processed_at", "output_dir"]
    columns += ["city", "province", "country", "place_source", F.coalesce("masthead", F.lit("")).alias("masthead")]
    columns += [part(1, 4).alias("year"), part(6, 2).alias("month"), part(9, 2).alias("day"), "day_of_week", "date_precision"]
    return issues.select(*columns)


def upsert_index(index: DataFrame, new: DataFrame) -> DataFrame:
    """K6, U4. index with the rows of new in place of equal issue ids.

    Of several new rows of one id the one of largest processed_at counts."""
    latest = new.groupBy("issue_id").agg(F.max_by(F.struct(*[c for c in new.columns if c != "issue_id"]), F.coalesce("processed_at", F.lit(""))).alias("r")).select("issue_id", "r.*")
    return index.join(latest, "issue_id", "left_anti").unionByName(latest, allowMissingColumns=True)


def corrections_json(corrections: DataFrame) -> DataFrame:
    """K10. (issue_id, json): the map from article id of each issue."""
    entry = F.struct("article_id", F.struct("corrected_text", "model", "corrected_at"))
    return corrections.groupBy("issue_id").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("json"))
