"""Incremental runs on Structured Streaming.

Layout files arrive in a folder; a checkpoint remembers which were read, so a restart
goes on where it stopped. Each micro-batch is a batch plan. The index is a table in hash
buckets (index_table): a batch rewrites those it touches. A late sibling can resolve an issue
of any age, so no watermark applies and no issue expires.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pressline.sources import schemas as S
from pressline.streaming.index_table import BUCKETS, IndexTable, first_version


def layout_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New layout.json files as they arrive, in the form of readers.read_layouts."""
    raw = spark.readStream.schema(S.LAYOUT_JSON).option("multiLine", True).option("maxFilesPerTrigger", files_per_batch).json(path)
    at = F.col("_metadata.file_path")
    return raw.select(F.regexp_extract(at, r"([^/]+)/pages/page_(\d+)/", 1).alias("issue_id"), F.regexp_extract(at, r"/page_(\d+)/", 1).cast("int").alias("page_number"), "ocr", "layout")


def upsert_stream(records: DataFrame, index_path: str, checkpoint: str, reconcile: Callable[[DataFrame], DataFrame] | None = None, buckets: int = BUCKETS) -> StreamingQuery:
    """K6. Upsert a stream of index records into the index table at index_path.

    Every batch writes a version of the table, numbered by batch, so a batch that is run
    again after a failure starts from the same version and gives the same result; it rewrites
    only the buckets it touches. A new checkpoint over an old index goes on from its newest
    version; which that was is kept beside the checkpoint. A version that should be there and is
    not fails the query (Q22)."""
    first = first_version(IndexTable(records.sparkSession, index_path, buckets), checkpoint)

    def put(batch: DataFrame, batch_id: int) -> None:
        IndexTable(batch.sparkSession, index_path, buckets).upsert(batch, first + batch_id, reconcile)

    return records.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_index(spark: SparkSession, index_path: str) -> DataFrame:
    """The newest version that upsert_stream wrote; empty before the first."""
    return IndexTable(spark, index_path).read()


def uncorrected_stream(articles: DataFrame, corrections: DataFrame, min_words: int = 15) -> DataFrame:
    """New articles that no correction covers: a stream against a static table."""
    from pressline.operators.correct import candidates

    return candidates(articles, corrections, min_words=min_words)
