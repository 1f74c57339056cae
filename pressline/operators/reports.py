"""The group and stats reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.functions.text import ellipsis
from pressline.operators.identity import canonical_names

ID_WIDTH, NAME_WIDTH = 44, 26


def group_report(issues: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """A15, O3. One row per issue under its publication, with the count of the publication's issues,
    by publication in lower case, then date."""
    names = canonical_names(issues) if names is None else names
    rows = issues.join(names, "issue_id", "left").withColumn("publication", F.coalesce(F.nullif("canonical", F.lit("")), "newspaper", F.lit("Unknown")))
    counts = rows.groupBy("publication").agg(F.count(F.lit(1)).alias("issues"))
    # array_join leaves nulls out
    place = F.array_join(F.array(F.coalesce("city", F.lit("")), F.nullif("province", F.lit(""))), ", ")
    variant = F.when(F.col("newspaper").eqNullSafe(F.col("publication")), "").otherwise(F.concat(F.lit("  [read as: "), F.coalesce("newspaper", F.lit("None")), F.lit("]")))
    return rows.join(counts, "publication").select("publication", "issues", "date", "issue_id", ellipsis(F.col("issue_id"), ID_WIDTH).alias("shown_id"), place.alias("place"), variant.alias("read_as")).orderBy(F.lower("publication"), "publication", F.coalesce("date", F.lit("")), "issue_id")


def stats_report(issues: DataFrame) -> DataFrame:
    """A16. One row per issue and one for all, by grouping sets; issue_id is null in the total.

    issues has block_count, article_count and coverage_min_ratio (Q4)."""
    place = F.array_join(F.array(*(F.nullif(c, F.lit("")) for c in ("city", "province", "country"))), " ")
    rows = issues.select("issue_id", ellipsis(F.col("newspaper"), NAME_WIDTH).alias("newspaper"), "date", "page_count", "block_count", "article_count", "coverage_min_ratio", place.alias("place"))
    both = rows.rollup("issue_id").agg(
        F.max("newspaper").alias("newspaper"), F.max("date").alias("date"), F.sum("page_count").alias("pages"), F.sum("block_count").alias("blocks"), F.sum("article_count").alias("articles"), F.min("coverage_min_ratio").alias("coverage"), F.max("place").alias("place"), F.count(F.lit(1)).alias("issues"), F.grouping("issue_id").alias("is_total")
    )
    return both.withColumns({c: F.when(F.col("is_total") == 0, F.col(c)) for c in ("newspaper", "date", "place")})
