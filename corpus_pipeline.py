"""A training-corpus pipeline over `documents`: five stages, each one operator of pressline.llm.

Each stage takes (spark, docs, sf_dir), where docs is the Parquet that its
predecessor wrote, and works on all of it. All stages but the last return the
columns of documents; the last returns the mix.

Every stage takes null and repeated ids, null, empty and very long texts, an empty
table and columns of any name beside doc_id, text and source; what it does with
them stands at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressline.llm import decontaminate, exact_dedup, jaccard_join, mixing, toxicity
from pressline.session import discard_paths, noting, release, stored, visible


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return visible(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.

    Null and empty texts have no features and stay where the labels lean to 0; repeated rows are
    judged alike; without usable labels all stay."""
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document of largest id.

    Null texts equal empty ones, so one row of all of them stays; a null id loses to any other;
    rows that repeat id and text become one."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 or more over five-word shingles the one of smallest id.

    Documents without words, and rows without an id, link with nothing and stay; rows that repeat
    an id stay or go together; exactly 0.8 is a link."""
    return jaccard_join.keep_one(docs, words=5, num=8, den=10)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage within its edit budget.

    Null and empty texts stay; ids are not looked at, so repeated rows are judged alike; an empty
    benchmark drops nothing, and items under ten bytes do not decide."""
    return decontaminate.drop_leaks(docs, _table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left.

    Null texts count no words and null sources are one source, the last; a document without an id
    is ranked by its text."""
    return mixing.mix(docs, _table(spark, sf_dir, "labels"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("source_mixing", mix_sources),
]

#: The toxicity model and the banded alignment have no SQL form; a test holds run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, behind = _table(visible(spark), sf_dir, "documents"), []
    for i, (name, stage) in enumerate(STAGES):
        with noting() as made:
            docs = stage(spark, docs, sf_dir)
            if i + 1 < len(STAGES):
                docs = stored(docs, name)
                # what the stage wrote on its way, and its predecessor, nothing reads any more
                discard_paths(spark, [*behind, *(path for path in made if path != docs._stored_at)])
                behind = [docs._stored_at]
                release(spark)
    return docs
