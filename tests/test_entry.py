"""The driver contract, and queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: A query of every operator family; the driver compares all of them.
SAMPLE = ["segment_articles", "build_blocks", "normalize_html_lines", "join_lines", "garbage_lines", "dateline", "masthead_lines", "sibling_backfill", "canonical_names", "continuation_links", "export_stats", "sanitize_response"]


def shown(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = entry_module.queries()[name](spark, SF)
    want = con.sql(entry_module.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    rows = sorted(repr([shown(r[c]) for c in order]) for r in df.collect())
    assert rows == sorted(repr([shown(dict(zip(want.columns, r, strict=True))[c]) for c in order]) for r in want.fetchall())
    assert rows


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_what_cannot_be_imported_is_left_out():
    assert entry_module._imported("pressline.nothing") is None
