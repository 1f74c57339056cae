"""URL filter: a trie over reversed host labels and path segments.

The trie is built once from (host, path, verdict) rules and broadcast with the
closure; rules are configuration, refused beyond MAX_RULES, so its size is bounded.
A url walks its host labels from the right; at every node that ends a rule's
host it walks the path segments. The longest matching rule wins.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_RULES = 1_000_000
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: host, path prefix, verdict
RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def build_trie(rules) -> dict:
    """Nested dicts: host labels from the right, then under "/" the path segments.

    A rule's last path segment is a prefix of the url's segment, so it is kept
    under None as (prefix, rule, verdict), longest first.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are broadcast")
    root: dict = {}
    for host, path, verdict in rules:
        node = root
        for label in reversed(host.translate(ASCII_LOWER).split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault("/", {})
        *whole, last = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        node.setdefault(None, []).append((last, host.translate(ASCII_LOWER) + path, verdict))
        node[None].sort(key=lambda rule: -len(rule[0]))
    return root


def split_url(url) -> tuple[str, str]:
    """(host, path); both empty for a null or a text without ://"""
    if not isinstance(url, str) or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1].partition("#")[0].partition("?")[0]
    host, slash, path = rest.partition("/")
    return host.translate(ASCII_LOWER), slash + path


def lookup(trie: dict, host: str, path: str):
    """The longest rule that fits, as (rule, verdict), or None."""
    best, node = None, trie
    segments = path.split("/")
    for label in reversed(host.split(".")):
        # "/" and None are no labels: a label holds no slash
        node = node.get(label)
        if node is None:
            break
        at = node.get("/")
        for i, segment in enumerate(segments):
            if at is None:
                break
            for prefix, rule, verdict in at.get(None, ()):
                if segment.startswith(prefix) or (prefix == "" and i < len(segments)):
                    if best is None or len(rule) > len(best[0]):
                        best = (rule, verdict)
                    break
            at = at.get(segment)
    return best


def judge_urls(pages: DataFrame, rules=None, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A url that no rule fits gets the default verdict and a null rule, as do
    null and malformed urls, whose host and path are empty. Repeated rows and
    null ids are kept as they are; the work is one narrow pass, no shuffle. Of rules of equal
    length that of the shorter host wins, of equal rules the first in the list. An empty table
    gives no rows, a url of any length is walked label by label and segment by segment. Only
    the two named columns are read, so other columns may have any name.
    """
    trie = build_trie(RULES if rules is None else rules)

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = [split_url(url) for url in batch["url"]]
            found = [lookup(trie, *part) or (None, default) for part in parts]
            batch["host"], batch["path"] = [p[0] for p in parts], [p[1] for p in parts]
            batch["rule"], batch["verdict"] = [f[0] for f in found], [f[1] for f in found]
            yield batch[["page_id", "host", "path", "rule", "verdict"]]

    kind = dict(pages.dtypes)[id_col]
    # ids travel as strings: pandas would turn longs with nulls into doubles
    out = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url")).mapInPandas(judged, "page_id string, host string, path string, rule string, verdict string")
    return out.withColumn("page_id", F.col("page_id").cast(kind))


URL_SQL = r"""
with u as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
p as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from u),
r(rhost, rpath, rverdict) as (values ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
m as (select page_id, arg_max(rhost || rpath, length(rhost || rpath)) as rule, arg_max(rverdict, length(rhost || rpath)) as v from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by page_id)
select p.page_id, host, path, m.rule as rule, coalesce(m.v, 'allow') as verdict from p left join m on p.page_id = m.page_id
"""
