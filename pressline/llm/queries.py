"""The queries opN_<name> of this subpackage, and their SQL where it can say them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressline.llm import chat_format, conversation_repair, decontaminate, exact_dedup, jaccard_join, mixing, packing, pii, ranked_search, secrets, substring_dedup, toxicity, url_filter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.sql("select -1L as conv_id, t.turn, t.role, :probe as text from values (0L, 'user'), (1L, 'assistant') as t(turn, role)", args={"probe": probe})
    return chat_format.chat_digest(chat_format.format_chats(rows.select("conv_id", "turn", "role", "text").unionByName(extra)))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.cut_repeats(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(ranked_search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damage(table(spark, sf_dir, "conversations"))
    return conversation_repair.repair_conversations(rows, dropped=rows["dropped"])


DEDUP_SQL = """
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(coalesce(text, '')) as text_sha256
from documents window w as (partition by coalesce(text, ''))
"""

# links are few, so candidates may meet on any shared shingle here
JACCARD_SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, chr(10))] else [w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2] for i in range(1, len(w) - 1)] end) as g from d),
c as (select list_sort(g) as g, min(doc_id) as id, count(*) as copies, len(any_value(g)) as n from s where len(g) > 0 group by list_sort(g)),
e as (select id, n, unnest(g) as t from c),
p as (select x.id as a, y.id as b, count(*) as o, any_value(x.n) as na, any_value(y.n) as nb from e x join e y on x.t = y.t and x.id < y.id and 100 * x.n >= 90 * y.n and 100 * y.n >= 90 * x.n group by x.id, y.id),
l as (select a, b from p where 100 * o >= 90 * (na + nb - o)),
r(id, to_id) as (select id, id from c union select r.id, case when l.a = r.to_id then l.b else l.a end from r join l on l.a = r.to_id or l.b = r.to_id),
m as (select id, min(to_id) as component from r group by id),
k as (select id, sum(copies) as links from (select l.a as id, c.copies from l join c on c.id = l.b union all select l.b, c.copies from l join c on c.id = l.a) group by id)
select s.doc_id, len(s.g)::bigint as n_shingles, case when len(s.g) = 0 then s.doc_id else m.component end as component_id, case when len(s.g) = 0 then 0 else c.copies - 1 + coalesce(k.links, 0) end::bigint as n_links
from s left join c on c.g = list_sort(s.g) left join m on m.id = c.id left join k on k.id = c.id
"""

# bytes as pairs of hexadecimal digits; windows are named by a 128-bit hash
REPEATS_SQL = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
p as (select doc_id, h, unnest(range(greatest(0, length(h) // 2 - 99))) as i from d),
w as (select doc_id, i, md5_number(substr(h, 2 * i + 1, 200)) as m from p),
r as (select doc_id, i from (select doc_id, i, row_number() over (partition by m order by doc_id, i) as n from w) where n > 1),
g as (select doc_id, i, case when i <= lag(i) over (partition by doc_id order by i) + 100 then 0 else 1 end as new from r),
k as (select doc_id, i, sum(new) over (partition by doc_id order by i) as island from g),
s as (select doc_id, island, min(i) as a, max(i) + 100 as b from k group by doc_id, island),
c as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from s),
t as (select c.doc_id, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' order by a) as kept from c join d using (doc_id) group by c.doc_id)
select d.doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join t using (doc_id)
"""

QUERIES = {f.__name__: f for f in (op1_pii, op2_secret_scan, op3_jaccard_join, op4_chat_formatting, op5_source_mixing, op6_toxicity, op7_url_filter, op8_decontamination, op9_exact_dedup, op10_suffix_dedup, op11_best_fit_packing, op12_ranked_search, op13_conversation_repair)}
ORACLE = {"op3_jaccard_join": JACCARD_SQL, "op4_chat_formatting": chat_format.CHAT_SQL, "op5_source_mixing": mixing.MIX_SQL, "op7_url_filter": url_filter.URL_SQL, "op9_exact_dedup": DEDUP_SQL, "op10_suffix_dedup": REPEATS_SQL, "op12_ranked_search": ranked_search.SEARCH_SQL, "op13_conversation_repair": conversation_repair.REPAIR_SQL}
