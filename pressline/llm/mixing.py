"""Mixing sources to target weights by weighted sampling without replacement.

Each document gets the key -ln(u) / quality weight (exponential keys, smallest
first), u being a hash of its id, so reruns agree. A source takes as many
complete epochs as its target holds; the rest of the target is filled with the
documents of smallest key, found by a prefix sum over the sorted keys.

The prefix sum has two levels: keys fall into buckets of a few hundred rows,
bucket totals are summed per source, and rows are sorted inside their bucket
only. A source that holds most rows is thus spread over many sort groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressline.session import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Rows that a bucket of keys holds on average.
BUCKET_ROWS = 500
#: Sampling weight of quality 0, unlabelled, and quality 1 documents.
LOW, UNKNOWN, HIGH = 0.5, 1.0, 2.0


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, rows, source_size, rank, target) from rows of (source, size).

    Sources in code-point order, null last, weigh 1, 2, 3, repeating. A target
    stops at max_epochs times its source; the excess goes to the others by
    weight. Sorted by cap per unit of weight, the capped sources are a prefix,
    so the water level is one comparison of exact integers per source. The
    windows run over one row per source, never over documents.
    """
    whole = "decimal(38,0)"
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(order))
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    per = per.withColumn("total", F.sum("source_size").over(Window.partitionBy()))
    per = per.withColumn("below", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    per = per.withColumn("open", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    rest = (F.col("total") - F.col("below")).cast(whole)
    per = per.withColumn("capped", F.col("cap").cast(whole) * F.col("open") <= rest * F.col("weight"))
    first = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "rank", (F.col("total") - F.col("below")).alias("rest"), "open"))).over(Window.partitionBy())
    per = per.withColumn("level", first)
    level = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise((F.col("level.rest") * F.col("weight")).cast("double") / F.col("level.open").cast("double"))
    return per.select("source", "rows", "source_size", "rank", level.alias("target"))


def unit(seed: F.Column) -> F.Column:
    """A number in (0, 1) that depends on the seed alone."""
    return (F.conv(F.substring(F.md5(seed), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def mix(docs: DataFrame, quality: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken.

    size counts words (null text: 0). quality has (doc_id, quality 0..1);
    documents without it weigh UNKNOWN. A document is wholly in or out of the
    last, fractional epoch; the one at the border goes to the nearer side.
    Empty sources and empty tables take nothing. Rows that repeat an id are
    documents of their own with equal keys; a document without an id gets its key from its
    text. Equal keys go by id, null last, then size. A quality that is null, or given for no
    document, changes nothing; of several for one id the mean counts. Texts of any length
    are counted whole. Only the named columns are read, so other columns may have any name.
    """
    count = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    base = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), count.alias("size"), F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(F.col(text_col), F.lit(""))))).alias("seed")), "sizes")
    if quality is not None:
        known = quality.groupBy(F.col("doc_id").alias("q_id")).agg(F.avg("quality").alias("quality"))
        base = base.join(known, base["doc_id"] == known["q_id"], "left").drop("q_id")
    else:
        base = base.withColumn("quality", F.lit(None).cast("double"))
    weight = F.coalesce(F.lit(LOW) + F.lit(HIGH - LOW) * F.col("quality"), F.lit(UNKNOWN))
    base = base.withColumn("key", -F.ln(unit(F.col("seed"))) / weight).drop("quality", "seed")
    per = stored(source_targets(base), "targets").withColumnRenamed("source", "of_source")
    rows = base.join(per, base["source"].eqNullSafe(per["of_source"]), "inner").drop("source", "of_source")
    full = F.when(F.col("source_size") > 0, F.least(F.lit(MAX_EPOCHS), F.floor(F.col("target") / F.col("source_size")))).otherwise(F.lit(0))
    rows = rows.withColumn("epochs", full.cast("long")).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    buckets = F.ceil(F.col("rows") / BUCKET_ROWS)
    rows = rows.withColumn("bucket", F.floor((1 - F.exp(-F.col("key"))) * buckets).cast("long"))
    ahead = rows.groupBy("rank", "bucket").agg(F.sum("size").alias("held"))
    ahead = ahead.withColumn("ahead", F.sum("held").over(Window.partitionBy("rank").orderBy("bucket")) - F.col("held")).drop("held")
    inside = Window.partitionBy("rank", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last(), "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("within", F.sum("size").over(inside) - F.col("size")).join(ahead, ["rank", "bucket"])
    taken = F.col("ahead") + F.col("within") + F.col("size") / 2.0 <= F.col("rest")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("epochs") + taken.cast("long"))).alias("taken"))


MIX_SQL = r"""
with words as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size, coalesce(doc_id::varchar, 'text ' || md5(coalesce(text, ''))) as seed from documents),
q as (select doc_id, avg(quality) quality from labels group by doc_id),
base as (select w.*, -ln((('0x' || substr(md5(w.seed), 1, 13))::ubigint::double + 0.5) / 4503599627370496.0) / coalesce(0.5 + 1.5 * quality, 1.0) as key from words w left join q using (doc_id)),
per as (select source, sum(size)::bigint source_size, row_number() over (order by source nulls last) rnk from base group by source),
wt as (select *, (rnk - 1) % 3 + 1 as weight, 3 * source_size as cap, (sum(source_size) over ())::hugeint total from per),
lv as (select *, coalesce(sum(cap) over (order by cap / weight, rnk rows between unbounded preceding and 1 preceding), 0)::hugeint below, (sum(weight) over (order by cap / weight, rnk rows between current row and unbounded following))::hugeint as opened from wt),
cp as (select *, cap::hugeint * opened <= (total - below) * weight as capped from lv),
tg as (select source, rnk, source_size, case when capped then cap::double else ((select arg_min(total - below, rnk_all) from (select *, row_number() over (order by cap / weight, rnk) rnk_all from cp) where not capped) * weight)::double / (select arg_min(opened, rnk_all) from (select *, row_number() over (order by cap / weight, rnk) rnk_all from cp) where not capped)::double end as target from cp),
ep as (select b.doc_id, b.size, b.key, t.*, case when source_size > 0 then least(3, floor(target / source_size))::bigint else 0 end as epochs from base b join tg t on b.source is not distinct from t.source),
su as (select *, sum(size) over (partition by rnk order by key, doc_id nulls last, size rows between unbounded preceding and current row) - size as ahead from ep)
select doc_id, size, source_size, target, (size * (epochs + case when ahead + size / 2.0::double <= target - epochs * source_size then 1 else 0 end))::bigint as taken from su
"""
