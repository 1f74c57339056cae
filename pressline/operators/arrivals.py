"""Reconciliation of an index as issues arrive, without looking at all of it again.

Who belongs together is kept as tables (Publications): kinds of mastheads and of names, their
members and their links. A batch adds its own kinds and links. Only the issues that hang together with
a new one can get other sibling values; only the fallback issues that a changed donor's name fits can get
another name. All others are settled and stay as they are.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressline.functions import headers
from pressline.functions.text import strip
from pressline.operators.identity import CONFIDENT, FINGERPRINT_SHARE, STAR_WORDS, Space, _reconcile_round, cross_issue_names, subset_keys
from pressline.operators.names import matching_names
from pressline.session import discard_paths, noting, stored
from pressline.sources.writers import upsert_index

_SIDE = "kind string, label array<string>"
_STARS = "kind string, key string, asks boolean"


@dataclass
class Side:
    """One way to belong together: kinds (kind, label), members (issue_id, kind), links (a, b) of kinds, once a pair,
    and stars (kind, key, asks): kinds that meet under a key (identity.Space)."""

    kinds: DataFrame
    members: DataFrame
    links: DataFrame
    stars: DataFrame

    def tables(self) -> list[DataFrame]:
        return [self.kinds, self.members, self.links, self.stars]


@dataclass
class Publications:
    mastheads: Side
    names: Side

    def sides(self) -> list[Side]:
        return [self.mastheads, self.names]

    def paths(self) -> list[str]:
        return [t._stored_at for side in self.sides() for t in side.tables()]


def no_publications(spark) -> Publications:
    empty = lambda ddl: stored(spark.createDataFrame([], ddl), "none")
    side = lambda: Side(empty(_SIDE), empty("issue_id string, kind string"), empty("a string, b string"), empty(_STARS))
    return Publications(side(), side())


def _overlaps(fresh: DataFrame, kinds: DataFrame) -> DataFrame:
    """(a, b): masthead kinds, a fresh, that share half of the smaller set's words, one of them too long for stars."""
    long = F.size("label") > STAR_WORDS
    words = lambda df, c: df.select(F.col("kind").alias(c), F.size("label").alias(f"n_{c}"), F.explode("label").alias("word"))
    both = words(fresh.where(long), "a").join(words(kinds, "b"), "word").unionByName(words(fresh.where(~long), "a").join(words(kinds.where(long), "b"), "word"))
    met = both.where("a <> b").groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("shared"))
    return met.where(F.col("shared") >= FINGERPRINT_SHARE * F.least("n_a", "n_b")).select("a", "b")


def _subsets(fresh: DataFrame) -> DataFrame:
    short = fresh.where(F.size("label") <= STAR_WORDS)
    return subset_keys(short.select("kind", F.size("label").alias("n"), F.col("label").alias("words")))


def _alike(fresh: DataFrame, kinds: DataFrame) -> DataFrame:
    """(a, b): name kinds, a fresh, whose names match in either order."""
    name = lambda df, c: df.select(F.get("label", F.lit(0)).alias(f"{c}_name"))
    both = matching_names(name(fresh, "a"), name(kinds, "b")).unionByName(matching_names(name(kinds, "a"), name(fresh, "b")).select(F.col("b_name").alias("a_name"), F.col("a_name").alias("b_name")))
    kind = lambda c: _kind(F.array(f"{c}_name")).alias(c)
    return both.where("a_name <> b_name").select(kind("a"), kind("b")).distinct()


def _kind(label) -> F.Column:
    return F.sha2(F.to_json(label), 256)


def _grown(side: Side, labels: DataFrame, gone: DataFrame, links_of, stars_of=None) -> Side:
    """side with the issues of `gone` taken out and those of labels (issue_id, label) put in."""
    own = stored(labels.withColumn("kind", _kind(F.col("label"))), "labels")
    members = stored(side.members.join(gone, "issue_id", "left_anti").unionByName(own.select("issue_id", "kind")), "members")
    fresh = stored(own.select("kind", "label").distinct().join(side.kinds, "kind", "left_anti"), "fresh")
    live = members.select("kind").distinct()
    kinds = stored(side.kinds.unionByName(fresh).join(live, "kind", "left_semi"), "kinds")
    pairs = links_of(fresh, kinds).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    # a kind without members left links nobody
    old = reduce(lambda df, c: df.join(live.withColumnRenamed("kind", c), c, "left_semi"), "ab", side.links)
    stars = side.stars.join(live, "kind", "left_semi")
    if stars_of:
        stars = stars.unionByName(stars_of(fresh))
    return Side(kinds, members, stored(old.unionByName(pairs), "links"), stored(stars, "stars"))


def with_arrivals(publications: Publications, new: DataFrame) -> Publications:
    """publications after the issues of new came or were read again; the work is that of the new kinds' links."""
    gone = new.select("issue_id")
    prints = new.select("issue_id", headers.fingerprint(F.col("masthead")).alias("label")).where(F.size("label") > 0)
    named = new.where(F.col("newspaper_source").isin(CONFIDENT)).select("issue_id", F.array(strip(F.coalesce("newspaper", F.lit("")))).alias("label")).where("label[0] <> ''")
    return Publications(_grown(publications.mastheads, prints, gone, _overlaps, _subsets), _grown(publications.names, named, gone, _alike))


def hanging_together(publications: Publications, ids: DataFrame) -> DataFrame:
    """(issue_id): ids and every issue that a chain of common or linked kinds joins to one of them.

    A round goes one kind further; only kinds that the last round reached for the first time are followed."""
    reached = edge = stored(ids.select("issue_id").distinct(), "reached")
    while True:
        near = []
        for side in publications.sides():
            kinds = side.members.join(edge, "issue_id", "left_semi").select("kind").distinct()
            linked = [side.links.join(kinds.withColumnRenamed("kind", c), c, "left_semi").select(F.col(d).alias("kind")) for c, d in ("ab", "ba")]
            at = side.stars.join(kinds, "kind", "left_semi").groupBy("key").agg(F.max("asks").alias("asked"))
            starred = side.stars.join(at, "key").where(F.col("asks") | F.col("asked")).select("kind")
            every = reduce(DataFrame.unionByName, [kinds, *linked, starred]).distinct()
            near.append(side.members.join(every, "kind", "left_semi").select("issue_id"))
        edge = stored(reduce(DataFrame.unionByName, near).distinct().join(reached, "issue_id", "left_anti"), "edge")
        if edge.isEmpty():
            return reached
        reached = stored(reached.unionByName(edge), "reached")


def _within(side: Side, ids: DataFrame) -> Space:
    members = stored(side.members.join(ids, "issue_id", "left_semi"), "within")
    return Space(members, side.links, stored(side.stars.join(members.select("kind").distinct(), "kind", "left_semi"), "stars"))


def reconcile_arrivals(index: DataFrame, new: DataFrame, publications: Publications, clusters: DataFrame, regions: DataFrame | None = None) -> tuple[DataFrame, Publications]:
    """C3. (index, publications) after a batch: what reconcile(upsert_index(index, new), clusters) says.

    index is settled, as this function or reconcile left it, and publications belongs to it. clusters holds
    the header phrases of all issues. Of several new rows of one issue the last counts."""
    spark = index.sparkSession
    with noting() as made:
        merged = stored(upsert_index(index, new), "merged")
        fresh = stored(merged.join(new.select("issue_id").distinct(), "issue_id", "left_semi"), "fresh")
        grown = with_arrivals(publications, fresh)
        ids = hanging_together(grown, fresh)
        current = last = stored(merged.join(ids, "issue_id", "left_semi"), "current")
        beside = stored(merged.join(ids, "issue_id", "left_anti"), "beside")
        donors = beside.where("newspaper_source = 'page_headers'").select("newspaper_source", "newspaper", "city", "province")
        spaces = [_within(side, ids) for side in grown.sides()]
        asking, named = beside.where("newspaper_source = 'fallback'"), None
        while True:
            # the fallback issues beside: a name of a changed donor may fit them
            found = cross_issue_names(asking, clusters, current).select("issue_id", F.col("newspaper").alias("__name"))
            named = stored(found if named is None else named.unionByName(found), "named")
            asking = asking.join(named, "issue_id", "left_anti")
            last = _reconcile_round(current, clusters, spaces, regions, merged.columns, donors)
            current = last.drop("__changed")
            if last.where("__changed").isEmpty():
                break
        lent = beside.join(named, "issue_id", "left").withColumns({"newspaper": F.coalesce("__name", "newspaper"), "newspaper_source": F.when(F.col("__name").isNotNull(), "cross_issue").otherwise(F.col("newspaper_source"))})
        out = stored(current.unionByName(lent.select(*merged.columns)), "settled")
    kept = {out._stored_at, *grown.paths()}
    discard_paths(spark, [p for p in made if p not in kept])
    return out, grown
