"""Bylines: names on articles matched with authors by a cascade of joins, cheapest first.

Names are matched once for each similarity key: a special edit first, then an equal key, then the
most similar key. Articles have `id` and `names` (an array of texts); authors `id`, `display_name`
and `login`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.columns import fresh
from galley.functions.names import similarity_key, truthy
from galley.operators.similar import Measure, similar_pairs
from galley.session import cut_lineage

MATCH, CANDIDATE = 0.9, 0.8


def author_lookup(authors: DataFrame) -> DataFrame:
    """(key, author_id, name, at): keys of display names and logins with the smallest author id.

    at: where the key came up first, by `ord` and display name before login. A login's key carries
    the display name of its author.
    """
    rows = authors.select("ord", "id", "display_name", F.posexplode(F.array("display_name", "login")).alias("at", "text"))
    rows = rows.where(truthy(F.col("text")).isNotNull()).select(similarity_key(F.col("text")).alias("key"), (F.col("ord") * 2 + F.col("at")).alias("at"), "id", F.col("display_name").alias("name"))
    best = F.min_by(F.struct("id", "name"), F.struct(F.coalesce("id", F.lit((1 << 63) - 1)), "at"))
    return rows.where("key <> ''").groupBy("key").agg(best.alias("b"), F.min("at").alias("at")).select("key", F.col("b.id").alias("author_id"), F.col("b.name").alias("name"), "at")


def occurrences(articles: DataFrame) -> DataFrame:
    """(article_id, at, name, key) of every name that leaves a key."""
    rows = articles.select(F.col("id").alias("article_id"), F.posexplode("names").alias("at", "name"))
    rows = rows.where(truthy(F.col("name")).isNotNull()).withColumn("key", similarity_key(F.col("name")))
    return rows.where("key <> ''")


def unique_names(articles: DataFrame) -> DataFrame:
    """(key, n_names, n_articles, first_article) of each similarity key."""
    return occurrences(articles).groupBy("key").agg(F.count("*").alias("n_names"), F.count_distinct("article_id").alias("n_articles"), F.min("article_id").alias("first_article"))


def special_matches(keys: DataFrame, edits: DataFrame, lookup: DataFrame) -> DataFrame:
    """(key, at, author_id, name): keys of an edit with the authors that it names, in its order.

    edits: match, at, target. A target is found by its name or its key, the earliest in the lookup;
    targets that nobody bears are left out.
    """
    wanted = edits.select(similarity_key(F.col("match")).alias("key"), "at", F.col("target"), similarity_key(F.col("target")).alias("target_key"))
    wanted = wanted.join(keys.select("key").distinct(), "key", "left_semi")
    known = lookup.where(truthy(F.col("name")).isNotNull()).select(F.col("at").alias("where"), "author_id", "name", similarity_key(F.col("name")).alias("target_key"))
    found = wanted.join(known, "target_key")
    return found.groupBy("key", "at").agg(F.min_by(F.struct("author_id", "name"), "where").alias("b")).select("key", "at", F.col("b.author_id").alias("author_id"), F.col("b.name").alias("name"))


def similar_names(keys: DataFrame, lookup: DataFrame, match: float = MATCH, candidate: float = CANDIDATE, measure: Measure | None = None) -> DataFrame:
    """(key, author_id, name, sim, matched) of each key's best match, or else of its candidates.

    The best has at least `match`, the highest similarity, and of equals the earliest place in the lookup.
    """
    pairs = similar_pairs(keys, lookup, candidate, measure=measure).select(F.col("a").alias("key"), F.col("b").alias("other"), "sim")
    pairs = cut_lineage(pairs.join(lookup.withColumnRenamed("key", "other"), "other").select("key", "author_id", "name", "sim", "at"))
    best = pairs.where(F.col("sim") >= match - 1e-12).groupBy("key").agg(F.max_by(F.struct("author_id", "name", "sim"), F.struct("sim", -F.col("at"))).alias("b"))
    best = best.select("key", "b.*", F.lit(True).alias("matched"))
    rest = pairs.join(best.select("key"), "key", "left_anti").select("key", "author_id", "name", "sim", F.lit(False).alias("matched"))
    return best.unionByName(rest)


def match_bylines(articles: DataFrame, authors: DataFrame, edits: DataFrame | None = None, cache: DataFrame | None = None, measure: Measure | None = None) -> dict[str, DataFrame]:
    """`matches` (article_id, at, sub, author_id, name), `flagged` (article_id, name, candidates),
    `unknown` (name, article_ids) and `changes` (article_id, old_name, new_name).

    cache: (name, author_id, display_name), decisions of earlier runs for flagged names. measure: see `similar_pairs`.
    """
    lookup = cut_lineage(author_lookup(authors))
    names = cut_lineage(occurrences(articles))
    keys = names.select("key").distinct()
    empty = keys.sparkSession.createDataFrame([], "key string, at int, author_id bigint, name string")
    special = cut_lineage(special_matches(keys, edits, lookup)) if edits is not None else empty
    left = keys.join(special, "key", "left_anti")
    exact = left.join(lookup.select("key", "author_id", "name"), "key")
    left = cut_lineage(left.join(lookup, "key", "left_anti"))
    fuzzy = cut_lineage(similar_names(left, lookup, measure=measure))
    sure = special.select("key", F.col("at").alias("sub"), "author_id", "name", F.lit("special").alias("by"))
    sure = sure.unionByName(exact.select("key", F.lit(0).alias("sub"), "author_id", "name", F.lit("exact").alias("by")))
    sure = sure.unionByName(fuzzy.where("matched").select("key", F.lit(0).alias("sub"), "author_id", "name", F.lit("similar").alias("by")))
    matches = names.select("article_id", "at", F.col("name").alias("old_name"), "key").join(sure, "key")
    flagged = names.join(fuzzy.where(~F.col("matched")).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("author_id", F.col("name").alias("name"), "sim"))).alias("candidates")), "key")
    flagged = flagged.select("article_id", "at", "name", "candidates")
    if cache is not None:
        known = cache.select("name", "author_id", F.col("display_name").alias("found"))
        hit = flagged.join(known, "name")
        matches = matches.unionByName(hit.select("article_id", "at", F.col("name").alias("old_name"), F.lit(None).cast("string").alias("key"), F.lit(0).alias("sub"), "author_id", F.col("found").alias("name"), F.lit("cached").alias("by")))
        flagged = flagged.join(known, "name", "left_anti")
    matched_keys = sure.select("key").union(fuzzy.select("key")).distinct()
    lost = names.join(matched_keys, "key", "left_anti").groupBy("name").agg(F.array_sort(F.collect_set("article_id")).alias("article_ids"))
    new_name = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sub", "name"))), lambda x: x["name"]), ", ")
    changes = matches.where("by <> 'exact'").groupBy("article_id", "at", "old_name").agg(new_name.alias("new_name")).select("article_id", "old_name", "new_name")
    return {"matches": matches.select("article_id", "at", "sub", "author_id", "name", "by"), "flagged": flagged, "unknown": lost, "changes": changes}


def apply_matches(articles: DataFrame, matches: DataFrame) -> DataFrame:
    """`articles` with author_ids and authors, in the order of names; names without a match are dropped."""
    one = F.struct("at", "sub", "author_id", "name")
    found = matches.groupBy("article_id").agg(F.array_sort(F.collect_list(one)).alias("m"))  # an article's names
    of, all_ = fresh(articles.columns, "article", "m")
    out = articles.join(found.toDF(of, all_), F.col("id") == F.col(of), "left")
    m = F.coalesce(all_, F.array().cast("array<struct<at:int,sub:int,author_id:bigint,name:string>>"))
    columns = [c for c in articles.columns if c not in ("author_ids", "authors")]
    return out.select(*columns, F.transform(m, lambda x: x["author_id"]).alias("author_ids"), F.transform(m, lambda x: x["name"]).alias("authors"))


def merge_unknown(old: DataFrame, new: DataFrame) -> DataFrame:
    """(name, article_ids) of both, ids distinct and in order."""
    rows = old.select("name", F.explode("article_ids").alias("i")).union(new.select("name", F.explode("article_ids")))
    return rows.groupBy("name").agg(F.array_sort(F.collect_set("i")).alias("article_ids"))
