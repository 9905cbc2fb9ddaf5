"""Articles and authors out of an export's items, and the checks that decide which articles stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.columns import fresh
from galley.functions.content import escape_quotes, excerpt, first_upload, is_puzzle, odd_characters, sanitized, shortcodes, inline_styles, text_norm, unslash
from galley.functions.literals import no_zero_date, photo_url
from galley.functions.names import byline_key
from galley.operators.keys import dense_ids

# What a missing text reads as, the shortest text, and what marks posts to leave out.
MISSING = "None"
LEAST_TEXT = 100
PUZZLE_TEXT = "sudoku"
SKIPPED_TERMS = ("crossword", "comics")
# The keys of a guest author's fields in the order of the author columns.
GUEST_KEYS = ("cap-display_name", "cap-first_name", "cap-last_name", "cap-user_email", "cap-user_login")
AUTHOR_COLUMNS = ("display_name", "first_name", "last_name", "email", "login")


def staff_authors(items: DataFrame) -> DataFrame:
    """items: ord and wp:author_* elements."""
    source = ("wp:author_display_name", "wp:author_first_name", "wp:author_last_name", "wp:author_email", "wp:author_login")
    rows = items.select("ord", *[F.col(f"`{s}`").alias(c) for s, c in zip(source, AUTHOR_COLUMNS)])
    return dense_ids(rows, "ord").select("id", *AUTHOR_COLUMNS)


def meta_map(entries: Column) -> Column:
    """An array of (key, value) structs as a map; of equal keys the last one counts."""
    known = F.filter(entries, lambda e: e["key"].isNotNull())
    return F.aggregate(
        known,
        F.create_map().cast("map<string,string>"),
        lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e["key"]), F.create_map(e["key"], e["value"])),
    )


def guest_authors(items: DataFrame) -> DataFrame:
    """items: ord and meta, an array of (key, value) structs."""
    rows = items.withColumn("m", meta_map(F.filter("meta", lambda e: e["key"].isin(*GUEST_KEYS))))
    fields = [F.try_element_at("m", F.lit(k)).alias(c) for k, c in zip(GUEST_KEYS, AUTHOR_COLUMNS)]
    return dense_ids(rows.select("ord", *fields), "ord").select("id", *AUTHOR_COLUMNS)


def yoast(entries: Column) -> Column:
    return meta_map(F.filter(entries, lambda e: F.contains(e["key"], F.lit("yoast"))))


def terms(entries: Column, text: Column) -> Column:
    """A struct (tags, categories, authors, names, skip) of an article's terms (domain, nicename, text)."""

    def of(domain: str, missing: bool) -> Column:
        own = F.filter(entries, lambda t: t["domain"] == domain)
        texts = F.transform(own, lambda t: text_norm(t["text"]))
        return texts if missing else F.filter(texts, lambda t: t.isNotNull() & (t != MISSING))

    authors = F.transform(of("author", True), lambda t: F.coalesce(t, F.lit(MISSING)))
    skip = F.exists(entries, lambda t: F.coalesce(t["nicename"].isin(*SKIPPED_TERMS), F.lit(False)) | (text == MISSING))
    return F.struct(
        F.sort_array(of("post_tag", False), False).alias("tags"),
        F.sort_array(of("category", False), False).alias("categories"),
        authors.alias("authors"),
        F.transform(authors, byline_key).alias("names"),
        F.coalesce(skip, F.lit(False)).alias("skip"),
    )


def keeps(title: Column, text: Column) -> Column:
    """An article with a title, without `_` in it, of at least 100 characters and no puzzle."""
    good = title.isNotNull() & (title != MISSING) & ~F.contains(title, F.lit("_")) & (text != MISSING)
    return F.coalesce(good & (F.length(text) >= LEAST_TEXT) & ~F.contains(text, F.lit(PUZZLE_TEXT)), F.lit(False))


def article_text(body: Column) -> Column:
    return escape_quotes(F.coalesce(text_norm(body), F.lit(MISSING)))


def translate_articles(items: DataFrame) -> DataFrame:
    """items: ord, title, body, description, slug, comment_status, mod_date, pub_date, terms and meta."""
    none = F.array().cast("array<struct<domain:string,nicename:string,text:string>>")
    rows = items.withColumns({"text": article_text(F.col("body")), "title": unslash(text_norm(F.col("title"))), "description": text_norm(F.col("description"))})
    rows = rows.withColumn("t", terms(F.coalesce("terms", none), F.col("text")))
    rows = rows.where(keeps(F.col("title"), F.col("text")) & ~F.col("t.skip"))
    rows = rows.select(
        "ord",
        "title",
        "text",
        "description",
        "slug",
        "comment_status",
        "mod_date",
        "pub_date",
        first_upload(F.col("text")).alias("photo_url"),
        "t.tags",
        "t.categories",
        "t.names",
        F.col("t.authors").alias("authors"),
        yoast(F.coalesce("meta", F.array().cast("array<struct<key:string,value:string>>"))).alias("metadata"),
        F.lit(False).alias("breaking_news"),
        F.lit(False).alias("priority"),
        F.lit(-1).cast("long").alias("featured_img_id"),
    )
    return dense_ids(rows, "ord")


def sanitise_content(articles: DataFrame) -> DataFrame:
    """`articles` with repaired text, `fixes` (null if nothing changed) and `excerpt`."""
    (s,) = fresh(articles.columns, "s")
    rows = articles.withColumn(s, sanitized(F.col("text")))
    fixes = F.when(F.size(f"{s}.fixes") > 0, F.array_join(f"{s}.fixes", "; "))
    rows = rows.withColumns({"text": F.col(f"{s}.text"), "fixes": fixes}).drop(s)
    return rows.withColumn("excerpt", F.when(is_puzzle(F.col("categories"), F.col("text")), F.lit("")).otherwise(excerpt(F.col("text"))))


def shortcode_log(articles: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    return articles.select(F.col(key).alias("article_id"), F.inline(shortcodes(F.col(text))))


def style_log(articles: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    return articles.select(F.col(key).alias("article_id"), F.explode(inline_styles(F.col(text))).alias("style"))


def odd_character_log(articles: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    return articles.select(F.col(key).alias("article_id"), F.inline(odd_characters(F.col(text))))


def odd_character_kinds(log: DataFrame) -> DataFrame:
    """(kind, codes, n): distinct codes in order and occurrences."""
    return log.groupBy("kind").agg(F.array_sort(F.collect_set("code")).alias("codes"), F.count("*").alias("n"))


def cms_rows(articles: DataFrame, site: str) -> DataFrame:
    """The 19 columns of the target table."""
    created = F.coalesce(F.nullif("pub_date", F.lit("")), "mod_date")
    return articles.select(
        "id",
        no_zero_date(created).alias("creation_date"),
        "slug",
        "author_ids",
        "authors",
        "breaking_news",
        "comment_status",
        "description",
        "featured_img_id",
        "priority",
        no_zero_date(F.col("mod_date")).alias("mod_date"),
        photo_url(F.col("photo_url"), site).alias("photo_url"),
        no_zero_date(F.col("pub_date")).alias("pub_date"),
        "tags",
        "categories",
        "metadata",
        "text",
        "excerpt",
        "title",
    )
