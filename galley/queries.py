"""The registered queries: each operator on the driver's tables, and SQL that gives the same rows.

Inputs that the tables lack (captions, shortcodes, control characters) are put into the rows by
literals that query and SQL share.
"""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.functions import content, literals, names
from galley.operators import articles, authors, bylines, keys, similar, slugs, vectors
from galley.plans import migration
from galley.session import cut_lineage, shared_folder, table
from galley.sinks import files
from galley.sinks import sql as dumps
from galley.sources import export, storage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SITE = "www.example.org"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def _docs(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "text", *more)


# Texts and pages.

PAGE_PLAIN = r"""trim(regexp_replace(regexp_replace(
  replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(html, '<figure\b[^>]*>.*?</figure>', ' ', 'gis'), '<img\b[^>]*>', ' ', 'gi'),
  '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g'))"""


@query(f"SELECT page_id, array_to_string(string_split({PAGE_PLAIN}, ' ')[1:100], ' ') AS excerpt FROM (SELECT page_id, regexp_replace(html, '&amp([^;]|$)', '&amp;\\1', 'g') AS html FROM pages)")
def i9_excerpt(spark, sf):
    return table(spark, sf, "pages").select("page_id", content.excerpt(F.col("html")).alias("excerpt"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM pages")
def i10_strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", content.strip_html(F.col("html")).alias("plain"))


@query(r"""SELECT doc_id, replace(replace('\"a\" \\ ' || text, '\"', '"'), '\\', '\') AS clean FROM documents""")
def i1_backslashes(spark, sf):
    return _docs(spark, sf).select("doc_id", content.sanitize_backslashes(F.concat(F.lit('\\"a\\" \\\\ '), "text")).alias("clean"))


CAPTION_HEAD = '<p>[caption id="Att_7 b" align="alignleft" width="300"]<img src="a.png" />'


@query(r"""SELECT doc_id, 'x <figure id="Att_7 b" aria-describedby="caption-att-7-b" style="width: 300px" class="wp-caption alignleft"><img src="a.png" />'
  || '<figcaption id="caption-att-7-b" class="wp-caption-text">' || lang || ' ' || doc_id || '</figcaption></figure> y [caption width="3"]none[/caption] ' || text AS html
FROM documents""")
def i2_captions(spark, sf):
    raw = F.concat(F.lit("x " + CAPTION_HEAD + " "), "lang", F.lit(" "), F.col("doc_id").cast("string"), F.lit(' [/caption] </p> y [caption width="3"]none[/caption] '), "text")
    return _docs(spark, sf, "lang").select("doc_id", content.convert_captions(raw).alias("html"))


@query(r"""SELECT doc_id, 'a <div class="pm-embed-div" data-id="' || doc_id || '" data-set="' || source || '" data-puzzleType="wordrow" data-height="700px" data-embedparams="embed=wp"></div> b [puzzleme set="z"] ' || text AS html FROM documents""")
def i3_puzzles(spark, sf):
    raw = F.concat(F.lit('a <p><strong>[puzzleme set="'), "source", F.lit('" id="'), F.col("doc_id").cast("string"), F.lit('" type=" WordRow "]</strong></p> b [puzzleme set="z"] '), "text")
    return _docs(spark, sf, "source").select("doc_id", content.convert_puzzles(raw).alias("html"))


@query(r"""SELECT doc_id, array_to_string(list_transform(list_filter(list_transform(regexp_split_to_array(replace(text, chr(10), chr(10) || ' ' || chr(10) || chr(10)) || chr(10) || chr(10) || '<ul>x</ul>', '\n\s*\n+'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''),
  lambda x: CASE WHEN starts_with(x, '<ul>') THEN x ELSE '<p>' || x || '</p>' END), chr(10)) AS html FROM documents""")
def i4_paragraphs(spark, sf):
    raw = F.concat(F.replace("text", F.lit("\n"), F.lit("\n \n\n")), F.lit("\n\n<ul>x</ul>"))
    return _docs(spark, sf).select("doc_id", content.add_paragraphs(raw).alias("html"))


@query("""SELECT doc_id AS article_id, s AS shortcode, CASE s WHEN 'gallery' THEN '[gallery ids="' || source || '"]' ELSE '[video src=a]' || lang || '[/video]' END AS example
FROM documents, (VALUES ('gallery'), ('video')) t(s)""")
def i5_shortcodes(spark, sf):
    raw = F.concat("text", F.lit(' [gallery ids="'), "source", F.lit('"] [video src=a]'), "lang", F.lit('[/video] [gallery ids="2"]'), "text")
    return articles.shortcode_log(_docs(spark, sf, "source", "lang").select("doc_id", raw.alias("text")), "doc_id")


@query("SELECT doc_id AS article_id, style FROM (SELECT doc_id, unnest(['color: ' || lang, 'width: 1px']) AS style FROM documents)")
def i6_inline_styles(spark, sf):
    raw = F.concat("text", F.lit('<p style="color: '), "lang", F.lit("\">a</p><b class=x style='width: 1px'>"), "text")
    return articles.style_log(_docs(spark, sf, "lang").select("doc_id", raw.alias("text")), "doc_id")


ODD = "\u200b"


@query(r"""SELECT doc_id AS article_id, kind, pos AS position, code FROM (
  SELECT doc_id, 'zero-width character' AS kind, length(text)::BIGINT AS pos, 'U+200B' AS code FROM documents UNION ALL
  SELECT doc_id, 'control character', length(text)::BIGINT + 2, 'U+0007' FROM documents)""")
def i7_odd_characters(spark, sf):
    raw = F.concat("text", F.lit(ODD + "x\x07"))
    return articles.odd_character_log(_docs(spark, sf).select("doc_id", raw.alias("text")), "doc_id")


@query("SELECT 'zero-width character' AS kind, ['U+200B', 'U+FEFF'] AS codes, (2 * count(*))::BIGINT AS n FROM documents UNION ALL SELECT 'control character', ['U+0007'], count(*)::BIGINT FROM documents")
def e4_odd_character_kinds(spark, sf):
    raw = F.concat("text", F.lit(ODD + "x\x07\ufeff"))
    return articles.odd_character_kinds(articles.odd_character_log(_docs(spark, sf).select("doc_id", raw.alias("text")), "doc_id"))


@query("SELECT doc_id, 'a[U+200B]' || text || '[U+0007]' AS shown FROM documents")
def i8_show_odd_characters(spark, sf):
    return _docs(spark, sf).select("doc_id", content.show_odd_characters(F.concat(F.lit("a" + ODD), "text", F.lit("\x07"))).alias("shown"))


@query(r"""SELECT doc_id AS id, '<p>"q" ' || text || '</p>' || chr(10) || '<div class="pm-embed-div" data-id="1" data-set="s" data-puzzleType="wordrow" data-height="700px" data-embedparams="embed=wp"></div>' AS html,
  'backslashes stripped; puzzleme shortcodes converted' AS fixes, '' AS excerpt FROM documents""")
def i11_sanitise_content(spark, sf):
    raw = F.concat(F.lit('<p>\\"q\\" '), "text", F.lit('</p>\n[puzzleme set="s" id="1" type="wordrow"]'))
    rows = _docs(spark, sf).select(F.col("doc_id").alias("id"), raw.alias("text"), F.array().cast("array<string>").alias("categories"))
    return articles.sanitise_content(rows).select("id", F.col("text").alias("html"), "fixes", "excerpt")


@query(r"SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 5 = 0 THEN '' ELSE array_to_string(string_split(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ')[1:100], ' ') END AS excerpt FROM documents")
def c4_puzzle_excerpts(spark, sf):
    category = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(" Comics & Puzzles "), F.lit("x"))).otherwise(F.array("lang"))
    raw = F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" [PuzzleMe"))).otherwise(F.col("text"))
    rows = _docs(spark, sf, "lang")
    return rows.select("doc_id", F.when(content.is_puzzle(category, raw), F.lit("")).otherwise(content.excerpt(raw)).alias("excerpt"))


@query("SELECT doc_id, replace(replace('&nbsp;&amp;nbsp; ' || text, '&amp;', '&'), '&nbsp;', ' ') AS norm, replace(replace(replace('\"' || text, '&amp;', '&'), '&nbsp;', ' '), '\"', '\\\"') AS body FROM documents")
def h9_text_norm(spark, sf):
    return _docs(spark, sf).select("doc_id", content.text_norm(F.concat(F.lit("&nbsp;&amp;nbsp; "), "text")).alias("norm"), articles.article_text(F.concat(F.lit('"'), "text")).alias("body"))


@query("SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'wp-content/uploads/2001/' || page_id || '.png' END AS photo FROM pages")
def b7_first_upload(spark, sf):
    raw = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('x <img src=\\"/wp-content/uploads/2001/'), F.col("page_id").cast("string"), F.lit('.png\\"> wp-content/uploads/b.gif\\"'))).otherwise(F.col("html"))
    return table(spark, sf, "pages").select("page_id", content.first_upload(raw).alias("photo"))


@query("""SELECT doc_id, 'A "q" and ''s ' || source || ' ' || text AS title FROM documents""")
def b8_unslash(spark, sf):
    return _docs(spark, sf, "source").select("doc_id", content.unslash(F.concat(F.lit("A \\\"q\\\" and \\'s "), "source", F.lit(" "), "text")).alias("title"))


@query("""SELECT page_id, CASE page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN url WHEN 2 THEN 'https://cdn.test/' || page_id WHEN 3 THEN 'https://www.example.org/a' || page_id
  WHEN 4 THEN 'https://www.example.org/WP-content/' || page_id WHEN 5 THEN 'https://www.example.org/wp-content/' || page_id ELSE 'other/' || page_id END AS photo FROM pages""")
def b12_photo_url(spark, sf):
    own = F.col("page_id").cast("string")
    raw = F.lit("other/ ")
    for k, prefix in enumerate(("  ", None, " //cdn.test/", "www.example.org/a", "WP-content/", "/wp-content/")):
        c = F.lit(prefix) if k == 0 else F.concat(F.lit(" "), "url") if prefix is None else F.concat(F.lit(prefix), own)
        raw = F.when(F.col("page_id") % 7 == k, c).otherwise(raw) if k else F.when(F.col("page_id") % 7 == 0, c).otherwise(F.concat(F.lit("other/"), own))
    return table(spark, sf, "pages").select("page_id", literals.photo_url(raw, SITE).alias("photo"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') ELSE '2001-01-01 10:00:00' END AS created FROM orders""")
def b11_creation_date(spark, sf):
    pub = F.when(F.col("o_orderkey") % 3 == 0, F.lit("0000-00-00 00:00:00")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00")).otherwise(F.lit(""))
    created = literals.no_zero_date(F.coalesce(F.nullif(pub, F.lit("")), F.lit("2001-01-01 10:00:00")))
    return table(spark, sf, "orders").select("o_orderkey", created.alias("created"))


@query("SELECT doc_id, array_to_string(string_split(text, ' ')[1:7], ' ') AS words, substr(text, 1, 50) AS chars, (doc_id // 1000)::BIGINT AS bucket FROM documents")
def f9_limits(spark, sf):
    return _docs(spark, sf).select("doc_id", content.first_words(F.col("text"), 7).alias("words"), F.substring("text", 1, 50).alias("chars"), keys.bucket_of(F.col("doc_id")).alias("bucket"))


# Names and slugs.


@query(r"SELECT doc_id, trim(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents")
def h7_slug(spark, sf):
    return _docs(spark, sf).select("doc_id", names.slug(F.col("text")).alias("slug"))


@query(r"SELECT doc_id, lower(regexp_replace(text || ' Zoë O''Neil-3_b', '[^\p{L}\p{N}]|\p{Nd}', '', 'g')) AS key, lower(regexp_replace(source || '.A-b_c d', '[.\-_ ]', '', 'g')) AS byline FROM documents")
def h1_similarity_key(spark, sf):
    return _docs(spark, sf, "source").select("doc_id", names.similarity_key(F.concat("text", F.lit(" Zoë O'Neil-3_b"))).alias("key"), names.byline_key(F.concat("source", F.lit(".A-b_c d"))).alias("byline"))


@query(r"""SELECT p_partkey, array_to_string(list_transform(string_split(trim(regexp_replace(regexp_replace(p_name, '[^\p{L}\p{N}_ ^''.\-]|_|\p{Nd}', '', 'g'), '^by ', '') || '.j O''neil'), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS name FROM part""")
def h2_clean_author(spark, sf):
    return table(spark, sf, "part").select("p_partkey", names.clean_author(F.concat(F.lit("by "), "p_name", F.lit(".j O'neil 3@x.test"))).alias("name"))


@query("SELECT p_partkey, ['Ann ' || p_name, 'amp ' || p_name, '', 'Eve Fox', 'Sandy'] AS names FROM part")
def h3_clean_authors(spark, sf):
    raw = F.concat(F.lit("By Ann "), "p_name", F.lit(" &amp; "), "p_name", F.lit(", and Eve Fox and Sandy"))
    return table(spark, sf, "part").select("p_partkey", names.clean_authors(raw).alias("names"))


@query("SELECT p_partkey, nullif(regexp_extract(p_name, '^(.*) ([^ ]*)$', 1), '') AS first, nullif(regexp_extract(p_name, '^(.*) ([^ ]*)$', 2), '') AS last, nullif(p_name || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE ' ' || p_brand END, '') AS built FROM part")
def h5_split_name(spark, sf):
    first, last = names.split_display_name(F.col("p_name"))
    built = names.build_display_name(F.col("p_name"), F.when(F.col("p_partkey") % 2 == 1, F.col("p_brand")).otherwise(F.lit("")))
    return table(spark, sf, "part").select("p_partkey", first.alias("first"), last.alias("last"), built.alias("built"))


@query("SELECT p_partkey, p_partkey % 4 IN (1, 2) AS several FROM part")
def c3_holds_several(spark, sf):
    mark = F.when(F.col("p_partkey") % 4 == 1, F.lit(" and x")).when(F.col("p_partkey") % 4 == 2, F.lit(" &amp; y")).when(F.col("p_partkey") % 4 == 3, F.lit(" & sand")).otherwise(F.lit(""))
    return table(spark, sf, "part").select("p_partkey", names.holds_several(F.concat("p_name", mark)).alias("several"))


@query("""WITH s AS (SELECT doc_id, lang || '-' || source AS base FROM documents)
SELECT doc_id AS id, CASE WHEN row_number() OVER (PARTITION BY base ORDER BY doc_id) = 1 THEN base ELSE base || '-' || doc_id END AS slug FROM s""")
def f3_unique_slugs(spark, sf):
    """Bases end in letters and a number behind them, as no base repeats with another's suffix here."""
    rows = _docs(spark, sf, "lang", "source").select(F.col("doc_id").alias("id"), F.concat_ws(" ", "lang", "source").alias("title"))
    return slugs.unique_slugs(rows, (F.col("title"),), "article").select("id", "slug")


@query("""WITH RECURSIVE r AS (
  SELECT doc_id AS id, CASE WHEN doc_id % 3 = 0 THEN 'a-' || (doc_id + 1) ELSE 'a' END AS base, row_number() OVER (ORDER BY doc_id) AS i FROM documents
), s AS (
  SELECT 0::BIGINT AS i, []::VARCHAR[] AS used, NULL::BIGINT AS id, NULL::VARCHAR AS slug
  UNION ALL
  SELECT i, list_append(used, slug), id, slug FROM (
    SELECT r.i, s.used, r.id, CASE WHEN NOT list_contains(s.used, r.base) THEN r.base
      WHEN NOT list_contains(s.used, r.base || '-' || r.id) THEN r.base || '-' || r.id
      ELSE r.base || '-' || list_filter(range(1, r.i + 1), lambda k: NOT list_contains(s.used, r.base || '-' || k))[1] END AS slug
    FROM s JOIN r ON r.i = s.i + 1)
)
SELECT id, slug FROM s WHERE i > 0""")
def f3_colliding_slugs(spark, sf):
    """Bases that collide with suffixes that others were given."""
    rows = _docs(spark, sf).select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("a-"), (F.col("doc_id") + 1).cast("string"))).otherwise(F.lit("A")).alias("title"))
    return slugs.unique_slugs(rows, (F.col("title"),), "article").select("id", "slug")


# Rows of an export, synthesised from the tables.


def _articles(spark, sf) -> DataFrame:
    null = F.lit(None).cast("string")
    term = "array<struct<domain:string,nicename:string,text:string>>"
    one = lambda d, n, t: F.struct(F.lit(d).alias("domain"), n.alias("nicename"), t.alias("text"))
    nice = F.when(F.col("doc_id") % 11 == 0, F.lit("comics")).otherwise(F.col("lang"))
    terms = F.array(one("post_tag", F.lit("a"), F.concat(F.lit("R&amp;"), "source")), one("post_tag", F.lit("b"), F.col("lang")), one("category", nice, F.col("lang")), one("category", F.lit("c"), null), one("author", F.lit("d"), F.concat(F.col("source"), F.lit(". "), "lang"))).cast(term)
    meta = F.array(F.struct(F.lit("_yoast_a").alias("key"), F.col("lang").alias("value")), F.struct(F.lit("other").alias("key"), F.lit("x").alias("value")), F.struct(F.lit("_yoast_a").alias("key"), F.col("source").alias("value")))
    title = F.when(F.col("doc_id") % 7 == 0, null).when(F.col("doc_id") % 13 == 0, F.lit("a_b")).otherwise(F.concat(F.lit("T \\\"&amp;\\\" "), "source"))
    return _docs(spark, sf, "lang", "source").select(
        F.col("doc_id").alias("ord"),
        title.alias("title"),
        F.col("text").alias("body"),
        F.col("lang").alias("description"),
        F.concat_ws(" ", "lang", "source").alias("slug"),
        F.lit("open").alias("comment_status"),
        F.lit("2020-01-02 00:00:00").alias("mod_date"),
        F.lit("0000-00-00 00:00:00").alias("pub_date"),
        terms.alias("terms"),
        meta.alias("meta"),
    )


KEPT = """SELECT *, (row_number() OVER (ORDER BY doc_id) - 1)::BIGINT AS id FROM (SELECT *, replace(text, '"', '\\"') AS t FROM documents)
WHERE doc_id % 7 <> 0 AND doc_id % 13 <> 0 AND doc_id % 11 <> 0 AND length(t) >= 100 AND NOT contains(t, 'sudoku')"""


@query(f"""SELECT id, 'T "&" ' || source AS title, t AS text, lang AS description, ['R&' || source, lang] AS tags_any, [lang] AS categories, [replace(source, '.', '') || lang] AS names, source AS yoast, 'open' AS comment_status FROM ({KEPT})""")
def b4_translate_articles(spark, sf):
    rows = articles.translate_articles(_articles(spark, sf))
    tags = F.sort_array("tags").alias("tags_any")
    return rows.select("id", "title", "text", "description", tags, "categories", "names", F.col("metadata")["_yoast_a"].alias("yoast"), "comment_status")


SQL["b4_translate_articles"] = SQL["b4_translate_articles"].replace("['R&' || source, lang] AS tags_any", "list_sort(['R&' || source, lang]) AS tags_any")


@query("SELECT doc_id, text IS NOT NULL AND doc_id % 3 <> 0 AND doc_id % 5 <> 0 AND length(text) >= 100 AND NOT contains(text, 'sudoku') AS keep FROM documents")
def c1_sanity(spark, sf):
    title = F.when(F.col("doc_id") % 3 == 0, F.lit("None")).when(F.col("doc_id") % 5 == 0, F.lit("a_b")).otherwise(F.lit("t"))
    return _docs(spark, sf).select("doc_id", articles.keeps(title, F.col("text")).alias("keep"))


@query("SELECT (row_number() OVER (ORDER BY s_suppkey) - 1)::BIGINT AS id, s_name AS display_name, NULL::VARCHAR AS first_name, 'L' || s_nationkey AS last_name, lower(s_name) || '@x.test' AS email, 'log' || s_suppkey AS login FROM supplier")
def b1_staff_authors(spark, sf):
    rows = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") * 3).alias("ord"),
        F.col("s_name").alias("wp:author_display_name"),
        F.lit(None).cast("string").alias("wp:author_first_name"),
        F.concat(F.lit("L"), F.col("s_nationkey").cast("string")).alias("wp:author_last_name"),
        F.concat(F.lower("s_name"), F.lit("@x.test")).alias("wp:author_email"),
        F.concat(F.lit("log"), F.col("s_suppkey").cast("string")).alias("wp:author_login"),
    )
    return articles.staff_authors(rows)


@query("SELECT c_custkey AS id, c_name AS display_name, NULL::VARCHAR AS first_name, c_mktsegment AS last_name, 'b' AS email, NULL::VARCHAR AS login FROM customer")
def b2_guest_authors(spark, sf):
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    meta = F.array(pair("cap-display_name", F.lit("x")), pair("cap-user_email", F.lit("b")), pair("other", F.lit("y")), pair("cap-display_name", F.col("c_name")), pair("cap-last_name", F.col("c_mktsegment")), pair("cap-user_login", F.lit(None).cast("string")))
    return articles.guest_authors(table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), meta.alias("meta")))


@query("SELECT user_id, arg_max(event_type, event_id) AS last_type, count(DISTINCT event_type)::BIGINT AS n_keys FROM events GROUP BY user_id")
def b6_meta_map(spark, sf):
    rows = table(spark, sf, "events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", F.struct(F.concat(F.lit("yoast-"), "event_type").alias("key"), F.col("event_type").alias("value"))))).alias("l"))
    m = articles.yoast(F.transform("l", lambda x: x["col2"]))
    last = F.element_at("l", -1)["col2"]["value"]
    return rows.withColumn("m", m).select("user_id", F.element_at("m", F.concat(F.lit("yoast-"), last)).alias("last_type"), F.size("m").cast("long").alias("n_keys"))


@query("SELECT user_id, list_sort(list(event_type), 'DESC') AS tags FROM events GROUP BY user_id")
def f6_sorted_tags(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(F.sort_array(F.collect_list("event_type"), False).alias("tags"))


@query("""SELECT (row_number() OVER (ORDER BY o_orderkey, l_linenumber, l_suppkey))::BIGINT AS id, l_suppkey AS author_id, o_orderkey AS articles_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def f2_bridge_rows(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("l"))
    rows = table(spark, sf, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_orderkey").alias("id"), F.transform("l", lambda x: x["l_suppkey"]).alias("author_ids"))
    return keys.bridge_rows(rows)


@query("SELECT (row_number() OVER (ORDER BY event_id) - 1)::BIGINT AS id, event_id FROM events WHERE event_type <> 'click'")
def f1_dense_ids(spark, sf):
    return keys.dense_ids(table(spark, sf, "events").where("event_type <> 'click'").select("event_id"), "event_id")


# Authors.


def _people(spark, sf, name: str = "customer") -> DataFrame:
    """Rows of authors: names of two letters-only parts. The first is one for four keys in a row, the second one of two, so
    names are as many as rows grow to, about half of them more than once, and half of all end alike."""
    c = table(spark, sf, name)
    key, nation = (F.col("c_custkey"), F.col("c_nationkey")) if name == "customer" else (F.col("s_suppkey"), F.col("s_nationkey"))
    family = F.translate(F.sha2((nation % 2).cast("string"), 256).substr(1, 9), "0123456789", "ghijklmnop")
    given = F.translate(F.sha2(F.concat(F.lit("g"), F.floor(key / 4).cast("string")), 256).substr(1, 9), "0123456789", "qrstuvwxyz")
    display = F.concat_ws(" ", given, family)
    return c.select(key.alias("ord"), (key * 2).alias("id"), display.alias("display_name"), F.lit(None).cast("string").alias("first_name"), F.lit(None).cast("string").alias("last_name"), F.when(key % 3 == 0, F.concat(key.cast("string"), F.lit("@x.test"))).alias("email"), F.concat(F.lit("l"), key.cast("string")).alias("login"))


_FAMILY = "translate(substr(sha256(({n} % 2)::VARCHAR), 1, 9), '0123456789', 'ghijklmnop')"
_GIVEN = "translate(substr(sha256('g' || ({k} // 4)), 1, 9), '0123456789', 'qrstuvwxyz')"
PEOPLE = f"""SELECT c_custkey AS ord, c_custkey * 2 AS id, {_GIVEN.format(k='c_custkey')} || ' ' || {_FAMILY.format(n='c_nationkey')} AS display_name, CASE WHEN c_custkey % 3 = 0 THEN c_custkey || '@x.test' END AS email, 'l' || c_custkey AS login FROM customer"""
GUESTS = f"""SELECT s_suppkey AS ord, s_suppkey * 2 AS id, {_GIVEN.format(k='s_suppkey')} || ' ' || {_FAMILY.format(n='s_nationkey')} AS display_name, CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey || '@x.test' END AS email, 'l' || s_suppkey AS login FROM supplier"""


@query(f"""WITH p AS ({PEOPLE})
SELECT id, array_to_string(list_transform(string_split(display_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS display_name, email FROM p WHERE ord % 5 <> 0
UNION ALL
SELECT (SELECT max(id) FROM p) + (row_number() OVER (ORDER BY ord, pos))::BIGINT, piece, NULL FROM (
  SELECT ord, 1 AS pos, array_to_string(list_transform(string_split(display_name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS piece FROM p WHERE ord % 5 = 0 UNION ALL
  SELECT ord, 2, 'Eve Fox' FROM p WHERE ord % 5 = 0)""")
def f5_normalise_authors(spark, sf):
    rows = _people(spark, sf).withColumn("display_name", F.when(F.col("ord") % 5 == 0, F.concat("display_name", F.lit(" and Eve Fox"))).otherwise(F.col("display_name")))
    return authors.normalise(rows).select("id", "display_name", "email")


@query(f"WITH p AS ({PEOPLE}) SELECT id, CASE WHEN ord = 3 THEN 'X Y' ELSE display_name END AS display_name, CASE WHEN ord = 3 THEN 'X' ELSE NULL END AS first_name, CASE WHEN ord = 3 THEN NULL ELSE email END AS email FROM p")
def h13_edit_rows(spark, sf):
    rows = _people(spark, sf)
    rows = rows.withColumn("display_name", F.when(F.col("ord") == 3, F.lit("Board")).otherwise(F.col("display_name")))
    edits = spark.range(1).select(F.lit("Board").alias("match"), F.lit(True).alias("set_display_name"), F.lit("X Y").alias("new_display_name"), F.lit(True).alias("set_first_name"), F.lit("X").alias("new_first_name"), F.lit(True).alias("set_email"), F.lit(None).cast("string").alias("new_email"))
    return authors.edit_rows(rows, edits).select("id", "display_name", "first_name", "email")


@query(f"WITH p AS ({PEOPLE}) SELECT id, regexp_extract(display_name, '^(.*) ([^ ]*)$', 1) AS first_name, regexp_extract(display_name, '^(.*) ([^ ]*)$', 2) AS last_name FROM p")
def h14_fill_names(spark, sf):
    first, last = authors.fill_names(F.col("display_name"), F.col("first_name"), F.col("last_name"))
    return _people(spark, sf).select("id", first.alias("first_name"), last.alias("last_name"))


@query(f"""WITH p AS ({PEOPLE}), g AS (SELECT * FROM ({GUESTS}) UNION ALL SELECT ord + 100000, id, 'zz' || (ord % 7), email, login FROM ({GUESTS})),
n AS (SELECT display_name, min(ord) AS ord, arg_min(email, ord) FILTER (email IS NOT NULL OR true) AS email, arg_min(login, ord) AS login FROM g GROUP BY display_name)
SELECT id, display_name, login FROM p UNION ALL
SELECT (SELECT max(id) FROM p) + (row_number() OVER (ORDER BY ord))::BIGINT, display_name, login FROM n WHERE display_name NOT IN (SELECT display_name FROM p)""")
def d4_combine(spark, sf):
    guests = _people(spark, sf, "supplier")
    more = guests.withColumns({"ord": F.col("ord") + 100_000, "display_name": F.concat(F.lit("zz"), (F.col("ord") % 7).cast("string"))})
    return authors.combine(_people(spark, sf), guests.union(more)).select("id", "display_name", "login")


@query(f"""WITH p AS ({PEOPLE}), g AS (SELECT * FROM ({GUESTS}))
SELECT id, display_name FROM g WHERE NOT (display_name IN (SELECT display_name FROM p) AND display_name IN (SELECT display_name FROM g WHERE ord % 2 = 0))""")
def c7_prune_banned(spark, sf):
    guests = _people(spark, sf, "supplier")
    banned = guests.where("ord % 2 = 0").select("display_name")
    return authors.prune_banned(guests, _people(spark, sf), banned).select("id", "display_name")


@query(f"""WITH p AS ({PEOPLE}), k AS (SELECT ord, id, email, login, regexp_replace(display_name, ' ', '') AS key FROM p),
ban AS (SELECT DISTINCT key FROM k WHERE ord < 2),
m AS (SELECT key, min(id) AS id, min(ord) AS ord, count(*) AS n, arg_min(login, ord) AS login, arg_min(email, ord) FILTER (email IS NOT NULL) AS email FROM k WHERE key NOT IN (FROM ban) GROUP BY key)
SELECT id, login, email FROM m UNION ALL SELECT id, login, email FROM k WHERE key IN (FROM ban)""")
def d5_resolve_authors(spark, sf):
    """Here keys are alike only if they are equal; tests cover the greedy order among similar ones."""
    rows = _people(spark, sf)
    result, _, _ = authors.resolve(rows, rows.where("ord < 2").select("display_name"))
    return result.select("id", "login", "email")


_SHINGLES = "CASE WHEN length({k}) < 3 THEN [{k}] ELSE list_distinct(list_transform(range(1, length({k}) - 1), lambda i: substr({k}, i, 3))) END"


NAME_KEYS = f"""SELECT replace(display_name, ' ', '') AS key, ord FROM ({PEOPLE}) UNION ALL SELECT replace(display_name, ' ', '') || 'q', ord + 1000000 FROM ({PEOPLE})"""


def _name_keys(spark, sf) -> DataFrame:
    """Keys of names, and each once more with a letter behind it."""
    rows = _people(spark, sf).select(names.similarity_key(F.col("display_name")).alias("key"), "ord")
    return rows.union(rows.select(F.concat("key", F.lit("q")), F.col("ord") + 1_000_000))


@query(f"""WITH k AS (SELECT DISTINCT key FROM ({NAME_KEYS})),
s AS (SELECT key, {_SHINGLES.format(k='key')} AS s FROM k),
p AS (SELECT x.key AS a, y.key AS b, len(list_intersect(x.s, y.s)) AS n, len(x.s) AS m, len(y.s) AS o FROM s x JOIN s y ON x.key < y.key)
SELECT a, b, round(n / (m + o - n), 9) AS sim FROM p WHERE n / (m + o - n) >= 0.8 - 1e-12""")
def d5_similar_pairs(spark, sf):
    rows = _name_keys(spark, sf)
    return similar.similar_pairs(rows, rows, 0.8).where("a < b").select("a", "b", F.round("sim", 9).alias("sim"))


@query(f"""WITH RECURSIVE k AS (SELECT key, min(ord) AS node FROM ({NAME_KEYS}) GROUP BY key),
s AS (SELECT key, node, {_SHINGLES.format(k='key')} AS s FROM k),
p AS (SELECT x.node AS lo, y.node AS hi, len(list_intersect(x.s, y.s)) AS n, len(x.s) AS m, len(y.s) AS o FROM s x JOIN s y ON x.node < y.node),
l AS (SELECT hi, list(lo) AS earlier FROM p WHERE n / (m + o - n) >= 0.8 - 1e-12 GROUP BY hi),
e AS (SELECT row_number() OVER (ORDER BY node) AS i, node, coalesce(earlier, []) AS earlier FROM k LEFT JOIN l ON hi = node),
r AS (
  SELECT 0::BIGINT AS i, []::BIGINT[] AS anchors
  UNION ALL
  SELECT e.i, CASE WHEN len(list_intersect(e.earlier, r.anchors)) = 0 THEN list_append(r.anchors, e.node) ELSE r.anchors END FROM r JOIN e ON e.i = r.i + 1)
SELECT node, coalesce(list_min(list_intersect(earlier, anchors)), node) AS anchor FROM e, (SELECT anchors FROM r ORDER BY i DESC LIMIT 1)""")
def d5_star_clusters(spark, sf):
    """Greedy clusters of names."""
    nodes = cut_lineage(_name_keys(spark, sf).groupBy("key").agg(F.min("ord").alias("node")))  # read five times
    pairs = similar.similar_pairs(nodes, nodes, 0.8).where("a <> b")
    pairs = pairs.join(nodes.toDF("a", "lo"), "a").join(nodes.toDF("b", "hi"), "b").where("lo < hi").select("lo", "hi")
    return similar.star_clusters(nodes.select("node"), pairs)


@query("""WITH RECURSIVE n AS (SELECT count(*) // 2 + 1 AS n FROM customer),
e AS (SELECT row_number() OVER (ORDER BY c_custkey) AS i, c_custkey * 7919 % n AS a, c_custkey * 104729 % n AS b FROM customer, n WHERE c_custkey * 7919 % n <> c_custkey * 104729 % n),
s AS (
  SELECT 0::BIGINT AS i, []::BIGINT[][] AS chains
  UNION ALL
  SELECT i, CASE WHEN p = 0 THEN list_append(chains, [a, b]) ELSE list_concat(list_concat(chains[1:p - 1], [list_append(chains[p], b)]), chains[p + 1:]) END FROM (
    SELECT e.i, s.chains, e.a, e.b, coalesce(list_position(list_transform(s.chains, lambda c: c[-1]), e.a), 0) AS p FROM s JOIN e ON e.i = s.i + 1)
)
SELECT chain[1] AS first_id, chain FROM (SELECT unnest(chains) AS chain FROM s WHERE i = (SELECT max(i) FROM s))""")
def n_change_chains(spark, sf):
    """Ids that change into several others, and that several others change into."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"))
    n = rows.count() // 2 + 1
    return authors.change_chains(rows.select("ord", (F.col("ord") * 7919 % n).alias("old_id"), (F.col("ord") * 104729 % n).alias("new_id"))).select("first_id", "chain")


@query(f"""WITH p AS ({PEOPLE}) SELECT id, display_name FROM p WHERE ord >= 20 OR ord % 2 = 1 AND ord >= 10 OR ord % 2 = 0 AND ord >= 10
UNION ALL SELECT 900000 + ord, 'Canon ' || ord FROM p WHERE ord < 10 AND ord % 2 = 0""")
def g3_settle_disputes(spark, sf):
    rows = _people(spark, sf)
    person = F.struct(*authors.FIELDS)
    left = rows.where("ord < 10 AND ord % 2 = 0").select(F.col("ord").alias("left_ord"), person.alias("left"))
    right = rows.where("ord < 10 AND ord % 2 = 1").select((F.col("ord") - 1).alias("left_ord"), F.col("ord").alias("right_ord"), person.alias("right"))
    disputes = left.join(right, "left_ord").select("left_ord", "right_ord", "left", "right")
    null = F.lit(None).cast("string")
    decisions = rows.where("ord < 10").select("ord", F.col("id").alias("first_id"), (F.col("ord") + 900_000).alias("id"), F.concat(F.lit("Canon "), F.col("ord").cast("string")).alias("display_name"), null.alias("first_name"), null.alias("last_name"), null.alias("email"), null.alias("login"))
    return authors.settle(rows, disputes, decisions)[0].select("id", "display_name")


# Bylines.


def _bylined(spark, sf) -> DataFrame:
    """Articles with three names: one of an author, one nearly so, one of nobody."""
    rows = _people(spark, sf, "supplier").select("ord", "display_name")
    n = rows.count()
    docs = _docs(spark, sf).select("doc_id", (F.col("doc_id") % n).alias("ord"))
    upper = F.upper(F.replace("display_name", F.lit(" "), F.lit(". ")))
    return docs.join(rows, "ord").select(F.col("doc_id").alias("id"), F.array(upper, F.lit("nobody at all"), F.lit("The Board"), F.lit("")).alias("names"))


BYLINED = f"""SELECT doc_id AS id, upper(replace(display_name, ' ', '. ')) AS name, display_name FROM documents JOIN (SELECT * FROM ({GUESTS})) g ON g.ord = doc_id % (SELECT count(*) FROM supplier)"""
LOOKUP = f"""SELECT key, min(author_id) AS author_id, arg_min(name, author_id * 2 + pos) AS name FROM (
  SELECT replace(display_name, ' ', '') AS key, id AS author_id, display_name AS name, 0 AS pos FROM ({GUESTS}) UNION ALL
  SELECT regexp_replace(login, '[0-9]', '', 'g'), id, display_name, 1 FROM ({GUESTS})) GROUP BY key"""


@query(f"SELECT * FROM ({LOOKUP})")
def d6_author_lookup(spark, sf):
    return bylines.author_lookup(_people(spark, sf, "supplier")).select("key", "author_id", "name")


@query(f"""SELECT key, count(*)::BIGINT AS n_names, count(DISTINCT id)::BIGINT AS n_articles, min(id) AS first_article FROM (
  SELECT id, replace(display_name, ' ', '') AS key FROM ({BYLINED}) UNION ALL SELECT id, 'nobodyatall' FROM ({BYLINED}) UNION ALL SELECT id, 'theboard' FROM ({BYLINED})) GROUP BY key""")
def e1_unique_names(spark, sf):
    return bylines.unique_names(_bylined(spark, sf))


@query(f"""SELECT id AS article_id, b.name AS name, l.author_id, l.name AS found FROM ({BYLINED}) b JOIN ({LOOKUP}) l ON l.key = replace(b.display_name, ' ', '')""")
def d1_exact_match(spark, sf):
    lookup = bylines.author_lookup(_people(spark, sf, "supplier"))
    return bylines.occurrences(_bylined(spark, sf)).join(lookup.select("key", "author_id", F.col("name").alias("found")), "key").select("article_id", "name", "author_id", "found")


def _edits(spark, sf) -> DataFrame:
    rows = _people(spark, sf, "supplier").where("ord < 2")
    return rows.select(F.lit("the board").alias("match"), F.col("ord").cast("int").alias("at"), F.col("display_name").alias("target"))


@query(f"""SELECT 'theboard' AS key, g.ord::INTEGER AS "at", l.author_id FROM ({GUESTS}) g JOIN ({LOOKUP}) l ON l.key = replace(g.display_name, ' ', '') WHERE g.ord < 2""")
def d2_special_edits(spark, sf):
    found = bylines.occurrences(_bylined(spark, sf)).select("key").distinct()
    lookup = bylines.author_lookup(_people(spark, sf, "supplier"))
    return bylines.special_matches(found, _edits(spark, sf), lookup).select("key", "at", "author_id")


@query(f"""WITH l AS ({LOOKUP}), k AS (SELECT key || substr(key, 1, 1) AS key FROM l WHERE length(key) > 3),
s AS (SELECT key, {_SHINGLES.format(k='key')} AS s FROM k), t AS (SELECT key, author_id, {_SHINGLES.format(k='key')} AS s FROM l),
p AS (SELECT s.key, author_id, len(list_intersect(s.s, t.s)) / (len(s.s) + len(t.s) - len(list_intersect(s.s, t.s))) AS sim FROM s, t)
SELECT key, max(sim) >= 0.9 - 1e-12 AS matched, round(max(sim), 9) AS sim FROM p WHERE sim >= 0.8 - 1e-12 GROUP BY key""")
def d3_similar_names(spark, sf):
    lookup = bylines.author_lookup(_people(spark, sf, "supplier"))
    found = lookup.where(F.length("key") > 3).select(F.concat("key", F.col("key").substr(1, 1)).alias("key")).distinct()
    return bylines.similar_names(found, lookup).groupBy("key").agg(F.bool_or("matched").alias("matched"), F.round(F.max("sim"), 9).alias("sim"))


@query(f"""SELECT b.id, list_concat([l.author_id], (SELECT list(x.author_id ORDER BY g.ord) FROM ({GUESTS}) g JOIN ({LOOKUP}) x ON x.key = replace(g.display_name, ' ', '') WHERE g.ord < 2)) AS author_ids
FROM ({BYLINED}) b JOIN ({LOOKUP}) l ON l.key = replace(b.display_name, ' ', '')""")
def d7_apply_matches(spark, sf):
    rows = _bylined(spark, sf)
    found = bylines.match_bylines(rows, _people(spark, sf, "supplier"), _edits(spark, sf))
    return bylines.apply_matches(rows, found["matches"]).select("id", "author_ids")


@query(f"SELECT 'nobody at all' AS name, list(DISTINCT id ORDER BY id) AS article_ids FROM ({BYLINED}) UNION ALL SELECT 'The Board', list(DISTINCT id ORDER BY id) FROM ({BYLINED})")
def d8_unknown_names(spark, sf):
    return bylines.match_bylines(_bylined(spark, sf), _people(spark, sf, "supplier"))["unknown"]


@query("SELECT event_type AS name, list(DISTINCT i ORDER BY i) AS article_ids FROM (SELECT event_type, user_id AS i FROM events UNION ALL SELECT event_type, event_id % 50 FROM events) GROUP BY event_type")
def e3_merge_unknown(spark, sf):
    e = table(spark, sf, "events")
    return bylines.merge_unknown(e.groupBy(F.col("event_type").alias("name")).agg(F.collect_set("user_id").alias("article_ids")), e.groupBy(F.col("event_type").alias("name")).agg(F.collect_set(F.col("event_id") % 50).alias("article_ids")))


@query("SELECT CASE WHEN min(run) = 0 THEN 0 ELSE 1 END::INTEGER AS run, event_type, user_id FROM (SELECT 0 AS run, event_type, user_id FROM events WHERE event_id % 2 = 0 UNION ALL SELECT 1, event_type, user_id FROM events) GROUP BY event_type, user_id")
def e7_merge_conflicts(spark, sf):
    e = table(spark, sf, "events").select(F.col("event_id").alias("ord"), F.struct("event_type", "user_id").alias("conflict"))
    return export.merged_conflicts(e.where("ord % 2 = 0"), e).select("run", "conflict.event_type", "conflict.user_id")


# Sources and files, written from the tables and read again.


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def _zipping(uri: str):
    """One archive of (name, line), a member for each name in a row."""

    def run(batches):
        now, member = None, None
        with storage.writing(uri) as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for batch in batches:
                for name, line in zip(*(c.to_pylist() for c in batch.columns)):
                    if name != now:
                        if member is not None:
                            member.close()
                        now, member = name, z.open(name, "w")
                    member.write(f"{line}\n".encode())
            if member is not None:
                member.close()
        yield from ()

    return run


@query("SELECT 'pages/' || (page_id % 3) || '.txt' AS member, url AS value FROM pages")
def a1_unzip(spark, sf):
    """An archive of three members, read from where they were unpacked."""
    folder = _folder(spark)
    rows = table(spark, sf, "pages").select(F.format_string("pages/%d.txt", F.col("page_id") % 3).alias("name"), "url")
    rows.coalesce(1).sortWithinPartitions("name").mapInArrow(_zipping(storage.located(spark, f"{folder}/export.zip")), "name string").collect()
    members = export.unzip(spark, f"{folder}/export.zip", f"{folder}/out")
    return spark.read.text(members).select(F.concat(F.lit("pages/"), F.element_at(F.split("_metadata.file_path", "/"), -1)).alias("member"), "value")


def _export(elements: DataFrame) -> str:
    """The path of a folder of XML files with the elements of (ord, line), as the content system parts a large export."""
    path = _folder(elements.sparkSession)
    head = '<?xml version="1.0" encoding="UTF-8"?><rss xmlns:content="c" xmlns:wp="w"><channel>'
    files.write_parts(elements.toDF("ord", "line"), path, head, "</channel></rss>")
    return path


def _element(name: str, value) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


@query("SELECT 'T &<' || c_custkey AS title, c_name AS body, lower(c_name) AS slug, c_mktsegment AS tag, c_custkey::VARCHAR AS meta FROM customer")
def a2_read_items(spark, sf):
    """Items of an export with an attribute, nested and repeated elements."""
    c = table(spark, sf, "customer")
    meta = _element("wp:postmeta", F.concat(_element("wp:meta_key", F.lit("k")), _element("wp:meta_value", F.col("c_custkey").cast("string"))))
    term = F.concat(F.lit('<category domain="post_tag" nicename="n">'), "c_mktsegment", F.lit("</category>"))
    title = _element("title", F.concat(F.lit("T &amp;&lt;"), F.col("c_custkey").cast("string")))
    item = _element("item", F.concat(title, _element("content:encoded", F.col("c_name")), _element("wp:post_name", F.lower("c_name")), term, meta))
    return export.articles(spark, _export(c.select("c_custkey", item))).select("title", "body", "slug", F.get("terms", F.lit(0))["text"].alias("tag"), F.get("meta", F.lit(0))["value"].alias("meta"))


@query("SELECT s_name AS display_name, 'l' || s_suppkey AS login, NULL::VARCHAR AS email FROM supplier")
def a4_read_authors(spark, sf):
    s = table(spark, sf, "supplier")
    login = _element("wp:author_login", F.concat(F.lit("l"), F.col("s_suppkey").cast("string")))
    author = _element("wp:author", F.concat(login, _element("wp:author_email", F.lit("")), _element("wp:author_display_name", F.col("s_name"))))
    return export.authors(spark, _export(s.select("s_suppkey", author))).select(F.col("`wp:author_display_name`").alias("display_name"), F.col("`wp:author_login`").alias("login"), F.col("`wp:author_email`").alias("email"))


@query("SELECT o_orderstatus AS status, count(*) AS written, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE count(*) END AS left, o_orderstatus = 'F' AS deleted, false AS again FROM orders GROUP BY 1")
def a5_delete(spark, sf):
    """A folder for each status; one is deleted, once and in vain a second time, and what is left is counted."""
    path = _folder(spark)
    orders = table(spark, sf, "orders")
    orders.select("o_orderkey", F.col("o_orderstatus").alias("status")).write.partitionBy("status").parquet(path)
    before = cut_lineage(spark.read.parquet(path).groupBy("status").agg(F.count("*").alias("written")))
    first, second = (export.delete(spark, f"{path}/status=F") for _ in range(2))
    left = spark.read.schema("o_orderkey long, status string").parquet(path).groupBy("status").agg(F.count("*").alias("n"))
    gone = F.col("status") == "F"
    return before.join(left, "status", "left").select("status", "written", F.coalesce("n", F.lit(0)).cast("long").alias("left"), (gone & F.lit(first)).alias("deleted"), (gone & F.lit(second)).alias("again"))


@query("SELECT c_name AS name, c_custkey AS author_id, c_mktsegment AS display_name FROM customer")
def a6_stored_cache(spark, sf):
    """A cache that one run stored and the next one loads; where none is, it is empty."""
    path, schema = _folder(spark), "name string, author_id bigint, display_name string"
    none = export.stored(spark, path, schema)
    export.store(table(spark, sf, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("author_id"), F.col("c_mktsegment").alias("display_name")), path)
    return export.stored(spark, path, schema).union(none)


@query("""SELECT 'CREATE TABLE authors (id BIGINT PRIMARY KEY AUTO_INCREMENT, display_name VARCHAR(255), first_name VARCHAR(255), last_name VARCHAR(255), email VARCHAR(255), login VARCHAR(255));' AS line
UNION ALL SELECT 'INSERT INTO authors (id, display_name, first_name, last_name, email, login) VALUES (''' || c_custkey || ''', ''' || c_name || ''', NULL, NULL, NULL, ''' || c_mktsegment || ''');' FROM customer""")
def l6_sql_file(spark, sf):
    """One file: the definition, then the commands."""
    null, path = F.lit(None).cast("string"), f"{_folder(spark)}.sql"
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_custkey").alias("id"), F.col("c_name").alias("display_name"), null.alias("first_name"), null.alias("last_name"), null.alias("email"), F.col("c_mktsegment").alias("login"))
    files.write_lines(dumps.authors_dump(c), path)
    return spark.read.text(path).toDF("line")


@query("SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS at, c_custkey AS key, c_name AS name, NULL::VARCHAR AS none FROM customer")
def l7_positioned_json(spark, sf):
    """One JSON object of all rows by place."""
    path = f"{_folder(spark)}.json"
    files.write_positioned(table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit(None).cast("string").alias("none")), "key", path)
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,struct<key:bigint,name:string,none:string>>")).alias("at", "row"))
    return whole.select(F.col("at").cast("long").alias("at"), "row.*")


@query("SELECT (i // 1000)::BIGINT AS bucket, count(*) AS n, min(i) AS first_at, min(o_orderkey) AS first_key FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) GROUP BY 1")
def l8_buckets(spark, sf):
    """Files of 1000 rows each, named by their numbers."""
    folder = _folder(spark)
    files.write_buckets(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", folder)
    read = spark.read.text(folder, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"(\d+)\.json$", 1).cast("long").alias("bucket"), F.from_json("value", "map<string,struct<o_orderkey:bigint,o_orderstatus:string>>").alias("m"))
    rows = read.select("bucket", F.explode("m").alias("at", "row"))
    return rows.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.col("at").cast("long")).alias("first_at"), F.min("row.o_orderkey").alias("first_key"))


@query("""SELECT row_number() OVER (ORDER BY p.ord, side) - 1 AS ord, p.id + 2 * side AS first_id, p.ord + 900000 AS canonical_id
FROM (SELECT c_custkey AS ord, c_custkey * 2 AS id FROM customer WHERE c_custkey % 2 = 0 AND c_custkey + 1 IN (SELECT c_custkey FROM customer)) p, (VALUES (0), (1)) v(side)""")
def l9_conflicts(spark, sf):
    """Decided disputes as they are stored, read again as the decisions of the next run."""
    rows, path = _people(spark, sf), _folder(spark)
    person = F.struct(*authors.FIELDS)
    left = rows.where("ord % 2 = 0").select(F.col("ord").alias("left_ord"), person.alias("left"))
    right = rows.where("ord % 2 = 1").select((F.col("ord") - 1).alias("left_ord"), F.col("ord").alias("right_ord"), person.alias("right"))
    disputes = left.join(right, "left_ord").select("left_ord", "right_ord", "left", "right")
    decisions = rows.select("ord", F.col("id").alias("first_id"), (F.col("ord") + 900_000).alias("id"), *authors.FIELDS[1:]).where("ord % 2 = 0")
    export.store(authors.conflicts(disputes, decisions), path)
    found = authors.stored_decisions(export.stored(spark, path, migration.STATE["staff_conflicts"]))
    return found.select("ord", "first_id", F.col("id").alias("canonical_id"))


# Sinks and vectors.


@query("""SELECT c_custkey AS ord, 'INSERT INTO authors (id, display_name, first_name, last_name, email, login) VALUES (''' || c_custkey || ''', ''O''''B\\\\' || c_name || ''', NULL, ''' || c_mktsegment || ''', NULL, ''x'');' AS command FROM customer""")
def l3_authors_sql(spark, sf):
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_custkey").alias("id"), F.concat(F.lit("O'B\\"), "c_name").alias("display_name"), F.lit(None).cast("string").alias("first_name"), F.col("c_mktsegment").alias("last_name"), F.lit("0000-00-00").alias("email"), F.lit("x").alias("login"))
    return dumps.authors_inserts(rows)


def _dumped(dump: Callable[[DataFrame], DataFrame], rows: DataFrame) -> DataFrame:
    """(of, ord, line): the dump of the rows, and that of none."""
    return dump(rows).select(F.lit("all").alias("of"), "ord", "line").union(dump(rows.limit(0)).select(F.lit("none"), "ord", "line"))


HEAD = "-4611686018427387904 AS ord"
SEO_DDL = "'CREATE TABLE seo (id BIGINT PRIMARY KEY, article_id BIGINT NOT NULL, yoast_tag_data LONGTEXT);' AS line"


@query(f"""SELECT unnest(['all', 'none']) AS of, {HEAD}, {SEO_DDL} UNION ALL
SELECT 'all', id, 'INSERT INTO seo (id, article_id, yoast_tag_data) VALUES(''' || id || ''', ''' || id || ''', ''{{"_yoast_a": "' || source || '"}}'');' FROM ({KEPT})""")
def l2_seo_sql(spark, sf):
    return _dumped(dumps.seo_dump, articles.translate_articles(_articles(spark, sf)))


ARTICLES_DDL = """'CREATE TABLE articles (`id` BIGINT PRIMARY KEY AUTO_INCREMENT, `creation_date` DATETIME, `slug` LONGTEXT, `author_ids` LONGTEXT, `authors` LONGTEXT, `breaking_news` BOOL, `comment_status` VARCHAR(255), `description` LONGTEXT, `featured_img_id` BIGINT, `priority` BOOL, `mod_date` DATETIME, `photo_url` LONGTEXT, `pub_date` DATETIME, `tags` LONGTEXT, `categories` LONGTEXT, `metadata` LONGTEXT, `text` LONGTEXT, `excerpt` LONGTEXT, `title` LONGTEXT);'"""


@query(f"""SELECT 'all' AS of, {HEAD}, {ARTICLES_DDL} AS line UNION ALL
SELECT 'all', id, 'INSERT INTO articles (`id`, `creation_date`, `slug`, `author_ids`, `authors`, `breaking_news`, `comment_status`, `description`, `featured_img_id`, `priority`, `mod_date`, `photo_url`, `pub_date`, `tags`, `categories`, `metadata`, `text`, `excerpt`, `title`) VALUES('''
  || id || ''', NULL, ''' || lang || ' ' || source || ''', ''[1, 2]'', ''["' || source || '. ' || lang || '"]'', 0, ''open'', ''' || lang || ''', ''-1'', 0, ''2020-01-02 00:00:00'', NULL, NULL, ''["'
  || list_sort(['R&' || source, lang])[2] || '", "' || list_sort(['R&' || source, lang])[1] || '"]'', ''["' || lang || '"]'', ''{{"_yoast_a": "' || source || '"}}'', '''
  || replace(replace(t, '\\', '\\\\'), '''', '''''') || ''', NULL, ''T "&" ' || source || ''');' FROM ({KEPT})""")
def l1_articles_sql(spark, sf):
    """Without articles there is no dump, not even the table."""
    rows = articles.translate_articles(_articles(spark, sf)).withColumns({"author_ids": F.array(F.lit(1), F.lit(2)), "excerpt": F.lit(None).cast("string")})
    return _dumped(lambda r: dumps.articles_dump(r, SITE), rows)


BRIDGE_DDL = "'CREATE TABLE articles_authors (id BIGINT PRIMARY KEY, author_id BIGINT NOT NULL, articles_id BIGINT NOT NULL);' AS line"


@query(f"""SELECT unnest(['all', 'none']) AS of, {HEAD}, {BRIDGE_DDL} UNION ALL
SELECT 'all', (row_number() OVER (ORDER BY o_orderkey, l_linenumber, l_suppkey))::BIGINT, 'INSERT INTO articles_authors (id, author_id, articles_id) VALUES (' || row_number() OVER (ORDER BY o_orderkey, l_linenumber, l_suppkey) || ', ' || l_suppkey || ', ' || o_orderkey || ');' FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def l4_articles_authors_sql(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_suppkey"))).alias("l"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return _dumped(dumps.articles_authors_dump, orders.join(lines, "id").select("id", F.transform("l", lambda x: x["l_suppkey"]).alias("author_ids")))


@query(f"""SELECT 'none' AS of, {HEAD}, 'DROP TABLE IF EXISTS article_embeddings;' || chr(10) || '-- No articles to embed.' AS line UNION ALL
SELECT 'all', -4611686018427387904, 'DROP TABLE IF EXISTS article_embeddings;' || chr(10) || 'CREATE TABLE article_embeddings (' || chr(10) || '  article_id BIGINT PRIMARY KEY,' || chr(10) || '  embedding VECTOR(' || (SELECT max(len(embedding)) FROM embeddings) || ') NOT NULL,' || chr(10) || '  VECTOR INDEX (embedding) DISTANCE=euclidean' || chr(10) || ');' UNION ALL
SELECT 'all', vec_id, 'INSERT INTO article_embeddings (article_id, embedding) VALUES (' || vec_id || ', VEC_FromText(''[' || array_to_string(list_transform(embedding, lambda x: printf('%.8f', x::DOUBLE)), ',') || ']''));' FROM embeddings""")
def l5_embeddings_sql(spark, sf):
    return _dumped(lambda r: dumps.embeddings_dump(r, "vec_id"), table(spark, sf, "embeddings"))


@query("SELECT doc_id, '[' || array_to_string(list_transform([lang, source, NULL], lambda x: coalesce('\"' || x || '\"', 'null')), ', ') || ']' AS list, '{\"a\": \"' || lang || '\", \"b\": null}' AS map FROM documents")
def j_json(spark, sf):
    null = F.lit(None).cast("string")
    return _docs(spark, sf, "lang", "source").select("doc_id", literals.json_list(F.array("lang", "source", null)).alias("list"), literals.json_map(F.create_map(F.lit("a"), F.col("lang"), F.lit("b"), null)).alias("map"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
d AS (SELECT q.vec_id AS query_id, v.vec_id, list_distance(q.e, v.e) AS distance FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM d)
SELECT query_id, rank, vec_id, round(distance, 6) AS distance FROM r WHERE rank <= 5""")
def k4_nearest(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return vectors.pruned_nearest(v, v.where("vec_id % 20 = 0"), 5)[0].withColumn("distance", F.round("distance", 6))


@query(r"""SELECT page_id AS id, substr(array_to_string(list_filter([trim(url), regexp_replace(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')), '^$', '')], lambda x: x <> ''), chr(10) || chr(10)), 1, 5000) AS text FROM pages""")
def k3_embeddable(spark, sf):
    rows = table(spark, sf, "pages").select(F.col("page_id").cast("string").alias("id"), F.col("url").alias("title"), F.lit(" ").alias("description"), F.col("html").alias("text"))
    return vectors.embeddable(rows)


@query()
def k2_embed(spark, sf):
    rows = table(spark, sf, "pages").select(F.col("page_id").alias("id"), content.strip_html(F.col("html")).alias("text"))
    return vectors.embed(rows, vectors.hashed_features(16))
