"""Benchmark decontamination by a prefix-filtered set join.

The sets of the join are an item's windows, WINDOW words in a row (all its words, if it has fewer), and
the texts of the documents; a window occurs in a text if the text contains it whole. A window is
the set of its shingles, up to SHINGLE words with their places. Shingles are ordered by rarity, the
number of their occurrences in all documents, from one count of the shingles that windows have. What
is to be contained whole has a necessary prefix of one token, so a window is posted under its rarest
shingle alone; one with a shingle that no document has cannot occur. Occurrences of the posted
shingles in documents give candidates. The place of the shingle in the window says where the window
would begin (positional bound), and that it must end within the text (length bound). What is left is
compared with the window, word for word. Windows that several items share are posted once.

Documents are never shuffled: they are scanned past broadcast tables of shingles, BLOCK_ROWS rows at
most at once; more are taken block by block, a scan for each. Hits are gathered by a 128-bit hash of
the text, so copies count once before the shuffle, and join the documents' rows (without text) again
by a skew-safe join. Lists of items are made for each set of windows that occurs together, not for
each document.

Defined cases: null texts and texts without words have no windows and no hits. Repeated items and
rows count once for each item_id; windows of items with a null item_id hit, but are not counted
among items nor in the digest. Documents are judged row by row, whatever their doc_id. Without items
nothing is hit. items_sha256 of no items is that of the empty text. Texts are worked on whole.
Other columns are not used, whatever their names. Ties of rarity go to the earlier shingle; they
change no result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.session import cut_lineage

#: Words of a window and, at most, of a shingle.
WINDOW, SHINGLE = 10, 3
#: Rows of shingles (with their windows) that are broadcast at once.
BLOCK_ROWS = 200_000

# The characters of words: all but U+0000 to U+002F, U+003A to U+0060 and U+007B to U+007F. Said so, a class is matched faster.
_WORD, _CASED = r"[0-9a-z\x80-\x{10FFFF}]+", r"[0-9A-Za-z\x80-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    ascii_ = F.octet_length(text) == F.length(text)  # then A-Z are the only capitals
    return F.regexp_extract_all(F.when(ascii_, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER)), F.lit(_WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_CASED)), F.lit(0)).cast("long")


def _shingles(of: Column, width: int) -> Column:
    """A hash of the `width` words from each word on; the last ones have fewer words."""
    return F.transform(of, lambda w, i: F.xxhash64(w, *[F.get(of, i + j) for j in range(1, width)]))


def windows(items: DataFrame, item: str, text: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(window, n, width, text, words) of the distinct windows, and (window, item): checkpoints."""
    own = items.select(F.col(item).cast("string").alias("item"), words(F.col(text)).alias("w")).where("size(w) > 0")
    n = F.least(F.lit(size), F.size("w"))
    each = own.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.slice("w", i, n))).alias("words"))
    each = each.withColumn("text", F.array_join("words", " "))  # words have no spaces
    of = each.groupBy("text").agg(F.first("words").alias("words")).withColumns({"n": F.size("words"), "width": F.least(F.lit(SHINGLE), F.size("words"))})
    of = cut_lineage(of.withColumn("window", F.monotonically_increasing_id()))
    return of, cut_lineage(each.join(of.select("text", "window"), "text").where("item IS NOT NULL").select("window", "item").distinct())


def _blocks(tokens: DataFrame) -> list[DataFrame]:
    """tokens (shingle, ...) in blocks of about BLOCK_ROWS rows, a shingle's rows in one."""
    n = -(-tokens.count() // BLOCK_ROWS)
    return [tokens.where(F.pmod(F.xxhash64("shingle", F.lit(1)), F.lit(n)) == i) for i in range(n)] if n > 1 else [tokens] * n


def _scan(texts: DataFrame, width: int) -> DataFrame:
    """(k1, k2, w, at, shingle) of every shingle of every text; w, the words, is only referred to until a row is chosen."""
    tokens = texts.select("k1", "k2", words(F.col("text")).alias("w")).withColumn("s", _shingles(F.col("w"), width))
    return tokens.select("k1", "k2", "w", F.posexplode_outer("s").alias("at", "shingle"))  # the inner form would be filtered by its own shingles first


def _rarest(texts: DataFrame, of: DataFrame, width: int) -> DataFrame:
    """(shingle, place, n, window, text): each window under its rarest shingle; windows with one that no text has are left out."""
    places = F.slice(_shingles(F.col("words"), width), F.lit(1), F.col("n") - width + 1)
    posted = cut_lineage(of.where(F.col("width") == width).select("window", "n", "text", F.posexplode(places).alias("place", "shingle")))
    distinct = cut_lineage(posted.select("shingle").distinct())
    found = [_scan(texts, width).join(F.broadcast(b), "shingle").groupBy("shingle").agg(F.count("*").alias("c")) for b in _blocks(distinct)]
    if not found:
        return posted.select("shingle", "place", "n", "window", "text").limit(0)
    counts = cut_lineage(reduce(DataFrame.union, found))
    ranked = posted.join(counts, "shingle", "left").groupBy("window", "n", "text").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "place", "shingle")).alias("r"))
    return cut_lineage(ranked.where("r.c > 0").select("r.shingle", "r.place", "n", "window", "text"))


def occurrences(texts: DataFrame, of: DataFrame) -> DataFrame:
    """(k1, k2, begin, end, window): where the windows occur in texts (k1, k2, text), in words."""
    found = []
    for r in of.select("width").distinct().collect():  # SHINGLE at most
        for block in _blocks(_rarest(texts, of, r["width"])):
            met = _scan(texts, r["width"]).join(F.broadcast(block), "shingle").withColumn("begin", F.col("at") - F.col("place"))
            met = met.where((F.col("begin") >= 0) & (F.col("begin") + F.col("n") <= F.size("w")))
            met = met.where(F.array_join(F.slice("w", F.col("begin") + 1, F.col("n")), " ") == F.col("text"))
            found.append(met.select("k1", "k2", F.col("begin").cast("long").alias("begin"), (F.col("begin") + F.col("n")).cast("long").alias("end"), "window"))
    empty = texts.select("k1", "k2", F.lit(0).cast("long").alias("begin"), F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("window")).limit(0)
    return reduce(DataFrame.union, found) if found else empty


def _covered(spans: Column) -> Column:
    """Words in any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("upto"))
    step = lambda s, x: F.struct((s["n"] + F.greatest(F.lit(0).cast("long"), x["end"] - F.greatest(x["begin"], s["upto"]))).alias("n"), F.greatest(s["upto"], x["end"]).alias("upto"))
    return F.aggregate(spans, start, step, lambda s: s["n"])


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every row of docs."""
    content = F.col(text).cast("string")
    of, of_items = windows(items, item, item_text, size)
    texts = docs.select(F.xxhash64(content).alias("k1"), F.xxhash64(F.lit(1), content).alias("k2"), content.alias("text"))
    hits = occurrences(texts, of).groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("begin", "end"))).alias("spans"), F.array_sort(F.collect_set("window")).alias("windows"))  # a text's
    hits = cut_lineage(hits.select("k1", "k2", _covered(F.col("spans")).alias("n_hit"), "windows"))
    each = hits.select("windows").distinct().select("windows", F.explode("windows").alias("window")).join(of_items, "window")
    lists = each.groupBy("windows").agg(F.array_sort(F.collect_set("item")).alias("i")).select("windows", F.size("i").cast("long").alias("n_items"), F.sha2(F.array_join("i", ","), 256).alias("items_sha256"))
    found = cut_lineage(hits.join(lists, "windows", "left").drop("windows"))  # on its own, so that a hot text's rows can be split
    rows = docs.select(F.col(key), n_words(content).alias("n_words"), F.xxhash64(content).alias("k1"), F.xxhash64(F.lit(1), content).alias("k2"))
    out = rows.join(found, ["k1", "k2"], "left")
    none = F.sha2(F.lit("").cast("binary"), 256)
    zero = F.lit(0).cast("long")
    return out.select(key, "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"), F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contaminated(docs.select("doc_id", "text"), items.select("item_id", "text"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0))),
places AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS t
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT DISTINCT r, i, p.n, item_id FROM places p JOIN windows USING (n, t)),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS k FROM found) GROUP BY r),
listed AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item_id FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""
