"""URL filters: host-suffix and path-prefix rules by hash-prefix lookup, in DataFrame operations only.

A rule is (host, path, verdict). It fits a url whose host is the rule's host or a subdomain of
it and whose path starts with the rule's path; of the rules that fit, the one with the longest
`host + path` wins (then the longer host, then `block` over `allow`).

Method. A rule's *shape* is (labels in its host, length of its path). Every url is expanded into
one expression for each shape: the last so many labels of its host, and the first so many code
points of its path. The expression's SHA-256 is looked up by its first 32 bits (an equi-join on
an int), the full digest then confirms the hit, and precedence picks among confirmed hits.

Two physical forms of that one plan:

* few shapes and a rule table under a checked size: the rules of each shape, grouped by hash
  prefix, are broadcast; a url row never multiplies and nothing is shuffled.
* else: expressions are exploded and joined with the rules by (shape, hash prefix) in a shuffle
  join with salted keys, so that a host with a third of all urls is spread; the best hit of each
  url comes back by a map-side-combined aggregate.

Defined cases: null url or one without `://`: host and path are empty, no rule fits. Repeated
rows are judged one by one and all returned. Rules with null host, path or verdict are left out;
of equal (host, path) rules `block` wins. Empty tables give empty results. Extra columns are kept,
whatever their names; host, path, rule and verdict replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm.columns import fresh

#: Rules in all that are broadcast at most: under 200 bytes each, 20 MB in all.
BROADCAST_RULES = 100_000
#: Shapes that become one broadcast lookup each at most.
NARROW_SHAPES = 16
SALTS = 32
DEFAULT_VERDICT = "allow"


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) literals as a DataFrame."""
    rows = [F.struct(*(F.lit(v).cast("string").alias(n) for n, v in zip(("host", "path", "verdict"), r))) for r in rules]
    if not rows:
        return spark.range(0).select(*(F.lit("").alias(n) for n in ("host", "path", "verdict")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; '' for null or no `://`."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _short(digest: Column) -> Column:
    """The digest's first 32 bits."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def _expression(host: Column, path: Column, labels: int | Column, length: int | Column) -> Column:
    """Host suffix, a separator that hosts cannot hold, and path prefix."""
    labels = F.lit(labels) if isinstance(labels, int) else labels
    length = F.lit(length) if isinstance(length, int) else length
    return F.concat(F.substring_index(host, ".", -labels) if isinstance(labels, int) else _suffix(host, labels), F.lit("/"), path.substr(F.lit(1), length))


def _suffix(host: Column, labels: Column) -> Column:
    parts = F.split(host, r"\.", -1)
    return F.array_join(F.when(F.size(parts) > labels, F.slice(parts, F.size(parts) - labels + 1, labels)).otherwise(parts), ".")


def _prepared(rules: DataFrame) -> DataFrame:
    rules = rules.select(*(F.col(c).cast("string") for c in ("host", "path", "verdict"))).dropna()
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # block > allow
    digest = F.sha2(F.concat("host", F.lit("/"), "path"), 256)
    return rules.select(
        F.size(F.split("host", r"\.", -1)).alias("labels"),
        F.length("path").alias("length"),
        _short(digest).alias("short"),
        F.struct(
            (F.length("host") + F.length("path")).alias("size"),
            F.length("host").alias("host_size"),
            "verdict",
            F.concat("host", "path").alias("rule"),
            digest.alias("digest"),
        ).alias("hit"),
    )


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", broadcast_rules: int = BROADCAST_RULES, narrow_shapes: int = NARROW_SHAPES) -> DataFrame:
    """`pages` with columns host, path, rule and verdict in place of any of these names."""
    rules = _prepared(rules)
    shapes = rules.groupBy("labels", "length").agg(F.count("*").alias("n")).limit(narrow_shapes + 1).collect()
    pages = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if len(shapes) <= narrow_shapes and sum(s["n"] for s in shapes) <= broadcast_rules:
        return _narrow(pages, rules, sorted((s["labels"], s["length"]) for s in shapes))
    return _wide(pages, rules)


RESULT = ("host", "path", "rule", "verdict")


def _verdict(pages: DataFrame, best: Column, columns: list[str]) -> DataFrame:
    (name,) = fresh([*pages.columns, *RESULT], "best")
    out = pages.withColumn(name, best).withColumns({"rule": F.col(f"{name}.rule"), "verdict": F.coalesce(F.col(f"{name}.verdict"), F.lit(DEFAULT_VERDICT))})
    return out.select(*[c for c in columns if c not in RESULT], *RESULT)


def _confirmed(hits: str, digest: str) -> Column:
    return F.filter(F.col(hits), lambda h: h["digest"] == F.col(digest))


def _narrow(pages: DataFrame, rules: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    hits, columns = [], pages.columns
    for labels, length in shapes:
        at, key, digest = fresh([*pages.columns, *RESULT], "hits", "short", "digest")
        own = rules.where((F.col("labels") == labels) & (F.col("length") == length))
        own = own.groupBy(F.col("short").alias(key)).agg(F.collect_list("hit").alias(at))  # as long as digests collide
        pages = pages.withColumn(digest, F.sha2(F.concat(F.substring_index("host", ".", -labels), F.lit("/"), F.col("path").substr(1, length)), 256))
        pages = pages.withColumn(key, _short(F.col(digest)))
        pages = pages.join(F.broadcast(own), key, "left")
        hits.append(F.get(_confirmed(at, digest), F.lit(0)))
    best = F.array_max(F.array(*hits)) if hits else F.lit(None).cast("struct<rule:string,verdict:string>")
    return _verdict(pages, best, columns)


def _wide(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules of any number and shape. The shapes are few beside the rules, and each url gets those its host and path can fill."""
    shapes = rules.groupBy("labels").agg(F.sort_array(F.collect_set("length")).alias("lengths"))
    shapes = shapes.agg(F.collect_list(F.struct("labels", "lengths")).alias("__shapes"))
    shaped = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # One row for each distinct (host, path), however many urls have it.
    places = pages.select("host", "path").distinct()
    wide = places.join(F.broadcast(shapes)).select("host", "path", F.inline("__shapes"))
    n = F.size(F.split("host", r"\.", -1))
    wide = wide.where(F.col("labels") <= n).select("host", "path", "labels", F.explode("lengths").alias("length"))
    wide = wide.where(F.length("path") >= F.col("length"))
    digest = F.sha2(F.concat(_suffix(F.col("host"), F.col("labels")), F.lit("/"), F.col("path").substr(F.lit(1), F.col("length"))), 256)
    wide = wide.withColumn("digest", digest).withColumn("short", _short(F.col("digest")))
    wide = wide.withColumn("salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)).cast("int"))
    found = wide.join(shaped, ["labels", "length", "short", "salt"]).where(F.col("digest") == F.col("hit.digest"))
    best = found.groupBy("host", "path").agg(F.max("hit").alias("hit"))
    columns, (hit, salt) = pages.columns, fresh([*pages.columns, *RESULT], "hit", "salt")
    best = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).toDF("host", "path", hit, salt)  # pages of one host and path are dealt out
    pages = pages.withColumn(salt, F.pmod(F.spark_partition_id(), F.lit(SALTS))).join(best, ["host", "path", salt], "left")
    return _verdict(pages, F.col(hit), columns)


#: The rules of query op1_url_filters.
QUERY_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return filter_urls(pages, rules_frame(spark, QUERY_RULES)).select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = """
WITH u AS (
  SELECT page_id,
         CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
  FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), j AS (
  SELECT *,
         CASE
           WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
           WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
           WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
           WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
           WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
         END AS rule
  FROM p
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""
