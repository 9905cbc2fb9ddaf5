"""SQL dump files: a CREATE TABLE and one INSERT for each row.

`*_inserts` return (ord, command) DataFrames; `write` orders them into text files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.functions.literals import flag, json_list, json_map, quoted, vector_text
from galley.operators.articles import cms_rows
from galley.operators.keys import bridge_rows

# The columns of the target tables.
ARTICLE_COLUMNS = {
    "id": "BIGINT PRIMARY KEY AUTO_INCREMENT",
    "creation_date": "DATETIME",
    "slug": "LONGTEXT",
    "author_ids": "LONGTEXT",
    "authors": "LONGTEXT",
    "breaking_news": "BOOL",
    "comment_status": "VARCHAR(255)",
    "description": "LONGTEXT",
    "featured_img_id": "BIGINT",
    "priority": "BOOL",
    "mod_date": "DATETIME",
    "photo_url": "LONGTEXT",
    "pub_date": "DATETIME",
    "tags": "LONGTEXT",
    "categories": "LONGTEXT",
    "metadata": "LONGTEXT",
    "text": "LONGTEXT",
    "excerpt": "LONGTEXT",
    "title": "LONGTEXT",
}
AUTHOR_COLUMNS = ("id", "display_name", "first_name", "last_name", "email", "login")


def articles_ddl(table: str = "articles") -> str:
    return f"CREATE TABLE {table} ({', '.join(f'`{c}` {kind}' for c, kind in ARTICLE_COLUMNS.items())});"


def articles_inserts(articles: DataFrame, site: str, table: str = "articles") -> DataFrame:
    rows = cms_rows(articles, site)
    kinds = dict(rows.dtypes)
    values = []
    for c in ARTICLE_COLUMNS:
        if kinds[c] == "boolean":
            values.append(flag(F.col(c)))
        elif kinds[c].startswith("array"):
            values.append(quoted(json_list(F.col(c), "string" not in kinds[c])))
        elif kinds[c].startswith("map"):
            values.append(quoted(json_map(F.col(c))))
        else:
            values.append(quoted(F.col(c)))
    head = f"INSERT INTO {table} ({', '.join(f'`{c}`' for c in ARTICLE_COLUMNS)}) VALUES("
    return rows.select(F.col("id").alias("ord"), F.concat(F.lit(head), F.concat_ws(", ", *values), F.lit(");")).alias("command"))


# The definitions of the other target tables.


def seo_ddl(table: str = "seo") -> str:
    return f"CREATE TABLE {table} (id BIGINT PRIMARY KEY, article_id BIGINT NOT NULL, yoast_tag_data LONGTEXT);"


def seo_inserts(articles: DataFrame, table: str = "seo") -> DataFrame:
    own = quoted(F.col("id"))
    values = F.concat_ws(", ", own, own, quoted(json_map(F.col("metadata"))))
    return articles.select(F.col("id").alias("ord"), F.concat(F.lit(f"INSERT INTO {table} (id, article_id, yoast_tag_data) VALUES("), values, F.lit(");")).alias("command"))


def authors_ddl(table: str = "authors") -> str:
    return f"CREATE TABLE {table} (id BIGINT PRIMARY KEY AUTO_INCREMENT, {', '.join(f'{c} VARCHAR(255)' for c in AUTHOR_COLUMNS[1:])});"


def authors_inserts(authors: DataFrame, table: str = "authors", order: str = "ord") -> DataFrame:
    head = f"INSERT INTO {table} ({', '.join(AUTHOR_COLUMNS)}) VALUES ("
    values = F.concat_ws(", ", *[quoted(F.col(c)) for c in AUTHOR_COLUMNS])
    return authors.select(F.col(order).cast("long").alias("ord"), F.concat(F.lit(head), values, F.lit(");")).alias("command"))


def articles_authors_ddl(table: str = "articles_authors") -> str:
    return f"CREATE TABLE {table} (id BIGINT PRIMARY KEY, author_id BIGINT NOT NULL, articles_id BIGINT NOT NULL);"


def articles_authors_inserts(articles: DataFrame, table: str = "articles_authors") -> DataFrame:
    rows = bridge_rows(articles)
    values = F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("id", "author_id", "articles_id")])
    return rows.select(F.col("id").alias("ord"), F.concat(F.lit(f"INSERT INTO {table} (id, author_id, articles_id) VALUES ("), values, F.lit(");")).alias("command"))


def embeddings_ddl(dim: int, table: str = "article_embeddings") -> str:
    return f"DROP TABLE IF EXISTS {table};\nCREATE TABLE {table} (\n  article_id BIGINT PRIMARY KEY,\n  embedding VECTOR({dim}) NOT NULL,\n  VECTOR INDEX (embedding) DISTANCE=euclidean\n);"


NO_EMBEDDINGS = "DROP TABLE IF EXISTS article_embeddings;\n-- No articles to embed."


def embeddings_inserts(vectors: DataFrame, table: str = "article_embeddings", key: str = "article_id") -> DataFrame:
    values = F.concat(F.lit(f"INSERT INTO {table} (article_id, embedding) VALUES ("), F.col(key).cast("string"), F.lit(", VEC_FromText('"), vector_text(F.col("embedding")), F.lit("'));"))
    return vectors.select(F.col(key).cast("long").alias("ord"), values.alias("command"))


def lines(commands: DataFrame, head: str, always: bool = True) -> DataFrame:
    """(ord, line): `head`, then the commands by `ord`; if not always, the head only before commands."""
    first = commands.sparkSession.range(1) if always else commands.limit(1)
    first = first.select(F.lit(-(1 << 62)).cast("long").alias("ord"), F.lit(head).alias("line"))
    return first.union(commands.select(F.col("ord").cast("long"), F.col("command").alias("line")))


def articles_dump(articles: DataFrame, site: str) -> DataFrame:
    """The lines of the dump; none without articles."""
    return lines(articles_inserts(articles, site), articles_ddl(), always=False)


def seo_dump(articles: DataFrame) -> DataFrame:
    return lines(seo_inserts(articles), seo_ddl())


def authors_dump(authors: DataFrame) -> DataFrame:
    return lines(authors_inserts(authors), authors_ddl())


def articles_authors_dump(articles: DataFrame) -> DataFrame:
    return lines(articles_authors_inserts(articles), articles_authors_ddl())


def embeddings_dump(vectors: DataFrame, key: str = "article_id") -> DataFrame:
    """The lines of the dump; without vectors the table is dropped and not made. It is as wide as the longest vector."""
    width = vectors.where("embedding IS NOT NULL").agg(F.max(F.size("embedding"))).first()[0]
    return lines(embeddings_inserts(vectors, key=key), NO_EMBEDDINGS if width is None else embeddings_ddl(width))


def write(dump: DataFrame, path: str) -> None:
    """A folder of text files that, in the order of their names, make the dump; for one file see `files.write_lines`.

    Every part is sorted and the parts follow each other, so no task holds all commands.
    """
    dump.repartitionByRange("ord").sortWithinPartitions("ord").select("line").write.mode("overwrite").text(path)
