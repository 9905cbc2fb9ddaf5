"""The whole migration: an export's three files to sanitised authors, articles and dump files."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.operators import articles as art
from galley.operators import authors as auth
from galley.operators import bylines, slugs, vectors
from galley.operators.authors import FIELDS
from galley.operators.keys import dense_ids
from galley.sinks import files, sql
from galley.sources import export
from galley.session import cut_lineage

# The file-size unit of the article log.
LOG_ROWS = 1000


@dataclass
class Policies:
    """What an editor decides, as tables; each may be missing.

    staff_edits, guest_edits: see `authors.edit_rows`; staff_banned, guest_banned: display_name;
    staff_decisions, guest_decisions: see `authors.settle`; byline_edits: match, at, target;
    byline_cache: name, author_id, display_name.
    """

    staff_edits: DataFrame | None = None
    guest_edits: DataFrame | None = None
    staff_banned: DataFrame | None = None
    guest_banned: DataFrame | None = None
    staff_decisions: DataFrame | None = None
    guest_decisions: DataFrame | None = None
    byline_edits: DataFrame | None = None
    byline_cache: DataFrame | None = None


_PERSON = "struct<id:bigint,display_name:string,first_name:string,last_name:string,email:string,login:string>"
#: What one run leaves to the next, by name, and the columns.
STATE = {
    "staff_conflicts": f"ord bigint, conflict struct<first:{_PERSON},canonical:{_PERSON}>",
    "guest_conflicts": f"ord bigint, conflict struct<first:{_PERSON},canonical:{_PERSON}>",
    "byline_unknown": "name string, article_ids array<bigint>",
    "byline_cache": "name string, author_id bigint, display_name string",
}


@dataclass
class Migrated:
    """authors, articles, and the logs that an editor reads."""

    authors: DataFrame
    articles: DataFrame
    logs: dict[str, DataFrame] = field(default_factory=dict)


def _decisions(stored: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
    """Decisions of earlier runs come before this run's."""
    if stored is None:
        return new
    old = auth.stored_decisions(stored)
    if new is None:
        return old
    start = old.agg(F.coalesce(F.max("ord") + 1, F.lit(0))).first()[0]
    return old.unionByName(new.select((F.col("ord") + start).alias("ord"), "first_id", *FIELDS, F.lit(False).alias("stored")))


def _people(rows: DataFrame, edits, banned, decisions, stored, logs: dict, name: str) -> DataFrame:
    decisions = _decisions(stored, decisions)
    rows, logs[f"{name}_disputes"], changes, settled = auth.sanitise(rows.withColumn("ord", F.col("id")), edits, banned, decisions)
    changes = cut_lineage(changes)
    logs[f"{name}_changes"] = changes
    logs[f"{name}_chains"] = auth.change_chains(auth.logged(changes))
    if settled is not None:
        old = stored if stored is not None else settled.limit(0)
        merged = cut_lineage(export.merged_conflicts(old, settled).withColumn("place", F.col("run") * F.lit(1 << 40) + F.col("ord")))
        logs[f"{name}_conflicts"] = dense_ids(merged.select("place", "conflict"), "place", "ord").select("ord", "conflict")
    return unique_logins(rows)


def unique_logins(rows: DataFrame) -> DataFrame:
    return slugs.unique_slugs(rows, (F.col("login"), F.col("display_name")), "author", name="login", tie="ord").select("ord", *FIELDS)


def migrate(staff: DataFrame, guests: DataFrame, items: DataFrame, policies: Policies = Policies(), state: dict[str, DataFrame] | None = None) -> Migrated:
    """staff, guests, items: as `sources.export` reads them. state: what an earlier run left, see `read_state`."""
    p, logs, earlier = policies, {}, state or {}
    people = _people(art.staff_authors(staff), p.staff_edits, p.staff_banned, p.staff_decisions, earlier.get("staff_conflicts"), logs, "staff")
    more = _people(art.guest_authors(guests), p.guest_edits, p.guest_banned, p.guest_decisions, earlier.get("guest_conflicts"), logs, "guest")
    people = cut_lineage(unique_logins(auth.combine(cut_lineage(people), cut_lineage(more))))
    rows = cut_lineage(art.translate_articles(items))
    cache = _cache(earlier.get("byline_cache"), p.byline_cache)
    found = bylines.match_bylines(rows, people, p.byline_edits, cache)
    unknown = found["unknown"]
    if "byline_unknown" in earlier:
        unknown = bylines.merge_unknown(earlier["byline_unknown"], unknown)
    logs |= {"byline_changes": found["changes"], "byline_flagged": found["flagged"], "byline_unknown": unknown}
    if cache is not None:
        logs["byline_cache"] = cache
    rows = art.sanitise_content(bylines.apply_matches(rows, found["matches"]))
    rows = slugs.unique_slugs(rows, (F.col("slug"), F.col("title")), "article")
    rows = cut_lineage(rows)
    logs |= {"content_changes": rows.where("fixes IS NOT NULL").select(F.col("id").alias("article_id"), "fixes"), "shortcodes": art.shortcode_log(rows), "styles": art.style_log(rows), "odd_characters": art.odd_character_log(rows)}
    return Migrated(people, rows, logs)


def _cache(stored: DataFrame | None, new: DataFrame | None) -> DataFrame | None:
    """(name, author_id, display_name) of both; of one name this run's."""
    if stored is None or new is None:
        return new if stored is None else stored
    columns = ["name", "author_id", "display_name"]
    return new.select(columns).unionByName(stored.select(columns).join(new.select("name"), "name", "left_anti"))


def read_state(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """What `write` left in a folder; nothing if there was no earlier run."""
    version = export.current(spark, f"{folder}/state")
    if version is None:
        return {}
    found = {name: export.stored(spark, f"{version}/{name}", schema) for name, schema in STATE.items()}
    return {name: cut_lineage(rows) for name, rows in found.items() if not rows.isEmpty()}


def read(spark: SparkSession, posts: str, guests: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(staff, guests, items) of the two files of an export."""
    return export.authors(spark, posts), export.guests(spark, guests), export.articles(spark, posts)


def write(result: Migrated, folder: str, site: str) -> None:
    """The four dumps, the rows as JSON and the logs, each a file, article buckets of LOG_ROWS rows, and the state for the next run."""
    dumps = {
        "articles": sql.articles_dump(result.articles, site),
        "seo": sql.seo_dump(result.articles),
        "authors": sql.authors_dump(result.authors),
        "articles_authors": sql.articles_authors_dump(result.articles),
    }
    for name, lines in dumps.items():
        files.write_lines(lines, f"{folder}/sql/{name}.sql")
    files.write_positioned(result.authors.select("ord", *FIELDS), "ord", f"{folder}/authors.json")
    files.write_positioned(result.articles, "id", f"{folder}/articles.json")
    files.write_buckets(result.articles, "id", f"{folder}/articles", LOG_ROWS)
    for name, rows in result.logs.items():
        rows.write.mode("overwrite").json(f"{folder}/logs/{name}")
    export.publish(result.authors.sparkSession, f"{folder}/state", {name: result.logs[name] for name in STATE if name in result.logs})


def write_embeddings(result: Migrated, folder: str, encoder: vectors.Encoder, max_chars: int = vectors.MAX_CHARS) -> None:
    rows = cut_lineage(vectors.embed(vectors.embeddable(result.articles, max_chars), encoder))
    files.write_lines(sql.embeddings_dump(rows), f"{folder}/sql/article_embeddings.sql")
