"""Unique slugs.

Rows come in the order of their ids (null last). Each gets the first slug of its list that no
earlier row has: its base, base-id, base-1, base-2 and so on. Slugs of a base are the base and
base-<number>, so rows meet only if their bases agree without trailing numbers (their root). Roots
in which no base repeats keep their bases, roots with one base get ids behind it; both are plain
expressions. In the other roots rows bid in rounds: each row bids for one slug of its list, the
earliest bidder of a slug holds it, the others go on to a later one. That ends in the same slugs,
as no row ever passes one that it could have had. Rows that neither their base nor base-id was left
to are given numbers together, by ranks and counts over ranges of rows and of numbers (`_free_numbers`):
however many rows or numbers a base has, no task has all of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.columns import fresh
from galley.functions.names import slug
from galley.operators.keys import running, sorted_parts
from galley.session import cut_lineage

_PLACE = ["none", "id", "tie", "row"]
_NUMBERED = "^(.*)-(0|[1-9][0-9]{0,17})$"


def _skipping(entered: dict[int, int], rows_out: bool):
    """For (part, base, number, bound) of a range, sorted: a number is skipped if fewer than `bound` before it were.

    entered: how many of its first base were skipped before a range. Gives (base, at) of the skipped numbers, at being
    the number less those skipped before it; or else (part, first, last): how many of the range's first base are skipped
    here, and how many of its last base up to its end, null if that is the first.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = base = first = None
        skipped = begun = 0
        for batch in batches:
            found = []
            for p, of, number, bound in zip(*(c.to_pylist() for c in batch.columns)):
                if of != base or p != part:
                    if p == part:
                        first = skipped - begun if first is None else first
                        skipped = begun = 0
                    else:
                        skipped = begun = entered.get(p, 0)
                    part, base = p, of
                if skipped < bound:
                    found.append((of, number - skipped))
                    skipped += 1
            if rows_out:
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.int64())], names=["base", "at"])
        if not rows_out and part is not None:
            ends = [part], [skipped - begun if first is None else first], [None if first is None else skipped]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(ends, (pa.int32(), pa.int64(), pa.int64()))], names=["part", "first", "last"])

    return run


def _skipped(held: DataFrame) -> DataFrame:
    """(base, at) of the skipped ones of (base, number, bound), see `_skipping`.

    A base may lie in many ranges. How many it skips in one depends on how many it skipped before; ranges are
    gone through at the same time, with what the last pass gave for those before, until nothing changes.
    That is two passes where the numbers before make no difference, as many as ranges at worst.
    """
    rows = sorted_parts(held, F.col("base"), F.col("number"))
    ends = rows.groupBy("part").agg(F.min_by("base", "local").alias("a"), F.max_by("base", "local").alias("z"), F.count("*").alias("n")).collect()  # ranges
    ends.sort(key=lambda r: r["part"])
    goes_on = {r["part"] for q, r in zip(ends, ends[1:]) if q["z"] == r["a"]}
    ranges, entered = rows.select("part", "base", "number", "bound"), dict.fromkeys(goes_on, 0)
    while goes_on:
        of = {r["part"]: r for r in ranges.mapInArrow(_skipping(entered, False), "part int, first long, last long").collect()}  # ranges
        now, end = {}, 0
        for r in ends:
            found = of[r["part"]]
            if r["part"] in goes_on:
                now[r["part"]] = end
            end = now.get(r["part"], 0) + found["first"] if found["last"] is None else found["last"]
        if now == entered:
            break
        entered = now
    return ranges.mapInArrow(_skipping(entered, True), "base string, at long")


def _free_numbers(late: DataFrame, held: DataFrame) -> DataFrame:
    """(row, number) of rows (row, base, place) without a slug: in the order of places, each the least number from 1
    that no earlier row of its base has. held: (base, number, place) of rows that have one, each number once.

    As rows come and numbers go up together, one pass over the numbers serves them: a held number is skipped if the row
    that is next was later than its holder. With c rows before the holder, that is number k is skipped if
    fewer than k - c were skipped before it; and the i-th row gets i and the skipped numbers before that.
    """
    both = late.select("base", "place.*", F.lit(1).cast("long").alias("is_late"), F.lit(None).cast("long").alias("number"))
    both = both.union(held.where("number > 0").select("base", "place.*", F.lit(0).cast("long"), "number"))
    ranked = cut_lineage(running(both, "base", [F.col(c) for c in _PLACE], {"c": ("sum", F.col("is_late"))}))
    skipped = _skipped(ranked.where("is_late = 0").select("base", "number", (F.col("number") - F.col("c")).alias("bound")))
    each = ranked.where("is_late = 1").select("base", F.col("c").alias("at"), "row").union(skipped.select("base", "at", F.lit(None).cast("long")))
    before = running(each, "base", [F.col("at"), F.col("row").asc_nulls_first()], {"n": ("sum", F.col("row").isNull().cast("long"))})
    return before.where("row IS NOT NULL").select("row", (F.col("at") + F.col("n")).alias("number"))


def _bids(rows: DataFrame) -> DataFrame:
    """(row, slug) of rows (row, base, id, place). place: (no id, id, tie, row), by which rows come in order."""
    own = F.coalesce(F.col("id").cast("string"), F.lit("None"))
    state = cut_lineage(rows.select("row", "base", "id", "place", F.lit(0).alias("n"), F.col("base").alias("slug")))
    while True:
        holders = state.groupBy("slug").agg(F.min("place").alias("holder"), F.count("*").alias("bidders")).where("bidders > 1")
        judged = state.join(holders, "slug", "left").withColumn("lost", F.coalesce(F.col("place") != F.col("holder"), F.lit(False)))
        judged = cut_lineage(judged.select("row", "base", "id", "place", F.least(F.lit(2), F.col("n") + F.col("lost").cast("int")).alias("n"), "slug", "lost"))
        if judged.where("lost").isEmpty():
            return judged.select("row", "slug")
        late = judged.where("n = 2")
        if late.isEmpty():
            state = judged.select("row", "base", "id", "place", "n", F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat("base", F.lit("-"), own)).alias("slug"))
            continue
        held = judged.where("NOT lost").withColumns({"of": F.regexp_extract("slug", _NUMBERED, 1), "number": F.regexp_extract("slug", _NUMBERED, 2)})
        held = held.where("number <> '' AND NOT (n = 2 AND base = of)").join(late.select(F.col("base").alias("of")).distinct(), "of", "left_semi")
        given = cut_lineage(_free_numbers(late.select("row", "base", "place"), held.select(F.col("of").alias("base"), F.col("number").cast("long").alias("number"), "place")))
        late = late.join(given, "row").withColumn("slug", F.concat("base", F.lit("-"), F.col("number").cast("string")))
        early = judged.where("n < 2").withColumn("slug", F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat("base", F.lit("-"), own)))
        columns = ["row", "base", "id", "place", "n", "slug"]
        state = cut_lineage(early.select(columns).union(late.select(columns)))


def unique_slugs(df: DataFrame, sources: tuple[Column, ...], fallback: str, key: str = "id", name: str = "slug", tie: str | None = None) -> DataFrame:
    """`df` with a unique slug in `name`, made of the first of `sources` that leaves one.

    key: a long id, unique where it is not null; `tie` orders rows of one id.
    """
    columns = [c for c in df.columns if c != name]
    base_, id_, tie_, root, first, rounds_, plain_, row_, slug_ = fresh(df.columns, "base", "id", "tie", "root", "first", "rounds", "plain", "row", "slug")
    base = F.coalesce(*[F.nullif(slug(s), F.lit("")) for s in sources], F.concat(F.lit(f"{fallback}-"), F.coalesce(F.col(key).cast("string"), F.lit("None"))))
    rows = df.withColumns({base_: base, id_: F.col(key).cast("long"), tie_: F.col(tie).cast("long") if tie else F.lit(0).cast("long")})
    rows = rows.withColumn(root, F.regexp_replace(base_, "(-[0-9]+)+$", ""))
    by_base = rows.groupBy(root, base_).agg(F.count("*").alias("n"), F.min(id_).alias("low"), (F.count("*") - F.count_distinct(id_)).alias("odd"))
    by_root = by_base.groupBy(root).agg(F.max("n").alias("most"), F.count("*").alias("bases"), F.min("low").alias(first), F.max("odd").alias("odd"))
    rounds = (F.col("most") > 1) & ((F.col("bases") > 1) | (F.col("odd") > 0))
    by_root = cut_lineage(by_root.select(root, first, rounds.alias(rounds_), (F.col("most") == 1).alias(plain_)))  # apart, so that a hot root's rows can be split
    rows = rows.join(by_root, root)
    plain = F.when(F.col(plain_) | (F.col(id_) == F.col(first)), F.col(base_)).otherwise(F.concat(base_, F.lit("-"), F.col(id_).cast("string")))
    easy = rows.where(~F.col(rounds_)).select(*columns, plain.alias(name))
    hard = cut_lineage(rows.where(F.col(rounds_)).withColumn(row_, F.monotonically_increasing_id()))
    if hard.isEmpty():
        return easy
    place = F.struct(F.col(id_).isNull().alias("none"), F.coalesce(id_, F.lit(0)).alias("id"), F.coalesce(tie_, F.lit(0)).alias("tie"), F.col(row_).alias("row"))
    found = _bids(hard.select(F.col(row_).alias("row"), F.col(base_).alias("base"), F.col(id_).alias("id"), place.alias("place")))
    return easy.union(hard.join(found.toDF(row_, slug_), row_).select(*columns, F.col(slug_).alias(name)))
