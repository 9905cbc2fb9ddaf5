"""Authors: normalisation, order-aware fuzzy resolution, decisions, and the union with guests.

Rows have `ord` (their position, which decides ties and merges), `id`, `display_name`,
`first_name`, `last_name`, `email` and `login`.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions.names import build_display_name, clean_author, clean_authors, holds_several, similarity_key, split_display_name, truthy
from galley.operators.keys import dense_ids, running
from galley.operators.similar import Measure, similar_pairs, star_clusters
from galley.session import cut_lineage

FIELDS = ("id", "display_name", "first_name", "last_name", "email", "login")
MERGE, FLAG = 0.9, 0.8


def edit_rows(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Rows whose display name equals an edit's `match` get its fields, nulls included.

    edits: match, and for each field that may change `set_<field>` (boolean) and `new_<field>`.
    """
    fields = [c.removeprefix("set_") for c in edits.columns if c.startswith("set_")]
    both = rows.join(F.broadcast(edits) if _few(edits) else edits, F.col("display_name") == F.col("match"), "left")
    changed = {f: F.when(F.coalesce(F.col(f"set_{f}"), F.lit(False)), F.col(f"new_{f}")).otherwise(F.col(f)) for f in fields}
    return both.select(*[changed.get(c, F.col(c)).alias(c) for c in rows.columns])


def _few(policy: DataFrame, most: int = 10_000) -> bool:
    return policy.limit(most + 1).count() <= most


def fill_names(display: Column, first: Column, last: Column) -> tuple[Column, Column]:
    """(first, last): both from the display name if one is missing and the display name has a space."""
    f, n = split_display_name(display)
    fill = (first.isNull() | last.isNull()) & (truthy(f).isNotNull() | truthy(n).isNotNull())
    return F.when(fill, f).otherwise(first), F.when(fill, n).otherwise(last)


def normalise(rows: DataFrame, edits: DataFrame | None = None) -> DataFrame:
    """Clean names; rows that hold several people give way to one row for each, behind all others."""
    rows = rows.select("ord", *FIELDS)
    rows = rows.withColumn("display_name", F.coalesce("display_name", build_display_name(F.col("first_name"), F.col("last_name"))))
    if edits is not None:
        rows = edit_rows(rows, edits)
    last = rows.agg(F.max_by("id", "ord").alias("id"), F.max("ord").alias("ord")).first()
    several = holds_several(F.col("display_name"))
    one = rows.where(~several).withColumn("display_name", clean_author(F.col("display_name")))
    first, family = fill_names(F.col("display_name"), F.col("first_name"), F.col("last_name"))
    one = one.withColumns({"first_name": first, "last_name": family})
    pieces = rows.where(several).select("ord", F.posexplode(clean_authors(F.col("display_name"))).alias("at", "piece"))
    first, family = split_display_name(F.col("display_name"))
    null = F.lit(None).cast("string")
    pieces = dense_ids(pieces.withColumn("display_name", clean_author(F.col("piece"))), "ord", "n", 1, ("at",))
    pieces = pieces.select((F.col("n") + (last["ord"] or 0)).alias("ord"), (F.col("n") + (last["id"] or 0)).alias("id"), "display_name", first.alias("first_name"), family.alias("last_name"), null.alias("email"), null.alias("login"))
    return one.unionByName(pieces)


def merge_people(rows: DataFrame, by: str) -> DataFrame:
    """(by, n, the fields) of each group of rows (by, ord, the fields, decided, low), merged in the order of ord.

    low: the least id of the group's rows before, up to the first decided one. A group's row takes in the next
    one after the other: if one of two was decided on (the first, if both) its id and its fields where it
    has them; else the smaller id, the fields of the first where it has them, first and last name from one
    that has both, if any, of two such from the one with the smaller id. All of that follows from aggregates
    that are combined before the shuffle, so a group may have any number of rows:

    * Fields other than names are the first that is there, or else what the last row has.
    * Names are whole from the first row with both, or once both were found apart. From then on a row with
      both takes over if its id is below all before it; of these rows the last one stays.
    * Rows behind the first decided one only fill what is missing.
    """
    first = cut_lineage(rows.where("decided").groupBy(by).agg(F.min("ord").alias("d")))
    each = rows.join(first, by, "left")
    pre, post = F.col("d").isNull() | (F.col("ord") < F.col("d")), F.col("ord") > F.col("d")
    has = {c: truthy(F.col(c)).isNotNull() for c in FIELDS if c != "id"}
    both = has["first_name"] & has["last_name"]
    names = F.struct("first_name", "last_name")
    below = both & ~F.coalesce(F.col("low") <= F.col("id"), F.lit(False))
    at = lambda condition: F.when(condition, F.col("ord"))
    row = F.struct(*FIELDS)
    aggregates = [F.count("*").alias("n"), F.min(F.when(pre, F.col("id"))).alias("least"), F.count_if(post).alias("behind"), F.max_by(row, "ord").alias("last"), F.max_by(row, at(pre)).alias("last_pre"), F.min_by(row, at(F.col("ord") == F.col("d"))).alias("own")]
    for c in has:
        aggregates += [F.min_by(c, at(pre & has[c])).alias(f"{c}_pre"), F.min_by(c, at(post & has[c])).alias(f"{c}_post")]
    aggregates += [F.min(at(pre & has[c])).alias(f"{c}_at") for c in ("first_name", "last_name")]
    aggregates += [F.min(at(pre & both)).alias("both_at"), F.min_by(names, at(pre & both)).alias("both"), F.max(at(pre & below)).alias("below_at"), F.max_by(names, at(pre & below)).alias("below")]
    g = each.groupBy(by).agg(*aggregates)
    apart = F.when(F.col("first_name_at").isNotNull() & F.col("last_name_at").isNotNull(), F.greatest("first_name_at", "last_name_at"))
    whole = F.least("both_at", apart)

    def name(c: str) -> Column:
        plain = F.when(F.col("below_at") > whole, F.col(f"below.{c}")).when(F.col("both_at") == whole, F.col(f"both.{c}")).otherwise(F.col(f"{c}_pre"))
        return F.coalesce(truthy(F.col(f"own.{c}")), plain, F.col(f"{c}_post"))

    def other(c: str) -> Column:
        rest = F.when(F.col("behind") > 0, F.col(f"last.{c}")).otherwise(F.col(f"last_pre.{c}"))
        return F.coalesce(truthy(F.col(f"own.{c}")), F.col(f"{c}_pre"), F.col(f"{c}_post"), rest)

    made = {"id": F.when(F.col("own").isNotNull(), F.col("own.id")).otherwise(F.col("least"))}
    made |= {c: name(c) if c in ("first_name", "last_name") else other(c) for c in has}
    return g.select(by, "n", *[F.when(F.col("n") == 1, F.col(f"last.{c}")).otherwise(made[c]).alias(c) for c in FIELDS])


def resolve(rows: DataFrame, banned: DataFrame | None = None, merge: float = MERGE, flag: float = FLAG, decided: DataFrame | None = None, measure: Measure | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, disputes, changes) after one pass of greedy merging.

    In order, each row that is still there takes in all later rows whose keys are at least `merge`
    alike and flags those from `flag` up. Untouched rows keep their place, merged ones follow, banned
    ones (no display name, or one of `banned`'s) come last. measure: see `similar_pairs`. decided: (id) of rows that were decided on
    and win over those they are merged with. disputes: (left, right) rows; changes: (anchor, ord,
    old_id, then_id, new_id, new_name) of the rows taken in, then_id being the id of the merged row
    when it had just taken that one in.
    """
    rows = rows.select("ord", *FIELDS).withColumn("key", similarity_key(F.col("display_name")))
    keys = banned.select(similarity_key(F.col("display_name")).alias("key")).distinct() if banned is not None else None
    out_of = F.col("display_name").isNull()
    if keys is not None:
        rows = rows.join(F.broadcast(keys.withColumn("hit", F.lit(True))) if _few(keys) else keys.withColumn("hit", F.lit(True)), "key", "left")
        out_of = out_of | F.coalesce("hit", F.lit(False))
    rows = cut_lineage(rows.select("ord", *FIELDS, "key", out_of.alias("banned")))
    open_ = rows.where(~F.col("banned"))
    nodes = open_.groupBy("key").agg(F.min("ord").alias("node"))  # equal keys are one node: they act alike
    pairs = cut_lineage(similar_pairs(nodes, nodes, flag, measure=measure).where("a <> b"))
    at = nodes.select(F.col("key").alias("a"), F.col("node").alias("na")), nodes.select(F.col("key").alias("b"), F.col("node").alias("nb"))
    pairs = pairs.join(at[0], "a").join(at[1], "b").where("na < nb")
    placed = nodes.join(star_clusters(nodes, pairs.where(F.col("sim") >= merge - 1e-12).select(F.col("na").alias("lo"), F.col("nb").alias("hi"))), "node")
    members = cut_lineage(open_.join(placed.select("key", "anchor"), "key"))
    person = F.struct(*FIELDS)
    if decided is not None:
        members = members.join(decided.select("id").distinct().withColumn("won", F.lit(True)), "id", "left")
    members = members.select("ord", "key", "anchor", *FIELDS, (F.coalesce("won", F.lit(False)) if decided is not None else F.lit(False)).alias("decided"))
    own = F.when(F.col("decided"), F.struct("ord", "id"))
    members = cut_lineage(running(members, "anchor", [F.col("ord")], {"low": ("min", F.col("id")), "first": ("min", own)}, before=True))
    people = cut_lineage(merge_people(members.select("anchor", "ord", *FIELDS, "decided", "low"), "anchor"))
    merged = people.where("n > 1").select(F.lit(1).alias("grp"), F.col("anchor").alias("ord"), *FIELDS)
    alone = people.where("n = 1").select(F.lit(0).alias("grp"), F.col("anchor").alias("ord"), *FIELDS)
    tail = rows.where("banned").select(F.lit(2).alias("grp"), "ord", *FIELDS)
    result = dense_ids(alone.union(merged).union(tail).withColumnRenamed("ord", "place"), "grp", "ord", 0, ("place",)).select("ord", *FIELDS)

    # Flags: the left one is an anchor's own row, the right one not yet taken in by an earlier anchor.
    anchors = placed.where("node = anchor").select(F.col("node").alias("na"))
    flagged = pairs.where(F.col("sim") < merge - 1e-12).select("na", F.col("b").alias("key")).union(pairs.where(F.col("sim") < merge - 1e-12).select("nb", F.col("a").alias("key")))
    flagged = flagged.join(anchors, "na").join(members.select("key", "anchor", F.col("ord").alias("right_ord"), person.alias("right")), "key")
    flagged = flagged.where((F.col("right_ord") > F.col("na")) & (F.col("anchor") >= F.col("na")))
    left = members.select(F.col("ord").alias("na"), person.alias("left"))
    disputes = flagged.join(left, "na").select(F.col("na").alias("left_ord"), "right_ord", "left", "right")
    then = F.coalesce(F.col("first.id"), F.when(F.col("decided"), F.col("id")), F.least("low", "id"))
    changes = members.withColumn("then_id", then).where("ord <> anchor").select("ord", F.col("id").alias("old_id"), "then_id", "anchor")
    changes = changes.join(merged.select(F.col("ord").alias("anchor"), F.col("id").alias("new_id"), F.col("display_name").alias("new_name")), "anchor")
    changes = changes.select("anchor", "ord", "old_id", "then_id", "new_id", "new_name")
    return result, disputes, changes


def logged(changes: DataFrame) -> DataFrame:
    """(ord, old_id, new_id) for `change_chains`, of the changes of both runs in the order in which they happened."""
    placed = dense_ids(changes, "run", "at", 0, ("anchor", "ord"))
    return placed.select(F.col("at").alias("ord"), "old_id", F.col("then_id").alias("new_id"))


def _chosen(disputes: DataFrame, decisions: DataFrame) -> DataFrame:
    """(left_ord, right_ord, row): the canonical rows of the disputes that are decided."""
    sides = disputes.select("left_ord", "right_ord", F.explode(F.array("left.id", "right.id")).alias("first_id"))
    rows = decisions.select("ord", "first_id", F.struct(*FIELDS).alias("row"))
    return sides.join(rows, "first_id").groupBy("left_ord", "right_ord").agg(F.min_by("row", "ord").alias("row"))


def conflicts(disputes: DataFrame, decisions: DataFrame) -> DataFrame:
    """(ord, conflict): each side of a decided dispute with its canonical row, as a later run finds decisions."""
    both = _chosen(disputes, decisions).join(disputes, ["left_ord", "right_ord"])
    sides = both.select("left_ord", "right_ord", F.posexplode(F.array("left", "right")).alias("at", "first"), "row")
    placed = dense_ids(sides.withColumn("o", F.col("left_ord").cast("long")), "o", "n", 0, ("right_ord", "at"))
    return placed.select(F.col("n").alias("ord"), F.struct(F.col("first"), F.col("row").alias("canonical")).alias("conflict"))


def stored_decisions(conflicts: DataFrame) -> DataFrame:
    """The decisions that stored conflicts stand for."""
    return conflicts.select("ord", F.col("conflict.first.id").alias("first_id"), "conflict.canonical.*").withColumn("stored", F.lit(True))


def settle(rows: DataFrame, disputes: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, open disputes) after decisions.

    decisions: `ord`, `first_id` and the fields of the canonical row, and `stored` (true for those of
    an earlier run) if some are. A dispute takes the first
    decision whose first_id is one of its two ids; both rows go, the canonical row is appended.
    A dispute without a decision changes nothing and is returned.
    """
    chosen = _chosen(disputes, decisions)
    gone = chosen.join(disputes, ["left_ord", "right_ord"]).select(F.explode(F.array("left", "right")).alias("r")).distinct()
    same = [F.col(f).eqNullSafe(F.col(f"r.{f}")) for f in FIELDS]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    kept = rows.join(gone, condition, "left_anti").select("ord", *FIELDS)
    last = rows.agg(F.coalesce(F.max("ord"), F.lit(0))).first()[0]
    added = dense_ids(chosen.select(F.col("left_ord").cast("long").alias("o"), "right_ord", "row"), "o", "n", last + 1, ("right_ord",)).select(F.col("n").alias("ord"), "row.*")
    return kept.unionByName(added.select("ord", *FIELDS)), disputes.join(chosen.select("left_ord", "right_ord"), ["left_ord", "right_ord"], "left_anti")


def combine(authors: DataFrame, guests: DataFrame) -> DataFrame:
    """Authors, then those guests whose display name is new, with the next free ids; first guests win."""
    authors, guests = authors.select("ord", *FIELDS), guests.select("ord", *FIELDS)
    first = guests.groupBy("display_name").agg(F.min_by(F.struct("ord", *FIELDS), "ord").alias("g")).select("g.*")
    new = first.join(authors.select(F.col("display_name").alias("n")), F.col("display_name").eqNullSafe(F.col("n")), "left_anti")
    start, last = authors.agg(F.coalesce(F.max("id") + 1, F.lit(0)), F.coalesce(F.max("ord") + 1, F.lit(0))).first()
    new = dense_ids(new.drop("id"), "ord", "id", start)
    return authors.unionByName(new.select((F.col("id") - start + last).alias("ord"), *FIELDS))


def prune_banned(guests: DataFrame, authors: DataFrame, banned: DataFrame) -> DataFrame:
    """Guests without those of a banned name that an author has too."""
    key = similarity_key(F.col("display_name")).alias("key")
    known = authors.where("display_name IS NOT NULL").select(key).join(banned.select(key), "key", "left_semi").distinct()
    return guests.withColumn("key", key).join(known, "key", "left_anti").drop("key")


def sanitise(rows: DataFrame, edits: DataFrame | None = None, banned: DataFrame | None = None, decisions: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame | None]:
    """(rows, open disputes, changes, conflicts): normalise, resolve, settle, resolve again."""
    rows = cut_lineage(normalise(rows, edits))
    rows, disputes, changes = resolve(rows, banned)
    rows, disputes, settled = cut_lineage(rows), cut_lineage(disputes), None
    if decisions is not None:
        settled = cut_lineage(conflicts(disputes, decisions))
        rows, disputes = settle(rows, disputes, decisions)
        rows = cut_lineage(rows)
    decided = None
    if decisions is not None:  # those of an earlier run do not win
        decided = decisions.where(~F.coalesce("stored", F.lit(False))) if "stored" in decisions.columns else decisions
    rows, _, more = resolve(rows, banned, decided=decided)
    return rows, disputes, changes.withColumn("run", F.lit(1)).unionByName(more.withColumn("run", F.lit(2))), settled


def _matched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(ord, begin): what each departure of (id, start, ord, step, begin), sorted so, goes on with: of the open ends the one
    that began first. A stretch is followed until an arrival of which the begin is not known yet."""
    stretch, ends, known = None, [], True
    for batch in batches:
        found = []
        for id_, start, at, step, begin in zip(*(c.to_pylist() for c in batch.columns)):
            if (id_, start) != stretch:
                stretch, ends, known = (id_, start), [], True
            if known and step > 0:
                known = begin is not None
                if known:
                    heapq.heappush(ends, begin)
            elif known:
                found.append((at, heapq.heappop(ends)))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["ord", "begin"])


def change_chains(changes: DataFrame) -> DataFrame:
    """(ord, first_id, chain): ids that became each other one after another, in the order of their beginnings.

    changes: (ord, old_id, new_id), ords and ids being integers, ords unique. In order, a change goes to the
    end of the chain that ends in its old id, of several such to the one that began first; without such
    a chain it begins one. Changes of an id into itself do nothing.

    A change arrives at its new id and departs from its old one. How many ends are open at an id follows
    from counts alone, whichever goes on: running sums of arrivals and departures, less their minimum.
    So it is known which departures begin a chain. Where no second end is open from one time to the
    next at which there is none (a stretch), the departure goes on from the arrival before it; these links
    are followed by pointer doubling, in as many rounds as the logarithm of the longest run of them.
    Stretches with several open ends are contested: there the k-th departure need not follow the
    k-th arrival. They are settled in order, each as far as the beginnings of its arrivals are known,
    in as many rounds as contested stretches depend on each other in a row. Only contested stretches
    are taken whole by a task, which streams them.
    """
    edges = cut_lineage(changes.where("old_id <> new_id").select(F.col("ord").cast("long").alias("ord"), F.col("old_id").cast("long").alias("old_id"), F.col("new_id").cast("long").alias("new_id")))
    if edges.isEmpty():
        return edges.select("ord", F.col("old_id").alias("first_id"), F.array("old_id", "new_id").alias("chain"))
    events = edges.select(F.col("old_id").alias("id"), "ord", F.lit(-1).cast("long").alias("step")).union(edges.select("new_id", "ord", F.lit(1).cast("long")))
    summed = running(events, "id", [F.col("ord")], {"s": ("sum", F.col("step"))})
    low = running(summed, "id", [F.col("ord")], {"low": ("min", F.col("s"))}, before=True)
    low = low.withColumn("before", F.col("s") - F.col("step") - F.least(F.lit(0), F.coalesce("low", F.lit(0)))).select("id", "ord", "step", "before")
    start = F.when((F.col("step") > 0) & (F.col("before") == 0), F.col("ord"))
    placed = cut_lineage(running(low, "id", [F.col("ord")], {"start": ("max", start)}))
    goes_on = placed.where("step > 0 OR before > 0")
    contested = goes_on.groupBy("id", "start").agg(F.max("before").alias("most"), F.count("*").alias("n")).where("n > 2 OR most > 1").select("id", "start")
    contested = cut_lineage(contested)
    # (ord, prev): a departure's arrival before it, itself where it begins a chain or is contested
    forced = goes_on.where("step < 0").join(contested, ["id", "start"], "left_anti").select("ord", F.col("start").alias("prev"))
    links = cut_lineage(edges.select("ord").join(forced, "ord", "left").select("ord", F.coalesce("prev", "ord").alias("prev")))
    while True:
        further = links.join(links.select(F.col("ord").alias("prev"), F.col("prev").alias("next")), "prev")
        further = cut_lineage(further.select("ord", F.col("next").alias("prev"), (F.col("next") != F.col("prev")).alias("moved")))
        links = further.select("ord", "prev")
        if further.where("moved").isEmpty():
            break
    rows = goes_on.join(contested, ["id", "start"], "left_semi").join(links.withColumnRenamed("prev", "root"), "ord")
    rows = cut_lineage(rows.select("id", "start", "ord", "step", "root"))
    begins = cut_lineage(links.where("ord = prev").join(rows.where("step < 0").select("ord"), "ord", "left_anti").select("ord", F.col("ord").alias("begin")))
    waiting = rows.where("step < 0").count()
    while waiting:
        each = rows.join(begins.select(F.col("ord").alias("root"), "begin"), "root", "left").select("id", "start", "ord", "step", "begin")
        found = each.repartition("id", "start").sortWithinPartitions("id", "start", "ord").mapInArrow(_matched, "ord long, begin long")
        begins = cut_lineage(begins.join(rows.where("step < 0").select("ord"), "ord", "left_anti").union(found))
        now = rows.where("step < 0").join(begins, "ord", "left_anti").count()
        if now == waiting:
            raise ValueError("changes need unique ords")
        waiting = now
    state = edges.join(links, "ord").join(begins.select(F.col("ord").alias("prev"), "begin"), "prev")
    chain = F.array_sort(F.collect_list(F.struct("ord", "old_id", "new_id")))  # a chain
    chains = state.groupBy("begin").agg(chain.alias("l"))
    first = F.get("l", F.lit(0))["old_id"]
    return chains.select(F.col("begin").alias("ord"), first.alias("first_id"), F.concat(F.array(first), F.transform("l", lambda x: x["new_id"])).alias("chain"))
