"""Similarity joins of short texts by exact Jaccard on character shingles, and greedy clustering.

The similarity is the Jaccard coefficient of k-character shingles, a text of fewer characters being
its own shingle. Any other can be passed as a `Measure`; pairs to measure then come from MinHash
signatures of the texts' shingles (or other sets), cut into bands.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galley.functions.names import jaccard, shingles
from galley.operators.components import components
from galley.operators.keys import dense_ids
from galley.session import cut_lineage

#: Texts of a list, from which on they are posted with one more shingle, and shingles of a list at most.
HOT, DEEPEST = 50, 3
#: Counters of shingles; those whose hashes share one are counted together.
COUNTERS = 1 << 16
#: Long lists, up to which they are broadcast.
LISTS = 500_000
#: Entries of a list, from which on it goes by bands of sizes, and entries of a band, from which on it is cut into blocks.
SHORT, LIST = 200, 2000
#: Links of a component that one task settles, and nodes of a block of larger ones.
SMALL, BLOCK = 100_000, 2048


@dataclass(frozen=True)
class Measure:
    """A similarity of two texts, the same both ways, and how to find pairs to measure.

    Each of `bands` bands has `rows` minima of hashes of a text's `tokens`; texts that agree in one are measured. Texts
    whose token sets have a Jaccard coefficient of s are measured with a probability of 1 - (1 - s ** rows) ** bands:
    with the numbers here 0.986 at 0.5, 0.9996 at 0.6 and over 0.99999 from 0.68 on.
    """

    similarity: Callable[[Column, Column], Column]
    tokens: Callable[[Column], Column] = shingles
    bands: int = 32
    rows: int = 3


def edit_similarity(a: Column, b: Column) -> Column:
    """One less the share of the longer text's characters that differ; two empty texts are equal."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


#: For names of 9 characters and more: at a similarity of 0.8 and more their shingles mostly agree by half.
EDITS = Measure(edit_similarity)


def signed(texts: DataFrame, measure: Measure) -> DataFrame:
    """Entries as of `posted`, a list for each value of a band."""
    minima = F.transform(F.sequence(F.lit(1), F.lit(measure.bands * measure.rows)), lambda i: F.array_min(F.transform(F.col("o"), lambda t: F.xxhash64(t, i))))
    bands = F.transform(F.sequence(F.lit(0), F.lit(measure.bands - 1)), lambda j: F.xxhash64(j, F.slice(F.col("m"), j * measure.rows + 1, measure.rows)).cast("string"))
    each = texts.withColumn("o", measure.tokens(F.col("key"))).withColumn("m", minima)
    same = {c: F.lit(0) for c in ("at", "low", "high")} | {"size": F.lit(1)}  # no bound by size
    return each.select(F.explode(F.array_distinct(bands)).alias("list"), "key", "l", "r").withColumns(same).select("list", "key", "l", "r", "size", "at", "low", "high")


def _bits(tokens: Column, seed: int) -> Column:
    """64 bits, each the parity of the tokens that fall on it: sets differ in at least as many tokens as in bits."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda s, t: s.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(t, F.lit(seed)), F.lit(64)).cast("int"))))


def posted(texts: DataFrame, least: float, k: int = 3, hot: int = HOT) -> DataFrame:
    """(list, key, l, r, size, at, low, high) of the lists of distinct texts (key, l, r).

    A text's shingles come in the order of their rarity, by counts of COUNTERS classes of their hashes: any order that
    is the same for all texts finds each pair, and a count that is too high only parts a list that need not be. Two sets of a similarity of `least` or more
    share one of the rarest of each, as many as the set may miss and one more (its prefix), and another
    one for each that is taken more. So a shingle that over `hot` texts have is no list of its own: it is posted
    with each one that comes after it in the longer prefix, and a list of several that is as long likewise with one more,
    up to DEEPEST; so lists stay short, however many texts there are. Texts so short that they may share
    no more shingles than a list stands for are under it, too. list: a hash of the shingles; at: the first one's place.
    """
    counter = lambda h: F.pmod(h, F.lit(COUNTERS)).cast("int")
    hashed = F.transform(shingles(F.col("key"), k), lambda t: F.xxhash64(t))
    counts = texts.select(F.explode(hashed).alias("s")).groupBy(counter(F.col("s")).alias("c")).agg(F.count("*").alias("n"))
    counts = texts.sparkSession.range(COUNTERS).select(F.col("id").cast("int").alias("c")).join(counts, "c", "left")
    counts = cut_lineage(counts.agg(F.transform(F.sort_array(F.collect_list(F.struct("c", F.coalesce("n", F.lit(0)).alias("n")))), lambda x: x["n"]).alias("n")))
    ranked = texts.select("key", "l", "r", counts.scalar().alias("n"))  # COUNTERS numbers in all, so no shingle need travel to its count
    ranked = ranked.select("key", "l", "r", F.sort_array(F.transform(hashed, lambda h: F.struct(F.get("n", counter(h)).alias("n"), h.alias("s")))).alias("o"))
    size = F.size("o")
    need = F.ceil(size * F.lit(least) - 1e-9).cast("int")  # shingles that a similar text shares at least
    tokens = F.transform("o", lambda x: x["s"])
    front = F.slice("o", F.lit(1), size - need + DEEPEST)
    prefix = F.transform(front, lambda x: x["s"])
    hot_ = F.size(F.filter(F.slice("o", F.lit(1), size - need + 1), lambda x: x["n"] > hot))  # at the end, as the rarest come first
    ranked = cut_lineage(ranked.select("key", "l", "r", size.alias("size"), need.alias("need"), _bits(tokens, 1).alias("low"), _bits(tokens, 2).alias("high"), prefix.alias("o"), hot_.alias("hots")))
    own = ["key", "l", "r", "size", "low", "high"]
    first = F.slice("o", F.lit(1), F.col("size") - F.col("need") + 1)
    hot_at = F.col("at") > F.col("size") - F.col("need") - F.col("hots")
    rows = ranked.select(*own, "need", "o", "hots", F.posexplode(first).alias("at", "list")).select(*own, "need", "o", "at", F.col("at").alias("last"), "list", hot_at.alias("hot"))
    found, taken = [], 1
    while True:
        found.append(rows.where(~F.col("hot") | (F.col("need") <= taken) | F.lit(taken == DEEPEST)).select("list", "key", "l", "r", "size", "at", "low", "high"))
        if taken == DEEPEST or (long_ := rows.where("hot")).isEmpty():
            break
        taken += 1
        behind = F.slice("o", F.col("last") + 2, F.greatest(F.col("size") - F.col("need") + taken - F.col("last") - 1, F.lit(0)))
        more = long_.select(*own, "need", "o", "at", "last", "list", F.posexplode(behind).alias("i", "s"))
        more = more.select(*own, "need", "o", "at", (F.col("last") + 1 + F.col("i")).alias("last"), F.xxhash64("list", "s").alias("list"))
        if taken < DEEPEST:
            often = cut_lineage(more.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("list", F.lit(True).alias("hot")))
            few = often.count() <= LISTS
            rows = more.join(F.broadcast(often) if few else often, "list", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
            rows = rows if few else cut_lineage(rows)  # entries follow from a text's row alone, unless they were shuffled
        else:
            rows = more.withColumn("hot", F.lit(False))
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out


def meetings(entries: DataFrame, least: float) -> DataFrame:
    """Each two entries (x_..., y_...) of a list whose texts are of like size, the shorter one (or the first of equals) as x.

    Entries of a list of up to SHORT are shuffled once and meet as they are. Longer ones are ordered by size in bands,
    each as wide as sizes may differ; an entry meets those of its band and the next. Lists with over LIST entries of a
    band are cut into blocks, and each two blocks meet on their own. Entries are read several times.
    """
    named = lambda side: [F.col(c).alias(f"{side}_{c}") for c in entries.columns if c != "list"]
    ordered = (F.col("x_size") < F.col("y_size")) | (F.col("x_size") == F.col("y_size")) & (F.col("x_key") < F.col("y_key"))
    alike = F.col("x_size") >= F.col("y_size") * (least - 1e-9)
    often = cut_lineage(entries.groupBy("list").agg(F.count("*").alias("n")).where(F.col("n") > min(SHORT, LIST)).select("list"))
    n = often.count()
    mark = F.broadcast(often) if n <= LISTS else often
    short = (entries.join(mark, "list", "left_anti") if n else entries).repartition("list")
    met = short.select("list", *named("x")).join(short.select("list", *named("y")), "list").where(ordered & alike).drop("list")
    if not n:
        return met
    width = math.log(1 / least) if least < 1 - 1e-9 else 0.0
    band = lambda shift: F.floor(F.log("size") / width + shift).cast("int") if width else F.col("size")
    own = cut_lineage(entries.join(mark, "list", "left_semi").withColumn("band", band(0.0)))
    long_ = cut_lineage(own.groupBy("list", "band").agg(F.count("*").alias("n")).where(F.col("n") > LIST).select("list", "band", F.ceil(F.col("n") / LIST).cast("int").alias("cuts")))
    cuts = F.coalesce("cuts", F.lit(1))
    block = F.pmod(F.xxhash64("key"), cuts).cast("int")
    every = F.explode(F.sequence(F.lit(0), cuts - 1))
    shorter = own.withColumn("band", F.explode(F.array_distinct(F.array(band(-1e-9), band(1 - 1e-9), band(1 + 1e-9))))) if width else own
    x = shorter.join(long_, ["list", "band"], "left").select("list", "band", block.alias("i"), every.alias("j"), *named("x"))
    y = own.join(long_, ["list", "band"], "left").select("list", "band", every.alias("i"), block.alias("j"), *named("y"))
    return met.union(x.join(y, ["list", "band", "i", "j"]).where(ordered & alike).drop("list", "band", "i", "j"))


def candidates(entries: DataFrame, least: float) -> DataFrame:
    """(x, y, forth, back) of the texts that may be similar: left and right in this order, and the other way round."""
    both = F.col("x_size") + F.col("y_size")
    shared = F.ceil(both * F.lit(least / (1 + least)) - 1e-9)  # shingles that a similar pair shares at least
    upto = F.least("x_at", "y_at") + 1 + F.least(F.col("x_size") - F.col("x_at"), F.col("y_size") - F.col("y_at")) - 1  # by the places in both
    apart = F.bit_count(F.col("x_low").bitwiseXOR(F.col("y_low"))) + F.bit_count(F.col("x_high").bitwiseXOR(F.col("y_high")))
    forth, back = F.col("x_l") & F.col("y_r"), F.col("x_r") & F.col("y_l")
    met = meetings(entries, least).where((upto >= shared) & (apart <= 2 * (both - 2 * shared)) & (forth | back))
    return met.select(F.col("x_key").alias("x"), F.col("y_key").alias("y"), forth.alias("forth"), back.alias("back")).distinct()


def similar_pairs(left: DataFrame, right: DataFrame, least: float, k: int = 3, measure: Measure | None = None) -> DataFrame:
    """(a, b, sim) for distinct texts `key` of left and right with a similarity of `least` or more.

    Texts that are in both are compared with themselves, too. Each two texts are compared once, whichever sides they
    are on. Without a measure the result is exact; with one, pairs are found with the probability stated there.
    """
    if not 0 < least <= 1:
        raise ValueError("the least similarity must be over 0 and at most 1")
    if left is right:  # computed once
        both = left.select("key", F.lit(True).alias("l"), F.lit(True).alias("r"))
    else:
        both = left.select("key", F.lit(True).alias("l"), F.lit(False).alias("r")).union(right.select("key", F.lit(False), F.lit(True)))
    texts = cut_lineage(both.where("key IS NOT NULL").groupBy("key").agg(F.max("l").alias("l"), F.max("r").alias("r")))
    if measure is None:
        near = candidates(posted(texts, least, k), least)
        compared = lambda a, b: jaccard(shingles(a, k), shingles(b, k))
    else:
        forth, back = F.col("x_l") & F.col("y_r"), F.col("x_r") & F.col("y_l")
        near = meetings(cut_lineage(signed(texts, measure)), 0.5).where(forth | back).select(F.col("x_key").alias("x"), F.col("y_key").alias("y"), forth.alias("forth"), back.alias("back")).distinct()
        compared = measure.similarity
    near = cut_lineage(near)  # or else each two that meet would be compared, as the filter moves into the join
    near = cut_lineage(near.withColumn("sim", compared(F.col("x"), F.col("y"))).where(F.col("sim") >= least - 1e-12))
    itself = texts.where("l AND r").select(F.col("key").alias("a"), F.col("key").alias("b"), compared(F.col("key"), F.col("key")).cast("double").alias("sim"))
    itself = itself.where(F.col("sim") >= least - 1e-12)
    return itself.union(near.where("forth").select("x", "y", "sim")).union(near.where("back").select("y", "x", "sim"))


def _settling(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hi, anchor) of the nodes that can be settled, for links (kind, grp, hi, lo, any, open) sorted so.

    A row without lo says of the links from outside of the group whether one is an anchor's and one is open.
    """
    group = hi = None
    taken: set[int] = set()  # of the group: nodes that are no anchors
    unsure: set[int] = set()
    hit = doubt = False
    found: list[tuple[int, bool]] = []

    def close() -> None:
        if hi is not None:
            if hit:
                taken.add(hi)
                found.append((hi, False))
            elif doubt:
                unsure.add(hi)
            else:
                found.append((hi, True))

    def batch_of() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.bool_())], names=["hi", "anchor"])
        found.clear()
        return out

    for batch in batches:
        for kind, grp, own, lo, any_, open_ in zip(*(c.to_pylist() for c in batch.columns)):
            if (kind, grp) != group or own != hi:
                close()
                hi, hit, doubt = own, False, False
                if (kind, grp) != group:
                    group, taken, unsure = (kind, grp), set(), set()
            if lo is None:
                hit, doubt = hit or any_, doubt or open_
            elif lo in unsure:
                doubt = True
            elif lo not in taken:
                hit = True
        yield batch_of()
    close()
    yield batch_of()


def star_clusters(nodes: DataFrame, edges: DataFrame, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """(node, anchor) by greedy clustering in the order of nodes.

    nodes: (node), long; edges: (lo, hi) with lo < hi. A node that no earlier anchor is linked with is an
    anchor; any other belongs to the earliest anchor linked with it. Components of up to `small` links
    are settled in their order, each in one task, whatever chains they hold. Larger ones are cut into
    blocks of `block` nodes that follow each other; in a round, each block settles in its order what its
    own nodes and the settled ones outside allow. A chain goes on in a later block, so rounds are as
    many as blocks that a chain of links leads through, not as many as its links.
    """
    edges = cut_lineage(edges.select("lo", "hi").distinct())
    if edges.isEmpty():
        return nodes.select("node", F.col("node").alias("anchor"))
    label = components(edges.toDF("a", "b"))  # of a checkpoint
    links = edges.join(label.select(F.col("id").alias("hi"), "label"), "hi").groupBy("label").agg(F.count("*").alias("n"))
    large = cut_lineage(links.where(F.col("n") > small).select("label"))
    state = label.join(large, "label", "left_anti").select(F.col("id").alias("node"), F.lit(0).alias("kind"), F.col("label").alias("grp"))
    if not large.isEmpty():
        numbered = dense_ids(label.join(large, "label", "left_semi").select("id"), "id", "n")
        state = state.union(numbered.select("id", F.lit(1), F.floor(F.col("n") / block)))
    state = state.join(edges.select(F.col("hi").alias("node"), F.lit(True).alias("later")).distinct(), "node", "left")
    state = cut_lineage(state.select("node", "kind", "grp", F.when(F.col("later").isNull(), True).alias("anchor")))
    while not (open_ := state.where("anchor IS NULL")).isEmpty():
        of_hi = open_.select(F.col("node").alias("hi"), "kind", "grp")
        of_lo = state.select(F.col("node").alias("lo"), F.col("kind").alias("k"), F.col("grp").alias("g"), "anchor")
        each = edges.join(of_hi, "hi").join(of_lo, "lo")
        inside = (F.col("kind") == F.col("k")) & (F.col("grp") == F.col("g")) & F.col("anchor").isNull() | (F.col("kind") == 0)
        known = each.where(~inside).groupBy("kind", "grp", "hi").agg(F.lit(None).cast("long").alias("lo"), F.max(F.coalesce("anchor", F.lit(False))).alias("any"), F.max(F.col("anchor").isNull()).alias("open"))
        own = each.where(inside).select("kind", "grp", "hi", "lo", F.lit(False).alias("any"), F.lit(False).alias("open")).union(known)
        settled = own.repartition("kind", "grp").sortWithinPartitions("kind", "grp", "hi", "lo").mapInArrow(_settling, "hi long, anchor boolean")
        after = state.join(settled.toDF("node", "now"), "node", "left")
        state = cut_lineage(after.select("node", "kind", "grp", F.coalesce("anchor", "now").alias("anchor")))
    anchors = state.where("anchor").select(F.col("node").alias("lo"))
    owner = edges.join(anchors, "lo").groupBy("hi").agg(F.min("lo").alias("owner"))
    out = nodes.join(state.select("node", "anchor"), "node", "left").join(owner, F.col("node") == F.col("hi"), "left")
    return out.select("node", F.when(F.coalesce("anchor", F.lit(True)), F.col("node")).otherwise(F.col("owner")).alias("anchor"))
