"""MinHash near-duplicates by an inverted join on signature coordinates.

Documents whose sets of word shingles have 100 * intersection >= `percent` * union are linked;
connected documents form a component. The steps:

1. Every text becomes its set of distinct shingle hashes (64 bits), a digest of the set and a
   signature of K coordinates, the minimum of the set under K hash functions. Documents with one
   digest are a class; its smallest doc_id represents it, whatever the number of copies.
2. Class representatives are posted under each (coordinate, value). Lists with one entry can join
   nothing. A linked pair agrees in at least MATCHES coordinates (or is lost with a probability
   below 5e-6 at a similarity of 0.8, and less above), so by the prefix principle it shares one
   of the K - MATCHES + 1 rarest coordinates of each; only these stay posted.
3. Lists are merged without expanding them into pairs: in each list all entries are paired with
   one, the most central (its coordinates are in the longest lists, as an original's among its
   edited copies). Collisions of a pair are counted over all K coordinates; pairs with enough of
   them are confirmed on the full sets.
4. What the links connect needs no more test. In lists that still hold entries of different
   components, every entry is described by its difference from the list's central one, a set of s
   shingles: the set R of r shingles that it lacks and the set N of n that it has beyond. With the
   weight w = 100 r + percent n and the gap g = w - (100 - percent) s, an entry is linked with the
   central one if g <= 0, and two entries a and y are linked, by the definition, if
   (100 + percent) (|N_a & N_y| + |R_a & R_y|) >= w_a + g_y. Let y be an entry with g_y > 0. As they
   lack no more in common than a lacks, either (A) they share new shingles, at least
   g_y / (100 + percent) of them if n_a >= r_a, or (B) g_y <= percent (r_a - n_a), that is a mostly
   lacks. Pairs of the first kind are posted under new shingles, in which independent edits of a
   text do not meet; those of the second kind under all that they lack and have, which only few
   entries near the limit are. In both an entry is posted under its rarest features only, as many
   as the formulas demand.
5. A list of features is not expanded either: its entries are paired with a few of them (PIVOTS,
   eight times as many in each further round), pairs whose features cannot agree enough by the
   parities of their bits go, links are confirmed by the formula above, components
   are joined if many were found, entries that have been pivots go, lists within one component are
   done. Nothing is capped: the rounds end when no list is left.

What is hot is spread: a key with over a thousandth of the rows of a join is salted (`spread`),
and pairs carry ids, never texts; sets of shingles are joined to them by id.

Defined cases: null, empty or wordless text: empty set, linked with nothing. Fewer words than the
width: the whole sequence is the one shingle. Repeated rows and rows that share a doc_id are one
document. Rows without doc_id are linked with nothing, component_id null, kept true. An empty
table gives an empty result. Very long texts are hashed block by block, whole. Words are runs of
bytes other than 0x20 and 0x09-0x0D, A-Z in lower case. The key must be an integer column. Other
columns are not returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm import hashing
from galley.llm.columns import integral
from galley.llm.components import components
from galley.session import cut_lineage, free_unused

K, MATCHES = 64, 36
#: Ids by a broadcast of which rows are looked up; above, by a shuffle join.
BROADCAST_IDS = 300_000
#: Entries of a list that the others are paired with in the first round.
PIVOTS = 32
#: Words of 64 bits in which the parities of a text's features are kept.
WORDS = 8
#: Rows of a key, at least, that are spread over several tasks, and the share of all rows.
HOT_ROWS, HOT_SHARE = 4096, 1000

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _stream(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


_A, _B = (_stream(1 << 20, K) | np.uint64(1))[:, None], _stream(1 << 21, K)[:, None]
_PLACES = _stream(1 << 22, 64) | np.uint64(1)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a sequence of word hashes."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = max(1, len(words) - width + 1)
    total = np.full(n, min(len(words), width), np.uint64)
    for i in range(min(width, len(words))):
        total += words[i : i + n] * _PLACES[i % 64]
    total = np.sort(_mix(total))
    return total[np.append(True, total[1:] != total[:-1])]


def signature(own: np.ndarray) -> np.ndarray:
    """K minima, each mixed and cut to 32 bits."""
    low = np.full(K, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(own), 2048):
        each = _A * own[i : i + 2048]
        each += _B
        low = np.minimum(low, each.min(axis=1))
    return _mix(low).astype(np.uint32).view(np.int32)


def _lists(arrays: list[np.ndarray], kind: type) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, kind), *arrays])))


def _signed(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, high, low, sigs = [], [], [], []
            for words in hashing.of_texts(batch.column(1), lower=True):
                own = shingles(words, width)
                n.append(len(own))
                digest = xxhash.xxh3_128_intdigest(own.tobytes())
                high.append((digest >> 64) - (1 << 63))
                low.append((digest & ((1 << 64) - 1)) - (1 << 63))
                sigs.append(signature(own) if len(own) else np.zeros(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), _lists(sigs, np.int32)], names=["id", "n_shingles", "high", "low", "sig"])

    return run


def _named(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows whose id is in `pairs` (a, b)."""
    ids = cut_lineage(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _sets(rows: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(id, s): the sets of the documents in `pairs`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(words, width).view(np.int64) for words in hashing.of_texts(batch.column(1), lower=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(found, np.int64)], names=["id", "s"])

    return cut_lineage(_named(rows, pairs).mapInArrow(run, "id long, s array<long>"))


def spread(big: DataFrame, small: DataFrame, on: str, by: Column, rows: DataFrame) -> DataFrame:
    """`big` joined with `small`, in which a value of `on` has few rows; `by` deals the rows of a hot value out.

    rows: `on` of the rows of big, best a checkpoint, or with their counts n already. Hot are values with over
    HOT_ROWS rows and a share of over one in HOT_SHARE; so there are at most HOT_SHARE of them, which are broadcast,
    and `small` repeats their rows HOT_SHARE times more in all at most.
    """
    counts = rows if "n" in rows.columns else rows.groupBy(on).agg(F.count("*").alias("n"))
    top = counts.where(F.col("n") > HOT_ROWS).orderBy(F.desc("n")).limit(HOT_SHARE).collect()  # HOT_SHARE rows
    least = max(HOT_ROWS, counts.agg(F.sum("n")).first()[0] // HOT_SHARE) if top else 0
    found = [(r[on], -(-r["n"] // least)) for r in top if r["n"] > least]
    if not found:
        return big.join(small, on)
    hot = F.broadcast(big.sparkSession.createDataFrame(found, f"{on} long, _salts int"))  # HOT_SHARE rows
    dealt = big.join(hot, on, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    copied = small.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return dealt.join(copied, [on, "_salt"]).drop("_salt")


def _both(pairs: DataFrame, of: DataFrame, name: str) -> DataFrame:
    """pairs: (a, b, ...), a checkpoint, with column `name` of `of` (id, name) for both, as name + a and name + b."""
    own = pairs.join(of.toDF("b", f"{name}b"), "b")
    return spread(own, of.toDF("a", f"{name}a"), "a", F.col("b"), pairs.select("a"))


def _links(rows: DataFrame, classes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs with enough collisions whose full sets are similar enough."""
    both = _both(pairs, classes.select("id", F.struct("sig", "n").alias("c")), "c")
    alike = 100 * F.least("ca.n", "cb.n") >= percent * F.greatest("ca.n", "cb.n")
    equal = F.aggregate(F.zip_with("ca.sig", "cb.sig", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    near = cut_lineage(both.where(alike).where(equal >= MATCHES).select("a", "b"))
    both = _both(near, _sets(rows, near, width), "s").withColumn("i", F.size(F.array_intersect("sa", "sb")))
    return cut_lineage(both.where(100 * F.col("i") >= percent * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b"))


def _differences(rows: DataFrame, open_: DataFrame, width: int) -> DataFrame:
    """(o, lo, id, label, s, new, lacked): the difference of each entry of an open list from the list's central one.

    open_: (o, lo, id, label), the entries of open lists with the lists' central entries and both components.
    """
    pairs = cut_lineage(open_.where("id <> o").select(F.col("o").alias("a"), "lo", F.col("id").alias("b"), "label"))
    both = _both(pairs, _sets(rows, pairs, width), "s")
    out = both.select(F.col("a").alias("o"), "lo", F.col("b").alias("id"), "label", F.size("sa").cast("long").alias("s"), F.array_except("sb", "sa").alias("new"), F.array_except("sa", "sb").alias("lacked"))
    return cut_lineage(out)


def _rare(delta: DataFrame, features: str) -> DataFrame:
    """(o, id, l): the features that several entries of a list have, by their number of entries, rarest first."""
    posts = delta.select("o", "id", F.explode(features).alias("feature"))
    shared = posts.groupBy("o", "feature").agg(F.count("*").alias("c")).where("c > 1")
    return posts.join(shared, ["o", "feature"]).groupBy("o", "id").agg(F.sort_array(F.collect_list(F.struct("c", "feature"))).alias("l"))  # a text's features


def _posted(delta: DataFrame, percent: int) -> DataFrame:
    """(list, o, id, label, y, q, x, d): entries as one with a gap (y) and as its partner (x); they may be linked if q <= d."""
    share = 100 + percent
    facts = delta.drop("new", "lacked", "f")
    short = F.greatest(F.lit(1), F.ceil(F.col("g") / share))  # features that one with a gap shares with its partner

    own = _rare(delta, "new").join(facts, ["o", "id"]).withColumn("rare", F.size("l") - short)
    own = own.select("o", "id", "label", "g", "more", "rare", F.posexplode("l").alias("at", "e"))
    deep = (F.col("at") > F.col("rare")).cast("long")
    a = own.select(F.xxhash64("o", "e.feature").alias("list"), "o", "id", "label", (F.col("g") > 0).alias("y"), deep.alias("q"), F.lit(True).alias("x"), (F.col("more") > 0).cast("long").alias("d"))

    of_list = delta.groupBy("o").agg(F.min(F.when(F.col("g") > 0, F.col("g"))).alias("least"), F.max("more").alias("most"))
    some = delta.join(of_list, "o").withColumns({"as_y": (F.col("g") > 0) & (F.col("g") <= percent * F.col("most")), "as_x": (F.col("more") > 0) & (percent * F.col("more") >= F.col("least"))}).where("as_x OR as_y")
    some = cut_lineage(some)
    own = _rare(some, "f").join(some.drop("new", "lacked", "f"), ["o", "id"])
    own = own.withColumns({"rare_y": F.size("l") - short, "rare_x": F.size("l") - F.floor(F.col("w") / share) - 1})
    own = own.select("o", "id", "label", "g", "more", "as_x", "as_y", "rare_x", "rare_y", F.posexplode("l").alias("at", "e"))
    b = own.select(F.xxhash64("o", "e.feature", F.lit("B")).alias("list"), "o", "id", "label", (F.col("as_y") & (F.col("at") <= F.col("rare_y"))).alias("y"), F.col("g").alias("q"), (F.col("as_x") & (F.col("at") <= F.col("rare_x"))).alias("x"), (percent * F.col("more")).alias("d"))
    return a.union(b).where("x OR y")


def _open(posted: DataFrame) -> DataFrame:
    """The entries of lists in which a pair of different components is left."""
    lists = posted.groupBy("list").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min(F.when(F.col("y"), F.col("q"))).alias("q"), F.max(F.when(F.col("x"), F.col("d"))).alias("d"), F.count("*").alias("size"))
    lists = lists.where("low < high AND q <= d").select("list", "size")
    return cut_lineage(posted.join(lists, "list"))


def _parities(features: Column) -> Column:
    """WORDS * 64 bits, each the parity of the features that fall on it: sets differ in at least as many features as in bits."""
    one = F.lit(1).cast("long")
    bit = lambda x: F.call_function("shiftleft", one, F.pmod(F.shiftright(x, 8), F.lit(64)).cast("int"))
    word = lambda w: F.aggregate(F.filter(features, lambda x: F.pmod(x, F.lit(WORDS)) == w), F.lit(0).cast("long"), lambda s, x: s.bitwiseXOR(bit(x)))
    return F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word)


def _shared_at_most() -> Column:
    """Of two texts with features (n, bits) in ca and cb."""
    apart = F.aggregate(F.zip_with("ca.bits", "cb.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return F.least("ca.n", "cb.n", F.floor((F.col("ca.n") + F.col("cb.n") - apart) / 2))


def _across(delta: DataFrame, percent: int) -> DataFrame:
    """(a, b): links between different components of open lists, enough of them to join all that are linked."""
    weight = 100 * F.size("lacked").cast("long") + percent * F.size("new")
    other = F.transform("lacked", lambda x: F.bitwise_not(x))  # what is lacked is another feature than what is new
    delta = delta.withColumns({"w": weight, "g": weight - (100 - percent) * F.col("s"), "more": (F.size("lacked") - F.size("new")).cast("long"), "f": F.concat("new", other)}).drop("s")
    found = delta.where("g <= 0 AND label <> lo").select(F.col("o").alias("a"), F.col("id").alias("b"))
    delta = cut_lineage(delta.withColumn("bits", _parities(F.col("f"))))
    facts, pivots = delta.select(F.xxhash64("o", "id").alias("id"), F.struct("w", "g", "f").alias("c")), PIVOTS
    light = delta.select(F.xxhash64("o", "id").alias("id"), F.struct("w", "g", F.size("f").alias("n"), "bits").alias("c"))
    delta = delta.drop("bits")
    posted = _open(_posted(delta, percent))
    while not posted.isEmpty():
        free_unused(delta.sparkSession)
        slot = F.when(F.col("size") <= 2 * pivots, F.col("id")).otherwise(F.pmod(F.xxhash64("id", F.lit(pivots)), F.lit(pivots)))  # of a short list all
        best = posted.groupBy("list", slot).agg(F.max(F.struct("y", "x", "id", "label", "q", "d")).alias("p"))
        of_list = cut_lineage(best.groupBy("list").agg(F.collect_list("p").alias("ps")))  # 2 * pivots at most
        met = spread(posted, of_list, "list", F.col("id"), posted.select("list")).withColumn("p", F.explode("ps"))
        roles = (F.col("p.y") & F.col("x") & (F.col("p.q") <= F.col("d"))) | (F.col("p.x") & F.col("y") & (F.col("q") <= F.col("p.d")))
        met = met.where(roles & (F.col("p.label") != F.col("label")))
        tests = met.groupBy(F.col("p.id").alias("pivot"), "id").agg(F.min("o").alias("o"))  # a pair once, whatever lists it meets in
        tests = cut_lineage(tests.select("pivot", "id", F.xxhash64("o", "pivot").alias("a"), F.xxhash64("o", "id").alias("b")))
        n_tests = tests.count()
        close = _both(tests, _named(light, tests), "c").where((100 + percent) * _shared_at_most() >= F.col("ca.w") + F.col("cb.g"))
        tests = cut_lineage(close.select("pivot", "id", "a", "b"))  # features travel only with pairs that may be linked
        shared = F.size(F.array_intersect("ca.f", "cb.f"))
        new = _both(tests, _named(facts, tests), "c").where((100 + percent) * shared >= F.col("ca.w") + F.col("cb.g"))
        new = cut_lineage(new.select(F.col("pivot").alias("a"), F.col("id").alias("b")))
        rest = posted.join(of_list.select("list", F.explode("ps.id").alias("id")), ["list", "id"], "left_anti")
        found, n = found.union(new), new.count()
        if 10 * n >= n_tests:  # lists fall apart into few components; else it is not worth while
            joined = posted.select("id", "label").distinct()
            joined = new.join(joined.toDF("a", "la"), "a").join(joined.toDF("b", "lb"), "b").select(F.col("la").alias("a"), F.col("lb").alias("b"))
            to = components(joined).select(F.col("id").alias("label"), F.col("label").alias("to"))
            rest = rest.join(to, "label", "left").withColumn("label", F.coalesce("to", "label")).drop("to")
        posted, pivots = _open(rest.select(*posted.columns).drop("size")), 8 * pivots
    return found


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row."""
    integral(docs, key)
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    signed = cut_lineage(rows.mapInArrow(_signed(width), "id long, n_shingles long, high long, low long, sig array<int>"))
    some = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = cut_lineage(some.groupBy("high", "low").agg(F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n")))

    coordinate = F.shiftleft(F.col("at").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))
    posted = classes.select("id", F.posexplode("sig").alias("at", "value")).select("id", coordinate.alias("key"))
    shared = cut_lineage(posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    own = spread(posted, shared, "key", F.col("id"), shared)
    own = own.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("l"), F.sum("n").alias("central"))  # K entries at most
    prefix = F.slice("l", F.lit(1), F.greatest(F.lit(0), F.size("l") - MATCHES + 1))  # K - size(l) rarer ones stand alone
    entries = cut_lineage(own.select("id", "central", F.explode(prefix).alias("e")).select("id", "central", "e.key"))

    centre = entries.groupBy("key").agg(F.max(F.struct("central", -F.col("id"))).alias("c"), F.count("*").alias("n")).where("n > 1")
    centre = cut_lineage(centre.select("key", (-F.col("c.col2")).alias("a"), "n"))
    star = spread(entries, centre.drop("n"), "key", F.col("id"), centre.select("key", "n"))
    star = cut_lineage(star.where("id <> a").select("a", F.col("id").alias("b")).distinct())
    links = _links(rows, classes, star, width, percent)

    free_unused(docs.sparkSession)
    label = components(links)
    placed = cut_lineage(entries.join(label, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label")))
    mixed = placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("key")
    central = centre.join(mixed, "key").select("key", F.col("a").alias("o"), "n")
    central = central.join(label.toDF("o", "lo"), "o", "left").withColumn("lo", F.coalesce("lo", "o"))
    open_ = cut_lineage(spread(placed, central.drop("n"), "key", F.col("id"), central.select("key", "n")).select("o", "lo", "id", "label").distinct())
    twice = some.groupBy("id").agg(F.min(F.struct("high", "low")).alias("x"), F.max(F.struct("high", "low")).alias("y")).where("x <> y").select("id")  # one document, several texts
    more = some.join(twice, "id", "left_semi").join(classes.select("high", "low", F.col("id").alias("b")), ["high", "low"]).select(F.col("id").alias("a"), "b")
    if not open_.isEmpty():
        free_unused(docs.sparkSession)
        more = more.union(_across(_differences(rows, open_, width), percent))
    more = cut_lineage(more.where("a <> b"))
    if not more.isEmpty():
        label = components(label.toDF("a", "b").union(more))

    of_class = classes.select("high", "low", "id").join(label, "id", "left").select("high", "low", F.coalesce("label", "id").alias("component"))
    out = signed.select("id", "n_shingles", "high", "low").join(of_class, ["high", "low"], "left")
    component = F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.col("component")).otherwise(F.col("id"))
    out = out.select(F.col("id").alias(key), "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, width=4, percent=80)
