"""Mixing sources to target weights: min-cost flow over membership patterns, then seeded selection.

Documents may belong to several sources. Documents with the same set of sources form a pattern;
patterns and sources are the nodes of a small transport problem: every pattern can give its
words up to `max_repeats` times, each further time at a higher (convex) cost, to any of its
sources, and every source takes its target. The flow of least cost says how many words each
pattern gives. A pattern's whole rounds take all its documents; of the last, partial round a
seeded hash of doc_id selects documents: histograms of words by hash prefix, refined three times
by ten bits, locate the hash up to which documents are taken, without a sort or a collected group.
Where the document that crosses the line is long beside what is missing, selection goes on behind
it among the documents that still fit, SWEEPS times at most.

Sizes are numbers of words (runs of characters other than space and U+0009 to U+000D). Sources
in the order of code points, null last, weigh 5, 2, 1, 5, 2, 1, ... and share all words; a target
stops at `max_repeats` times its source's size, and the excess is shared by weight among the rest
until none is above.

Defined cases: null text: size 0, never taken more than 0 words; null source: a source of its
own; null or empty membership: in no source, so never taken, with a size and target of source of 0,
though its words count among all; null doc_id: selected by the hash of the text alone. Repeated rows
with one doc_id and text have one hash and are taken together, and so are others of equal hash. An
empty table gives an empty result. Texts are counted whole, however long. Extra columns are kept,
whatever their names; size, source_size, target, copies and taken replace columns of these names.
Only the pattern table (one row for each set of sources that occurs) comes to the driver, where
the flow is run over all of them, part by part of the network; more than MAX_PATTERNS patterns
raise an error.
"""

from __future__ import annotations

import math
from collections import deque
from itertools import cycle

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from galley.llm.columns import fresh
from galley.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Sets of sources in a corpus; more of them mean that `sources` is not a label of sources.
MAX_PATTERNS = 100_000
LEVELS, BITS = 3, 10
#: Selections one after the other, and the missing share of a target at which they end.
SWEEPS, NEAR = 4, 0.002


def n_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", -1), lambda w: w != "")).cast("long")


def by_code_point(sources: set[str | None]) -> list[str | None]:
    return sorted(sources, key=lambda s: (s is None, s or ""))


def targets(sizes: dict[str | None, int], total: int, weights: tuple[float, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> dict[str | None, float]:
    """Words to take of each source."""
    weight = dict(zip(by_code_point(set(sizes)), cycle(weights)))
    out: dict[str | None, float] = {}
    free = set(weight)
    while free:
        left, whole = total - sum(out.values()), sum(weight[s] for s in free)
        share = {s: left * weight[s] / whole for s in free}
        above = {s for s in free if share[s] > repeats * sizes[s]}
        if not above:
            return out | share
        out |= {s: float(repeats * sizes[s]) for s in above}
        free -= above
    return out


def min_cost_flow(supply: list[tuple[int, list[int]]], demand: list[float], repeats: int = MAX_REPEATS) -> list[dict[int, float]]:
    """Words that each pattern gives to each of its sources.

    supply: (size, sources) of each pattern; demand: of each source. Successive shortest paths:
    node 0 is the origin, then patterns, then sources, then the sink. The k-th round of a pattern
    costs k * k for each word, so rounds fill in order.
    """
    p, s = len(supply), len(demand)
    sink = p + s + 1
    to: list[int] = []
    room: list[float] = []
    cost: list[float] = []
    leaving: list[list[int]] = [[] for _ in range(sink + 1)]

    def arc(a: int, b: int, capacity: float, price: float) -> None:
        for x, y, c, w in ((a, b, capacity, price), (b, a, 0.0, -price)):
            leaving[x].append(len(to))
            to.append(y)
            room.append(c)
            cost.append(w)

    given: list[dict[int, int]] = []
    for i, (size, sources) in enumerate(supply):
        for k in range(repeats):
            arc(0, 1 + i, float(size), float(k * k))
        given.append({})
        for j in sources:
            given[-1][j] = len(to)
            arc(1 + i, 1 + p + j, math.inf, 0.0)
    for j, wanted in enumerate(demand):
        arc(1 + p + j, sink, float(wanted), 0.0)
    while True:
        best, via = [math.inf] * (sink + 1), [-1] * (sink + 1)
        best[0], queue, queued = 0.0, deque([0]), {0}
        while queue:  # Bellman-Ford by a queue: residual arcs may have negative cost
            x = queue.popleft()
            queued.discard(x)
            for e in leaving[x]:
                if room[e] > 1e-6 and best[x] + cost[e] < best[to[e]] - 1e-12:
                    best[to[e]], via[to[e]] = best[x] + cost[e], e
                    if to[e] not in queued:
                        queue.append(to[e])
                        queued.add(to[e])
        if best[sink] == math.inf:
            return [{j: room[e ^ 1] for j, e in own.items()} for own in given]
        path, x = [], sink
        while x:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push


def transport(supply: list[tuple[int, list]], demand: dict, repeats: int = MAX_REPEATS) -> list[dict]:
    """`min_cost_flow` by names of sources, in each part of the network on its own.

    Parts have no arcs between them, so their flows add up to the flow of the whole. A source whose
    documents are in no other is a part of one pattern, whose paths have three arcs each.
    """
    parent: dict = {s: s for s in demand}

    def top(s):
        while parent[s] != s:
            parent[s] = s = parent[parent[s]]
        return s

    for _, sources in supply:
        for s in sources[1:]:
            parent[top(s)] = top(sources[0])
    parts: dict = {}
    for i, (_, sources) in enumerate(supply):
        if sources:
            parts.setdefault(top(sources[0]), []).append(i)
    out: list[dict] = [{} for _ in supply]
    for own in parts.values():
        names = by_code_point({s for i in own for s in supply[i][1]})
        at = {s: j for j, s in enumerate(names)}
        flow = min_cost_flow([(supply[i][0], [at[s] for s in supply[i][1]]) for i in own], [demand[s] for s in names], repeats)
        for i, given in zip(own, flow):
            out[i] = {names[j]: words for j, words in given.items()}
    return out


_SWEEP = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType()), T.StructField("most", T.DoubleType())])


def _rank(seed: int, *of: Column) -> Column:
    """LEVELS * BITS bits of a seeded hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *of), 64 - LEVELS * BITS)


def _cut(sized: DataFrame, wanted: dict[int, float], begin: dict[int, int]) -> dict[int, tuple[int, float, int]]:
    """For each pattern (cut, missing, crossing): from rank `begin` up to `cut` documents of at most `wanted` words
    are taken, so that their words do not exceed it; what is then missing, and the words at the next rank, 0 if none."""
    spark = sized.sparkSession
    at = {i: (begin[i], wanted[i], 0) for i in wanted}
    open_ = set(wanted)
    for level in range(LEVELS):
        low = (LEVELS - 1 - level) * BITS
        if not open_:
            break
        frame = spark.createDataFrame([(i, begin[i], at[i][0], wanted[i], at[i][1]) for i in open_], "pattern int, begin long, cut long, most double, want double")
        rows = sized.join(F.broadcast(frame), "pattern").where((F.col("rank") >= F.col("begin")) & (F.col("size") <= F.col("most")))  # MAX_PATTERNS rows
        if level:
            rows = rows.where(F.shiftright("rank", low + BITS) == F.shiftright("cut", low + BITS))
        bins = rows.groupBy("pattern", "want", F.shiftright("rank", low).alias("bin")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("pattern").orderBy("bin"))  # at most 2 ** BITS rows each
        over = F.col("upto") > F.col("want")
        bins = bins.withColumn("upto", upto).groupBy("pattern").agg(F.min(F.when(over, F.struct("bin", "upto", "words"))).alias("b"), F.max("upto").alias("all"))
        for r in bins.collect():  # a row for each pattern
            i = r["pattern"]
            if r["b"] is None:  # all of the range fits
                at[i] = ((((at[i][0] >> (low + BITS)) + 1) << (low + BITS)) if level else 1 << (LEVELS * BITS), at[i][1] - r["all"], 0)
                open_.discard(i)
            else:
                at[i] = (r["b"]["bin"] << low, at[i][1] - (r["b"]["upto"] - r["b"]["words"]), r["b"]["words"])
        open_ &= {i for i in open_ if at[i][2]}
    return at


def _sweeps(sized: DataFrame, wanted: dict[int, float]) -> dict[int, list[tuple[int, int, float]]]:
    """For each pattern (from rank, up to rank, words of a document at most) of the documents to take."""
    out: dict[int, list[tuple[int, int, float]]] = {i: [] for i in wanted}
    left, begin = dict(wanted), dict.fromkeys(wanted, 0)
    for sweep in range(SWEEPS):
        found = _cut(sized, left, begin) if left else {}
        for i, (cut, missing, crossing) in found.items():
            if sweep == SWEEPS - 1 and 0 < crossing < 2 * missing:
                cut, missing = cut + 1, 0.0  # nearer with the document that crosses the line
            out[i].append((begin[i], cut, left[i]))
            left[i], begin[i] = missing, cut
            if missing <= NEAR * wanted[i] or cut >= 1 << (LEVELS * BITS):
                del left[i]
    return out


def mix(docs: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", weights: tuple[float, ...] = WEIGHTS, repeats: int = MAX_REPEATS, seed: int = 7) -> DataFrame:
    """`docs` with size, copies, taken, and the size and target of the first of its sources.

    sources: an array of source names. copies: how often the mix takes the document.
    """
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    names = fresh([*docs.columns, "size", "source_size", "target", "copies", "taken"], "sources", "pattern", "words", "rank", "whole", "cut")
    of, pattern, words, rank, whole_of, cut_of = names
    member = F.array_sort(F.array_distinct(F.coalesce(sources.cast("array<string>"), F.array().cast("array<string>"))))
    sized = docs.withColumns({of: member, words: n_words(F.col(text)), rank: _rank(seed, F.col(key), F.when(F.col(key).isNull(), F.col(text)))})
    sized = sized.withColumn(pattern, F.to_json(of, {"ignoreNullFields": "false"})).select(*own, *names[:4])
    slim = cut_lineage(sized.select(F.col(pattern).alias("p"), F.col(of).alias("s"), F.col(words).alias("size"), F.col(rank).alias("rank")))
    rows = slim.groupBy("p").agg(F.first("s").alias("s"), F.sum("size").alias("n")).limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"over {MAX_PATTERNS} sets of sources")
    rows.sort(key=lambda r: r["p"])
    sizes: dict[str | None, int] = dict.fromkeys(by_code_point({s for r in rows for s in r["s"]}), 0)
    for r in rows:
        for s in r["s"]:
            sizes[s] += r["n"]
    want = targets(sizes, sum(r["n"] for r in rows), weights, repeats)
    flow = transport([(r["n"], r["s"]) for r in rows], want, repeats)
    whole, part = {}, {}
    for i, (r, given) in enumerate(zip(rows, flow)):
        wanted = sum(given.values())
        whole[i] = min(repeats, int((wanted + 1e-6) // r["n"])) if r["n"] else 0
        if whole[i] < repeats and wanted - whole[i] * r["n"] > 0.5:
            part[i] = wanted - whole[i] * r["n"]
    keys = spark.createDataFrame([(r["p"], i) for i, r in enumerate(rows)], "p string, pattern int")
    cut = _sweeps(slim.join(F.broadcast(keys), "p").select("pattern", "size", "rank"), part)
    plan = spark.createDataFrame(
        [(r["p"], whole[i], cut.get(i, []), sizes[r["s"][0]] if r["s"] else 0, float(want[r["s"][0]]) if r["s"] else 0.0) for i, r in enumerate(rows)],
        T.StructType([T.StructField(pattern, T.StringType()), T.StructField(whole_of, T.IntegerType()), T.StructField(cut_of, T.ArrayType(_SWEEP)), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())]),
    )
    out = sized.join(F.broadcast(plan), pattern, "left")  # MAX_PATTERNS rows
    taken = F.exists(cut_of, lambda c: (F.col(rank) >= c["begin"]) & (F.col(rank) < c["end"]) & (F.col(words) <= c["most"]))
    copies = F.col(whole_of) + taken.cast("int")
    return out.select(*own, F.col(words).alias("size"), "source_size", "target", copies.alias("copies"), (copies * F.col(words)).alias("taken"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs, F.array("source")).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")
