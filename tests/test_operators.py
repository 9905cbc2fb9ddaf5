import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from galley import queries
from galley.operators import articles, authors, bylines, components, keys, similar, slugs, vectors

ROW = "ord long, id long, display_name string, first_name string, last_name string, email string, login string"


def people(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ROW)


def jaccard(a, b):
    x, y = ({s[i : i + 3] for i in range(max(1, len(s) - 2))} for s in (a, b))
    return len(x & y) / len(x | y)


def test_dense_ids_do_not_depend_on_partitions(spark):
    rows = [(o,) for o in random.Random(1).sample(range(1000), 300)]
    for parts in (1, 7):
        got = keys.dense_ids(spark.createDataFrame(rows, "o long").repartition(parts), "o").orderBy("id").collect()
        assert [r.id for r in got] == list(range(300)) and [r.o for r in got] == sorted(o for (o,) in rows)


def test_dense_ids_of_nothing(spark):
    assert keys.dense_ids(spark.createDataFrame([], "o long"), "o").collect() == []
    assert keys.next_id(spark.createDataFrame([], "id long")) == 0


def walk(rows):
    used, out = set(), {}
    for own, base in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        found, n = base, 0
        if found in used:
            found = f"{base}-{own}"
            while found in used:
                n += 1
                found = f"{base}-{n}"
        used.add(found)
        out[own] = found
    return out


def test_slugs_match_the_ordered_walk(spark):
    rnd = random.Random(3)
    for _ in range(3):
        ids = rnd.sample(range(1, 40), 30)
        rows = [(i, rnd.choice(["a", "a-2", "b", "b-3", "a-2-1", "c", "article-4", "", "d-1", "d-1-7"])) for i in ids]
        want = walk([(i, b or f"article-{i}") for i, b in rows])
        got = slugs.unique_slugs(spark.createDataFrame(rows, "id long, title string"), (F.col("title"),), "article").collect()
        assert {r.id: r.slug for r in got} == want and len(set(want.values())) == len(got)


def test_slugs_of_rows_without_id(spark):
    rows = spark.createDataFrame([(1, "A", 0), (None, "a", 1), (None, None, 2)], "id long, title string, o long")
    got = slugs.unique_slugs(rows, (F.col("title"),), "author", tie="o").orderBy("o").collect()
    assert [r.slug for r in got] == ["a", "a-None", "author-None"]


def test_many_rows_with_one_base_and_no_id(spark):
    """Their list has no slug of their own: base, base-None, base-1 and so on, some of them taken by others."""
    rows = [(None, "n", i) for i in range(300)] + [(1, "n-7", 0), (2, "n", 0), (3, "n-3", 0), (4, "n-None", 0)]
    got = slugs.unique_slugs(spark.createDataFrame(rows, "id long, title string, o long").repartition(3), (F.col("title"),), "author", tie="o").collect()
    later = [r.slug for r in sorted(got, key=lambda r: r.o) if r.id is None]
    assert {r.id: r.slug for r in got if r.id} == {1: "n-7", 2: "n", 3: "n-3", 4: "n-none"}
    assert later == ["n-None", *(f"n-{k}" for k in range(1, 302) if k not in (3, 7))]


def test_similar_pairs_are_exact(spark):
    rnd = random.Random(5)
    texts = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))) for _ in range(60)})
    df = spark.createDataFrame([(t,) for t in texts], "key string")
    for least in (0.6, 0.8, 0.9):
        got = {(r.a, r.b) for r in similar.similar_pairs(df, df, least).collect()}
        assert got == {(a, b) for a in texts for b in texts if jaccard(a, b) >= least - 1e-12}


def test_star_clusters_match_the_greedy_order(spark):
    rnd = random.Random(7)
    for _ in range(4):
        edges = [(a, b) for a, b in itertools.combinations(range(14), 2) if rnd.random() < 0.2]
        anchor = {}
        for i in range(14):
            if i not in anchor:
                anchor[i] = i
                anchor |= {b: i for a, b in edges if a == i and b not in anchor}
        got = similar.star_clusters(spark.range(14).toDF("node"), spark.createDataFrame(edges or [(0, 0)], "lo long, hi long").where("lo < hi")).collect()
        assert {r.node: r.anchor for r in got} == anchor


def merge(a, b):
    full = [bool(x["first_name"]) and bool(x["last_name"]) for x in (a, b)]
    out = {k: a[k] or b[k] for k in ("email", "display_name", "login")} | {"id": min(a["id"], b["id"])}
    if any(full):
        source = a if full[0] and (not full[1] or a["id"] <= b["id"]) else b
        return out | {k: source[k] for k in ("first_name", "last_name")}
    return out | {k: a[k] or b[k] or None for k in ("first_name", "last_name")}


def brute_resolve(rows, banned):
    key = lambda r: "".join(c for c in r["display_name"] if c.isalpha()).lower()
    tail = [r for r in rows if r["display_name"] is None or key(r) in banned]
    left = [r for r in rows if not (r["display_name"] is None or key(r) in banned)]
    names, keep, merged, flags = [key(r) for r in left], [True] * len(left), [], set()
    for i, row in enumerate(left):
        if not keep[i]:
            continue
        whole, some = row, False
        for j in range(i + 1, len(left)):
            if keep[j]:
                sim = jaccard(names[i], names[j])
                if sim >= 0.9:
                    whole, some, keep[j] = merge(whole, left[j]), True, False
                elif sim >= 0.8:
                    flags.add((row["ord"], left[j]["ord"]))
        if some:
            keep[i] = False
            merged.append(whole)
    return [r for r, k in zip(left, keep) if k] + merged + tail, flags


def test_resolve_matches_the_sequential_pass(spark):
    rnd = random.Random(11)
    bases = ["".join(rnd.choice("abcdefghij") for _ in range(14)) for _ in range(5)]
    rows = []
    for o in range(45):
        base = rnd.choice(bases)
        name = base + rnd.choice(["", "", "k", "km", "kmn", "x"]) if rnd.random() > 0.1 else rnd.choice([None, "Banned One"])
        pick = lambda *x: rnd.choice(x)
        rows.append((rnd.randint(0, 999), name, pick(None, "", "F1", "F2"), pick(None, "L1", "L2"), pick(None, "e"), pick("", "l")))
    df = people(spark, *rows)
    own = [r.asDict() for r in df.collect()]
    want, flags = brute_resolve(own, {"bannedone"})
    got, disputes, _ = authors.resolve(df.repartition(5), spark.createDataFrame([("banned one!",)], "display_name string"))
    assert [tuple(r)[1:] for r in got.orderBy("ord").collect()] == [tuple(w[k] for k in authors.FIELDS) for w in want]
    assert {(r.left_ord, r.right_ord) for r in disputes.collect()} == flags


def test_normalise(spark):
    df = people(
        spark,
        (5, None, "ann", "bee", "e", "l"),
        (9, "X and y.zed", None, None, None, None),
        (2, "Op Desk", None, "kept?", None, "o"),
        (7, "Solo", None, None, None, None),
        (8, None, None, None, None, None),
    )
    edits = spark.createDataFrame([("Op Desk", True, None)], "match string, set_last_name boolean, new_last_name string")
    got = authors.normalise(df, edits).orderBy("ord").collect()
    assert [tuple(r)[1:5] for r in got] == [
        (5, "Ann Bee", "ann", "bee"),
        (2, "Op Desk", "Op", "Desk"),
        (7, "Solo", None, None),
        (8, None, None, None),
        (9, "X", None, None),
        (10, "Y Zed", "Y", "Zed"),
    ]


def test_settle_and_combine(spark):
    df = people(spark, (1, "a", None, None, None, None), (2, "b", None, None, None, None), (3, "c", None, None, None, None))
    person = F.struct(*authors.FIELDS)
    left = df.where("ord = 0").select(F.col("ord").alias("left_ord"), person.alias("left"))
    right = df.where("ord = 1").select(F.col("ord").alias("right_ord"), person.alias("right"))
    disputes = left.join(right)
    decisions = spark.createDataFrame([(1, 2, 50, "B"), (0, 1, 60, "A")], "ord long, first_id long, id long, display_name string").select("*", *[F.lit(None).cast("string").alias(c) for c in authors.FIELDS[2:]])
    rows, open_ = authors.settle(df, disputes, decisions)
    assert [(r.id, r.display_name) for r in rows.orderBy("ord").collect()] == [(3, "c"), (60, "A")] and open_.count() == 0
    assert authors.settle(df, disputes, decisions.limit(0))[0].count() == 3
    both = authors.combine(df, people(spark, (0, "b", None, None, None, None), (0, "z", None, None, "1", None), (0, "z", None, None, "2", None), (0, None, None, None, None, None)))
    assert [(r.id, r.display_name, r.email) for r in both.orderBy("ord").collect()][3:] == [(4, "z", "1"), (5, None, None)]


def log(edges):
    """The log written change by change."""
    chains = []
    for old, new in edges:
        own = next((c for c in chains if c[-1] == old), None)
        if own is not None:
            own += [new] if own[-1] != new else []
        elif old != new:
            chains.append([old, new])
    return chains


@pytest.mark.parametrize("edges", [[(1, 2), (7, 8), (2, 3), (5, 5)], [(1, 2), (2, 3), (2, 4)], [(1, 2), (5, 2), (2, 3)], [(1, 2), (2, 1), (1, 2), (3, 2), (2, 9), (2, 8), (9, 2), (2, 7)], []])
def test_change_chains(spark, edges):
    df = spark.createDataFrame([(i, *e) for i, e in enumerate(edges)], "ord long, old_id long, new_id long")
    assert [r.chain for r in authors.change_chains(df).orderBy("ord").collect()] == log(edges)


def test_change_chains_match_the_log(spark):
    rnd = random.Random(0)
    edges = [(rnd.randint(0, 14), rnd.randint(0, 14)) for _ in range(40)]
    df = spark.createDataFrame([(i, *e) for i, e in enumerate(edges)], "ord long, old_id long, new_id long").repartition(3)
    assert [r.chain for r in authors.change_chains(df).orderBy("ord").collect()] == log(edges)


def test_a_decided_row_wins_when_it_is_merged_again(spark):
    """A dispute is settled; its canonical row is like a third one, whose id is smaller."""
    df = people(spark, (30, "annabelle beesworth", "F0", "L0", "e0", None), (40, "annabelle beesworthyq", None, None, None, "l1"), (10, "annabelle beeswortha", "F2", "L2", "e2", "l2"))
    decision = [(0, 30, 40, "annabelle beeswortha", None, "Chosen", None, None)]
    decisions = spark.createDataFrame(decision, "ord long, first_id long, id long, display_name string, first_name string, last_name string, email string, login string")
    person = F.struct(*authors.FIELDS)
    side = lambda o, n: df.where(F.col("ord") == o).select(F.col("ord").alias(f"{n}_ord"), person.alias(n))
    rows, _ = authors.settle(df, side(0, "left").join(side(1, "right")), decisions)
    got, _, changes = authors.resolve(rows, decided=decisions.select("id"))
    assert [tuple(r)[1:] for r in got.collect()] == [(40, "annabelle beeswortha", "F2", "Chosen", "e2", "l2")]
    assert [(r.old_id, r.then_id, r.new_id) for r in changes.collect()] == [(40, 40, 40)]
    plain, _, changes = authors.resolve(rows)
    assert [(r.id, r.first_name, r.last_name) for r in plain.collect()] == [(10, "F2", "L2")]
    assert [(r.old_id, r.then_id) for r in changes.collect()] == [(40, 10)]


def test_match_bylines(spark):
    staff = people(spark, (4, "Ann Bee", None, None, None, "abe"), (2, "Anna Beeson Longname", None, None, None, "x"), (3, "ann bee", None, None, None, None))
    rows = spark.createDataFrame([(1, ["annbee", "abe", "annabeesonlongnames", "zzz", ""]), (2, ["the board", "annabeesonlongna"]), (3, None)], "id long, names array<string>")
    edits = spark.createDataFrame([("The Board", 0, "Anna Beeson Longname"), ("The Board", 1, "ANN BEE"), ("The Board", 2, "Nobody")], "match string, at int, target string")
    found = bylines.match_bylines(rows, staff, edits)
    got = {r.id: (r.author_ids, r.authors) for r in bylines.apply_matches(rows, found["matches"]).collect()}
    assert got == {1: ([3, 4, 2], ["ann bee", "Ann Bee", "Anna Beeson Longname"]), 2: ([2, 3], ["Anna Beeson Longname", "ann bee"]), 3: ([], [])}
    assert [(r.name, r.article_ids) for r in found["unknown"].collect()] == [("zzz", [1])]
    flagged = found["flagged"].collect()
    assert [(r.article_id, r.name) for r in flagged] == [(2, "annabeesonlongna")]
    cache = spark.createDataFrame([("annabeesonlongna", 77, "Chosen")], "name string, author_id long, display_name string")
    again = bylines.match_bylines(rows, staff, edits, cache)
    assert again["flagged"].count() == 0 and again["matches"].where("by = 'cached'").first()["author_id"] == 77


def test_terms(spark):
    kind = "id int, terms array<struct<domain:string,nicename:string,text:string>>, text string"
    rows = [(1, [("post_tag", "x", "b&amp;c"), ("post_tag", "y", None), ("category", "z", "q"), ("author", "a", None), ("author", "a", "J. R-x_y")], "t"), (2, [("category", "comics", "c")], "t"), (3, [], "None"), (4, [("post_tag", None, "k")], "None")]
    got = {r.id: r.t for r in spark.createDataFrame(rows, kind).select("id", articles.terms(F.col("terms"), F.col("text")).alias("t")).collect()}
    assert (got[1].tags, got[1].categories, got[1].authors, got[1].names) == (["b&c"], ["q"], ["None", "J. R-x_y"], ["none", "jrxy"])
    assert [got[i].skip for i in (1, 2, 3, 4)] == [False, True, False, True]


def test_nearest(spark):
    rnd = random.Random(2)
    rows = [(i, [float(rnd.randint(0, 3)) for _ in range(3)]) for i in range(40)] + [(99, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = vectors.nearest(df, df.where("vec_id < 3"), 4).collect()
    for q in range(3):
        want = sorted((sum((x - y) ** 2 for x, y in zip(v, rows[q][1])) ** 0.5, i) for i, v in rows[:-1] if i != q)[:4]
        assert [(pytest.approx(r.distance), r.vec_id) for r in sorted(got, key=lambda r: r.rank) if r.query_id == q] == want
    with pytest.raises(ValueError):
        vectors.nearest(df, df, 1, most_queries=5)


def test_nearest_in_blocks(spark):
    rnd = random.Random(3)
    rows = [(i, [float(rnd.randint(0, 3)) for _ in range(3)]) for i in range(40)] + [(99, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = sorted((q, n + 1, i, round(d, 9)) for q, w in rows[:-1] for n, (d, i) in enumerate(sorted((sum((x - y) ** 2 for x, y in zip(v, w)) ** 0.5, i) for i, v in rows[:-1] if i != q)[:4]))
    for block in (7, 2_000):
        got = vectors.pruned_nearest(df, df, 4, block=block)[0].collect()
        assert sorted((r.query_id, r.rank, r.vec_id, round(r.distance, 9)) for r in got) == want
    assert vectors.pruned_nearest(df, df.where("vec_id < 0"), 4)[0].collect() == []


def test_the_nearest_query_takes_over_2000_queries(spark, tmp_path):
    spark.range(41_000).selectExpr("id AS vec_id", "array(CAST(id AS float)) AS embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["k4_nearest"](spark, str(tmp_path)).where("rank = 1").collect()
    assert sorted((r.query_id, r.vec_id) for r in got) == [(q, q - 1 if q else 1) for q in range(0, 41_000, 20)]


def test_prune_banned(spark):
    guests = people(spark, (1, "Desk", None, None, None, None), (2, "Ann", None, None, None, None), (3, None, None, None, None, None))
    got = authors.prune_banned(guests, people(spark, (9, "the desk", None, None, None, None), (8, "desk!", None, None, None, None)), spark.createDataFrame([("DESK",), ("Ann",)], "display_name string"))
    assert sorted(r.id for r in got.collect()) == [2, 3]


def test_dense_ids_of_sparse_and_equal_orders(spark):
    """One row for each 100,000 values, many rows of one value, nulls first; columns may have any name."""
    rows = [(100_000 * i * (-1) ** i, i, 1, 2) for i in range(300)] + [(77, i, 1, 2) for i in range(300, 900)] + [(None, 5, 1, 2)]
    df = spark.createDataFrame(rows, "o long, then long, part int, local int").repartition(3)
    got = keys.dense_ids(df, "o", "n", 10, ("then",)).orderBy("n").collect()
    assert [r.n for r in got] == list(range(10, 911)) and got[0].asDict().keys() == {"n", "o", "then", "part", "local"}
    assert [(r.o, r.then) for r in got] == sorted([r[:2] for r in rows], key=lambda r: (r[0] is not None, r[0], r[1]))


def counted(monkeypatch, *modules):
    """Calls of cut_lineage from now on."""
    from galley import session

    calls = []
    for m in modules:
        monkeypatch.setattr(m, "cut_lineage", lambda df, *a, **k: calls.append(1) or session.cut_lineage(df, *a, **k))
    return calls


def test_a_chain_of_links_takes_few_checkpoints(spark, monkeypatch):
    n = 10_000
    calls = counted(monkeypatch, similar, components, keys)
    got = similar.star_clusters(spark.range(n).toDF("node"), spark.range(n - 1).selectExpr("id lo", "id + 1 hi")).collect()
    assert len(calls) < 20
    assert {r.node: r.anchor for r in got} == {i: i - i % 2 for i in range(n)}


@pytest.mark.parametrize("small,block", [(0, 1), (0, 4), (6, 5), (10**6, 1)])
def test_large_components_go_by_blocks(spark, small, block):
    rnd = random.Random(small + block)
    edges = [(a, a + rnd.choice([1, 1, 2, 7])) for a in range(60) if rnd.random() < 0.8] + [(5, b) for b in range(6, 50, 3)] + [(100, 101), (101, 102), (102, 103)]
    anchor = {}
    for i in sorted({x for e in edges for x in e} | {200}):
        if i not in anchor:
            anchor[i] = i
            anchor |= {b: i for a, b in edges if a == i and b not in anchor}
    nodes = spark.createDataFrame([(i,) for i in anchor], "node long")
    got = similar.star_clusters(nodes, spark.createDataFrame(edges, "lo long, hi long").repartition(3), small, block).collect()
    assert {r.node: r.anchor for r in got} == anchor


@pytest.mark.parametrize("least,hot,list_", [(0.8, 1000, 2000), (0.8, 3, 4), (0.5, 2, 3), (0.3, 1, 2), (1.0, 2, 2)])
def test_similarity_join_of_two_sides(spark, monkeypatch, least, hot, list_):
    """Common shingles, lists in blocks, short texts, texts on both sides, equal sets of shingles."""
    monkeypatch.setattr(similar, "LIST", list_)
    monkeypatch.setattr(similar.posted, "__defaults__", (3, hot))
    rnd = random.Random(4)
    draw = lambda: "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))) + rnd.choice(["", "ending", "end"])
    left, right = ({draw() for _ in range(45)} | {"aaa", "aaaa", "aaaaaaa", "", "b"} for _ in range(2))
    frame = lambda x: spark.createDataFrame([(t,) for t in x] + [(None,)] + [(t,) for t in list(x)[:3]], "key string").repartition(3)
    got = [(r.a, r.b, round(r.sim, 9)) for r in similar.similar_pairs(frame(left), frame(right), least).collect()]
    want = {(a, b, round(jaccard(a, b), 9)) for a in left for b in right if jaccard(a, b) >= least - 1e-12}
    assert len(got) == len(set(got)) and set(got) == want


def test_a_common_ending_is_not_compared_with_all(spark):
    """Texts that meet in a list at all are under 5% of all pairs, though all have one ending."""
    n = 20_000
    texts = spark.range(n).select(F.concat(F.translate(F.sha2(F.col("id").cast("string"), 256).substr(1, 8), "0123456789", "ghijklmnop"), F.lit("ensonson")).alias("key"), F.lit(True).alias("l"), F.lit(True).alias("r"))
    met = similar.meetings(similar.posted(texts, 0.8), 0.8)
    assert 0 < met.count() < 0.05 * n * (n - 1) / 2


def test_lists_of_many_texts_are_parted(spark):
    """Each of 512 shingles is in about 400 of the texts; a text meets under 100 others all the same."""
    n = 20_000
    letters = F.translate(F.sha2(F.col("id").cast("string"), 256).substr(1, 12), "0123456789abcdef", "abcdefghabcdefgh")
    texts = spark.range(n).select(letters.alias("key"), F.lit(True).alias("l"), F.lit(True).alias("r"))
    assert 0 < similar.meetings(similar.posted(texts, 0.8), 0.8).count() < 100 * n


@pytest.mark.parametrize("counters,short,lists", [(1, 200, 0), (3, 2, 500), (1 << 16, 1, 0)])
def test_similarity_join_with_few_counters_and_short_lists(spark, monkeypatch, counters, short, lists):
    """Shingles counted together, lists that go by bands, long lists that are not broadcast."""
    for name, value in (("COUNTERS", counters), ("SHORT", short), ("LISTS", lists)):
        monkeypatch.setattr(similar, name, value)
    monkeypatch.setattr(similar.posted, "__defaults__", (3, 2))
    rnd = random.Random(5)
    texts = {"".join(rnd.choice("ab") for _ in range(rnd.randint(0, 12))) + rnd.choice(["", "ending"]) for _ in range(60)}
    df = spark.createDataFrame([(t,) for t in texts], "key string")
    want = {(a, b) for a in texts for b in texts if jaccard(a, b) >= 0.6 - 1e-12}
    got = [(r.a, r.b) for r in similar.similar_pairs(df, df, 0.6).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_entries_of_lists_are_not_written_down(spark, monkeypatch):
    """What is written on the way to candidates is about a row for each text; entries are shuffled once, for both sides."""
    from galley import session

    n, rows = 20_000, []
    monkeypatch.setattr(similar, "cut_lineage", lambda df: (out := session.cut_lineage(df), rows.append(out.count()))[0])
    letters = F.translate(F.sha2(F.col("id").cast("string"), 256).substr(1, 12), "0123456789abcdef", "abcdefghabcdefgh")
    texts = spark.range(n).select(letters.alias("key"), F.lit(True).alias("l"), F.lit(True).alias("r"))
    met = similar.meetings(similar.posted(texts, 0.8), 0.8)
    met.collect()
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert sum(rows) < 1.5 * n and "ReusedExchange" in plan


def test_a_long_chain_of_changes_takes_rounds_of_its_logarithm(spark, monkeypatch):
    n = 100_000
    calls = counted(monkeypatch, authors)
    got = authors.change_chains(spark.range(n).selectExpr("id ord", "id old_id", "id + 1 new_id")).collect()
    assert len(got) == 1 and got[0].chain == list(range(n + 1)) and len(calls) <= 17 + 8


@pytest.mark.parametrize("ids", [2, 3, 5, 30])
def test_contested_chains_match_the_log(spark, ids):
    rnd = random.Random(ids)
    edges = [(rnd.randint(0, ids), rnd.randint(0, ids)) for _ in range(150)]
    df = spark.createDataFrame([(7 * i - 300, *e) for i, e in enumerate(edges)], "ord long, old_id int, new_id int").repartition(5)
    assert [r.chain for r in authors.change_chains(df).orderBy("ord").collect()] == log(edges)


def test_running_totals_lie_across_ranges(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([1, 1, 1, 2, 3]), i, rnd.choice([None, -3, -1, 1, 4])) for i in range(400)]
    df = spark.createDataFrame(rows, "g long, o long, v long").repartition(4)
    what = {"s": ("sum", F.col("v")), "low": ("min", F.col("v")), "high": ("max", F.col("v"))}
    for before in (False, True):
        got = {r.o: r for r in keys.running(df, "g", [F.col("o")], what, before).collect()}
        for g, o, _ in rows:
            own = [v for h, p, v in rows if h == g and (p < o or p == o and not before) and v is not None]
            assert (got[o].s, got[o].low, got[o].high) == (sum(own), min(own, default=None), max(own, default=None))
    assert len(got) == 400


def fold_people(rows):
    """Rows (id, display_name, first_name, last_name, email, login, decided) as one, one after the other."""

    def either(a, b):
        return a or b

    def two(a, b):
        if a["decided"] or b["decided"]:
            x, y = (a, b) if a["decided"] else (b, a)
            out = {c: either(x[c], y[c]) for c in ("display_name", "email", "login")} | {c: either(x[c], y[c]) or None for c in ("first_name", "last_name")}
            return out | {"id": x["id"], "decided": True}
        return merge(a, b) | {"decided": False}

    out = rows[0]
    for r in rows[1:]:
        out = two(out, r)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_merging_by_aggregates_is_the_ordered_fold(spark, seed):
    rnd = random.Random(seed)
    names, rows = [*authors.FIELDS, "decided"], []
    for g in range(120):
        ids = rnd.sample(range(100), 7)
        for o in range(rnd.randint(1, 7)):
            pick = lambda c: rnd.choice([None, "", f"{c}{o}", f"{c}{o}"])
            rows.append((g, o, ids[o], pick("d"), pick("f"), pick("l"), pick("e"), pick("n"), rnd.random() < 0.15))
    df = spark.createDataFrame(rows, "anchor long, ord long, id long, display_name string, first_name string, last_name string, email string, login string, decided boolean").repartition(3)
    low = keys.running(df, "anchor", [F.col("ord")], {"low": ("min", F.col("id"))}, before=True)
    got = {r.anchor: r for r in authors.merge_people(low, "anchor").collect()}
    for g in range(120):
        own = [dict(zip(names, r[2:])) for r in sorted(rows) if r[0] == g]
        want = fold_people(own)
        assert got[g].n == len(own) and {c: got[g][c] for c in authors.FIELDS} == {c: want[c] for c in authors.FIELDS}, own


def brute_numbers(rows):
    """(row, number) of (base, place, number or None), each late row of a base the least number that no earlier one has."""
    out, used = {}, {}
    for i, (base, place, number) in sorted(enumerate(rows), key=lambda x: x[1][1]):
        gone = used.setdefault(base, set())
        if number is None:
            n = 1
            while n in gone:
                n += 1
            out[i] = n
        gone.add(n if number is None else number)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_free_numbers_are_the_ordered_walk(spark, seed):
    """One base in all ranges, others in one; held numbers dense, sparse, before and behind the late rows; 0 is no number."""
    rnd = random.Random(seed)
    places, rows = rnd.sample(range(10_000), 700), []
    for base, n, share, most in (("a", 400, 0.5, 300), ("b", 40, 0.9, 60), ("c", 40, 0.1, 2000), ("d", 20, 1.0, 30), ("e", 200, rnd.random(), 250)):
        numbers = rnd.sample(range(most), min(n, most))
        rows += [(base, places.pop(), numbers.pop() if numbers and rnd.random() < share else None) for _ in range(n)]
    place = lambda p, i: (False, p, 0, i)
    kind = "place struct<none:boolean,id:long,tie:long,row:long>"
    late = spark.createDataFrame([(i, b, place(p, i)) for i, (b, p, n) in enumerate(rows) if n is None], f"row long, base string, {kind}").repartition(3)
    held = spark.createDataFrame([(b, n, place(p, i)) for i, (b, p, n) in enumerate(rows) if n is not None], f"base string, number long, {kind}").repartition(3)
    got = {r.row: r.number for r in slugs._free_numbers(late, held).collect()}
    assert got == brute_numbers(rows)


def test_one_late_row_among_many_held_slugs(spark, monkeypatch):
    """All rows have one base; its held numbers lie in many ranges, which are gone through in few passes."""
    n, sizes, passes = 200_000, [], []
    skipping = slugs._skipping
    monkeypatch.setattr(slugs, "_skipping", lambda *a: passes.append(1) or skipping(*a))
    sorted_parts = slugs.sorted_parts
    monkeypatch.setattr(slugs, "sorted_parts", lambda *a: sizes.append(x := sorted_parts(*a)) or x)
    place = F.struct(F.lit(False).alias("none"), F.col("id"), F.lit(0).cast("long").alias("tie"), F.col("id").alias("row")).alias("place")
    held = spark.range(n).select(F.lit("news").alias("base"), (F.col("id") + 1).alias("number"), place)
    late = spark.range(n, n + 1).select(F.col("id").alias("row"), F.lit("news").alias("base"), place)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # such small ranges would be put together
    try:
        assert [tuple(r) for r in slugs._free_numbers(late, held).collect()] == [(n, n + 1)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    most = max(r["count"] for r in sizes[0].groupBy("part").count().collect())
    assert most < 0.5 * n and len(passes) <= 4


def test_slugs_beside_columns_of_any_name(spark):
    names = ["base", "id_", "tie", "root", "first", "rounds", "plain", "row"]
    df = spark.createDataFrame([(i, "a" if i % 2 else f"a-{i}", *["x"] * len(names)) for i in range(8)], f"id long, title string, {', '.join(f'`{n}` string' for n in names)}")
    got = slugs.unique_slugs(df, (F.col("title"),), "t").orderBy("id").collect()
    assert [r.slug for r in got] == ["a-0", "a", "a-2", "a-3", "a-4", "a-5", "a-6", "a-7"] and got[0].asDict().keys() == {"id", "title", "slug", *names}


@pytest.mark.parametrize("cells,sample,block", [(1, 10, 1000), (8, 64, 1000), (16, 200, 20), (300, 4096, 7)])
def test_pruned_neighbours_are_exact(spark, cells, sample, block):
    """Groups of vectors, ties, repeated ids, more asked than there are, and whatever cells."""
    rnd = np.random.default_rng(cells)
    middle = rnd.normal(size=(6, 5)) * 20
    rows = [(i, [float(np.float32(x)) for x in middle[i % 6] + rnd.normal(size=5)]) for i in range(240)]
    rows += [(300 + i, [1.0, 2.0, 3.0, 4.0, 5.0]) for i in range(9)] + [rows[6]] * 3 + [(500, None), (None, [0.0] * 5)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, cell string").repartition(4)
    asked = df.where("vec_id % 3 = 1 OR vec_id >= 300")
    known = [(i, np.array(v)) for i, v in rows if i is not None and v]
    for k in (1, 5, 400):
        got, share = vectors.pruned_nearest(df, asked, k, cells=cells, sample=sample, block=block)
        want = {}
        for q in {i for i, _ in known if i % 3 == 1 or i >= 300}:
            at = next(v for i, v in known if i == q)
            want[q] = sorted((float(np.sqrt(((v - at) ** 2).sum())), i) for i, v in known if i != q)[:k]
        found = {}
        for r in got.collect():
            found.setdefault(r.query_id, []).append((r.rank, r.distance, r.vec_id))
        assert {q: [(d, i) for _, d, i in sorted(x)] for q, x in found.items()} == want
        assert share <= 1 and (k > 5 or cells < 8 or share < 0.5)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return 1 - row[-1] / max(len(a), len(b), 1)


def test_another_measure(spark):
    """Names with up to two edits by edit distance: all that are found are right, and few are missed."""
    rnd = random.Random(6)
    letters = "abcdefghijklmnopqrst"
    left = ["".join(rnd.choice(letters) for _ in range(rnd.randint(9, 20))) for _ in range(150)] + ["", "a"]
    right = [*left[:20], ""]
    for text in left[:150]:
        for n in (1, 2):
            own = list(text)
            for _ in range(n):
                own[rnd.randrange(len(own))] = rnd.choice(letters)
            right.append("".join(own))
    frame = lambda x: spark.createDataFrame([(t,) for t in x], "key string").repartition(3)
    got = {(r.a, r.b): r.sim for r in similar.similar_pairs(frame(left), frame(right), 0.85, measure=similar.EDITS).collect()}
    want = {(a, b): edits(a, b) for a in set(left) for b in set(right) if edits(a, b) >= 0.85}
    assert all(want[p] == pytest.approx(s) for p, s in got.items()) and len(got) >= 0.98 * len(want) > 200


def test_resolving_and_matching_by_another_measure(spark):
    """Two letters that changed places: a quarter of the shingles differs, two of twenty characters."""
    rows = people(spark, (1, "Alexandra Bellingham", None, None, "a@x", "l1"), (2, "Alexandra Belilngham", None, None, None, "l2"), (3, "Someone Entirely Else", None, None, None, "l3"))
    by_shingles = authors.resolve(rows)[0].collect()
    got = authors.resolve(rows, merge=0.85, measure=similar.EDITS)[0].collect()
    assert len(by_shingles) == 3 and sorted(r.id for r in got) == [1, 3]
    lookup = bylines.author_lookup(rows)
    keys_ = spark.createDataFrame([("alexandrabelinlgham",)], "key string")
    assert bylines.similar_names(keys_, lookup).where("matched").isEmpty()
    found = bylines.similar_names(keys_, lookup, 0.85, measure=similar.EDITS).collect()
    assert [(r.author_id, r.matched) for r in found] == [(1, True)]
