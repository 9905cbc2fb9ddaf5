"""Top-k search, near-duplicates and substring dedup."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from galley.llm import chunk_dedup, components, neardup, topk


def brute_top(rows, queries, k):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in ok:
        if i in queries:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored)]
    return sorted(out)


def test_top_k_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, [0.5] * 8) for i in range(40)]  # ties
    rows += [(2000, None), (2001, []), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, [1.0] * 8), (2005, [0.25, 1.0]), (2010, [0.5, 0.5]), (2020, [2.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, q string, rank int").repartition(4)
    queries = {i for i, _ in rows if i is not None and i % 10 == 0}
    for k, block in ((5, 2048), (3, 7), (500, 2048)):
        got = topk.top_k(df, F.col("vec_id") % 10 == 0, k, block=block).collect()
        assert sorted(tuple(r) for r in got) == brute_top(rows, queries, k)


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") >= 0).collect() == []
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("vec_id") >= 0).collect() == []


def sets_of(rows, width):
    out = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        out.setdefault(i, []).append({tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    return out


def brute_components(rows, width, percent):
    sets = sets_of([r for r in rows if r[0] is not None], width)
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in sets}


def test_near_duplicates_match_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for width in (4, 5):
        got = neardup.near_duplicates(docs, width=width)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"] and got.count() == len(rows)
        want = brute_components(rows, width, 80)
        sizes = {(i, len(s)) for i, own in sets_of(rows, width).items() for s in own}
        for r in got.collect():
            assert r.component_id == want.get(r.doc_id) and (r.doc_id, r.n_shingles) in sizes
            assert r.kept == (r.doc_id is None or r.component_id == r.doc_id)


def test_a_chain_and_a_crowd_of_near_copies(spark):
    """Neighbours of a chain are alike, its ends are not; copies of a text edited here and there are alike through it."""
    rnd = random.Random(8)
    pool = [f"v{i}" for i in range(2000)]
    chain = [" ".join(pool[s : s + 300]) for s in range(0, 300, 20)]
    origin = pool[1000:1200]
    crowd = [" ".join(origin[:p] + [f"e{n}", f"f{n}"] + origin[p:]) for n, p in enumerate(rnd.sample(range(200), 120))]
    rows = list(enumerate([*chain, *crowd, " ".join(origin)]))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    assert got == brute_components(rows, 5, 80)


def test_similar_pairs_at_the_limit_are_found(spark):
    """Pairs of a similarity of exactly 0.8 and a little below."""
    rows, n = [], 0
    for pair in range(60):
        shared = [f"p{pair}_{i}" for i in range(80)]
        for side in "ab":
            rows.append((n, " ".join([*shared, *(f"{side}{pair}_{i}" for i in range(10 if pair % 2 else 12))])))
            n += 1
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width=1).collect()}
    assert got == {i: (i // 2 * 2 if (i // 2) % 2 else i) for i in range(n)}


def texts_round_a_template(rnd, kinds):
    """Texts that share most of a template: cut short, with a footer that many share, with own filler."""
    origin = [f"v{i}" for i in range(200)]
    footer = [f"f{i}" for i in range(30)]
    out = []
    for n in range(kinds):
        own = [f"o{n}_{i}" for i in range(rnd.randint(0, 70))]
        kind = n % 4
        text = origin[: rnd.randint(50, 200)] if kind == 0 else origin + own if kind == 1 else origin + footer + own if kind == 2 else origin[rnd.randint(0, 150) :] + own[:8]
        out.append(" ".join(text))
    return out


def test_shortened_copies_and_common_footers_match_brute_force(spark):
    for seed in range(2):
        rnd = random.Random(seed)
        rows = list(enumerate(texts_round_a_template(rnd, 160)))
        rnd.shuffle(rows)
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), width=4).collect()}
        assert got == brute_components(rows, 4, 80)


def test_hot_keys_are_spread(spark, monkeypatch):
    """With salts for every key of a few rows the result is the same."""
    monkeypatch.setattr(neardup, "HOT_ROWS", 5)
    rnd = random.Random(5)
    rows = list(enumerate(texts_round_a_template(rnd, 80) + ["the same text of a few words"] * 30))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), width=4).collect()}
    assert got == brute_components(rows, 4, 80)


def test_one_document_with_several_texts(spark):
    a, b, c = (" ".join(f"{k}{i}" for i in range(40)) for k in "abc")
    rows = [(5, a), (7, a), (7, b), (9, b), (9, c), (11, c), (20, "alone " + c[:40])]
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(5, 5), (7, 5), (9, 5), (11, 5), (20, 20)}


def test_keys_must_be_integers(spark):
    df = spark.createDataFrame([("x", "some text")], "doc_id string, text string")
    for operator in (neardup.near_duplicates, chunk_dedup.dedup_passages, chunk_dedup.dedup_substrings):
        with pytest.raises(TypeError, match="doc_id must be an integer column"):
            operator(df)


def test_near_duplicates_of_nothing(spark, nothing):
    assert neardup.near_duplicates(nothing).collect() == []


def test_signatures_estimate_similarity():
    a, b = (np.unique(neardup._stream(s, 4000)) for s in (1, 1))
    b = np.concatenate([b[:3000], neardup._stream(1 << 24, 1000)])
    agree = (neardup.signature(np.unique(a)) == neardup.signature(np.unique(b))).mean()
    assert 0.4 < agree < 0.8  # 0.6 is expected


def test_pairs_at_the_limit_are_lost_as_rarely_as_said():
    """Fewer than MATCHES of K coordinates agree with a probability below 5e-6 at a similarity of 0.8."""
    lost = sum(math.comb(neardup.K, i) * 0.8**i * 0.2 ** (neardup.K - i) for i in range(neardup.MATCHES))
    assert lost < 5e-6


def test_components(spark):
    rnd = random.Random(4)
    edges = [(rnd.randint(0, 150), rnd.randint(0, 150)) for _ in range(110)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 7)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    linked = {x for e in edges if e[0] != e[1] for x in e}
    got = {r.id: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in linked}


def brute_dedup(rows, min_words):
    owner = {}
    for i, t in rows:
        for d in set(chunk_dedup.chunks(t)[2]) if t and i is not None else ():
            owner[d] = min(i, owner.get(d, i))
    return sorted((str(i), str(chunk_dedup.remove_runs(t, {d for d in set(chunk_dedup.chunks(t)[2]) if owner[d] < i}, min_words)[0] if t and i is not None else t)) for i, t in rows)


def test_substring_dedup_matches_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = chunk_dedup.dedup_substrings(docs).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == brute_dedup(rows, chunk_dedup.MIN_WORDS)
    whole = {(r[0], len(r[1] or "")) for r in rows}
    for r in got:
        assert (r.doc_id, len(r.text or "") + r.removed_chars) in whole
        assert all(0 <= s.begin < s.end for s in r.repeats) and sum(s.end - s.begin for s in r.repeats) == r.removed_chars
        assert r.kept == "no" and r.size == 9


def test_passages_are_caught_and_clean_texts_left(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    passages = [" ".join(word() for _ in range(55)) for _ in range(30)]
    rows = []
    for n, p in enumerate(passages):
        for copy in range(3):
            rows.append((len(rows), " ".join(word() for _ in range(rnd.randint(30, 90))) + (" " if copy else "\n") + p + " " + " ".join(word() for _ in range(40))))
    clean = [(1000 + i, " ".join(word() for _ in range(150)) + "\nThis line stands in all of them, as lines do.") for i in range(40)]
    got = {r.doc_id: r for r in chunk_dedup.dedup_substrings(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    for i, _ in rows:
        assert (got[i].removed_chars > 0) == (i % 3 > 0)
    assert all(got[i].removed_chars == 0 and got[i].text == t for i, t in clean)


def test_chunks_survive_insertions():
    rnd = random.Random(9)
    text = " ".join(f"w{rnd.randint(0, 99999)}" for _ in range(2000))
    a, b = set(chunk_dedup.chunks(text)[2]), set(chunk_dedup.chunks("inserted at the front " + text[:5000] + "more " + text[5000:])[2])
    assert len(a - b) <= 4
    for odd in ("", " ", "é" * 2000, "x" * 5000, "漢字" * 900, "\n" * 600):
        raw, at, digests = chunk_dedup.chunks(odd)
        assert at[0] == 0 and at[-1] == len(raw) and len(digests) == len(at) - 1
        assert "".join(raw[i:j].decode() for i, j in zip(at, at[1:])) == odd


def brute_passages(rows, n):
    """Texts without every word in a run of n words that a smaller doc_id holds, word by word."""
    held = {}
    for i, t in rows:
        w = (t or "").split()
        for j in range(len(w) - n + 1) if i is not None else ():
            held[tuple(w[j : j + n])] = min(i, held.get(tuple(w[j : j + n]), i))
    out = []
    for i, t in rows:
        w = (t or "").split()
        gone = {x for j in range(len(w) - n + 1) if i is not None and held[tuple(w[j : j + n])] < i for x in range(j, j + n)}
        out.append((str(i), [x for j, x in enumerate(w) if j not in gone]))
    return sorted(out)


def test_passages_go_to_their_true_ends(spark, docs):
    """Short passages in random places, one inside another, in one document twice and with other white space."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijé") for _ in range(rnd.randint(2, 14)))
    rows = []
    for n in range(120):
        p = [word() for _ in range([19, 20, 21, 51, 60, 80][n % 6])]
        for copy, gap in enumerate((" ", "\n", "  ")):
            inner = p[5:40] if copy == 1 and n % 3 == 0 else p
            rows.append((len(rows), " ".join(word() for _ in range(rnd.randint(0, 30))) + " " + gap.join(inner * (1 + copy // 2)) + " " + " ".join(word() for _ in range(rnd.randint(0, 30)))))
    rows += [(5000 + r.doc_id if r.doc_id is not None else None, r.text) for r in docs.collect()]
    rnd.shuffle(rows)
    got = chunk_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((str(r.doc_id), (r.text or "").split()) for r in got) == brute_passages(rows, chunk_dedup.MIN_WORDS)
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    for r in got:
        if r.removed_chars:
            assert any(r.text == "".join(t[a:b] for a, b in zip([0, *(s.end for s in r.repeats)], [*(s.begin for s in r.repeats), len(t)])) for t in texts[r.doc_id] if t)


@pytest.mark.parametrize("length", [51, 60, 80])
def test_the_query_catches_passages(spark, tmp_path, length):
    """At least 99 of 100 passages are caught, most of their words go, and no other word does."""
    rnd = random.Random(length)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.choice([2, 3, 3, 4, 5, 5, 6, 7, 9])))
    words = lambda n: " ".join(word() for _ in range(n))
    n, rows = 300, []
    for k in range(n):
        passage = words(length)
        rows += [(2 * k + side, f"{words(30)}\n{passage} {words(30)}") for side in (0, 1)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in chunk_dedup.op3_substring_dedup(spark, str(tmp_path)).collect()}
    assert all(got[2 * k].text == rows[2 * k][1] and not got[2 * k].repeated for k in range(n))
    assert sum(got[2 * k + 1].repeated for k in range(n)) >= 0.99 * n
    gone = 0
    for k in range(n):
        own, kept = rows[2 * k + 1][1].split(), got[2 * k + 1].text.split()
        assert kept[:30] == own[:30] and kept[-30:] == own[-30:]
        gone += len(own) - len(kept)
    assert gone >= 0.75 * n * length


def test_too_many_ids_for_a_broadcast_give_the_same(spark, docs, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "BROADCAST_IDS", 2)
    got = chunk_dedup.dedup_substrings(docs).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in got) == brute_dedup([(r.doc_id, r.text) for r in docs.collect()], chunk_dedup.MIN_WORDS)


def test_passages_of_nothing(spark, nothing):
    assert chunk_dedup.dedup_passages(nothing).collect() == []


def test_substring_dedup_of_nothing(spark, nothing):
    assert chunk_dedup.dedup_substrings(nothing).collect() == []


def test_crowds_round_the_limit_match_brute_force(spark):
    """Copies with so many edits, cuts and shared insertions that links and gaps mix."""
    for seed in range(3):
        rnd = random.Random(seed)
        origin = [f"v{i}" for i in range(160)]
        shared = [[f"s{j}_{i}" for i in range(14)] for j in range(3)]
        rows = []
        for n in range(90):
            text = list(origin)
            for k in range(rnd.randint(0, 9)):
                p = rnd.randrange(len(text))
                kind = rnd.random()
                if kind < 0.35:
                    text[p] = f"n{n}_{k}"
                elif kind < 0.6:
                    del text[p : p + rnd.randint(1, 8)]
                else:
                    text[p:p] = [f"m{n}_{k}"]
            if rnd.random() < 0.4:
                p = rnd.choice([0, 40, 100])
                text[p:p] = rnd.choice(shared)
            if rnd.random() < 0.3:
                text = text[: int(len(text) * rnd.uniform(0.7, 1))]
            rows.append((n, " ".join(text)))
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), width=4).collect()}
        assert got == brute_components(rows, 4, 80)
