import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from galley.llm import merkle
from galley.llm.merkle import OP13_SQL
from galley.llm.queries import queries
from tests.helpers import SMALL, same_rows

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, digest string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """(root, siblings of each leaf)."""
    nodes, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            if at[i] ^ 1 < len(nodes):
                path.append(nodes[at[i] ^ 1])
            at[i] //= 2
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], paths


def up(digest, at, n, path):
    path = list(path)
    while n > 1:
        if at ^ 1 < n:
            digest = h(path.pop(0), digest) if at & 1 else h(digest, path.pop(0))
        else:
            digest = h(digest)
        at, n = at // 2, (n + 1) // 2
    return digest


def leaf(r, n_chars):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r[0], r[1], r[2], n_chars, r[4])])


def brute(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[3]), r))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    subs = []
    for name in names:
        langs[name].sort(key=lambda x: x[:3])
        subs.append(brute_tree([x[2] for x in langs[name]]))
    root, above = brute_tree([s[0] for s in subs])
    out = []
    for k, name in enumerate(names):
        own = langs[name]
        for i, (_, _, digest, r) in enumerate(own):
            tampered = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            start = leaf(r, r[3] + 1) if tampered else digest
            path = subs[k][1][i]
            folded = up(up(start, i, len(own), path), k, len(names), above[k])
            out.append((r[0], digest, subs[k][0], root, h(*path, *above[k]), folded, folded == root))
    return sorted(out, key=str)


def corpus(n, langs, seed=1):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append((rnd.choice([None, i, i, i, i, 7]) if i % 10 == 0 else i * 3, rnd.choice([None, "a", "é-1"]), rnd.choice(langs), rnd.choice([None, 3, 12, 0]), rnd.choice([None, "", "x", "né\0\n" * 9, "w " * 400]), "t", "d"))
    return rows + rows[:5]


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (2, [None]), (3, [None, "b", "a", "é"]), (97, ["en", "en", "en", None, "de", "-"]), (700, ["en"])])
def test_against_brute_force(spark, n, langs):
    rows = corpus(n, langs)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = merkle.manifest(df.select("doc_id", "source", "lang", "n_chars", "text"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_no_documents(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("bits", [1, 2, 5])
def test_rounds_of_few_levels(spark, bits):
    """Blocks are smaller than trees and trees lie across tasks, in any order."""
    rows = [(t, n, at, sha256(f"{t}{at}".encode()).digest(), at * 2) for t, n in (("a", 37), ("b", 1), ("c", 64), ("d", 2)) for at in range(n)]
    df = spark.createDataFrame(rows, "tree string, n long, at long, digest binary, mine long").repartition(6)
    got = {(r.tree, r.at): r for r in merkle.merkle(df, bits).collect()}
    for t, n in (("a", 37), ("b", 1), ("c", 64), ("d", 2)):
        root, paths = brute_tree([h(f"{t}{at}") for at in range(n)])
        for at in range(n):
            assert got[t, at].root.hex() == root and got[t, at].path.hex() == "".join(paths[at]) and got[t, at].mine == at * 2
            assert merkle.fold(got[t, at].digest, at, n, got[t, at].path).hex() == root
    assert len(got) == 104


def test_query_against_sql(spark):
    same_rows(spark, queries()["op13_merkle_manifest"], OP13_SQL, SMALL)


def test_a_change_is_found(spark):
    got = queries()["op13_merkle_manifest"](spark, SMALL).collect()
    touched = {r.doc_id for r in spark.read.parquet(f"{SMALL}/documents.parquet").where(F.col("n_chars").isNotNull()).collect() if zlib.crc32(str(r.doc_id).encode()) % 7 == 0}
    assert {r.doc_id for r in got if not r.verified} == touched and touched
