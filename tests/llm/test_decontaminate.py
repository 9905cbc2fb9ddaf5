import hashlib
import random
import re

from galley.llm import decontaminate
from galley.llm.decontaminate import OP11_SQL, contaminated
from galley.llm.queries import queries
from tests.helpers import SMALL, same_rows

WORD = re.compile(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, w string, n_words string, k1 string, n_hit string, shingle long"
ITEMS = "item_id long, text string, window string, words string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, size=10):
    out = []
    for doc_id, text, *_ in docs:
        own, hit, found = words(text), set(), set()
        for item, item_text, *_ in items:
            w = words(item_text)
            n = min(size, len(w))
            windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()
            for i in range(len(own) - n + 1):
                if tuple(own[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= {str(item)} - {"None"}
        out.append((doc_id, len(own), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def corpus():
    rnd = random.Random(9)
    word = lambda: rnd.choice(["Öl", "a", "b1", "Zz", "東京", "x9", "of", "the"])
    text = lambda n: "".join(word() + rnd.choice([" ", ", ", "-\n", "\0", "__"]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 2, 3, 5, 9, 10, 11, 30])), "w", "v") for i in range(25)]
    items += [(3, text(12), "", ""), (None, "only null here and nothing more than these few words", "", ""), (99, None, "", ""), (98, "!? --", "", ""), items[5], (100, items[20][1], "", "")]
    docs = [(i, text(rnd.choice([0, 1, 5, 40, 200])), *"wxyz", 1) for i in range(60)]
    docs += [(i, f"{text(20)} {rnd.choice(items)[1]} {text(20)}", *"wxyz", 1) for i in range(60, 110)]
    docs += [(None, "Only NULL here and nothing; more than these few words", *"wxyz", 1), (5, None, *"wxyz", 1), (6, "", *"wxyz", 1), docs[70], docs[70], docs[71], (7, docs[80][1] * 300, *"wxyz", 1)]
    return docs, items


def check(spark, docs, items, **more):
    got = contaminated(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), **more)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, **more)


def test_against_brute_force(spark):
    check(spark, *corpus())


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ROWS", 40)
    check(spark, *corpus(), size=6)


def test_nothing(spark):
    docs, items = corpus()
    check(spark, docs, [])
    check(spark, docs, [(1, None, "", "")])
    assert contaminated(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).collect() == []


def test_query_against_sql(spark):
    same_rows(spark, queries()["op11_decontaminate"], OP11_SQL, SMALL)


def test_texts_pass_by_without_shuffle_or_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = docs.selectExpr("xxhash64(text) k1", "xxhash64(1, text) k2", "text")
    of, _ = decontaminate.windows(spark.read.parquet(f"{SMALL}/benchmark.parquet"), "item_id", "text", 10)
    plan = decontaminate.occurrences(texts, of)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "Python" not in plan and "Arrow" not in plan
