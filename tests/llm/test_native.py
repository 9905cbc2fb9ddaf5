"""URL filters and quality rules."""

import random
import re

import pytest
from pyspark.sql import functions as F

from galley.llm import quality, queries, url_filter
from tests.helpers import SMALL, same_rows

URLS = [None, "", "no scheme", "http://", "https://Example.COM/en/1?q", "http://www.example.com/en/", "http://www.example.com/fr", "ftp://a.www.example.com/en/x#y", "http://notexample.com/en/", "http://a.net/es/", "http://net/fr/1", "http://com", "http://com/", "http://x.com?a/", "http://x.net/de/http://y.com/en/", "http://x.com:80/en/", "http://x.com./"]


def judge(url, rules):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2]), default=None)
    return (host, path, best and best[0] + best[1], best[2] if best else "allow")


def judged(df):
    return sorted((str(r.url), r.host, r.path, r.rule, r.verdict) for r in df.collect())


@pytest.mark.parametrize("few", [True, False])
def test_urls_match_brute_force(spark, few):
    rnd = random.Random(1)
    rules = list(url_filter.QUERY_RULES) + [("a.net", "/e", "allow"), ("a.net", "/e", "block"), ("x.com", "/en/", "block"), ("", "/", "allow")]
    rules += [(".".join(rnd.choice(["a", "b", "com"]) for _ in range(rnd.randint(1, 4))), "/" + "ab/"[: rnd.randint(0, 3)], rnd.choice(["allow", "block"])) for _ in range(30)]
    rules = list({(h, p): (h, p, max(v for x, y, v in rules if (x, y) == (h, p))) for h, p, _ in rules}.values())
    urls = URLS + ["http://" + ".".join(rnd.choice(["a", "b", "com", "www"]) for _ in range(rnd.randint(1, 5))) + rnd.choice(["", "/", "/ab/c", "/a?x"]) for _ in range(200)] * 2
    df = spark.createDataFrame([(i, u, "h", 1) for i, u in enumerate(urls)], "page_id int, url string, host string, labels int")
    made = url_filter.rules_frame(spark, rules + [("x", None, "block")])
    got = url_filter.filter_urls(df, made, narrow_shapes=16 if few else 0)
    if few:
        got = url_filter.filter_urls(df, made, narrow_shapes=200)
    assert judged(got) == sorted((str(u), *judge(u, rules)) for u in urls)


@pytest.mark.parametrize("shapes", [16, 0])
def test_columns_may_have_any_name(spark, shapes):
    names = ["hits", "short", "digest", "best", "hit", "salt", "host", "rule", "__hits0", "labels", "length"]
    df = spark.createDataFrame([("http://www.example.com/en/x", *range(len(names)))], ["url", *names])
    r = url_filter.filter_urls(df, url_filter.rules_frame(spark, url_filter.QUERY_RULES), narrow_shapes=shapes).first().asDict()
    assert (r["host"], r["rule"], r["verdict"]) == ("www.example.com", "www.example.com/en/", "allow")
    assert {n: r[n] for n in names if n not in ("host", "rule")} == {n: i for i, n in enumerate(names) if n not in ("host", "rule")}


def test_long_repetitive_texts(spark):
    """Windows of texts of thousands of words, by positions of equal windows."""
    rnd = random.Random(5)
    unit = [f"w{rnd.randint(0, 40)}" for _ in range(2500)]
    texts = [" ".join(unit + unit[100:900] + [f"x{i}" for i in range(500)]), "a b c d e f g h i " * 700, " ".join(f"y{i}" for i in range(6000))]
    for i, r in enumerate(spark.createDataFrame(list(enumerate(texts)), "i int, text string").withColumn("s", quality.stats(F.col("text"))).orderBy("i").collect()):
        words, at = texts[i].split(), {}
        for k in range(len(words) - 7):
            at.setdefault(tuple(words[k : k + 8]), []).append(k)
        assert r.s.n_repeat_words == len({k + j for own in at.values() if len(own) > 1 for k in own for j in range(8)})


def test_urls_of_nothing(spark):
    empty = spark.createDataFrame([], "page_id int, url string")
    rules = url_filter.rules_frame(spark, url_filter.QUERY_RULES)
    assert url_filter.filter_urls(empty, rules).collect() == []
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id int, url string")
    assert url_filter.filter_urls(some, url_filter.rules_frame(spark, [])).first()["verdict"] == "allow"


def brute(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)} if len(words) < 3000 else set()
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_stats_match_brute_force(spark, docs):
    more = spark.createDataFrame([(900, "a b c d e f g h i a b c d e f g h j\n\n \nx#\nx#\n x#"), (901, "z " * 40), (902, "a b c d e f g h"), (903, "é　b\x0bc\x1cd"), (904, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 1 2 3")], "doc_id long, text string")
    for r in docs.select("doc_id", "text").union(more).withColumn("s", quality.stats(F.col("text"))).collect():
        assert tuple(r.s) == brute(r.text)


def test_cascade_orders_but_never_decides(spark, docs):
    rules = (*quality.BASE, *quality.METHOD)
    a = quality.apply_rules(docs, rules)
    assert a.columns == [c for c in docs.columns if c != "kept"] + ["failed_rule", "kept"] or set(a.columns) == {*docs.columns, "failed_rule"}
    kept = lambda df: sorted((str(r.doc_id), str(r.text), r.kept) for r in df.collect())
    b = docs.withColumn("failed_rule", quality.cascade(F.col("text"), list(rules[::-1]))).withColumn("kept", F.col("failed_rule").isNull())
    assert kept(a) == kept(b)
    plain = docs.withColumn("kept", ~F.greatest(*[r.rejects(F.col("text")) for r in rules]))
    assert kept(a) == kept(plain)


def test_cheap_rules_that_reject_come_first(spark, docs):
    never = quality.Rule("never", lambda t: F.lit(False))
    always = quality.Rule("always", lambda t: F.lit(True))
    assert [r.name for r in quality.order_rules(docs, (never, always))] == ["always", "never"]


def test_quality_of_nothing(spark, nothing):
    assert quality.apply_rules(nothing).collect() == []


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    same_rows(spark, queries.queries()[name], queries.oracle_sql()[name], SMALL)


@pytest.mark.parametrize("name", ["op1_url_filters", "op4_quality_rules"])
def test_no_python_on_the_main_path(spark, name):
    plan = queries.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
