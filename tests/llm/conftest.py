import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, sig string, size int, kept string, __at int, __id long, owned int, digests string, __key string, __size string, __rank int, __pattern string, __hits0 int, w int, n int"


def words(rnd, n, vocabulary=400):
    return " ".join(f"w{rnd.randint(0, vocabulary)}" for _ in range(n))


def corpus():
    """Texts of many kinds: null, empty, blank, short, long, copies, near copies, shared passages."""
    rnd = random.Random(42)
    passage = words(rnd, 70, 5000)
    origin = words(rnd, 300, 5000).split()
    texts = [None, "", " \n\t ", "one", "A b", "a B", "one two three", "é" * 50, "x" * 3000, "dup dup " * 60]
    texts += [words(rnd, rnd.randint(5, 200)) for _ in range(40)]
    texts += [f"{words(rnd, 60, 5000)}\n{passage}\n{words(rnd, 60, 5000)}" for _ in range(6)]
    for n in range(12):
        near = list(origin)
        for i in rnd.sample(range(300), n):
            near[i] = f"edit{n}_{i}"
        texts.append(" ".join(near))
    texts += [texts[20], texts[20], texts[25].upper(), " ".join(origin), words(rnd, 30_000, 20_000)]
    rows = [(3 * i + 1, t, ["en", "de", None][i % 3], ["s1", "s2", "s3", None][min(3, i % 7)], 0) for i, t in enumerate(texts)]
    rows += [rows[20], (None, texts[20], "en", "s1", 0), (None, None, None, None, None)]
    return [(*r, 5, "k", "s", 9, "no", 1, 2, 3, "d", "k", "s", 4, "p", 6, 7, 8) for r in rows]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
