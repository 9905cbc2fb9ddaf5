"""Language identification, toxicity, token counts, SentencePiece and mixing."""

import itertools
import os
import random
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from galley.llm import langid, mixing, queries, spm, tokencount, toxicity
from tests.helpers import SMALL

ODD = ["", " ", "a", " a", "a ", "a  b", "a\nb", "a \n b", "\n", "don't we'll", "x <|endoftext|> y", "x  <|endoftext|>", "<|endoftext|><|endoftext|>", "é 漢字　🙂\xa0\x85a", "1 2 33,4", "\r\n a", "▁ a▁b", "<s> </s> <unk>", "a" * 2000, " " * 300, "ab " * 3000, "漢" * 700]


def test_language_held_out(spark):
    got = queries.queries()["op5_language_id"](spark, SMALL)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    rows = got.join(docs, "doc_id").where("held_out").collect()
    assert rows and sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and got.count() == docs.count()


def test_language_backs_off_to_shorter_grams(spark, docs):
    train = spark.createDataFrame([("der hund und die katze", "de"), ("the dog and the cat", "en"), ("the the the", "en")], "text string, lang string")
    model = langid.fit(train)
    scorer = langid.Scorer(model)
    assert scorer.predict("THE cat")[0] == "en" and scorer.predict("und")[0] == "de"
    assert scorer.predict("hunde katzen")[0] == "de"  # unseen words, known n-grams
    for nothing in (None, "", "123 !?", "_ _"):
        assert scorer.predict(nothing) == ("und", 0.0)
    rows = model.backoff(["hunden", "☃"])
    longest = [model.gram_table[model.grams[g]] for g in ("^hun", "hund") if g in model.grams]
    assert rows[0] == pytest.approx(sum(longest) / len(longest)) and not rows[1].any()
    out = langid.identify(docs, model)
    assert out.count() == docs.count() and out.where("lang_pred IS NULL OR score NOT BETWEEN 0 AND 1").count() == 0
    assert langid.identify(docs, langid.fit(train.limit(0))).where("lang_pred <> 'und'").count() == 0


def test_language_needs_a_letter():
    model = langid.Model(["de", "en"], {"der": [5, 0], "the": [0, 5]}, [5, 5], {"t": [0, 5], "d": [5, 0]}, {1: [5, 5], 2: [0, 0], 3: [0, 0], 4: [0, 0]})
    scorer = langid.Scorer(model)
    for nothing in ("½ ²", "Ⅷ ①", "١٢٣", "_ 4"):
        assert scorer.predict(nothing) == ("und", 0.0)
    assert scorer.predict("the²") == scorer.predict("the") and scorer.predict("der½the")[1] == pytest.approx(0.5)


def test_language_sample_is_exact_and_never_empty(spark):
    """Of one text many times, and of languages with few rows, some are taken; of none more than asked."""
    rows = [(i, "der hund und die katze", "de") for i in range(3000)] + [(9000 + i, f"the dog {i}", "en") for i in range(500)] + [(9999, "le chat", "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    n = {r["lang"]: r["count"] for r in langid._sample(df.withColumnRenamed("doc_id", "key"), 200).groupBy("lang").count().collect()}
    assert n == {"de": 200, "en": 200, "fr": 1}
    model = langid.fit(df, 200)
    assert model.languages == ["de", "en", "fr"] and langid.Scorer(model).predict("le chat")[0] == "fr"
    with pytest.raises(ValueError, match="languages"):
        langid.fit(spark.range(600).selectExpr("id AS doc_id", "'a' AS text", "concat('l', id) AS lang"))


def test_language_scores_are_the_model_restated():
    """Against the formula of the module's first paragraph, word by word."""
    import math

    counts = {"der": [7, 1], "hund": [4, 0], "the": [0, 9], "dog": [0, 3]}
    totals, grams = [20, 30], {"h": [4, 9], "u": [6, 1], "^h": [4, 0], "un": [5, 0]}
    gram_totals = {1: [40, 60], 2: [35, 50], 3: [0, 0], 4: [0, 0]}
    scorer = langid.Scorer(langid.Model(["de", "en"], counts, totals, grams, gram_totals))

    def centred(c, total, n):
        logs = [math.log((x + 0.5) / (t + 0.5 * (n + 1))) for x, t in zip(c, total)]
        return [x - sum(logs) / 2 for x in logs]

    def value(word):
        if word in counts:
            return centred(counts[word], totals, len(counts))
        for n in (4, 3, 2, 1):
            marked = f"^{word}$" if n > 1 else word
            found = [marked[i : i + n] for i in range(len(marked) - n + 1) if marked[i : i + n] in grams]
            if found:
                each = [centred(grams[g], gram_totals[n], sum(len(g) == n for g in grams)) for g in found]
                return [sum(x) / len(each) for x in zip(*each)]
        return [0.0, 0.0]

    for text in ("der hund", "the dog der", "hundu", "hat", "xyz", "der the xyz uh hu"):
        total = [sum(x) for x in zip(*map(value, text.split()))]
        best = max(range(2), key=lambda i: (total[i], -i))
        score = 1 / sum(math.exp((t - total[best]) / max(1, len(text.split()) / 20)) for t in total)
        assert scorer.predict(text) == (["de", "en"][best], pytest.approx(score, rel=1e-4))


def test_models_of_empty_tables(spark, nothing):
    train = spark.createDataFrame([(1, "der hund", "de", 1), (2, "the dog", "en", 0)], "doc_id long, text string, lang string, toxic int")
    assert langid.identify(nothing, langid.fit(train)).collect() == []
    assert toxicity.score(nothing, toxicity.fit(train)).collect() == []


def test_toxicity_scores_are_the_lexicon_restated():
    """Weights of matches outside exceptions for 100 words, on the curve."""
    import math

    lexicon = toxicity.Lexicon({" zork": 2.0, " blat ": 3.0}, {"the zorkian"}, 1.5, -4.0)
    automaton = lexicon.automaton()
    for text, weights, words in (("zork and blat", 5.0, 3), ("so the zorkian blats", 0.0, 4), ("zorking zork blat the zorkian", 7.0, 5), ("", 0.0, 0)):
        folded = toxicity.fold(text)
        want = math.log1p(100 * weights / (folded.count(" ") + 9)) if weights else 0.0
        found = toxicity.density(folded, automaton, lexicon.exceptions)
        assert found == pytest.approx(want) and lexicon.score(found) == pytest.approx(1 / (1 + math.exp(4.0 - 1.5 * want)))
        assert folded.count(" ") == words + 1


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.queries()["op7_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    caught = sum(r.predicted for r in got if r.toxic) / sum(r.toxic for r in got)
    wrong = sum(r.predicted for r in got if not r.toxic) / sum(1 - r.toxic for r in got)
    assert caught >= 0.9 and wrong <= 0.02


def test_folding():
    assert toxicity.fold("Idi0t, 1d10t IDІОT ídíot") == " idiot idiot idiot idiot "
    assert toxicity.fold("in 2024 a 10 b") == " in 2024 a 10 b "
    assert toxicity.fold(None) == toxicity.fold("") == " "
    assert toxicity.fold("wow!! id!ot! (4ss) a$$ho1e !!") == " wow idiot ass asshoie "


def test_folding_takes_linear_time():
    import time

    for word in ("x" * 1_000_000, "x1" * 500_000, "1" * 1_000_000, "a!" * 500_000, "!" * 1_000_000, "a" * 500_000 + "1" * 500_000):
        began = time.perf_counter()
        toxicity.fold(word)
        assert time.perf_counter() - began < 2


def test_toxicity_learns_stems_and_exceptions(spark, docs):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    rows = []
    for i in range(400):
        text = [word() for _ in range(60)]
        if i % 4 == 0:
            text[rnd.randint(1, 50)] = "zork" + word()
        elif i % 20 == 1:
            text[10:12] = ["the", "zorkian"]  # a phrase of clean texts
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    lexicon = toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
    assert any(e.startswith(" zork") and len(e) <= 6 for e in lexicon.weights) and "the zorkian" in lexicon.exceptions
    trial = spark.createDataFrame([(1, "a z0rkabc b"), (2, "so the zorkian came"), (3, "calm words"), (4, None), (5, "")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.score(trial, lexicon).collect()} == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    out = toxicity.score(docs, lexicon)
    assert out.count() == docs.count() and out.where("score IS NULL OR score NOT BETWEEN 0 AND 1").count() == 0
    none = toxicity.fit(spark.createDataFrame([], "doc_id long, text string, toxic int"))
    assert toxicity.score(docs, none).where("score <> 0").count() == 0


def library(path):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_token_counts_match_the_library(spark, docs):
    own = library(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(2)
    made = ["".join(rnd.choice([" ", " ", "\n", "a", "é", "1", "'s", ".", "<|endoftext|>", "\t", "　", "the", "\x1c", "Word"]) for _ in range(rnd.randint(0, 12))) for _ in range(1500)]
    texts = [*ODD, *made, *(r.text for r in docs.collect()), None]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id int, text string, n_bytes int")
    for r in tokencount.count_tokens(df).collect():
        want = len(own.encode(texts[r.doc_id] or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((texts[r.doc_id] or "").encode()), want, want > 1024)
    assert tokencount.count_tokens(df.limit(0)).collect() == []


def test_counts_by_a_sentencepiece_model(spark, docs, pieces):
    texts = [*ODD, *(r.text for r in docs.collect()), None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in tokencount.count_tokens(df, "piece_bpe_32k.model").collect():
        want = len(pieces.encode(texts[r.doc_id] or ""))
        assert (r.n_tokens, r.over_limit) == (want, want > 1024)


def test_long_texts_are_counted_in_windows():
    import pyarrow as pa

    path = public_tokenizers.path("byte_bpe_50k.json")
    own = tokencount.counter(path)
    texts = [" ".join(f"w{i * i}" for i in range(4000)), None, "x", "no" * 5000, "a\n\nb  c " * 900]
    n_bytes, n_tokens = tokencount.count_batch(pa.array(texts), own.count, 2000)
    assert n_tokens == [len(library(path).encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert all("".join(tokencount.split_safely(t or "", 100)) == (t or "") for t in texts)


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.mark.parametrize("giant,chunk,block", [(48_000, 16_000, 256), (60, 40, 3)])
def test_sentencepiece_matches_the_library(spark, docs, pieces, giant, chunk, block):
    rnd = random.Random(5)
    made = ["".join(rnd.choice("thein ing▁ 漢é🙂\n  abcdeost") for _ in range(rnd.randint(1, 400))) for _ in range(80)]
    texts = [*ODD, *made, *(r.text for r in docs.collect() if r.text is None or len(r.text) < 5000), ODD[-1], None]
    df = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id int, text string, ids string")
    out = spm.decode(spm.encode(df, giant=giant, chunk=chunk, block=block))
    got = out.collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        if t is None:
            assert r.ids is None and r.decoded is None
        else:
            assert list(r.ids) == pieces.encode(t)
            assert r.decoded == t.replace("▁", " ")  # an exact round trip but for the mark itself
    assert spm.encode(df.limit(0)).collect() == []


def test_giants_of_the_query_go_through_the_scan(spark, pieces, tmp_path, monkeypatch):
    """A table with a tenth of giants, through the query itself."""
    rnd = random.Random(8)
    vocabulary = ["".join(rnd.choice("abcdefghilmnorst") for _ in range(rnd.randint(1, 11))) for _ in range(3000)]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", " ", " ", "  ", "\n", ". ", "é", "▁"]) for _ in range(n))
    rows = [(i, text(9000 if i % 10 == 0 else 30)) for i in range(40)] + [(50, "ab" * 30_000), (51, " " * 60_000), (52, "漢" * 50_000), (53, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    giants = []
    scan = spm._encode_giants
    monkeypatch.setattr(spm, "_encode_giants", lambda texts, *a: giants.append(texts.count()) or scan(texts, *a))
    got = {r.doc_id: r for r in spm.op8_sentencepiece(spark, str(tmp_path)).collect()}
    assert giants == [7] and sorted(got) == [i for i, _ in rows]
    for i, t in rows[:-1]:
        assert list(got[i].ids) == pieces.encode(t) and got[i].n_tokens == len(got[i].ids) and got[i].round_trip


def unigram_model(path, scores):
    """A model file of these pieces."""
    import struct

    def field(number, kind, body):
        size, out = len(body), bytearray([number << 3 | kind])
        while kind == 2 and size > 127:
            out.append(size & 127 | 128)
            size >>= 7
        return bytes(out) + (bytes([size]) if kind == 2 else b"") + body

    def piece(name, score, kind):
        return field(1, 2, field(1, 2, name.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))

    pieces = [piece("<unk>", 0.0, 2), piece("<s>", 0.0, 3), piece("</s>", 0.0, 3), *(piece(p, s, 1) for p, s in scores.items())]
    trainer = field(2, 2, field(3, 0, b"\x01"))
    normalizer = field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01"))
    path.write_bytes(b"".join(pieces) + trainer + normalizer)
    return str(path)


def test_the_scan_finds_the_best_path_of_a_unigram_model(spark, tmp_path):
    import sentencepiece

    rnd = random.Random(4)
    pieces = {"▁": -2.0} | {c: -3.0 - i / 8 for i, c in enumerate("abcde")}
    while len(pieces) < 60:
        p = "".join(rnd.choice("abcde▁") for _ in range(rnd.randint(2, 5)))
        pieces.setdefault(p, -rnd.randint(20, 90) / 8 - len(pieces) / 1024)  # sums are exact in floats
    path = unigram_model(tmp_path / "own.model", pieces)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["".join(rnd.choice("abcde abcde abcdezq") for _ in range(rnd.randint(1, 300))) for _ in range(40)] + ["", "zzzz" * 30, None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    own = spm.codec(path)
    assert own.unigram and own.scans and not own.splits
    got = {r.doc_id: r.ids for r in spm.encode(df, path=path, giant=40, chunk=25, block=3).collect()}
    score = lambda ids: sum(pieces.get(library.id_to_piece(i), 0) for i in ids)
    for i, t in enumerate(texts):
        if t is None:
            assert got[i] is None
        else:
            want = library.encode(t)
            assert list(got[i]) == want or score(got[i]) == pytest.approx(score(want)) and library.decode(list(got[i])) == library.decode(want)
    exact = sum(list(got[i]) == library.encode(t) for i, t in enumerate(texts) if t is not None)
    assert exact >= 40


def test_decoding_of_any_ids(spark, pieces):
    rows = [(1, [3 + 0xC3]), (2, []), (3, None), (4, pieces.encode("a é")), (5, [1, 2, 0])]
    got = {r.doc_id: r.decoded for r in spm.decode(spark.createDataFrame(rows, "doc_id int, ids array<int>")).collect()}
    assert got[1] == "�" and got[2] == "" and got[3] is None and got[4] == "a é"


def test_max_plus_scan():
    import numpy as np

    rng = np.random.default_rng(3)
    shapes = [1, 4, 3, 5, 2]
    matrices = [rng.integers(0, 9, (a, b)).astype(float) for a, b in zip(shapes, shapes[1:])]
    a, b, c, d = matrices
    whole = spm.max_plus(spm.max_plus(a, b), spm.max_plus(c, d))
    assert (whole == spm.max_plus(a, spm.max_plus(b, spm.max_plus(c, d)))).all()
    best = max(itertools.product(*map(range, shapes)), key=lambda s: sum(m[s[i], s[i + 1]] for i, m in enumerate(matrices)))
    states = spm.scan(matrices, 0, best[-1])
    assert sum(m[states[i], states[i + 1]] for i, m in enumerate(matrices)) == whole.max()


def test_targets():
    assert mixing.targets({"a": 100, "b": 100, "c": 100, None: 100}, 400) == {"a": pytest.approx(400 * 5 / 13), "b": pytest.approx(800 / 13), "c": pytest.approx(400 / 13), None: pytest.approx(2000 / 13)}
    capped = mixing.targets({"a": 10, "b": 1000}, 1010)
    assert capped["a"] == 30 and capped["b"] == pytest.approx(980)
    assert mixing.targets({}, 0) == {}


def test_flow_is_cheapest():
    """Against all ways to send whole words."""
    supply, demand = [(2, [0]), (2, [0, 1]), (1, [1])], [4.0, 4.0]
    flow = mixing.min_cost_flow(supply, demand, 3)
    taken = [sum(f.values()) for f in flow]
    cost = lambda size, words: sum(min(size, max(0, words - k * size)) * k * k for k in range(3))
    best = min(
        sum(cost(s, sum(g)) for (s, _), g in zip(supply, ((a, 0), (b, c), (0, d))))
        for a, b, c, d in itertools.product(range(7), range(7), range(7), range(4))
        if a + b == 4 and c + d == 4 and b + c <= 6
    )
    assert sum(taken) == pytest.approx(8) and sum(cost(s, t) for (s, _), t in zip(supply, taken)) == pytest.approx(best)


def test_mix_comes_near_its_targets(spark):
    rnd = random.Random(7)
    rows = [(i, "w " * rnd.randint(1, 60), rnd.choice(["a", "b", "c", None, "b"])) for i in range(3000)] + [(9000, None, "a"), (9001, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    once = mixing.mix(df, F.array("source"))
    got = once.collect()
    sizes = {s: sum(len((t or "").split()) for _, t, x in rows if x == s) for s in ("a", "b", "c", None)}
    want = mixing.targets(sizes, sum(sizes.values()))
    for s in sizes:
        own = [r for r in got if r.source == s]
        assert sum(r.taken for r in own) == pytest.approx(want[s], rel=0.01)
        assert {(r.source_size, round(r.target, 6)) for r in own} == {(sizes[s], round(want[s], 6))}
    assert all(r.taken == r.size * r.copies and 0 <= r.copies <= 3 for r in got)
    again = mixing.mix(df.repartition(9), F.array("source")).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_of_overlapping_sources(spark):
    rows = [(i, "w w w w", ["a"] if i % 3 else ["a", "b"]) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    got = mixing.mix(df, F.col("sources")).collect()
    assert sum(r.taken for r in got) == pytest.approx(3600, rel=0.01)
    assert max(r.copies for r in got) <= 3


def test_mix_of_no_sources(spark):
    rows = [(1, "a b", ["x"]), (2, "c d e", None), (3, "f", []), (4, "g h", [None]), (5, "i", ["x", "x"])]
    df = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    got = {r.doc_id: (r.size, r.source_size, r.target, r.copies, r.taken) for r in mixing.mix(df, F.col("sources")).collect()}
    assert got[2] == (3, 0, 0.0, 0, 0) and got[3] == (1, 0, 0.0, 0, 0)
    assert got[1][1:3] == (3, pytest.approx(9 * 5 / 7)) and got[4][1:3] == (2, pytest.approx(9 * 2 / 7))


def test_every_pattern_goes_through_the_flow(spark, monkeypatch):
    seen, flow = [], mixing.min_cost_flow
    monkeypatch.setattr(mixing, "min_cost_flow", lambda supply, *a: seen.extend(supply) or flow(supply, *a))
    got = mixing.op10_source_mix(spark, "/root/testdata/sf0.001")
    sizes = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    assert sorted(n for n, _ in seen) == sorted(sizes.values()) and len(seen) == len(sizes)


def test_a_hundred_thousand_patterns_take_a_minute_at_most():
    rnd = random.Random(2)
    supply = [(rnd.randint(1, 50), [f"s{i}"]) for i in range(99_000)] + [(rnd.randint(1, 50), [f"t{i // 10}_{rnd.randint(0, 3)}", f"t{i // 10}_x"]) for i in range(1000)]
    demand = {s: float(rnd.randint(1, 120)) for _, of in supply for s in of}
    began = time.perf_counter()
    got = mixing.transport(supply, demand)
    assert time.perf_counter() - began < 60
    for (n, of), given in zip(supply[:99_000], got):
        assert given == {of[0]: pytest.approx(min(3 * n, demand[of[0]]))}


def test_transport_serves_single_sources_as_the_flow_does():
    rnd = random.Random(3)
    supply = [(rnd.randint(1, 50), [s]) for s in ("a", "b", None)] + [(20, ["c", "d"]), (9, ["d"]), (5, ["c"])]
    demand = {"a": 20.0, "b": 3.0, None: 60.0, "c": 30.0, "d": 25.0}
    names = list(demand)
    flow = mixing.min_cost_flow([(n, [names.index(s) for s in of]) for n, of in supply], list(demand.values()))
    got = mixing.transport(supply, demand)
    assert [sum(x.values()) for x in got] == pytest.approx([sum(x.values()) for x in flow])


def brute_selection(rows, ranks, wanted, share=mixing.NEAR):
    """Documents of one source in the order of their hashes, up to `wanted` words, then sweeps among those that still fit."""
    taken, left, begin = set(), wanted, 0
    for sweep in range(mixing.SWEEPS):
        most, cut, crossing = left, 1 << (mixing.LEVELS * mixing.BITS), 0
        for rank in sorted({ranks[i] for i in rows if ranks[i] >= begin}):
            words = sum(rows[i] for i in rows if ranks[i] == rank and rows[i] <= most)
            if words > left:
                cut, crossing = rank, words
                break
            left -= words
        if sweep == mixing.SWEEPS - 1 and 0 < crossing < 2 * left:
            cut, left = cut + 1, 0
        taken |= {i for i in rows if begin <= ranks[i] < cut and rows[i] <= most}
        begin = cut
        if left <= share * wanted or cut >= 1 << (mixing.LEVELS * mixing.BITS):
            break
    return taken


def test_selection_matches_brute_force(spark):
    rnd = random.Random(12)
    rows = [(i, "w " * rnd.choice([1, 5, 30, 200]), rnd.choice(["a", "b", "c"])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    ranks = {r.doc_id: r.k for r in df.select("doc_id", mixing._rank(7, F.col("doc_id"), F.lit(None).cast("string")).alias("k")).collect()}
    got = {r.doc_id: r for r in mixing.mix(df, F.array("source")).collect()}
    for s in "abc":
        sizes = {i: len(t.split()) for i, t, x in rows if x == s}
        target = got[next(iter(sizes))].target
        whole = int((target + 1e-6) // sum(sizes.values()))
        partial = target - whole * sum(sizes.values())
        want = brute_selection(sizes, ranks, partial) if whole < 3 and partial > 0.5 else set()
        assert {i: got[i].copies for i in sizes} == {i: whole + (i in want) for i in sizes}


def test_mix_of_odd_rows(spark, docs, nothing):
    got = mixing.mix(docs, F.array("source")).collect()
    assert len(got) == docs.count() and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(nothing, F.array("source")).collect() == []
