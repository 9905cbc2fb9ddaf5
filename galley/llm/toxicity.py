"""Toxicity: a weighted lexicon matched by Aho-Corasick, with exception phrases, normalised by length.

Texts are folded first: lower case, homoglyphs of other scripts to Latin letters, accents off,
digits and signs inside words to the letters they stand for, anything else to one space. Lexicon
entries are whole words or beginnings of words of the folded text; an automaton finds all entries
of a text in one pass. The weights of its matches are added up, but for matches inside an
exception phrase (two words that are found in clean texts only), and divided by the number of
words; a logistic curve turns this density into a score from 0 to 1.

Learning, on a bounded sample of labelled rows (TRAIN_DOCS, by a hash of doc_id; near copies,
texts with the same smallest 5-word shingle hash, count once): an entry's rate is its mean share
of the words of a text. Entries are candidates if their rate in toxic texts is more than ODDS times
that in clean ones. A greedy cover takes, one by one, the candidate that explains most toxic texts
not yet explained (at least one of DENSE words is its match), so that words that merely keep company
with an entry stay out; candidates that many toxic texts and next to no clean ones hold are taken
too. Weights are the logarithms of the ratios of rates. The model is bounded too: of the features
of toxic texts the FEATURES with the largest shares are looked at, the CANDIDATES of highest ratio
may become entries, ENTRIES and EXCEPTIONS are kept at most. These bound the fitting only; all
texts are scored, whole.

Defined cases: null and empty texts have density 0 and get the curve's lowest score. Without
labels of both kinds every score is 0. An empty table gives an empty result. Very long texts and
words are folded and matched whole, in linear time. Extra columns are not returned, whatever their
names. Repeated rows are scored one by one; labels that repeat or
contradict each other for one doc_id count as toxic if any does; rows without key are scored but
never learned from.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TRAIN_DOCS = 12_000
FEATURES, CANDIDATES, ENTRIES, EXCEPTIONS = 150_000, 5_000, 1_000, 1_000
ODDS, PURE_ODDS, PURE_TEXTS = 8.0, 40.0, 6
DENSE = 200
STEMS = range(4, 10)

#: Letters of other scripts that look like Latin ones.
_LOOKS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "ғ": "f", "һ": "h", "н": "h", "і": "i", "ї": "i", "ј": "j", "к": "k",
    "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "г": "r", "ѕ": "s", "т": "t", "ц": "u", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ϲ": "c", "ε": "e", "η": "n", "ι": "i", "κ": "k", "μ": "u", "ν": "v", "ο": "o", "ρ": "p", "σ": "o", "τ": "t",
    "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss", "æ": "ae", "œ": "oe", "ɑ": "a", "ɡ": "g",
}
_HOMOGLYPHS = str.maketrans(_LOOKS)
_SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"})
#: A run of letters, digits and signs that holds a digit or sign; what makes it a spelling: signs between letters,
#: or digits at its beginning with two letters behind. None of them looks at a character more than a few times.
_SIGNED = re.compile(r"(?<![a-z0-9@$!|+])[a-z]*+[0-9@$!|+][a-z0-9@$!|+]*+")
_BETWEEN = re.compile(r"[a-z][0-9@$!|+]+[a-z]")
_BEFORE = re.compile(r"[0-9@$]{1,2}[a-z]{2}")
_OTHER = re.compile(r"[\W_]+")


def _spelled(run: re.Match) -> str:
    """The letters that a run stands for; signs at its ends are punctuation."""
    own = run[0].strip("!|+")
    return run[0].replace(own, own.translate(_SIGNS)) if _BETWEEN.search(own) or _BEFORE.match(own) else run[0]


def fold(text: str | None) -> str:
    """Folded words with a space before, between and behind them."""
    if not text:
        return " "
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.translate(_HOMOGLYPHS))
        if not text.isascii():
            text = "".join(c for c in text if not unicodedata.combining(c)).translate(_HOMOGLYPHS)
    text = _SIGNED.sub(_spelled, text)
    return f" {_OTHER.sub(' ', text).strip()} ".replace("  ", " ")


def features(folded: str) -> dict[str, float]:
    """Whole words (` word `) and beginnings of words (` stem`) with their share of the words."""
    words = Counter(folded.split())
    each = 1 / max(1, sum(words.values()))
    found: dict[str, float] = {}
    for w, n in words.items():
        if not w.isdigit():
            for f in (f" {w} ", *(f" {w[:k]}" for k in STEMS if len(w) >= k)):
                found[f] = found.get(f, 0.0) + n * each
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    slope: float = 0.0
    offset: float = -20.0

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            out.add_word(entry, (len(entry), weight))
        if self.weights:
            out.make_automaton()
        return out

    def score(self, density: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * density + self.offset)))) if self.weights else 0.0


def _phrases(folded: str, at: int) -> list[str]:
    """The word that begins behind the space at `at`, with the word before it and with the word behind it."""
    end = folded.index(" ", at + 1)
    before = folded.rfind(" ", 0, at) if at else -1
    behind = folded.find(" ", end + 1)
    return [p for p in (folded[before + 1 : end] if before >= 0 else "", folded[at + 1 : behind] if behind > 0 else "") if p]


def matches(folded: str, automaton) -> Iterator[tuple[int, float]]:
    """(where the word's space stands, weight)."""
    if len(automaton):
        for last, (length, weight) in automaton.iter(folded):
            yield last - length + 1, weight


def density(folded: str, automaton, exceptions: set[str]) -> float:
    """log(1 + weights for 100 words)."""
    total = 0.0
    for at, weight in matches(folded, automaton):
        if not exceptions or not any(p in exceptions for p in _phrases(folded, at)):
            total += weight
    return math.log1p(100 * total / (folded.count(" ") + 9)) if total > 0 else 0.0


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """(text, toxic), near copies once."""
    n = labelled.count()
    kept = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(max(1, -(-n // rows)))) == 0)
    w = F.split(F.lower("text"), r"\s+")
    sketch = F.array_min(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("w", i, 5))))
    return kept.withColumn("w", w).withColumn("sketch", sketch).groupBy("sketch", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def _tally(known):
    """A function for mapInArrow: (feature, texts, sum of shares in millionths) of a task, of all features or those of `known`."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, shares = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            names = list(texts)
            return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([texts[f] for f in names], pa.int64()), pa.array([shares[f] for f in names], pa.int64())], names=["f", "texts", "shares"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for f, share in features(fold(text)).items():
                    if known is None or f in known.value:
                        texts[f] += 1
                        shares[f] += round(share * 1e6)
                if len(texts) > 200_000:
                    yield rows()
                    texts.clear()
                    shares.clear()
        yield rows()

    return run


def _cover(texts: list[list[str]], weights: dict[str, float], least: int) -> dict[str, float]:
    """Greedy: the entry with the most weighted texts not yet covered, until none covers `least` more."""
    holders: dict[str, set[int]] = {}
    for i, found in enumerate(texts):
        for f in found:
            holders.setdefault(f, set()).add(i)
    open_, out = set(range(len(texts))), {}
    while holders and len(out) < ENTRIES:
        gain = {f: len(own & open_) * weights[f] for f, own in holders.items()}
        most = max(gain.values())
        best = max((f for f in gain if gain[f] >= 0.97 * most), key=lambda f: (f.endswith(" "), len(f), f))  # of near equals the narrowest
        if len(holders[best] & open_) < least:
            break
        out[best] = weights[best]
        open_ -= holders.pop(best)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) by Newton steps with a light ridge."""
    a = np.column_stack([x, np.ones(len(x))])
    w, ridge = np.zeros(2), np.array([1e-2, 1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def fit(labelled: DataFrame, train_docs: int = TRAIN_DOCS) -> Lexicon:
    """labelled: doc_id, text and toxic (0 or 1), none null."""
    sample = _sample(labelled, train_docs).persist()
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        sample.unpersist()
        return Lexicon({})
    sc = sample.sparkSession.sparkContext
    least = 2 if bad < 100 else 3
    tally = "f string, texts long, shares long"
    sums = [F.sum("texts").alias("texts"), F.sum("shares").alias("shares")]
    toxic, clean = (sample.where(F.col("toxic") == k).select("text") for k in (1, 0))
    held = toxic.mapInArrow(_tally(None), tally).groupBy("f").agg(*sums).where(F.col("texts") >= least).orderBy(F.desc("shares"), "f").limit(FEATURES).collect()
    known = sc.broadcast({r["f"] for r in held})  # FEATURES strings
    other = {r["f"]: r for r in clean.mapInArrow(_tally(known), tally).groupBy("f").agg(*sums).collect()}  # FEATURES rows
    odds, pure = {}, set()
    for r in held:
        o = other.get(r["f"])
        ratio = ((r["shares"] + 2500) / (bad + 1)) / (((o["shares"] if o else 0) + 2500) / (good + 1))
        if ratio > ODDS:
            odds[r["f"]] = math.log(ratio)
            if ratio > PURE_ODDS and r["texts"] >= PURE_TEXTS and 50 * (o["texts"] if o else 0) <= r["texts"]:
                pure.add(r["f"])
    weights = dict(sorted(odds.items(), key=lambda x: (-x[1], x[0]))[:CANDIDATES]) if len(odds) > CANDIDATES else odds
    shared = sc.broadcast(set(weights))

    def candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(f for f, share in features(fold(t)).items() if share * DENSE >= 1 and f in shared.value) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.string()))], names=["f"])

    texts = [r["f"] for r in toxic.mapInArrow(candidates, "f array<string>").collect()]  # TRAIN_DOCS rows at most
    entries = _cover(texts, weights, least)
    for f in sorted(pure & weights.keys(), key=lambda f: (-len(f), f)):
        if not any(f.startswith(e) or e.startswith(f) for e in entries):
            entries[f] = weights[f]
    lexicon = Lexicon(entries)
    lexicon.exceptions = _exceptions(sample, lexicon)
    points = sample.select(F.col("toxic").cast("long").alias("doc_id"), "text").mapInArrow(_scoring(sample.sparkSession, lexicon, "doc_id", "density"), "doc_id long, density double").collect()
    lexicon.slope, lexicon.offset = _logistic(np.array([p["density"] for p in points]), np.array([p["doc_id"] for p in points], float))
    sample.unpersist()
    return lexicon


def _exceptions(sample: DataFrame, lexicon: Lexicon) -> set[str]:
    """Two-word phrases round an entry that three clean texts of the sample hold and no toxic one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            rows = []
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded = fold(text)
                rows += [(p, int(toxic)) for p in {p for at, _ in matches(folded, automaton) for p in _phrases(folded, at)}]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int32())], names=["p", "toxic"])

    found = sample.mapInArrow(run, "p string, toxic int").groupBy("p").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    return {r["p"] for r in found.where("bad = 0 AND n >= 3").orderBy(F.desc("n"), "p").limit(EXCEPTIONS).collect()}


def _scoring(spark: SparkSession, lexicon: Lexicon, key: str, name: str, curve: bool = False):
    shared = spark.sparkContext.broadcast(lexicon)  # ENTRIES and EXCEPTIONS strings

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        automaton = own.automaton()
        for batch in batches:
            found = [density(fold(t.as_py()), automaton, own.exceptions) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.score(x) for x in found] if curve else found, pa.float64())], names=[key, name])

    return run


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    out = docs.select(key, text).mapInArrow(_scoring(docs.sparkSession, lexicon, key, "score", True), f"`{key}` {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    train = docs.where(~held_out & F.col("text").isNotNull()).join(labels, "doc_id")
    return score(docs, fit(train)).select("doc_id", held_out.alias("held_out"), "score", "predicted")
