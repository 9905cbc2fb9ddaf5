"""Quality rules as a short-circuit cascade, in DataFrame operations only.

A rule rejects a text. The cascade runs every rule alone on a sample, takes the time it needs
beyond a job that does nothing and the share it rejects, and orders the rules by rejections per
second, in classes of a power of four, within a class as they are given; in the one expression that
judges the corpus each rule is then evaluated only for texts that all rules before it let through.
The order changes the time and the name in `failed_rule`, never the verdict: a text is kept if no
rule rejects it. What several rules need (`Facts`) is computed once for a text.

Words are runs of characters other than space and U+0009 to U+000D; whole texts are judged.
Defined cases: a null or empty text has no word and fails `too_short`. Repeated rows are judged
one by one. Very long texts are judged whole. Extra columns are kept, whatever their names; `failed_rule` and `kept` replace columns of these names.
An empty table gives an empty result (the rules then keep their given order).
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm.columns import fresh

#: Texts on which costs and selectivities are measured, about, of all partitions. Only the order depends on them.
SAMPLE_ROWS = 1000
#: Times that a rule is timed; the best counts.
TRIALS = 2

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS, MARKS = "#*$%&|<>", "!?"
WINDOW = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` over `value`, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", -1), "")


def removed(text: Column, chars: str) -> Column:
    """Code points of `text` that are among `chars`."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def signs(text: Column) -> Column:
    """The symbols, marks and capitals of a text, in order."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"[^{SYMBOLS}{MARKS}\p{{Lu}}]+", "")


def lines(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)


def n_dup_lines(text: Column) -> Column:
    """Lines that hold a word and equal an earlier line of the text."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.instr(text, "\n") == 0, 0).otherwise(let(lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))))


def _covered(windows: Column) -> Column:
    """Words that lie in a window whose hash occurs twice or more; windows: hashes in order."""
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        def twin(k: Column) -> Column:
            own = F.get(s, k)["h"]
            return F.coalesce(F.get(s, k - 1)["h"] == own, F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == own, F.lit(False))

        at = F.filter(F.sequence(F.lit(0), F.size(s) - 1), twin)
        return F.sort_array(F.transform(at, lambda k: F.get(s, k)["i"]))

    def spread(p: Column) -> Column:
        return F.aggregate(
            p,
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n"), x.alias("last")),
            lambda a: a["n"],
        )

    return let(let(pairs, starts), spread)


def n_repeat_words(of: Column) -> Column:
    """`of`: an array of words. Words in 8-word windows that the text holds twice or more, the first included.

    Hashes of windows are made of those of their halves: of 2 words, of 4, of 8.
    """

    def twice(half: Column, n: int) -> Column:
        return F.transform(half, lambda x, i: F.xxhash64(x, F.get(half, i + n)))

    def count(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(_covered(windows))

    def windows(w: Column) -> Column:
        return let(twice(w, 1), lambda two: let(twice(two, 2), lambda four: F.slice(twice(four, 4), F.lit(1), F.size(four) - (WINDOW - 1))))

    return let(of, lambda w: F.when(F.size(w) <= WINDOW, 0).otherwise(let(windows(w), count)))


class Facts:
    """What rules need of a text, as columns; those that are given are there already, the rest are expressions."""

    def __init__(self, text: Column, **given: Column):
        self.text = F.coalesce(text, F.lit(""))
        vars(self).update(given)

    @cached_property
    def words(self) -> Column:
        return words(self.text)

    @cached_property
    def signs(self) -> Column:
        return signs(self.text)

    @cached_property
    def n_words(self) -> Column:
        return F.size(self.words).cast("long")

    @cached_property
    def word_chars(self) -> Column:
        return F.length(F.array_join(self.words, "")).cast("long")

    @cached_property
    def n_symbols(self) -> Column:
        return removed(self.signs, SYMBOLS).cast("long")

    @cached_property
    def n_dup_lines(self) -> Column:
        return n_dup_lines(self.text).cast("long")

    @cached_property
    def n_repeat_words(self) -> Column:
        return n_repeat_words(self.words).cast("long")


STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def facts(of: Column | Facts) -> Facts:
    return of if isinstance(of, Facts) else Facts(of)


def stats(text: Column | Facts) -> Column:
    """One struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all long)."""
    return F.struct(*[getattr(facts(text), name).alias(name) for name in STATS])


@dataclass(frozen=True)
class Rule:
    """`rejects` turns the text column, or its facts, into a boolean, never null, that is true for a rejected text."""

    name: str
    rejects: Callable[[Column | Facts], Column]


def _too_short(text: Column | Facts) -> Column:
    return facts(text).n_words < 20


def _repeated_windows(text: Column | Facts) -> Column:
    own = facts(text)
    return 100 * own.n_repeat_words > 30 * own.n_words


def _symbols(text: Column | Facts) -> Column:
    own = facts(text)
    return 10 * own.n_symbols > own.n_words


def _shouting(text: Column | Facts) -> Column:
    """Most letters that have case are capitals."""
    own = facts(text)
    small = lambda x: F.length(F.regexp_replace(x, r"[^\p{Ll}]+", ""))
    capitals = F.length(F.translate(own.signs, SYMBOLS + MARKS, ""))

    def more(n: Column) -> Column:
        begin = F.substring(own.text, F.lit(1), 4 * n + 64)  # as a rule its small letters already are as many; else the whole text decides
        return F.when(n == 0, F.lit(False)).when(small(begin) >= n, F.lit(False)).otherwise(n > small(own.text))

    return let(capitals, more)


def _marks(text: Column | Facts) -> Column:
    """More than one mark of exclamation or question to five words."""
    own = facts(text)
    return 5 * removed(own.signs, MARKS) > own.n_words


def _stutter(text: Column | Facts) -> Column:
    """More than a fifth of the words repeat the word before."""
    own = facts(text)
    return let(own.words, lambda w: 5 * F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1))) > F.size(w))


def _dup_lines(text: Column | Facts) -> Column:
    own = facts(text)
    return (own.n_dup_lines > 0) & (10 * own.n_dup_lines > 3 * F.size(F.split(own.text, "\n", -1)))


def _word_length(text: Column | Facts) -> Column:
    """The mean word is under 2 or over 20 characters."""
    own = facts(text)
    return (own.word_chars < 2 * own.n_words) | (own.word_chars > 20 * own.n_words)


BASE = (Rule("too_short", _too_short), Rule("repeated_windows", _repeated_windows))
METHOD = (
    Rule("symbols", _symbols),
    Rule("shouting", _shouting),
    Rule("marks", _marks),
    Rule("stutter", _stutter),
    Rule("dup_lines", _dup_lines),
    Rule("word_length", _word_length),
)


def order_rules(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text", sample_rows: int = SAMPLE_ROWS, given: Callable[[DataFrame], tuple[DataFrame, Facts]] | None = None) -> list[Rule]:
    """By rejections per second on a sample, most first. given: adds what the rules find computed already."""
    n = docs.count()
    sample = docs.select(F.col(text).alias("text"))
    sample, own = (given or (lambda df: (df, Facts(F.col("text")))))(sample.sample(min(1.0, sample_rows / n), 17) if n else sample)
    sample = sample.persist()

    def timed(rejected: Column) -> tuple[float, int]:
        best = math.inf
        for _ in range(TRIALS):
            began = time.perf_counter()
            found = sample.agg(F.count_if(rejected)).first()[0]
            best = min(best, time.perf_counter() - began)
        return best, found

    try:
        n = sample.count()
        if not n:
            return list(rules)
        nothing, _ = timed(F.length("text") < 0)
        gain = []
        for rule in rules:
            took, rejected = timed(rule.rejects(own))
            gain.append(round(math.log((rejected + 0.5) / (n + 1) / max(1e-3, took - nothing), 4)))
        return [r for _, r in sorted(zip(gain, rules), key=lambda x: -x[0])]
    finally:
        sample.unpersist()


def cascade(text: Column | Facts, ordered: list[Rule]) -> Column:
    """The first rule that rejects the text, null if none does; later rules are not evaluated."""
    out = None
    for rule in ordered:
        out = (F if out is None else out).when(rule.rejects(text), F.lit(rule.name))
    return F.lit(None).cast("string") if out is None else out


def with_words(docs: DataFrame, text: str = "text") -> tuple[DataFrame, Facts]:
    """`docs` with the words and signs of the text, computed once, and the facts that use them."""
    names = fresh(docs.columns, "words", "signs")
    docs = docs.withColumns({names[0]: words(F.col(text)), names[1]: signs(F.col(text))})
    return docs, Facts(F.col(text), words=F.col(names[0]), signs=F.col(names[1]))


def apply_rules(docs: DataFrame, rules: tuple[Rule, ...] = (*BASE, *METHOD), text: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """`docs` with failed_rule and kept."""
    ordered = order_rules(docs, rules, text, sample_rows, with_words)
    columns = [c for c in docs.columns if c not in ("failed_rule", "kept")]
    out, own = with_words(docs, text)
    out = out.withColumn("failed_rule", cascade(own, ordered)).select(*columns, "failed_rule")
    return out.withColumn("kept", F.col("failed_rule").isNull())


def _with_stats(docs: DataFrame) -> tuple[DataFrame, Facts]:
    """`docs` with the stats, and the facts that use them."""
    out, own = with_words(docs)
    out = out.withColumns({name: getattr(own, name) for name in STATS})
    return out, Facts(F.col("text"), words=own.words, signs=own.signs, **{name: F.col(name) for name in STATS})


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ordered = order_rules(docs, METHOD, given=_with_stats)
    out, own = _with_stats(docs)
    out = out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    failed = F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(own, ordered))
    return out.withColumn("kept", failed.isNull()).drop("text", "words", "signs")


#: The same counts and rules in plain SQL.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM d)
), rep AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, len(l) - len(list_distinct(l)) AS n, n_all
  FROM (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l, len(string_split(t, chr(10))) AS n_all FROM d)
), s AS (
  SELECT d.doc_id, t, w, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         lines.n::BIGINT AS n_dup_lines, lines.n_all, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         length(regexp_replace(t, '[^!?]+', '', 'g')) AS n_marks,
         length(regexp_replace(t, '[^\p{Lu}]+', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^\p{Ll}]+', '', 'g')) AS n_lower,
         len(list_filter(list_zip(w[1:len(w) - 1], w[2:len(w)]), lambda x: x[1] = x[2])) AS n_twins
  FROM s
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR n_upper > n_lower OR 5 * n_marks > n_words OR 5 * n_twins > n_words
            OR 10 * n_dup_lines > 3 * n_all OR word_chars < 2 * n_words OR word_chars > 20 * n_words) AS kept
FROM b
"""
