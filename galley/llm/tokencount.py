"""Token counts: batch encoding inside Arrow functions that return lengths only.

The library's own encoder gives every count. What is built round it:

* a text is cut at *safe boundaries*, places where the tokenizer's splitting rule always starts
  a new pre-token, so that counts of the parts add up to the count of the whole. For byte-level
  BPE with the usual splitting rule a single space between two characters that are not white
  space is such a place, and so are both sides of a single line feed between two such;
* the parts that recur (words with the space before them) are encoded once and remembered, in a
  table of bounded size for each worker; only unseen parts go to the encoder, in one batch call;
* rows are taken in groups of about equal bytes, and a text over the group size is worked off in
  windows that end at safe boundaries, so memory does not follow the longest text.

A .model file is counted by `sentencepiece` through `spm.Codec`, text by text, units of BPE models once
for a batch.

Special strings inside texts are handled as the library's default does (they become the special
token); no tokens are added. Defined cases: null counts as an empty text; empty: 0 tokens, not
over the limit. Repeated rows are counted one by one. An empty table gives an empty result. Other
columns are not returned, whatever their names.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from galley.llm import spm

GROUP_BYTES = 1 << 20
#: Remembered parts in a worker, and the longest of them.
MEMO_PARTS = 800_000
MEMO_LENGTH = 64

#: White space to any of the libraries, but the space and the line feed.
_ODD_SPACE = re.compile(r"[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
_RUNS = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S)(?= \S)")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_safely(text: str, window: int) -> Iterator[str]:
    """The text in windows of at least `window` characters that end at safe boundaries."""
    begin, n = 0, len(text)
    while n - begin > window:
        m = _SAFE.search(text, begin + window)
        # "\S \S" is looked up in the text itself, so what stands before the window counts.
        if not m or m.start() >= n:
            break
        yield text[begin : m.start()]
        begin = m.start()
    yield text[begin:]


def parts(text: str) -> tuple[list[str], list[str], int]:
    """(parts as they stand, parts that a space precedes, single line feeds) of a text; safe to count one by one."""
    if not text:
        return [], [], 0
    if _ODD_SPACE.search(text) or _RUNS.search(text) or text[0] in " \n" or text[-1] in " \n":
        return _SAFE.split(text), [], 0
    if "\n" not in text:
        first, *rest = text.split(" ")
        return [first], rest, 0
    own, after = [], []
    lines = text.split("\n")
    for line in lines:
        first, *rest = line.split(" ")
        own.append(first)
        after += rest
    return own, after, len(lines) - 1


class Counter:
    """Counts by `encode`, which takes a list of strings and returns their token counts."""

    def __init__(self, encode: Callable[[list[str]], list[int]]):
        self.encode, self.own, self.after = encode, {}, {}
        self.line_feed = encode(["\n"])[0]

    def _known(self, memo: dict[str, int], found: Iterable[str], before: str) -> dict[str, int]:
        """A table with all that is found: the memo, or for long parts one that is not kept."""
        found = set(found)
        unseen = [x for x in found if x not in memo]
        if not unseen:
            return memo
        if len(memo) + len(unseen) > MEMO_PARTS:
            memo.clear()
            unseen = list(found)
        counts = dict(zip(unseen, self.encode([before + x for x in unseen])))
        if all(len(x) <= MEMO_LENGTH for x in unseen):
            memo |= counts
            return memo
        memo |= {x: n for x, n in counts.items() if len(x) <= MEMO_LENGTH}
        return memo | {x: counts[x] for x in counts if len(x) > MEMO_LENGTH}

    def count(self, texts: list[str]) -> list[int]:
        split = [parts(t) for t in texts]
        own = self._known(self.own, (x for p in split for x in p[0]), "")
        after = self._known(self.after, (x for p in split for x in p[1]), " ")
        return [sum(map(own.__getitem__, a)) + sum(map(after.__getitem__, b)) + n * self.line_feed for a, b, n in split]


class PieceCounter:
    """Counts by a SentencePiece model; its texts are not cut."""

    def __init__(self, path: str):
        self.codec = spm.codec(path)

    def count(self, texts: list[str]) -> list[int]:
        return pc.list_value_length(self.codec.encode(pa.array(texts, pa.string()))).to_pylist()


_counters: dict[str, Counter | PieceCounter] = {}


def counter(path: str) -> Counter | PieceCounter:
    """One for each worker and vocabulary; a .json file by `tokenizers`, a .model file by `sentencepiece`."""
    if path not in _counters:
        if path.endswith(".model"):
            _counters[path] = PieceCounter(path)
            return _counters[path]
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        _counters[path] = Counter(lambda texts: [len(e) for e in t.encode_batch_fast(texts, add_special_tokens=False)])
    return _counters[path]


def count_batch(texts: pa.Array, count: Callable[[list[str]], list[int]], group_bytes: int = GROUP_BYTES, cut: bool = True) -> tuple[list[int], list[int]]:
    """(bytes, tokens) of each text, worked off in groups of about `group_bytes`; cut: longer texts in windows."""
    n_bytes = pc.fill_null(pc.binary_length(texts.cast(pa.large_binary())), 0).to_pylist()
    n_tokens, begin = [0] * len(n_bytes), 0
    while begin < len(n_bytes):
        end, held = begin + 1, n_bytes[begin]
        while end < len(n_bytes) and held + n_bytes[end] <= group_bytes:
            held += n_bytes[end]
            end += 1
        if held > group_bytes and cut:  # one long text
            n_tokens[begin] = sum(count([w])[0] for w in split_safely(texts[begin].as_py(), group_bytes // 4))
        else:
            n_tokens[begin:end] = count([t or "" for t in texts.slice(begin, end - begin).to_pylist()])
        begin = end
    return n_bytes, n_tokens


def count_tokens(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", path: str | None = None, limit: int = 1024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row. path: the vocabulary's file, as executors see it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path or tokenizer_path(vocabulary))
        for batch in batches:
            n_bytes, n_tokens = count_batch(batch.column(1), own.count, cut=isinstance(own, Counter))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())],
                names=[key, "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
