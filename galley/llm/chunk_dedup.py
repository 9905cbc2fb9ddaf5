"""Substring dedup by content-defined chunks (dedup_substrings), and exactly by windows of words (dedup_passages).

A gear hash rolls over the last 16 bytes of a text; where it falls under a threshold the text may be
cut, at the next beginning of a word. Cuts depend on nearby bytes alone, so an insertion moves the
chunks round it and no others. Chunks are compared by a 64-bit digest: of all documents that hold a
chunk, the one with the smallest doc_id owns it. In every other document, runs of neighbouring chunks
that smaller documents own are removed if they hold at least MIN_WORDS words. A chunk is about five
words long, so of a passage of over 50 words enough chunks are whole, and under one in a hundred such
passages is missed; up to about a chunk stays at each end, where it shares one with its surroundings. A run needs several equal digests in a row, so a chance collision removes nothing.

Only (digest, doc_id) pairs are shuffled, each once for a document: first into the smallest and
largest doc_id of each digest, combined before the shuffle, then against the digests that two
documents share. A digest with a third of all rows is one row for each task in the first step
and a skewed but splittable join key in the second. Texts are shuffled only if something goes from
them, as long as their ids are few enough for a broadcast.

dedup_passages removes passages to their true ends: every word of a document that stands in a run of
MIN_WORDS words which a document of smaller doc_id holds too, white space apart. Of each run of
MIN_WORDS words one shorter run is selected by the words alone (winnowing), so two documents that
share the long run share the selected one. Only long runs whose selected run stands in two documents
are hashed and shuffled. That takes twice the disk; the query and the pipeline go by chunks.

Defined cases: null and empty texts stay as they are. Rows without doc_id own nothing and stay.
Rows with one doc_id are one document: nothing is removed for what only they share; repeats
inside one document stay. A text may become empty; its row stays. Very long texts are worked on
whole. An empty table gives an empty result. The key must be an integer column. Extra columns are
kept, whatever their names; `repeats` and `removed_chars` replace columns of these names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.llm import hashing
from galley.llm.columns import fresh, integral
from galley.session import cut_lineage

#: Mean distance of possible cuts, the least, and the length at which a cut is forced, in bytes.
MEAN, LEAST, MOST = 16, 12, 512
#: Documents from which something goes, up to which their ids are broadcast to choose them.
BROADCAST_IDS = 300_000
#: A cut moves to the next word if that begins within so many bytes.
REACH = 64
MIN_WORDS = 20

_GEAR = np.random.Generator(np.random.PCG64(20240229)).integers(0, 1 << 32, 256, dtype=np.uint32)


def cuts(data: np.ndarray) -> np.ndarray:
    """Where chunks begin and the last one ends; data: the bytes of a text."""
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    h = _GEAR[data]
    for shift in (1, 2, 4, 8):  # the sum of gear[b[i - j]] << j over 16 bytes
        h[shift:] += h[:-shift] << np.uint32(shift)
    at = np.flatnonzero(h < np.uint32((1 << 32) // MEAN)) + 1
    at = at[np.diff(at, prepend=-LEAST) >= LEAST]
    space = hashing.SPACE[data]
    begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    if len(begins) and len(at):
        word = np.append(begins, n)[np.searchsorted(begins, at)]
        at = np.where(word - at <= REACH, word, at)
    at = np.unique(np.concatenate([[0], at[at < n], [n]]))
    gaps = np.diff(at)
    if gaps.max() > MOST:
        at = np.unique(np.concatenate([at, *[np.arange(a, a + g, MOST) for a, g in zip(at[:-1][gaps > MOST], gaps[gaps > MOST])]]))
    inside = (data[np.minimum(at, n - 1)] & 0xC0) == 0x80  # never inside a character
    while (inside & (at < n)).any():
        at = np.where(inside & (at < n), at + 1, at)
        inside = (data[np.minimum(at, n - 1)] & 0xC0) == 0x80
    return np.unique(at)


def chunks(text: str) -> tuple[bytes, np.ndarray, list[int]]:
    """(bytes, cuts, digest of each chunk without the white space round it)."""
    raw = text.encode("utf-8", "surrogatepass")
    at = cuts(np.frombuffer(raw, np.uint8))
    ends = at.tolist()
    return raw, at, [xxhash.xxh3_64_intdigest(raw[a:b].strip()) - (1 << 63) for a, b in zip(ends, ends[1:])]


def _pairs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [np.unique(np.array(chunks(text.as_py())[2], np.int64)) for text in batch.column(1)]
        docs = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(x) for x in own])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own) if own else docs), pa.array(docs)], names=["digest", "id"])


def remove_runs(text: str, owned: set[int], min_words: int) -> tuple[str, list[dict]]:
    """The text without runs of `owned` chunks, and the runs as code point offsets."""
    raw, at, digests = chunks(text)
    flags = np.array([0, *(d in owned for d in digests), 0], np.int8)
    edge = np.flatnonzero(np.diff(flags))
    kept, spans, end = [], [], 0
    for first, behind in zip(edge[::2].tolist(), edge[1::2].tolist()):
        a, b = int(at[first]), int(at[behind])
        if len(raw[a:b].split()) >= min_words:
            kept.append(raw[end:a])
            begin = (spans[-1]["end"] if spans else 0) + len(raw[end:a].decode("utf-8", "surrogatepass"))
            spans.append({"begin": begin, "end": begin + len(raw[a:b].decode("utf-8", "surrogatepass"))})
            end = b
    kept.append(raw[end:])
    return b"".join(kept).decode("utf-8", "surrogatepass"), spans


_SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
_REPEATS = T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))


def _removing(at: int, names: list[str], min_words: int):
    """For rows with the text in column `at` and the owned digests in the last one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, last = list(batch.columns[:-1]), batch.columns[-1]
            texts, spans = columns[at].to_pylist(), [[] for _ in range(len(batch))]
            for i, owned in enumerate(last):
                if owned.is_valid and texts[i]:
                    texts[i], spans[i] = remove_runs(texts[i], set(owned.as_py()), min_words)
            columns[at] = pa.array(texts, pa.string())
            removed = pa.array([sum(s["end"] - s["begin"] for s in x) for x in spans], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, _SPANS), removed], names=names)

    return run


def _beside(docs: DataFrame, own: Column, found: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rows with the digests that `found` (id, digests) has for them, rows it has nothing for).

    If too many have some for a broadcast of their ids, all are joined, and rows with nothing are among the first.
    """
    own_id, own_digests = fresh(docs.columns, "id", "digests")
    found = cut_lineage(found.toDF(own_id, own_digests))
    if found.count() > BROADCAST_IDS:
        return docs.join(found, own == F.col(own_id), "left").select(*docs.columns, own_digests), None
    ids = F.broadcast(found.select(own_id))
    some = docs.join(ids, own == F.col(own_id), "left_semi").join(found, own == F.col(own_id))
    return some.select(*docs.columns, own_digests), docs.join(ids, own == F.col(own_id), "left_anti")


def dedup_substrings(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` with passages removed that a document of smaller key holds, `repeats` (begin and end of
    each in code points of the text as it was) and `removed_chars`."""
    integral(docs, key)
    docs = docs.select(*[c for c in docs.columns if c not in ("repeats", "removed_chars")])
    usable = docs.where(F.col(key).isNotNull() & (F.length(text) > 0)).select(F.col(key).cast("long"), text)
    pairs = cut_lineage(usable.mapInArrow(_pairs, "digest long, id long"))  # 16 bytes for about 27 of text, chunked once
    shared = pairs.groupBy("digest").agg(F.min("id").alias("owner"), F.max("id").alias("last")).where("owner < last").select("digest", "owner")
    owned = pairs.join(shared, "digest").where("id > owner").groupBy("id").agg(F.collect_set("digest").alias("owned"))  # as many as the text has chunks
    some, rest = _beside(docs, F.col(key).cast("long"), owned)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField("repeats", _REPEATS), T.StructField("removed_chars", T.LongType())])
    out = some.mapInArrow(_removing(docs.columns.index(text), schema.names, min_words), schema)
    none = [F.array().cast(_REPEATS).alias("repeats"), F.lit(0).cast("long").alias("removed_chars")]
    return out if rest is None else out.union(rest.select("*", *none))


#: Words of a run that is selected from each run of min_words, if that is longer.
SEED = 10
#: Digests in a row of the tables between the steps.
ROW = 1 << 16

def runs(text: str, min_words: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, where words begin, the digest of each run of min_words words, that of the run selected from it)."""
    raw = text.encode("utf-8", "surrogatepass")
    words, begins = hashing.words(np.frombuffer(raw, np.uint8))
    n = len(begins) - min_words + 1
    if n < 1:
        return raw, begins, np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(len(begins))
    k = min(SEED, min_words)
    seeds = hashing.sums(words, at[: len(at) - k + 1], at[k - 1 :] + 1)
    least = np.lib.stride_tricks.sliding_window_view(seeds, min_words - k + 1).min(axis=1)
    return raw, begins, hashing.sums(words, at[:n], at[:n] + min_words).view(np.int64), least.view(np.int64)


def remove_windows(text: str, owned: np.ndarray, min_words: int) -> tuple[str, list[dict]]:
    """The text without the words in runs of min_words whose digest is in `owned`, and the spans as code point offsets."""
    raw, begins, digests, _ = runs(text, min_words)
    change = np.zeros(len(begins) + 1, np.int64)
    hit = np.flatnonzero(np.isin(digests, owned))
    change[hit] += 1
    change[hit + min_words] -= 1
    edge = np.flatnonzero(np.diff(np.cumsum(change) > 0, prepend=False))
    places = np.append(begins, len(raw))
    points = np.append(0, np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    kept, spans, end = [], [], 0
    for a, b in zip(places[edge[::2]].tolist(), places[edge[1::2]].tolist()):
        kept.append(raw[end:a])
        spans.append({"begin": int(points[a]), "end": int(points[b])})
        end = b
    kept.append(raw[end:])
    return b"".join(kept).decode("utf-8", "surrogatepass"), spans


def _rows(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    parts = [(i, d[j : j + ROW]) for i, d in found for j in range(0, len(d), ROW)]
    offsets = np.cumsum([0, *(len(d) for _, d in parts)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, np.int64), *(d for _, d in parts)])
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array([i for i, _ in parts], pa.int64()), lists], names=["id", "digests"])


def _selected(min_words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _rows([(i.as_py(), np.unique(runs(t.as_py(), min_words)[3])) for i, t in zip(*batch.columns)])

    return run


def _candidates(min_words: int):
    """Runs of min_words words whose selected run is in the third column."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, t, shared in zip(*batch.columns):
                if shared.is_valid and t.is_valid:
                    _, _, digests, least = runs(t.as_py(), min_words)
                    found.append((i.as_py(), np.unique(digests[np.isin(least, shared.values.to_numpy())])))
            yield _rows(found)

    return run


def _removing_windows(at: int, names: list[str], min_words: int):
    """For rows with the text in column `at` and the owned digests in the last one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, last = list(batch.columns[:-1]), batch.columns[-1]
            texts, spans = columns[at].to_pylist(), [[] for _ in range(len(batch))]
            for i, owned in enumerate(last):
                if owned.is_valid and texts[i]:
                    texts[i], spans[i] = remove_windows(texts[i], owned.values.to_numpy(), min_words)
            columns[at] = pa.array(texts, pa.string())
            removed = pa.array([sum(s["end"] - s["begin"] for s in x) for x in spans], pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(spans, _SPANS), removed], names=names)

    return run


def _shared(rows: DataFrame, first: str) -> DataFrame:
    """(id, digests): those digests of (id, digests) that two ids hold, for the ids that satisfy `first`."""
    pairs = rows.select(F.explode("digests").alias("digest"), "id")
    shared = pairs.groupBy("digest").agg(F.min("id").alias("owner"), F.max("id").alias("last")).where("owner < last").select("digest", "owner")
    return pairs.join(shared, "digest").where(first).groupBy("id").agg(F.collect_set("digest").alias("digests"))


def dedup_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """`docs` without the words in runs of at least `min_words` words that a document of smaller key
    holds, `repeats` (begin and end of each in code points of the text as it was) and `removed_chars`."""
    integral(docs, key)
    docs = docs.select(*[c for c in docs.columns if c not in ("repeats", "removed_chars")])
    own, (own_id, own_digests) = F.col(key).cast("long"), fresh(docs.columns, "id", "digests")
    usable = docs.where(F.col(key).isNotNull() & (F.length(text) > 0)).select(own, text)
    selected = cut_lineage(usable.mapInArrow(_selected(min_words), "id long, digests array<long>"))
    both = docs.join(_shared(selected, "true").toDF(own_id, own_digests), own == F.col(own_id), "left").select(own, text, own_digests)
    windows = cut_lineage(both.mapInArrow(_candidates(min_words), "id long, digests array<long>"))
    both = docs.join(_shared(windows, "id > owner").toDF(own_id, own_digests), own == F.col(own_id), "left").select(*docs.columns, own_digests)
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in docs.schema), T.StructField("repeats", _REPEATS), T.StructField("removed_chars", T.LongType())])
    return both.mapInArrow(_removing_windows(docs.columns.index(text), schema.names, min_words), schema)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_substrings(docs)
    return out.select("doc_id", (F.col("removed_chars") > 0).alias("repeated"), "removed_chars", "repeats", "text")
