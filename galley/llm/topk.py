"""Exact top-k search by distributed histogram selection.

Vectors become integers, floor(256 * x) of every component; a score is the integer inner product
of a query and a candidate. For a block of queries, of bounded size and sent to all tasks:

1. every candidate is scored against the block, and every task counts its scores into bins of
   each query's range; the counts are added up over all tasks and the bin that holds the query's
   kth highest score is located; that bin becomes the range, until a bin is one value wide;
2. all candidates above the kth value, and of those equal to it each task's smallest ids, are
   returned; a window ranks them by score, ties to the smaller id, and cuts at k.

Of its counts a task sends, from the top, only the bins down to the one that holds its own kth
score: the global kth value cannot lie below it. So k rows for each query and task at most are
shuffled, in each pass and in the end, and no group of scores is ever gathered.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no part;
vectors of different length have no score. Rows without an id take no part. A candidate is any
row whose id is not the query's; repeated rows are candidates each. A query id that repeats is
searched once, with its smallest vector. A query with fewer than k candidates gets all of them.
Scores are exact up to 2 ** 53; larger ones raise an error. An empty table gives an empty result.
Extra columns are not returned, whatever their names. Queries beyond one block are searched block by
block, each block's result being written to the shared folder before the next begins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from galley.session import shared_folder

BINS = 512
#: Queries in a block: with 64 components 1 MB, with 4096 components 64 MB.
BLOCK_QUERIES = 2048
#: Candidates that are scored at once: 16 MB of scores.
SLICE = 1024


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, integer components as doubles) by length of the vectors."""
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    lists = batch.column(1)
    flat = np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    length = np.diff(lists.offsets.to_numpy())
    begin = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
    for d in np.unique(length):
        rows = np.flatnonzero(length == d)
        yield ids[rows], flat[begin[rows][:, None] + np.arange(d)]


def _scored(batches: Iterable[pa.RecordBatch], block: dict) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(positions of queries, candidate ids, scores) of slices; a query's own id scores -inf."""
    for batch in batches:
        for ids, own in _matrices(batch):
            if own.shape[1] not in block:
                continue
            at, q_ids, q = block[own.shape[1]]
            if np.abs(q).max(initial=0) * np.abs(own).max(initial=0) * own.shape[1] >= 2.0**53:
                raise ValueError("components too large for exact scores")
            for i in range(0, len(ids), SLICE):
                scores = q @ own[i : i + SLICE].T
                scores[q_ids[:, None] == ids[None, i : i + SLICE]] = -np.inf
                yield at, ids[i : i + SLICE], scores


def _histogram(shared, low: np.ndarray, width: np.ndarray, k: int):
    """A function for mapInArrow: (query, bin, n) of each task, highest bins first, until k scores are counted.

    Scores above a query's range count into its last bin plus one.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(low), BINS + 2), np.int64)  # bin 0: below the range
        for at, _, scores in _scored(batches, shared.value):
            bins = np.clip(np.floor((scores - low[at, None]) / width[at, None]) + 1, 0, BINS + 1)
            bins = bins.astype(np.int64) + np.arange(len(at))[:, None] * (BINS + 2)
            own = np.isfinite(scores)
            counts[at] += np.bincount(bins[own], minlength=len(at) * (BINS + 2)).reshape(len(at), -1)
        above = counts[:, ::-1].cumsum(axis=1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (above < k))
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(counts[q, b])], names=["q", "bin", "n"])

    return run


def _winners(shared, names: np.ndarray, kth: np.ndarray, k: int):
    """A function for mapInArrow: (query_id, vec_id, score) of all above the kth value, and of k equal to it by each task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple[int, int]]] = {}
        for at, ids, scores in _scored(batches, shared.value):
            q, c = np.nonzero((scores >= kth[at, None]) & np.isfinite(scores))
            for i, vec, score in zip(at[q].tolist(), ids[c].tolist(), scores[q, c].astype(np.int64).tolist()):
                own = kept.setdefault(i, [])
                own.append((-score, vec))
                if len(own) > 4 * k:
                    own.sort()
                    del own[k:]
        rows = [(int(names[i]), vec, -score) for i, own in kept.items() for score, vec in sorted(own)[:k]]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])

    return run


def _block_top(candidates: DataFrame, queries: list, k: int) -> DataFrame:
    """The k best of a block, from each task."""
    spark = candidates.sparkSession
    whole = lambda x: F.floor(x.cast("double") * 256).cast("double")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + whole(x) * whole(x)))
    lengths = sorted({len(r["v"]) for r in queries})
    longest = candidates.where(F.size("v").isin(lengths)).groupBy(F.size("v").alias("d")).agg(F.max(norm).alias("n"))
    longest = {r["d"]: r["n"] for r in longest.collect()}  # a row for each length in the block
    names = np.array([r["id"] for r in queries], np.int64)
    block, low, high = {}, np.zeros(len(queries)), np.zeros(len(queries))
    for d in {len(r["v"]) for r in queries}:
        at = np.array([i for i, r in enumerate(queries) if len(r["v"]) == d])
        q = np.floor(256.0 * np.array([queries[i]["v"] for i in at], np.float64))
        block[d] = (at, names[at], q)
        high[at] = np.ceil(np.linalg.norm(q, axis=1) * longest.get(d, 0.0)) + 1
        low[at] = -high[at]
    shared = spark.sparkContext.broadcast(block)  # BLOCK_QUERIES vectors
    above = np.zeros(len(queries), np.int64)
    width = np.maximum(1.0, np.ceil((high - low + 1) / BINS))
    kth, done = np.full(len(queries), -np.inf), np.zeros(len(queries), bool)
    while not done.all():
        bins = candidates.mapInArrow(_histogram(shared, low, width, k), "q int, bin int, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        upto = F.sum("n").over(Window.partitionBy("q").orderBy(F.desc("bin")))  # BINS + 2 rows at most
        bins = bins.withColumn("upto", upto).where(F.col("upto") >= k)
        found = bins.groupBy("q").agg(F.max("bin").alias("bin")).collect()  # one row for each query of the block
        at = {r["q"]: r["bin"] for r in found}
        for i in np.flatnonzero(~done):
            if i not in at:  # fewer than k candidates
                done[i] = True
                continue
            low[i] += (at[i] - 1) * width[i]
            if width[i] == 1:
                kth[i], done[i] = low[i], True
            width[i] = max(1.0, np.ceil(width[i] / BINS))
    return candidates.mapInArrow(_winners(shared, names, kth, k), _FOUND)


_FOUND = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", block: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query."""
    spark = vectors.sparkSession
    candidates = vectors.where(F.col(key).isNotNull() & usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    queries = vectors.where(is_query & F.col(key).isNotNull() & usable(F.col(vector))).groupBy(F.col(key).cast("long").alias("id")).agg(F.min(vector).alias("v"))
    blocks = -(-queries.count() // block)
    out, path = spark.createDataFrame([], _FOUND), f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").collect()  # about `block` rows
        if own and blocks == 1:
            out = _block_top(candidates, own, k)
        elif own:  # the plan of the result reads one folder, whatever the number of blocks
            _block_top(candidates, own, k).write.mode("append").parquet(path)
            out = spark.read.schema(_FOUND).parquet(path)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # k rows from each task at most
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
