"""Texts to embed, encoders, and exact nearest neighbours by Euclidean distance."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from galley.functions.content import strip_html
from galley.functions.names import strip
from galley.session import cut_lineage

# The defaults of the embedding step.
BATCH_SIZE, MAX_CHARS = 64, 5000

Encoder = Callable[[list[str]], np.ndarray]


class EncoderMissing(RuntimeError):
    """The named model cannot be loaded here."""


def blob(title: Column, description: Column, text: Column) -> Column:
    """Title, description and text without tags, the empty ones left out, a blank line between."""

    def part(c: Column) -> Column:
        return F.nullif(strip(F.coalesce(c, F.lit(""))), F.lit(""))

    return F.concat_ws("\n\n", part(title), part(description), F.nullif(strip_html(strip(F.coalesce(text, F.lit("")))), F.lit("")))


def embeddable(articles: DataFrame, max_chars: int = MAX_CHARS) -> DataFrame:
    """(id, text) of rows with a whole-number id and some text, cut to `max_chars`."""
    rows = articles.select(F.col("id").try_cast("bigint").alias("id"), blob(F.col("title"), F.col("description"), F.col("text")).alias("text"))
    return rows.where("id IS NOT NULL AND text <> ''").withColumn("text", F.substring("text", 1, max_chars))


def hashed_features(dim: int = 64) -> Encoder:
    """A stand-in for a sentence model where none can be loaded: signed word hashes, not normalised."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
                out[i, h % dim] += 1.0 if h >> 63 else -1.0
        return out

    return encode


def sentence_model(name: str) -> Encoder:
    """A model of the library sentence-transformers, loaded once in each worker."""
    held: list = []

    def encode(texts: list[str]) -> np.ndarray:
        if not held:
            try:
                from sentence_transformers import SentenceTransformer
            except ImportError as e:
                raise EncoderMissing("sentence-transformers is not installed") from e
            held.append(SentenceTransformer(name, device="cpu"))
        return held[0].encode(texts, batch_size=BATCH_SIZE, convert_to_numpy=True, normalize_embeddings=False)

    return encode


def embed(rows: DataFrame, encoder: Encoder, batch_size: int = BATCH_SIZE) -> DataFrame:
    """(article_id, embedding) of (id, text)."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), batch_size):
                part = batch.iloc[i : i + batch_size]
                yield pd.DataFrame({"article_id": part["id"].to_numpy(), "embedding": list(np.asarray(encoder(part["text"].tolist()), np.float32))})

    return rows.select("id", "text").mapInPandas(run, "article_id bigint, embedding array<float>")


def distance(a: Column, b: Column) -> Column:
    gaps = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, x: s + x))


def nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", most_queries: int = 2_000) -> DataFrame:
    """(query_id, rank, vec_id, distance) of the k nearest of each query, ties to the smaller id.

    The stated queries, checked to be few, travel to every task as one array; each row of `vectors`
    is compared with all of them, and only the k best of each task and query are shuffled.
    """
    few = queries.select(F.col(key).alias("q"), F.col(vector).alias("v")).limit(most_queries + 1).collect()
    if len(few) > most_queries:
        raise ValueError(f"over {most_queries} queries at once")
    return _nearest(vectors, few, k, key, vector)


#: Cells of the index, vectors that it is fitted on, and rows of a block of vectors or queries that meet in a task.
CELLS, SAMPLE, BLOCK = 64, 4096, 4096


def centres(sample: np.ndarray, cells: int = CELLS, rounds: int = 8) -> np.ndarray:
    """Means of the nearest of a sample, begun with some of it. They decide on speed only, not on results."""
    rnd = np.random.default_rng(7)
    out = sample[rnd.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(rounds):
        own = _to_centres(sample, out).argmin(axis=1)
        out = np.array([sample[own == c].mean(axis=0) if (own == c).any() else out[c] for c in range(len(out))])
    return np.unique(out, axis=0)


def _to_centres(rows: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """(rows, centres) distances, up to rounding."""
    square = (rows**2).sum(axis=1)[:, None] + (middle**2).sum(axis=1)[None, :] - 2 * rows @ middle.T
    return np.sqrt(np.maximum(square, 0))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _celled(middle: np.ndarray):
    """(id, v, cell, off): the nearest centre of each vector and its distance."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                rows = _matrix(batch.column(1))
                cell = _to_centres(rows, middle).argmin(axis=1)
                off = np.sqrt(((rows - middle[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(off)], names=["id", "v", "cell", "off"])

    return run


def _probing(middle: np.ndarray, stats: dict[int, tuple[int, float, float]], k: int, begin: bool):
    """(id, v, reach, cell, d, first): for queries (id, v, reach) the cells to look into, and the distances to their centres.

    stats: vectors of a cell, and how near and how far from its centre they are at least and at most. begin: the
    first cells, nearest centre first, that hold k other vectors; else those others that may hold one within reach
    (null: any), by the triangle inequality.
    """
    ids = np.array(sorted(stats))
    n, near, far = (np.array([stats[c][i] for c in ids]) for i in range(3))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            d = np.sqrt(((_matrix(batch.column(1))[:, None, :] - middle[ids][None]) ** 2).sum(axis=2))
            order = np.argsort(d, axis=1, kind="stable")
            before = np.cumsum(n[order], axis=1) - n[order]
            first = np.zeros(d.shape, bool)
            np.put_along_axis(first, order, before < k + 1, axis=1)
            chosen = first
            if not begin:
                reach = batch.column(2)
                least = np.maximum(np.maximum(d - far, near - d), 0)
                limit = np.where(reach.is_valid(), reach.fill_null(0.0).to_numpy(zero_copy_only=False), np.inf)[:, None]
                chosen = ~first & (least <= limit * (1 + 1e-9) + 1e-12)
            rows, at = np.nonzero(chosen)
            picked = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(ids[at].astype(np.int32)), pa.array(d[rows, at])], names=["id", "v", "reach", "cell", "d"])

    return run


def _comparing(k: int):
    """(query_id, vec_id, distance): the k best of a block of vectors for each of a block of queries."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, rows, off = left["id"].to_numpy(), _matrix(left["v"].combine_chunks()) if len(left) else None, left["off"].to_numpy()
        found: list[tuple[int, int, float]] = []
        probes = _matrix(right["v"].combine_chunks()) if len(right) else ()
        for own, probe, reach, d in zip(right["id"].to_pylist(), probes, right["reach"].to_pylist(), right["d"].to_pylist()):
            if rows is None:
                break
            some = np.flatnonzero(names != own if reach is None else (names != own) & (np.abs(off - d) <= reach * (1 + 1e-9) + 1e-9))
            distance = np.sqrt(((rows[some] - probe) ** 2).sum(axis=1))
            best = np.lexsort((names[some], distance))[:k]
            found += [(own, int(names[some[i]]), float(distance[i])) for i in best]
        return pa.table({c: pa.array([r[i] for r in found], t) for i, (c, t) in enumerate((("query_id", pa.int64()), ("vec_id", pa.int64()), ("distance", pa.float64())))})

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id"))  # k rows for each block that was looked into
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "distance")


def pruned_nearest(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", cells: int = CELLS, sample: int = SAMPLE, block: int = BLOCK) -> tuple[DataFrame, float]:
    """(query_id, rank, vec_id, distance) of the k nearest other vectors of each query, ties to the smaller id; and the share
    of all pairs of a query and a vector that were in a cell looked into.

    Every vector goes to the nearest of `cells` centres, which are fitted on `sample` vectors (those of the least
    hashes). A query first looks into the cells round it that hold k others; no vector farther than the
    k-th of these is wanted. By the triangle inequality a cell holds none nearer than the distance to its centre less
    its radius; the cells that may are looked into next, and in them only at vectors as far from the
    centre as one within reach can be. So the result is exact, whatever the centres.

    Vectors and queries meet by cells, in blocks of about `block` of each: many queries or vectors of a cell are many
    blocks. Rows without id or vector take no part; vectors are of one length, ids of queries unique.
    """
    spark = vectors.sparkSession

    def usable(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))

    own, asked = usable(vectors), usable(queries)
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, distance double")
    fitted = own.orderBy(F.xxhash64("id"), "id").limit(sample).collect()  # SAMPLE rows
    if not fitted:
        return none, 0.0
    middle = centres(np.array([r["v"] for r in fitted], np.float64), cells)
    placed = cut_lineage(own.mapInArrow(_celled(middle), "id long, v array<double>, cell int, off double"))
    stats = {r["cell"]: (r["n"], r["near"], r["far"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("off").alias("near"), F.max("off").alias("far")).collect()}  # cells
    compared = 0

    def met(of: DataFrame, begin: bool) -> DataFrame:
        nonlocal compared
        probes = cut_lineage(of.mapInArrow(_probing(middle, stats, k, begin), "id long, v array<double>, reach double, cell int, d double"))
        asking = {r["cell"]: r["count"] for r in probes.groupBy("cell").count().collect()}  # cells
        compared += sum(stats[c][0] * n for c, n in asking.items())
        cuts = [(c, -(-stats[c][0] // block), -(-n // block)) for c, n in asking.items()]
        blocks = F.broadcast(spark.createDataFrame(cuts, "cell int, vs int, qs int"))  # cells
        one = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = placed.join(blocks, "cell").select("cell", one("vs").alias("vb"), every("qs").alias("qb"), "id", "v", "off")
        right = probes.join(blocks, "cell").select("cell", every("vs").alias("vb"), one("qs").alias("qb"), "id", "v", "reach", "d")
        by = ["cell", "vb", "qb"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(_comparing(k), "query_id long, vec_id long, distance double")

    first = cut_lineage(_ranked(met(asked.withColumn("reach", F.lit(None).cast("double")), True), k))
    reach = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("distance").alias("reach"))
    more = met(asked.join(reach, "id", "left").select("id", "v", "reach"), False)
    pairs = asked.count() * sum(n for n, _, _ in stats.values())
    return _ranked(first.select("query_id", "vec_id", "distance").union(more), k), compared / pairs if pairs else 0.0


def _nearest(vectors: DataFrame, few: list, k: int, key: str, vector: str) -> DataFrame:
    """The nearest of the queries `few`, rows of q and v."""
    names = np.array([r["q"] for r in few])
    matrix = np.array([r["v"] for r in few], np.float64).reshape(len(few), -1)
    shared = vectors.sparkSession.sparkContext.broadcast((names, matrix))

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, matrix = shared.value
        best: list[list[tuple[float, int]]] = [[] for _ in names]
        for batch in batches:
            ids = batch[key].to_numpy()
            rows = np.array(batch[vector].tolist(), np.float64).reshape(len(ids), -1)
            for i, own in enumerate(names):
                d = np.sqrt(((rows - matrix[i]) ** 2).sum(axis=1))
                near = np.argsort(d, kind="stable")
                near = near[d[near] <= d[near[min(k, len(near) - 1)]]] if len(near) else near
                best[i] = sorted(best[i] + [(float(d[j]), int(ids[j])) for j in near if ids[j] != own])[:k]
        rows = [(int(q), n, d) for q, found in zip(names, best) for d, n in found]
        yield pd.DataFrame(rows, columns=["query_id", "vec_id", "distance"])

    found = vectors.where(F.col(vector).isNotNull()).select(key, vector).mapInPandas(run, "query_id bigint, vec_id bigint, distance double")
    return _ranked(found, k)
