"""Merkle dataset manifest: trees over documents, the root of all of them, and a proof for each document.

The documents of a language are the leaves of a binary tree in the order of doc_id, the subroots of
the languages the leaves of one more. Nodes climb in rounds, as combineByKey does. In a task, a child
opens its parent as a partial one or is put into it, by its index; when a partial parent has as many
children as the size of the tree gives it (two, or one at the end of an odd level), it becomes a node,
which goes on to its own parent. What is left of a round are the nodes whose parents are still
partial, the frontier: about one for each 2 ** BITS nodes, and those at the edges of tasks. It is
dealt out again by ranges that are 2 ** BITS times as wide, in which the partial parents meet, until
only roots are left; that is a round for each BITS levels. A round keeps for each node that came in
the highest ancestor it reached and the siblings on its way. These links are followed in reverse,
from the roots down, each putting the siblings of a round before those of the ancestor; at the leaves
that is the proof.

Leaves are placed by a sort in ranges and the counts of the ranges (`sorted_parts`); a task holds a
block of 2 ** BITS nodes at most besides what it streams, and no tree, language or level is ever
gathered. A language with all documents is as good as many.

Defined cases: null fields count as `-`, also in the order of languages and doc_ids, where they come
first. Documents of one language and doc_id follow in the order of their leaves; equal rows have
equal leaves and each its own proof. A language of one document has its leaf as subroot, one language
its subroot as root. An empty table gives an empty result. Texts are hashed whole, in the scan; they
are not shuffled. Tampering leaves rows with a null doc_id or n_chars as they are. Other columns are
not returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from galley.operators.keys import sorted_parts
from galley.session import cut_lineage

#: Levels that a round climbs.
BITS = 10
#: Rows of proofs and offsets that are broadcast; above, they are joined by a shuffle.
BROADCAST_ROWS = 20_000

WIDTH = 32


def parent_of(children: list[bytes]) -> bytes:
    """The digest of a run of nodes."""
    return sha256("".join([c.hex() for c in children]).encode()).digest()


def fold(digest: bytes, at: int, n: int, path: bytes) -> bytes:
    """The root over leaf `at` of n, from its digest and its siblings."""
    used = 0
    while n > 1:
        if at ^ 1 < n:
            sibling = path[used : used + WIDTH]
            used += WIDTH
            digest = parent_of([sibling, digest] if at & 1 else [digest, sibling])
        else:
            digest = parent_of([digest])
        at, n = at >> 1, (n + 1) >> 1
    return digest


def climb(nodes: list[tuple[int, int, bytes]], n: int, reach: int) -> list[tuple[int, int, bytes, bytes]]:
    """(level, index, digest, path) of the highest ancestor of each node (level, index, digest) and the siblings on the way to it.

    n: leaves of the tree. Parents are made up to level `reach`.
    """
    partial: dict[tuple[int, int], dict[int, bytes]] = {}
    made: dict[tuple[int, int], bytes] = {}
    for node in nodes:
        level, at, digest = node
        while True:
            size = -(-n >> level) if level else n
            if level >= reach or size == 1:
                break
            parent = level + 1, at >> 1
            children = partial.setdefault(parent, {})
            children[at] = digest
            if len(children) < min(2, size - (at & ~1)):
                break
            level, at = parent
            digest = made[parent] = parent_of([children[k] for k in sorted(children)])
    ways: dict[tuple[int, int], tuple[int, int, bytes | None, bytes]] = {}

    def way(level: int, at: int) -> tuple[int, int, bytes | None, bytes]:
        """From a node to its highest ancestor; the digest is None if that is the node itself."""
        if (level, at) not in ways:
            parent = level + 1, at >> 1
            if parent not in made:
                ways[level, at] = level, at, made.get((level, at)), b""
            else:
                top_level, top, digest, path = way(*parent)
                ways[level, at] = top_level, top, digest, partial[parent].get(at ^ 1, b"") + path
        return ways[level, at]

    out = []
    for level, at, digest in nodes:
        top_level, top, found, path = way(level, at)
        out.append((top_level, top, found or digest, path))
    return out


def _climbing(names: list[str], reach: int):
    """For rows sorted by tree and first leaf, of the columns tree, n, level, at, digest and more."""

    def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        levels, ats, digests = (rows.column(i).to_pylist() for i in (2, 3, 4))
        found = list(zip(*climb(list(zip(levels, ats, digests)), rows.column(1)[0].as_py(), reach)))
        more = [pa.array(x, t) for x, t in zip(found, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))]
        return pa.RecordBatch.from_arrays([*rows.columns, *more], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for batch in batches:
            blocks = [(t, (a << v) >> reach) for t, v, a in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)))]
            begin = 0
            for i in range(1, len(blocks) + 1):
                if i == len(blocks) or blocks[i] != blocks[begin]:
                    if held and blocks[begin] != now:
                        yield done(held)
                        held = []
                    held.append(batch.slice(begin, i - begin))
                    now, begin = blocks[begin], i
        if held:
            yield done(held)

    return run


def _join(rows: DataFrame, found: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(found) if found.count() <= BROADCAST_ROWS else found, on, how)


def merkle(leaves: DataFrame, bits: int = BITS) -> DataFrame:
    """`leaves` with `root` and `path`, the digest of the tree's root and the siblings from leaf to root, one after the other.

    leaves: tree (string), n (its leaves), at (0 to n - 1) and digest (binary), and other columns.
    """
    more = [c for c in leaves.columns if c not in ("tree", "n", "at", "digest")]
    rows, rounds, reach = leaves.select("tree", "n", F.lit(0).alias("level"), "at", "digest", *more), [], bits
    first = F.expr("shiftleft(at, level)")
    while True:
        if rounds:
            rows = rows.repartition("tree", F.shiftright(first, reach))
        rows = rows.sortWithinPartitions("tree", first)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", top_level int, top long, top_digest binary, path binary"
        names = [*rows.columns, "top_level", "top", "top_digest", "path"]
        climbed = cut_lineage(rows.mapInArrow(_climbing(names, reach), schema))
        rounds.append(climbed)
        open_ = climbed.where(F.expr("shiftleft(1L, top_level) < n"))
        rows = open_.groupBy("tree", "n", F.col("top_level").alias("level"), F.col("top").alias("at")).agg(F.first("top_digest").alias("digest"))
        if open_.isEmpty():
            break
        rows, reach = cut_lineage(rows), reach + bits
    full = None
    for climbed in reversed(rounds):
        own = climbed.withColumn("root", F.col("top_digest"))
        if full is not None:
            above = cut_lineage(full.select("tree", F.col("level").alias("top_level"), F.col("at").alias("top"), F.col("root").alias("root_above"), F.col("path").alias("path_above")))
            own = _join(own, above, ["tree", "top_level", "top"], "left")
            own = own.withColumns({"root": F.coalesce("root_above", "root"), "path": F.concat("path", F.coalesce("path_above", F.lit(b"")))})
        full = own
    return full.select("tree", "n", "at", "digest", *more, "root", "path")


def placed(rows: DataFrame, tree: Column, *order: Column) -> DataFrame:
    """`rows` with tree, n and at: its place among the n rows of its tree, in the order of `order`.

    order begins with the tree's own order.
    """
    numbered = sorted_parts(rows.withColumn("tree", tree), *order)
    each = numbered.groupBy("part", "tree").agg(F.count("*").alias("c"), F.min("local").alias("low"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = cut_lineage(each.select("part", "tree", (before - F.col("low")).alias("shift"), F.sum("c").over(Window.partitionBy("tree")).alias("n")))  # parts and trees
    return _join(numbered, each, ["part", "tree"]).withColumn("at", F.col("local") + F.col("shift")).drop("part", "local", "shift")


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The digest of a row, in hex."""
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def _folding(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(2, 9)]
        found = [fold(fold(d, at, n, path), at_above, n_above, above) for d, at, n, path, at_above, n_above, above in zip(*columns)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], *batch.columns[9:], pa.array(found, pa.binary())], names=["doc_id", "leaf", "subroot", "root", "proof", "folded"])


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of documents (doc_id, source, lang, n_chars, text).

    folded_root follows from the document as it is after tampering and the siblings before it.
    """
    own = [F.col(c) for c in ("doc_id", "source", "lang")]
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)) & F.col("n_chars").isNotNull()
    tampered = F.when(touched, F.unhex(leaf(*own, F.col("n_chars") + 1, F.col("text"))))
    slim = cut_lineage(docs.select(F.col("doc_id"), "lang", F.unhex(leaf(*own, F.col("n_chars"), F.col("text"))).alias("digest"), tampered.alias("tampered")))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-"))  # no null, for joins
    leaves = placed(slim, tree, F.col("lang").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("digest"))
    trees = cut_lineage(merkle(leaves.select("tree", "n", "at", "digest", "doc_id", "lang", "tampered")))
    subroots = trees.groupBy("tree").agg(F.first("lang").alias("lang"), F.first("root").alias("digest"))  # languages
    above = placed(cut_lineage(subroots.withColumnRenamed("tree", "of")), F.lit("all"), F.col("lang").asc_nulls_first())
    above = cut_lineage(merkle(above.select("tree", "n", "at", "digest", "of")).select(F.col("of").alias("tree"), F.col("at").alias("at_above"), F.col("n").alias("n_above"), F.col("path").alias("above"), F.col("root").alias("whole")))
    both = _join(trees, above, ["tree"])
    rows = both.select("doc_id", F.col("digest").alias("leaf"), F.coalesce("tampered", "digest").alias("start"), "at", "n", "path", "at_above", "n_above", "above", F.col("root").alias("subroot"), F.col("whole").alias("root"), F.concat("path", "above").alias("proof"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    folded = rows.mapInArrow(_folding, f"doc_id {kind}, leaf binary, subroot binary, root binary, proof binary, folded binary")
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")}
    return folded.select("doc_id", text["leaf"].alias("leaf"), text["subroot"].alias("subroot"), text["root"].alias("root"), F.sha2(text["proof"], 256).alias("proof_sha256"), text["folded"].alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text"))


# crc32 bit by bit, as the engine of the SQL has none.
OP13_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, source, n_chars, text,
    coalesce(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
      lambda h, c: list_reduce(list_prepend(xor(h, c), range(8)), lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))) , 0) AS crc
  FROM documents),
f AS (
  SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    CASE WHEN doc_id IS NOT NULL AND xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS told
  FROM d),
leaves AS (
  SELECT doc_id, lang, sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen(told::VARCHAR) || ':' || told, '-') || tail) AS start
  FROM f),
placed AS (
  SELECT row_number() OVER () AS r, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM leaves),
nodes AS (
  SELECT lang, 0 AS level, pos, n AS size, leaf AS digest FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 2, (size + 1) // 2, sha256(digest || coalesce(other, ''))
  FROM (SELECT *, lead(digest) OVER (PARTITION BY lang ORDER BY pos) AS other FROM nodes WHERE size > 1) WHERE pos % 2 = 0),
subroots AS (
  SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE size = 1),
above AS (
  SELECT 0 AS level, pos, n AS size, digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (size + 1) // 2, sha256(digest || coalesce(other, ''))
  FROM (SELECT *, lead(digest) OVER (ORDER BY pos) AS other FROM above WHERE size > 1) WHERE pos % 2 = 0),
way AS (
  SELECT r, lang, 0 AS level, pos, n AS size, start AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT w.r, w.lang, w.level + 1, w.pos // 2, (w.size + 1) // 2,
    sha256(CASE WHEN w.pos % 2 = 1 THEN s.digest || w.folded ELSE w.folded || coalesce(s.digest, '') END), w.proof || coalesce(s.digest, '')
  FROM way w LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM w.lang AND s.level = w.level AND s.pos = xor(w.pos, 1)
  WHERE w.size > 1),
on_top AS (
  SELECT w.r, w.lang, 0 AS level, s.pos, s.n AS size, w.folded, w.proof FROM way w JOIN subroots s ON s.lang IS NOT DISTINCT FROM w.lang WHERE w.size = 1
  UNION ALL
  SELECT w.r, w.lang, w.level + 1, w.pos // 2, (w.size + 1) // 2,
    sha256(CASE WHEN w.pos % 2 = 1 THEN s.digest || w.folded ELSE w.folded || coalesce(s.digest, '') END), w.proof || coalesce(s.digest, '')
  FROM on_top w LEFT JOIN above s ON s.level = w.level AND s.pos = xor(w.pos, 1)
  WHERE w.size > 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, a.digest AS root, sha256(w.proof) AS proof_sha256, w.folded AS folded_root, w.folded = a.digest AS verified
FROM placed p JOIN on_top w ON w.r = p.r AND w.size = 1 JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, (SELECT digest FROM above WHERE size = 1) a
"""
