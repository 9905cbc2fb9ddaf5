"""Co-bucketed table pair: two tables rewritten as one sorted Parquet file for each table and bucket.

Rows are sorted as bytes: `rowkeys` makes a whole row one order-preserving key, with sale_id
inverted, from which the row is decoded again when it is written. The sort is a distributed MSD
radix sort. Its first digit is the bucket. A bucket with more than a fair share of the rows is cut
by the next byte in which its keys differ, its cells by the next, until a cell is a fair share; the
counts of the cells come from one histogram for each digit, combined before they leave a task. Cells
of neighbours are put together to parts of about a fair share, each part is one task, which sorts its
rows and writes the files of its buckets as they stream by. Equal rows need no order and are dealt
out. A bucket of several parts comes as one sorted run for each, and one task for each bucket copies
its runs, one batch after the other, into its file.

What comes to the driver are counts of files, buckets and cells. Of the first two there are BUCKETS
+ 2 at most, of cells about two for each part and 256 for each that is cut, whatever the input;
parts are as many as the session's shuffle partitions. A cell's digit is looked up in a table of
these cells that tasks carry with them.

A file is written under a name of its attempt and counts only if the task that wrote it is the one
whose result Spark keeps: its path is in that result. What other attempts left is deleted at the
end. Files are written by Arrow's file systems, so the folder must be one that these know (file,
hdfs, s3, gs, abfs).

Defined cases: a null sale_id goes to bucket BUCKETS + 1, a line whose sale_id is no sale to bucket
BUCKETS. Rows of all nulls are rows. Repeated rows stay repeated. A sale_id with several sales joins
each of them. Empty tables have no files. Texts of any length are whole in a key. Columns of any
names are kept as they are but for the three that are needed; types without a key raise a TypeError.
Nothing here depends on the order of equal rows.
"""

from __future__ import annotations

import hashlib
import posixpath
import re
import uuid
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm.columns import fresh
from galley.llm.rowkeys import RowKeys
from galley.session import cut_lineage, shared_folder, written
from galley.sources.export import delete

BUCKETS = 600
#: Rows of a row group, which is what a writing task holds.
GROUP_ROWS = 1 << 16

_FILE = "grp int, part int, path string, n_rows long, ids_sha256 string"


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


class _Digest:
    """sha256 of numbers in decimal, null as nothing, joined by commas, as they come."""

    def __init__(self) -> None:
        self.hash, self.n = hashlib.sha256(), 0

    def add(self, ids: pa.Array) -> None:
        text = ",".join(ids.cast(pa.string()).fill_null("").to_pylist())
        self.hash.update((("," if self.n else "") + text).encode())
        self.n += len(ids)


class _File:
    """A Parquet file that is written batch by batch."""

    def __init__(self, uri: str, keys: RowKeys) -> None:
        self.uri, self.digest = uri, _Digest()
        files, path = place(uri)
        files.create_dir(posixpath.dirname(path), recursive=True)
        self.stream = files.open_output_stream(path)
        self.writer = pq.ParquetWriter(self.stream, keys.arrow)
        self.held: list[pa.RecordBatch] = []

    def add(self, batch: pa.RecordBatch) -> None:
        self.digest.add(batch.column(0))
        self.held.append(batch)
        if sum(map(len, self.held)) >= GROUP_ROWS:
            self._flush()

    def _flush(self) -> None:
        if self.held:
            self.writer.write_table(pa.Table.from_batches(self.held))
            self.held = []

    def close(self, grp: int, part: int) -> pa.RecordBatch:
        self._flush()
        self.writer.close()
        self.stream.close()
        own = [[grp], [part], [self.uri], [self.digest.n], [self.digest.hash.hexdigest()]]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(own, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.string()))], names=["grp", "part", "path", "n_rows", "ids_sha256"])


@dataclass
class Cells:
    """Cells in their order: (grp, first bytes of its keys), the part of each, and over how many parts its equal rows are dealt."""

    starts: list[tuple[int, bytes]]
    parts: list[int]
    dealt: list[int]
    n_parts: int
    split: frozenset[int]  # groups of several parts


def _digits(nodes: list[tuple[int, bytes, int]]):
    """(node, digit, n, low, high): for each node (grp, prefix, place of the digit) the counts of its digits and the ends of their keys."""
    starts = [x[:2] for x in nodes]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            for g, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                i = bisect_right(starts, (g, k)) - 1
                if i < 0 or nodes[i][0] != g or not k.startswith(nodes[i][1]):
                    continue
                at = (i, k[nodes[i][2]] if nodes[i][2] < len(k) else -1)
                if (x := found.get(at)) is None:
                    found[at] = [1, k, k]
                else:
                    x[0] += 1
                    if k < x[1]:
                        x[1] = k
                    elif k > x[2]:
                        x[2] = k
        rows = [(*at, *x) for at, x in found.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=["node", "digit", "n", "low", "high"])

    return run


def cells(rows: DataFrame, counts: dict[int, int], parts: int) -> Cells:
    """rows: (grp, key), counts: the rows of each group. Parts of about a `parts`-th of the rows each."""
    fair = max(1, -(-sum(counts.values()) // max(1, parts)))
    done = [(g, b"", n, 1) for g, n in counts.items() if n <= fair]
    nodes = sorted((g, b"", 0) for g, n in counts.items() if n > fair)
    while nodes:  # each holds more than a fair share, so they are fewer than `parts`
        own = rows.where(F.col("grp").isin(sorted({x[0] for x in nodes}))).select("grp", "key")
        each = own.mapInArrow(_digits(nodes), "node int, digit int, n long, low binary, high binary")
        found = each.groupBy("node", "digit").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).collect()  # 257 for each node
        nodes_next = []
        for r in found:
            g, low, high = nodes[r["node"]][0], bytes(r["low"]), bytes(r["high"])
            same = next((i for i, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
            if r["n"] <= fair or low == high:
                done.append((g, low[: nodes[r["node"]][2] + 1], r["n"], -(-r["n"] // fair)))
            else:
                nodes_next.append((g, low[:same], same))
        nodes = sorted(nodes_next)
    out = Cells([], [], [], 0, frozenset())
    held, of = 0, {}
    for g, prefix, n, deal in sorted(done):
        if out.starts and (held + n > fair or deal > 1):
            out.n_parts, held = out.n_parts + 1, 0
        out.starts.append((g, prefix))
        out.parts.append(out.n_parts)
        out.dealt.append(deal)
        of.setdefault(g, set()).update(range(out.n_parts, out.n_parts + deal))
        out.n_parts, held = out.n_parts + deal - 1, n if deal > 1 else held + n
    out.n_parts += 1
    out.split = frozenset(g for g, x in of.items() if len(x) > 1)
    return out


def _with_part(of: Cells):
    """(grp, key, part) of (grp, key)."""
    whole = {g: p for (g, _), p in zip(of.starts, of.parts) if g not in of.split}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            part = np.array([whole.get(g, -1) for g in groups.tolist()], np.int32)
            for i in np.flatnonzero(part < 0).tolist():
                at = bisect_right(of.starts, (int(groups[i]), batch.column(1)[i].as_py())) - 1
                part[i] = of.parts[at] + turn % of.dealt[at]
                turn += 1
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(part)], names=["grp", "key", "part"])

    return run


def _writing(of: Cells, keys: RowKeys, folder: str, name: str):
    """A file for each group of sorted (grp, key, part), or a run where a group has several parts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, now, attempt = None, None, uuid.uuid4().hex[:12]
        for batch in batches:
            groups = batch.column(0).to_numpy(zero_copy_only=False)
            edge = np.flatnonzero(np.diff(groups, prepend=groups[0] - 1, append=groups[-1] + 1)) if len(groups) else []
            for a, b in zip(edge[:-1], edge[1:]):
                of_file = int(groups[a]), batch.column(2)[int(a)].as_py()
                if file is None or of_file[0] != now[0]:
                    if file is not None:
                        yield file.close(*now)
                    now = of_file
                    file = _File(f"{folder}.runs/{now[0]}-{now[1]}-{attempt}.parquet" if now[0] in of.split else f"{folder}/{name}-{now[0]:05d}-{attempt}.parquet", keys)
                file.add(pa.RecordBatch.from_arrays(keys.decode(batch.column(1).slice(a, b - a)), schema=keys.arrow))
        if file is not None:
            yield file.close(*now)

    return run


def _joining(keys: RowKeys, folder: str, name: str):
    """One file for each group of (grp, runs), from its runs in order."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for grp, runs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                out = _File(f"{folder}/{name}-{grp:05d}-{uuid.uuid4().hex[:12]}.parquet", keys)
                for x in runs:
                    files, path = place(x["path"])
                    with files.open_input_file(path) as source:
                        for rows in pq.ParquetFile(source).iter_batches(GROUP_ROWS):
                            out.add(rows.cast(keys.arrow))
                yield out.close(grp, 0)

    return run


def keyed(rows: DataFrame, keys: RowKeys, *more: str) -> DataFrame:
    """(more columns, key) of rows that begin with the key's columns."""
    n = len(keys.names)
    kept = rows.select(*rows.columns[:n], *more)
    types = ", ".join(f"{c} {kept.schema[c].dataType.simpleString()}" for c in more)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[n:], keys.encode(batch.columns[:n])], names=[*more, "key"])

    return kept.mapInArrow(run, f"{types}, key binary")


def sorted_files(rows: DataFrame, counts: dict[int, int], keys: RowKeys, folder: str, name: str) -> DataFrame:
    """Writes rows (grp, key) as one sorted file for each group; (grp, path, n_rows, ids_sha256) of the files.

    counts: the rows of each group. ids_sha256 is of the first column.
    """
    spark = rows.sparkSession
    if not counts:
        return spark.createDataFrame([], _FILE).drop("part")
    of = cells(rows, counts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.select("grp", "key").mapInArrow(_with_part(of), "grp int, key binary, part int")
    dealt = dealt.repartitionById(of.n_parts, F.col("part")).sortWithinPartitions("grp", "key")
    files = cut_lineage(dealt.mapInArrow(_writing(of, keys, folder, name), _FILE))
    whole = files.where(~F.col("grp").isin(sorted(of.split))) if of.split else files
    if of.split:
        runs = files.where(F.col("grp").isin(sorted(of.split))).groupBy("grp").agg(F.sort_array(F.collect_list(F.struct("part", "path"))).alias("runs"))  # as many as parts
        whole = whole.union(cut_lineage(runs.repartition("grp").mapInArrow(_joining(keys, folder, name), _FILE)))
        delete(spark, f"{folder}.runs")
    return whole.drop("part")


def bucket(key: Column, buckets: int = BUCKETS, salt: str = "s") -> Column:
    """Unsigned crc32 of the salt and the decimal number, modulo `buckets`."""
    return (F.crc32(F.concat(F.lit(salt), key.cast("string")).cast("binary")) % buckets).cast("int")


def _counts(rows: DataFrame) -> dict[int, int]:
    return {r["grp"]: r["count"] for r in rows.groupBy("grp").count().collect()}  # groups


def start_files(rows: DataFrame, number: Column, keys: RowKeys, folder: str) -> DataFrame:
    """The table `rows` as numbered sorted files in a folder; (grp, path, n_rows, ids_sha256)."""
    (grp,) = fresh(rows.columns, "grp")
    own = rows.withColumn(grp, number)
    counts = _counts(own.select(F.col(grp).alias("grp")))
    return cut_lineage(sorted_files(keyed(own, keys, grp).withColumnRenamed(grp, "grp"), counts, keys, folder, "start"))


def rewrite(spark: SparkSession, started: DataFrame, keys: RowKeys, folder: str, of: DataFrame | None, key: str, buckets: int) -> tuple[DataFrame, DataFrame]:
    """(files, flows): the final files of a table, and (grp, start, n, joined), how many rows each starting file gives to each bucket.

    started: what `start_files` gave. of: (id, n), how often each id is in the table that decides on buckets; none for that table itself.
    """
    names = fresh(keys.names, "start", "grp", "id", "n")
    start, grp, id_, n = names
    paths = [r["path"] for r in started.select("path").collect()]  # starting files
    rows = spark.read.schema(keys.schema).parquet(*paths) if paths else spark.createDataFrame([], keys.schema)
    number = F.regexp_extract(F.col("_metadata.file_name"), r"start-(\d+)-", 1).cast("int") if paths else F.lit(0)
    rows = rows.select("*", number.alias(start))
    if of is None:
        rows = rows.withColumns({grp: F.coalesce(bucket(F.col(key), buckets), F.lit(buckets + 1)), n: F.lit(0).cast("long")})
    else:
        rows = rows.join(of.toDF(id_, n).hint("merge"), F.col(key) == F.col(id_), "left")  # never broadcast, as ids grow with the input
        own = F.when(F.col(key).isNull(), buckets + 1).when(F.col(id_).isNull(), buckets).otherwise(bucket(F.col(key), buckets))
        rows = rows.withColumns({grp: own, n: F.coalesce(n, F.lit(0))})
    staged, path = written(keyed(rows.select(*keys.names, start, grp, n), keys, start, grp, n).toDF("start", "grp", "n", "key"))
    flows = cut_lineage(staged.groupBy("grp", "start").agg(F.count("*").alias("n"), F.sum("n").alias("joined")))  # starting files by buckets
    alone = flows.groupBy("grp").agg(F.count("*").alias("c"), F.min("start").alias("start")).where("c = 1").select("grp", "start")
    alone = alone.join(flows.groupBy("start").agg(F.count("*").alias("c")).where("c = 1").select("start"), "start").select("start", "grp")
    stay = {r["grp"]: r["start"] for r in alone.collect()}  # buckets
    moved = staged.where(~F.col("grp").isin(sorted(stay)))
    totals = {r["grp"]: r["n"] for r in flows.groupBy("grp").agg(F.sum("n").alias("n")).collect() if r["grp"] not in stay}  # buckets
    new = sorted_files(moved, totals, keys, folder, "bucket").withColumn("rewritten", F.lit(True))
    kept = spark.createDataFrame(list(stay.items()), "bucket int, grp int").join(started, "grp").select(F.col("bucket").alias("grp"), "path", "n_rows", "ids_sha256", F.lit(False).alias("rewritten"))
    files = cut_lineage(new.select("grp", "path", "n_rows", "ids_sha256", "rewritten").union(kept))
    delete(spark, path)
    return files, flows


def _tidy(spark: SparkSession, folder: str, files: DataFrame) -> None:
    """Deletes what is in a folder but not in `files`."""
    kept = {posixpath.basename(r["path"]) for r in files.select("path").collect()}  # buckets
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    hadoop = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in hadoop.listStatus(path) if hadoop.exists(path) else []:
        if status.getPath().getName() not in kept:
            hadoop.delete(status.getPath(), True)


def co_bucket(sales: DataFrame, lines: DataFrame, start_numbers: tuple[Column, Column], key: str = "sale_id", buckets: int = BUCKETS, names: tuple[str, str] = ("sales", "sale_lines")) -> DataFrame:
    """(table_name, path, columns, bucket, n_rows, n_joined, ids_sha256, lineage_sha256, rewritten) of the final files.

    Both tables begin with their integer column `key`. start_numbers: of the file in which each row of a table starts.
    """
    spark = sales.sparkSession
    folder = f"{shared_folder(spark)}/pair-{uuid.uuid4().hex}"
    ids, path = written(sales.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("id")).agg(F.count("*").alias("n")))
    out, joined = [], None
    for name, rows, number, of in ((names[1], lines, start_numbers[1], ids), (names[0], sales, start_numbers[0], None)):
        if rows.columns[0] != key:
            raise ValueError(f"{key} must be the first column of {name}")
        keys, own = RowKeys(rows.schema, (key,)), f"{folder}/{name}"
        started = start_files(rows, number, keys, own)
        files, flows = rewrite(spark, started, keys, own, of, key, buckets)
        _tidy(spark, own, files)
        if of is not None:
            joined = flows.groupBy("grp").agg(F.sum("joined").alias("joined"))
        lineage = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start", "n"))), lambda x: F.concat_ws(":", x["start"], x["n"])), ",")
        lineage = flows.groupBy("grp").agg(F.sha2(lineage, 256).alias("lineage_sha256"))  # starting files
        all_ = files.join(lineage, "grp").join(joined, "grp", "left")
        n_joined = F.when(F.col("grp") < buckets, F.coalesce("joined", F.lit(0))).otherwise(F.lit(0)).cast("long")
        out.append(all_.select(F.lit(name).alias("table_name"), "path", F.lit(",".join(rows.columns)).alias("columns"), F.col("grp").cast("long").alias("bucket"), "n_rows", n_joined.alias("n_joined"), "ids_sha256", "lineage_sha256", "rewritten"))
    delete(spark, path)
    return out[1].unionByName(out[0])


def op12_bucketed_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("sales", "sale_lines"))
    b = F.coalesce(bucket(F.col("sale_id")), F.lit(BUCKETS + 1))
    return co_bucket(sales, lines, (F.when(b % 4 == 1, b - 1).otherwise(b), F.coalesce(bucket(F.col("item_id"), salt=""), F.lit(0))))
