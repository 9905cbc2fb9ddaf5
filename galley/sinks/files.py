"""Single files: lines in order, JSON objects keyed by position, and buckets of them.

Parts are written by all tasks. One file of them is copied together by one task, as a stream;
buckets are files of the tasks that have their rows. The driver sees names only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galley.columns import fresh
from galley.operators.keys import bucket_of, dense_ids
from galley.sources.storage import hadoop, located, pieces, place, put


def _copying(parts: list[str], to: str):
    def contents() -> Iterator[bytes]:
        for uri in parts:
            system, path = place(uri)
            with system.open_input_stream(path, compression=None) as source:
                yield from pieces(source)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                put(to, contents())
            yield batch

    return run


def write_lines(lines: DataFrame, path: str) -> None:
    """One text file with the `line`s of (ord, line), by ord."""
    spark = lines.sparkSession
    folder, fs = hadoop(spark, f"{path}.parts")
    rows = lines.select(F.col("ord").cast("long").alias("ord"), "line")
    rows.repartitionByRange("ord").sortWithinPartitions("ord").select("line").write.mode("overwrite").text(folder.toString())
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))  # partitions
    parts = [located(spark, f"{path}.parts/{n}") for n in names if n.startswith("part-")]
    target, _ = hadoop(spark, path)
    fs.delete(target, True)  # with its checksum, if it has one
    spark.range(0, 1, 1, 1).mapInArrow(_copying(parts, located(spark, path)), "id long").collect()
    fs.delete(folder, True)


def _framed(head: str, tail: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lambda texts: pa.RecordBatch.from_arrays([texts], names=["line"])
        yield of(pa.array([head], pa.string()))
        for batch in batches:
            yield of(batch.column(0))  # of one schema, whether lines may be null or not
        yield of(pa.array([tail], pa.string()))

    return run


def write_parts(lines: DataFrame, folder: str, head: str, tail: str) -> None:
    """A folder of text files, whole ones each: `head`, a range of the `line`s of (ord, line) by ord, `tail`. No task has all lines."""
    rows = lines.select(F.col("ord").cast("long").alias("ord"), "line").repartitionByRange("ord").sortWithinPartitions("ord")
    rows.select("line").mapInArrow(_framed(head, tail), "line string").write.mode("overwrite").text(folder)


def _entries(rows: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """(at, entry): each row's place in the order of `order`, from 0, and its entry of a JSON object."""
    (at,) = fresh(rows.columns, "at")
    placed = dense_ids(rows, order, at)
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return placed.select(F.col(at).alias("at"), F.concat(F.lit('"'), F.col(at).cast("string"), F.lit('": '), text).alias("entry"))


def write_positioned(rows: DataFrame, order: str, path: str) -> None:
    """One JSON object in one file: the rows, as objects, by their place in the order of `order`."""
    entries, n = _entries(rows, order, rows.columns), rows.count()
    frame = rows.sparkSession.createDataFrame([(-1, "{"), (n, "}")], "ord long, line string")
    lines = entries.select(F.col("at").alias("ord"), F.when(F.col("at") < n - 1, F.concat("entry", F.lit(","))).otherwise(F.col("entry")).alias("line"))
    write_lines(frame.union(lines), path)


def _bucketing(folder: str):
    """Writes sorted (bucket, at, entry); (bucket) of the files."""

    def done(bucket: int, entries: list[str]) -> pa.RecordBatch:
        put(f"{folder}/{bucket}.json", [("{\n" + ",\n".join(entries) + "\n}\n").encode()])
        return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64())], names=["bucket"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, entries = None, []
        for batch in batches:
            for bucket, entry in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if bucket != now and entries:
                    yield done(now, entries)
                    entries = []
                now = bucket
                entries.append(entry)
        if entries:
            yield done(now, entries)

    return run


def write_buckets(rows: DataFrame, order: str, folder: str, size: int = 1000) -> int:
    """Files 0.json, 1.json and so on with `size` rows each, JSON objects by place; their number."""
    spark = rows.sparkSession
    target, fs = hadoop(spark, folder)
    fs.delete(target, True)
    fs.mkdirs(target)
    entries = _entries(rows, order, rows.columns).select(bucket_of(F.col("at"), size).alias("bucket"), "at", "entry")
    dealt = entries.repartition("bucket").sortWithinPartitions("bucket", "at")  # a bucket is one task's, `size` rows
    return dealt.mapInArrow(_bucketing(located(spark, folder)), "bucket long").count()
