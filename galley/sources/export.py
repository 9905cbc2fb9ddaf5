"""A content system's XML export as DataFrames, zipped or not, and the stores kept between runs."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galley.sources.storage import hadoop, located, pieces, place, put, replace

_TEXT = T.StringType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


_META = T.ArrayType(T.StructType([T.StructField("wp:meta_key", _TEXT), T.StructField("wp:meta_value", _TEXT)]))
_TERM = T.ArrayType(_struct(_domain=_TEXT, _nicename=_TEXT, _VALUE=_TEXT))
# Elements of the export.
AUTHOR_FIELDS = ("wp:author_login", "wp:author_email", "wp:author_display_name", "wp:author_first_name", "wp:author_last_name")
ITEM_FIELDS = {
    "title": "title",
    "content:encoded": "body",
    "description": "description",
    "wp:post_name": "slug",
    "wp:comment_status": "comment_status",
    "wp:post_modified_gmt": "mod_date",
    "wp:post_date_gmt": "pub_date",
}


def _read(spark: SparkSession, path: str, tag: str, schema: T.StructType) -> DataFrame:
    rows = spark.read.format("xml").option("rowTag", tag).option("nullValue", "").option("ignoreNamespace", "false").schema(schema).load(path)
    return rows.withColumn("ord", F.monotonically_increasing_id())  # the place in the file; of several files, one after the other in no order


def _meta(c: str) -> Column:
    return F.transform(F.col(f"`{c}`"), lambda m: F.struct(m["wp:meta_key"].alias("key"), m["wp:meta_value"].alias("value")))


def authors(spark: SparkSession, path: str) -> DataFrame:
    """ord and the five wp:author_* elements of each author."""
    return _read(spark, path, "wp:author", T.StructType([T.StructField(f, _TEXT) for f in AUTHOR_FIELDS]))


def articles(spark: SparkSession, path: str) -> DataFrame:
    """ord, the item's texts, `terms` and `meta`; elements that occur once are arrays of one."""
    schema = T.StructType([*(T.StructField(f, _TEXT) for f in ITEM_FIELDS), T.StructField("category", _TERM), T.StructField("wp:postmeta", _META)])
    rows = _read(spark, path, "item", schema)
    term = F.transform("category", lambda t: F.struct(t["_domain"].alias("domain"), t["_nicename"].alias("nicename"), t["_VALUE"].alias("text")))
    return rows.select("ord", *[F.col(f"`{f}`").alias(c) for f, c in ITEM_FIELDS.items()], term.alias("terms"), _meta("wp:postmeta").alias("meta"))


def guests(spark: SparkSession, path: str) -> DataFrame:
    """ord and meta of each item of the guest file."""
    rows = _read(spark, path, "item", T.StructType([T.StructField("wp:postmeta", _META)]))
    return rows.select("ord", F.coalesce(_meta("wp:postmeta"), F.array().cast("array<struct<key:string,value:string>>")).alias("meta"))


def _members(uri: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            system, path = place(uri)
            for _ in range(len(batch)):
                with system.open_input_file(path) as source, zipfile.ZipFile(source) as z:
                    found = [n for n in z.namelist() if not n.endswith("/") and ".." not in n.split("/")]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], names=["name"])

    return run


def _unpacking(uri: str, to: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                system, path = place(uri)
                with system.open_input_file(path) as source, zipfile.ZipFile(source) as z, z.open(name) as member:
                    put(f"{to}/{name}", pieces(member))
            yield batch

    return run


def unzip(spark: SparkSession, path: str, to: str) -> list[str]:
    """Unpack an archive into a folder of the session's file system; the paths of its members, in their order.

    A member is one stream, of any length, and one task's; the driver gets their names.
    """
    uri = located(spark, path)
    names = [r["name"] for r in spark.range(0, 1, 1, 1).mapInArrow(_members(uri), "name string").collect()]
    if names:
        each = spark.createDataFrame([(n,) for n in names], "name string").repartition(len(names))
        each.mapInArrow(_unpacking(uri, located(spark, to)), "name string").collect()
    return [f"{to}/{n}" for n in names]


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a file or folder; False if there is none."""
    target, fs = hadoop(spark, path)
    return fs.delete(target, True)


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that an earlier run kept; none if the folder is missing or cannot be read."""
    target, fs = hadoop(spark, path)
    if not fs.exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def store(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def current(spark: SparkSession, folder: str) -> str | None:
    """The folder of the version that `publish` named last; none if there is none."""
    target, fs = hadoop(spark, f"{folder}/current")
    if not fs.exists(target):
        return None
    return f"{folder}/{spark.read.text(target.toString()).first()['value']}"


def publish(spark: SparkSession, folder: str, stores: dict[str, DataFrame]) -> str:
    """Stores tables together as a new version in `folder`; its path.

    The version is written in a folder of its own, and only when all of it is there the pointer to it is
    renamed over the last one. So a reader has the one or the other, whole, wherever a run ends. The
    version before stays for those who read it; older ones go.
    """
    before, name = current(spark, folder), f"v-{uuid.uuid4().hex}"
    for table, rows in stores.items():
        store(rows, f"{folder}/{name}/{table}")
    target, fs = hadoop(spark, f"{folder}/next-{name}")
    stream = fs.create(target, True)
    stream.write(name.encode())
    stream.close()
    replace(spark, target.toString(), f"{folder}/current")
    for status in fs.listStatus(hadoop(spark, folder)[0]):  # versions
        other = status.getPath().getName()
        if other.startswith("v-") and other != name and (before is None or other != before.rpartition("/")[2]):
            fs.delete(status.getPath(), True)
    return f"{folder}/{name}"


def merged_conflicts(old: DataFrame, new: DataFrame) -> DataFrame:
    """(ord, conflict): distinct conflicts, the first of equals, old ones first. conflict: a struct."""
    rows = old.select(F.lit(0).alias("run"), "ord", "conflict").union(new.select(F.lit(1).alias("run"), "ord", "conflict"))
    text = F.to_json("conflict", {"ignoreNullFields": "false"})
    first = rows.withColumn("text", text).groupBy("text").agg(F.min(F.struct("run", "ord")).alias("o"), F.first("conflict").alias("conflict"))
    return first.select("o.run", "o.ord", "conflict")
