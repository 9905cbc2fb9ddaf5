"""Files that tasks read and write whole, in the file systems that Arrow knows (file, hdfs, s3, gs, abfs)."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import SparkSession

#: Bytes that are copied at once.
COPY = 1 << 20


def hadoop(spark: SparkSession, path: str) -> tuple:
    """(path, file system) of Hadoop."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def located(spark: SparkSession, path: str) -> str:
    """A path with the scheme that it has by the session's configuration, as tasks have no such."""
    target, system = hadoop(spark, path)
    return re.sub("^file:/+", "file:///", system.makeQualified(target).toString())


def place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


@contextmanager
def writing(uri: str) -> Iterator[pa.NativeFile]:
    """A file to write from a task: under a name of its own first, so that a lost or repeated attempt leaves no half of it."""
    system, path = place(uri)
    own = f"{path}.{uuid.uuid4().hex}"
    system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(own, compression=None) as out:
        yield out
    if system.get_file_info(path).type != pafs.FileType.NotFound:
        system.delete_file(path)
    system.move(own, path)


def put(uri: str, chunks: Iterable[bytes]) -> None:
    with writing(uri) as out:
        for chunk in chunks:
            out.write(chunk)


def pieces(source) -> Iterator[bytes]:
    """What is left of an open file, COPY bytes at a time."""
    while chunk := source.read(COPY):
        yield chunk


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file over another one in one step."""
    jvm = spark.sparkContext._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    a, b = hadoop(spark, source)[0], hadoop(spark, target)[0]
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(hadoop(spark, target)[1].makeQualified(b).toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(a, b, options)
