"""Session helpers: configuration, the shared checkpoint folder and shipping of the package."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_shipped: set[str] = set()


def local_session(cores: str = "8", memory: str = "6g", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("galley")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Rows and bytes of an Arrow batch; the defaults let long texts fill a worker's memory.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Python functions are pickled by reference, so that tokenizers and models which a worker
    has loaded stay loaded between tasks; workers must then be able to import the package.
    """
    for key, value in BATCH.items():
        if spark.conf.get(key, "10000") in ("10000", "268435456", "2147483647"):  # as it comes
            spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="galley"), "galley_package.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Only a session on one machine may leave it unset (as tests do) and gets a temporary folder.
    """
    sc = spark.sparkContext
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="galley-checkpoint"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Checkpoint into the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """`df` written as Parquet into the shared folder and read again, and the path."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def free_unused(spark: SparkSession) -> None:
    """Collects the driver's garbage, upon which Spark removes the shuffle files and checkpoints that nothing refers to any more."""
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
