"""Session helpers: a local session for tests and tools, and shipping of this package to executors."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from docketlake.places import remove_folder

_SHIPPED: set[str] = set()
#: Folders written in the shared one, by application.
_WRITTEN: dict[str, list[str]] = {}
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
FILE_FACTOR = "spark.sql.sources.fileCompressionFactor"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, set up as the tests and the benchmark need it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("docketlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the executors' Python workers, once for each application.

    Arrow batches of whole texts are held to a thousand rows: a worker has a few copies of a batch in memory. Tables are
    taken to be four times as large as their files, which are compressed, before one is broadcast. Both only where the
    session has Spark's defaults.
    """
    context = spark.sparkContext
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "1000")
    if float(spark.conf.get(FILE_FACTOR)) == 1.0:
        spark.conf.set(FILE_FACTOR, "4.0")
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="docketlake-")
    target = os.path.join(folder, "docketlake_src.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one that the session names. Only a session on this machine gets one of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="docketlake-checkpoints-"))
        current = context.getCheckpointDir()
    return current


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared one, which ``clear_settled`` removes."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def settled(df):
    """``df`` computed once and written to the checkpoint folder as a table, so that lost executors cost no recomputation.

    Unlike a checkpoint the table tells its real size, so joins of it are planned right however many steps led to it. It
    stays until ``clear_settled`` is called, since what an operator returns may still read it.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, "docketlake")
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def clear_settled(spark: SparkSession) -> int:
    """Removes the tables and files that operators and queries of this application have written so far; how many there were.

    To be called when their results have been read or written elsewhere: DataFrames that rest on them cannot be computed
    after that. Checkpoints of Spark's own are removed by ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    return sum(remove_folder(folder) for folder in _WRITTEN.pop(spark.sparkContext.applicationId, []))


def settled_in_place(df):
    """``df`` written to the checkpoint folder with its partitions and the order of rows in them."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
