"""Cut lineage: tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import hashlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Only a session on one machine gets one of its own where none is set."""
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    root = spark.conf.get("spark.checkpoint.dir", None) or (held.get() if held.isDefined() else None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        made = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        root = "file://" + made
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back."""
    path = f"{shared_dir(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a written table that every task may hold.
HELD_ROWS = 100_000


def held(df: DataFrame, most: int = HELD_ROWS) -> DataFrame:
    """A written table for a join: held by every task if its rows are few, else dealt by key.

    Rows decide, not the size of the files: compressed, these are a small part of what the driver would hold.
    """
    return df.hint("broadcast" if df.limit(most + 1).count() <= most else "merge")


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, in any store that Spark writes to; it replaces an older one."""
    at, fs = _fs(spark, path)
    stream = fs.create(at, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None where there is none."""
    at, fs = _fs(spark, path)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def stamp(spark: SparkSession, *paths: str) -> str:
    """Digest of the names, lengths and times of all files under the paths; no file is opened. What is missing counts as such."""
    leaves = []
    for path in paths:
        at, fs = _fs(spark, path)
        if not fs.exists(at):
            leaves.append(f"{path} missing")
            continue
        it = fs.listFiles(at, True)
        files = []
        while it.hasNext():
            f = it.next()
            files.append(f"{f.getPath()} {f.getLen()} {f.getModificationTime()}")
        leaves.append(hashlib.md5("\n".join(sorted(files)).encode()).hexdigest())
    return hashlib.md5("\n".join(leaves).encode()).hexdigest()
