"""Shared plumbing: table access, shared scratch tables, byte tokenisers."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Java / RE2 class of the contracts' two word definitions.
SPACE_CLASS = r"[\x20\x09-\x0D]"
NONSPACE_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

#: Byte table: A-Z lowered, every byte outside [0-9a-z\x80-\xff] becomes a blank.
_ALNUM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage: spark.checkpoint.dir. Only a session on one machine (as in tests) gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        made = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        spark.sparkContext.setCheckpointDir("file://" + made)
        root = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts lineage in a place every executor can read, so a lost executor costs no recomputation, and
    several consumers scan the narrow columnar copy instead of repeating the work above it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def alnum_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    return text.translate(_ALNUM).split() if text else []


def alnum_bytes(text: bytes) -> bytes:
    """The text with A-Z lowered and all that parts words as blanks."""
    return text.translate(_ALNUM)


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """The text in pieces of about ``most`` bytes, cut at blanks; a longer word stays whole."""
    at = 0
    while at < len(text):
        to = min(len(text), at + most)
        if to < len(text):  # up to the last blank; a longer word ends at the next one
            cut = text.rfind(b" ", at, to)
            to = cut if cut > at else text.find(b" ", to)
            to = len(text) if to < 0 else to
        yield text[at:to]
        at = to + 1


def space_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; null has none."""
    return text.lower().split() if text else []


def binary(batch, name: str) -> list[bytes | None]:
    """A string column of an Arrow batch as Python bytes."""
    import pyarrow as pa

    return batch.column(name).cast(pa.large_binary()).to_pylist()


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and exclusive ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]
