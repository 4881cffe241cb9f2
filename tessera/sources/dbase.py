"""dBASE tables as a data source: records have one width, so a file is read in ranges of them, each in a task of its own.

Files are opened through Arrow's file systems (local paths, and the stores that Arrow knows by their scheme);
no task holds more than its range, and the driver reads the header alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Bytes of a range, and records that are turned into columns at once.
RANGE_BYTES = 16 << 20
BATCH_ROWS = 50_000


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Header:
    records: int
    start: int
    width: int
    fields: list[tuple[str, int, int]]  # name, first and last byte of a record

    @classmethod
    def read(cls, path: str) -> Header:
        store, at = _store(path)
        with store.open_input_file(at) as f:
            head = f.read(32)
            records, start, width = (int.from_bytes(head[a:b], "little") for a, b in ((4, 8), (8, 10), (10, 12)))
            told = f.read(max(0, start - 32))
        fields, byte = [], 1  # the first byte marks a deleted record
        for i in range(0, len(told) - 31, 32):
            if told[i] == 0x0D:
                break
            size = told[i + 16]
            fields.append((told[i : i + 11].split(b"\0")[0].decode("latin-1"), byte, byte + size))
            byte += size
        return cls(records, start, width, fields)


class Records(InputPartition):
    """Records from ``first`` up to ``last``."""

    def __init__(self, first: int, last: int):
        self.first, self.last = first, last


class DbaseReader(DataSourceReader):
    def __init__(self, path: str, names: list[str], range_bytes: int):
        self.path, self.names, self.header = path, names, Header.read(path)
        self.range_bytes = range_bytes

    def partitions(self) -> list[Records]:
        step = max(1, self.range_bytes // max(1, self.header.width))
        return [Records(a, min(a + step, self.header.records)) for a in range(0, self.header.records, step)] or [Records(0, 0)]

    def read(self, partition: Records) -> Iterator[pa.RecordBatch]:
        head, wanted = self.header, {name: (a, b) for name, a, b in self.header.fields}
        store, at = _store(self.path)
        with store.open_input_file(at) as f:
            for first in range(partition.first, partition.last, BATCH_ROWS):
                n = min(BATCH_ROWS, partition.last - first)
                f.seek(head.start + first * head.width)
                data = f.read(n * head.width)
                held = np.frombuffer(data, dtype=np.uint8)[: len(data) // head.width * head.width].reshape(-1, head.width)
                alive = np.flatnonzero(held[:, 0] != ord("*"))
                cols = [pa.array(alive + first, type=pa.int64())]
                for name in self.names[1:]:
                    a, b = wanted[name]
                    cells = np.ascontiguousarray(held[alive, a:b]).view(f"S{b - a}").ravel() if b > a else np.full(len(alive), b"")
                    text = [c.decode("latin-1").strip() for c in cells.tolist()]
                    cols.append(pa.array([t or None for t in text], type=pa.string()))
                yield pa.RecordBatch.from_arrays(cols, self.names)


class DbaseSource(DataSource):
    """Columns: ``ord``, the number of the record, and the fields as trimmed text, null where blank; deleted records are left out."""

    @classmethod
    def name(cls) -> str:
        return "dbase"

    def schema(self) -> StructType:
        fields = Header.read(self.options["path"]).fields
        return StructType([StructField("ord", LongType()), *(StructField(name, StringType()) for name, _, _ in fields)])

    def reader(self, schema: StructType) -> DbaseReader:
        return DbaseReader(self.options["path"], schema.fieldNames(), int(self.options.get("rangeBytes", RANGE_BYTES)))


def read_dbase(spark: SparkSession, path: str, *, range_bytes: int = RANGE_BYTES):
    spark.dataSource.register(DbaseSource)
    return spark.read.format("dbase").option("rangeBytes", range_bytes).load(path)
