"""Tables with keyed writes: copy-on-write by key buckets, and a manifest that is swapped last.

A write puts the new state of the touched buckets beside the old one and then adds the next manifest, which
names the folder of every bucket. Readers take the latest manifest, so a write that dies leaves the old
table as it was, and of two writers on one version the second fails. Files go through Spark and the
store's own interface, so any store that Spark reads will do.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
#: Parts of a bucket's rows in a write: a hot key, as one source with a third of the rows, is not one file.
SALTS = 8


class WriteConflict(RuntimeError):
    """Another write has put the next version in place."""


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def version(self) -> int:
        """Number of the latest manifest, 0 without any."""
        folder = self._at("manifest")
        if not self._fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json")], default=0)

    def manifest(self, version: int | None = None) -> dict:
        """keys, schema and the folder of each bucket that has rows."""
        stream = self._fs.open(self._at(f"manifest/{version or self.version():012d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _publish(self, version: int, content: dict) -> None:
        """The manifest appears whole under its name, or not at all."""
        final, draft = self._at(f"manifest/{version:012d}.json"), self._at(f"manifest/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(content).encode()))
        stream.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise WriteConflict(f"version {version} of {self.path} is there already")

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version (the latest if None), or of some buckets of it."""
        held = self.manifest(version)
        folders = [d for b, d in sorted(held["buckets"].items()) if buckets is None or int(b) in buckets]
        if not folders:
            return self.spark.createDataFrame([], held["schema"])
        return self.spark.read.schema(held["schema"]).parquet(*[f"{self.path}/{d}" for d in folders])

    def replace(self, rows: DataFrame, keys: Sequence[str]) -> int:
        """Rows with a key that ``rows`` brings are replaced by its rows, the others stay; the new version's number.

        With an id as key this is insert-or-replace (the caller says which of several rows of an id counts), with a source
        as key replacement by source. Null keys are keys. Only the buckets of the keys brought are read and
        rewritten. The keys are the table's for good; columns that one side lacks are null there.
        """
        now = self.version()
        held = self.manifest(now) if now else {"keys": list(keys), "schema": None, "buckets": {}}
        if held["keys"] != list(keys):
            raise ValueError(f"the table is keyed by {held['keys']}")
        bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
        touched = sorted(b for (b,) in rows.select(bucket.alias("b")).distinct().collect())  # BUCKETS at most
        if not touched:
            return now
        new = rows
        if now:
            old = self.read(now, touched)
            brought = rows.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
            new = old.join(brought, [same[0], *same[1:]], "left_anti").unionByName(rows, allowMissingColumns=True)
        dealt = new.withColumn("__bucket", bucket).withColumn("__salt", F.pmod(F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in new.columns]))), F.lit(SALTS)))
        folder = f"data/{now + 1:012d}-{uuid.uuid4().hex}"
        dealt.repartition("__bucket", "__salt").drop("__salt").write.partitionBy("__bucket").parquet(f"{self.path}/{folder}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)  # old columns first
        there = {f.getPath().getName() for f in self._fs.listStatus(self._at(folder))}
        buckets = {b: d for b, d in held["buckets"].items() if int(b) not in touched}
        buckets |= {str(b): f"{folder}/__bucket={b}" for b in touched if f"__bucket={b}" in there}
        self._publish(now + 1, {"keys": list(keys), "schema": ddl, "buckets": buckets})
        return now + 1

    def vacuum(self, keep: int = 2) -> None:
        """Removes what only versions before the last ``keep`` name."""
        last = self.version()
        kept = range(max(1, last - keep + 1), last + 1)
        named = {d.split("/")[1] for v in kept for d in self.manifest(v)["buckets"].values()}
        for v in range(1, kept.start):
            self._fs.delete(self._at(f"manifest/{v:012d}.json"), False)
        for f in self._fs.listStatus(self._at("data")) if last else []:
            if f.getPath().getName() not in named:
                self._fs.delete(f.getPath(), True)
