"""Batch pipeline: ordered steps over DataFrames, Parquet checkpoints, resume, skip, review table, event log."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import chrono
from .operators import dedup, match, rows
from .operators.aggregate import union_all
from .operators.shared import read_text, stamp, write_text
from .sources.readers import UnsupportedFormatError, read_source
from .sources.writers import export

STEPS = ("INGEST", "EXTRACT", "NORMALIZE", "DEDUPLICATE", "GEOCODE", "VALIDATE", "EXPORT")
#: Columns of a raw record.
RAW = (
    ("raw_text", "string"), ("commune", "string"), ("type_mention", "string"), ("periode_mention", "string"), ("page_number", "int"), ("latitude_raw", "double"),
    ("longitude_raw", "double"), ("source_path", "string"), ("extraction_method", "string"), ("extra", "map<string,string>"),
)


@dataclass
class Config:
    """sources: dicts of path, type, method, options, mapping (columns of the file -> of a raw record).

    chrono, departments and countries are the filters after INGEST; None switches one off. providers
    are lookup tables by country (commune, x, y), asked in turn; gazetteer serves every country.
    """

    sources: list[dict]
    out: str
    merge: float = dedup.MERGE
    review: float = dedup.REVIEW
    chrono: bool = True
    departments: Sequence[int] | None = (67, 68)
    countries: Sequence[str] | None = ("FR", "DE", "CH")
    gazetteer: DataFrame | None = None
    providers: dict[str, Sequence[DataFrame]] = field(default_factory=dict)

    def digest(self, step: str) -> str:
        """Of what the step's result depends on beside its input."""
        own = {"INGEST": ("sources", "chrono", "departments", "countries"), "DEDUPLICATE": ("merge", "review")}.get(step, ())
        return hashlib.md5(json.dumps({k: getattr(self, k) for k in own}, sort_keys=True, default=str).encode()).hexdigest()


class MissingCheckpointError(FileNotFoundError):
    """A step before the requested start has not been run."""


def _content(df: DataFrame):
    """Aggregates that make an order-insensitive hash of the rows."""
    return F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))).cast("decimal(38,0)")).alias("h")


def _mark(n, h) -> str:
    return hashlib.md5(json.dumps([str(n), str(h)]).encode()).hexdigest()


def fingerprint(df: DataFrame) -> str:
    """Order-insensitive content hash."""
    return _mark(*df.agg(*_content(df)).first())


def table_mark(df: DataFrame) -> str:
    """Of a table over files the digest of their names, lengths and times and of its plan, of any other its content hash."""
    files = df.inputFiles()
    return f"{stamp(df.sparkSession, *sorted(files))}{df.semanticHash()}" if files else fingerprint(df)


def raw_records(df: DataFrame) -> DataFrame:
    """The columns of a raw record; what is missing is null, other columns go into ``extra`` as text."""
    known = dict(RAW)
    kinds = dict(df.dtypes)
    spare = [c for c in df.columns if c not in known]
    held = F.map_filter(F.create_map(*[x for c in spare for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]), lambda _, v: v.isNotNull() & (v != "")) if spare else F.lit(None).cast(known["extra"])
    extra = dedup.map_right_wins(held, F.col("extra")) if kinds.get("extra", "").startswith("map") else held
    one = lambda c, t: F.lit(None).cast(t) if c not in kinds else F.col(c).try_cast(t)
    return df.select(*[one(c, t).alias(c) for c, t in RAW[:-1]], extra.alias("extra"))


def _ingest(spark: SparkSession, config: Config) -> tuple[list[DataFrame], list[tuple[str, str]]]:
    frames, failed = [], []
    for s in config.sources:
        try:
            read = read_source(spark, s["path"], s.get("type"), mapping=s.get("mapping"), **s.get("options", {}))
        except UnsupportedFormatError as e:
            failed.append((s["path"], str(e)))
            continue
        method = F.lit(s.get("method", s.get("type", "csv")))
        kept = {"source_path": F.lit(s["path"]), "extraction_method": method}  # unless the rows say it themselves
        frames.append(raw_records(read.withColumns({c: F.coalesce(F.col(c), v) if c in read.columns else v for c, v in kept.items()})))
    return frames, failed


def retained(raw: DataFrame, config: Config) -> DataFrame:
    """The chronological and geographic filters; what is not stated passes the geographic one."""
    e = lambda k: F.nullif(F.try_element_at("extra", F.lit(k)), F.lit(""))
    listed = lambda k, by: F.coalesce(F.split(e(k), by), F.expr("cast(array() as array<string>)"))
    old = chrono.iron_age(F.col("periode_mention"), flags=listed("phases_bool", ","), mentions=listed("datation_mentions", ";"), start=e("datation_debut").try_cast("int"), end=e("datation_fin").try_cast("int"), method=F.col("extraction_method"))
    department = chrono.department(e("departement"), e("dept_land"), identifier=e("patriarche_ea"))
    place = rows.area_ok(F.coalesce(e("pays"), F.lit("")), department, config.departments, config.countries)
    return raw.where((old if config.chrono else F.lit(True)) & place)


def geocode(sites: DataFrame, tables: Sequence[tuple[str | None, DataFrame]]) -> DataFrame:
    """Sites without a position take their commune's, from the first table that knows it.

    tables: (country or None for any, table of commune, x, y) in order of trust. A found position is a
    centroid. Sites with a position or without a commune stay as they are.
    """
    out = sites.withColumn("__key", F.when((F.col("x_l93").isNull() | F.col("y_l93").isNull()) & (F.trim("commune") != ""), F.lower(F.trim("commune"))))
    found = []
    for i, (country, table) in enumerate(tables):
        g = match.first_wins(table.withColumn("__k", F.lower(F.trim("commune"))), ["__k"], [F.col("x"), F.col("y")])
        out = out.join(g.select(F.col("__k").alias(f"__k{i}"), F.struct("x", "y").alias(f"__p{i}")), F.col("__key") == F.col(f"__k{i}"), "left")
        found.append(F.col(f"__p{i}") if country is None else F.when(F.col("pays") == country, F.col(f"__p{i}")))
    out = out.withColumn("__hit", F.coalesce(*found) if found else F.lit(None).cast("struct<x:double,y:double>"))
    hit = F.col("__hit").isNotNull()
    placed = {"x_l93": F.when(hit, F.col("__hit.x")).otherwise(F.col("x_l93")), "y_l93": F.when(hit, F.col("__hit.y")).otherwise(F.col("y_l93")), "precision_localisation": F.when(hit, "centroïde").otherwise(F.col("precision_localisation"))}
    return out.withColumns(placed).select(*sites.columns)


def _review(rows_: DataFrame, step: str, subject: str, reason) -> DataFrame:
    return rows_.select(F.lit(step).alias("step"), F.col(subject).cast("string").alias("subject"), reason.alias("reason"))


class Runner:
    """Runs the steps; each result is a checkpoint with a manifest of its input's and its own hash."""

    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.reviews: list[DataFrame] = []
        self.changed = False

    def path(self, name: str) -> str:
        return f"{self.config.out}/checkpoints/{name}"

    def log(self, step: str, event: str, **facts) -> None:
        """Add one line to the event log, as a file of its own."""
        line = json.dumps({"step": step, "event": event, "ts": round(time.time(), 3), **facts}, sort_keys=True, default=str)
        write_text(self.spark, f"{self.config.out}/log/{time.time_ns()}-{uuid.uuid4().hex}.txt", line + "\n")

    def manifest(self, step: str) -> dict | None:
        """input, config, output and files of the step's last run, and what it noted beside."""
        held = read_text(self.spark, self.path(f"{step}.manifest"))
        return json.loads(held) if held else None

    def step(self, name: str, source: str, make: Callable[[], DataFrame], note: Callable[[], dict] = dict) -> tuple[DataFrame, str]:
        """The step's result and its content hash; made anew unless its last input had the hash ``source``.

        The hash is taken while the rows are written and kept in the manifest beside a digest of the files, so
        a step that is skipped reads no rows.
        """
        held, own = self.manifest(name), self.config.digest(name)
        skip = held is not None and (held["input"], held["config"]) == (source, own)
        self.log(name, "start", input=source)
        if skip:
            out, mark = self.held(name)
        else:
            made, seen = make(), Observation()
            made.observe(seen, *_content(made)).write.mode("overwrite").parquet(self.path(name))
            out, mark = self.spark.read.parquet(self.path(name)), _mark(seen.get["n"], seen.get["h"])
            self.changed = True
            write_text(self.spark, self.path(f"{name}.manifest"), json.dumps({"input": source, "config": own, "output": mark, "files": stamp(self.spark, self.path(name)), "schema": out.schema.json(), **note()}))
        self.log(name, "skipped" if skip else "end", output=mark)
        return out, mark

    def table(self, name: str, schema: str) -> DataFrame:
        """A stored table under its known schema, so that no file is opened for it."""
        return self.spark.read.schema(T.StructType.fromJson(json.loads(schema))).parquet(self.path(name))

    def held(self, name: str) -> tuple[DataFrame, str]:
        """A step's result and content hash from its checkpoint; rows are read only if its files are not those it wrote."""
        held = self.manifest(name)
        if held is None:
            raise MissingCheckpointError(self.path(name))
        out = self.table(name, held["schema"])
        return out, held["output"] if held["files"] == stamp(self.spark, self.path(name)) else fingerprint(out)

    def run(self, start: str = STEPS[0]) -> dict[str, DataFrame]:
        config, at = self.config, STEPS.index(start)
        do = lambda name, *how: self.step(name, *how) if STEPS.index(name) >= at else self.held(name)

        failed: list[tuple[str, str]] = []

        def ingested() -> DataFrame:
            frames, bad_ = _ingest(self.spark, config)
            failed.extend(bad_)
            return retained(union_all(frames), config) if frames else self.spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in RAW))

        source = stamp(self.spark, *[s["path"] for s in config.sources]) if at == 0 else ""
        raw, mark = do("INGEST", source, ingested, lambda: {"failed": failed})
        if told := self.manifest("INGEST")["failed"]:  # also where a run starts later
            self.reviews.append(self.spark.createDataFrame([("INGEST", *f) for f in told], "step string, subject string, reason string"))

        blank = F.array(F.when((F.trim(F.coalesce("raw_text", F.lit(""))) == "") & (F.coalesce("commune", F.lit("")) == ""), "empty raw_text and commune"))
        kept, rejected = rows.split_rejects(raw, blank)
        self.reviews.append(_review(rejected, "EXTRACT", "source_path", F.get("rejects", F.lit(0))))
        records, mark = do("EXTRACT", mark, lambda: kept)

        # A repeated id keeps its first record by content.
        sites, mark = do("NORMALIZE", mark, lambda: match.first_wins(rows.normalise(records), ["site_id"], [F.to_json(F.struct("*"))]))
        first = F.get("phases", F.lit(0))
        good, bad = rows.split_rejects(sites, rows.site_rejects(F.col("x_l93"), F.col("y_l93"), first["periode"], first["sous_periode"], F.col("nom_site")))
        self.reviews.append(_review(bad, "NORMALIZE", "site_id", F.array_join("rejects", ";")))

        def merged() -> DataFrame:
            out, pairs, told = dedup.deduplicate(good, merge=config.merge, review=config.review)
            pairs.write.mode("overwrite").parquet(self.path("DEDUPLICATE.review"))
            told.write.mode("overwrite").parquet(self.path("DEDUPLICATE.report"))
            return out

        side = ("DEDUPLICATE.review", "DEDUPLICATE.report")
        sites, mark = do("DEDUPLICATE", mark, merged, lambda: {x: self.spark.read.parquet(self.path(x)).schema.json() for x in side})
        beside = self.manifest("DEDUPLICATE")
        pairs, told_ = (self.table(x, beside[x]) for x in side)
        self.reviews.append(pairs.select(F.lit("DEDUPLICATE").alias("step"), F.concat_ws("|", "site_id_a", "site_id_b").alias("subject"), F.concat_ws(":", F.lit("similarity_review"), F.col("score").cast("string")).alias("reason")))

        tables = [(c, x) for c, many in config.providers.items() for x in many] + ([(None, config.gazetteer)] if config.gazetteer is not None else [])
        known = "".join([mark, *(f"{c}{table_mark(x)}" for c, x in tables)])
        sites, mark = do("GEOCODE", known, lambda: geocode(sites, tables))
        lost = sites.where("(x_l93 is null or y_l93 is null) and trim(commune) <> ''")
        self.reviews.append(_review(lost, "GEOCODE", "site_id", F.lit("lookup_failed")))

        warned = sites.select("site_id", F.explode("phases").alias("p")).select("site_id", F.explode(chrono.warnings(F.col("p.periode"), F.col("p.sous_periode"), F.col("p.datation_debut"), F.col("p.datation_fin"))).alias("w"))
        self.reviews.append(_review(warned, "VALIDATE", "site_id", F.concat_ws(":", F.lit("chrono"), "w.field", "w.message")))
        placed = sites.select("site_id", F.explode(rows.geo_warnings(F.col("x_l93"), F.col("y_l93"))).alias("w"))
        self.reviews.append(_review(placed, "VALIDATE", "site_id", F.concat_ws(":", F.lit("geo"), "w")))
        sites, mark = do("VALIDATE", mark, lambda: sites)

        # What depends on the steps alone is written again only if one of them was made, or if it is not whole.
        done = read_text(self.spark, self.path("EXPORT.manifest"))
        if self.changed or done != mark:
            export(sites, f"{config.out}/export")
            union_all(self.reviews).write.mode("overwrite").json(f"{config.out}/review")
            write_text(self.spark, self.path("EXPORT.manifest"), mark)
        self.log("EXPORT", "kept" if not self.changed and done == mark else "end", input=mark)
        review = self.spark.read.schema("step string, subject string, reason string").json(f"{config.out}/review")
        return {"sites": sites, "review": review, "report": told_, "log": self.spark.read.text(f"{config.out}/log")}


def run(spark: SparkSession, config: Config, start: str = STEPS[0]) -> dict[str, DataFrame]:
    """Run the steps from ``start`` on, earlier ones from their checkpoints: sites, review, report, log."""
    return Runner(spark, config).run(start)


def latest(spark: SparkSession, out: str) -> DataFrame:
    """Sites of the last step that has a checkpoint: VALIDATE, else GEOCODE, DEDUPLICATE, NORMALIZE."""
    runner = Runner(spark, Config([], out))
    for step in ("VALIDATE", "GEOCODE", "DEDUPLICATE", "NORMALIZE"):
        if runner.manifest(step) is not None:
            return spark.read.parquet(runner.path(step))
    raise MissingCheckpointError(out)
