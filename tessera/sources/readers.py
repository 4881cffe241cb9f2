"""Source registry: every reader returns a DataFrame; unsupported formats raise."""

from __future__ import annotations

import struct
from collections.abc import Callable
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from . import typed
from .dbase import Header, read_dbase


class UnsupportedFormatError(ValueError):
    """No reader for a source."""


def _head(spark: SparkSession, path: str) -> bytes:
    rows = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, 65536).alias("h")).limit(1).collect()
    return bytes(rows[0]["h"]) if rows else b""


def sniff(head: bytes) -> tuple[str, str]:
    """(encoding, delimiter) from the first lines."""
    try:
        head.decode("utf-8")
        encoding = "UTF-8"
    except UnicodeDecodeError as e:
        encoding = "UTF-8" if e.start > len(head) - 4 else "ISO-8859-1"
    lines = head.decode("latin-1").splitlines()[:5]
    return encoding, max((",", ";", "\t"), key=lambda d: sum(x.count(d) for x in lines))


def _cleaned(df: DataFrame) -> DataFrame:
    """Trimmed cells, blanks null; rows without any go."""
    cells = df.select(*[text.clean(F.col(f"`{c}`")).alias(c.strip("\ufeff ")) for c in df.columns])
    return cells.where(F.coalesce(*[F.col(f"`{c}`") for c in cells.columns]).isNotNull())


def read_csv(spark: SparkSession, path: str, *, sep: str | None = None, encoding: str | None = None) -> DataFrame:
    """Header CSV, cells as text, blanks null, all-empty rows dropped."""
    if not (sep and encoding):
        found = sniff(_head(spark, path))
        encoding, sep = encoding or found[0], sep or found[1]
    df = spark.read.csv(path, header=True, sep=sep, encoding=encoding, multiLine=True, escape='"')
    return _cleaned(df)


def read_two_headers(spark: SparkSession, path: str, *, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """CSV under two header rows (group, sub): columns 'group.sub'; the header is read on the driver, the rows are not."""
    first = spark.read.csv(path, header=False, sep=sep, encoding=encoding, multiLine=True, escape='"')
    head = first.limit(2).collect()
    names = flatten_header(list(head[0]), list(head[1])) if len(head) == 2 else [f"col_{i}" for i in range(len(first.columns))]
    # One file is read in order by one task: the header rows are its first two, whatever stands further down.
    df = first.withColumn("__i", F.monotonically_increasing_id()).where("__i >= 2").drop("__i").toDF(*names)
    return _cleaned(df)


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a 'documents' array."""
    return spark.read.json(path, multiLine=True).select(F.explode("documents").alias("d")).select("d.*")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("raw_text"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON features (a collection, or one a line): their properties, longitude and latitude."""
    df = spark.read.json(path, multiLine=True)
    if "features" in df.columns:
        df = df.select(F.explode("features").alias("f")).select("f.*")
    else:
        df = spark.read.json(path)
    return df.select("properties.*", F.col("geometry.coordinates")[0].alias("longitude"), F.col("geometry.coordinates")[1].alias("latitude"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Text blocks of an ALTO page: source_path, hpos, vpos, width, height, text."""

    def run(batches):
        import re
        from xml.etree import ElementTree

        import pandas as pd

        for pdf in batches:
            made = []
            for p, c in zip(pdf["path"], pdf["content"]):
                root = ElementTree.fromstring(re.sub(rb' xmlns="[^"]+"', b"", bytes(c)))
                for block in root.iter("TextBlock"):
                    box = [float(block.get(k, "0")) for k in ("HPOS", "VPOS", "WIDTH", "HEIGHT")]
                    made.append((p, *box, " ".join(x.get("CONTENT", "") for x in block.iter("String"))))
            yield pd.DataFrame(made, columns=["source_path", "hpos", "vpos", "width", "height", "text"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "source_path string, hpos double, vpos double, width double, height double, text string")


def read_search(spark: SparkSession, path: str) -> DataFrame:
    """Saved answers of a library search (SRU): ark, title, creator, date of each record."""

    def run(batches):
        import re
        from xml.etree import ElementTree

        import pandas as pd

        for pdf in batches:
            made = []
            for c in pdf["content"]:
                root = ElementTree.fromstring(re.sub(rb"(</?)[A-Za-z_]+:", rb"\1", re.sub(rb' xmlns(:\w+)?="[^"]+"', b"", bytes(c))))
                for record in root.iter("record"):
                    get = lambda tag: next((x.text for x in record.iter(tag) if x.text), None)  # noqa: B023, E731
                    ids = [x.text or "" for x in record.iter("identifier")]
                    ark = next((i[i.index("ark:/") :] for i in ids if "ark:/" in i), None)
                    made.append((ark, get("title"), get("creator"), get("date")))
            yield pd.DataFrame(made, columns=["ark", "title", "creator", "date"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "ark string, title string, creator string, date string").where("ark is not null")


def parse_dbf(content: bytes) -> tuple[list[str], list[list[str]]]:
    """Field names and rows of a dBASE table; deleted rows go."""
    n, start, width = struct.unpack("<IHH", content[4:12])
    fields, at = [], 32
    while content[at] != 0x0D:
        fields.append((content[at : at + 11].split(b"\0")[0].decode("latin-1"), content[at + 16]))
        at += 32
    rows = []
    for i in range(n):
        row, at = content[start + i * width : start + (i + 1) * width], 1
        if row[:1] == b"*":
            continue
        cells = []
        for _, size in fields:
            cells.append(row[at : at + size].decode("latin-1").strip())
            at += size
        rows.append(cells)
    return [f for f, _ in fields], rows


def _wide(held: DataFrame) -> DataFrame:
    """(ord, fields map) as columns; the field names, a header's worth, are asked for first."""
    names = [r["k"] for r in held.select(F.explode(F.map_keys("fields")).alias("k")).distinct().orderBy("k").collect()]
    return held.select("ord", *[F.try_element_at("fields", F.lit(n)).alias(n) for n in names])


def read_dbf(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a dBASE table as columns, with the number of their record ``ord``.

    Read in ranges of records where Arrow can open the file; a file in another store is one row of
    Spark's binary source and parsed whole where it is read (``ord`` then counts what is not deleted).
    """
    try:
        Header.read(path)
    except (OSError, ValueError) as e:
        if "://" not in path:
            raise FileNotFoundError(path) from e
    else:
        return read_dbase(spark, path)

    def run(batches):
        import pandas as pd

        for pdf in batches:
            made = []
            for c in pdf["content"]:
                names, rows = parse_dbf(bytes(c))
                made += [(i, {k: v for k, v in zip(names, r) if v != ""}) for i, r in enumerate(rows)]
            yield pd.DataFrame(made, columns=["ord", "fields"])

    return _wide(spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "ord long, fields map<string,string>"))


def read_sheet(spark: SparkSession, path: str, *, sheet: str | None = None, headers: int = 1) -> DataFrame:
    """Rows of one sheet (the first by default) of an XLSX or ODS workbook as columns, with their number ``ord``.

    The first row names the columns, or two rows do ('group.sub'). Parsed where the file is.
    """

    def run(batches):
        import pandas as pd

        from .workbook import sheets

        for pdf in batches:
            made = []
            for c in pdf["content"]:
                book = sheets(bytes(c))
                rows = book.get(sheet) if sheet else next(iter(book.values()), None)
                if not rows:
                    continue
                width = max(map(len, rows))
                padded = [[*r, *[""] * (width - len(r))] for r in rows]
                names = padded[0] if headers == 1 else flatten_header(padded[0], padded[1])
                made += [(i, {n.strip() or f"Unnamed: {j}": v for j, (n, v) in enumerate(zip(names, r)) if v.strip()}) for i, r in enumerate(padded[headers:])]
            yield pd.DataFrame(made, columns=["ord", "fields"])

    held = spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "ord long, fields map<string,string>")
    return _wide(held.where(F.size("fields") > 0))


READERS: dict[str, Callable[..., DataFrame]] = {"csv": read_csv, "json": read_json_documents, "geojson": read_features, "txt": read_text, "dbf": read_dbf, "xlsx": read_sheet, "ods": read_sheet, "alto": read_blocks, "sru": read_search}


def _register(spark: SparkSession, path: str, *, dbf: str | None = None) -> DataFrame:
    return typed.register_rows(read_by_suffix(spark, path), typed.side_table(read_dbf(spark, dbf), "ord") if dbf else None)


def _workbook(spark: SparkSession, path: str, *, sites: str = "sites", occupations: str = "occupations", furniture: str = "mobilier") -> DataFrame:
    return typed.workbook_rows(*[read_sheet(spark, path, sheet=x) for x in (sites, occupations, furniture)])


def _silos(spark: SparkSession, path: str, *, departments=None) -> DataFrame:
    df = read_by_suffix(spark, path)
    return typed.silo_rows(df if "ord" in df.columns else df.withColumn("ord", F.monotonically_increasing_id()), "ord", departments)


#: Known sources: reader and shape of a raw record in one.
SOURCES: dict[str, Callable[..., DataFrame]] = {
    "arkeogis": lambda spark, path, *, filter_age_du_fer=False: typed.exchange_rows(read_csv(spark, path, sep=";"), filtered=filter_age_du_fer),
    "bdd_proto_alsace": lambda spark, path: typed.flagged_rows(read_by_suffix(spark, path)),
    "necropoles": lambda spark, path, *, departments=None: typed.necropolis_rows(read_by_suffix(spark, path), departments),
    "habitats_tombes_riches": lambda spark, path, *, departments=None: typed.rich_rows(read_by_suffix(spark, path), departments),
    "inhumations_silos": _silos,
    "afeaf": lambda spark, path, *, sheet=None: typed.funerary_rows((read_two_headers(spark, path) if path.endswith(".csv") else read_sheet(spark, path, sheet=sheet, headers=2).drop("ord"))),
    "patriarche": _register,
    "alsace_basel": _workbook,
    "cag": lambda spark, path, *, label="cag_68": typed.notice_rows(read_text(spark, path), "source_path", "raw_text", label),
    "gallica_metadata": lambda spark, path: typed.catalogue_rows(read_json_documents(spark, path)),
}


def read_by_suffix(spark: SparkSession, path: str, **options) -> DataFrame:
    kind = PurePosixPath(path).suffix.lstrip(".").lower()
    if kind not in READERS:
        raise UnsupportedFormatError(f"no reader for {path!r} ({kind or 'no suffix'})")
    return READERS[kind](spark, path, **options)


def read_source(spark: SparkSession, path: str, kind: str | None = None, *, mapping: dict[str, str] | None = None, **options) -> DataFrame:
    """Known source or reader by stated kind, else reader by suffix; columns renamed by ``mapping``."""
    if kind and kind not in READERS and kind not in SOURCES:
        raise UnsupportedFormatError(f"no reader for {path!r} ({kind})")
    df = (SOURCES.get(kind) or READERS[kind])(spark, path, **options) if kind else read_by_suffix(spark, path, **options)
    df = df.withColumnsRenamed(mapping) if mapping else df
    return placed_rows(df) if (kind or PurePosixPath(path).suffix.lstrip(".").lower()) == "ods" else df


def placed_rows(df: DataFrame) -> DataFrame:
    """Rows with a commune or an x (not zero); where neither column is there, all."""
    named = {c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in ("commune", "x_l93") if c in df.columns}
    x = F.coalesce(F.replace(named["x_l93"], F.lit(","), F.lit(".")).try_cast("double"), F.lit(0.0)) != 0 if "x_l93" in named else F.lit(False)
    return df.where((named["commune"] != "" if "commune" in named else F.lit(False)) | x) if named else df


def flatten_header(groups: list[str | None], subs: list[str | None]) -> list[str]:
    """Names of a two-row header: 'group.sub', the group filled forward, repeats numbered."""
    names, group, seen = [], "", {}
    for g, s in zip(groups, subs):
        group = (g or "").strip() or group
        s = (s or "").strip()
        name = f"{group}.{s}" if group and s else group or s or "column"
        seen[name] = seen.get(name, 0) + 1
        names.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return names
