"""Readers of files: workbooks, dBASE, two header rows, saved answers, and the known sources over them."""

import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from tessera import pipeline
from tessera.operators import reports
from tessera.sources import dbase, readers, typed, workbook

XLSX = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_xlsx(path, sheets):
    """A minimal workbook: shared strings for the first sheet, inline ones after."""
    shared = sorted({c for rows in list(sheets.values())[:1] for r in rows for c in r if isinstance(c, str) and c})
    with zipfile.ZipFile(path, "w") as z:
        names = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{XLSX}" xmlns:r="{REL}"><sheets>{names}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(1, len(sheets) + 1)) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{XLSX}">' + "".join(f"<si><t>{t}</t></si>" for t in shared) + "</sst>")
        for i, rows in enumerate(sheets.values(), 1):
            body = ""
            for r, row in enumerate(rows, 1):
                cells = ""
                for c, v in enumerate(row):
                    ref = f"{chr(65 + c)}{r}"
                    if isinstance(v, (int, float)):
                        cells += f'<c r="{ref}"><v>{v}</v></c>'
                    elif v:
                        cells += f'<c r="{ref}" t="s"><v>{shared.index(v)}</v></c>' if i == 1 else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
                body += f'<row r="{r}">{cells}</row>'
            z.writestr(f"xl/worksheets/s{i}.xml", f'<worksheet xmlns="{XLSX}"><sheetData>{body}</sheetData></worksheet>')
    return str(path)


def write_dbf(path, names, rows, width=20):
    head = struct.pack("<BBBBIHH20x", 3, 24, 1, 1, len(rows), 32 + 32 * len(names) + 1, 1 + width * len(names))
    fields = b"".join(struct.pack("<11sc4xBB14x", n.encode(), b"C", width, 0) for n in names)
    path.write_bytes(head + fields + b"\r" + b"".join(b" " + b"".join(str(c).encode("latin-1").ljust(width) for c in r) for r in rows))
    return str(path)


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_workbooks(spark, tmp_path):
    path = write_xlsx(tmp_path / "a.xlsx", {"one": [["Commune", "", "X"], ["Colmar", "", 12.0], [], ["Thann", "note", 3.5]], "two": [["a"], ["b"]]})
    assert workbook.sheets((tmp_path / "a.xlsx").read_bytes()) == {"one": [["Commune", "", "X"], ["Colmar", "", "12"], ["Thann", "note", "3.5"]], "two": [["a"], ["b"]]}
    got = by(readers.read_source(spark, path), "Commune")
    assert got["Colmar"]["X"] == "12" and got["Thann"]["Unnamed: 1"] == "note"
    ods = tmp_path / "a.ods"
    with zipfile.ZipFile(ods, "w") as z:
        cell = lambda t: f"<table:table-cell><text:p>{t}</text:p></table:table-cell>"
        rows = f"<table:table-row>{cell('Commune')}{cell('X')}</table:table-row><table:table-row>{cell('Erstein')}<table:table-cell office:value='7' table:number-columns-repeated='1'/></table:table-row><table:table-row table:number-rows-repeated='1048576'><table:table-cell table:number-columns-repeated='1024'/></table:table-row>"
        z.writestr("content.xml", f'<office:d xmlns:office="urn:oasis:names:tc:opendocument:xmlns:office:1.0" xmlns:table="urn:oasis:names:tc:opendocument:xmlns:table:1.0" xmlns:text="urn:oasis:names:tc:opendocument:xmlns:text:1.0"><table:table table:name="t">{rows}</table:table></office:d>')
    assert by(readers.read_source(spark, str(ods)), "Commune")["Erstein"]["X"] == "7"


def test_register_with_side_table(spark, tmp_path):
    book = write_xlsx(tmp_path / "p.xlsx", {"s": [["Identification_de_l_EA", "Numero_de_l_EA", "Code_national_de_l_EA", "Nom_de_la_commune"], ["1 / 67 001 / ACHENHEIM /  / Breite / habitat", "67 001", "N1", "x"], ["2 / 67 002", "67 002", "N2", "BENFELD"]]})
    dbf = write_dbf(tmp_path / "e.dbf", ["EA_NATCODE", "X_DEGRE", "Y_DEGRE", "CHRONO"], [["N1", "7.5", "48.5", "EURFER"], ["67 002", "7.6", "48.6", "autre"], ["N1", "7.55", "48.55", ""]])
    got = by(readers.read_source(spark, book, "patriarche", dbf=dbf), "commune")
    a, b = got["ACHENHEIM"], got["BENFELD"]
    assert (a.longitude_raw, a.latitude_raw, a.periode_mention, a.type_mention) == (7.55, 48.55, "Âge du Fer", "habitat") and a.extra["lieu_dit"] == "Breite" and a.extra["patriarche_ea"] == "67 001"
    assert (b.longitude_raw, b.periode_mention, b.extraction_method) == (7.6, "autre", "patriarche")


def test_linked_workbook(spark, tmp_path):
    book = write_xlsx(tmp_path / "b.xlsx", {
        "sites": [["id_site", "pays", "commune", "lieu_dit", "x", "y", "epsg_coord"], ["1", "FR", "Sierentz", "Sand", "7.4", "47.6", ""], ["2", "CH", "Basel", "", "1040000", "6740000", "2154"], ["3", "DE", "Breisach", "", "", "", ""]],
        "occupations": [["id_occupation", "fk_site", "type", "datation"], ["o1", "1", "inconnu", "Ha D"], ["o2", "1", "grande nécropole", "LT A"], ["o3", "2", "hab_ouv", ""]],
        "mobilier": [["fk_occupation", "type_mobilier", "NR_mobilier"], ["o1", "fibule", "2"], ["o1", "bracelet", "1"]],
    })
    got = by(readers.read_source(spark, book, "alsace_basel"), "commune")
    assert (got["Sierentz"].type_mention, got["Sierentz"].periode_mention, got["Sierentz"].longitude_raw) == ("nécropole", "Ha D / LT A", 7.4)
    assert "fibule" in got["Sierentz"].extra["occupations"] and got["Basel"].type_mention == "habitat" and got["Basel"].extra["x_l93"] == "1040000.0"
    assert got["Breisach"].type_mention == "indéterminé" and got["Breisach"].periode_mention is None and got["Basel"].latitude_raw is None


def test_thematic_sources(spark, tmp_path):
    read = lambda kind, rows, **o: readers.read_source(spark, write_xlsx(tmp_path / f"{kind}.xlsx", {"s": rows}), kind, **o)
    proto = by(read("bdd_proto_alsace", [["commune", "lieu_dit", "type_site", "HaD", "LTAB", "datation_1"], ["A", "x", "habitat", 1, 0, "Ha D"], ["B", "", "", 0, "0", "BA"], ["C", "", "", "", 1, ""]]), "commune")
    assert set(proto) == {"A", "C"} and proto["A"].extra["phases_bool"] == "HaD" and proto["C"].type_mention == "indéterminé"
    necro = [["Dept", "Commune", "Nom", "Datation", "Coordonnées x (Lambert 93)", "Coordonnées y (Lambert 93)"], ["67", "A", "n", "Ha C", 1000000, 6800000], ["57", "B", "", "", "", ""], ["BW", "C", "", "", "", ""]]
    assert set(by(read("necropoles", necro), "commune")) == {"A", "B", "C"}
    only = by(read("necropoles", necro, departments=[67]), "commune")
    assert set(only) == {"A"} and only["A"].extra["x_l93"] == "1000000.0"
    rich = by(read("habitats_tombes_riches", [["Pays", "Dept/Land", "Commune", "type"], ["F", "67", "A", "Tombe princière"], ["D", "BW", "B", "habitat de hauteur"], ["", "Total", "C", ""], ["f", "88", "D", "x"]], departments=[67]), "commune")
    assert set(rich) == {"A", "B"} and rich["B"].extra["pays"] == "DE" and rich["A"].type_mention == "nécropole"
    silos = by(read("inhumations_silos", [["Département", "Site", "Lieu dit", "X(L93)", "Y(L93)", "14C (2 sigma)"], ["68", "A", "p", "", "", "780 - 540"], ["68", "A", "p", "1000,5", "2000", "800-600 av. J.-C."], ["TOTAL", "x", "", "", "", ""], ["68", "A", "p", "9", "9", ""], ["67", "B", "", "", "", ""]]), "commune")
    a = silos["A"].extra
    assert set(silos) == {"A", "B"} and (a["individus_count"], a["x_l93"], a["datation_14c_debut"], a["datation_14c_fin"]) == ("3", "1000.5", "-800", "-540")
    (tmp_path / "f.csv").write_text("info SITE;;rite;\nDPT;SITE;;DATATION\n67;Colmar rue des Aunes;oui;Ha D\n68;Thann;*;\n;;;\n", encoding="utf-8")
    fun = by(readers.read_source(spark, str(tmp_path / "f.csv"), "afeaf"), "commune")
    assert fun["Colmar rue"].extra["lieu_dit"] == "des Aunes" and fun["Colmar rue"].periode_mention == "Ha D" and fun["Colmar rue"].extra["rite"] == "oui" and "rite" not in fun["Thann"].extra


def test_exchange_source(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "SITE_AKG_ID;DATABASE_NAME;SITE_NAME;MAIN_CITY_NAME;LONGITUDE;LATITUDE;CITY_CENTROID;STARTING_PERIOD;ENDING_PERIOD;CARAC_LVL1;COMMENTS\n"
        "1;Baden;N;Breisach;7,58;48,03;Oui;-620:-531;-450:-380;Habitat;x\n2;Fr;M;;7.1;48.2;Non;-800:-600;;Céramique;GENAUIGK_T : ca. 10m # DAT_FEIN : Ha D #\n3;Fr;O;X;;;Non;Indéterminé;Indéterminé;;\n4;Fr;P;Y;;;Non;-50:-20;100:600;;\n",
        encoding="utf-8",
    )
    got = by(readers.read_source(spark, str(tmp_path / "a.csv"), "arkeogis"), "commune")
    b, m = got["Breisach"], got["M"]
    assert (b.longitude_raw, b.type_mention, b.periode_mention) == (7.58, "habitat", "-620:-531 / -450:-380") and (b.extra["datation_debut"], b.extra["datation_fin"], b.extra["pays"], b.extra["precision_localisation"]) == ("-620", "-380", "DE", "centroïde")
    assert m.type_mention == "indéterminé" and m.extra["DAT_FEIN"] == "Ha D" and m.extra["precision_localisation"] == "exact" and m.extra["datation_fin"] == "-600"
    kept = readers.read_source(spark, str(tmp_path / "a.csv"), "arkeogis", filter_age_du_fer=True)
    assert {r.commune for r in kept.collect()} == {"Breisach", "M"}
    out = pipeline.run(spark, pipeline.Config([{"path": str(tmp_path / "a.csv"), "type": "arkeogis"}], str(tmp_path / "out")))
    assert {r.commune for r in out["sites"].collect()} == {"Breisach am Rhein", "M", "Y"} and out["sites"].where("identifiants_externes['arkeogis_id'] = '1'").count() == 1


def test_texts_and_catalogues(spark, tmp_path):
    (tmp_path / "n.txt").write_text("intro\n001 - ALTKIRCH\nRien ici.\n (004 AH) Au lieu-dit Berg, un tumulus du Hallstatt. Dupont, 1998\n (005 AH, 006 AH) - mur romain\n002 — COLMAR\nHabitat protohistorique.\n", encoding="utf-8")
    rows = readers.read_source(spark, str(tmp_path / "n.txt"), "cag").collect()
    got = {(r.commune, r.extra.get("lieu_dit")): r for r in rows}
    assert set(got) == {("ALTKIRCH", "004 AH"), ("COLMAR", None)}
    a = got["ALTKIRCH", "004 AH"]
    assert a.periode_mention == "Hallstatt / tumulus" and a.extra["bibliographie"] == "Dupont, 1998" and a.type_mention == "tumulus"
    (tmp_path / "m.json").write_text('{"documents": [{"ark": "ark:/1", "title": "T", "geographic_scope": "Colmar, Haut (Thann)", "communes_mentioned": [], "mentions_found": ["oppidum de Thann"], "categories": ["Bronzes"], "relevance": "r", "year": 1900}, {"ark": "ark:/2", "title": "U", "geographic_scope": "", "communes_mentioned": ["Basel"], "mentions_found": [], "categories": [], "relevance": "", "year": null}]}')
    cat = by(readers.read_source(spark, str(tmp_path / "m.json"), "gallica_metadata"), "commune")
    assert {k: v.type_mention for k, v in cat.items()} == {"Colmar": "dépôt", "Thann": "oppidum", "Basel": None}
    (tmp_path / "s.xml").write_text('<srw:r xmlns:srw="u" xmlns:dc="d"><srw:record><dc:identifier>https://x/ark:/12148/b1</dc:identifier><dc:title>T</dc:title><dc:date>1900</dc:date></srw:record><srw:record><dc:title>no ark</dc:title></srw:record></srw:r>')
    assert [tuple(r) for r in readers.read_source(spark, str(tmp_path / "s.xml"), "sru").collect()] == [("ark:/12148/b1", "T", None, "1900")]
    (tmp_path / "a.xml").write_text('<alto xmlns="z"><TextBlock HPOS="1" VPOS="2" WIDTH="3" HEIGHT="4"><TextLine><String CONTENT="un"/><SP/><String CONTENT="mur"/></TextLine></TextBlock></alto>')
    assert readers.read_source(spark, str(tmp_path / "a.xml"), "alto").first().text == "un mur"
    pages = spark.createDataFrame([("<!DOCTYPE><HTML>x",), ("texte",), (None,)], "t string")
    assert [r[0] for r in pages.select(typed.is_page(pages.t)).collect()] == [False, True, False]
    arks = spark.createDataFrame([("https://gallica.example/ark:/12148/bpt6k1.r",), ("ark:/1/b",)], "t string")
    assert [r[0] for r in arks.select(typed.ark_path(arks.t)).collect()] == ["12148_bpt6k1_r", "1_b"]
    (tmp_path / "g.geojson").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"site_id": "a"}, "geometry": {"type": "Point", "coordinates": [7.5, 48.1]}}]}')
    assert typed.first_known(spark, [str(tmp_path / "none.json"), str(tmp_path / "g.geojson")]).first().latitude == 48.1
    with pytest.raises(FileNotFoundError):
        typed.first_known(spark, [str(tmp_path / "none.csv")])
    for bad in ("x.doc", "x.pdf"):
        with pytest.raises(readers.UnsupportedFormatError):
            readers.read_source(spark, bad)


def test_reading_helpers(spark):
    df = spark.createDataFrame([("oui", "x", 'a""b', "0", "7.1"), ("NON", "y", "c", "48.1", "7.2")], "presence string, SITE_AKG_ID string, note string, LATITUDE string, LONGITUDE string")
    assert reports.geo_columns(df.columns) == ("LATITUDE", "LONGITUDE", None) and reports.id_column(df.columns) == "SITE_AKG_ID" and reports.id_column(["a"]) is None
    assert tuple(reports.quality_probes(df.withColumn("Unnamed: 3", F.lit("")).withColumn("none", F.lit(None).cast("string"))).first()) == (1, 1, 1, 1)
    assert reports.enum_columns(df) == ["presence"] and {r.presence for r in reports.normalise_enums(df).collect()} == {"oui", "non"}
    assert reports.expect(df, columns=df.columns, rows=2) is df
    for bad in ({"columns": ["a"]}, {"rows": 3}):
        with pytest.raises(reports.SchemaError):
            reports.expect(df, **bad)


def test_dbase_in_ranges(spark, tmp_path):
    """Every range of records in a task of its own; deleted records, blanks and other letters; the whole equals the parsed file."""
    cells = [[str(i), f"é{i % 7}"] for i in range(3000)] + [["", ""]]
    path = write_dbf(tmp_path / "r.dbf", ["A", "B"], cells)
    data = bytearray((tmp_path / "r.dbf").read_bytes())
    start, width = 32 + 32 * 2 + 1, 41
    data[start + 5 * width] = ord("*")
    (tmp_path / "r.dbf").write_bytes(data)
    for size in (5_000, 1 << 24):
        got = dbase.read_dbase(spark, path, range_bytes=size)
        assert got.columns == ["ord", "A", "B"] and got.rdd.getNumPartitions() == (25 if size == 5_000 else 1)
        assert sorted(map(tuple, got.collect())) == [(i, a or None, b or None) for i, (a, b) in enumerate(cells) if i != 5]
    names, parsed = readers.parse_dbf(bytes(data))
    assert names == ["A", "B"] and parsed == [c for i, c in enumerate(cells) if i != 5]
    assert by(readers.read_source(spark, path), "A")["7"]["B"] == "é0" and dbase.read_dbase(spark, write_dbf(tmp_path / "e.dbf", ["A"], [])).count() == 0
    with pytest.raises(FileNotFoundError):
        readers.read_dbf(spark, str(tmp_path / "none.dbf"))
