"""The batch pipeline end to end, on a small file of records."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tessera import pipeline

CSV = """commune;type_mention;periode_mention;latitude_raw;longitude_raw;raw_text;pays;departement
Strasbourg;habitat;La Tène;48.573;7.752;fouille A;FR;67
Straßburg;habitat;La Tène;48.5731;7.7521;fouille B;FR;67
Colmar;nécropole;Hallstatt C;48.079;7.358;tombes;FR;68
Paris;oppidum;La Tène;48.85;2.35;loin;FR;75
Breisach;Höhensiedlung;Hallstatt;;;burg;DE;
Thann;dépôt;Age du Bronze;47.8;7.1;trop ancien;FR;68
;;;;;;FR;68
Basel;oppidum;LT D1;47.55;7.59;münster;CH;
"""


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("pipeline")
    (root / "sites.csv").write_text(CSV, encoding="utf-8")
    gazetteer = spark.createDataFrame([("Breisach am Rhein", 1_035_000.0, 6_780_000.0)], "commune string, x double, y double")
    return pipeline.Config([{"path": str(root / "sites.csv"), "type": "csv"}, {"path": str(root / "x.zzz")}], str(root / "out"), gazetteer=gazetteer)


def test_end_to_end(spark, config):
    out = pipeline.run(spark, config)
    sites = {r.commune: r for r in out["sites"].collect()}
    assert set(sites) == {"Strasbourg", "Colmar", "Breisach am Rhein", "Basel"}
    merged = sites["Strasbourg"]
    assert len(merged.sources) == 2 and len(merged.phases) == 1 and {p.site_id for p in merged.phases} | {s.site_id for s in merged.sources} == {merged.site_id}
    assert sites["Breisach am Rhein"].precision_localisation == "centroïde" and sites["Breisach am Rhein"].x_l93 == 1_035_000.0 and sites["Colmar"].precision_localisation == "exact"
    assert sites["Colmar"].phases[0].periode == "Hallstatt" and sites["Basel"].phases[0].sous_periode == "LT D1"
    review = {(r.step, r.reason) for r in out["review"].collect()}
    assert any(s == "INGEST" for s, _ in review)
    report = out["report"].first()
    assert (report.input_count, report.output_count, report.clusters_merged, report.pairwise_merges, report.pairs_compared) == (5, 4, 1, 1, 10)
    assert pipeline.latest(spark, config.out).count() == 4


def test_skip_and_resume(spark, config):
    events = lambda out: [(x["step"], x["event"]) for x in sorted((json.loads(r.value) for r in out["log"].collect()), key=lambda x: x["ts"])]
    before = len(events(pipeline.run(spark, config)))
    again = events(pipeline.run(spark, config))[before:]
    assert {s for s, e in again if e == "skipped"} == set(pipeline.STEPS) - {"EXPORT"}
    for step in pipeline.STEPS:
        assert pipeline.run(spark, config, step)["sites"].count() == 4
    config.merge = 0.9999
    changed = events(pipeline.run(spark, config))
    assert ("DEDUPLICATE", "end") in changed[-12:] and ("NORMALIZE", "skipped") in changed[-12:]
    with pytest.raises(pipeline.MissingCheckpointError):
        pipeline.run(spark, pipeline.Config([], config.out + "-none"), "GEOCODE")


def test_filters_can_be_switched_off(spark, config):
    frames, failed = pipeline._ingest(spark, config)
    raw = frames[0]
    count = lambda **k: pipeline.retained(raw, pipeline.Config([], "", **k)).count()
    assert len(failed) == 1 and count() == 5 and count(departments=None) == 6 and count(chrono=False) == 7 and count(chrono=False, departments=None, countries=("DE",)) == 1


def test_geocode_by_country(spark):
    rows = [("a", "Aa", "FR", None, None, "approx"), ("b", "Aa", "DE", None, None, "approx"), ("c", "Bb", "CH", None, None, "approx"), ("d", "Aa", "FR", 1.0, 2.0, "exact"), ("e", " ", "FR", None, None, "approx")]
    sites = spark.createDataFrame(rows, "site_id string, commune string, pays string, x_l93 double, y_l93 double, precision_localisation string")
    table = lambda *r: spark.createDataFrame(r, "commune string, x double, y double")
    got = {r.site_id: (r.x_l93, r.precision_localisation) for r in pipeline.geocode(sites, [("FR", table(("aa", 10.0, 1.0))), ("DE", table(("Zz", 0.0, 0.0))), (None, table(("AA", 20.0, 1.0)))]).collect()}
    assert got == {"a": (10.0, "centroïde"), "b": (20.0, "centroïde"), "c": (None, "approx"), "d": (1.0, "exact"), "e": (None, "approx")}
    assert pipeline.geocode(sites, []).where(F.col("x_l93").isNotNull()).count() == 1


def test_nothing_changed_reads_no_rows(spark, config, tmp_path):
    """Checkpoints whose bytes are spoilt, but not their lengths and times: a run that skips every step does not see it."""
    (tmp_path / "sites.csv").write_text(CSV, encoding="utf-8")
    own = pipeline.Config([{"path": str(tmp_path / "sites.csv"), "type": "csv"}, {"path": "x.zzz"}], str(tmp_path / "out"), gazetteer=config.gazetteer)
    first = pipeline.run(spark, own)
    assert first["sites"].count() == 4
    spoilt = [*(tmp_path / "out/checkpoints").glob("*/part-*.parquet"), tmp_path / "sites.csv"]
    saved = {f: (f.read_bytes(), f.stat()) for f in spoilt}
    for f, (data, at) in saved.items():
        f.write_bytes(b"\0" * len(data))
        os.utime(f, ns=(at.st_atime_ns, at.st_mtime_ns))
    again = pipeline.run(spark, own)
    events = [json.loads(r.value) for r in again["log"].collect()]
    assert sum(e["event"] == "kept" for e in events) == 1 and sum(e["event"] == "end" for e in events) == len(pipeline.STEPS)
    for f, (data, _) in saved.items():
        f.write_bytes(data)
    # New times, equal rows: the sources are read again, what follows is not made anew.
    touched = sorted((json.loads(r.value) for r in pipeline.run(spark, own)["log"].collect()), key=lambda e: e["ts"])[len(events) :]
    assert {(e["step"], e["event"]) for e in touched if e["event"] == "end"} <= {("INGEST", "end"), ("EXPORT", "end")}
    late = pipeline.run(spark, own, "VALIDATE")["review"]
    assert late.where("step = 'INGEST'").count() == 1  # an unreadable source is still told
