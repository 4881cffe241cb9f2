"""Value tables of the domain functions, dedup scenarios, sinks and the query door."""

import math
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import api, vocab
from tessera.functions import chrono, geo, rules, similarity, text
from tessera.operators import aggregate, dedup, fuzzy, machine, match, qgram, reports, search
from tessera.sources import readers, writers


def one(spark, col, value=None):
    return spark.createDataFrame([(value,)], "v string").select(col.alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("given", "subs"),  # fixed values
    [
        ("-800:-620", [("Hallstatt", "Ha C", -800, -620)]), ("LT B2", [("La Tène", "LT B2", -320, -260)]), ("EURFER------", [(vocab.UNKNOWN, None, -800, -25)]),
        ("Age du fer", [(vocab.UNKNOWN, None, -800, -25)]), ("Age du Bronze - age du Fer", [("Hallstatt", None, -800, -450)]), ("quelque chose", [(vocab.UNKNOWN, None, None, None)]), ("", [(vocab.UNKNOWN, None, None, None)]),
        ("780-540 avant J.C", [("Hallstatt", None, -780, -540)]), ("Ha D1 - LT A", [("Hallstatt", "Ha D1", -620, -540), ("Hallstatt", "Ha D2", -540, -500), ("Hallstatt", "Ha D3", -500, -450), ("La Tène", "LT A", -450, -380)]),
    ],
)
def test_dating(spark, given, subs):
    assert [tuple(p) for p in one(spark, chrono.parse(F.col("v")), given)] == subs


def test_flag_columns(spark):
    got = one(spark, chrono.flags({"Ha C": F.lit(0), "Ha D": F.lit(1), "LT C": F.lit(1)}))
    assert [p["sub"] for p in got] == ["Ha D1", "Ha D2", "Ha D3", "LT C1", "LT C2"]


@pytest.mark.parametrize(("given", "kind"), [("habitat", "habitat"), ("Grabhügel", "tumulus"), ("un oppidum celtique", "oppidum"), ("Viereckschanze", "sanctuaire"), ("rien", vocab.UNKNOWN)])
def test_types(spark, given, kind):
    assert one(spark, text.site_type(F.col("v")), given) == kind


def test_identifier(spark):
    for given, want in (
        ("8342 / 67 019 0009 / BALDENHEIM /  / SCHLITTWEG / habitat / Age du fer - Gallo-romain", ("BALDENHEIM", "SCHLITTWEG", "habitat", "Age du fer - Gallo-romain")),
        ("12163 / 67 008 0022 / ALTORF /  / Osterlaeng / Age du fer", ("ALTORF", "Osterlaeng", None, "Age du fer")),
        ("1121 / 67 001 0006 / ACHENHEIM /  / Breite / Age du bronze - Age du fer / fosse", ("ACHENHEIM", "Breite", "fosse", "Age du bronze - Age du fer")),
    ):
        assert tuple(one(spark, text.identifier(F.col("v")), given)) == want


def test_projection(spark):
    row = spark.range(1).select(*geo.to_lambert93(F.lit(7.374384646862587), F.lit(48.19273904424394))).first()
    back = spark.range(1).select(*geo.to_wgs84(F.lit(row[0]), F.lit(row[1]))).first()
    assert abs(back[0] - 7.374384646862587) < 1e-9 and abs(back[1] - 48.19273904424394) < 1e-9
    utm = spark.range(1).select(*geo.utm32_to_wgs84(F.lit(500000.0), F.lit(5316300.0))).first()
    assert abs(utm[0] - 9.0) < 1e-9 and 47.9 < utm[1] < 48.1
    with pytest.raises(ValueError):
        geo.reproject(F.lit(1.0), F.lit(1.0), 9999)


def _site(spark, rows):
    made = spark.createDataFrame(rows, "ord int, site_id string, name string, commune string, lon double, lat double")
    x, y = geo.to_lambert93(F.col("lon"), F.col("lat"))
    return made.select("ord", "site_id", "name", "commune", x.alias("x"), y.alias("y"), F.lit(False).alias("centroid"), F.expr("cast(array('', '') as array<string>)").alias("ids"))


def test_dedup_scenarios(spark):
    rows = [(0, "a", "Vieux-Brisach", "Breisach", 7.58, 48.03), (1, "b", "Breisach am Rhein", "Breisach", 7.575, 48.028)]
    every = lambda r: _site(spark, r).withColumn("all", F.lit(1))
    score = lambda r, least=0.0: dedup.score_pairs(dedup.self_pairs(every(r), "ord", "all"), least).first()["score"]
    assert round(score(rows), 4) == 0.7841
    assert 0.78 <= score([(0, "a", "Site Alpha", "Strasbourg", 7.75, 48.58), (1, "b", "Site Beta", "Strasbourg", 7.76, 48.59)]) < 0.85
    assert score([(0, "a", "Oppidum du Baerengraben", "Neuf-Brisach", 7.752, 48.573), (1, "b", "Oppidum du Bärengraben", "Emmendingen", 7.96, 48.11)]) < 0.85
    labels, review, report = dedup.clusters(_site(spark, [(0, "a", "Ensisheim nord", "Ensisheim", 7.35, 47.97), (1, "b", "Ensisheim sud", "Ensisheim", 7.351, 47.971)]))
    assert labels.select("cluster").distinct().count() == 1 and review.count() == 0 and report.first().pairwise_merges == 1


def test_review_lists_pairs_within_a_cluster(spark):
    """a-b and b-c merge, a-c is for review though all three end in one cluster."""
    rows = [(0, "a", "abcdefghij klmnop", "X", 7.35, 47.97), (1, "b", "abcdefghij klm", "X", 7.35, 47.97), (2, "c", "abcdefgh", "X", 7.35, 47.97)]
    labels, review, _ = dedup.clusters(_site(spark, rows))
    scores = {(r.a_ord, r.b_ord): r.score for r in dedup.score_pairs(dedup.self_pairs(_site(spark, rows).withColumn("all", F.lit(1)), "ord", "all"), 0.7).collect()}
    want = {(a, b) for (a, b), s in scores.items() if s < 0.85}
    got = {(r.site_id_a, r.site_id_b) for r in review.collect()}
    assert got == {("abc"[a], "abc"[b]) for a, b in want}
    assert labels.select("cluster").distinct().count() < 3


def test_candidates_lose_no_pair(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    names, communes = [" ".join(word() for _ in range(rng.randint(1, 3))) for _ in range(25)], [word() for _ in range(8)]
    rows = [(i, f"s{i}", rng.choice(names) + rng.choice(("", "x", " b")), rng.choice(communes), *((7 + rng.random(), 48 + rng.random()) if rng.random() < 0.6 else (None, None))) for i in range(120)]
    ids = F.array(F.when(F.col("ord") % 17 == 0, (F.col("ord") % 2).cast("string")).otherwise(""), F.lit(""))
    sites = _site(spark, rows).withColumn("ids", ids)
    found = dedup.candidates(sites)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    key = lambda df: {(r.a_ord, r.b_ord) for r in df.select("a_ord", "b_ord").collect()}
    everything = dedup.score_pairs(dedup.self_pairs(sites.withColumn("all", F.lit(1)), "ord", "all"), 0.7)
    assert key(dedup.score_pairs(found, 0.7)) == key(everything) != set()


def test_merge_of_two_records(spark):
    kind = "site_id string, nom_site string, variantes_nom array<string>, commune string, x_l93 double, region_admin string, description string, surface_m2 double, identifiants_externes map<string,string>, phases array<struct<phase_id:string,site_id:string,periode:string>>, sources array<struct<source_id:string,site_id:string>>"
    poor = ("p", "Alpha", ["A"], "Here", None, "", "told", None, {"k": "1", "m": "1"}, [("p1", "p", "Ha")], [("x", "p")])
    full = ("f", "Beta", ["B", "A"], "There", 1.0, "Alsace", None, 5.0, {"k": "2"}, [("f1", "f", "Ha"), ("f2", "f", "LT")], [("x", "f"), ("y", "f")])
    df = spark.createDataFrame([(poor, full)], f"a struct<{kind.replace(' ', ':').replace(',:', ', ')}>, b struct<{kind.replace(' ', ':').replace(',:', ', ')}>")
    schema = df.schema["a"].dataType
    for first, second in (("a", "b"), ("b", "a")):
        r = df.select(dedup.merge(F.col(first), F.col(second), schema).alias("m")).first().m
        assert (r.site_id, r.nom_site, r.commune, r.x_l93, r.region_admin, r.description, r.surface_m2) == ("f", "Beta", "There", 1.0, "Alsace", "told", 5.0)
        assert r.variantes_nom == ["B", "A", "Alpha"] and r.identifiants_externes == {"k": "1", "m": "1"}
        assert [p.phase_id for p in r.phases] == ["f1", "f2"] and [x.source_id for x in r.sources] == ["x", "y"]


def test_similarity():
    assert similarity.ratio("", "") == 1.0 and similarity.lcs("abcde", "xbxdx") == 2 and similarity.token_set("a b", "b a c") == 1.0


def test_plans(spark, tmp_path):
    a = spark.range(2000).select("id", (F.col("id") * 13 % 997).cast("double").alias("x"), (F.col("id") * 7 % 991).cast("double").alias("y"))
    joined = match.radius_join(a, a, 5.0)
    assert not any(x in joined._jdf.queryExecution().executedPlan().toString() for x in ("CartesianProduct", "BroadcastNestedLoopJoin"))
    assert joined.count() == a.alias("l").crossJoin(a.alias("r")).where("sqrt(pow(l.x - r.x, 2) + pow(l.y - r.y, 2)) <= 5").count()


@pytest.mark.parametrize("most", [10_000, 40, 7])
def test_radius_join_over_quadtrees(spark, most):
    """Every pair once, however far hot cells are split; points of one spot and without a position included."""
    rng = random.Random(4)
    points = [(i, rng.uniform(0, 300), rng.uniform(0, 300)) for i in range(150)] + [(150 + i, 100 + rng.gauss(0, 4), 100 + rng.gauss(0, 4)) for i in range(200)] + [(350 + i, 55.0, 55.0) for i in range(60)] + [(500, None, 1.0), (501, 1.0, None)]
    df = spark.createDataFrame(points, "id int, x double, y double")
    want = {(a[0], b[0]) for a in points for b in points if None not in a + b and math.dist(a[1:], b[1:]) <= 30}
    joined = match.radius_join(df, df, 30.0, most=most)
    got = [(r.id, r.r_id) for r in joined.select("id", "r_id").collect()]
    assert len(got) == len(want) and set(got) == want and "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()


def test_a_hot_cell_is_many_keys(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 141).cast("double").alias("x"), (F.col("id") % 139).cast("double").alias("y"), F.lit(0).cast("long").alias("__cx"), F.lit(0).cast("long").alias("__cy"))
    leaves = match._quadrants(df, 150.0, "x", "y", 500).first()["__leaves"]
    assert 40 <= sum(q.salts for q in leaves) < 400 and len({q.code for q in leaves}) == len(leaves)
    spot = df.withColumns({"x": F.lit(3.0), "y": F.lit(3.0)})
    assert [q.salts for q in match._quadrants(spot, 150.0, "x", "y", 500).first()["__leaves"]] == [40]


def test_similar_texts_lose_no_pair(spark):
    """The q-gram index against all pairs, over short, long, empty, equal and accented texts."""
    rng = random.Random(9)
    names = {" ".join("".join(rng.choices("abcdeéilnorst", k=rng.randint(1, 9))) for _ in range(rng.randint(1, 4))) for _ in range(160)}
    for x in sorted(names)[:60]:
        y = list(x)
        for _ in range(rng.randint(1, 4)):
            i = rng.randrange(len(y) + 1)
            y[i : i + rng.randrange(2)] = rng.choice(["", "x", "a", "st"])
        names.add("".join(y))
    names |= {"", " ", "a", "b a", "a b", "ab" * 60, "ab" * 59 + "ba"}
    key = lambda t: " ".join(sorted(t.split()))
    df = spark.createDataFrame([(n,) for n in names] + [(None,), ("a b",)], "t string")
    for least in (0.55, 0.72, 0.85, 0.95):
        got = {(r.v, r.w): r.score for r in qgram.similar_texts(df, "t", least).collect()}
        want = {(a, b): s for a in names for b in names if (s := similarity.ratio(key(a), key(b))) >= least}
        assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want)


def test_candidates_of_varied_names_are_few(spark):
    """Over 3,000 names of syllables, no candidate list grows near the number of names."""
    rng = random.Random(4)
    parts = [a + b for a in "bcdfghjklmnprstvz" for b in ("a", "e", "i", "o", "u", "an", "er", "in")]
    names = {" ".join(sorted("".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(rng.randint(1, 3)))) for _ in range(3000)}
    assert qgram.met(spark.createDataFrame([(n,) for n in names], "k string"), 0.85).count() < 2 * len(names)


def test_guarded_sql(spark):
    spark.range(3).createOrReplaceTempView("sites")
    assert api.guarded_sql(spark, "WITH a AS (SELECT id FROM sites) SELECT count(*) FROM a WHERE id > 0").first()[0] == 2
    assert api.guarded_sql(spark, "SELECT id, (SELECT max(id) FROM sites) AS m FROM sites WHERE id IN (SELECT id FROM sites WHERE id < 2) ORDER BY id LIMIT 5").count() == 2
    bad_ = (
        "DROP TABLE sites", "CREATE VIEW v AS SELECT 1", "SET x = 1", "SHOW TABLES", "SELECT reflect('java.lang.System', 'currentTimeMillis')", "SELECT (SELECT java_method('java.lang.System', 'getenv', 'HOME'))",
        "SELECT * FROM parquet.`/tmp/x`", "SELECT * FROM sites WHERE id IN (SELECT id FROM csv.`/etc/passwd`)", "WITH a AS (SELECT * FROM text.`/etc/passwd`) SELECT * FROM a", "SELECT * FROM other", "INSERT INTO sites VALUES (1)",
    )
    bad_ += (
        "SELECT * FROM secret WHERE EXISTS (WITH secret AS (SELECT 1 a) SELECT * FROM secret)", "WITH a AS (SELECT * FROM b), b AS (SELECT 1 x) SELECT * FROM a", "SELECT * FROM (WITH c AS (SELECT 1 x) SELECT * FROM c) JOIN c",
        "SELECT current_database()", "SELECT current_catalog()", "SELECT current_user", "SELECT user() FROM sites", "SELECT version()", "SELECT input_file_name() FROM sites", "SELECT spark_catalog.default.f(1)", "SELECT mine(1)",
        "SELECT * FROM IDENTIFIER('secret')", "SELECT id FROM sites WHERE id > (SELECT count(*) FROM secret)", "WITH RECURSIVE r AS (SELECT 1 x UNION ALL SELECT x FROM secret) SELECT * FROM r",
    )
    spark.udf.register("mine", lambda x: x)
    spark.sql("CREATE TABLE IF NOT EXISTS secret USING parquet AS SELECT 'hidden' AS v")
    try:
        for bad in bad_:
            with pytest.raises(api.NotAQuery):
                api.guarded_sql(spark, bad)
    finally:
        spark.sql("DROP TABLE secret")
    good = "WITH a AS (SELECT id FROM sites), b AS (SELECT id FROM a WHERE id > 0) SELECT upper(cast(max(id) AS string)) AS m, sum(CASE WHEN id = 1 THEN 1 END) AS n, array_sort(collect_list(id)) AS x, current_date() AS d FROM b"
    assert api.guarded_sql(spark, good).first()[:3] == ("2", 1, [1, 2])
    assert api.guarded_sql(spark, "SELECT id, row_number() OVER (ORDER BY id) AS r, date_add(DATE'2024-01-01', 1) AS d FROM sites WHERE EXISTS (WITH sites2 AS (SELECT 1 a) SELECT * FROM sites2)").count() == 3


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Commune;X\nColmar;1,5\n;\nThann;\n", encoding="utf-8")
    got = readers.read_source(spark, str(tmp_path / "a.csv"), mapping={"Commune": "commune"})
    assert got.columns == ["commune", "X"] and [r.commune for r in got.orderBy("commune").collect()] == ["Colmar", "Thann"]
    with pytest.raises(readers.UnsupportedFormatError):
        readers.read_source(spark, "x.zzz")
    assert readers.flatten_header(["A", None, "B"], ["x", "y", ""]) == ["A.x", "A.y", "B"]
    sites = spark.createDataFrame([("s1", "n", "FR", "c", "habitat", 1e6, 6.8e6, "exact", [("Hallstatt", None, None, None), ("La Tène", None, None, None)], [("ref",)]), ("s2", "m", "FR", "c", "habitat", None, None, "approx", [], [])], "site_id string, nom_site string, pays string, commune string, type_site string, x_l93 double, y_l93 double, precision_localisation string, phases array<struct<periode:string,sous_periode:string,datation_debut:int,datation_fin:int>>, sources array<struct<reference:string>>")
    assert writers.denormalised(sites).count() == 3 and writers.features(sites).count() == 1
    assert {k: v.count() for k, v in writers.relational(sites).items()} == {"sites": 2, "phases": 2, "sources": 1}


def test_two_headers_leave_equal_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("Site;;Date\nname;code;\nx;1;2\nname;code;\nSite;;Date\n", encoding="utf-8")
    df = readers.read_two_headers(spark, str(tmp_path / "t.csv"))
    assert df.columns == ["Site.name", "Site.code", "Date"] and sorted(tuple(r)[:2] for r in df.collect()) == [("Site", None), ("name", "code"), ("x", "1")]


def test_spelling_of_sub_periods(spark):
    told = {"ltb": "LT B", "LTB2": "LT B2", " Ha D 3 ": "Ha D3", "HaC": "Ha C", "ha d1 / lta": "Ha D1 / LT A", "LT   C1-ltd": "LT C1-LT D", "Ha D 4": "Ha D 4", "Ha d": "Ha d", "": "", "LT": "LT"}
    df = spark.createDataFrame([(k,) for k in told], "c string")
    assert {r.c: r.t for r in df.select("c", rules.sub_period_spelling(F.col("c")).alias("t")).collect()} == told


def test_columns_of_yes_and_no(spark):
    df = spark.createDataFrame([("oui", "Oui ", "x", "oui"), ("non", None, "y", "non")] * 3 + [("probable", "*", "oui", "non")], "a string, b string, c string, site string")
    assert reports.enum_columns(df) == ["a", "b", "c"] and reports.enum_columns(df.select("site")) == []


def test_vocabulary_scan(spark):
    """The longest word against plain search, with one automaton and with blocks; ties, empty words, nulls, no join."""
    rng = random.Random(2)
    words = {"".join(rng.choices("abcé ", k=rng.randint(1, 5))) for _ in range(80)} | {"ab", "ba"}
    rows = [(i, "".join(rng.choices("abcdé ", k=rng.randint(0, 40)))) for i in range(200)] + [(900, None), (901, ""), (901, "")]
    df, v = spark.createDataFrame(rows, "id int, t string"), spark.createDataFrame([(w,) for w in words] * 2 + [(None,)], "w string")
    for prefix in (False, True):
        want = sorted((i, t, None if t is None else max((w for w in words if (t.startswith(w) if prefix else w in t)), key=lambda w: (len(w), w), default=None)) for i, t in rows)
        for most in (10**6, 40):
            got = match.longest_contained(df, "t", v, "w", prefix=prefix, most=most)
            assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        assert "Join" not in match.longest_contained(df, "t", v, "w", prefix=prefix)._jdf.queryExecution().executedPlan().toString()
    blank = match.longest_contained(df, "t", v.union(spark.createDataFrame([("",)], "w string")), "w")
    assert blank.where("t is not null and found is null").count() == 0
    assert match.longest_contained(df, "t", v.limit(0), "w").where("found is not null").count() == 0


def test_profile_without_expand(spark):
    df = spark.createDataFrame([(i % 5 if i % 4 else None, f"v{i % 300}", float(i)) for i in range(4000)], "a int, b string, c double").repartition(6)
    exact, told = aggregate.profile(df), aggregate.estimates(aggregate.sketches(df), 2)
    for made in (exact, told):
        assert "Expand" not in made._jdf.queryExecution().executedPlan().toString()
    assert {r.column_name: (r.n_null, r.n_distinct, r.n_rows) for r in exact.collect()} == {"a": (1000, 5, 4000), "b": (0, 300, 4000), "c": (0, 4000, 4000)}
    parts = aggregate.estimates(aggregate.merged_sketches(aggregate.sketches(df.withColumn("p", F.spark_partition_id() % 3), ["p"])), 2)
    for made in (told, parts):
        got = {r.column_name: r for r in made.collect()}
        assert {c: (r.n_rows, r.n_null) for c, r in got.items()} == {"a": (4000, 1000), "b": (4000, 0), "c": (4000, 0)}
        assert got["a"].n_distinct == 5 and abs(got["b"].n_distinct - 300) <= 15 and abs(got["c"].n_distinct - 4000) <= 200
        assert got["b"].median is None and abs(got["c"].median - 2000) <= 140 and {x.value for x in got["a"].top} <= set("01234")
    none = spark.createDataFrame([], "a int, b string")
    assert [tuple(r)[1:4] for r in aggregate.profile(none).collect()] == [(0, 0, 0)] * 2 and aggregate.estimates(aggregate.sketches(none)).count() == 2


@pytest.mark.parametrize("piece", [1, 7, 4096])
def test_machines_over_pieces(spark, piece):
    """Counts and states equal a plain run over each document, in pieces of any length."""
    rng = random.Random(piece)
    lines = [(d, i, rng.randrange(3), f"t{i}") for d in (1, 2, None) for i in range(60)] + [(3, 5, 1, None)]
    rng.shuffle(lines)
    df = spark.createDataFrame(lines, "d long, i int, y int, t string").repartition(5)
    table = [[0, 1, 2], [2, 1, 0], [2, 2, 1]]
    want, counts = {}, {}
    for d in (1, 2, None, 3):
        state, n = 1, 0
        for _, i, y, t in sorted((x for x in lines if x[0] == d), key=lambda x: x[1]):
            before, state, n = state, table[state][y], n + (y == 2)
            want[d, i], counts[d, i] = (t, before, state), n
    got = {(r.d, r.i): (r.t, r.before, r.after) for r in machine.states(df, "d", "i", F.col("y"), table, start=1, piece=piece).collect()}
    assert got == want
    counted = machine.running_count(df, "d", "i", F.col("y") == 2, "n", piece)
    assert counted.columns == [*df.columns, "n"] and {(r.d, r.i): r.n for r in counted.collect()} == counts
    assert machine.states(df.limit(0), "d", "i", F.col("y"), table, piece=piece).count() == 0


def test_search_for_all_words(spark):
    rng = random.Random(3)
    words = [f"wordabc{chr(97 + i)}" for i in range(12)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(9))) + " common WORDABCA"[: 7 if i % 5 else 16]) for i in range(80)] + [(None, "wordabca"), (90, None)]
    asked = [(i, rng.sample(words, rng.randrange(5))) for i in range(30)] + [(50, ["absentword"]), (51, ["wordabca", "absentword"]), (52, None), (53, ["wordabca", "wordabca", None])]
    index = search.postings(spark.createDataFrame(docs, "id int, t string"), "id", "t")
    got = [tuple(r) for r in search.all_of(index, spark.createDataFrame(asked, "query int, terms array<string>")).collect()]
    held = {i: set((t or "").lower().split()) for i, t in docs if i is not None}
    want = {(q, i) for q, ts in asked if ts for i, w in held.items() if {x for x in ts if x} <= w}
    assert len(got) == len(set(got)) and set(got) == want


def plain_weighted(a, b):
    """The weighted ratio from its definition: longest common subsequences by table, every window tried."""

    def ratio(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            out = [0]
            for j, d in enumerate(y):
                out.append(row[j] + 1 if c == d else max(row[j + 1], out[j]))
            row = out
        return 2 * row[-1] / (len(x) + len(y)) if x or y else 1.0

    def partial(x, y):
        x, y = sorted((x, y), key=len)
        n = len(x)
        windows = {y[i : i + n] for i in range(len(y) - n + 1)} | {y[:k] for k in range(1, n)} | {y[-k:] for k in range(1, n)}
        return max((ratio(x, w) for w in windows), default=0.0)

    if not a or not b:
        return 0.0
    ta, tb = a.split(), b.split()
    sa, sb = " ".join(sorted(ta)), " ".join(sorted(tb))
    both, only_a, only_b = (sorted(x) for x in (set(ta) & set(tb), set(ta) - set(tb), set(tb) - set(ta)))
    factor = max(len(a), len(b)) / min(len(a), len(b))
    if factor < 1.5:
        if both and not (only_a and only_b):
            together = 1.0
        else:
            left, right = " ".join(both + only_a), " ".join(both + only_b)
            together = max([ratio(left, right)] + ([ratio(" ".join(both), left), ratio(" ".join(both), right)] if both else []))
        return max(ratio(a, b), 0.95 * max(ratio(sa, sb), together))
    scale = 0.9 if factor <= 8 else 0.6
    return max(ratio(a, b), scale * partial(a, b), 0.95 * scale * (1.0 if both else partial(sa, sb)))


def test_likest_against_every_choice(spark):
    """The weighted ratio and the join that takes the likest, against a version from the definitions."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcde", k=rng.randint(1, 6)))
    names = [" ".join(word() for _ in range(rng.randint(1, 4))) for _ in range(40)] + ["", "a", "abc abc", "a b", "b a"]
    for a in names:
        for b in names:
            assert similarity.weighted(a, b) == pytest.approx(plain_weighted(a, b)), (a, b)
    left = [(i, i % 3, n) for i, n in enumerate(names)]
    choices = [(i % 3, n, i) for i, n in enumerate(dict.fromkeys(rng.sample(names, 20)))]
    got = {r.id: (r.choice, r.score) for r in fuzzy.likest(spark.createDataFrame(left, "id int, g int, t string"), spark.createDataFrame(choices, "g int, choice string, ord int"), ["g"], "t", "choice", 0.6).collect()}
    want = {}
    for i, g, t in left:
        scored = [(plain_weighted(t, c), -o, c) for h, c, o in choices if h == g]
        if scored and max(scored)[0] >= 0.6:
            want[i] = (max(scored)[2], pytest.approx(max(scored)[0]))
    assert got == want


def test_clusters_merge_like_a_fold(spark):
    """Whole clusters against the merge of two records, applied member by member; one cluster has most of the rows."""
    kind = "c long, o long, site_id string, nom_site string, variantes_nom array<string>, commune string, region_admin string, description string, surface_m2 double, identifiants_externes map<string,string>, phases array<struct<phase_id:string,site_id:string,periode:string,sous_periode:string>>, sources array<struct<source_id:string,site_id:string,reference:string>>"
    rng = random.Random(11)
    some = lambda *x: rng.choice(x)
    rows = []
    for i in range(44):
        sid = f"s{i}"
        names = [some("A", "B", "C", "", None) for _ in range(rng.randrange(3))]
        phases = [(f"p{i}{j}", sid, some("Ha", "LT"), some(None, "D1")) for j in range(rng.randrange(3))]
        sources = [(some("x", "y", "z", f"q{i}", None), sid, f"r{i}{j}") for j in range(rng.randrange(3))]
        rows.append((some(1, 1, 1, 2, 3, i + 10), i, sid, some("A", "B", "N"), some(names, names, []), some(None, "K"), some(None, "", "R"), some(None, f"d{i}"), some(None, float(i)), some({}, {some("k", "m"): f"{i}"}, {"k": None}), phases, sources))
    df = spark.createDataFrame(rows, kind).repartition(4)
    got = {r.c: r for r in dedup.merge_clusters(df, "c", "o").collect()}
    record = [f for f in df.schema.fields if f.name not in ("c", "o")]
    schema = T.StructType(record)
    both = lambda a, b: spark.createDataFrame([(a, b)], T.StructType([T.StructField("a", schema), T.StructField("b", schema)])).select(dedup.merge(F.col("a"), F.col("b"), schema).alias("m")).first().m
    full = lambda r: sum((len(v) > 0 if isinstance(v, (list, dict)) else v is not None) for f, v in zip(record, r) if f.name not in ("phases", "sources"))
    held = {}
    for r in rows:
        held.setdefault(r[0], []).append(r)
    assert got.keys() == held.keys() and len(held[1]) > 12
    for c, members in held.items():
        members.sort(key=lambda r: (-full(r[2:]), r[1]))
        at = T.Row(*[f.name for f in record])(*members[0][2:])
        for m in members[1:]:
            at = both(tuple(at), m[2:])
        assert got[c].n_members == len(members)
        for f in (f.name for f in record):
            assert getattr(got[c], f) == getattr(at, f), (c, f)


def test_reprojection_by_row(spark):
    rows = [(7.75, 48.58, 4326), (1e6, 6.8e6, 2154), (5.0, 5.0, 2154), (0.0, 0.0, 4326), (None, 1.0, 4326), (7.0, 48.0, None), (7.0, 48.0, 9999), (float("nan"), 1.0, 2154), (410_000.0, 5_380_000.0, 25832)]
    got = [r.p for r in spark.createDataFrame(rows, "x double, y double, e int").coalesce(1).select(geo.reprojected(F.col("x"), F.col("y"), F.col("e")).alias("p")).collect()]
    assert [p.in_bounds for p in got] == [True, True, False, False, False, False, False, False, True]
    assert (got[1].x, got[2].x) == (1e6, 5.0) and all(p.x is None and p.y is None for p in got[3:8])


def test_rows_without_a_place_go(spark):
    df = spark.createDataFrame([("a", "1"), ("", "0"), (None, None), (" ", "12,5"), (None, "x")], "commune string, x_l93 string")
    assert sorted((r.commune or "", r.x_l93) for r in readers.placed_rows(df).collect()) == [(" ", "12,5"), ("a", "1")]
    assert readers.placed_rows(df.select("commune")).count() == 1 and readers.placed_rows(spark.range(3)).count() == 3


def test_fixed_values_have_one_name_each():
    names = re.findall(r"^([A-Z_0-9]+)\s*[:=]", Path(vocab.__file__).read_text(encoding="utf-8"), re.M)
    assert len(names) == len(set(names)) > 20


def test_records_of_one_name_and_commune_are_one_class(spark):
    """What is compared as texts and written grows with the classes, not with pairs of records; forests keep the components."""
    rows = [(i, f"s{i}", ("alpha beta", "alpha betas")[i % 2], "Here", 7.35, 47.97) for i in range(60)]
    sites = _site(spark, rows)
    classes = dedup._classes(sites)
    assert classes.count() == 2 and dedup.class_pairs(sites, classes).count() == 3
    assert dedup.cluster_labels(sites).select("cluster").distinct().count() == 1 and dedup.review_pairs(sites).count() == 0
    rng = random.Random(3)
    edges = spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(200)] * 3, "a long, b long").repartition(5)
    nodes = spark.range(300).withColumnRenamed("id", "node")
    forest = dedup.spanning(edges)
    assert forest.count() < 300 and {*map(tuple, dedup.components(nodes, edges).collect())} == {*map(tuple, dedup.components(nodes, forest).collect())}


def test_searches_by_rounds_equal_all_pairs(spark):
    """Nearest by growing circles, first by prefixes, counts and pairs over spots against every pair; most rows share a spot."""
    rng = random.Random(8)
    spot = [(float(rng.randrange(200)), float(rng.randrange(200))) for _ in range(60)] + [(None, 1.0)]
    left, right = ([(i, rng.choice("ab"), *rng.choice(spot)) for i in range(n)] for n in (150, 400))
    l, r = (spark.createDataFrame(x, f"{n} long, k string, x double, y double") for x, n in ((left, "id"), (right, "ref")))
    d = lambda a, b: math.dist(a[2:], b[2:]) if a[2] is not None and b[2] is not None else math.inf
    assert match._rounds(match.spots(l, ["x", "y", "k"]), match.spots(r, ["x", "y", "k"]), 100.0, ["k"]) > 0
    for k in (1, 3):
        got = sorted((x.id, x["rank"], x.r_ref) for x in match.nearest_where(l, r, 100.0, F.lit(True), "id", ["r_ref"], k, on=["k"]).collect())
        want = [(a[0], n + 1, b[0]) for a in left for n, b in enumerate(sorted((b for b in right if b[1] == a[1] and d(a, b) <= 100), key=lambda b: (d(a, b), b[0]))[:k])]
        assert got == sorted(want)
    first = {(x.x, x.y, x.k): x.r_ref for x in match.first_where(l, r, 30.0, "ref", ["k"]).collect()}
    want = {a[2:] + a[1:2]: min((b[0] for b in right if b[1] == a[1] and d(a, b) <= 30), default=None) for a in left}
    assert first == {k: v for k, v in want.items() if v is not None}
    assert {x.id: x.n for x in match.counts_within(l, r, 30.0).collect()} == {a[0]: sum(d(a, b) <= 30 for b in right) for a in left}
    assert sorted((x.id, x.r_ref) for x in match.radius_pairs(l, r, 30.0, "id", "ref").collect()) == sorted((a[0], b[0]) for a in left for b in right if d(a, b) <= 30)


def test_compatible_texts_lose_no_pair(spark):
    names = ["", " ", "a", "Ab", "abc", "xabcx", "É", "eb", "b", "ABCD", None, "cd"]
    df = spark.createDataFrame([(n,) for n in names], "commune string")
    pairs = df.withColumnRenamed("commune", "v").crossJoin(df.withColumnRenamed("commune", "w"))
    want = {tuple(x) for x in pairs.where(fuzzy.compatible(F.col("v"), F.col("w"))).collect()}
    assert {tuple(x) for x in fuzzy.compatible_texts(df, df).collect()} == want != set()
