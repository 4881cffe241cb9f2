"""Whitening, fingerprints and lexical search against plain versions, on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import fingerprints, lexical, whitening
from tests.llm.test_operators import LOWER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
VECTORS = "vec_id long, embedding array<double>, n string, x int, component string"


def terms(t):
    return WORD.findall((t or "").translate(LOWER))


def plain_components(whole):
    """Eigenpairs by a dense solver, over the distinct integer vectors."""
    x = np.array([[math.floor(256 * c) for c in v] for v in whole], dtype=np.int64)
    fitted = np.unique(x, axis=0)
    e, q = np.linalg.eigh(np.cov(fitted.T, bias=True))
    return x, fitted, e[::-1], q[:, ::-1]


def test_whitening(spark):
    rng = random.Random(3)
    whole = [[rng.gauss(0, 1 + 3 / (1 + d)) for d in range(12)] for _ in range(150)]
    whole += [whole[0]] * 90 + [[-0.0, 0.001, -0.001] + [0.0] * 9]
    rows = [(i, v, "n", 1, "c") for i, v in enumerate(whole)]
    rows += [(900, None, "n", 1, "c"), (901, [None] + [1.0] * 11, "n", 1, "c"), (902, [float("nan")] * 12, "n", 1, "c"), (903, [float("inf")] * 12, "n", 1, "c"), (None, whole[5], None, None, None)]
    got = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)).collect()
    x, fitted, e, q = plain_components(whole)
    n, sums = len(fitted), fitted.sum(axis=0)
    assert len(got) == 4 * (len(whole) + 1) and {r.n for r in got} == {n} and not {r.vec_id for r in got} & {900, 901, 902, 903}
    p = (x - sums / n) @ q[:, :4] / np.sqrt(e[:4])
    for k in range(4):
        mine = {r.vec_id: r for r in got if r.component == k + 1}
        a = np.array([mine[i].whitened for i in range(len(whole))])
        assert np.abs(a * np.sign(a @ p[:, k]) - p[:, k]).max() < 1e-10
        assert abs(mine[0].explained - e[k] / e.sum()) < 1e-12 and mine[0].identity_error < 1e-9 and mine[None].whitened == pytest.approx(mine[5].whitened)
        assert all(mine[i].deviation == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[i], sums)) for i in range(len(whole)))


def test_whitening_of_odd_tables(spark):
    frame = lambda rows: spark.createDataFrame(rows, VECTORS)
    same = [(i, [1.0, 2.0], "n", 1, "c") for i in range(9)]
    assert whitening.whiten(frame([])).count() == whitening.whiten(frame(same)).count() == whitening.whiten(frame([(1, None, "", 1, "c"), (2, [], "", 1, "c")])).count() == 0
    flat = whitening.whiten(frame([(i, [float(i), 2.0 * i, 0.0], "n", 1, "c") for i in range(9)])).collect()
    assert {r.component for r in flat} == {1} and abs(flat[0].explained - 1) < 1e-12
    ragged = whitening.whiten(frame([(1, [1.0], "", 1, "c"), (2, [1.0, 0.0], "", 1, "c"), (3, [0.0, 5.0], "", 1, "c")])).collect()
    assert {r.n for r in ragged} == {2}
    huge = whitening.whiten(frame([(1, [1e300, 1.0], "", 1, "c"), (2, [-1e300, 2.0], "", 1, "c"), (3, [0.5, 3.0], "", 1, "c")])).collect()
    assert {r.vec_id: r.deviation for r in huge} == {1: None, 2: None, 3: (3 * 128 - 127) ** 2 + (3 * 768 - 1536) ** 2}  # the ends of a long


@pytest.mark.parametrize("dims,block,most", [(40, 4, 256), (120, 3, 24), (60, 5, 20)])
def test_lanczos(dims, block, most):
    """Restarted and whole bases find the leading pairs, equal values and a breakdown included."""
    rng = np.random.default_rng(dims)
    q = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    values = np.concatenate(([90.0, 90.0, 80.0, 70.0], np.linspace(20, 0, dims - 4)))
    a = (q * values) @ q.T
    found, vectors, _ = whitening.lanczos(lambda b: a @ b, dims, 4, block, most)
    assert np.allclose(found, values[:4], rtol=1e-12) and np.abs(a @ vectors - vectors * found).max() < 1e-10 and np.allclose(vectors.T @ vectors, np.eye(4), atol=1e-12)
    low = np.outer(q[:, 0], q[:, 0]) * 5.0  # one direction only: every further block breaks down
    found, vectors, _ = whitening.lanczos(lambda b: low @ b, dims, 3, block, most)
    assert found[0] == pytest.approx(5.0) and np.abs(found[1:]).max() < 1e-12


def texts():
    rng = random.Random(12)
    prose = lambda n: " ".join(f"w{rng.randrange(900)}" for _ in range(n))
    hot = prose(80)
    return [None, "", " \n", "one", "One two  three four", "ünï 𝒳𝒴 code points é", hot, hot, hot, prose(30_000), "y" * 400_000, *[prose(rng.randrange(5, 700)) for _ in range(30)]]


SCHEMA = "doc_id long, text string, part int, peek string, h int, score string, rank string, n int, terms int"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, 1, "p", 1, "s", "r", 1, 1) for i, t in enumerate(texts())]
    return spark.createDataFrame(rows + [(None, "no id at all here or there", 1, "", 1, "", "", 1, 1)], SCHEMA).repartition(4)


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_fingerprints(docs, ranges):
    held = texts()
    got = {r.doc_id: r for r in fingerprints.compare(docs, ranges=ranges).collect()}
    order = [*[(i * 3, t or "") for i, t in reversed(list(enumerate(held)))], (None, "no id at all here or there")]
    shingles = lambda t: {tuple(w[i : i + min(5, len(w))]) for w in [terms(t)] for i in range(max(0, len(w) - min(5, len(w)) + 1)) if w}
    share = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    assert len(got) == len(order)
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half, r = len(t) // 2, got[i]
        changed = t[: len(t) - half] + after[:half]
        a, b, c = shingles(t), shingles(changed), shingles(after)
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert len(r.fingerprint) == 16 * min(len(a), fingerprints.SIZE) and len(r.edited_fingerprint) == 16 * min(len(b), fingerprints.SIZE)
        assert abs(r.near_edited - share(a, b)) < 0.2 and abs(r.near_next - share(a, c)) < 0.2 and abs(r.n_shingles - len(a)) <= 0.35 * len(a)
        if len(a | b) <= fingerprints.SIZE:
            assert r.near_edited == share(a, b) and r.n_shingles == len(a)
    assert got[18].fingerprint == got[21].fingerprint == got[24].fingerprint and got[24].near_next == 1.0


def test_fingerprints_of_odd_tables(spark, docs):
    assert fingerprints.compare(docs.limit(0)).count() == 0
    one = fingerprints.compare(docs.where("doc_id = 12")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"One two  tOne two  ").hexdigest()
    tied = spark.createDataFrame([(5, "b b b b", 1), (5, "a a a a", 1), (5, "b b b b", 1), (5, None, 1)], "doc_id long, text string, x int")
    some = lambda n: sorted(tuple(r) for r in fingerprints.compare(tied, ranges=n).collect())
    assert some(1) == some(7) and len(some(1)) == 4
    hot = spark.createDataFrame([(None, "same text in every row of it")] * 200, "doc_id long, text string")
    assert fingerprints.compare(hot, ranges=8).where("near_next = 1 and near_edited <= 1").count() == 200


def test_sketches_merge(spark, docs):
    """Parts merge to the sketch of the whole; columns say what arrays say."""
    held = fingerprints.sketches(docs.where("doc_id is not null")).withColumn("g", F.col("doc_id") % 2)
    by = {r.g: r.sketch for r in fingerprints.merged(held, ["g"]).collect()}
    for g in (0, 1):
        every = np.unique(np.concatenate([fingerprints.sketch((t or "").encode()) for i, t in enumerate(texts()) if i * 3 % 2 == g]))
        assert by[g] == every[: fingerprints.SIZE].tolist()
    pair = held.where("doc_id in (27, 36)").select("sketch").collect()
    a, b = (np.array(r.sketch) for r in pair)
    row = spark.createDataFrame([(a.tolist(), b.tolist()), (a.tolist(), a[:50].tolist()), ([], a.tolist()), ([], [])], "a array<bigint>, b array<bigint>")
    got = row.select(fingerprints.resemblance(F.col("a"), F.col("b")), fingerprints.containment(F.col("a"), F.col("b")), fingerprints.distinct_shingles(F.col("a")), fingerprints.as_text(F.col("a"))).collect()
    for (x, y), r in zip(((a, b), (a, a[:50]), (a[:0], a), (a[:0], a[:0])), got):
        assert tuple(r) == (*fingerprints.likeness(x, y), pytest.approx(fingerprints.distinct(x)), fingerprints.encoded(x))
    long = " ".join(f"v{i % 70_000}" for i in range(300_000)).encode()  # over several pieces
    assert abs(fingerprints.distinct(fingerprints.sketch(long)) / 70_000 - 1) < 0.35
    whole = fingerprints.shingle_hashes(fingerprints._hash_piece(long)[0], 5)
    assert fingerprints.sketch(long).tolist() == np.unique(whole)[: fingerprints.SIZE].tolist()


def plain_ranks(docs, items, best=50, counted=False):
    held = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    total, df = sum(sum(c.values()) for _, c in held), Counter(w for _, c in held for w in c)
    out = []
    for key, c in items.items():
        scored = []
        for i, d in held:
            m = 50 + 50 * sum(d.values()) * len(held) // total
            s = sum((k if counted else 1) * math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[w] + 1))) * (10**9 * d[w] // (1000 * d[w] + 20 * m)) for w, k in c.items() if w in d)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(key, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:best], 1)]
    return out


def test_search(spark, docs):
    rng = random.Random(8)
    items = [(i, " ".join(f"W{rng.randrange(900)}" for _ in range(20)) + " w1 w1") for i in range(25)] + [(7, "w3 w4 here"), (None, "one there"), (40, None), (41, "..."), (42, "nowhere at_all_found zzz")]
    table = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, doc_id int").repartition(3)
    wanted = {}
    for a, b in items:
        if terms(b):
            wanted.setdefault(a, Counter()).update(terms(b))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    order = lambda found: sorted(map(tuple, found), key=str)
    want = order(plain_ranks(rows, wanted))
    assert order(lexical.search(docs, table).collect()) == want and any(i is None for *_, i, _ in want)
    assert order(lexical.search(docs, table, most_terms=60).collect()) == want  # several blocks of items
    assert order(lexical.search(docs, table, best=3, counted=True).collect()) == order(plain_ranks(rows, wanted, 3, True))
    twice = docs.unionByName(docs)
    assert order(lexical.search(twice, table).collect()) == order(plain_ranks(rows + rows, wanted))
    assert lexical.search(docs.limit(0), table).count() == lexical.search(docs, table.limit(0)).count() == lexical.search(docs.where("doc_id = 0"), table).count() == 0
