"""Near-duplicate passages, licence chains and clashing ids against versions that share no code with the operators."""

import random

import pytest

from tessera.llm import licenses, passages, simhash_bk
from tests.llm.test_operators import prose, words

#: Words of a passage, and how many are changed; where negative, so many words are put in instead.
BANDS = ((80, 1), (120, 2), (200, 4), (200, 3), (200, -4))


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)]


def jaccard(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def planted():
    """Pairs of unrelated texts that share a passage, in one of them with words changed at even distances."""
    rng, rows, pairs = random.Random(31), [], []
    for size, edits in BANDS:
        for _ in range(50):
            passage = prose(rng, size).split()
            edited = list(passage)
            for k in reversed(range(abs(edits))):
                at = size * (k + 1) // (abs(edits) + 1)
                edited[at : at + (edits > 0)] = [f"changed{rng.randrange(10**9)}"]
            pairs.append((len(rows), len(rows) + 1, size, edits, jaccard(grams(passage), grams(edited))))
            for p in (passage, edited):
                rows.append((len(rows), " ".join([prose(rng, rng.randrange(60, 200)), *p, prose(rng, rng.randrange(60, 200))])))
    rows += [(len(rows) + i, prose(rng, 300)) for i in range(60)]
    return rows, pairs


def test_evenly_edited_passages(spark, planted):
    """Of each kind of pair, similarities from 0.81 to 0.92, nine in ten are found; every span told is as similar as asked for."""
    rows, pairs = planted
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in passages.classes(df).collect()}
    for size, edits in BANDS:
        mine = [(a, b) for a, b, s, e, j in pairs if (s, e) == (size, edits) and 0.8 <= j < 0.95]
        assert len(mine) == 50 and sum(got[a].class_id == got[b].class_id for a, b in mine) >= 45, (size, edits)
    together = {(a, b) for a, b, *_ in pairs}
    assert all(r.class_id == i or (r.class_id, i) in together for i, r in got.items())
    w, found = {i: words(t) for i, t in rows}, passages.repeats(df).collect()
    for r in found:
        assert jaccard(grams(w[r.doc][r.first : r.last + 1]), grams(w[r.rep][r.rep_first : r.rep_last + 1])) >= 0.8
    reached = {}
    for r in found:
        reached[r.rep, r.doc] = max(reached.get((r.rep, r.doc), 0), r.last - r.first + 1)
    for size, edits in BANDS:  # and over their whole length
        assert sum(reached.get((a, b), 0) in (s, s - min(e, 0)) for a, b, s, e, _ in pairs if (s, e) == (size, edits)) >= 45, (size, edits, [reached.get((a, b), 0) for a, b, s, e, _ in pairs if (s, e) == (size, edits)])


def test_longest_stretches():
    """Against all pairs of runs."""
    import numpy as np

    rng = random.Random(6)
    for _ in range(200):
        n = rng.randrange(1, 9)
        size, gap = [rng.randrange(1, 60) for _ in range(n)], [rng.randrange(1, 14) for _ in range(n - 1)]
        good = [(i, j) for i in range(n) for j in range(i, n) if sum(size[i : j + 1]) >= passages.PENALTY * sum(gap[i:j])]
        want = [(i, j) for i, j in good if not any((x, y) != (i, j) and x <= i and j <= y for x, y in good)]
        assert passages.longest_stretches(np.array(size), np.array(gap)) == want


def chain_of_all(found, sizes, labels):
    """Best covered share per label: every earlier match is tried."""
    best, done = {}, []
    for end, t, at, n in found:
        value = n
        for d, u, x, covered in done:
            if u == t:
                gap, skip = end - n - d, at - n - x
                if 0 <= gap <= licenses.MAX_GAP and 0 <= skip <= licenses.MAX_GAP:
                    value = max(value, covered + n)
                elif gap < 0 and end - d == at - x > 0:
                    value = max(value, covered + end - d)
        done.append((end, t, at, value))
        best[labels[t]] = max(best.get(labels[t], 0.0), min(1.0, value / sizes[t]))
    return best


def test_chains_of_perturbed_licences():
    rng, model = random.Random(77), licenses.Templates()
    held = []
    plain, model.chain = model.chain, lambda found: (held.append(list(found)), plain(found))[1]
    for _ in range(400):
        w = licenses.alnum_words(rng.choice(licenses.TEMPLATES)[1].encode())
        for _ in range(rng.randrange(1, 5)):
            at = rng.randrange(len(w))
            w[at : at + rng.randrange(3)] = rng.choice(([b"changed"], [b"new", b"words"], w[max(0, at - 12) : at], []))
            w = w or [b"x"]
        got = model.scan(w)["best"]
        assert got == chain_of_all(held[-1], model.sizes, model.labels)
    # a long match that ends late but starts before a short one
    t = max(range(len(model.sizes)), key=model.sizes.__getitem__)
    assert plain([(10, t, 10, 10), (30, t, 25, 5), (40, t, 38, 28)])["best"] == {model.labels[t]: 38 / model.sizes[t]}


def test_clashing_ids_keep_their_texts(spark):
    a, near, b = (prose(random.Random(i), 300) for i in (1, 1, 2))
    near = near.replace(near.split()[5], "other", 1)
    rows = [(1, a, 1), (5, a, 2), (5, b, 3), (7, b, 4), (7, near, 5), (9, "alone here", 7), (9, "alone here", 7), (9, "alone here", 8), (None, a, 9), (None, a, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, x int")
    kept = sorted(map(tuple, simhash_bk.keep_first(df).collect()), key=str)
    for _ in range(2):
        assert sorted(map(tuple, simhash_bk.keep_first(df.repartition(5)).collect()), key=str) == kept
    assert [(r[0], r[1]) for r in kept] == sorted([(1, a), (5, b), (9, "alone here"), (None, a), (None, a)], key=str)
    mapped = spark.createDataFrame([(3, a, {"k": 1}), (3, a, {"k": 1}), (3, a, {"k": 2})], "doc_id long, text string, m map<string,long>")
    assert simhash_bk.keep_first(mapped).count() == 1
    tied = spark.createDataFrame([(3, a, 1), (3, near, 2), (4, a, 3)], "doc_id long, text string, x int")
    assert [r.doc_id for r in simhash_bk.keep_first(tied).collect()] == [3]
