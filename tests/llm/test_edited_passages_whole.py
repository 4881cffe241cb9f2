"""No pair of passages that meets the threshold is left out: all planted ones, against the planting alone."""

import random

import numpy as np

from tessera.llm import passages
from tests.llm.test_edited_passages import grams, jaccard
from tests.llm.test_operators import prose

#: Words of a passage and how many are changed: similarities from 0.80 to 0.82.
LEAST_ALIKE = ((51, 1), (97, 2), (145, 3), (195, 4))


def edited(rng, passage, edits):
    out = list(passage)
    for k in range(edits):
        out[len(out) * (k + 1) // (edits + 1)] = f"changed{rng.randrange(10**9)}"
    return out


def test_passages_at_the_threshold(spark):
    """Each of 400 pairs at a similarity of 0.80 to 0.82; the hash functions alone may part some."""
    rng, rows, pairs = random.Random(83), [], []
    for size, edits in LEAST_ALIKE:
        for _ in range(100):
            passage = prose(rng, size).split()
            other = edited(rng, passage, edits)
            assert 0.8 <= jaccard(grams(passage), grams(other)) < 0.82
            pairs.append((len(rows), len(rows) + 1))
            for p in (passage, other):
                rows.append((len(rows), " ".join([prose(rng, rng.randrange(20, 200)), *p, prose(rng, rng.randrange(20, 200))])))
    rows += [(len(rows) + i, prose(rng, 300)) for i in range(40)]
    got = {r.doc_id: r for r in passages.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [p for p in pairs if got[p[1]].class_id != p[0]] == []
    assert all(got[a].n_links == got[b].n_links == 1 for a, b in pairs)
    assert all(got[i].class_id == i for i, _ in rows if i > pairs[-1][1])


def test_edits_that_repeat_words(spark):
    """Words said twice, sentences that stand in many texts on either side of an edit, and rows of one word."""
    rng, rows, pairs = random.Random(84), [], []
    shared = [prose(rng, 26, "s") for _ in range(6)]
    rows += [(i, " ".join(prose(rng, 60) + " " + x for x in rng.sample(shared, 6))) for i in range(80)]

    def plant(a, b):
        assert jaccard(grams(a), grams(b)) >= 0.8
        pairs.append((len(rows), len(rows) + 1))
        for p in (a, b):
            rows.append((len(rows), " ".join([prose(rng, 70), *p, prose(rng, 70)])))

    for _ in range(20):
        p = prose(rng, 80).split()
        plant(p, [*p[:20], p[19], *p[20:40], p[39], *p[40:]])
        q = [f"r{rng.randrange(10**6)}" for _ in range(10)]
        plant([w for w in q for _ in range(6)], [w for w in q for _ in range(7)])
    for a, b in zip(shared[::2], shared[1::2]):
        plant([*a.split(), "left", *b.split()], [*a.split(), "right", *b.split()])
    got = {r.doc_id: r for r in passages.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [p for p in pairs if got[p[1]].class_id != got[p[0]].class_id] == []


def test_rarest_shingles_meet():
    """Windows with few shingles apart have one of their rarest in common, whatever the counts."""
    rng = random.Random(85)
    for size, edits in LEAST_ALIKE * 40:
        p = [rng.randrange(10**6) for _ in range(size)]
        other = list(p)
        for k in range(edits):
            other[size * (k + 1) // (edits + 1)] = 2**40 + k
        far = lambda: [rng.randrange(10**6) for _ in range(50)]
        both = [passages.combined(np.array([*far(), *x, *far()], dtype=np.uint64)) for x in (p, other)]
        tokens = np.intersect1d(*both)
        tokens = np.concatenate((tokens, both[0][:20], both[1][-20:]))  # and some that other texts have
        counts = np.array([2 + int(t) % 40 for t in tokens.tolist()])
        for many in (counts, counts + passages.FEW):  # single shingles, and two of frequent ones
            x, y = ({k: (a, b) for k, a, b in zip(*(c.tolist() for c in passages.rarest(s, tokens, many)))} for s in both)
            assert len({t for k in x.keys() & y.keys() for t in x[k]}) >= passages.MORE
