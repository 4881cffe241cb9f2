"""Toxicity: cumulative-link ordinal regression on sparse text features.

One weight vector is shared by all thresholds: P(grade <= k) = sigmoid(theta_k - w.x), with ordered
thetas. Features are the set of a text's words and of their beginnings, by how many different words of
the text share a beginning and what share of its words they make (inflected families). The labels are
binary, so grades are 0 for harmless, and for toxic ones 1 or 2 by whether their evidence reaches the
toxic median; a row's evidence is summed from log-odds counted on the other half of the sample.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Container, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import alnum_words, binary

#: Bound of the labelled sample.
SAMPLE_ROWS = 6_000
#: Rows a feature must stand in, and its chi-square against the label, to be kept: rare words would fit
#: the sample by heart and say nothing of other texts.
LEAST_ROWS = 3
LEAST_CHI2 = 20.0
#: Lengths of beginnings in bytes; numbers of different words that share one, and their least share of
#: all words in thousandths, that are features of their own.
PREFIXES = (4, 5, 6, 7)
FAMILIES = (1, 2, 3)
SHARES = (5, 12)
L2 = 0.03
STEPS = 200


def features(text: bytes | None, stems: Container[bytes] | None = None) -> set[bytes]:
    """All features of a text, or (for scoring) its words and those of the beginnings ``stems`` only."""
    words = alnum_words(text)
    count = Counter(words)
    family: dict[bytes, list[int]] = {}
    for w, n in count.items():
        for k in PREFIXES:
            if len(w) <= k:
                break
            p = w[:k]
            if stems is None or p in stems:
                held = family.setdefault(p, [0, 0])
                held[0] += 1
                held[1] += n
    out = set(count)
    for p, (different, n) in family.items():
        out.update(b"%d^" % least + p for least in FAMILIES if different >= least)
        out.update(b"%d%%" % share + p for share in SHARES if 1000 * n >= share * len(words))
    return out


def stem_of(feature: bytes) -> bytes | None:
    """The beginning that a feature is about; None for a word (which holds neither mark)."""
    for mark in (b"^", b"%"):
        if mark in feature:
            return feature.partition(mark)[2]
    return None


class OrdinalModel:
    def __init__(self, weights: dict[bytes, float], thetas: Sequence[float]):
        self.weights, self.thetas = weights, list(thetas)
        self.stems = {x for f in weights if (x := stem_of(f)) is not None}

    def score(self, text: bytes | None) -> float:
        get = self.weights.get
        return math.fsum(get(x, 0.0) for x in features(text, self.stems))

    def probabilities(self, score: float) -> list[float]:
        """Of each grade."""
        upto = [1 / (1 + math.exp(-max(-60.0, min(60.0, t - score)))) for t in self.thetas] + [1.0]
        return [b - a for a, b in zip([0.0, *upto], upto)]

    @classmethod
    def fit(cls, texts: Sequence[bytes | None], toxic: Sequence[int], *, steps: int = STEPS, rate: float = 0.1, l2: float = L2) -> OrdinalModel:
        """Full-batch descent on the likelihood of the grades, the whole sample in array operations; reproducible."""
        y = np.asarray(toxic, dtype=np.int64)
        if not len(y) or y.min() == y.max():
            return cls({}, [30.0, 31.0] if not len(y) or not y[0] else [-31.0, -30.0])
        sets = [features(t) for t in texts]
        half = np.arange(len(y)) % 2
        rows, bad = ([Counter(), Counter()] for _ in range(2))
        for s, t, h in zip(sets, y, half):
            rows[h].update(s)
            if t:
                bad[h].update(s)
        n1, n0 = int(y.sum()), int(len(y) - y.sum())
        kept = []
        for f in rows[0].keys() | rows[1].keys():
            n, a = rows[0][f] + rows[1][f], bad[0][f] + bad[1][f]
            if n >= LEAST_ROWS and len(y) * (a * (n0 - n + a) - (n - a) * (n1 - a)) ** 2 >= LEAST_CHI2 * n * (len(y) - n) * n1 * n0:
                kept.append(f)
        kept.sort()
        at = {f: i for i, f in enumerate(kept)}
        held = [sorted(at[f] for f in s if f in at) for s in sets]
        row, col = np.repeat(np.arange(len(y)), [len(x) for x in held]), np.array([i for x in held for i in x], dtype=np.int64)

        def odds(h: int) -> np.ndarray:
            m1, m0 = int(y[half == h].sum()), int((1 - y[half == h]).sum())
            return np.array([max(0.0, math.log((bad[h][f] + 0.5) / (m1 + 1)) - math.log((rows[h][f] - bad[h][f] + 0.5) / (m0 + 1))) for f in kept])

        other = [odds(1), odds(0)]
        evidence = np.where(half == 0, *(np.bincount(row, weights=o[col], minlength=len(y)) for o in other))
        grade = np.where(y == 0, 0, np.where(evidence >= np.median(evidence[y == 1]), 2, 1))
        x, theta = np.zeros(len(kept)), np.array([2.0, 3.0])
        mean, square = np.zeros(len(kept) + 2), np.zeros(len(kept) + 2)
        for t in range(1, steps + 1):
            s = np.bincount(row, weights=x[col], minlength=len(y))
            upto = 1 / (1 + np.exp(-np.clip(theta[:, None] - s, -60, 60)))
            lo, hi = np.where(grade == 0, 0.0, np.where(grade == 1, *upto)), np.where(grade == 2, 1.0, np.where(grade == 0, *upto))
            mass, dlo, dhi = np.maximum(hi - lo, 1e-9), lo * (1 - lo), hi * (1 - hi)
            slope = (dhi - dlo) / mass  # of the negative log-likelihood by the score
            g = np.concatenate((np.bincount(col, weights=slope[row], minlength=len(kept)) + l2 * x, [-(dhi / mass)[grade == 0].sum() + (dlo / mass)[grade == 1].sum(), -(dhi / mass)[grade == 1].sum() + (dlo / mass)[grade == 2].sum()]))
            mean, square = 0.9 * mean + 0.1 * g, 0.99 * square + 0.01 * g * g
            step = rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
            x, theta = x - step[:-2], theta - step[-2:]
            theta[1] = max(theta[1], theta[0] + 1e-3)
        return cls({f: float(x[i]) for f, i in at.items() if abs(x[i]) > 1e-6}, theta.tolist())


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> OrdinalModel:
    """Fit on at most ``rows`` labelled documents, drawn by the hash of their id; of a repeated id the least text."""
    drawn = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("__toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("__toxic").alias("__toxic"))
    got = sorted(((r[0], r[1], r[2]) for r in found.toLocalIterator()), key=lambda r: r[0])
    return OrdinalModel.fit([t.encode() if t else None for _, t, _ in got], [int(y) for *_, y in got])


def _grade(shared, text_col: str):
    def run(batches):
        import pyarrow as pa

        model: OrdinalModel = shared.value
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for t in binary(batch, text_col):
                p = model.probabilities(model.score(t))
                for c, v in zip(cols, (round(p[1] + 2 * p[2], 9), int(np.argmax(p)), round(1 - p[0], 9), p[0] < 0.5)):
                    c.append(v)
            kinds = (pa.float64(), pa.int32(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, type=k) for c, k in zip(cols, kinds))], ["doc_id", "severity", "grade", "p_toxic", "toxic"])

    return run


def grade(docs: DataFrame, model: OrdinalModel, *, text: str = "text") -> DataFrame:
    """One row per document: doc_id, severity (expected grade, 0 to 2), grade (likeliest), p_toxic, toxic.

    Null or empty text has no features and gets the base rate; equal texts get equal grades, so repeated
    rows repeat; a very long text is read whole; an empty table gives an empty result; without labels of
    both kinds the one kind is predicted; further columns are ignored. Narrow, no shuffle; the broadcast
    model holds features of the bounded sample only.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", text).mapInArrow(_grade(shared, text), "doc_id long, severity double, grade int, p_toxic double, toxic boolean")
