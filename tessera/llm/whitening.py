"""Embedding whitening: leading components of the covariance by matrix-free block Lanczos.

The covariance is never formed: each step is one distributed pass that multiplies it with a narrow
block, every row centred before the product. The driver holds the basis (dimensions times at most
BASIS + BLOCK), keeps it orthogonal to all earlier blocks, restarts broken-down directions at random and
stops when the residuals of the wanted pairs are down at rounding. Sums, deviations and the trace are exact integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

COMPONENTS = 4
SCALE = 256
#: Columns of a block, and of the basis before it is condensed to its leading Ritz vectors.
BLOCK = 8
BASIS = 256
#: Residual against the largest value at which a pair counts as settled: rounding of the products.
TOLERANCE = 16 * np.finfo(float).eps
#: Values that one step of a task works on.
STEP_VALUES = 1 << 20
_LIMB = 30


@dataclass
class Model:
    """n and sums are exact; columns of ``vectors`` are unit eigenvectors by falling ``values``."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def integers(column, dims: int, scale: int = SCALE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) of an Arrow list column, some rows at a time: floor(scale * c) of each vector without null or non-finite entries.

    A vector shorter than ``dims`` counts as if it ended in zeros; what a long cannot hold is its nearest end.
    """
    import pyarrow.compute as pc

    step = max(1, STEP_VALUES // max(1, dims))
    for at in range(0, len(column), step):
        part = column.slice(at, step)
        size = part.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
        flat = part.flatten()
        value = pc.fill_null(flat.cast("float64"), float("nan")).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(part)), np.maximum(size, 0))
        good = size >= 0
        good[row[~np.isfinite(value)]] = False
        start = np.concatenate(([0], np.cumsum(np.maximum(size, 0))[:-1]))
        x = np.zeros((len(part), dims), dtype=np.int64)
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = np.floor(scale * value)
            whole = np.where(np.abs(scaled) < 2.0**63, scaled, 0).astype(np.int64)
        whole[scaled >= 2.0**63] = 2**63 - 1
        whole[scaled <= -(2.0**63)] = -(2**63)
        x[row, np.arange(len(row)) - start[row]] = whole
        kept = np.flatnonzero(good)
        if len(kept):
            yield kept + at, x[kept]


def exact(x: np.ndarray, rows: int) -> np.ndarray:
    """``x`` as it stands if sums of so many squares fit in 64 bits, else as Python integers."""
    top = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    return x if top * top * max(1, rows) < 2**62 else x.astype(object)


def _encode(dims: int, scale: int) -> Callable:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for _, x in integers(batch.column(0), dims, scale):
                made = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), dims).cast(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([made], ["x"])

    return run


def _matrix(batch, dims: int) -> Iterator[np.ndarray]:
    """The x of a batch as rows, some at a time."""
    flat = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    step = max(1, STEP_VALUES // dims)
    for at in range(0, len(flat), step):
        yield flat[at : at + step]


def _limbs(value: int) -> list[int]:
    """Digits to the base 2**30, the last one signed, so that sums of them stay small."""
    out = []
    while not -(1 << _LIMB) < value < (1 << _LIMB):
        out.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*out, value]


def _totals(dims: int) -> Callable:
    def run(batches):
        import pyarrow as pa

        n, sums, squares = 0, np.zeros(dims, dtype=object), 0
        for batch in batches:
            for x in _matrix(batch, dims):
                held = exact(x, x.size)
                n += len(x)
                sums = sums + held.sum(axis=0).astype(object)
                squares += int((held * held).sum())
        rows = [(d, i, v) for d, s in enumerate([*sums, squares, n]) for i, v in enumerate(_limbs(int(s)))]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in zip(*rows)], ["d", "limb", "v"])

    return run


def _products(mean: np.ndarray, block: np.ndarray) -> Callable:
    """Per task: sum of c (c . block) over its centred rows c."""

    def run(batches):
        import pyarrow as pa

        out = np.zeros(block.shape)
        for batch in batches:
            for x in _matrix(batch, len(mean)):
                c = x - mean
                out += c.T @ (c @ block)
        yield _rows(out, pa)

    return run


def _moments(mean: np.ndarray, block: np.ndarray) -> Callable:
    """Per task: sums of the projections, and of their products."""

    def run(batches):
        import pyarrow as pa

        k = block.shape[1]
        out = np.zeros((k + 1, k))
        for batch in batches:
            for x in _matrix(batch, len(mean)):
                p = (x - mean) @ block
                out[0] += p.sum(axis=0)
                out[1:] += p.T @ p
        yield _rows(out, pa)

    return run


def _rows(out: np.ndarray, pa):
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(out))), *(pa.array(np.ascontiguousarray(c)) for c in out.T)], ["d", *(f"v{i}" for i in range(out.shape[1]))])


def summed(fitted: DataFrame, task: Callable, rows: int, columns: int) -> np.ndarray:
    """Sum over the tasks of what each makes, rows by columns: no more than that reaches the driver."""
    names = [f"v{i}" for i in range(columns)]
    made = fitted.mapInArrow(task, ", ".join(["d long", *(f"{c} double" for c in names)]))
    out = np.zeros((rows, columns))
    for d, *v in made.groupBy("d").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[d] = v
    return out


def orthogonal(new: np.ndarray, basis: np.ndarray, rng: np.random.Generator, least: float = 1e-10) -> np.ndarray:
    """Unit columns orthogonal to ``basis`` and each other; a column that breaks down is restarted at random."""
    room = len(new) - basis.shape[1]
    out: list[np.ndarray] = []
    for v in list(new.T)[:room]:
        while True:
            before = np.linalg.norm(v)
            for _ in range(3):
                v = v - basis @ (basis.T @ v)
                for q in out:
                    v = v - q * (q @ v)
            now = np.linalg.norm(v)
            if now > least * max(before, 1e-300) and now > 1e-290:
                out.append(v / now)
                break
            v = rng.standard_normal(len(v))
    return np.array(out).T.reshape(len(new), -1)


def lanczos(multiply: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, block: int = BLOCK, most: int = BASIS, seed: int = 11) -> tuple[np.ndarray, np.ndarray, int]:
    """(values falling, unit vectors, passes) of the symmetric operator ``multiply``, which takes and gives dims by b.

    Ritz pairs come from the whole basis; their residuals are true ones, as the products with the basis
    are kept. Ends when those of the wanted pairs are at rounding, stand still there, or the space is exhausted.
    """
    rng = np.random.default_rng(seed)
    wanted, block = min(wanted, dims), min(block, dims)
    most = max(most, 2 * (wanted + block))
    basis, images = np.zeros((dims, 0)), np.zeros((dims, 0))
    new, passes, history = orthogonal(rng.standard_normal((dims, block)), basis, rng), 0, []
    while True:
        image = multiply(new)
        passes += 1
        basis, images = np.hstack((basis, new)), np.hstack((images, image))
        core = basis.T @ images
        values, turn = np.linalg.eigh((core + core.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        top = max(abs(values[0]), abs(values[-1]))
        off = images @ turn[:, :wanted] - (basis @ turn[:, :wanted]) * values[:wanted]
        history.append(np.linalg.norm(off, axis=0).max() / top if top > 0 else 0.0)
        still = len(history) > 4 and history[-1] < 1e3 * TOLERANCE and history[-1] > 0.5 * history[-4]
        # The first block alone may be an invariant one that misses larger values.
        if basis.shape[1] == dims or passes > 1 and (history[-1] <= TOLERANCE or still):
            return values[:wanted], np.linalg.qr(basis @ turn[:, :wanted])[0], passes
        new = orthogonal(image, basis, rng)
        if basis.shape[1] + block > most:
            kept = turn[:, : wanted + block]
            basis, images = basis @ kept, images @ kept


def fit(vectors: DataFrame, *, embedding: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, block: int = BLOCK) -> Model | None:
    """Components of the covariance over the distinct vectors of x = floor(scale * c); None where no vector is whole.

    Equal vectors are dropped by a hash aggregate that combines before the shuffle, so a vector that
    many rows share reaches one task once per task. Only components with a variance over rounding count.
    """
    column = vectors.select(F.col(embedding).alias("x"))
    dims = column.agg(F.max(F.size("x"))).first()[0]
    if dims is None or dims < 1:
        return None
    fitted = materialise(column.mapInArrow(_encode(dims, scale), "x array<bigint>").distinct(), "whitening-fit")
    totals: dict[int, int] = {}
    for d, limb, v in fitted.mapInArrow(_totals(dims), "d long, limb long, v long").groupBy("d", "limb").agg(F.sum("v")).collect():
        totals[d] = totals.get(d, 0) + (int(v) << (_LIMB * limb))
    n = totals.get(dims + 1, 0)
    if not n:
        return None
    sums = [totals[d] for d in range(dims)]
    mean = np.array([s / n for s in sums])
    spread = n * n * totals[dims] - n * sum(s * s for s in sums)  # the deviations of all, summed
    trace = spread / n**3
    empty = Model(n, sums, np.zeros(0), np.zeros((dims, 0)), trace, 0.0, 0)
    if not spread:
        return empty
    values, found, passes = lanczos(lambda q: summed(fitted, _products(mean, q), dims, q.shape[1]) / n, dims, components, block)
    real = values > dims * np.finfo(float).eps * values[0]
    values, found = values[real], found[:, real]
    found = found * np.sign(found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])])
    k = len(values)
    moments = summed(fitted, _moments(mean, found / np.sqrt(values)), k + 1, k) / n
    error = float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(k)).max())
    return Model(n, sums, values, found, trace, error, passes)


def _apply(model: Model, scale: int) -> Callable:
    sums, mean, dims = model.sums, model.mean, len(model.sums)
    block, k = model.vectors / np.sqrt(model.values), len(model.values)
    small = max(map(abs, sums)) < 2**62
    explained = model.values / model.trace

    def deviations(x: np.ndarray) -> list[int | None]:
        top = max(abs(int(x.max())), abs(int(x.min())))
        if small and (model.n * top + max(map(abs, sums))) ** 2 * dims < 2**62:
            z = model.n * x - np.array(sums, dtype=np.int64)
            return (z * z).sum(axis=1).tolist()
        z = model.n * x.astype(object) - np.array(sums, dtype=object)
        return [int(v) if v < 2**63 else None for v in (z * z).sum(axis=1)]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for rows, x in integers(batch.column(1), dims, scale):
                m = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n, dtype=np.int64)),
                        pa.array(deviations(x), type=pa.int64()).take(pa.array(np.repeat(np.arange(m), k))), pa.array(((x - mean) @ block).ravel()),
                        pa.array(np.tile(explained, m)), pa.array(np.full(m * k, model.identity_error)),
                    ],
                    ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return run


def transform(vectors: DataFrame, model: Model | None, *, embedding: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """One row per whole vector and component: key, component, n, deviation, whitened, explained, identity_error. Narrow."""
    kind = vectors.schema[key].dataType.simpleString()
    shape = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], shape)
    return vectors.select(F.col(key).alias("key"), F.col(embedding).alias("x")).mapInArrow(_apply(model, scale), shape)


def whiten(vectors: DataFrame, *, embedding: str = "embedding", key: str = "vec_id", components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """Fit over the distinct vectors, then the whitened components of every row.

    A row whose vector is null or holds a null or non-finite entry has no result; a null key passes;
    repeated rows have one result each and count once in the fit; a shorter vector counts as if it ended
    in zeros; very long vectors are worked on in steps; ties among values leave the basis within them
    free, but it is the same for all rows; directions without variance are no components, so equal
    vectors only, one vector or an empty table give an empty result; a deviation beyond a long is null;
    other columns are ignored.
    """
    return transform(vectors, fit(vectors, embedding=embedding, components=components, scale=scale), embedding=embedding, key=key, scale=scale)


def deviations(vectors: DataFrame, *, embedding: str = "embedding", key: str = "vec_id", scale: int = SCALE) -> DataFrame:
    """key, n and deviation of every row of ``whiten``, once: its columns that SQL can say again."""
    return whiten(vectors, embedding=embedding, key=key, components=1, scale=scale).select(key, "n", "deviation")


BASE_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT) for c in embedding] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter([c IS NOT NULL AND isfinite(CAST(c AS DOUBLE)) for c in embedding], lambda b: NOT b)) = 0),
f AS (SELECT DISTINCT x FROM v),
n AS (SELECT count(*) AS n FROM f),
s AS (SELECT i, sum(c) AS s FROM (SELECT unnest(x) AS c, generate_subscripts(x, 1) AS i FROM f) GROUP BY i),
d AS (SELECT x, CAST(sum((n * c - s) * (n * c - s)) AS BIGINT) AS deviation FROM (SELECT x, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM f) e JOIN s ON s.i = e.i, n GROUP BY x)
SELECT vec_id, n, deviation FROM v JOIN d ON d.x = v.x, n
"""
