"""Substring dedup: near-duplicate passages by compact windows of min-hashed shingles.

For a hash function, a position's compact window is the widest range in which its shingle has the
least hash; the Cartesian tree over the hashes gives them, and all subsequences of at least LEAST
shingles fall into about 2n / LEAST of them. Windows of two texts with the same least shingle share
their signature over every pair of subsequences around it. Windows are joined by signature, aligned as
intervals, counted over the hash functions, and what collides in enough of them is verified by the hashes of its shingles (of the 64 bits the upper
32; words of over a thousand bytes could be made to collide).
Runs of LEAST_WORDS equal words need no luck: those that no verified passage with a smaller id covers are
keyed by all their words wherever their least shingles occur twice, and linked to the first that holds them.
Neither do edited passages, which the hash functions may part: alike stretches have an equal run of RUN shingles
(``_meetings``) and, of any window's RAREST rarest shingles, one in common (``_rarest``), so that what meets by
these is all there is; it is compared over all its shingles.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import count, repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import alnum_bytes, binary, materialise, runs
from .components import components

SHINGLE = 5
LEAST_WORDS = 50
LEAST = LEAST_WORDS - SHINGLE + 1
#: Hash functions, and in how many of them a pair of texts must collide to be compared at once. Equal passages
#: collide in all; what is alike and does not is met by its rarest shingles.
HASHES = 3
ENOUGH = 2
SIMILARITY = 0.8
#: e equal shingles beside g others, of both texts together, have a similarity of e / (e + g): with so much
#: against each of the g, a sum of at least zero means one of SIMILARITY.
PENALTY = 4
#: Shingles on either side of the segments that are compared too, as an edit may end a window early.
MARGIN = 2 * LEAST
#: Bytes of several texts that are worked on at once, in arrays; a longer text is hashed in such pieces.
CHUNK_BYTES = 3_000_000
#: Of e equal shingles with gaps of g in all, e >= PENALTY * g and e + g >= LEAST. Where each gap takes 3 or more of
#: both texts together, the longest equal run has RUN at least (three gaps of 3: 37 in four runs). A smaller gap
#: stands beside an equal shingle whose first words repeat with a period of 1 or 2.
RUN = 10
#: Such a stretch of less than REACH shingles is in every alike stretch: cut in two parts of LEAST or more, one of them is alike.
REACH = 128
#: The best windows of LEAST shingles of both sides have 35 or more in common: of 46 + t against 46 at least 41 + 4 t / 9 are
#: equal, so t is 11 at most, and t more are lost where the larger side is cut to 46. A window every STEP shingles loses
#: STEP - 1 more. So RAREST - 1 at most are not common, and the rarest that is common is among the RAREST rarest of both.
ALIKE = 35
STEP = 4
RAREST = LEAST - ALIKE + STEP + 1
#: Of so many more of a window's rarest as many more are common; what has fewer in common is not compared.
MORE = 4
#: Shingles on either side of a common one that are compared.
AROUND = 2 * REACH
#: A shingle of more texts is no key but with another of its window.
FEW = 32

_SEEDS = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) & (2**64 - 1)) for i in range(16)]

_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)
_REAL = np.uint64(1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE and its inverse to the powers from 0 to n, kept between calls."""
    if len(_powers[0]) <= n:
        with np.errstate(over="ignore"):
            for i, b in enumerate((_BASE, _INVERSE)):
                _powers[i] = np.multiply.accumulate(np.concatenate((np.ones(1, dtype=np.uint64), np.full(max(n, CHUNK_BYTES), b, dtype=np.uint64))))
    return _powers[0][: n + 1], _powers[1][: n + 1]


def _hash_piece(piece: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of each word between blanks: differences of a running polynomial over the bytes."""
    b = np.frombuffer(b" " + piece + b" ", dtype=np.uint8)
    word = b != 32
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    start, stop = edge[::2], edge[1::2]
    up, down = powers(len(b))
    with np.errstate(over="ignore"):
        upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(b.astype(np.uint64) * up[:-1], dtype=np.uint64)))
        return _mix((upto[stop] - upto[start]) * down[start]), start - 1


def hash_words(text: bytes | None) -> np.ndarray:
    """64-bit hash of each word, whatever the length of the text."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    t, out, at = alnum_bytes(text), [], 0
    while at < len(t):
        to = min(len(t), at + CHUNK_BYTES)
        if to < len(t):  # up to the last blank; a longer word ends at the next one
            cut = t.rfind(b" ", at, to)
            to = cut if cut > at else t.find(b" ", to)
            to = len(t) if to < 0 else to
        out.append(_hash_piece(t[at:to])[0])
        at = to + 1
    return np.concatenate(out)


def combined(h: np.ndarray) -> np.ndarray:
    """Hash of each run of SHINGLE words, from the words' hashes."""
    n = len(h) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SHINGLE):
            out = out * np.uint64(0x100000001B3) + h[i : i + n]
    return _mix(out)


def shingles(text: bytes | None) -> np.ndarray:
    return combined(hash_words(text))


def compared(text: bytes | None) -> np.ndarray:
    """Upper halves of the shingle hashes: as a changed word changes five in a row, enough to tell aligned texts apart."""
    return (shingles(text) >> np.uint64(32)).astype(np.uint32)


class Chunk:
    """Shingles of several texts end to end. Positions are words; the last SHINGLE - 1 of a text hold no shingle."""

    def __init__(self, hashed: list[np.ndarray]):
        size = np.array([len(h) for h in hashed], dtype=np.int64)
        self.stop = np.cumsum(size)
        self.start = self.stop - size
        self.words = np.concatenate([*hashed, np.zeros(LEAST, dtype=np.uint64)])
        self.s = combined(self.words)
        self.real = np.ones(len(self.s), dtype=bool)
        for i in range(1, SHINGLE):
            self.real[self.stop - i] = False
        self.real[int(self.stop[-1]) :] = False
        self.bits = np.uint64(max(1, (len(self.s) - 1).bit_length()))

    def text_of(self, at: np.ndarray) -> np.ndarray:
        """Number of the text that holds a position."""
        return np.searchsorted(self.stop, at, side="right")

    def hashes(self, k: int) -> np.ndarray:
        return _mix(self.s ^ _SEEDS[k])

    def least(self, h: np.ndarray, width: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
        """Per position, that of the least shingle of the ``width`` from there on, and all values in order; where a text ends, its end is least."""
        at = np.arange(len(h), dtype=np.uint64)
        v = np.where(self.real, (((h >> np.uint64(1)) | _REAL) >> self.bits << self.bits) | at, at)
        return sliding_least(v, width) & ((np.uint64(1) << self.bits) - np.uint64(1)), v


def hash_texts(texts: list[bytes]) -> list[np.ndarray]:
    """``hash_words`` of several texts at once."""
    if len(texts) == 1:
        return [hash_words(texts[0])]
    h, at = _hash_piece(b" ".join(map(alnum_bytes, texts)))
    ends = np.cumsum(np.array([len(t) + 1 for t in texts]))
    return np.split(h, np.searchsorted(at, ends[:-1]))


def chunks(batch, text: str) -> Iterator[tuple[list[int], Chunk]]:
    """Rows (numbers in the batch) of texts with LEAST_WORDS words or more, some at a time."""
    rows, held, size = [], [], 0

    def made():
        kept = [(i, h) for i, h in zip(rows, hash_texts(held)) if len(h) >= LEAST_WORDS]
        if kept:
            yield [i for i, _ in kept], Chunk([h for _, h in kept])

    for i, t in enumerate(binary(batch, text)):
        if not t or len(t) < 2 * LEAST_WORDS - 1:
            continue
        if rows and size + len(t) > CHUNK_BYTES:
            yield from made()
            rows, held, size = [], [], 0
        rows.append(i)
        held.append(t)
        size += len(t) + 1
    if rows:
        yield from made()


def compact_windows(chunk: Chunk, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, left, right) of every compact window of at least LEAST positions; ties go left.

    Only a position that is least in some stretch of LEAST positions has so wide a window, and the
    next smaller position on either side of it is of that kind too: the sliding minimum names them, and
    the Cartesian tree is built over them alone. The ends of texts are smaller than any shingle.
    """
    low, v = chunk.least(h)
    at = np.unique(low).astype(np.int64)
    values = v[at].tolist()
    smaller_before, smaller_after = [-1] * len(values), [len(values)] * len(values)
    for i, x in enumerate(values):
        j = i - 1
        while j >= 0 and values[j] > x:
            smaller_after[j] = i
            j = smaller_before[j]
        smaller_before[i] = j
    edges = np.concatenate((at, [len(h), -1]))  # place -1 is before all, place len(values) behind all
    left, right = edges[np.array(smaller_before)] + 1, edges[np.array(smaller_after)] - 1
    # In a text that repeats itself within LEAST positions the first of the ties stands for all:
    # its window reaches over theirs.
    before = np.maximum(left - 1, 0)
    tied = (left > 0) & chunk.real[before] & (h[before] == h[at]) & (at - before < LEAST)
    kept = chunk.real[at] & ~tied
    return at[kept], left[kept], right[kept]


def _windows(batches):
    import pyarrow as pa

    names, kinds = ["key", "doc", "k", "c", "l", "r"], (np.int64, np.int64, np.int8, np.int32, np.int32, np.int32)
    for batch in batches:
        docs = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for rows, chunk in chunks(batch, "text"):
            cols: list[list[np.ndarray]] = [[] for _ in names]
            for k in range(HASHES):
                h = chunk.hashes(k)
                c, left, right = compact_windows(chunk, h)
                text = chunk.text_of(c)
                start = chunk.start[text]
                for to, x in zip(cols, (h[c].view(np.int64), docs[np.array(rows)[text]], np.full(len(c), k), c - start, left - start, right - start)):
                    to.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t)) for c, t in zip(cols, kinds)], names)


def run_hashes(s: np.ndarray, least: int) -> np.ndarray:
    """Hash of each run of ``least`` shingles: differences of a running polynomial, moved to one power."""
    n = len(s) - least + 1
    with np.errstate(over="ignore"):
        up, down = powers(len(s))
        upto = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(s * up[:-1])))
        return _mix((upto[least:] - upto[:-least]) * down[:n])


def sliding_least(h: np.ndarray, least: int) -> np.ndarray:
    """The least value of each ``least`` neighbouring positions."""
    n = len(h)
    grid = np.concatenate((h, np.full(-n % least, np.uint64(2**64 - 1)))).reshape(-1, least)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - least + 1], ahead[least - 1 : n])


def _flat(lists, dtype) -> tuple[np.ndarray, np.ndarray]:
    """Values of an Arrow list column one after the other, and the row of each."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype), np.repeat(np.arange(len(sizes)), sizes)


def _equal_runs(batches):
    """The runs of LEAST shingles whose least one, by each hash function, is among the document's shared keys, and that no covered stretch holds."""
    import pyarrow as pa

    spread = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        docs = batch.column("doc").to_numpy(zero_copy_only=False)
        keys, of = _flat(batch.column("keys"), np.int64)
        first, covers = _flat(batch.column("first"), np.int64)
        last, _ = _flat(batch.column("last"), np.int64)
        for rows, chunk in chunks(batch, "text"):
            n = len(chunk.s) - LEAST + 1
            place = np.full(batch.num_rows, -1)
            place[rows] = np.arange(len(rows))
            mine = place[of] >= 0
            with np.errstate(over="ignore"):
                known = np.unique(keys[mine].view(np.uint64) + place[of[mine]].astype(np.uint64) * spread)
            open_ = np.ones(n, dtype=bool)
            for k in range(HASHES):
                h = chunk.hashes(k)
                low = chunk.least(h)[0].astype(np.int64)
                at = np.unique(low)
                flags = np.zeros(len(h), dtype=bool)
                with np.errstate(over="ignore"):
                    flags[at] = chunk.real[at] & np.isin(h[at] + chunk.text_of(at).astype(np.uint64) * spread, known)
                open_ &= flags[low]
            held = place[covers] >= 0
            base = chunk.start[place[covers[held]]]
            step = np.zeros(n + 1, dtype=np.int32)
            a, b = np.minimum(base + first[held], n), np.minimum(base + last[held] - LEAST + 2, n)
            np.add.at(step, a[b > a], 1)
            np.add.at(step, b[b > a], -1)
            at = np.flatnonzero(open_ & (np.cumsum(step[:-1]) == 0))
            text = chunk.text_of(at)
            cols = (run_hashes(chunk.s, LEAST)[at].view(np.int64), docs[np.array(rows)[text]].astype(np.int64), (at - chunk.start[text]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["run", "doc", "a"])


def longest_stretches(size: np.ndarray, gap: np.ndarray) -> list[tuple[int, int]]:
    """(i, j): all longest stretches from run i to run j whose sizes make up for PENALTY times the gaps between them.

    With the sums before and after each run, a stretch from i reaches as far as the last run whose sum is
    not below that before i: the greatest sums from each run on fall, so a search finds it.
    """
    after = np.cumsum(size - PENALTY * np.concatenate(([0], gap)))
    before = after - size
    ahead = np.maximum.accumulate(after[::-1])
    reach = len(size) - 1 - np.searchsorted(ahead, before, "left")
    out, far = [], -1
    for i, j in enumerate(reach.tolist()):
        if j > far:
            out.append((i, j))
            far = j
    return out


def good_stretches(equal: np.ndarray, to: np.ndarray, similar: Callable[[int, int], bool], least: int) -> list[tuple[int, int]]:
    """Stretches [a, b) of at least ``least`` positions that outweigh what is unequal on either side and are ``similar``.

    The longest are asked first; one that fails is cut at its widest gap. A
    stretch all of whose runs are covered already is left out.
    """
    at = np.flatnonzero(equal)
    if not len(at):
        return []
    step = np.flatnonzero((np.diff(at) > 1) | (np.diff(to[at]) != 1)) + 1
    first, last = at[np.concatenate(([0], step))], at[np.concatenate((step - 1, [len(at) - 1]))] + 1
    apart = first[1:] - last[:-1]
    gap = apart + np.abs(apart + np.diff(to[first] - first))
    covered, out = np.zeros(len(first), dtype=bool), []
    start, stop, order, todo = first.tolist(), last.tolist(), count(), []

    def ask(x: int, y: int) -> None:
        for p, q in longest_stretches((last - first)[x:y], gap[x : y - 1]):
            if (size := stop[x + q] - start[x + p]) >= least:
                heappush(todo, (-size, -next(order), x + p, x + q))

    ask(0, len(first))
    while todo:
        *_, i, j = heappop(todo)
        a, b = start[i], stop[j]
        if covered[i : j + 1].all():
            continue
        if similar(a, b):
            covered[i : j + 1] = True
            out.append((a, b))
        elif j > i:
            cut = i + int(gap[i:j].argmax()) + 1
            ask(i, cut)
            ask(cut, j + 1)
    return sorted(out)


def alike(doc: np.ndarray, rep: np.ndarray, low: int, equal: np.ndarray, to: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first, last, first in rep, last in rep) of the good stretches whose sets of shingles have a similarity of SIMILARITY."""

    def image(a: int, b: int) -> tuple[int, int]:
        at = to[a:b][equal[a:b]]
        return int(at.min()), int(at.max()) + 1

    def similar(a: int, b: int) -> bool:
        ra, rb = image(a, b)
        mine, theirs = set(doc[a:b].tolist()), set(rep[ra - low : rb - low].tolist())
        return len(mine & theirs) >= SIMILARITY * len(mine | theirs)

    return [(a, b - 1, ra, rb - 1) for a, b in good_stretches(equal, to, similar, LEAST) for ra, rb in [image(a, b)]]


def verify(doc: np.ndarray, rep: np.ndarray, low: int, segments: tuple[np.ndarray, np.ndarray, np.ndarray]) -> list[tuple[int, int, int, int, bool, bool]]:
    """Near-duplicate stretches (first, last, first in rep, last in rep, passage, exact), in shingles.

    segments: arrays of first, last and shift in ``doc``; ``rep`` holds the other text's shingles from
    ``low`` on. All from MARGIN before the first to MARGIN after the last segment of one shift is compared. A stretch counts when
    the sets of shingles of both its sides have a Jaccard similarity of SIMILARITY; beside those, a run
    counts that is equal shingle by shingle. Equal runs within a counted stretch come with ``passage``
    False: they say what is covered.
    """
    equal, to = np.zeros(len(doc), dtype=bool), np.full(len(doc), -1, dtype=np.int64)
    exact = []
    order = np.argsort(segments[2], kind="stable")
    first, last, shifts = (x[order] for x in segments)
    cut = np.flatnonzero(np.concatenate(([True], shifts[1:] != shifts[:-1])))
    for a, b, shift in zip(np.minimum.reduceat(first, cut).tolist(), np.maximum.reduceat(last, cut).tolist(), shifts[cut].tolist()):
        a, b = max(a - MARGIN, 0, low - shift), min(b + 1 + MARGIN, len(doc), low + len(rep) - shift)
        if a >= b:
            continue
        same = doc[a:b] == rep[a + shift - low : b + shift - low]
        if np.count_nonzero(same) >= LEAST:
            exact += [(a + i, a + j - 1, shift) for i, j in zip(*(x.tolist() for x in runs(same))) if j - i >= LEAST]
        same &= ~equal[a:b]
        equal[a:b] |= same
        to[a:b][same] = np.flatnonzero(same) + (a + shift)
    out = [(*x, True, False) for x in alike(doc, rep, low, equal, to)]
    return out + [(i, j, i + shift, j + shift, not any(x <= i and j <= y for x, y, *_ in out), True) for i, j, shift in exact]


def _extract(batches):
    """Of each pair's partner text, the shingles that its segments reach."""
    import pyarrow as pa

    for batch in batches:
        made = []
        last_text, s = None, np.zeros(0, dtype=np.uint32)
        for text, low, high in zip(binary(batch, "text"), *(batch.column(c).to_pylist() for c in ("low", "high"))):
            if text != last_text:
                last_text, s = text, compared(text)
            made.append(s[low : high + 1].tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "rep", "low", "segments")), pa.array(made, type=pa.binary())], ["doc", "rep", "low", "segments", "passage"])


def _verify(batches):
    import pyarrow as pa

    names = ("doc", "rep", "first", "last", "rep_first", "rep_last", "passage", "exact")
    for batch in batches:
        out = []
        last_text, mine = None, None
        segments = batch.column("segments")
        fields = [x.to_numpy(zero_copy_only=False).astype(np.int64) for x in segments.flatten().flatten()]
        ends = np.cumsum(segments.value_lengths().to_numpy(zero_copy_only=False)).tolist()
        for doc, rep, low, a, b, passage, text in zip(*(batch.column(c).to_pylist() for c in ("doc", "rep", "low")), [0, *ends], ends, batch.column("passage").to_pylist(), binary(batch, "text")):
            if text != last_text:
                last_text, mine = text, compared(text)
            for i, j, ri, rj, *kind in verify(mine, np.frombuffer(passage, dtype=np.uint32), low, tuple(x[a:b] for x in fields)):
                out.append((doc, rep, i, j + SHINGLE - 1, ri, rj + SHINGLE - 1, *kind))
        cols = zip(*out) if out else repeat((), 8)
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64() if i < 6 else pa.bool_()) for i, c in enumerate(cols)], list(names))


#: Rows of an Arrow batch: with texts and passages of pairs in them, Spark's 10,000 are hundreds of megabytes in a task and again in its Python worker.
BATCH_ROWS = 1024


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``materialise`` in batches of BATCH_ROWS, and what was shuffled for it goes as soon as it is written, not when the driver happens to collect its garbage."""
    conf, held = df.sparkSession.conf, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}
    before = {n: conf.get(n) for n in held}
    try:
        for n, v in held.items():
            conf.set(n, v)
        return materialise(df, name)
    finally:
        for n, v in before.items():
            conf.set(n, v)


def _verified(met: DataFrame, texts: DataFrame, enough: int) -> DataFrame:
    """met: doc, rep, k, a, b, shift -> verified stretches of the pairs that collide in ``enough`` of the k."""
    pairs = (
        met.groupBy("doc", "rep")
        .agg(F.collect_set("k").alias("ks"), F.collect_set(F.struct("a", "b", "shift")).alias("segments"), F.greatest(F.lit(0), F.min(F.expr("a + shift")) - MARGIN).alias("low"), (F.max(F.expr("b + shift")) + MARGIN).alias("high"))
        .where(F.size("ks") >= enough)
        .drop("ks")
    )
    pairs = _kept(pairs, "passage-pairs")
    partner = pairs.join(texts.select(F.col("doc_id").alias("rep"), "text"), "rep").select("doc", "rep", "low", "high", "segments", "text")
    held = partner.mapInArrow(_extract, "doc long, rep long, low int, segments array<struct<a:int,b:int,shift:int>>, passage binary")
    both = held.join(texts.select(F.col("doc_id").alias("doc"), "text"), "doc").select("doc", "rep", "low", "segments", "passage", "text")
    found = both.mapInArrow(_verify, "doc long, rep long, first long, last long, rep_first long, rep_last long, passage boolean, exact boolean")
    return _kept(found, "passages")


def _distinct(key: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places of the first of each key of each text."""
    with np.errstate(over="ignore"):
        return np.unique(_mix(key) + text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), return_index=True)[1]


def _rows(batch, of: np.ndarray, names: list[str], *cols: np.ndarray):
    """A batch of 64-bit columns beside the document and the class of the row ``of`` each value."""
    import pyarrow as pa

    ids = [batch.column(x).take(pa.array(of)) for x in ("doc", "root")]
    return pa.RecordBatch.from_arrays([*ids, *(pa.array(c.view(np.int64)) for c in cols)], ["doc", "root", *names])


def _meetings(chunk: Chunk, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, key, least): each run of RUN shingles, and each shingle whose first words repeat with a period of 1 or 2: each alike pair of stretches has one in common.

    least: the place of the run's least shingle, by which it can be met only where that is shared.
    """
    least = chunk.least(h, RUN)[0].astype(np.int64)
    at = np.flatnonzero(chunk.real[least])
    alternate = chunk.words[2:] == chunk.words[:-2]
    again = np.flatnonzero(chunk.real & (alternate[:-1] & alternate[1:])[: len(chunk.s)])
    return np.concatenate((at, again)), np.concatenate((run_hashes(chunk.s, RUN)[at], h[again])), np.concatenate((least[at], again))


def _anchors(batches):
    """The least shingles of ``_meetings``, a fifth of all: texts that share a run share its least one."""
    for batch in batches:
        for rows, chunk in chunks(batch, "text"):
            h = chunk.hashes(0)
            at = np.unique(_meetings(chunk, h)[2])
            text = chunk.text_of(at)
            kept = _distinct(h[at], text)
            yield _rows(batch, np.array(rows)[text[kept]], ["key"], h[at[kept]])


def _among(batch, rows: list[int], chunk: Chunk, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which keys at the places ``at`` are among the ``keys`` of the same text."""
    keys, of = _flat(batch.column("keys"), np.int64)
    place = np.full(batch.num_rows, -1)
    place[rows] = np.arange(len(rows))
    mine = place[of] >= 0
    spread = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        return np.isin(key + chunk.text_of(at).astype(np.uint64) * spread, keys[mine].view(np.uint64) + place[of[mine]].astype(np.uint64) * spread)


def _around_anchors(batches):
    """What of ``_meetings`` holds a shared anchor."""
    for batch in batches:
        for rows, chunk in chunks(batch, "text"):
            h = chunk.hashes(0)
            at, key, least = _meetings(chunk, h)
            asked = np.unique(least)
            known = np.zeros(len(h), dtype=bool)
            known[asked] = _among(batch, rows, chunk, asked, h[asked])
            at, key = at[known[least]], key[known[least]]
            text = chunk.text_of(at)
            kept = _distinct(key, text)
            yield _rows(batch, np.array(rows)[text[kept]], ["key"], key[kept])


def _near_meetings(batches):
    """The shingles within REACH of what is shared of ``_meetings``."""
    for batch in batches:
        for rows, chunk in chunks(batch, "text"):
            at, key, _ = _meetings(chunk, chunk.hashes(0))
            at = at[_among(batch, rows, chunk, at, key)]
            text = chunk.text_of(at)
            step = np.zeros(len(chunk.s) + 1, dtype=np.int32)
            np.add.at(step, np.maximum(at - REACH, chunk.start[text]), 1)
            np.add.at(step, np.minimum(at + REACH + 1, chunk.stop[text]), -1)
            at = np.flatnonzero(chunk.real & (np.cumsum(step[:-1]) > 0))
            text = chunk.text_of(at)
            kept = _distinct(chunk.s[at], text)
            yield _rows(batch, np.array(rows)[text[kept]], ["token"], chunk.s[at[kept]])


def rarest(s: np.ndarray, tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, a, b): by what the windows of LEAST shingles meet, and the one or two shingles of each key.

    tokens, counts: what other texts have too, and how many. The order is by count and then by shingle, in all texts
    alike; the n-th of equal shingles is one of its own, the last the rarest (a and b: the shingle's upper half, and the lower
    with n). Of a window's RAREST rarest one is common, of its RAREST + MORE rarest MORE + 1. A key is a shingle of
    at most FEW texts or two of others: if all but one are of many texts, these meet, and if one alone is, the others.
    """
    none = np.zeros(0, dtype=np.uint64)
    if len(s) < LEAST or not len(tokens):
        return none, none, none
    order = np.argsort(tokens)
    tokens, counts = tokens[order], counts[order]
    own, of = np.unique(s, return_inverse=True)
    at = np.minimum(np.searchsorted(tokens, own), len(tokens) - 1)
    count = np.where(tokens[at] == own, counts[at], 1)
    order = np.lexsort((own, count))
    rank = np.empty(len(own), dtype=np.int64)
    rank[order] = np.arange(len(own))
    alone, few, rank = int(np.count_nonzero(count == 1)), int(np.count_nonzero(count <= FEW)) * LEAST, rank[of]
    upto = np.concatenate(([0], np.cumsum(rank < alone)))
    last = len(s) - LEAST
    start = np.unique(np.append(np.arange(0, last + 1, STEP), last))
    start = start[upto[start + LEAST] - upto[start] < RAREST]
    most, n, alone = RAREST + MORE, len(own) * LEAST, alone * LEAST
    i, j = np.triu_indices(most, 1)
    place, found = np.arange(LEAST), []
    for part in np.array_split(start, len(start) // 1024 + 1):
        w = np.sort(np.lib.stride_tricks.sliding_window_view(rank, LEAST)[part], axis=1)
        ends = np.concatenate((w[:, 1:] != w[:, :-1], np.ones((len(w), 1), dtype=bool)), axis=1)
        end = np.minimum.accumulate(np.where(ends, place, LEAST)[:, ::-1], axis=1)[:, ::-1]
        first = (w * LEAST + LEAST - 1 - (end - place))[:, :most]
        x = first[(first >= alone) & (first < few)]
        found.append(x * (n + 1))
        wide = first[np.count_nonzero(first >= few, axis=1) > 1]
        x, y = wide[:, i], wide[:, j]
        both = x >= few
        found.append(np.unique(x[both] * n + y[both]))
    code = np.unique(np.concatenate(found))
    low = np.uint64(2**32 - 1)
    with np.errstate(over="ignore"):
        a, b = ((t & ~low) | (_mix(t + (x % LEAST).astype(np.uint64)) & low) for x in (code // n, code % n) for t in [own[order[x // LEAST]]])
        return _mix(a * np.uint64(0x100000001B3) + b), a, b


def _rarest(batches):
    for batch in batches:
        tokens, _ = _flat(batch.column("tokens"), np.int64)
        counts, _ = _flat(batch.column("counts"), np.int64)
        ends = np.cumsum(batch.column("tokens").value_lengths().to_numpy(zero_copy_only=False))
        for rows, chunk in chunks(batch, "text"):
            found = []
            for row, a, b in zip(rows, chunk.start, chunk.stop):
                mine = slice(ends[row - 1] if row else 0, ends[row])
                found.append(rarest(chunk.s[a : b - SHINGLE + 1], tokens[mine].view(np.uint64), counts[mine]))
            yield _rows(batch, np.repeat(rows, [len(x[0]) for x in found]), ["key", "a", "b"], *map(np.concatenate, zip(*found)))


def _common(doc: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values that both hold, and the number of each shingle of either in these; what the other lacks has the last number."""
    values = np.intersect1d(doc, rep)

    def number(s: np.ndarray) -> np.ndarray:
        at = np.searchsorted(values, s)
        return np.where(np.append(values, 0)[at] == s, at, len(values)) if len(values) else np.zeros(len(s), dtype=np.int64)

    return values, *map(number, (doc, rep))


def _places(s: np.ndarray, number: np.ndarray, asked: np.ndarray, windows: np.ndarray) -> dict[int, list[int]]:
    """Per asked number, its places with one of the windows around; of those with equal surroundings the first."""
    p = np.flatnonzero(asked[number])
    p = p[np.searchsorted(windows, p - AROUND) < np.searchsorted(windows, p + AROUND + 1 - LEAST, "right")]
    out: dict[int, dict[bytes, int]] = {}
    for t, x in zip(number[p].tolist(), p.tolist()):
        out.setdefault(t, {}).setdefault(s[max(0, x - AROUND) : x + AROUND + 1].tobytes(), x)
    return {t: list(x.values()) for t, x in out.items()}


def around(doc: np.ndarray, rep: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Alike stretches around the places of common shingles; of places with equal surroundings one is compared.

    Of a shingle's places in the other text that in the longest equal run is taken. Where no window of either text has
    ALIKE shingles in common with the other nothing is looked at place by place.
    """
    values, mine, theirs = _common(doc, rep)
    if min(len(doc), len(rep)) < LEAST or len(values) < 1:
        return []
    whole, other = (np.flatnonzero(n[LEAST:] - n[:-LEAST] >= ALIKE) for n in (np.concatenate(([0], np.cumsum(x < len(values)))) for x in (mine, theirs)))
    asked = np.append(np.isin(values, tokens), False)
    if not len(whole) or not len(other) or not asked.any():
        return []
    left, right = _places(doc, mine, asked, whole), _places(rep, theirs, asked, other)
    found: list[tuple[int, int, int, int]] = []
    blocks, done = len(rep) // REACH + 1, {}
    for token, here in left.items():
        there = right.get(token, [])
        block = np.array(there, dtype=np.int64) // REACH
        for p in here:
            seen = done.setdefault(p // REACH, np.zeros(blocks, dtype=bool))
            for q in (there[n] for n in np.flatnonzero(~seen[block]).tolist()):
                if seen[q // REACH] or any(f <= p <= l and rf <= q <= rl for f, l, rf, rl in found):
                    continue
                seen[q // REACH] = True
                a, c = max(0, p - AROUND), max(0, q - AROUND)
                x, y = mine[a : p + AROUND + 1], theirs[c : q + AROUND + 1]
                in_x, in_y = (np.zeros(len(values) + 1, dtype=bool) for _ in range(2))
                in_x[x] = in_y[y] = True
                in_x[-1] = in_y[-1] = False
                if any((near[LEAST:] - near[:-LEAST]).max(initial=0) < ALIKE for near in (np.concatenate(([0], np.cumsum(z))) for z in (in_y[x], in_x[y]))):
                    continue
                order = np.argsort(y, kind="stable")
                low, high = (np.searchsorted(y[order], x, side) for side in ("left", "right"))
                n = np.where(in_y[x], high - low, 0)
                u = np.repeat(np.arange(len(x)), n)
                v = order[np.arange(len(u)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)]
                width = len(x) + len(y)  # sorted by v - u and then u, as one number, which is much faster than by two
                by = np.sort((v - u + width) * width + u)
                u = by % width
                v = by // width - width + u
                step = np.concatenate(([True], by[1:] - by[:-1] != 1))
                size = np.diff(np.append(np.flatnonzero(step), len(u)))[np.cumsum(step) - 1]
                best = np.sort((u * width + (width - size)) * len(u) + np.arange(len(u))) % len(u)  # the longest run of each u
                best = best[np.concatenate(([True], u[best][1:] != u[best][:-1]))]
                equal, to = np.zeros(len(x), dtype=bool), np.full(len(x), -1, dtype=np.int64)
                equal[u[best]] = True
                to[u[best]] = v[best]
                found += [(f + a, l + a, rf + c, rl + c) for f, l, rf, rl in alike(doc[a : a + len(x)], rep[c : c + len(y)], 0, equal, to)]
    return sorted(set(found))


def _compare(batches):
    import pyarrow as pa

    names = ("doc", "rep", "first", "last", "rep_first", "rep_last")
    for batch in batches:
        out, last_text, mine = [], None, None
        tokens, of = _flat(batch.column("tokens"), np.int64)
        ends = np.searchsorted(of, np.arange(batch.num_rows + 1))
        for n, (doc, rep, passage, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc", "rep", "passage")), binary(batch, "text"))):
            if text != last_text:
                last_text, mine = text, compared(text)
            asked = (tokens[ends[n] : ends[n + 1]].view(np.uint64) >> np.uint64(32)).astype(np.uint32)
            for i, j, ri, rj in around(mine, np.frombuffer(passage, dtype=np.uint32), asked):
                out.append((doc, rep, i, j + SHINGLE - 1, ri, rj + SHINGLE - 1))
        cols = zip(*out) if out else repeat((), 6)
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in cols], list(names))


def _shingled(batches):
    """Each pair's partner text as its shingles."""
    import pyarrow as pa

    for batch in batches:
        made, last_text, s = [], None, b""
        for text in binary(batch, "text"):
            if text != last_text:
                last_text, s = text, compared(text).tobytes()
            made.append(s)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "rep", "tokens")), pa.array(made, type=pa.binary())], ["doc", "rep", "tokens", "passage"])


def _remaining(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Near-duplicate passages of texts in different classes by what is ``found``: with these, classes are whole.

    Runs of RUN shingles that two classes share, asked for only where their least shingle is shared, tell the texts that
    are worked on; of these the shingles near such a run are counted, and texts of different classes meet by the rarest of their windows.
    """
    first = texts.groupBy(F.md5("text").alias("digest")).agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    whole = texts.join(first, "doc_id", "left_semi")  # of equal texts the least id: the others have whole texts in common with it
    roots = components(found.where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b")).distinct())
    whole = whole.join(roots, F.col("doc_id") == F.col("node"), "left").select(F.col("doc_id").cast("long").alias("doc"), F.coalesce("root", "doc_id").cast("long").alias("root"), "text")

    def shared(rows: DataFrame, key: str) -> DataFrame:
        by = Window.partitionBy(key)  # one pass: what makes the rows is run once
        several = rows.where(f"{key} is not null").select("*", F.count("doc").over(by).alias("n"), F.min("root").over(by).alias("least"), F.max("root").over(by).alias("most"))
        return several.where("least < most").select(*rows.columns, "n")

    anchors = shared(whole.mapInArrow(_anchors, "doc long, root long, key long"), "key").groupBy("doc").agg(F.collect_set("key").alias("keys"))
    held = anchors.join(whole, "doc").select("doc", "root", "keys", "text").mapInArrow(_around_anchors, "doc long, root long, key long")
    keys = _kept(shared(held, "key").groupBy("doc").agg(F.collect_set("key").alias("keys")), "passage-runs")
    few = _kept(keys.join(whole, "doc").select("doc", "root", "keys", "text"), "passage-texts")
    near = few.mapInArrow(_near_meetings, "doc long, root long, token long")
    counted = shared(near, "token").groupBy("doc").agg(F.collect_set(F.struct("token", "n")).alias("t")).select("doc", F.col("t.token").alias("tokens"), F.col("t.n").alias("counts"))
    met = counted.join(few, "doc").select("doc", "root", "tokens", "counts", "text").mapInArrow(_rarest, "doc long, root long, key long, a long, b long")
    met = _kept(shared(met, "key"), "passage-rarest")
    x, y = met.select("key", "doc", "a", "b", F.col("root").alias("xr")), met.select("key", F.col("doc").alias("rep"), F.col("root").alias("yr"))
    pairs = x.join(y, "key").where("doc > rep and xr <> yr").groupBy("doc", "rep")
    pairs = _kept(pairs.agg(F.array_union(F.collect_set("a"), F.collect_set("b")).alias("tokens")).where(f"size(tokens) >= {MORE}"), "passage-rest")
    partner = pairs.join(few.select(F.col("doc").alias("rep"), "text"), "rep").select("doc", "rep", "tokens", "text")
    held = partner.mapInArrow(_shingled, "doc long, rep long, tokens array<long>, passage binary")
    both = held.join(few.select("doc", "text"), "doc").select("doc", "rep", "tokens", "passage", "text")
    return _kept(both.mapInArrow(_compare, "doc long, rep long, first long, last long, rep_first long, rep_last long"), "passages")


def repeats(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Verified near-duplicate passages of LEAST_WORDS words or more: doc, rep, first, last, rep_first, rep_last.

    Positions are words, inclusive; rep is a document with a smaller id, or the document itself for an
    equal run that it repeats further on. A window is compared with the one of the least id in its
    signature and with its neighbours by reach to the left and to the right, which equal passages have
    alike; what these leave of runs of LEAST_WORDS equal words is compared with the run's first holder. So
    a passage in m documents makes a few times m pairs. One shuffle deals the windows by signature. What is alike
    and not linked by then is met by its rarest shingles (``_remaining``).
    """
    texts = docs.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    windows = texts.mapInArrow(_windows, "key long, doc long, k byte, c int, l int, r int")
    alone = Window.partitionBy("key")
    windows = windows.where("key is not null and doc is not null").select("*", F.min(F.struct("doc", "k", "c", "l", "r")).over(alone).alias("m"), F.count(F.lit(1)).over(alone).alias("n")).where("n > 1")
    windows = windows.withColumn("m", F.expr("named_struct('doc', m.doc, 'c', m.c, 'l', m.l, 'r', m.r)"))
    mine = F.struct("doc", "c", "l", "r")
    before = lambda *by: F.lag(mine).over(Window.partitionBy("key").orderBy(*map(F.expr, by), "doc", "c", "l", "r"))
    shared = windows.select("key", "k", mine.alias("x"), "m", before("c - l", "r - c").alias("p"), before("r - c", "c - l").alias("q"))
    shared = _kept(shared, "passage-windows")
    other = shared.select("k", "x", F.explode(F.array_distinct(F.array("m", "p", "q"))).alias("y")).where("y is not null and x.doc <> y.doc")
    met = other.select("k", F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).select("k", F.expr("x.doc").alias("doc"), F.expr("y.doc").alias("rep"), *[F.expr(f"{o}.{c}").alias(o + c) for o in "xy" for c in "clr"])
    left, right = F.least(F.expr("xc - xl"), F.expr("yc - yl")), F.least(F.expr("xr - xc"), F.expr("yr - yc"))
    met = met.select("doc", "rep", "k", (F.col("xc") - left).alias("a"), (F.col("xc") + right).alias("b"), F.expr("yc - xc").alias("shift"))
    near = _verified(met, texts, ENOUGH)
    # A run within a verified equal stretch is linked to a smaller id that holds it, and so on to its
    # first holder; only the others are keyed, and of these only what has a signature in common.
    covers = near.where("exact").groupBy("doc").agg(F.collect_list("first").alias("first"), F.collect_list(F.col("last") - (SHINGLE - 1)).alias("last"))
    reach = F.greatest("l", F.col("c") - (LEAST - 1)), F.least("r", F.col("c") + (LEAST - 1))
    within = F.exists(F.arrays_zip("first", "last"), lambda x: (x["first"] <= reach[0]) & (x["last"] >= reach[1]))
    open_ = shared.select("key", "x.*").join(covers, "doc", "left").where(~F.coalesce(within, F.lit(False))).select("key", "doc")
    open_ = _kept(open_, "passage-open")
    several = open_.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    keys = open_.join(several, "key").groupBy("doc").agg(F.collect_set("key").alias("keys"))
    held = keys.join(covers, "doc", "left").join(texts, F.col("doc") == F.col("doc_id")).select("doc", "keys", "first", "last", "text")
    held = held.mapInArrow(_equal_runs, "run long, doc long, a int").where("run is not null and doc is not null")
    alone = Window.partitionBy("run")
    held = held.select("*", F.min(F.struct("doc", "a")).over(alone).alias("m"), F.count(F.lit(1)).over(alone).alias("n")).where("n > 1").select("doc", "a", F.col("m.doc").alias("rep"), F.col("m.a").alias("ra"))
    exact = held.where(f"doc > rep or a >= ra + {LEAST_WORDS}").groupBy("doc", "rep", F.expr("ra - a").alias("shift")).agg(F.min("a").alias("a"), (F.max("a") + LEAST - 1).alias("b"))
    further = _verified(exact.select("doc", "rep", F.lit(-1).cast("byte").alias("k"), "a", "b", "shift"), texts, 1)
    found = near.unionByName(further).where("passage").drop("passage", "exact").distinct()
    return found.unionByName(_remaining(found, texts)).distinct()


def classes(docs: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_spans, dup_words, spans.

    class_id: the least id reachable over shared passages (its own without any); n_links: verified
    links of the document with others, either way; spans: ``first-last:rep`` (words) of what repeats a
    document with a smaller id or an earlier place of its own, dup_words the words they cover. Null text
    has no passages; a null id has none either and its class is null; repeated rows of one id are one
    document; of equal texts the least id holds the passages first; a very long text is worked on whole;
    an empty table gives an empty result; texts under LEAST_WORDS words have none; further columns are ignored.
    """
    found = _kept(repeats(docs, text=text, key=key), "passages")
    links = found.where("doc <> rep").select(F.col("doc").alias("a"), F.col("rep").alias("b")).distinct()
    roots = components(links)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    spans = F.array_sort(F.collect_set(F.struct("first", "last", "rep")))
    start = F.struct(F.lit(-1).cast("long").alias("upto"), F.lit(0).cast("long").alias("sum"))
    covered = F.aggregate(
        "s", start,
        lambda acc, x: F.struct(F.greatest(acc["upto"], x["last"]).alias("upto"), (acc["sum"] + F.greatest(F.lit(0), x["last"] - F.greatest(acc["upto"], x["first"] - 1))).alias("sum")),
        lambda acc: acc["sum"],
    )
    own = found.groupBy(F.col("doc").alias("node")).agg(spans.alias("s")).select("node", F.size("s").cast("long").alias("m"), covered.alias("w"), F.array_join(F.transform("s", lambda x: F.concat(x["first"], F.lit("-"), x["last"], F.lit(":"), x["rep"])), ",").alias("told"))
    # The least document of a class has links but no row in roots, one that only repeats itself has spans but no links.
    facts = degree.join(own, "node", "full").join(roots, "node", "left")
    ids = docs.select(F.col(key).alias("doc_id")).distinct()
    return ids.join(facts, ids["doc_id"] == facts["node"], "left").select(
        "doc_id", F.coalesce("root", "doc_id").alias("class_id"), *[F.coalesce(F.col(a), F.lit(0)).cast("long").alias(b) for a, b in (("n", "n_links"), ("m", "n_spans"), ("w", "dup_words"))], F.coalesce("told", F.lit("")).alias("spans")
    )
