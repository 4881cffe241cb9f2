"""Lines of long documents folded in pieces: running counts, and finite-state machines by composition.

A line is a function from states to states; functions compose associatively, so each piece of a document
is folded where its lines are, only the pieces' functions are composed in order, and each piece is run again
from the state that it starts in. No window, task or row holds a document.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

#: Lines (steps of the order) of a piece.
PIECE = 4096


def _pieces(lines: DataFrame, order: str, piece: int) -> DataFrame:
    return lines.withColumn("__p", F.floor(F.col(order) / piece).cast("long"))


def _joined(lines: DataFrame, doc: str, facts: DataFrame) -> DataFrame:
    """lines with what ``facts`` (__doc, __piece and more) say of their pieces."""
    return lines.join(facts, lines[doc].eqNullSafe(facts["__doc"]) & lines["__p"].eqNullSafe(facts["__piece"])).drop("__doc", "__piece")


def running_count(lines: DataFrame, doc: str, order: str, flag: Column, name: str, piece: int = PIECE) -> DataFrame:
    """lines with ``name``: how many lines up to each, itself included, have the flag (null is none)."""
    rows = _pieces(lines, order, piece).withColumn("__f", F.when(flag, 1).otherwise(0))
    sums = rows.groupBy(F.col(doc).alias("__doc"), F.col("__p").alias("__piece")).agg(F.sum("__f").alias("n"))
    upto = Window.partitionBy("__doc").orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("__doc", "__piece", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("__n"))
    own = F.sum("__f").over(Window.partitionBy(doc, "__p").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return _joined(rows, doc, before).withColumn(name, F.col("__n") + own).drop("__p", "__f", "__n")


def _runs(keys: Sequence[list], n: int, last: tuple | None) -> Iterator[tuple[int, int, tuple, bool]]:
    """(from, to, key, whether it goes on from ``last``) of each run of rows with equal keys."""
    at = 0
    while at < n:
        key = tuple(k[at] for k in keys)
        end = at + 1
        while end < n and all(k[end] == v for k, v in zip(keys, key)):
            end += 1
        yield at, end, key, key == last
        last, at = key, end


def states(lines: DataFrame, doc: str, order: str, symbol: Column, table: Sequence[Sequence[int]], *, start: int = 0, piece: int = PIECE) -> DataFrame:
    """lines with ``before`` and ``after``: the state of a machine around each, in order within its document.

    table[state][symbol] is the next state. Null documents are one, lines of equal order go in any order;
    names __p and __y are taken.
    """
    table = [list(map(int, row)) for row in table]
    rows = _pieces(lines, order, piece).withColumn("__y", symbol.cast("int"))
    named = lines.schema[doc].dataType
    kind = named.simpleString()

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(doc, "__p").sortWithinPartitions(doc, "__p", order)

    def compose(batches):
        import pyarrow as pa

        last, made, out = None, [], []
        for batch in batches:
            docs, ps, ys = (batch.column(c).to_pylist() for c in range(3))
            for a, b, key, more in _runs((docs, ps), len(ys), last):
                if not more:
                    if last is not None:
                        out.append((*last, made))
                    made = list(range(len(table)))
                for y in ys[a:b]:
                    made = [table[s][y] for s in made]
                last = key
        if last is not None:
            out.append((*last, made))
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], type=to_arrow_type(named)), pa.array(cols[1], type=pa.int64()), pa.array(cols[2], type=pa.list_(pa.int32()))], ["__doc", "__piece", "f"])

    def begin(batches):
        import pyarrow as pa

        last, state = None, start
        for batch in batches:
            docs, ps, fs = (batch.column(c).to_pylist() for c in range(3))
            out = []
            for d, f in zip(docs, fs):
                state = state if last == (d,) else start
                out.append(state)
                last, state = (d,), f[state]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, type=pa.int32())], ["__doc", "__piece", "__s"])

    names = lines.columns

    def run(batches):
        import pyarrow as pa

        last, state = None, start
        for batch in batches:
            docs, ps, ys, first = (batch.column(c).to_pylist() for c in (doc, "__p", "__y", "__s"))
            before, after = [], []
            for a, b, key, more in _runs((docs, ps), len(ys), last):
                state = state if more else first[a]
                for y in ys[a:b]:
                    before.append(state)
                    state = table[state][y]
                    after.append(state)
                last = key
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(before, type=pa.int32()), pa.array(after, type=pa.int32())], [*names, "before", "after"])

    folded = dealt(rows.select(doc, "__p", "__y", order)).mapInArrow(compose, f"__doc {kind}, __piece long, f array<int>")
    begun = folded.repartition("__doc").sortWithinPartitions("__doc", "__piece").mapInArrow(begin, f"__doc {kind}, __piece long, __s int")
    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in lines.schema.fields), "before int, after int"])
    return dealt(_joined(rows, doc, begun)).mapInArrow(run, shape)
