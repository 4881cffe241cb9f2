"""Texts of different classes are worked on where they share a run of shingles; nothing of the shuffles stays."""

import os
import random
from pathlib import Path

import numpy as np

from tessera.llm import passages
from tests.llm.test_edited_passages_whole import edited
from tests.llm.test_operators import prose


def test_texts_without_a_shared_run_are_left_out(spark, monkeypatch):
    """A sentence of 12 words has 8 shingles: they are shared anchors, but no run of RUN."""
    rng, kept, materialise = random.Random(91), {}, passages.materialise
    sentence = prose(rng, 12)
    rows = [(i, f"{prose(rng, 70)} {sentence} {prose(rng, 70)}") for i in range(20)]
    passage = prose(rng, 97).split()
    rows += [(20 + i, " ".join([prose(rng, 70), *p, prose(rng, 70), sentence])) for i, p in enumerate((passage, edited(rng, passage, 2)))]

    def told(df, name):
        kept[name] = materialise(df, name)
        return kept[name]

    monkeypatch.setattr(passages, "materialise", told)
    found = spark.createDataFrame([], "doc long, rep long, first long, last long, rep_first long, rep_last long")
    got = passages._remaining(found, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc, r.rep) for r in got} == {(21, 20)}
    assert {r.doc for r in kept["passage-texts"].collect()} == {20, 21}


def test_shuffled_files_go_once_written(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    files = lambda: set(Path(os.environ.get("SPARK_LOCAL_DIRS", "/tmp")).glob("blockmgr-*/*/shuffle_*.data"))
    before, conf = files(), spark.conf.get(name)
    df = passages._kept(spark.range(10_000).repartition(4, "id"), "any")
    assert files() <= before
    assert df.count() == 10_000 and spark.conf.get(name) == conf


def test_texts_of_one_line():
    """Of many places of a shingle those with equal surroundings are one; the whole of both texts is told."""
    line = [np.uint32(x) for x in range(1, 25)]
    doc, rep = (np.array(line * n, dtype=np.uint32) for n in (400, 6))
    got = passages.around(doc, rep, np.array(line, dtype=np.uint32))
    assert got and all(set(doc[a : b + 1].tolist()) == set(rep[c : d + 1].tolist()) for a, b, c, d in got)


def test_steps_run_once_in_small_batches(spark, monkeypatch):
    """What makes the rows of a shared key stands once in its step's plan, and texts come in batches of BATCH_ROWS."""
    plans, sizes, materialise = {}, set(), passages.materialise

    def told(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        sizes.add(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        return materialise(df, name)

    monkeypatch.setattr(passages, "materialise", told)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rng = random.Random(7)
    passage = prose(rng, 97).split()
    rows = [(i, " ".join([prose(rng, 30), *p, prose(rng, 30)])) for i, p in enumerate((passage, passage, edited(rng, passage, 2)))]
    passages.classes(spark.createDataFrame(rows, "doc_id long, text string"))
    assert plans["passage-windows"].count("_windows(") == 1
    assert plans["passage-runs"].count("_anchors(") == 2  # _anchors and _around_anchors
    assert plans["passage-rarest"].count("_near_meetings(") == 1 and plans["passage-rarest"].count("_rarest(") == 1
    assert sizes == {str(passages.BATCH_ROWS)} and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
