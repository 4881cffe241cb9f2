"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as
the next stage's docs; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import decontaminate, langid, mixing, shard_pack, simhash_bk
from tessera.llm.common import materialise, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of an identified language; the rest go.

    Null, empty and letterless texts are of none; repeated rows are judged alike; a very long text is
    read whole; an empty table stays empty; columns of any name without two leading underscores pass.
    """
    return langid.keep_accepted(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the least id, once.

    Null and empty texts share fingerprint zero and are one group; rows without an id stay; repeated rows
    become one; very long texts are hashed whole; an empty table stays empty; other columns pass.
    """
    return simhash_bk.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the coverage limit, unchanged.

    Null and wordless texts stay; repeated rows are judged one by one; very long texts are streamed whole;
    without benchmark items all stay; an empty table stays empty; columns but ``__hits`` pass.
    """
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: 0, 1 or 2 times.

    Null texts have size 0 and cost nothing; the null source is a source; rows that share an id share the
    decision; a very long text is taken or left whole; an empty table stays empty; columns of any name
    without two leading underscores pass.
    """
    return mixing.sample(docs)


def deal_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot, which replace columns of these names.

    Null texts count as empty; repeated rows get slots of their own; equal texts share a shard up to a
    shard's even share; a very long text is one row; an empty table stays empty; other columns pass.
    """
    return shard_pack.attach(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix_sources", mix_sources),
    ("shard", deal_shards),
]

#: XXH64 fingerprints, trained tables and greedy packing have no SQL form: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
