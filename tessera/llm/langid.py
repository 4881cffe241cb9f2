"""Language ID by Bayesian evidence fusion.

log P(language | all) = text likelihood + log P(declared | language) + log P(suffix | language)
+ log P(language | host), up to a constant. The text likelihood comes from byte trigrams; the tables
for declared language and address suffix are counted against the text's own verdict; the host prior is
smoothed towards its parent's and that towards the whole corpus's, all by grouped aggregation. A
document's own verdict is taken out of the counts before they judge it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import alnum_words, binary, materialise

#: Bound of the labelled sample that the trigram tables are fitted on: rows a declared language, and in
#: all (beyond it languages share it evenly, a few rows each at least). Languages are two- or three-letter codes.
LANGUAGE_ROWS = 500
SAMPLE_ROWS = 20_000
FEWEST_ROWS = 5
CODE = "^[a-z]{2,3}$"
SLOTS = 1 << 15
#: Share of every language's table that is the mean of all languages, so none gains from unseen trigrams.
BACKGROUND = 0.1
#: Trigrams beyond which more text adds no certainty (neighbouring trigrams are not independent).
SATURATION = 64.0
#: Pseudo-counts by which a host leans on its parent, and a parent on the corpus.
KAPPA = 20.0
LEAST_CONFIDENCE = 0.5
#: Nats per trigram by which the median word must lie below the sample's to be of no language: a limit
#: for long texts, and what is added over the square root of the number of words.
MISFIT, MISFIT_SPREAD = 3.5, 2.0
BROADCAST_HOSTS = 100_000
#: Digits are one symbol.
_DIGITS = bytes(48 if 48 <= b <= 57 else b for b in range(256))


def trigrams(words: list[bytes]) -> np.ndarray:
    """Slots of the byte trigrams of blank-framed words; a word of n bytes owns n of them and the next one straddles."""
    if not words:
        return np.zeros(0, dtype=np.int64)
    b = np.frombuffer((b" " + b" ".join(words) + b" ").translate(_DIGITS), dtype=np.uint8).astype(np.int64)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    return ((code * 0x9E3779B1) >> 15) & (SLOTS - 1)


class TrigramModel:
    def __init__(self, languages: Sequence[str], table: np.ndarray, centre: float = 0.0):
        self.languages, self.table, self.centre = list(languages), table, centre

    @classmethod
    def fit(cls, rows: Sequence[tuple[bytes | None, str]]) -> TrigramModel:
        """rows: (text, language)."""
        counts: dict[str, np.ndarray] = {}
        for text, lang in rows:
            counts.setdefault(lang, np.zeros(SLOTS))
            counts[lang] += np.bincount(trigrams(alnum_words(text)), minlength=SLOTS)
        languages = sorted(counts) or ["und"]
        own = np.stack([counts.get(x, np.zeros(SLOTS)) for x in languages], axis=1)
        share = own / np.maximum(own.sum(axis=0), 1)
        mean = share.mean(axis=1) + 1e-7
        table = np.log((1 - BACKGROUND) * share + BACKGROUND * (mean / mean.sum())[:, None]).astype(np.float32)
        model = cls(languages, table)
        fits = [fit for fit, n in ((x[2], x[1]) for x in (model.evidence(t) for t, _ in rows)) if n > 0]
        model.centre = float(np.median(fits)) if fits else 0.0
        return model

    def evidence(self, text: bytes | None) -> tuple[int, int, float, np.ndarray]:
        """(trigrams, words, median word's mean log-likelihood in the best language less the sample's, means of all trigrams by language)."""
        words = alnum_words(text)
        c = trigrams(words)
        if not len(c):
            return 0, 0, 0.0, np.zeros(len(self.languages))
        table = self.table[c]
        means = table.mean(axis=0, dtype=np.float64)
        upto = np.concatenate(([0.0], np.cumsum(table[:, int(means.argmax())], dtype=np.float64)))
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        start = np.cumsum(size + 1) - size - 1
        return len(c), len(words), float(np.median((upto[start + size] - upto[start]) / size)) - self.centre, means


def _code(col: Column) -> Column:
    """Stated language without its region, lower-cased; blank is none."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(col)), "[-_].*$", ""), F.lit(""))


def fit(docs: DataFrame, *, text: str = "text", declared: str = "lang", key: str = "doc_id", rows: int = LANGUAGE_ROWS, most: int = SAMPLE_ROWS) -> TrigramModel:
    """Fit on at most ``rows`` documents of each declared language, drawn by the hash of their id; of a repeated id the least text."""
    stated = docs.where(F.col(key).isNotNull()).select(F.col(key).alias("__id"), _code(F.col(declared)).alias("__code")).where(F.col("__code").rlike(CODE))
    counts = stated.groupBy("__code").agg(F.count(F.lit(1)).alias("__rows"))
    each = min(rows, max(FEWEST_ROWS, most // max(1, counts.count())))
    # A hash threshold of a language thins it to about twice the rows it may give, so none fills a task.
    share = F.pmod(F.xxhash64("__id"), F.lit(1 << 30)).cast("double") * F.col("__rows") < F.lit(2 * each + 20).cast("double") * (1 << 30)
    order = Window.partitionBy("__code").orderBy(F.xxhash64("__id"), "__id")
    thinned = stated.join(F.broadcast(counts), "__code").where(share)
    drawn = thinned.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= each).select("__id", "__code").distinct()
    found = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text")).join(F.broadcast(drawn), "__id").groupBy("__id", "__code").agg(F.min("__text").alias("__text"))
    got = sorted(((r[1], r[0], r[2] or "") for r in found.toLocalIterator()), key=lambda r: r[:2])
    return TrigramModel.fit([(t.encode(), lang) for lang, _, t in got])


def _evidence(shared, text_col: str, carried: list[str]):
    def run(batches):
        import pyarrow as pa

        model: TrigramModel = shared.value
        for batch in batches:
            n, words, fit, ll = zip(*map(model.evidence, binary(batch, text_col))) if batch.num_rows else ((),) * 4
            made = [pa.array(n, type=pa.int64()), pa.array(words, type=pa.int64()), pa.array(fit, type=pa.float64()), pa.array([x.tolist() for x in ll], type=pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in carried), *made], [*carried, "__n", "__words", "__fit", "__ll"])

    return run


def evidence(docs: DataFrame, model: TrigramModel, text: str, carry: list[str]) -> DataFrame:
    """Columns ``carry`` with __n, __words, __fit and __ll; no shuffle."""
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    shape = ", ".join([*(f"`{c}` {kinds[c]}" for c in carry), "`__n` bigint", "`__words` bigint", "`__fit` double", "`__ll` array<double>"])
    return docs.mapInArrow(_evidence(docs.sparkSession.sparkContext.broadcast(model), text, carry), shape)


def _best(values: Column) -> Column:
    """Position (from 0) of the largest value, the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def _index(col: Column, languages: Sequence[str]) -> Column:
    """Position of a stated language; len(languages) for any other, null for none."""
    c = _code(col)
    found = F.array_position(F.lit(list(languages)), c)
    return F.when(c.isNull(), F.lit(None)).when(found > 0, found - 1).otherwise(F.lit(len(languages))).cast("int")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


class Fusion:
    """Counted tables of a corpus, ready to be joined to its rows."""

    def __init__(self, model: TrigramModel, scored: DataFrame):
        """scored: __n, __ll, __declared, __suffix (columns or null), __host (string)."""
        k = len(model.languages)
        self.model, self.k = model, k
        votes = materialise(
            scored.where("__n > 0").select(F.col("__host").alias("host"), _index(F.col("__declared"), model.languages).alias("d"), _index(F.col("__suffix"), model.languages).alias("s"), _best(F.col("__ll")).alias("v")),
            "language-votes",
        )
        self.declared, self.suffix = (self._table(votes, c) for c in "ds")
        total = {r["v"]: r["count"] for r in votes.groupBy("v").count().collect()}
        n = sum(total.values())
        self.whole = F.lit([(total.get(i, 0) + 1.0) / (n + k) for i in range(k)])
        dense = lambda held: F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.coalesce(F.try_element_at(held, i), F.lit(0.0)))
        spread = lambda df, by: df.groupBy(by).agg(dense(F.map_from_entries(F.collect_list(F.struct("v", "n")))).alias("n"))
        counted = votes.where("host is not null").groupBy("host", "v").agg(F.count(F.lit(1)).cast("double").alias("n"))
        hosts = spread(counted, "host").withColumn("parent", self.parent(F.col("host")))
        parents = spread(counted.groupBy(self.parent(F.col("host")).alias("parent"), "v").agg(F.sum("n").alias("n")), "parent").withColumnRenamed("n", "m")
        self.hosts = materialise(hosts.join(parents, "parent").select(F.col("host").alias("__prior_host"), F.col("n").alias("__of_host"), F.col("m").alias("__of_parent")), "language-priors")
        self.hosts = F.broadcast(self.hosts) if self.hosts.count() <= BROADCAST_HOSTS else self.hosts

    @staticmethod
    def parent(host: Column) -> Column:
        """The last two labels of a host name; of a plain name, the name without its number."""
        return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -2)).otherwise(F.regexp_replace(host, "[0-9]+$", ""))

    def _table(self, votes: DataFrame, col: str) -> tuple[Column, Column]:
        """Counts by stated value and language, and by language; at most (k + 1) * k."""
        k = self.k
        got = {(r[col], r["v"]): r["count"] for r in votes.where(F.col(col).isNotNull()).groupBy(col, "v").count().collect()}
        rows = [[float(got.get((d, v), 0)) for v in range(k)] for d in range(k + 1)]
        return F.array(*[F.lit(r) for r in rows]), F.lit([sum(r[v] for r in rows) for v in range(k)])

    def judge(self, scored: DataFrame) -> DataFrame:
        """scored with __lang, __confidence, __accepted in place of the evidence."""
        k, own = self.k, F.col("__own")
        less = lambda values: F.transform(values, lambda x, i: x - F.when(i == own, 1.0).otherwise(0.0))
        lean = lambda n, prior: F.transform(F.zip_with(n, prior, lambda x, p: F.struct(x.alias("x"), p.alias("p"))), lambda z: (z["x"] + KAPPA * z["p"]) / (_total(n) + KAPPA))

        def stated(table: tuple[Column, Column], c: str) -> Column:
            at = _index(F.col(c), self.model.languages)
            known = F.zip_with(less(F.get(table[0], at)), less(table[1]), lambda x, n: F.log((x + 0.5) / (n + 0.5 * (k + 1))))
            return F.when(at.isNull(), F.lit([0.0] * k)).otherwise(known)

        joined = scored.join(self.hosts, scored["__host"] == self.hosts["__prior_host"], "left").withColumn("__own", F.when(F.col("__n") > 0, _best(F.col("__ll"))).otherwise(-1))
        joined = joined.withColumn("__up", lean(less(F.col("__of_parent")), self.whole))
        prior = F.transform(F.coalesce(lean(less(F.col("__of_host")), F.col("__up")), self.whole), lambda p: F.log(p))
        add = lambda *x: x[0] if len(x) == 1 else F.zip_with(x[0], add(*x[1:]), lambda a, b: a + b)
        text = F.transform("__ll", lambda x: x * F.col("__n") * SATURATION / (F.col("__n") + SATURATION))
        joined = joined.withColumn("__post", add(text, stated(self.declared, "__declared"), stated(self.suffix, "__suffix"), prior))
        top = F.array_max("__post")
        mass = _total(F.transform("__post", lambda x: F.exp(x - top)))
        odd = (F.col("__n") > 0) & (F.col("__fit") < -MISFIT - MISFIT_SPREAD / F.sqrt(F.greatest(F.col("__words"), F.lit(1))))
        # A text of none of the languages may still be of a stated one that the sample has no rows of.
        other = odd & (_index(F.col("__declared"), self.model.languages) == k) & _code(F.col("__declared")).rlike(CODE)
        judged = joined.withColumn("__confidence", F.round(1 / mass, 9)).withColumn("__other", F.coalesce(other, F.lit(False))).withColumn("__odd", odd)
        accepted = F.col("__other") | ((F.col("__n") > 0) & (F.col("__confidence") >= LEAST_CONFIDENCE) & ~F.col("__odd"))
        named = F.when(F.col("__other"), _code(F.col("__declared"))).when((F.col("__n") == 0) | F.col("__odd"), "und").otherwise(F.get(F.lit(self.model.languages), _best(F.col("__post"))))
        judged = judged.withColumn("__lang", named).withColumn("__accepted", accepted)
        return judged.drop("__prior_host", "__of_host", "__of_parent", "__own", "__up", "__post", "__fit", "__words", "__other", "__odd")


def _with_evidence(docs: DataFrame, declared: str | None, host: str | None, suffix: str | None) -> DataFrame:
    none = F.lit(None).cast("string")
    named = lambda c: none if c is None else F.col(c).cast("string")
    return docs.withColumn("__declared", named(declared)).withColumn("__suffix", named(suffix)).withColumn("__host", F.lower(named(host)))


def identify(docs: DataFrame, *, text: str = "text", key: str = "doc_id", declared: str = "lang", host: str | None = "source", suffix: str | None = None, model: TrigramModel | None = None) -> DataFrame:
    """One row per document: key, language ('und' if none fits), confidence, declared_language, n_trigrams, accepted.

    A text without letters or digits, of no language of the sample (unless its declaration names one that
    the sample lacks), or with a best posterior under LEAST_CONFIDENCE is not accepted. Null text has no
    letters; missing declarations, suffixes and hosts give no evidence (the corpus prior stands in for the
    host's); equal posteriors take the first language by code; a very long text is read whole, its
    evidence saturates; repeated rows repeat; an empty table gives an empty result; further columns are
    ignored. A host's rows are pre-aggregated before the shuffle, and priors are broadcast only up to
    BROADCAST_HOSTS hosts (beyond it joined by shuffle, which adaptive execution splits at hot hosts).
    """
    model = model or fit(docs, text=text, declared=declared, key=key)
    rows = _with_evidence(docs.select(*dict.fromkeys(c for c in (key, text, declared, host, suffix) if c)), declared, host, suffix)
    scored = materialise(evidence(rows, model, text, [key, "__declared", "__suffix", "__host"]), "language-scores")
    judged = Fusion(model, scored).judge(scored)
    return judged.select(key, F.col("__lang").alias("language"), F.col("__confidence").alias("confidence"), F.col("__declared").alias("declared_language"), F.col("__n").alias("n_trigrams"), F.col("__accepted").alias("accepted"))


def keep_accepted(docs: DataFrame, *, text: str = "text", key: str = "doc_id", declared: str = "lang", host: str | None = "source", suffix: str | None = None) -> DataFrame:
    """``docs`` without those that ``identify`` does not accept; the rest unchanged.

    The rows are scored once and written with their scores; the counts read only the narrow columns.
    Null text and texts without letters go; repeated rows are judged alike; columns of any name but
    those that begin with two underscores pass; an empty table gives an empty result.
    """
    model = fit(docs, text=text, declared=declared, key=key)
    rows = _with_evidence(docs, declared, host, suffix)
    scored = materialise(evidence(rows, model, text, rows.columns), "language-scored-rows")
    judged = Fusion(model, scored).judge(scored)
    return judged.where("__accepted").select(*[F.col(f"`{c}`") for c in docs.columns])


def pages(spark, sf_dir: str) -> DataFrame:
    """Web pages with their evidence: text without markup, declared language, host, address suffix."""
    raw = spark.read.parquet(f"{sf_dir}/pages.parquet")
    body = F.regexp_replace(F.regexp_replace("html", "(?is)<(script|style)[^>]*>.*?</\\1>", " "), "(?s)<[^>]*>", " ")
    tail = F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([a-z]{2})(?:[/?#]|$)", 1)
    country = F.regexp_extract("url", r"^[a-z]+://[^/?#]+\.([a-z]{2})(?:[:/?#]|$)", 1)
    return raw.select("page_id", body.alias("text"), F.nullif(F.regexp_extract("html", r"(?is)<html[^>]*\blang=[\"']?([a-z-]+)", 1), F.lit("")).alias("declared"), F.regexp_extract("url", r"^[a-z]+://([^/?#:]+)", 1).alias("host"), F.nullif(F.when(tail != "", tail).otherwise(country), F.lit("")).alias("suffix"))
