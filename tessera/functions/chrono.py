"""Chronology expressions over signed integer years."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

_PHASE = "array<struct<period:string,sub:string,start:int,end:int>>"


#: Word stems among the fixed patterns, which in French go on.
_STEMS = ("protohistor", "néolith", "paléolith", "mésol", "chalcolith")


def _pattern(p: str, compat: bool) -> str:
    """A fixed pattern, case-blind in Unicode; unless ``compat``, its stems match with any ending."""
    for stem in () if compat else _STEMS:
        p = p.replace(stem, stem + r"\w*")
    return "(?iu)" + p


def iron_age(period: Column, *, flags: Column, mentions: Column, start: Column, end: Column, method: Column, compat: bool = False) -> Column:
    """Ordered decision: text, flags, mentions, date range, older-only text, trusted source; else false.

    ``compat`` lets word stems match only as whole words.
    """
    iron, older = _pattern(vocab.IRON_PATTERN, compat), _pattern(vocab.OLDER_PATTERN, compat)
    low, high = vocab.IRON_AGE
    return (
        F.when(F.coalesce(period.rlike(iron), F.lit(False)), True)
        .when(F.coalesce(F.size(flags) > 0, F.lit(False)), True)
        .when(F.coalesce(F.exists(mentions, lambda m: m.rlike(iron)), F.lit(False)), True)
        .when(start.isNotNull() & end.isNotNull(), (end > low) & (start <= high))
        .when(F.coalesce(period.rlike(older), F.lit(False)), False)
        .otherwise(F.coalesce(method.isin(*vocab.TRUSTED), F.lit(False)))
    )


def department(*texts: Column, identifier: Column | None = None) -> Column:
    """Number in the first two characters of the first stated department, else of the identifier."""
    cut = lambda c: F.substring(F.trim(c), 1, 2).try_cast("int")
    found = cut(F.coalesce(*[F.nullif(t, F.lit("")) for t in texts]))
    return found if identifier is None else F.coalesce(found, F.when(F.length(identifier) >= 2, F.substring(identifier, 1, 2).try_cast("int")))


def period(text: Column) -> Column:
    """struct(period, sub): the first period with a pattern in the text, else by prefix, else unknown without sub."""
    low = F.lower(text)
    sub = F.nullif(F.regexp_extract(text, vocab.SUB_PERIOD_PATTERN, 0), F.lit(""))
    name = F.lit(None).cast("string")
    for label in reversed(vocab.PERIOD_PATTERNS):
        hit = F.lit(False)
        for p in sorted({x.lower() for x in vocab.PERIOD_PATTERNS[label]}):
            hit = hit | F.contains(low, F.lit(p))
        name = F.when(hit, label).otherwise(name)
    name = F.coalesce(name, F.when(sub.startswith("Ha"), "Hallstatt").when(sub.startswith("LT"), "La Tène"))
    return F.struct(F.coalesce(name, F.lit(vocab.UNKNOWN)).alias("period"), F.when(name.isNotNull(), sub).alias("sub"))


def _phase(period: Column | str | None, sub: Column | None, start: Column | int | None, end: Column | int | None) -> Column:
    lit = lambda x, t: x.cast(t) if isinstance(x, Column) else F.lit(x).cast(t)
    return F.struct(lit(period, "string").alias("period"), lit(sub, "string").alias("sub"), lit(start, "int").alias("start"), lit(end, "int").alias("end"))


def _subs() -> Column:
    return F.array(*[_phase(_of(s), F.lit(s), a, b) for s, a, b in vocab.SUB_PERIODS])


def _of(sub: str) -> str:
    return "Hallstatt" if sub.startswith("Ha") else "La Tène"


def within(start: Column, end: Column) -> Column:
    """Phase of a date range: the tightest sub-period around it, else the first period around or touching it."""
    inside = F.filter(_subs(), lambda p: (p["start"] <= start) & (end <= p["end"]))
    best = F.array_min(F.transform(inside, lambda p, i: F.struct((p["end"] - p["start"]).alias("w"), i.alias("i"), p["period"].alias("period"), p["sub"].alias("sub"))))
    name = F.lit(None).cast("string")
    for _, label, a, b in reversed(vocab.PERIODS):
        name = F.when((start <= b) & (end >= a), label).otherwise(name)
    return F.struct(F.coalesce(best["period"], name, F.lit(vocab.UNKNOWN)).alias("period"), best["sub"].alias("sub"), start.cast("int").alias("start"), end.cast("int").alias("end"))


def parse(text: Column) -> Column:
    """Phases of a dating text: 'a:b', EUR codes, textual ages, sub-period ranges, single ones, radiocarbon ranges."""
    t = F.trim(text)
    get = lambda p, g: F.regexp_extract(t, p, g)
    number = lambda p, g: get(p, g).try_cast("int")
    unknown = F.array(_phase(vocab.UNKNOWN, None, None, None))
    pair, code, age = vocab.DATE_PAIR_PATTERN, vocab.PERIOD_CODE_PATTERN, vocab.TEXTUAL_AGE_PATTERN
    span, one, c14 = vocab.SUB_PERIOD_RANGE_PATTERN, vocab.SINGLE_SUB_PERIOD_PATTERN, vocab.RADIOCARBON_PATTERN
    codes = F.when(get(code, 1) == "FER", F.array(_phase(vocab.UNKNOWN, None, -800, -25))).when(get(code, 1) == "BRO", F.array(_phase(vocab.UNKNOWN, None, -2200, -800)))
    codes = codes.when(get(code, 1) == "GAL", F.array(_phase("La Tène", None, -450, -25))).when(get(code, 1) == "ROM", F.array(_phase(vocab.UNKNOWN, None, -25, 500))).otherwise(unknown)
    a1, a2 = F.lower(get(age, 1)), F.lower(get(age, 2))
    ages = (
        F.when((a1 == "fer") & (a2 == ""), F.array(_phase(vocab.UNKNOWN, None, -800, -25)))
        .when((a1 == "fer") & a2.startswith("gallo"), F.array(_phase("La Tène", None, -450, -25)))
        .when((a1 == "bronze") & (a2 == "fer"), F.array(_phase("Hallstatt", None, -800, -450)))
        .when((a1 == "bronze") & (a2 == ""), F.array(_phase(vocab.UNKNOWN, None, -2200, -800)))
        .otherwise(unknown)
    )
    subs = _subs()
    known = F.array(*[F.lit(s) for s, *_ in vocab.SUB_PERIODS])

    def resolved(prefix: Column, sub_code: Column) -> Column:
        """A stated sub-period, or its letter where the digit is not one of it."""
        full, coarse = F.concat_ws(" ", prefix, sub_code), F.concat_ws(" ", prefix, F.substring(sub_code, 1, 1))
        return F.when(F.exists(known, lambda s: s.startswith(full)), full).when(F.exists(known, lambda s: s.startswith(coarse)), coarse).otherwise(full)

    def expanded(sub: Column) -> Column:
        plain = F.filter(subs, lambda p: (~F.contains(p["sub"], F.lit("/"))) & p["sub"].startswith(sub))
        alone = F.array(F.struct(F.when(sub.startswith("Ha"), "Hallstatt").otherwise("La Tène").alias("period"), sub.alias("sub"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("end")))
        return F.when(F.size(plain) > 0, plain).otherwise(alone)

    s1, s2 = resolved(get(span, 1), get(span, 2)), resolved(F.coalesce(F.nullif(get(span, 3), F.lit("")), get(span, 1)), get(span, 4))
    places = F.transform(known, lambda s, i: F.struct(i.alias("i"), s.alias("s")))
    hits = lambda sub: F.transform(F.filter(places, lambda p: p["s"].startswith(sub)), lambda p: p["i"])
    i1, i2 = F.array_min(hits(s1)), F.array_max(hits(s2))
    ranged = F.when(i1.isNull() | i2.isNull(), F.concat(expanded(s1), expanded(s2))).otherwise(F.slice(subs, F.least(i1, i2) + 1, F.abs(i2 - i1) + 1))
    v1, v2 = number(c14, 1), number(c14, 2)
    return (
        F.when(t.isNull() | t.isin("", "-", "Indéterminé", "indéterminé", "Non renseigné"), unknown)
        .when(t.rlike(pair), F.array(within(number(pair, 1), number(pair, 2))))
        .when(t.rlike(code), codes)
        .when(t.rlike(age), ages)
        .when(t.rlike(span), ranged)
        .when(t.rlike(one), expanded(resolved(get(one, 1), get(one, 2))))
        .when(t.rlike(c14), F.array(within(-F.greatest(v1, v2), -F.least(v1, v2))))
        .otherwise(unknown)
        .cast(_PHASE)
    )


def parse_pair(first: Column, second: Column) -> Column:
    """Phases of a range that starts in one 'a:b' text and ends in another."""
    p = vocab.DATE_PAIR_PATTERN
    both = F.trim(first).rlike(p) & F.trim(second).rlike(p)
    joined = F.concat_ws(":", F.regexp_extract(F.trim(first), p, 1), F.regexp_extract(F.trim(second), p, 2))
    return parse(F.when(both, joined).otherwise(F.coalesce(F.nullif(first, F.lit("")), second)))


def flags(columns: dict[str, Column]) -> Column:
    """Phases of period flag columns: {sub-period prefix: flag}."""
    plain = lambda sub: F.filter(_subs(), lambda p: (~F.contains(p["sub"], F.lit("/"))) & p["sub"].startswith(sub))
    parts = [F.when(F.coalesce(c.cast("string"), F.lit("")).isin("", "0", "0.0"), F.expr(f"cast(array() as {_PHASE})")).otherwise(plain(sub)) for sub, c in columns.items()]
    found = F.flatten(F.array(*parts))
    return F.when(F.size(found) > 0, found).otherwise(F.array(_phase(vocab.UNKNOWN, None, None, None)))


def overlap(start: Column, end: Column, low: int | Column, high: int | Column, *, inclusive: bool = True) -> Column:
    """Years that two intervals share."""
    low, high = (x if isinstance(x, Column) else F.lit(x) for x in (low, high))
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low) + int(inclusive))


def warnings(period: Column, sub: Column, start: Column, end: Column) -> Column:
    """Array of struct(field, message): inversion, bounds of the period, sub-period prefix."""
    say = lambda test, field, text: F.when(test, F.struct(F.lit(field).alias("field"), F.lit(text).alias("message")))
    out = [say(start > end, "datation", "start after end")]
    for _, label, low, high in vocab.PERIODS:
        out.append(say((period == label) & (start < low), "datation_debut", f"before {label} ({low})"))
        out.append(say((period == label) & (end > high), "datation_fin", f"after {label} ({high})"))
        prefixed = F.lit(False)
        for p in vocab.PREFIXES[label]:
            prefixed = prefixed | sub.startswith(p)
        out.append(say((period == label) & sub.isNotNull() & ~prefixed, "sous_periode", f"not of {label}"))
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def label(start: Column, end: Column) -> Column:
    return F.format_string("%d – %d av. J.-C.", F.abs(start), F.abs(end))
