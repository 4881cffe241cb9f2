"""Text expressions: cleaning, folding, keys, keyword extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import vocab

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyy"


def fold(c: Column) -> Column:
    """Lower-case without the accents of the French, German and Spanish repertoire."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean(c: Column) -> Column:
    """Trimmed cell, blank as null."""
    return F.nullif(F.trim(c), F.lit(""))


def decimal(c: Column, *, nbsp: bool = False) -> Column:
    """Number with a decimal comma or point; anything else is null."""
    text = F.replace(F.trim(c), F.lit(","), F.lit("."))
    if nbsp:
        text = F.replace(text, F.lit(" "), F.lit(""))
    value = text.try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def truthy(c: Column) -> Column:
    """1, oui, x, yes, a positive number or other text are true; blanks, 0, non and no are false."""
    t = F.lower(F.trim(c.cast("string")))
    n = t.try_cast("double")
    return F.coalesce(F.when(n.isNotNull(), n > 0).otherwise((t != "") & ~t.isin("non", "no", "false", "nan")), F.lit(False))


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), F.lit("-"))


def title_parts(c: Column) -> Column:
    """Each hyphened part capitalised."""
    return F.array_join(F.transform(F.split(c, "-"), lambda x: F.initcap(x)), "-")


def md5_key(prefix: str, *parts: Column) -> Column:
    """Prefix and 16 hex digits; a missing part prints as 'None'."""
    return F.concat(F.lit(prefix), F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("None")) for p in parts])), 1, 16))


def sha_key(c: Column, digits: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, digits)


def pairs_text(cols: Sequence[str]) -> Column:
    """'k=v | k=v' over the non-empty cells."""
    return F.concat_ws(" | ", *[F.when(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) != "", F.concat(F.lit(c + "="), F.col(f"`{c}`").cast("string"))) for c in cols])


def mentions(c: Column, pattern: str) -> Column:
    """Sorted distinct matches."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), 0)))


def lexicon_share(c: Column, words: Sequence[str], token: str = "[A-Za-zÀ-ÿ]+") -> Column:
    """Share of the tokens that are in the lexicon, 0 without tokens."""
    tokens = F.regexp_extract_all(F.lower(c), F.lit(token), 0)
    hit = F.size(F.filter(tokens, lambda t: t.isin(*words)))
    return F.when(F.size(tokens) > 0, hit / F.size(tokens)).otherwise(F.lit(0.0))


def merge_unique(texts: Column, split: str = "[;,]") -> Column:
    """Parts of all texts joined by '; ', each folded spelling once, the first spelling kept."""
    parts = F.filter(F.flatten(F.transform(texts, lambda t: F.transform(F.split(t, split), collapse))), lambda p: p != "")
    firsts = F.filter(parts, lambda p: p.isNotNull())
    kept = F.aggregate(
        firsts,
        F.struct(F.expr("cast(array() as array<string>)").alias("k"), F.expr("cast(array() as array<string>)").alias("v")),
        lambda acc, p: F.when(F.array_contains(acc["k"], fold(p)), acc).otherwise(F.struct(F.concat(acc["k"], F.array(fold(p))).alias("k"), F.concat(acc["v"], F.array(p)).alias("v"))),
        lambda acc: acc["v"],
    )
    return F.array_join(kept, "; ")


def tags(c: Column) -> Column:
    """Map of 'KEY : value #' tags in a comment; a repeated key keeps its last value."""
    found = F.regexp_extract_all(c, F.lit(r"(\w+)\s*:\s*([^#]+?)(?:\s*#|$)"), 0)
    cut = lambda g: lambda x: F.regexp_extract(x, r"(\w+)\s*:\s*([^#]+?)(?:\s*#|$)", g)
    return F.aggregate(found, F.expr("cast(map() as map<string,string>)"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != cut(1)(x)), F.create_map(cut(1)(x), F.trim(cut(2)(x)))))


def repair_mojibake(c: Column) -> Column:
    """UTF-8 that was read as Latin-1, where the text has the marks of that and decodes."""
    suspect = c.rlike("[ÃÂ]") & ~c.rlike("[^\\x{00}-\\x{FF}]")
    return F.coalesce(F.when(suspect, F.try_validate_utf8(F.encode(F.when(suspect, c), "ISO-8859-1").cast("string"))), c)


def site_type(c: Column) -> Column:
    """Type of a text: exact alias, else the first alias in it, else unknown."""
    text = F.lower(F.trim(c))
    rows = vocab.type_aliases()
    exact = F.create_map(*[F.lit(x) for _, a, t in rows for x in (a, t)])
    # Over the fixed list of aliases: position of the first that the text contains.
    names, kinds = F.array(*[F.lit(a) for _, a, _ in rows]), F.array(*[F.lit(t) for *_, t in rows])
    inside = F.get(F.filter(F.transform(names, lambda a, i: F.when(F.contains(text, a), i)), lambda i: i.isNotNull()), F.lit(0))
    return F.coalesce(F.try_element_at(exact, text), F.get(kinds, inside), F.lit(vocab.UNKNOWN))


def toponym(c: Column) -> Column:
    """struct(name, variants): the canonical name, with the given one as its variant if it differs."""
    table = F.create_map(*[F.lit(x) for name, vs in vocab.TOPONYMS.items() for v in dict.fromkeys(x.lower() for x in (name, *vs)) for x in (v, name)])
    given = F.trim(c)
    name = F.coalesce(F.try_element_at(table, F.lower(given)), given)
    return F.struct(name.alias("name"), F.when(name != given, F.array(given)).otherwise(F.expr("cast(array() as array<string>)")).alias("variants"))


def identifier(c: Column) -> Column:
    """struct(commune, place, type, period) of an ' / '-segmented site identifier; the tail comes in any order."""
    parts = F.split(c, " / ")
    dated = r"(?iu)\b(?:âge|age)\s+du\b|hallstatt|tène|gallo|néolith|protohistor|moyen|bronze|fer\b"
    tail = F.filter(F.slice(parts, F.lit(6), F.greatest(F.size(parts) - 5, F.lit(0))), lambda s: F.trim(s) != "")
    first = lambda xs: F.get(xs, F.lit(0))
    at = lambda i: F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit(""))
    enough = F.size(parts) >= 3
    return F.struct(
        F.when(enough, at(2)).alias("commune"), F.when(enough, at(4)).alias("place"),
        F.when(enough, first(F.filter(tail, lambda s: ~s.rlike(dated)))).alias("type"), F.when(enough, first(F.filter(tail, lambda s: s.rlike(dated)))).alias("period"),
    )
