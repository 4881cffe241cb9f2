"""Vocabulary scan: every word of a vocabulary that stands in a text, in one pass by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a vocabulary that one automaton holds, which bounds what is broadcast; a node a character, about forty bytes.
BLOCK_CHARS = 1_000_000


class Scanner:
    """Automaton over distinct, non-empty words; an empty word stands in every text."""

    def __init__(self, words: Sequence[str]):
        self.words = [w for w in dict.fromkeys(words) if w]
        self.blank = any(w == "" for w in words)
        self.most = max(map(len, self.words), default=0)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, w in enumerate(self.words):
            self.automaton.add_word(w, i)
        if self.words:
            self.automaton.make_automaton()

    def found(self, text: str) -> Iterator[tuple[int, int]]:
        """(start, number of the word) of every occurrence, by its end."""
        if self.words:
            for end, i in self.automaton.iter(text):
                yield end + 1 - len(self.words[i]), i

    def longest(self, text: str | None, prefix: bool = False) -> str | None:
        """The longest word in the text, or at its start; of equally long ones the greatest."""
        if text is None:
            return None
        hits = {i for start, i in self.found(text[: self.most] if prefix else text) if not prefix or start == 0}
        return max((self.words[i] for i in hits), key=lambda w: (len(w), w), default="" if self.blank else None)


def longest(c: Column, scanner, prefix: bool = False) -> Column:
    """The longest word of a broadcast ``Scanner`` in a text; null without any."""

    def run(texts: pa.Array) -> pa.Array:
        held = scanner.value
        return pa.array([held.longest(t, prefix) for t in texts.to_pylist()], type=pa.string())

    return F.arrow_udf(run, "string")(c)


def labels(c: Column, aliases: Sequence[tuple[str, str]]) -> Column:
    """Labels of the aliases (alias, label) that a text names, in their order, each once.

    Aliases of one word stand as whole words (letters, digits and _ are parts of words), others anywhere.
    The vocabulary is a fixed one and travels with the function.
    """
    names = [a for a, _ in aliases]
    of = [label for _, label in aliases]
    free = [bool(set(a) & set(" -'")) for a in names]
    held = Scanner(names)
    first = {w: i for i, w in reversed(list(enumerate(names)))}
    part = lambda ch: ch.isalnum() or ch == "_"

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            if t is None:
                out.append(None)
                continue
            hits = set()
            for start, k in held.found(t):
                i, end = first[held.words[k]], start + len(held.words[k])
                if free[i] or not (start and part(t[start - 1])) and not (end < len(t) and part(t[end])):
                    hits.add(i)
            # An alias that is listed again under another label names that too.
            named = {names[i] for i in hits}
            out.append(list(dict.fromkeys(label for a, label in aliases if a in named)))
        return pa.array(out, type=pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(c)
