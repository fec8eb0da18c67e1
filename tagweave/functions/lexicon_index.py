"""Tags of a text: each pattern by itself, or an inverted index from the words that patterns need to them.

A small lexicon is one expression for each pattern. In the index, all words of a lexicon are one pattern in the shape of a trie, which finds them in a single pass over a
text however many they are. Each word that is found is looked up in a table of buckets, which names the
patterns that are sure with it (plain words) and those that need it. A pattern all of whose needed words are found
is a candidate, and only candidates are matched. A text is neither shuffled nor exploded, and the plan holds the trie and
the tables as literals, so its size does not grow by an expression for each pattern.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagweave.functions.patterns import fold, folded_pattern, found, is_lettered, needed_words, plain_words

#: Branches that a trie tries one after another; more are halved by the range of their first characters.
BRANCHES = 5

# First characters that all words have, by which places are told before the trie is tried, and ranges in a class of them.
OUTLINE, RANGES = 4, 32

# Lexicons of more tags than this are looked up through an index of their words.
INDEXED = 100
# Tags per array expression. Keeps each generated method small.
CHUNK = 50

# Needed words of a pattern that are looked up.
LOOKED_UP = 8

_NAMES, _NUMBERS = "array<string>", "array<int>"


def matched_tags(text: Column, tags: Mapping[str, str], folded: Column | None = None, indexed: int = INDEXED) -> Column:
    """Names of the tags whose pattern is found in ``text``, in lexicon order; empty for null text.

    ``folded`` is a column that holds ``fold(text)``, so that it is computed once for all tags. In a
    lexicon of more than ``indexed`` tags, a pattern that is no regular expression is an error only
    where a word it needs is found.
    """
    folded = fold(text) if folded is None else folded
    names = list(tags)
    if len(names) > indexed:
        return LexiconIndex(tags).names(text, folded)
    chunks = [
        F.array_compact(F.array(*[F.when(found(text, tags[n], folded), F.lit(n)) for n in names[i : i + CHUNK]]))
        for i in range(0, len(names), CHUNK)
    ]
    if not chunks:
        return F.array().cast(_NAMES)
    return chunks[0] if len(chunks) == 1 else F.concat(*chunks)


def trie_pattern(words: Iterable[str]) -> str:
    """A Java pattern that matches the longest of ``words`` that begins at a place."""
    root: dict = {}
    for word in words:
        node = root
        for character in word:
            node = node.setdefault(character, {})
        node[""] = {}

    def branch(node: dict, character: str) -> str:
        text, node = character, node[character]
        while len(node) == 1 and "" not in node:
            (character, node), *_ = node.items()
            text += character
        return re.escape(text) + rest(node)

    def any_of(node: dict, characters: list[str]) -> str:
        if len(characters) <= BRANCHES:
            return "|".join(branch(node, c) for c in characters)
        half = len(characters) // 2
        first, last = characters[0], characters[half - 1]
        low = f"(?=[\\x{{{ord(first):x}}}-\\x{{{ord(last):x}}}])(?:{any_of(node, characters[:half])})"
        return f"{low}|{any_of(node, characters[half:])}"

    def rest(node: dict) -> str:
        characters = sorted(c for c in node if c)
        if not characters:
            return ""
        return f"(?:{any_of(node, characters)})" + ("?" if "" in node else "")

    return rest(root)


def outline_pattern(words: Iterable[str]) -> str:
    """A Java pattern of one class for each of the first characters, which the beginning of every word matches.

    Most places of a text are told by it to begin no word, without a step into the trie.
    """
    words = list(words)

    def any_of(characters: set[str]) -> str:
        codes = sorted(map(ord, characters))
        edges = [i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1]
        runs = [(codes[a], codes[b - 1]) for a, b in zip([0, *edges], [*edges, len(codes)])]
        runs = runs if len(runs) <= RANGES else [(codes[0], codes[-1])]
        return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs) + "]"

    return "".join(any_of({w[i] for w in words}) for i in range(min([OUTLINE, *map(len, words)])))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _constant(value: object, schema: str) -> Column:
    """A nested value as one literal, which the optimizer makes of its JSON text."""
    return F.from_json(F.lit(json.dumps(value)), schema)


# Patterns by word: their number, and which of their needed words it is, or SURE.
_Table = dict[str, set[tuple[int, int]]]
SURE = -1


class LexiconIndex:
    """The index of named patterns. Those without a plain word to look up are in ``without_word``."""

    def __init__(self, tags: Mapping[str, str]):
        self.tags = dict(tags)
        self.without_word: list[int] = []
        self._parts: list[int] = []
        self._folded: _Table = {}
        self._as_is: _Table = {}
        for number, pattern in enumerate(self.tags.values()):
            plain, needed = plain_words(pattern), needed_words(pattern)[:LOOKED_UP]
            if plain is None and not needed:
                self.without_word.append(number)
            self._parts.append(0 if plain else len(needed))
            # Any of the plain words is enough (no part), of the needed ones each is a part.
            for word, part in [(w, SURE) for w in plain] if plain else zip(needed, range(LOOKED_UP)):
                # Words without an ASCII letter do not ignore case.
                table, key = (self._folded, word.lower()) if is_lettered(word) else (self._as_is, word)
                table.setdefault(key, set()).add((number, part))

    def numbers(self, text: Column, folded: Column) -> Column:
        """Numbers of the patterns found in ``text``, ascending; empty for null text."""
        # In the folded text a pattern is searched by the bytes of its first word, without regard to case.
        in_folded = [folded_pattern(p) for p in self.tags.values()]
        patterns = _constant([f"(?i){p}" if q is None else q for p, q in zip(self.tags.values(), in_folded)], "array<string>")
        on_folded = _constant([q is not None for q in in_folded], "array<boolean>")
        n_parts = _constant(self._parts, _NUMBERS)
        of_words = [_hits(source, table) for source, table in ((folded, self._folded), (text, self._as_is)) if table]

        def confirmed(hits: Column) -> Column:
            sure = F.transform(F.filter(hits, lambda h: h < 0), lambda h: SURE - h)
            codes = F.filter(hits, lambda h: h >= 0)
            return F.concat(sure, _let(F.sort_array(F.array_distinct(codes)), candidates))

        def candidates(codes: Column) -> Column:
            def complete(code: Column, i: Column) -> Column:
                number = F.call_function("div", code, F.lit(LOOKED_UP)).cast("int")
                more = F.get(n_parts, number) - 1
                whole = (code % LOOKED_UP == 0) & F.get(codes, i + more).eqNullSafe(code + more)
                source = F.when(F.get(on_folded, number), folded).otherwise(text)
                return F.when(whole, F.when(F.rlike(source, F.get(patterns, number)), number))

            return F.array_compact(F.transform(codes, complete))

        none = F.array().cast(_NUMBERS)
        parts = [_let(F.concat(*[F.coalesce(h, none) for h in of_words]), confirmed)] if of_words else []
        if self.without_word:
            own = list(self.tags.values())
            parts.append(F.array_compact(F.array(*[F.when(found(text, own[n], folded), F.lit(n)) for n in self.without_word])))
        return F.sort_array(F.array_distinct(F.concat(*parts))) if parts else F.array().cast(_NUMBERS)

    def names(self, text: Column, folded: Column) -> Column:
        """Names of the patterns found in ``text``, in the order of the lexicon."""
        names = _constant(list(self.tags), "array<string>")
        return F.transform(self.numbers(text, folded), lambda n: F.get(names, n))


def _hits(source: Column, table: _Table) -> Column:
    """What the words of ``table`` that are in ``source`` are needed by: codes of patterns and parts, below zero where sure."""
    ordered = sorted(table)
    buckets: list[list[dict]] = [[] for _ in range(len(ordered) // 2 + 1)]
    open_words: list[str] = []
    for word in ordered:
        # Only the longest word at a place is found, so a word speaks for those that begin it.
        while open_words and not word.startswith(open_words[-1]):
            open_words.pop()
        open_words.append(word)
        of = sorted({entry for w in open_words for entry in table[w]})
        bucket = buckets[zlib.crc32(word.encode()) % len(buckets)]
        bucket.append({"word": word, "of": [SURE - n if part == SURE else n * LOOKED_UP + part for n, part in of]})
    index = _constant(buckets, f"array<array<struct<word:string,of:{_NUMBERS}>>>")
    at_place = f"(?={outline_pattern(ordered)})(?=({trie_pattern(ordered)}))"
    found = F.array_distinct(F.regexp_extract_all(source, F.lit(at_place), F.lit(1)))
    bucket_of = lambda word: F.get(index, (F.crc32(word.cast("binary")) % len(buckets)).cast("int"))
    return F.flatten(F.transform(found, lambda w: F.flatten(F.transform(F.filter(bucket_of(w), lambda e: e["word"] == w), lambda e: e["of"]))))
