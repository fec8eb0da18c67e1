"""Lexicon patterns as columns, and the cutting of text into clauses."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# The punctuation marks that end a clause.
CLAUSE_MARKS = "，,。;；!！…"
# Characters with a meaning in a regular expression.
REGEX_MARKS = frozenset("\\.[]{}()*+?^$|")
# The characters outside ASCII whose lower case begins with an ASCII letter.
FOLDS_INTO_ASCII = ("K", "İ")

_NAMES = "array<string>"


def fold(text: Column) -> Column:
    """Lower case of ``text``, in which an ASCII letter only stems from an ASCII letter."""
    for character in FOLDS_INTO_ASCII:
        text = F.replace(text, F.lit(character), F.lit("\u0000"))
    return F.lower(text)


def _is_word(text: str) -> bool:
    """Whether ``text`` can be looked up as a substring instead of being matched.

    With an ASCII letter it may hold no other letter that has a case, as only ASCII ignores case.
    """
    if not text or REGEX_MARKS & set(text) or "\u0000" in text:
        return False
    cased = [c for c in text if not c.isascii() and unicodedata.category(c) in ("Lu", "Ll", "Lt", "Lm", "Mn", "Mc", "Me")]
    return not (cased and is_lettered(text))


def is_lettered(word: str) -> bool:
    return any(c.isascii() and c.isalpha() for c in word)


def plain_words(pattern: str) -> list[str] | None:
    """The words of a pattern that is plain words joined by ``|``, else None."""
    words = pattern.split("|")
    return words if all(map(_is_word, words)) else None


# What can stand between two words: a class or a dot, however often repeated, or one of + ^ $.
_BETWEEN_WORDS = re.compile(r"(?:\[\^?[^\[\]^\\&]+\]|\.)(?:[*+?]|\{[0-9,]+\})?[+?]?|[+^$]")


def needed_words(pattern: str) -> list[str]:
    """Words that every match of ``pattern`` holds, the longest first, as far as they are plain to see.

    Only patterns without groups, alternatives, escapes and optional letters are looked at.
    """
    words = [w for w in _BETWEEN_WORDS.split(pattern) if w]
    return sorted(dict.fromkeys(words), key=len, reverse=True) if all(map(_is_word, words)) else []


_CLASS, _RANGE = re.compile(r"\[\^?([^\]]*)\]"), re.compile("(.)-(.)", re.DOTALL)


def folded_pattern(pattern: str) -> str | None:
    """A pattern that is found in ``fold(text)``, case regarded, where ``pattern`` is found in ``text``; None where none is plain to see.

    Only ASCII patterns of words and classes are looked at, whose ranges are of letters of one case or of digits.
    """
    if not pattern.isascii() or "\u0000" in pattern or not needed_words(pattern):
        return None
    ranges = [a + b for inner in _CLASS.findall(pattern) for a, b in _RANGE.findall(inner)]
    alike = all(r.isdigit() or r.isalpha() and r in (r.lower(), r.upper()) for r in ranges)
    return pattern.lower() if alike else None


def needed_word(pattern: str) -> str | None:
    """The first of the longest words that every match of ``pattern`` holds, None where none is plain to see."""
    return next(iter(needed_words(pattern)), None)


def _holds(text: Column, word: str, folded: Column) -> Column:
    return F.contains(folded, F.lit(word.lower())) if is_lettered(word) else F.contains(text, F.lit(word))


def found(text: Column, pattern: str, folded: Column | None = None) -> Column:
    """Whether ``pattern`` is found in ``text``; only ASCII letters ignore case. Null text gives null.

    Patterns of plain words are looked up as substrings, which reads the bytes of the text as they
    are; anything else is matched as a Java regular expression, where a word it needs is there.
    """
    folded = fold(text) if folded is None else folded
    words = plain_words(pattern)
    if words is not None:
        result = _holds(text, words[0], folded)
        for word in words[1:]:
            result = result | _holds(text, word, folded)
        return result
    matched = text.rlike(f"(?i){pattern}")
    word = needed_word(pattern)
    return matched if word is None else _holds(text, word, folded) & matched


def clauses(text: Column, marks: str = CLAUSE_MARKS) -> Column:
    """Text cut at every mark.

    Empty clauses inside the text stay, those at its end do not, so a text of marks alone has no
    clause. An empty text is one empty clause.
    """
    kept = F.rtrim(text, F.lit(marks))
    cut = F.split(kept, f"[{marks}]")
    only_marks = (kept == "") & (text != "")
    return F.when(only_marks, F.array().cast(_NAMES)).otherwise(cut)


def folded_clauses(text: Column) -> Column:
    """Clauses as structs of ``text`` and ``folded``."""
    return F.transform(clauses(text), lambda clause: F.struct(clause.alias("text"), fold(clause).alias("folded")))
