"""Dimension rules: boolean expressions over the names of tags.

A rule joins names with ``[&]`` (and), ``[|]`` (or), ``[-]`` (and not) and parentheses. Each name is
replaced by a Spark SQL predicate and the text is handed to ``F.expr``, so precedence is that of
SQL: not, and, or.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The operators of the rule language.
OPERATORS = {
    "[&]": "and",
    "[|]": "or",
    "[-]": "and not",
    "(": "(",
    ")": ")",
}
_OPERATOR = re.compile("(" + "|".join(re.escape(o) for o in OPERATORS) + ")")


class RuleError(ValueError):
    """A dimension rule that cannot be read, with its name in the message."""


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def rule_text(
    name: str,
    rule: str,
    tags: Sequence[str],
    objects: Collection[str] = (),
    columns: Collection[str] = (),
    tag_array: str = "tags",
    object_array: str = "objects",
    group_wildcards: bool = False,
) -> str:
    """Spark SQL predicate for one rule.

    A name is looked up as a tag, then as an object, then as a boolean input column; spaces around
    it are dropped only if it is unknown with them. A name with ``*`` stands for every tag that
    starts with the rest, joined with ``or`` and, unless ``group_wildcards``, not put in
    parentheses: ``a[&]b*`` is ``(a and b1) or b2``.
    """

    def known(word: str) -> str | None:
        if word in tags:
            return f"array_contains({tag_array}, {literal(word)})"
        if word in objects:
            return f"array_contains({object_array}, {literal(word)})"
        if word in columns:
            return "`" + word.replace("`", "``") + "`"
        return None

    def operand(word: str) -> str:
        if "*" in word:
            for prefix in dict.fromkeys((word.replace("*", ""), word.replace("*", "").strip())):
                hits = [known(t) for t in tags if t.startswith(prefix)]
                if hits:
                    text = " or ".join(hits)
                    return f"({text})" if group_wildcards else text
            raise RuleError(f"dimension {name!r}: no tag matches {word!r}")
        text = known(word) or known(word.strip())
        if text is None:
            raise RuleError(f"dimension {name!r}: unknown name {word!r}")
        return text

    words = [w for w in _OPERATOR.split(rule) if w in OPERATORS or w.strip()]
    if not words:
        raise RuleError(f"dimension {name!r}: the rule is empty")
    return " ".join(OPERATORS[w] if w in OPERATORS else operand(w) for w in words)


def check_rules(rows: DataFrame, rules: Mapping[str, str]) -> None:
    """Raises a RuleError naming the first dimension whose predicate is no expression over ``rows``."""
    try:
        rows.select(*[F.expr(f"({text})") for text in rules.values()])
    except AnalysisException:
        for name, text in rules.items():
            try:
                rows.select(F.expr(f"({text})"))
            except AnalysisException as error:
                raise RuleError(f"dimension {name!r}: not a valid rule ({text})") from error
        raise


def label_array(rules: Mapping[str, str]) -> str:
    """Spark SQL text of the array of the names whose predicate is true."""
    if not rules:
        return "cast(array() as array<string>)"
    cases = ", ".join(f"case when ({text}) then {literal(name)} end" for name, text in rules.items())
    return f"array_compact(array({cases}))"
