"""Named lexicons: tags (name to regex), dimensions (name to rule) and objects (names)."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lexicon:
    name: str
    tags: dict[str, str]
    dimensions: dict[str, str] = field(default_factory=dict)
    objects: list[str] = field(default_factory=list)

    def derived_dimensions(self) -> dict[str, str]:
        """Dimensions that need their rule: one named like a tag takes the flag of that tag."""
        return {d: rule for d, rule in self.dimensions.items() if d not in self.tags}


def load_lexicon(rules: DataFrame, name: str) -> Lexicon:
    """The rule set ``name`` of a table with columns ``name, tags, dimensions, objects`` (JSON text).

    Missing or malformed dimensions and objects are empty; missing tags, and a name that is absent
    or held by several rows, are errors.
    """
    # One row of rule text; its patterns become literals of the plan.
    rows = rules.filter(F.col("name") == name).select("tags", "dimensions", "objects").take(2)
    if len(rows) != 1:
        raise LookupError(f"{'no' if not rows else 'more than one'} rule set is named {name!r}")
    tags = _parse(rows[0]["tags"], dict)
    if tags is None:
        raise ValueError(f"rule set {name!r} has no tags")
    return Lexicon(name, tags, _parse(rows[0]["dimensions"], dict) or {}, _parse(rows[0]["objects"], list) or [])


def _parse(text: str | None, kind: type) -> dict | list | None:
    try:
        value = json.loads(text) if text else None
    except json.JSONDecodeError:
        return None
    return value if isinstance(value, kind) else None


def lexicon_entries(rules: DataFrame) -> DataFrame:
    """Every entry of every rule set as a row ``name, kind, entry, body``; objects have a null body."""
    entries = rules.select(
        "name",
        F.concat(*[_map_entries("tags", "tag"), _map_entries("dimensions", "dimension"), _object_entries()]).alias("all"),
    )
    return entries.select("name", F.inline("all"))


_ENTRY = "array<struct<kind:string,entry:string,body:string>>"


def _map_entries(column: str, kind: str) -> F.Column:
    parsed = F.map_entries(F.from_json(column, "map<string,string>"))
    rows = F.transform(parsed, lambda e: F.struct(F.lit(kind), e["key"], e["value"]))
    return F.coalesce(rows.cast(_ENTRY), F.array().cast(_ENTRY))


def _object_entries() -> F.Column:
    parsed = F.from_json("objects", "array<string>")
    rows = F.transform(parsed, lambda o: F.struct(F.lit("object"), o, F.lit(None).cast("string")))
    return F.coalesce(rows.cast(_ENTRY), F.array().cast(_ENTRY))
