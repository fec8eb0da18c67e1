"""Lexicon tagging: tags of a text, clause-wise tags of ambiguous texts, dimensions, labels.

Nothing here filters on, or explodes with an inferred filter, a column made of patterns: Spark would
copy the patterns into that filter and match every text twice. ``explode_outer`` with a filter on
its result keeps each pattern to one match.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.lexicon_index import matched_tags
from tagweave.functions.patterns import clauses, fold, folded_clauses, found
from tagweave.functions.rules import check_rules, label_array, literal, rule_text
from tagweave.sources.lexicon import Lexicon

_NAMES = "array<string>"


_FOLDED = "_folded"


def _with_folded(posts: DataFrame, content: str) -> DataFrame:
    return posts.withColumn(_FOLDED, fold(F.col(content)))


def tag_posts(posts: DataFrame, lexicon: Lexicon, content: str = "content") -> DataFrame:
    """``posts`` with ``tags``, the names of the tags found in the text. A null text has none."""
    folded = _with_folded(posts, content)
    return folded.withColumn("tags", matched_tags(F.col(content), lexicon.tags, F.col(_FOLDED))).drop(_FOLDED)


def tag_columns(posts: DataFrame, lexicon: Lexicon, content: str = "content") -> DataFrame:
    """``posts`` with one boolean column per tag, named like the tag."""
    hits = {tag: found(F.col(content), p, F.col(_FOLDED)) for tag, p in lexicon.tags.items()}
    flags = [F.coalesce(hit, F.lit(False)).alias(tag) for tag, hit in hits.items()]
    return _with_folded(posts, content).select(*posts.columns, *flags)


def flag_objects(tagged: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``tagged`` with ``objects``: objects whose name is contained in two or more of its tags."""
    return tagged.withColumn("objects", _objects(lexicon))


def _objects(lexicon: Lexicon) -> Column:
    flags = [F.when(_tags_naming(name) > 1, F.lit(name)) for name in lexicon.objects]
    return F.array_compact(F.array(*flags)) if flags else F.array().cast(_NAMES)


def _tags_naming(name: str) -> Column:
    return F.size(F.filter("tags", lambda tag: tag.contains(F.lit(name))))


def retag_clauses(flagged: DataFrame, lexicon: Lexicon, content: str = "content") -> DataFrame:
    """Posts with an object as one row per clause, with the tags of the clause; others as they are.

    Clause rows keep the whole text and the objects of the post. A post whose text is nothing but
    clause marks is left without a row.
    """
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.lit(None).cast("string").alias("text")))
    cut = F.transform(clauses(F.col(content)), lambda clause: F.struct(F.lit(False).alias("whole"), clause.alias("text")))
    units = F.when(F.size("objects") > 0, cut).otherwise(whole)
    split = flagged.withColumn("unit", F.explode_outer(units)).filter(F.col("unit").isNotNull())
    split = split.withColumn(_FOLDED, fold(F.col("unit.text")))
    own = matched_tags(F.col("unit.text"), lexicon.tags, F.col(_FOLDED))
    return split.withColumn("tags", F.when(F.col("unit.whole"), F.col("tags")).otherwise(own)).drop("unit", _FOLDED)


def _rules(tagged: DataFrame, lexicon: Lexicon, group_wildcards: bool, tag_array: str = "tags") -> dict[str, str]:
    """Predicate text of every dimension; the rules are checked over the columns of ``tagged``."""
    flags = [f.name for f in tagged.schema.fields if f.dataType.typeName() == "boolean"]

    def texts(held: str) -> dict[str, str]:
        return {name: f"array_contains({held}, {literal(name)})" for name in lexicon.dimensions if name in lexicon.tags} | {
            name: rule_text(name, rule, list(lexicon.tags), lexicon.objects, flags, held, "objects", group_wildcards)
            for name, rule in lexicon.derived_dimensions().items()
        }

    check_rules(tagged, texts("tags"))
    found = texts(tag_array)
    return {name: found[name] for name in lexicon.dimensions}


def apply_dimensions(tagged: DataFrame, lexicon: Lexicon, group_wildcards: bool = False) -> DataFrame:
    """``tagged`` with ``labels``: the names of the dimensions that are true of its tags and objects.

    A dimension named like a tag is true when the tag is; its rule is not looked at.
    """
    if "objects" not in tagged.columns:
        tagged = tagged.withColumn("objects", F.array().cast(_NAMES))
    return tagged.withColumn("labels", F.expr(label_array(_rules(tagged, lexicon, group_wildcards))))


def row_digest(columns: Sequence[str]) -> Column:
    """128 bits by which equal rows are brought together; rows that only share them are told apart later."""
    values = [F.col(c) for c in columns]
    return F.struct(F.xxhash64(*values).alias("one"), F.xxhash64(F.lit("other"), *values, F.lit(1)).alias("two"))


Digest = Callable[[Sequence[str]], Column]


def combine_clauses(labelled: DataFrame, lexicon: Lexicon, columns: Sequence[str], digest: Digest = row_digest) -> DataFrame:
    """One row per different post (``columns``), with the labels any of its rows has.

    Rows of a post meet by its digest, not by its text. A digest holds its different pairs of post and
    labels, so a post with many clauses or copies stays small, and posts that share one stay apart.
    """
    pair = F.struct(F.struct(*columns).alias("post"), F.col("labels").alias("labels"))
    met = labelled.groupBy(digest(columns).alias("digest")).agg(F.collect_set(pair).alias("pairs"))
    order = F.array(*[F.lit(n) for n in lexicon.dimensions]).cast(_NAMES)

    def of_post(post: Column) -> Column:
        own = F.filter("pairs", lambda p: p["post"].eqNullSafe(post))
        held = F.flatten(F.transform(own, lambda p: p["labels"]))
        return F.struct(post.alias("post"), F.filter(order, lambda n: F.array_contains(held, n)).alias("labels"))

    posts = F.array_distinct(F.transform("pairs", lambda p: p["post"]))
    return met.select(F.inline(F.transform(posts, of_post))).select("post.*", "labels")


def distinct_posts(rows: DataFrame, digest: Digest = row_digest) -> DataFrame:
    """Different rows of ``rows``. They meet by digest, each in one copy for a task; a digest keeps all that differ."""
    met = rows.groupBy(digest(rows.columns).alias("digest")).agg(F.collect_set(F.struct(*rows.columns)).alias("rows"))
    return met.select(F.inline("rows"))


def explode_labels(labelled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per post and label, with the label in ``attr``; posts without a label vanish."""
    rows = labelled.select(*columns, F.explode_outer("labels").alias("attr"))
    return rows.filter(F.col("attr").isNotNull())


def label_posts(
    posts: DataFrame,
    lexicon: Lexicon,
    content: str = "content",
    group_wildcards: bool = False,
    posts_differ: bool = False,
) -> DataFrame:
    """From posts to one row per different post and label (``attr``), in one pass over the text.

    Clauses are tagged and labelled inside the row of their post, so nothing but the posts that have
    a label is shuffled, and that only to make equal posts one. Equal posts stay apart where the
    lexicon has no objects, or where the caller knows that ``posts_differ``.
    """
    columns = posts.columns
    tagged = flag_objects(tag_posts(posts, lexicon, content), lexicon)
    if not lexicon.objects:
        return explode_labels(apply_dimensions(tagged, lexicon, group_wildcards), columns)
    tags_of = lambda clause: matched_tags(clause["text"], lexicon.tags, clause["folded"])
    cut = F.transform(folded_clauses(F.col(content)), tags_of)
    units = F.when(F.size("objects") > 0, cut).otherwise(F.array("tags"))
    per_unit = label_array(_rules(tagged, lexicon, group_wildcards, "unit"))
    labelled = tagged.withColumn("units", units).withColumn(
        "labels", F.array_distinct(F.flatten(F.expr(f"transform(units, unit -> {per_unit})")))
    )
    if posts_differ:
        return explode_labels(labelled, columns)
    some = F.filter(F.array("labels"), lambda names: F.size(names) > 0)
    kept = labelled.select(*columns, F.explode_outer(some).alias("labels")).filter(F.col("labels").isNotNull())
    return explode_labels(distinct_posts(kept), columns)
