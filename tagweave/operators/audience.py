"""Posts joined to the angles of the people who wrote them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.paths import n_segments

ANGLE = ["people_type", "people_angle"]
PERSON = ["platform_id", "user_id"]
POST_COLUMNS = ["id", "user_id", "platform_id", "categoryids", "brands"]
# Shares into which the posts of one person are dealt, so that no task gets all rows of a large one.
SHARES = 4


def share_of(columns: Sequence[str] = POST_COLUMNS) -> Column:
    """The share of its person that a post is dealt to, by its ``POST_COLUMNS``; posts of nobody are dealt freely."""
    post = F.xxhash64(*[c for c in POST_COLUMNS if c in columns])
    nobody = F.col("platform_id").isNull() | F.col("user_id").isNull()
    return F.when(nobody, post).otherwise(F.pmod(post, F.lit(SHARES)))


def audience(rows: DataFrame, people: DataFrame) -> DataFrame:
    """Distinct rows of ``rows`` for each angle of their author.

    Rows that lie by person and share, as those of ``classify_attrs`` do, are made distinct and joined
    where they lie: people, who are few beside their posts, are copied for each share instead.
    """
    share = "share"
    while share in rows.columns:
        share += "_"
    known = _angles(people).withColumn(share, F.explode(F.array([F.lit(n).cast("long") for n in range(SHARES)])))
    dealt = rows.withColumn(share, share_of(rows.columns)).distinct()
    return dealt.join(known, [*PERSON, share], "inner").select(*ANGLE, *rows.columns)


def _angles(people: DataFrame) -> DataFrame:
    return people.select(*PERSON, "people_type", F.explode("regex_rule").alias("people_angle")).distinct()


def angled(rows: DataFrame, people: DataFrame) -> DataFrame:
    """``rows`` for each angle of their author, repeated as they are: only the columns that are read get shuffled."""
    return rows.join(_angles(people), PERSON, "inner").select(*ANGLE, *rows.columns)


def audience_of(post_attr: DataFrame, people: DataFrame, people_type: str, angle: str) -> DataFrame:
    """Post attributes by the people of one type who hold one angle, with the length of the path."""
    held = people.filter((F.col("people_type") == people_type) & F.array_contains("regex_rule", angle))
    return post_attr.join(held, PERSON, "left_semi").select(
        "id", "user_id", "attr", "platform_id", "categoryids", "brands", n_segments("attr").alias("attr_len")
    )


def angle_list(people: DataFrame) -> DataFrame:
    """Distinct ``type_code, value`` of all people, by type and then value from last to first."""
    pairs = people.select(F.col("people_type").alias("type_code"), F.explode("regex_rule").alias("value"))
    return pairs.distinct().orderBy(F.col("type_code").asc(), F.col("value").desc())


def scene_touch(rows: DataFrame, scope: Sequence[str] = ANGLE) -> DataFrame:
    """Scenes and touch points that share a post, and those that stand alone.

    ``rows`` are classified attributes (``attr_type``, ``attr``) with the columns of ``scope``, which
    are matched together with the post. Where a touch point is found its user, categories and brands
    are taken, even if they are null; else those of the scene.

    This is a full outer join, put together from a left join and an anti join: Spark splits the rows of
    a post with a large part of all rows in both, which it can not in a full outer join. Rows without
    an id match nothing; a hash of their values stands for it, so that they do not meet in one task.
    Both joins have the same keys, so that the rows of each side are shuffled by post once for both.
    """
    keys = [*scope, "platform_id"]
    values = ["user_id", "categoryids", "brands"]
    fields = [*keys, "id", *values]
    place = F.coalesce("id", F.xxhash64(*fields).cast("string")).alias("place")
    # 0 where nothing of the match is null: other rows have a number that only their own side has. Equality that
    # takes nulls adds no filter of its own to either join.
    null = reduce(Column.__or__, [F.col(k).isNull() for k in [*keys, "id"]])
    lone = lambda side: F.when(null, side).otherwise(0).alias("lone")
    a = rows.filter(F.col("attr_type") == "scene").select(*fields, F.col("attr").alias("scene"), place, lone(1)).alias("a")
    b = rows.filter(F.col("attr_type").isin("tp", "sub_tp")).select(*fields, F.col("attr").alias("tp"), "attr_type", place, lone(2)).alias("b")
    match = [*keys, "place", "lone"]
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in match]
    alone = F.col("b.lone").isNull()
    picked = [F.when(alone, F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in fields]
    with_scenes = a.join(b, same, "left").select(*picked, "a.scene", "b.tp", "b.attr_type")
    without = b.join(a, same, "left_anti").withColumn("scene", F.lit(None).cast("string"))
    return with_scenes.unionByName(without.select(*with_scenes.columns))
