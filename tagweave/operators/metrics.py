"""The eleven tables of exact distinct-user counts by scene, touch point, category and brand.

How a table is computed: rows of a post are matched first, then reduced to the distinct facts of a
person, and only then joined to the angles of that person, since a count of users does not need the
posts any more. Facts of one person are few however many posts there are, so neither the angles nor
a person who wrote a large part of all posts multiplies the data.

That order is exact as long as a post has one author and nobody has a null type or angle. For other
data (``late_angles=False``) rows are joined to angles first and matched within the angle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.functions.paths import brand_of, category_of, segment
from tagweave.operators.attrs import AttrScheme, classed_rows
from tagweave.operators.audience import ANGLE, PERSON, angled
from tagweave.sources.runs import RUN, Runs, holds, keys_of

POST = ["platform_id", "id"]


def _angled() -> Column:
    return F.col("people_type").isNotNull() & F.col("people_angle").isNotNull()


def may_join_late(rows: DataFrame, people: DataFrame, own_ids: bool = False) -> bool:
    """Whether every post (``platform_id, id``) of ``rows`` is by one user and no type or angle is null.

    Two jobs that need no more than the names of posts and authors. Where ids are known to be of one
    person (``own_ids``), so are posts, and one job is enough.
    """
    unnamed = F.col("people_type").isNull() | F.exists("regex_rule", lambda angle: angle.isNull())
    if not people.filter(unnamed).isEmpty():
        return False
    if own_ids:
        return True
    ids = rows.filter(F.col("id").isNotNull() & F.col("platform_id").isNotNull())
    authors = ids.groupBy(*POST).agg(F.min("user_id").alias("first"), F.max("user_id").alias("last"))
    return authors.filter(F.col("first") != F.col("last")).isEmpty()


def ids_have_one_author(rows: DataFrame) -> bool:
    """Whether each post id is by one user of one platform. Then so is every post. One job over names."""
    named = rows.filter(F.col("id").isNotNull() & F.col("platform_id").isNotNull() & F.col("user_id").isNotNull())
    person = F.struct(*PERSON)
    authors = named.groupBy("id").agg(F.min(person).alias("first"), F.max(person).alias("last"))
    return authors.filter(F.col("first") != F.col("last")).isEmpty()


class TouchPointMetrics:
    """Metrics of ``post_attr`` for the angles of ``people``, for all pending runs in one plan.

    ``post_attr``: id, user_id, platform_id, attr, categoryids, brands (the last two arrays).
    ``people``: platform_id, user_id, people_type, regex_rule (array of angles).
    ``special_people``: id, value, state; without it there is one run, 0, over all scenes.
    ``late_angles``: whether angles are joined last; when not given it is looked up if they may be,
    over the rows that count.
    ``own_ids``: whether each post id is by one user of one platform, which lets posts be counted for
    each person and summed; when not given it is looked up where it is asked.
    ``keep``: applied to shared rows before anything is made of them, as to write them once.
    ``lists_of_post``: whether the caller knows that all rows of a post hold the same categories and
    brands, which saves a join where they would be taken from the touch point.
    ``tables``: the tables that will be asked for; rows of classes that none of them reads are left out.

    Every table has ``data_model``, ``people_type`` and ``people_angle`` among its keys.
    """

    def __init__(
        self,
        post_attr: DataFrame,
        people: DataFrame,
        special_people: DataFrame | None = None,
        scheme: AttrScheme = AttrScheme(),
        late_angles: bool | None = None,
        lists_of_post: bool = False,
        keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
        own_ids: bool | None = None,
        tables: Iterable[str] | None = None,
    ):
        self.scheme = scheme
        self.runs = Runs(special_people)
        self.people = people.select(*PERSON, "people_type", "regex_rule")
        self.lists_of_post = lists_of_post
        rows = classed_rows(post_attr, self.runs, scheme)
        if tables is not None:
            rows = rows.filter(F.col("kind").isin(sorted({kind for name in tables for kind in KINDS[name]})))
        rows = keep(rows)
        if late_angles is None:
            own_ids = ids_have_one_author(rows) if own_ids is None else own_ids
            late_angles = may_join_late(rows, people, own_ids)
        self.late_angles = late_angles
        if self.late_angles:
            # The author belongs to the post, so it may be part of the match.
            self.match, self.who, self.rows = [*POST, "user_id"], PERSON, rows
        else:
            self.match, self.who, self.rows = [*ANGLE, *POST], [*ANGLE, "user_id"], keep(angled(rows, people))
        self._own_ids = own_ids

    @property
    def own_ids(self) -> bool:
        if self._own_ids is None:
            self._own_ids = ids_have_one_author(self.rows)
        return self._own_ids

    def table(self, name: str) -> DataFrame:
        return TABLES[name](self)

    # ---- rows by class -------------------------------------------------------------------------

    def _scenes(self) -> DataFrame:
        scenes = self.rows.filter((F.col("kind") == "scene") & self.scheme.is_scene(F.col("attr")))
        return scenes.withColumn("scene", segment("attr", 1))

    def _touches(self, *kinds: str) -> DataFrame:
        touches = self.rows.filter(F.col("kind").isin(*kinds) & self.scheme.is_touch(F.col("attr")))
        sub = F.col("kind") == "sub_tp"
        return touches.withColumns(
            {
                "parent_tp": F.when(sub, segment("attr", 1)).otherwise("self"),
                "tp": F.when(sub, segment("attr", 2)).otherwise(segment("attr", 1)),
            }
        )

    # ---- from rows of posts to users of angles -------------------------------------------------

    def _of_users(self, facts: DataFrame) -> DataFrame:
        """Distinct facts of persons, as facts of the users of each angle. May repeat a user."""
        facts = facts.distinct()
        return self._to_angles(facts) if self.late_angles else facts

    def _to_angles(self, facts: DataFrame) -> DataFrame:
        """Facts of a person, keyed by PERSON, for each angle of that person."""
        joined = facts.join(self.people, PERSON, "inner").withColumn("people_angle", F.explode("regex_rule"))
        return joined.drop("regex_rule", "platform_id")

    def _by_run(self, facts: DataFrame) -> DataFrame:
        return self.runs.copies(facts)

    # ---- tables --------------------------------------------------------------------------------

    def scene(self) -> DataFrame:
        """By scene: users, users with a touch point or inside track on the same post, users of all scenes."""
        return self._scene_reach([])

    def scene_category(self) -> DataFrame:
        """As ``scene``, for each category of the post."""
        reach = self._scene_reach(["category"])
        return reach.withColumn("category", F.col("category").try_cast("int"))

    def _scene_reach(self, category: list[str]) -> DataFrame:
        flags = ["counted", "has_tp", "in_a", "in_b", "of_scene"]
        facts = self._reach_facts(category)
        facts = facts.groupBy(*[c for c in facts.columns if c not in flags]).agg(*_any(flags))
        if self.late_angles:
            facts = self._to_angles(facts)
        # Counts of inside tracks are matched by category as well.
        for name in category:
            facts = facts.withColumns({c: F.col(c) & F.col(name).isNotNull() for c in ("in_a", "in_b")})
        whole = [RUN, *ANGLE, *category]
        measures = {
            "user_count": F.col("counted"),
            "tp_user": F.col("has_tp"),
            "inside_track_user": F.col("in_a") | F.col("in_b"),
            "inside_track_A_user": F.col("in_a"),
            "inside_track_B_user": F.col("in_b"),
        }
        totals = {"all_scene_user": (whole, F.col("of_scene"))}
        return user_counts(facts, [*whole, "scene"], flags, measures, totals).filter(F.col("user_count") > 0)

    def _reach_facts(self, category: list[str]) -> DataFrame:
        """Who is reached by a scene, by run, with flags for what else is on the post.

        The user, and the categories, of a scene with a touch point are those of the touch point;
        inside tracks and the total of all scenes go by the user and the categories of the scene.
        """
        values = ["user_id", *(["categoryids"] if category else [])]
        same = [*self.match, *(["categoryids"] if self.lists_of_post else [])]
        picked = [c for c in values if c not in same]
        columns = list(dict.fromkeys([*self.who, *values]))
        rest = self.rows.filter(F.col("kind") != "scene")
        marks = rest.groupBy(*self.match).agg(
            F.bool_or(F.col("kind").isin("tp", "sub_tp")).alias("has_tp"),
            *keys_of(F.col("kind") == "scene_A", "a"),
            *keys_of(F.col("kind") == "scene_B", "b"),
        )
        wanted = dict.fromkeys([*self.match, *values, "run_key", "scene"])
        # Distinct before the join, so that a post has no more rows than it has different scenes.
        joined = self._scenes().select(*wanted).distinct().join(marks, self.match, "left")
        if picked:
            sides = self._touches("tp", "sub_tp").select(*self.match, *[F.col(c).alias(f"tp_{c}") for c in picked])
            joined = joined.join(sides.distinct(), self.match, "left")
        copies = self.runs.copies(joined, details=True)
        joined = copies.withColumns({"has_tp": F.coalesce("has_tp", F.lit(False)), "in_a": holds("a"), "in_b": holds("b")})
        yes, no = F.lit(True), F.lit(False)
        if picked:
            pick = {c: F.when(F.col("has_tp"), F.col(f"tp_{c}")).otherwise(F.col(c)) if c in picked else F.col(c) for c in values}
            equal = _all([pick[c].eqNullSafe(F.col(c)) for c in picked])
            own = lambda counted, tp: _fact({c: F.col(c) for c in values}, counted, tp, F.col("in_a"), F.col("in_b"), yes)
            other = _fact(pick, yes, F.col("has_tp"), no, no, no)
            facts = F.when(equal, F.array(own(yes, F.col("has_tp")))).otherwise(F.array(other, own(no, no)))
            joined = joined.withColumn("fact", F.explode(facts)).drop(*values, "has_tp", "in_a", "in_b").select("*", "fact.*")
        else:
            joined = joined.withColumns({"counted": yes, "of_scene": yes})
        facts = joined.select(RUN, *columns, "scene", "counted", "has_tp", "in_a", "in_b", "of_scene")
        return facts.withColumn("category", F.explode("categoryids")).drop("categoryids") if category else facts

    def scene_brand(self) -> DataFrame:
        """By scene, category and brand: users; users of all brands of the category."""
        brands = _brand_codes(self._scenes().select(*self.who, "run_key", "scene", "brands"))
        return _brand_share(self._by_run(self._of_users(brands)), ["scene", "category"])

    def subscene(self, need_child: bool = False) -> DataFrame:
        """By scene path: users and posts. Posts tagged with the parent only have a null ``scene``,
        unless ``need_child`` leaves them out."""
        return self._subscenes([], need_child)

    def subscene_category(self, need_child: bool = False) -> DataFrame:
        """As ``subscene``, for each category of the post."""
        table = self._subscenes(["category"], need_child)
        return table.withColumn("category", F.col("category").try_cast("int"))

    def _subscenes(self, category: list[str], need_child: bool) -> DataFrame:
        scenes = self._scenes()
        if need_child:
            scenes = scenes.filter(segment("attr", 2).isNotNull())
        if category:
            scenes = scenes.withColumn("category", F.explode("categoryids"))
        path = ["run_key", "attr", *category]
        if self.late_angles and self.own_ids:
            counts = self._posts_of_persons(scenes, path)
        else:
            # An id may be of several persons, so posts stay until the end.
            facts = scenes.select(*self.who, "id", *path)
            facts = self._to_angles(facts) if self.late_angles else facts
            counts = facts.groupBy(*ANGLE, *path).agg(
                F.countDistinct("user_id").alias("user_count"), F.countDistinct("id").alias("id_count")
            )
        # The runs of a row hang on its path alone, so finished counts are copied for them.
        counts = self._by_run(counts)
        named = counts.withColumns({"parent_scene": segment("attr", 1), "scene": segment("attr", 2)})
        return named.select(RUN, *ANGLE, "parent_scene", "scene", *category, "user_count", "id_count")

    def _posts_of_persons(self, scenes: DataFrame, path: list[str]) -> DataFrame:
        """Users and posts by angle and path, where a post id is of one person.

        Posts are counted for each person, and these counts are summed: no post is copied for an angle.
        """
        persons = scenes.groupBy(*PERSON, *path).agg(F.countDistinct("id").alias("ids"))
        # Rows that repeat an angle of a person would add the posts again.
        known = self.people.select(*PERSON, "people_type", F.explode("regex_rule").alias("people_angle")).distinct()
        users = persons.join(known, PERSON, "inner").groupBy(*ANGLE, *path, "user_id").agg(F.sum("ids").alias("ids"))
        return users.groupBy(*ANGLE, *path).agg(F.count("user_id").alias("user_count"), F.sum("ids").alias("id_count"))

    def _pairs(self, kinds: Sequence[str], values: Sequence[str]) -> DataFrame:
        """Distinct ``run_key, scene, parent_tp, tp`` that share a post, with its user.

        ``values`` are columns of the touch point. Both sides are distinct before they meet, so a
        post gives no more pairs than it has different scenes and touch points.
        """
        scenes = self._scenes().select(*self.match, "run_key", "scene").distinct()
        wanted = dict.fromkeys([*self.match, "user_id", "parent_tp", "tp", *values])
        return scenes.join(self._touches(*kinds).select(*wanted).distinct(), self.match, "inner")

    def _pair_users(self, pairs: DataFrame) -> DataFrame:
        return self._by_run(self._of_users(pairs))

    def scene_tp(self) -> DataFrame:
        """By scene and touch point of the same post: users."""
        pairs = self._pairs(["tp", "sub_tp"], []).select(*self.who, "run_key", "scene", "parent_tp", "tp")
        return user_counts(self._pair_users(pairs), [RUN, *ANGLE, "scene", "parent_tp", "tp"])

    def scene_tp_category(self) -> DataFrame:
        """As ``scene_tp`` for each category, with the users of the scene and of the touch point in it."""
        pairs = self._pairs(["tp", "sub_tp"], ["categoryids"]).withColumn("category", F.explode("categoryids"))
        users = self._pair_users(pairs.select(*self.who, "run_key", "scene", "parent_tp", "tp", "category"))
        totals = {
            "tp_user_count": ([RUN, *ANGLE, "scene", "category"], None),
            "scene_user_count": ([RUN, *ANGLE, "parent_tp", "tp", "category"], None),
        }
        counts = user_counts(users, [RUN, *ANGLE, "scene", "parent_tp", "tp", "category"], totals=totals)
        return counts.withColumn("category", F.col("category").try_cast("int"))

    def scene_tp_brand(self) -> DataFrame:
        """By scene, touch point, category and brand: users; users of all brands of the category."""
        pairs = _brand_codes(self._pairs(["tp"], ["brands"]))
        facts = pairs.select(*self.who, "run_key", "scene", "tp", "category", "brand")
        return _brand_share(self._pair_users(facts), ["scene", "tp", "category"])

    def tp(self) -> DataFrame:
        """By touch point: users, users with a scene on the same post, users of all touch points.

        Only the middle one depends on the run; the others are counted once for all runs.
        """
        scened = self._by_run(self._scenes().select(*self.match, "run_key")).distinct()
        wanted = dict.fromkeys([*self.match, "user_id", "tp"])
        touches = self._touches("tp").select(*wanted).distinct().join(scened, self.match, "left")
        users = self._of_users(touches.select(*self.who, "tp", RUN))
        keys = [*ANGLE, "tp"]
        grains = [keys, ANGLE, [*keys, RUN]]
        counts = grain_counts(users, [*keys, RUN], grains)
        of_tp, of_all, of_run = grain_ids([*keys, RUN], grains)
        own = counts.withColumn("tp_all_user", _total(of_tp, of_all, ANGLE, "user_count")).filter(F.col("of") == of_tp)
        table = self.runs.stamp(own.select(*keys, "user_count", "tp_all_user"))
        scened = counts.filter((F.col("of") == of_run) & F.col(RUN).isNotNull())
        scened = scened.select(*[F.col(c).alias(f"{c}_") for c in [RUN, *keys]], F.col("user_count").alias("scene_user"))
        same = _all([F.col(c).eqNullSafe(F.col(f"{c}_")) for c in [RUN, *keys]])
        table = table.join(scened, same, "left").fillna(0, subset=["scene_user"])
        return table.select(RUN, *keys, "scene_user", "user_count", "tp_all_user")

    def tp_brand(self) -> DataFrame:
        """By touch point, category and brand: users."""
        brands = _brand_codes(self._touches("tp").select(*self.who, "tp", "brands"))
        return self.runs.stamp(user_counts(self._of_users(brands), [*ANGLE, "tp", "category", "brand"]))

    def tp_category(self) -> DataFrame:
        """By category and touch point: users by category, users by brand, users of the category."""
        fact = lambda category, by_category: F.struct(
            category.alias("category"), F.lit(by_category).alias("by_category"), F.lit(not by_category).alias("by_brand")
        )
        none = F.array().cast("array<struct<category:int,by_category:boolean,by_brand:boolean>>")
        facts = F.concat(
            F.coalesce(F.transform("categoryids", lambda c: fact(c.try_cast("int"), True)), none),
            F.coalesce(F.transform("brands", lambda b: fact(category_of(b), False)), none),
        )
        touches = self._touches("tp").select(*self.who, "tp", F.explode(facts).alias("fact"))
        users = self._of_users(touches.select(*self.who, "tp", "fact.*"))
        whole = [*ANGLE, "category"]
        measures = {
            "user_count": F.col("by_category"),
            # Brands are matched to the rows of the categories, which null keys never are.
            "brand_all_user": F.col("by_brand") & F.col("category").isNotNull() & _angled(),
        }
        totals = {"tp_all_user": (whole, F.col("by_category"))}
        counts = user_counts(users, [*whole, "tp"], ["by_category", "by_brand"], measures, totals)
        return self.runs.stamp(counts.filter(F.col("user_count") > 0))


# Names of the eleven target tables.
TABLES: dict[str, Callable[[TouchPointMetrics], DataFrame]] = {
    "tpa_scene_data": TouchPointMetrics.scene,
    "tpa_scene_category_data": TouchPointMetrics.scene_category,
    "tpa_scene_brand_data": TouchPointMetrics.scene_brand,
    "tpa_subscene_data": TouchPointMetrics.subscene,
    "tpa_subscene_category_data": TouchPointMetrics.subscene_category,
    "tpa_scene_tp_data": TouchPointMetrics.scene_tp,
    "tpa_scene_tp_category_data": TouchPointMetrics.scene_tp_category,
    "tpa_scene_tp_brand_data": TouchPointMetrics.scene_tp_brand,
    "tpa_tp_data": TouchPointMetrics.tp,
    "tpa_tp_brand_data": TouchPointMetrics.tp_brand,
    "tpa_tp_category_data": TouchPointMetrics.tp_category,
}


# Classes of the rows that each table reads.
_TP, _TPS = ("tp",), ("tp", "sub_tp")
KINDS: dict[str, tuple[str, ...]] = {
    "tpa_scene_data": ("scene", *_TPS, "scene_A", "scene_B"),
    "tpa_scene_category_data": ("scene", *_TPS, "scene_A", "scene_B"),
    "tpa_scene_brand_data": ("scene",),
    "tpa_subscene_data": ("scene",),
    "tpa_subscene_category_data": ("scene",),
    "tpa_scene_tp_data": ("scene", *_TPS),
    "tpa_scene_tp_category_data": ("scene", *_TPS),
    "tpa_scene_tp_brand_data": ("scene", *_TP),
    "tpa_tp_data": ("scene", *_TP),
    "tpa_tp_brand_data": _TP,
    "tpa_tp_category_data": _TP,
}


def _brand_codes(rows: DataFrame) -> DataFrame:
    """``brands`` as one row per brand with int ``category`` and ``brand``."""
    codes = rows.withColumn("code", F.explode("brands")).drop("brands")
    return codes.withColumns({"category": category_of("code"), "brand": brand_of("code")}).drop("code")


def _any(flags: Sequence[str]) -> list[Column]:
    return [F.bool_or(c).alias(c) for c in flags]


def _all(conditions: Sequence[Column]) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def _fact(values: dict[str, Column], counted: Column, has_tp: Column, in_a: Column, in_b: Column, of_scene: Column) -> Column:
    flags = {"counted": counted, "has_tp": has_tp, "in_a": in_a, "in_b": in_b, "of_scene": of_scene}
    return F.struct(*[column.alias(name) for name, column in {**values, **flags}.items()])


# ---- distinct users at several grains ----------------------------------------------------------

Total = tuple[Sequence[str], Column | None]


def grain_ids(keys: Sequence[str], grains: Sequence[Sequence[str]]) -> list[int]:
    """Spark's ``grouping_id`` over ``keys`` and the user, for each grain: one bit per key left out."""
    columns = [*keys, "user_id"]
    top = len(columns) - 1
    return [sum(1 << (top - i) for i, c in enumerate(columns[:-1]) if c not in grain) for grain in grains]


def grain_counts(
    facts: DataFrame,
    keys: Sequence[str],
    grains: Sequence[Sequence[str]],
    flags: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
) -> DataFrame:
    """Distinct users by each of several subsets of ``keys``, in one pass over ``facts``.

    Rows are first made one per user and grain, which Spark begins before the shuffle, then counted:
    a large group is spread over its users. Rows of one group lie beside each other on their way, where
    they take about half the bytes. ``measures`` count the users for whom a condition on the
    ``flags`` holds; a flag holds for a user if any of the rows has it.
    """
    sets = [[*grain, "user_id"] for grain in grains]
    per_user = facts.sortWithinPartitions(*keys).groupingSets(sets, *keys, "user_id").agg(F.grouping_id().alias("grain"), *_any(flags))
    measures = measures or {"user_count": F.lit(True)}
    # As an aggregate the grain is known only after counting, so that a filter on it leaves all grains
    # to one pass over the facts, which Spark then runs once for all that read it.
    return per_user.groupBy(*keys, "grain").agg(*[F.count_if(m).alias(name) for name, m in measures.items()], F.max("grain").alias("of"))


def _total(fine: int, coarse: int, of: Sequence[str], measure: str) -> Column:
    """For rows of the grain ``fine``: a measure of their row in the grain ``coarse``, whose keys are ``of``.

    It is 0 where one of these keys is null. Counts of all grains are one finished table with as many
    rows as there are names, and a window over the keys takes the total from its row to the others; so
    the counts are planned and worked out once, however many totals are taken from them.
    """
    alike = Window.partitionBy(*of, F.col("of").isin(fine, coarse))
    total = F.max(F.when(F.col("of") == coarse, F.col(measure))).over(alike)
    known = _all([F.col(k).isNotNull() for k in of])
    return F.when(known, F.coalesce(total, F.lit(0))).otherwise(0)


def user_counts(
    facts: DataFrame,
    keys: Sequence[str],
    flags: Sequence[str] = (),
    measures: dict[str, Column] | None = None,
    totals: dict[str, Total] | None = None,
) -> DataFrame:
    """Distinct users by ``keys``, with totals at coarser keys on every row.

    A total is its keys and the condition its users meet. Rows with a null among the keys of a total
    have 0 for it.
    """
    measures = measures or {"user_count": F.lit(True)}
    if not totals:
        return facts.groupBy(*keys).agg(F.countDistinct("user_id").alias("user_count"))
    grains = [keys, *[of for of, _ in totals.values()]]
    conditions = {name: F.lit(True) if condition is None else condition for name, (_, condition) in totals.items()}
    counts = grain_counts(facts, keys, grains, flags, {**measures, **conditions})
    fine, *coarse = grain_ids(keys, grains)
    for (name, (of, _)), grain in zip(totals.items(), coarse):
        counts = counts.withColumn(f"total {name}", _total(fine, grain, of, name))
    return counts.filter(F.col("of") == fine).select(*keys, *measures, *[F.col(f"total {name}").alias(name) for name in totals])


def _brand_share(users: DataFrame, names: list[str]) -> DataFrame:
    whole = [RUN, *ANGLE, *names]
    return user_counts(users, [*whole, "brand"], totals={"brand_all_user": (whole, None)})
