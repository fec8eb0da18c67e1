"""Classification, audiences, sinks, the two jobs, and the shape of plans."""

import datetime
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from tagweave.operators.attrs import AttrScheme, classify_attrs
from tagweave.operators.audience import ANGLE, angle_list, audience, audience_of, scene_touch
from tagweave.operators.metrics import TABLES, TouchPointMetrics
from tagweave.plans import tagging, touch_points
from tagweave.plans.staging import Staging, staging
from tagweave.sinks.tables import align_to_target, append_metric, jdbc_write_options, replace_metric, save_orc
from tagweave.sources.lexicon import load_lexicon
from tagweave.sources.tables import jdbc_options, read_table, target_columns

SMALL = "/root/testdata/sf0.001"
POSTS = "id string, user_id string, platform_id string, attr string, categoryids array<string>, brands array<string>"
PEOPLE = "platform_id string, user_id string, people_type string, regex_rule array<string>"
RUNS = "id bigint, value string, state int"


def attrs(spark, *paths):
    return spark.createDataFrame([("1", "u", "1", p, None, None) for p in paths], POSTS)


def typed(rows):
    return sorted((r.attr_type, r.attr) for r in rows.collect())


def test_classes(spark):
    paths = ["场景.H", "场景.H.x", "TP.s", "TP.s.t", "TP内圈.A.场景A", "TP内圈.B.场景B", "other.x", "TP", "TP.a.b.c", "场景.A.x", "TP.A.x"]
    assert typed(classify_attrs(attrs(spark, *paths, "TP.s"))) == sorted(
        [
            ("sub_scene", "场景.H"), ("scene", "H"), ("sub_scene", "场景.H.x"), ("tp", "s"), ("sub_tp", "TP.s.t"),
            ("scene_A", "TP内圈.A.场景A"), ("scene_B", "TP内圈.B.场景B"), ("scene_A", "场景.A.x"), ("sub_tp", "TP.A.x"),
        ]
    )


def test_another_scheme(spark):
    rows = classify_attrs(attrs(spark, "S.h", "T.p", "in.L.x"), scheme=AttrScheme("S", "T", "L", "R"))
    assert typed(rows) == [("scene", "h"), ("scene_A", "in.L.x"), ("sub_scene", "S.h"), ("tp", "p")]


def test_runs_limit_scenes_by_last_word(spark):
    runs = [(1, "", 2), (2, "x", 4), (3, "H", 0), (4, ",,", 2), (5, None, 2), (6, "H,", 2)]
    rows = classify_attrs(attrs(spark, "场景.H", "场景.H.x", "TP.s"), spark.createDataFrame(runs, RUNS)).collect()
    scenes = {run: {r.attr for r in rows if r.data_model == run and r.attr_type == "sub_scene"} for run in range(1, 7)}
    both = {"场景.H", "场景.H.x"}
    assert scenes == {1: both, 2: {"场景.H.x"}, 3: set(), 4: set(), 5: both, 6: {"场景.H"}}
    assert {r.data_model for r in rows if r.attr_type == "tp"} == {1, 2, 4, 5, 6}


def test_only_limited_runs_drop_scenes_of_none(spark):
    runs = spark.createDataFrame([(2, "x", 4), (3, "y", 2)], RUNS)
    rows = classify_attrs(attrs(spark, "场景.H", "场景.H.x", "TP.s"), runs).collect()
    assert {(r.data_model, r.attr) for r in rows} == {(2, "场景.H.x"), (2, "H"), (2, "s"), (3, "s")}
    none = spark.createDataFrame([(4, ",", 2)], RUNS)
    assert typed(classify_attrs(attrs(spark, "场景.H", "TP.s"), none)) == [("tp", "s")]


def test_audience_gives_one_row_per_angle(spark):
    people = spark.createDataFrame([("1", "u", "a", ["N", "VIP"]), ("2", "u", "a", ["S"]), ("1", "u", "b", [])], PEOPLE)
    rows = audience(classify_attrs(attrs(spark, "TP.s", "TP.s")), people)
    assert sorted((r.people_type, r.people_angle) for r in rows.collect()) == [("a", "N"), ("a", "VIP")]
    assert audience_of(attrs(spark, "TP.s"), people, "a", "VIP").count() == 1
    assert audience_of(attrs(spark, "TP.s"), people, "a", "S").isEmpty()


def test_angles_are_listed_by_type_up_and_value_down(spark):
    people = spark.createDataFrame([("1", "u", "b", ["N"]), ("1", "v", "a", ["N", "S"]), ("1", "w", "a", ["S"])], PEOPLE)
    assert [tuple(r) for r in angle_list(people).collect()] == [("a", "S"), ("a", "N"), ("b", "N")]


def test_touch_point_side_wins_even_when_null(spark):
    rows = spark.createDataFrame(
        [
            ("a", "N", "1", "u", "1", ["1"], None, "scene", "H"),
            ("a", "N", "1", "v", "1", None, ["b"], "tp", "s"),
            ("a", "N", "2", "u", "1", ["2"], None, "scene", "H"),
            ("a", "N", "3", "w", "1", ["3"], None, "sub_tp", "TP.s.t"),
            ("a", "M", "2", "u", "1", ["4"], None, "tp", "s"),
        ],
        "people_type string, people_angle string, id string, user_id string, platform_id string, "
        "categoryids array<string>, brands array<string>, attr_type string, attr string",
    )
    found = {(r.people_angle, r.id, r.user_id, r.scene, r.tp, tuple(r.categoryids or ())) for r in scene_touch(rows, ANGLE).collect()}
    assert found == {
        ("N", "1", "v", "H", "s", ()),
        ("N", "2", "u", "H", None, ("2",)),
        ("N", "3", "w", None, "TP.s.t", ("3",)),
        ("M", "2", "u", None, "s", ("4",)),
    }


JOINED = "people_type string, people_angle string, id string, user_id string, platform_id string, categoryids array<string>, brands array<string>, attr_type string, attr string"


def joined_rows(rows):
    """The full outer join by plain loops."""
    scenes, touches, found, used = [r for r in rows if r[7] == "scene"], [r for r in rows if r[7] in ("tp", "sub_tp")], [], set()
    key = lambda r: (r[0], r[1], r[4], r[2])
    by_key = {}
    for n, t in enumerate(touches):
        by_key.setdefault(key(t), []).append(n)
    for s in scenes:
        partners = by_key.get(key(s), []) if None not in key(s) else []
        used.update(partners)
        found += [(*touches[n][:7], s[8], touches[n][8], touches[n][7]) for n in partners] or [(*s[:7], s[8], None, None)]
    found += [(*t[:7], None, t[8], t[7]) for n, t in enumerate(touches) if n not in used]
    return sorted(((*r[:5], tuple(r[5] or ()), *r[6:]) for r in found), key=repr)


def test_scenes_and_touches_of_a_large_post_are_split(spark):
    """One post, and one angle without ids, hold a third of the rows each; keys are null here and there."""
    rng = random.Random(3)
    rows = []
    for k in range(3000):
        id_ = ("hot", None, str(rng.randrange(400)))[k % 3]
        kind = rng.choice(("scene", "tp", "sub_tp", "other")) if id_ != "hot" else ("tp" if k % 100 == 0 else "scene")
        rows.append((rng.choice("aab") if k % 50 else None, "N", id_, f"u{k % 7}", rng.choice(("1", "1", "2", None)), [str(k)], None, kind, f"x{k % 90}"))
    frame = spark.createDataFrame(rows, JOINED).repartition(5)
    large = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in large}
    try:
        for name, value in large.items():
            spark.conf.set(name, value)
        found = scene_touch(frame)
        order = ["people_type", "people_angle", "id", "user_id", "platform_id", "categoryids", "brands", "scene", "tp", "attr_type"]
        result = sorted((tuple(tuple(v or ()) if n == 5 else v for n, v in enumerate(r)) for r in found.select(*order).collect()), key=repr)
        assert result == joined_rows(rows)
        found.collect()
        plan = plan_of(found)
        assert "skew=true" in plan and "FullOuter" not in plan
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_aligned_rows(spark):
    metric = spark.createDataFrame([(None, "x", None, 3), (5, None, 2, 3)], "category int, scene string, user_count bigint, data_model bigint")
    rows = align_to_target(metric, "2018-04-14", ["daterange", "data_model", "scene", "category", "user_count"])
    day = datetime.date(2018, 4, 14)
    assert [tuple(r) for r in rows.collect()] == [(day, 3, "x", 0, 0), (day, 3, None, 5, 2)]


def test_orc_table_and_append(spark):
    rows = spark.range(3).withColumn("attr", F.lit("x"))
    save_orc(rows, "labels_orc")
    save_orc(rows, "labels_orc")
    assert read_table(spark, "labels_orc", "id > 0").count() == 2
    assert target_columns(spark.table("labels_orc")) == ["id", "attr"]
    metric = spark.createDataFrame([("s", 4, 1)], "scene string, user_count bigint, data_model bigint")
    append_metric(metric, "metric_table", "2018-04-14")
    append_metric(metric, "metric_table", "2018-04-15", ["scene", "user_count", "data_model", "daterange"])
    assert spark.table("metric_table").count() == 2


def test_jdbc_options_limit_the_writers():
    options = jdbc_write_options("t", {"url": "jdbc:x", "user": "u"}, 7)
    assert options == {"url": "jdbc:x", "user": "u", "dbtable": "t", "numPartitions": "7"}


def test_staged_metrics_equal_unstaged(spark):
    inputs = fx.post_attr(spark, SMALL), fx.people(spark, SMALL), fx.special_people(spark)
    names = ["tpa_scene_data", "tpa_tp_brand_data"]
    with staging(spark) as shared:
        staged = touch_points.all_metrics(*inputs, late_angles=True, tables=names, keep=shared.keep)
        for name in names:
            own = TouchPointMetrics(*inputs, late_angles=True).table(name)
            assert own.exceptAll(staged[name]).isEmpty() and staged[name].exceptAll(own).isEmpty()


def test_metrics_job_writes_every_table(spark):
    written = {}
    inputs = fx.post_attr(spark, SMALL), fx.people(spark, SMALL), fx.special_people(spark)
    touch_points.run(*inputs, "2018-04-14", write=lambda metric, name, date: written.setdefault(name, (metric.columns, date)))
    assert set(written) == set(TABLES) and all(date == "2018-04-14" for _, date in written.values())


def test_staging_goes_with_the_job(spark, tmp_path):
    inputs = fx.post_attr(spark, SMALL), fx.people(spark, SMALL), fx.special_people(spark)
    seen = []
    write = lambda metric, name, date: seen.append(len(list(tmp_path.glob("tagweave-*"))))
    (tmp_path / "other").mkdir()
    touch_points.run(*inputs, "2018-04-14", write, str(tmp_path), late_angles=True, tables=["tpa_tp_brand_data"])
    assert seen == [1] and [p.name for p in tmp_path.iterdir()] == ["other"]
    with pytest.raises(ZeroDivisionError):
        touch_points.run(*inputs, "2018-04-14", lambda *_: 1 / 0, str(tmp_path), late_angles=True)
    assert [p.name for p in tmp_path.iterdir()] == ["other"]


def test_rows_without_a_folder_are_held_and_let_go(spark):
    rows = classify_attrs(fx.post_attr(spark, SMALL))
    shared = Staging(None)
    try:
        kept = shared.keep(rows)
        assert kept.storageLevel.useDisk and not kept.storageLevel.useMemory
        kept.count()
        names = ["tpa_scene_data", "tpa_tp_data"]
        inputs = fx.post_attr(spark, SMALL), fx.people(spark, SMALL), fx.special_people(spark)
        held = touch_points.all_metrics(*inputs, late_angles=True, tables=names, keep=shared.keep)
        for name in names:
            plan = plan_of(held[name])
            assert "InMemoryTableScan" in plan and held[name].exceptAll(TouchPointMetrics(*inputs, late_angles=True).table(name)).isEmpty()
    finally:
        shared.remove(spark)
    assert not kept.storageLevel.useDisk and not shared._held


def test_a_repeated_or_broken_job_leaves_each_metric_once(spark):
    inputs = fx.post_attr(spark, SMALL), fx.people(spark, SMALL), fx.special_people(spark)
    spark.sql("create database if not exists again")
    names = ["tpa_scene_data", "tpa_tp_brand_data"]
    write = lambda metric, name, date: replace_metric(metric, f"again.{name}", date)

    def broken(metric, name, date):
        if name == names[1]:
            raise OSError("lost")
        write(metric, name, date)

    with pytest.raises(OSError):
        touch_points.run(*inputs, "2018-04-14", broken, late_angles=True, tables=names)
    for date in ("2018-04-14", "2018-04-14", "2018-04-15"):
        touch_points.run(*inputs, date, write, late_angles=True, tables=names)
    for name in names:
        own = TouchPointMetrics(*inputs, late_angles=True).table(name).count()
        assert [tuple(r) for r in spark.table(f"again.{name}").groupBy("daterange").count().orderBy("daterange").collect()] == [
            (datetime.date(2018, 4, 14), own),
            (datetime.date(2018, 4, 15), own),
        ]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "STATIC"


def test_only_the_runs_of_a_metric_are_replaced(spark):
    metric = spark.createDataFrame([("s", 4, 1), ("s", 5, 2)], "scene string, user_count bigint, data_model bigint")
    replace_metric(metric, "replaced", "2018-04-14", form="orc")
    replace_metric(metric.filter("data_model = 2").withColumn("user_count", F.lit(9)), "replaced", "2018-04-14")
    assert sorted((r.data_model, r.user_count) for r in spark.table("replaced").collect()) == [(1, 4), (2, 9)]


def test_main_of_the_metrics_job(spark, tmp_path):
    for name, rows in (("posts", fx.post_attr(spark, SMALL)), ("people", fx.people(spark, SMALL)), ("runs", fx.special_people(spark))):
        rows.write.parquet(str(tmp_path / name))
    spark.sql("create database if not exists job")
    spark.sql("create table job.tpa_scene_data (scene string, data_model bigint, user_count bigint, daterange date) using parquet")
    paths = [x for name in ("posts", "people", "runs") for x in (f"--{name}", str(tmp_path / name))]
    touch_points.main(["2018-04-14", *paths, "--prefix", "job.", "--format", "orc", "--staging", str(tmp_path)])
    assert {t.name for t in spark.catalog.listTables("job")} == set(TABLES)
    narrow = spark.table("job.tpa_scene_data")
    assert narrow.columns == ["scene", "data_model", "user_count", "daterange"] and {r.data_model for r in narrow.collect()} == {1, 2, 4}
    assert not list(tmp_path.glob("tagweave-*"))


def test_main_of_the_tagging_job(spark, tmp_path):
    fx.posts(spark, SMALL).write.parquet(str(tmp_path / "posts"))
    fx.lexicon_rules(spark).write.parquet(str(tmp_path / "rules"))
    tagging.main(["fx1", str(tmp_path / "posts"), "labels_of_main", "--rules", str(tmp_path / "rules"), "--where", "lang = 'en'"])
    assert spark.table("labels_of_main").count() > 0


def test_jdbc_options_of_a_command_line():
    assert jdbc_options(["url=jdbc:x?a=b", "user=u"]) == {"url": "jdbc:x?a=b", "user": "u"}
    with pytest.raises(ValueError):
        jdbc_options(["url"])


def test_tagging_job(spark, tmp_path):
    fx.posts(spark, SMALL).write.parquet(str(tmp_path / "posts"))
    fx.lexicon_rules(spark).write.saveAsTable("rules")
    rules = read_table(spark, "rules")
    labels = tagging.tag_table(spark, rules, "fx1", str(tmp_path / "posts"), where="lang = 'en'", partitions=4)
    assert labels.count() > 0 and {r.lang for r in labels.select("lang").distinct().collect()} == {"en"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", TABLES)
def test_no_metric_multiplies_tables(spark, name):
    metrics = TouchPointMetrics(fx.post_attr(spark, SMALL), fx.people(spark, SMALL), fx.special_people(spark), late_angles=True)
    plan = plan_of(metrics.table(name))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    # Windows only put totals on finished counts, which stand below them.
    assert all("grain" in plan[m.start() :] and "count(" in plan[m.start() :] for m in re.finditer(r"\bWindow \[", plan))


def test_totals_share_one_pass_and_runs_come_after_counting(spark):
    metrics = TouchPointMetrics(fx.post_attr(spark, SMALL), fx.people(spark, SMALL), fx.special_people(spark), late_angles=True)
    plans = []
    for table in (metrics.scene_tp_category(), metrics.subscene()):
        table.collect()
        plans.append(plan_of(table).partition("== Initial Plan ==")[0])
    # Three grains are counted in one pass over the users, which the plan holds once; windows spread the totals.
    assert plans[0].count("Expand [") == 1 and plans[0].count("Window [") == 2
    # Printed from the top: copies for runs stand above the counts.
    assert plans[1].index("Generate explode(CASE") < plans[1].index("count(user_id")


@pytest.mark.parametrize("name, late", [("tpa_scene_data", True), ("tpa_subscene_data", True), ("tpa_tp_data", True), ("tpa_subscene_data", False)])
def test_sorted_and_split_joins_give_the_same(spark, name, late, tmp_path):
    """Without broadcasts and with every partition counted as skewed, as at a larger scale."""
    fx.post_attr(spark, SMALL).repartition(6).write.parquet(str(tmp_path / "posts"))
    # Most posts are by one user.
    posts = spark.read.parquet(str(tmp_path / "posts")).withColumn("user_id", F.expr("if(id % 3 > 0, '7', user_id)"))
    inputs = posts, fx.people(spark, SMALL), fx.special_people(spark)
    usual = sorted(map(tuple, TouchPointMetrics(*inputs, late_angles=late).table(name).collect()), key=repr)
    large = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",  # at a larger scale a step has more than one task
    }
    before = {key: spark.conf.get(key, None) for key in large}
    try:
        for key, value in large.items():
            spark.conf.set(key, value)
        split = TouchPointMetrics(*inputs, late_angles=late).table(name)
        assert sorted(map(tuple, split.collect()), key=repr) == usual
        plan = plan_of(split)
        assert "BroadcastHashJoin" not in plan
        # Rows of a person that cannot be reduced are split; elsewhere they are distinct before a join.
        assert name != "tpa_subscene_data" or "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "post_attr")
    fx.post_attr(spark, SMALL).write.parquet(path)
    metrics = TouchPointMetrics(spark.read.parquet(path), fx.people(spark, SMALL), fx.special_people(spark), late_angles=True)
    plan = plan_of(metrics.tp_brand())
    assert "StringStartsWith(attr,TP.)" in plan
    assert "ReadSchema: struct<user_id:string,platform_id:string,brands:array<string>,attr:string>" in plan


def test_staged_rows_are_read_by_class(spark, tmp_path):
    metrics = TouchPointMetrics(fx.post_attr(spark, SMALL), fx.people(spark, SMALL), late_angles=True)
    metrics.rows = Staging(str(tmp_path)).keep(metrics.rows)
    plan = plan_of(metrics.tp_brand())
    assert "PartitionFilters: [isnotnull(kind" in plan or "PartitionFilters: [(kind" in plan


def test_rule_sets_keep_their_order(spark):
    tags = {f"t{i}": str(i) for i in range(40)}
    rules = spark.createDataFrame([("a", json.dumps(tags), None, None)], "name string, tags string, dimensions string, objects string")
    assert list(load_lexicon(rules, "a").tags) == list(tags)
