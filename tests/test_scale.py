"""Plans whose memory and shuffled bytes must not grow faster than the input."""

import re

import pytest

from pyspark.sql import functions as F

from checks import fixtures as fx
from tagweave.operators.attrs import classify_attrs
from tagweave.operators.audience import SHARES, audience, scene_touch
from tagweave.operators.metrics import KINDS, TABLES, TouchPointMetrics, user_counts
from tagweave.plans.touch_points import all_metrics, run


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _tables(spark, folder):
    spark.createDataFrame([(1, "red small ball", "BRASS", 3, "Brand#11")], "p_partkey long, p_name string, p_type string, p_size int, p_brand string").write.parquet(f"{folder}/part.parquet")
    spark.createDataFrame([(1, 1, n, "R", "O") for n in (1, 2, 3)], "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(1, 7, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")


@pytest.mark.parametrize("posts", [fx.post_attr, fx.line_posts])
def test_no_table_that_grows_is_sent_through_the_driver(spark, tmp_path, posts):
    _tables(spark, tmp_path)
    rows = posts(spark, str(tmp_path))
    assert "BroadcastExchange" not in _executed(rows)
    assert rows.count() == 3


def _posts(spark):
    paths = ["场景.home.small", "场景.home.blue", "场景.home", "TP.shop", "TP.shop.web", "TP内圈.A.场景A"]
    rows = [(str(i % 4), str(i % 4), "1", ["3"], ["3_7"], path) for i, path in enumerate(paths * 2)]
    rows += [("9", None, "1", None, None, "场景.home.small"), (None, "2", None, ["3"], None, "TP.shop")]
    return spark.createDataFrame(rows, "id string, user_id string, platform_id string, categoryids array<string>, brands array<string>, attr string")


def test_copies_for_runs_and_classes_are_not_shuffled(spark):
    """Two scenes of one parent meet in a run that names both words, without a shuffle of the copies."""
    runs = fx._literal_table(spark, [(1, "small,blue", 2), (2, "", 4)], "id bigint, value string, state int")
    typed = classify_attrs(_posts(spark), runs)
    assert not [line for line in _executed(typed).splitlines() if "Exchange hashpartitioning" in line and "attr_type" in line]
    assert typed.columns == ["data_model", "id", "user_id", "platform_id", "categoryids", "brands", "attr_type", "attr"]
    rows = [tuple(map(str, row)) for row in typed.collect()]
    assert len(rows) == len(set(rows))
    assert sum(r[0] == "1" and r[6] == "scene" and r[1] == "9" for r in rows) == 1


@pytest.mark.parametrize("name", ["tpa_scene_data", "tpa_scene_category_data", "tpa_tp_data", "tpa_subscene_data"])
def test_angles_first_takes_only_what_is_read(spark, name):
    """Rows that go to angles first carry no column a table does not read, and count once however often they repeat."""
    people = spark.createDataFrame([("1", str(n), "P", ["a", "b"]) for n in range(4)], "platform_id string, user_id string, people_type string, regex_rule array<string>")
    table = lambda rows: TouchPointMetrics(rows, people, late_angles=False).table(name)
    once, twice = table(_posts(spark)), table(_posts(spark).union(_posts(spark)))
    assert not [line for line in _executed(once).splitlines() if "Exchange" in line and "brands" in line]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect())) != []


def test_paths_of_lines_are_made_once_for_each_part(spark, tmp_path):
    _tables(spark, tmp_path)
    rows = fx.line_posts(spark, str(tmp_path))
    joined = _executed(rows.filter(F.col("attr").contains("."))).split("SortMergeJoin")[0]
    assert "concat" not in joined and "split_part" not in joined
    assert [r.attr for r in rows.orderBy("user_id").collect()] == ["TP.small", "场景.BRASS", "场景.BRASS.red"]


def test_lines_go_to_their_order_once(spark, tmp_path):
    spark.createDataFrame([(1, "red ball", "BRASS", 3, "Brand#11"), (2, "blue box", "TIN", 12, "Brand#12")], "p_partkey long, p_name string, p_type string, p_size int, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    lines = [(1, 1, 1, "R", "O"), (1, 2, 2, "A", "F"), (1, 2, 2, "A", "F"), (2, 1, 7, "N", "F"), (None, 1, 1, "R", "O"), (3, 9, 1, "R", "O")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, "1-URGENT"), (2, 8, "2-HIGH"), (None, 9, "2-HIGH")], "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    rows = fx.post_attr(spark, str(tmp_path))
    # One shuffle for the lists, which is that of their join, and none where they are not asked for.
    shuffles = lambda plan: plan.count("Exchange hashpartitioning(l_orderkey")
    assert shuffles(_executed(rows)) == 2 and shuffles(_executed(rows.select("id", "attr"))) == 1
    assert sorted(map(tuple, rows.select("id", "user_id", "platform_id", "categoryids", "brands", "attr").collect()), key=str) == [
        ("1", "7", "1", ["2", "3"], ["3_11"], "场景.BRASS"),
        ("1", "7", "1", ["2", "3"], ["3_11"], "场景.TIN.blue"),
        ("1", "7", "1", ["2", "3"], ["3_11"], "场景.TIN.blue"),
    ] + [("2", "8", "2", None, None, "TP.ball.red.deep")]


PEOPLE = [("1", str(n), "P", ["a", "b"]) for n in range(4)] + [("2", "1", "P", ["a"])]


def _people(spark):
    return spark.createDataFrame(PEOPLE, "platform_id string, user_id string, people_type string, regex_rule array<string>")


def test_a_job_keeps_only_classes_that_its_tables_read(spark):
    kept = []
    keep = lambda rows: kept.append({r.kind for r in rows.select("kind").collect()}) or rows
    part = all_metrics(_posts(spark), _people(spark), tables=["tpa_tp_brand_data"], keep=keep)
    assert kept == [{"tp"}] and list(part) == ["tpa_tp_brand_data"]
    assert set(KINDS) == set(TABLES)


@pytest.mark.parametrize("name", list(TABLES))
def test_a_table_is_the_same_alone_as_among_all(spark, name):
    of = lambda tables: all_metrics(_posts(spark), _people(spark), late_angles=True, tables=tables)[name]
    assert sorted(map(str, of([name]).collect())) == sorted(map(str, of(tuple(TABLES)).collect()))


def _without(spark, **settings):
    """Settings for a test, and what they were."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return before


STATIC = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}


def test_an_audience_takes_classed_rows_where_they_lie(spark):
    """Classed rows are shuffled once, by person and share; to be distinct and to meet people they stay there."""
    people = _people(spark).union(_people(spark).limit(1))
    before = _without(spark, **STATIC)
    try:
        found = audience(classify_attrs(_posts(spark)), people)
        shuffles = [line for line in _executed(found).splitlines() if "Exchange hashpartitioning" in line]
        assert sum("categoryids" in line or "attr" in line for line in shuffles) == 1
        rows = [tuple(map(str, row)) for row in found.collect()]
        assert len(rows) == len(set(rows)) > 0 and "share" not in found.columns
        # Shares are by post, and people are there for each of them; posts of nobody have no angle.
        many = spark.range(200).selectExpr("cast(id as string) id", "'1' user_id", "'1' platform_id", "array('3') categoryids", "cast(null as array<string>) brands", "'TP.shop' attr", "id share")
        nobody = many.withColumn("user_id", F.lit(None).cast("string"))
        posts = many.union(nobody)
        assert audience(posts, people).count() == 400 and SHARES > 1
        assert audience(posts, people).columns == ["people_type", "people_angle", *posts.columns]
        assert audience(posts.select("platform_id", "user_id"), people).count() == 2
    finally:
        _without(spark, **before)


def test_scenes_and_touches_go_to_their_post_once(spark):
    """The left and the anti join share the rows of touch points, and the angles that both sides are made of."""
    before = _without(spark, **STATIC)
    try:
        found = scene_touch(audience(classify_attrs(_posts(spark)), _people(spark)))
        lines = _executed(found).splitlines()
        assert sum("Exchange hashpartitioning" in line and "place" in line and "Reused" not in line for line in lines) == 3
        assert sum("Exchange hashpartitioning" in line and "CASE WHEN" in line and "Reused" not in line and "place" not in line for line in lines) == 1
        assert sum(r.scene is not None and r.tp is not None for r in found.collect()) > 0
    finally:
        _without(spark, **before)


def test_lines_go_to_their_order_with_one_path(spark, tmp_path):
    """What a line of a post takes along is its own path, not all paths of its part; a null category stays one in its list."""
    parts = [(1, "red ball", "BRASS", None, "Brand#11"), (2, "blue box", "TIN", 12, "Brand#12")]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_type string, p_size int, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    lines = [(1, 1, 1, "R", "O"), (1, 2, 2, "N", "F"), (1, 2, 3, None, None), (None, 1, 1, "R", "O")]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_linenumber int, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, "1-URGENT")], "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    rows = fx.line_posts(spark, str(tmp_path))
    above = _executed(rows).split("SortMergeJoin [l_orderkey")[1].split("SortMergeJoin [l_partkey")[0]
    project = [line for line in above.splitlines() if "Project" in line and "l_orderkey" in line]
    assert project and not any(re.search(r"paths#\d+[,\]]", line) for line in project)
    assert sorted((r.user_id, r.categoryids, r.brands, r.attr) for r in rows.collect()) == [
        ("7", None, None, "TP.box"), ("8", [None], ["11"], "场景.BRASS"), ("9", None, None, "场景.TIN.blue")
    ]


def test_users_are_counted_from_rows_beside_their_like(spark):
    """Rows are sorted by group before they are copied for grains and shuffled, and counts are those of sets."""
    rows = [(str(n % 7), "ab"[n % 2], str(n % 3) if n % 5 else None) for n in range(200)]
    facts = spark.createDataFrame(rows, "user_id string, scene string, category string").repartition(5)
    counts = user_counts(facts, ["scene", "category"], totals={"all_users": (["category"], None)})
    plan = _executed(counts)
    assert plan.index("Expand [") < plan.index("Sort [scene")
    of = lambda scene, category: len({u for u, s, c in rows if c == category and scene in (s, None)})
    assert {(r.scene, r.category, r.user_count, r.all_users) for r in counts.collect()} == {
        (s, c, of(s, c), of(None, c) if c else 0) for _, s, c in rows
    }


def test_shuffle_files_of_a_metric_go_when_it_is_written(spark):
    files = lambda: {b.toString() for b in _listed(spark) if b.isShuffle()}
    held, at = files(), []
    write = lambda metric, name, date: (metric.write.format("noop").mode("overwrite").save(), at.append(len(files() - held)))
    run(_posts(spark), _people(spark), None, "2018-04-14", write, tables=["tpa_scene_data", "tpa_scene_tp_category_data"])
    assert at == [0, 0]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def _listed(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return [blocks.apply(n) for n in range(blocks.size())]
