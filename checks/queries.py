"""One query per unit of the operator inventory, over the test tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from tagweave.functions.paths import piece
from tagweave.operators.attrs import classify_attrs
from tagweave.operators.audience import ANGLE, angle_list, audience, audience_of, scene_touch
from tagweave.operators.metrics import TABLES, TouchPointMetrics
from tagweave.operators.tagging import (
    apply_dimensions,
    combine_clauses,
    explode_labels,
    flag_objects,
    label_posts,
    retag_clauses,
    tag_columns,
    tag_posts,
)
from tagweave.plans.tagging import tag_table
from tagweave.plans.touch_points import run
from tagweave.sinks.tables import align_to_target, append_metric, replace_metric, save_orc
from tagweave.sources.lexicon import lexicon_entries, load_lexicon
from tagweave.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _joined(rows: DataFrame) -> DataFrame:
    """Array columns as text, so that results compare by value."""
    joined = rows.withColumn("categories", F.array_join("categoryids", ","))
    return joined.withColumn("brands", F.array_join("brands", ",")).drop("categoryids")


def _audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audience(classify_attrs(fx.post_attr(spark, sf_dir)), fx.people(spark, sf_dir))


def _metric(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        # An order has one customer, one priority and one list of categories and of brands, hence so has a post.
        inputs = fx.post_attr(spark, sf_dir), fx.people(spark, sf_dir), fx.special_people(spark)
        return TouchPointMetrics(*inputs, late_angles=True, lists_of_post=True, own_ids=True).table(name)

    return query


def _job_metric(name: str) -> Query:
    """A metric as the job makes it for posts whose rows differ in author and lists: angles first."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        inputs = fx.line_posts(spark, sf_dir), fx.people(spark, sf_dir), fx.special_people(spark)
        return TouchPointMetrics(*inputs, late_angles=False).table(name)

    return query


def _scene_touch_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = audience(classify_attrs(fx.line_posts(spark, sf_dir)), fx.people(spark, sf_dir))
    return _joined(scene_touch(rows, ["data_model", *ANGLE])).drop("data_model")


def _orc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the tagging job written as an ORC table, and read back with a filter and spread by id."""
    name = f"labels_{uuid.uuid4().hex}"
    labels = tag_table(spark, fx.lexicon_rules(spark), "fx1", f"{sf_dir}/documents.parquet", rename={"doc_id": "id", "text": "content"})
    save_orc(labels.select("id", "attr", "lang"), name)
    return read_table(spark, name, "lang <> 'de'").repartition(4, "id").select("id", "attr")


def _appended_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric appended for two dates to a table with fewer columns, and read back for one of them."""
    name = f"metric_{uuid.uuid4().hex}"
    spark.sql(f"create table {name} (scene string, user_count bigint, people_angle string, people_type string, data_model bigint, daterange date) using parquet")
    metric = _metric("tpa_scene_data")(spark, sf_dir)
    for date in ("2018-04-14", "2018-05-14"):
        append_metric(metric, name, date)
    return read_table(spark, name, "daterange = date '2018-05-14'")


def _replaced_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metric written for two dates, and for one of them again, as by a job that is repeated."""
    name = f"metric_{uuid.uuid4().hex}"
    metric = _metric("tpa_tp_data")(spark, sf_dir)
    for date in ("2018-04-14", "2018-05-14", "2018-04-14"):
        replace_metric(metric, name, date)
    return read_table(spark, name)


def _metrics_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job as it is run by default, and in part again: rows and users of its eleven tables by run and type.

    Nothing is stated of the input, so the order of joins is looked up, and all tables start from rows
    that are kept once and let go at the end.
    """
    prefix = f"job_{uuid.uuid4().hex}_"
    inputs = fx.post_attr(spark, sf_dir), fx.people(spark, sf_dir), fx.special_people(spark)
    for tables in (tuple(TABLES), ("tpa_tp_brand_data",)):
        run(*inputs, "2018-04-14", lambda metric, name, date: replace_metric(metric, prefix + name, date), tables=tables)
    counts = [
        read_table(spark, prefix + name).groupBy("data_model", "people_type")
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum("user_count").alias("users"))
        .withColumn("metric", F.lit(name))
        for name in TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def _classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(classify_attrs(fx.post_attr(spark, sf_dir)))


def _special_people_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify_attrs(fx.post_attr(spark, sf_dir), fx.special_people(spark))
    return rows.drop("categoryids", "brands")


def _audience_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(audience_of(fx.post_attr(spark, sf_dir), fx.people(spark, sf_dir), "BUILDING", "VIP"))


def _scene_touch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(scene_touch(_audience(spark, sf_dir), ["data_model", *ANGLE])).drop("data_model")


def _metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    metric = _metric("tpa_scene_category_data")(spark, sf_dir)
    columns = ["category", "scene", "user_count", "tp_user", "all_scene_user", *ANGLE, "daterange", "data_model"]
    return align_to_target(metric, "2018-04-14", columns)


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_posts(fx.posts(spark, sf_dir), fx.FX1)


def _tag_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = _tagged(spark, sf_dir).select("id", F.explode_outer("tags").alias("tag"))
    return tags.filter(F.col("tag").isNotNull())


def _tag_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_objects(_tagged(spark, sf_dir), fx.FX1)
    objects = flagged.select("id", F.explode_outer("objects").alias("object"), F.size("tags").cast("bigint").alias("tag_count"))
    return objects.filter(F.col("object").isNotNull())


def _word_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of a lexicon of thousands, through its index: posts of each tag, the first and the last of them."""
    lexicon = load_lexicon(fx.word_lexicon_rules(spark, sf_dir), "words")
    tags = tag_posts(fx.posts(spark, sf_dir), lexicon).select("id", F.explode_outer("tags").alias("tag")).filter(F.col("tag").isNotNull())
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("post_count"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def _retag_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    clauses = retag_clauses(flag_objects(_tagged(spark, sf_dir), fx.FX1), fx.FX1)
    tags = clauses.select("id", F.explode_outer("tags").alias("tag")).filter(F.col("tag").isNotNull())
    return tags.groupBy("id", "tag").agg(F.count(F.lit(1)).alias("clause_count"))


def _dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = apply_dimensions(_tagged(spark, sf_dir), fx.FX1).select("id", F.explode_outer("labels").alias("attr"))
    return labels.filter(F.col("attr").isNotNull())


def _post_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = load_lexicon(fx.lexicon_rules(spark), "fx1")
    return label_posts(fx.posts(spark, sf_dir), lexicon).select("id", "attr")


def _combined_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of posts by the steps one after another, clauses as rows of their own."""
    clauses = retag_clauses(flag_objects(_tagged(spark, sf_dir), fx.FX1), fx.FX1)
    return explode_labels(combine_clauses(apply_dimensions(clauses, fx.FX1), fx.FX1, ["id"]), ["id"])


def _path_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = fx.post_attr(spark, sf_dir).select("attr").distinct()
    return paths.select("attr", piece("attr", r"\.", 1).alias("second"), piece("attr", r"\.", -1).alias("last"))


def _lexicon_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = lexicon_entries(fx.lexicon_rules(spark))
    found = _tag_posts(spark, sf_dir).groupBy("tag").agg(F.count(F.lit(1)).alias("post_count"))
    of_tag = (F.col("name") == "fx1") & (F.col("kind") == "tag") & (F.col("entry") == F.col("tag"))
    return entries.join(found, of_tag, "left").drop("tag").fillna(0, subset=["post_count"])


QUERIES: dict[str, Query] = {
    "classify_attrs": _classify,
    "special_people_runs": _special_people_runs,
    "audience": lambda spark, sf_dir: _joined(_audience(spark, sf_dir)).drop("data_model"),
    "audience_semi": _audience_semi,
    "angle_list": lambda spark, sf_dir: angle_list(fx.people(spark, sf_dir)),
    "scene_touch": _scene_touch,
    "scene_metrics": _metric("tpa_scene_data"),
    "scene_category_metrics": _metric("tpa_scene_category_data"),
    "scene_brand_metrics": _metric("tpa_scene_brand_data"),
    "subscene_metrics": _metric("tpa_subscene_data"),
    "subscene_category_metrics": _metric("tpa_subscene_category_data"),
    "scene_tp_metrics": _metric("tpa_scene_tp_data"),
    "scene_tp_category_metrics": _metric("tpa_scene_tp_category_data"),
    "scene_tp_brand_metrics": _metric("tpa_scene_tp_brand_data"),
    "tp_metrics": _metric("tpa_tp_data"),
    "tp_brand_metrics": _metric("tpa_tp_brand_data"),
    "tp_category_metrics": _metric("tpa_tp_category_data"),
    "metric_rows": _metric_rows,
    "line_scene_metrics": _job_metric("tpa_scene_data"),
    "line_scene_category_metrics": _job_metric("tpa_scene_category_data"),
    "line_scene_tp_category_metrics": _job_metric("tpa_scene_tp_category_data"),
    "line_tp_metrics": _job_metric("tpa_tp_data"),
    "line_scene_touch": _scene_touch_of_lines,
    "appended_metric": _appended_metric,
    "replaced_metric": _replaced_metric,
    "metrics_job": _metrics_job,
    "orc_labels": _orc_labels,
    "tag_posts": _tag_posts,
    "word_lexicon": _word_lexicon,
    "tag_columns": lambda spark, sf_dir: tag_columns(fx.posts(spark, sf_dir).select("id", "content"), fx.FX1).drop("content"),
    "tag_objects": _tag_objects,
    "retag_clauses": _retag_clauses,
    "dimensions": _dimensions,
    "post_labels": _post_labels,
    "combined_clauses": _combined_clauses,
    "path_pieces": _path_pieces,
    "lexicon_rules": _lexicon_rules,
}
