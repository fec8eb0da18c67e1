"""Inputs of the queries, derived from the test tables (see FIXTURES.md)."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.sources.lexicon import Lexicon

TAGS = {
    "tone.praise": "good|great|best",
    "tone.worth": "worthless",
    "offer/call": "free|buy|click",
    "legal.license": "license",
    "pii email": "[a-z0-9._]+@[a-z0-9.]+",
    "pii phone": "[0-9]{3}-[0-9]{4}",
    "suffix-ther": "ther",
    "suffix-ouen": "ouen",
    "geo-keit": "keit",
}
DIMENSIONS = {
    "promo": "offer/call[|]tone.praise[&]suffix-ther",
    "contact": "pii email[|]pii phone",
    "ther only": "suffix-ther[-]suffix-ouen",
    "wild": "legal.license[&]suffix-*",
    "grouped": "(tone.praise[|]tone.worth)[-]legal.license",
    "tone.worth": "legal.license",
}
OBJECTS = ["suffix"]
FX1 = Lexicon("fx1", TAGS, DIMENSIONS, OBJECTS)

# Run 2 is given by two rows with a word in common, and a row without an id is no run.
SPECIAL_PEOPLE = [(1, "", 2), (2, "ECONOMY,small", 4), (2, "small,blue", 2), (3, "PROMO", 0), (4, "blue", 4), (None, "small", 2)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the seven paths that a line of theirs may have, their category and their code of category and brand."""
    first, second = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    # Strings are put together once for each part, not for each line.
    root = F.lit("TP")
    paths = F.array(
        F.concat(F.lit("场景."), "p_type"),
        F.concat_ws(".", F.lit("场景"), "p_type", first),
        F.concat_ws(".", root, second),
        F.concat_ws(".", root, second, first),
        F.lit("TP内圈.A.场景A"),
        F.lit("TP内圈.B.场景B"),
        F.concat_ws(".", root, second, first, F.lit("deep")),
    )
    category = (F.col("p_size") % 10).cast("string")
    code = F.concat_ws("_", category, F.substring("p_brand", 7, 100))
    rows = table(spark, sf_dir, "part").select("p_partkey", paths.alias("paths"), category.alias("category"), code.alias("code"))
    # Parts grow with the lines, and a file is small beside its rows: joined by sorting, never through the driver.
    return rows.hint("merge")


def _path() -> F.Column:
    """The path of a line, by its number."""
    line = F.col("l_linenumber")
    return F.get("paths", F.when(line.between(1, 6), line - 1).otherwise(6))


def post_attr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts; each line gives an attribute path, and maybe a category and a brand.

    An order can repeat a path; nothing downstream depends on rows being distinct.
    """
    lines = table(spark, sf_dir, "lineitem").join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    attrs = lines.select("l_orderkey", _path().alias("attr"))
    # Lines go to their order once, and lists are made there: hardly any two lines of an order meet before, and
    # a list holds no more than parts have categories and brands.
    facts = lines.select(
        "l_orderkey",
        F.when(F.col("l_returnflag") != "N", F.col("category")).alias("category"),
        F.when(F.col("l_linestatus") == "O", F.col("code")).alias("code"),
    )
    lists = facts.repartition("l_orderkey").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_set("category")).alias("categories"),
        F.sort_array(F.collect_set("code")).alias("codes"),
    )
    # A left join by the keys of a group: dropped by the optimizer where no list is asked for.
    posts = attrs.join(lists.hint("merge"), "l_orderkey", "left").join(
        table(spark, sf_dir, "orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return posts.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).alias("platform_id"),
        F.when(F.size("categories") > 0, F.col("categories")).alias("categoryids"),
        F.when(F.size("codes") > 0, F.col("codes")).alias("brands"),
        "attr",
    )


def line_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``post_attr``, but with an author and lists for each line, so that rows of a post differ in them."""
    lines = table(spark, sf_dir, "lineitem").join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"))
    # The one path and the names a line has go to its order, not all paths of its part.
    has_category, has_code = F.col("l_returnflag") != "N", F.col("l_linestatus") == "O"
    lines = lines.select(
        "l_orderkey",
        "l_linenumber",
        has_category.alias("has_category"),
        F.when(has_category, F.col("category")).alias("category"),
        has_code.alias("has_code"),
        F.when(has_code, F.col("code")).alias("code"),
        _path().alias("attr"),
    )
    lines = lines.join(table(spark, sf_dir, "orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("o_orderkey").cast("string").alias("id"),
        (F.col("o_custkey") + F.col("l_linenumber") % 3).cast("string").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).alias("platform_id"),
        F.when(F.col("has_category"), F.array("category")).alias("categoryids"),
        F.when(F.col("has_code"), F.array("code")).alias("brands"),
        "attr",
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers on some of five platforms, with their region, and maybe ``VIP``, as angles."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    placed = (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    angles = F.array_compact(F.array("r_name", F.when(F.col("c_acctbal") > 5000, "VIP")))
    seen = placed.withColumn("p", F.explode(F.sequence(F.lit(1), F.lit(5)))).filter((F.col("c_custkey") + F.col("p")) % 3 != 0)
    return seen.select(
        F.col("p").cast("string").alias("platform_id"),
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_mktsegment").alias("people_type"),
        angles.alias("regex_rule"),
    )


def special_people(spark: SparkSession) -> DataFrame:
    return _literal_table(spark, SPECIAL_PEOPLE, "id bigint, value string, state int")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("content"), "source", "lang"
    )


def lexicon_rules(spark: SparkSession) -> DataFrame:
    row = (FX1.name, json.dumps(TAGS), json.dumps(DIMENSIONS), json.dumps(OBJECTS))
    other = ("fx2", json.dumps({"only": "the"}), None, None)
    return _literal_table(spark, [row, other], "name string, tags string, dimensions string, objects string")


def word_lexicon_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule set of real size: the small words of the benchmark as tags, long ones as patterns."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(F.regexp_extract_all("text", F.lit("[a-z]{5,12}"), F.lit(0))).alias("word"))
    word = F.col("word")
    pattern = F.when(F.length(word) < 9, word).otherwise(F.concat(F.substring(word, 1, 4), F.lit("[a-z]"), F.substring(word, 6, 20)))
    # A rule set is one row of text.
    entries = F.collect_set(F.struct(word, pattern.alias("pattern")))
    tags = F.to_json(F.map_from_entries(F.sort_array(entries)))
    none = F.lit(None).cast("string")
    return words.agg(tags.alias("tags")).select(F.lit("words").alias("name"), "tags", none.alias("dimensions"), none.alias("objects"))


def _literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    columns = list(zip(*rows))
    return spark.createDataFrame(pa.table(dict(zip([f.split()[0] for f in schema.split(", ")], columns))), schema)
