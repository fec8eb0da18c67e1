"""Tagging job: posts and a named lexicon to a table of labels."""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tagweave.operators.tagging import label_posts
from tagweave.sinks.tables import save_orc
from tagweave.sources.lexicon import load_lexicon
from tagweave.sources.tables import jdbc_options, read_jdbc, read_table


def tag_table(
    spark: SparkSession,
    rules: DataFrame,
    lexicon: str,
    posts: str,
    where: str | None = None,
    partitions: int | None = None,
    group_wildcards: bool = False,
    rename: Mapping[str, str] | None = None,
) -> DataFrame:
    """Labels of the posts in a table. ``partitions`` spreads posts by id, for a badly split source.

    ``rename`` gives columns of the table the names ``id`` and ``content``.
    """
    rows = read_table(spark, posts, where).withColumnsRenamed(dict(rename or {}))
    if partitions:
        rows = rows.repartition(partitions, "id")
    return label_posts(rows, load_lexicon(rules, lexicon), group_wildcards=group_wildcards)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write one row per post and label.")
    parser.add_argument("lexicon", help="name of the rule set")
    parser.add_argument("posts", help="input table or parquet path")
    parser.add_argument("output", help="output table")
    parser.add_argument("--rules", required=True, help="table or path of the rule sets, or a JDBC table with --jdbc")
    parser.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE", help="an option of the JDBC connection of the rules")
    parser.add_argument("--mode", default="overwrite")
    parser.add_argument("--partitions", type=int)
    parser.add_argument("--where", help="SQL filter on the posts")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("tagging").getOrCreate()
    rules = read_jdbc(spark, args.rules, jdbc_options(args.jdbc)) if args.jdbc else read_table(spark, args.rules)
    save_orc(tag_table(spark, rules, args.lexicon, args.posts, args.where, args.partitions), args.output, args.mode)


if __name__ == "__main__":
    main()
