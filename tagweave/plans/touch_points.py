"""Metrics job: post attributes, people and pending runs to eleven metric tables."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tagweave.operators.attrs import AttrScheme
from tagweave.operators.metrics import TABLES, TouchPointMetrics
from tagweave.plans.staging import staging
from tagweave.sinks.tables import append_metric_jdbc, replace_metric, setting
from tagweave.sources.tables import jdbc_options, read_jdbc, read_table, target_columns

# Lets go of the shuffle files of a query when it is done, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def all_metrics(
    post_attr: DataFrame,
    people: DataFrame,
    special_people: DataFrame | None = None,
    scheme: AttrScheme = AttrScheme(),
    late_angles: bool | None = None,
    lists_of_post: bool = False,
    tables: Iterable[str] = tuple(TABLES),
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> dict[str, DataFrame]:
    """The metric tables by name.

    ``keep`` is applied to the rows they share, as by ``Staging.keep``, which writes them once, split
    by class, so that a metric reads only the classes and columns it needs. Classes that none of the
    ``tables`` reads are left out.
    """
    tables = tuple(tables)
    metrics = TouchPointMetrics(post_attr, people, special_people, scheme, late_angles, lists_of_post, keep, tables=tables)
    return {name: metrics.table(name) for name in tables}


def run(
    post_attr: DataFrame,
    people: DataFrame,
    special_people: DataFrame | None,
    daterange: str,
    write: Callable[[DataFrame, str, str], None] = replace_metric,
    staging_folder: str | None = None,
    **options,
) -> None:
    """Computes and writes every metric. ``write`` takes the metric, its table and the date.

    As it stands, a job that is run again replaces what it wrote. Shared rows lie below
    ``staging_folder``, else below ``spark.checkpoint.dir``, until all is written. Shuffle files of a
    metric go when it is written, so that the disk holds those of one metric at a time.
    """
    spark = post_attr.sparkSession
    with staging(spark, staging_folder) as shared, setting(spark, CLEANUP, "true"):
        for name, metric in all_metrics(post_attr, people, special_people, keep=shared.keep, **options).items():
            write(metric, name, daterange)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Write the metric tables of all pending runs.")
    parser.add_argument("daterange", help="date of the metrics, yyyy-mm-dd")
    parser.add_argument("--posts", required=True, help="table or path of post attributes")
    parser.add_argument("--people", required=True, help="table or path of people angles")
    parser.add_argument("--runs", help="table or path of special people, or a JDBC table with --jdbc-runs")
    parser.add_argument("--prefix", default="", help="what stands before the names of the target tables, as a database and a dot")
    parser.add_argument("--format", default="parquet", help="format of target tables that do not exist yet")
    parser.add_argument("--staging", help="shared folder for intermediate rows, else spark.checkpoint.dir")
    parser.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE", help="an option of the JDBC connection")
    parser.add_argument("--jdbc-runs", action="store_true", help="read the runs over JDBC")
    parser.add_argument("--jdbc-targets", action="store_true", help="append to existing tables over JDBC")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("touch points").getOrCreate()
    options = jdbc_options(args.jdbc)
    runs = None
    if args.runs:
        runs = read_jdbc(spark, args.runs, options) if args.jdbc_runs else read_table(spark, args.runs)

    def write(metric: DataFrame, name: str, date: str) -> None:
        table = f"{args.prefix}{name}"
        if args.jdbc_targets:
            append_metric_jdbc(metric, table, date, target_columns(read_jdbc(spark, table, options)), options)
        else:
            replace_metric(metric, table, date, form=args.format)

    run(read_table(spark, args.posts), read_table(spark, args.people), runs, args.daterange, write, args.staging)


if __name__ == "__main__":
    main()
