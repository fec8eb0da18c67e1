"""Pending runs: each row of the special-people table asks for one set of metrics (``data_model``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# States of a run that is waiting to be computed.
PENDING_STATES = (2, 4)
# data_model of a computation without a special-people table.
DEFAULT_RUN = 0
RUN = "data_model"

# Values of ``run_key``: a row in every run, a scene only in runs without a limit, a scene some run names.
EVERY, WHOLE, NAMED = "every", "whole", "named "
# Runs that a row of a finished metric meets at once, and keys over which rows that no run limits are spread.
AT_ONCE, SPREAD = 1024, 4096


class Runs:
    """All pending runs at once.

    A run limits scenes to those whose path ends in one of its words. An empty word, as in the value
    ``''``, lifts the limit; a null value is read as ``''``. Empty words at the end of a list do not
    count, so a value of commas alone lets no scene pass. Rows of one id are one run with the words
    of all of them; rows without an id are no run.

    Rows carry a ``run_key`` in place of the runs themselves, and are joined to runs where copies for
    each run are needed. The same joins serve any number of runs and words.
    """

    def __init__(self, special_people: DataFrame | None = None):
        self._runs: DataFrame | None = None
        if special_people is not None:
            value = F.coalesce("value", F.lit(""))
            kept = F.rtrim(value, F.lit(","))
            words = F.when((kept == "") & (value != ""), F.array().cast("array<string>")).otherwise(F.split(kept, ","))
            pending = special_people.filter(F.col("state").isin(*PENDING_STATES) & F.col("id").isNotNull())
            # What is gathered for a run are the words of its own rows.
            named = F.array_sort(F.array_distinct(F.flatten(F.collect_list(words))))
            runs = pending.groupBy(F.col("id").cast("bigint").alias(RUN)).agg(named.alias("words"))
            whole = F.array_contains("words", "")
            keys = F.when(whole, F.array().cast("array<string>")).otherwise(F.transform("words", lambda w: F.concat(F.lit(NAMED), w)))
            self._runs = runs.select(RUN, whole.alias("run_whole"), keys.alias("run_names"))

    def limit(self, rows: DataFrame, is_scene: Column, word: Column) -> DataFrame:
        """``rows`` (platform_id, user_id, attr) with their ``run_key``; scenes that are in no run are dropped."""
        if self._runs is None:
            return rows.withColumn("run_key", F.when(is_scene, F.lit(WHOLE)).otherwise(EVERY))
        names = self._runs.select(F.explode("run_names").alias("run_name")).distinct()
        any_whole = self._runs.agg(F.coalesce(F.bool_or("run_whole"), F.lit(False))).scalar()
        # Only scenes can meet a name. Other rows, and scenes without a word, have one of many keys that are
        # none, by author and path, so that a join by sorting does not bring them together.
        author = F.xxhash64("platform_id", "user_id", "attr")
        spread = F.concat(F.lit(f"{EVERY} "), F.pmod(author, F.lit(SPREAD)))
        named = rows.withColumn("run_word", F.coalesce(F.when(is_scene, F.concat(F.lit(NAMED), word)), spread))
        named = named.join(names, F.col("run_word") == F.col("run_name"), "left")
        key = F.coalesce("run_name", F.when(is_scene, F.lit(WHOLE)).otherwise(EVERY))
        keyed = named.withColumn("run_key", key).drop("run_word", "run_name")
        return keyed.filter((F.col("run_key") != WHOLE) | any_whole)

    def copies(self, rows: DataFrame, details: bool = False) -> DataFrame:
        """One copy of each row for each of its runs, with ``data_model`` in place of ``run_key``.

        With ``details`` also ``run_whole`` and ``run_names``, for :func:`holds`.
        """
        wanted = ["run_whole", "run_names"] if details else []
        if self._runs is None:
            own = {RUN: F.lit(DEFAULT_RUN).cast("bigint"), "run_whole": F.lit(True), "run_names": F.array().cast("array<string>")}
            return rows.withColumns({c: own[c] for c in [RUN, *wanted]}).drop("run_key")
        general = F.array(F.lit(EVERY), F.when(F.col("run_whole"), F.lit(WHOLE)))
        by_key = self._runs.select(RUN, *wanted, F.explode(F.array_compact(F.concat(general, "run_names"))).alias("by_key"))
        # A run without a limit has no names, so a row meets each run once.
        keys = F.when(F.col("run_key").startswith(NAMED), F.array(F.lit(WHOLE), "run_key")).otherwise(F.array("run_key"))
        copied = rows.withColumn("run_key", F.explode(keys)).join(by_key, F.col("run_key") == F.col("by_key"))
        return copied.drop("run_key", "by_key")

    def stamp(self, metric: DataFrame) -> DataFrame:
        """One copy of a finished metric for each pending run, for metrics that no run changes.

        Runs are dealt over groups of about AT_ONCE by a hash, and rows are joined to them by group.
        """
        if self._runs is None:
            return metric.withColumn(RUN, F.lit(DEFAULT_RUN).cast("bigint"))
        n_groups = lambda: self._runs.agg(F.ceil(F.count(F.lit(1)) / AT_ONCE).cast("int")).scalar()
        runs = self._runs.select(RUN, F.pmod(F.xxhash64(RUN), n_groups()).cast("int").alias("run_group"))
        groups = F.when(n_groups() > 0, F.sequence(F.lit(0), n_groups() - 1))
        dealt = metric.withColumn("of_group", F.explode(groups))
        return dealt.join(runs, F.col("of_group") == F.col("run_group")).drop("of_group", "run_group")


def keys_of(condition: Column, name: str) -> list[Column]:
    """Aggregates: in which runs is any row that meets ``condition``? To be asked by :func:`holds`."""
    key = F.col("run_key")
    return [
        F.bool_or(condition & (key == EVERY)).alias(f"{name}_every"),
        F.bool_or(condition).alias(f"{name}_any"),
        F.collect_set(F.when(condition & key.startswith(NAMED), key)).alias(f"{name}_names"),
    ]


def holds(name: str) -> Column:
    """Whether the run of a copy made with details is among those of ``keys_of``; false where they are null."""
    found = F.col(f"{name}_every") | (F.col("run_whole") & F.col(f"{name}_any")) | F.arrays_overlap(f"{name}_names", "run_names")
    return F.coalesce(found, F.lit(False))
