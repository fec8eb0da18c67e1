"""Exact duplicates: sorted runs of digests are merged in binomial rounds, and the answer goes back.

Texts are equal when they are identical without ASCII white space. Each row belongs to one of
``RUNS`` runs. In a round, ``FAN`` runs exchange rows and become one: rows are brought together by
digest *and* number of the new run, so that a text with a third of all rows never gives a task more
than ``FAN`` rows a round besides its own run. Each level keeps, by digest, how many rows there are
and which of them stays. The answer of the last level goes back through the same levels, by joins
that no text is large in either. A digest is a SHA-256 together with the length and a second hash
of the text, and only rows that agree in all of them are merged.

Only DataFrame functions are used. Defined results: a null text is empty, and empty texts are equal;
of equal texts the longest original stays, then the smallest id, and null ids come last; rows that
agree in id and text are marked alike, while ``drop_copies`` keeps one of them; an empty table gives an
empty result; further columns of the input are neither read nor returned by ``exact_dedup``. The runs
are numbers dealt by a hash of the row, and a merge is an aggregation by digest and run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import stage, tagged

WHITE = " \t\n\x0b\x0c\r"
RUNS, FAN = 4096, 64
DIGEST = ["sha", "check", "size"]


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digest_runs(docs: DataFrame, runs: int = RUNS, row: Column | None = None) -> DataFrame:
    """A row for each document, without its text: digest, length of the original, number of a run.

    ``row`` numbers the rows where they have numbers already.
    """
    text = normalised(F.col("text"))
    rows = docs.select(
        "doc_id",
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
        F.xxhash64(text).alias("check"),
        F.length(text).alias("size"),
        F.coalesce(F.length("text"), F.lit(0)).alias("n_chars"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )
    return rows.withColumn("run", F.pmod(F.xxhash64("row"), F.lit(runs)).cast("int"))


def _merge(runs: DataFrame, fan: int) -> DataFrame:
    """Of ``fan`` runs one; equal digests become one row that keeps the better of the two."""
    merged = runs.groupBy(*DIGEST, F.expr(f"run div {fan}").cast("int").alias("run"))
    return merged.agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def _answered(rows: DataFrame, runs: int, fan: int, *last_resort: str) -> DataFrame:
    """Rows of ``digest_runs`` with ``best``, what tells the row that stays, and ``n``, the size of their group."""
    best = F.struct((-F.col("n_chars")).alias("longest"), F.col("doc_id").isNull().alias("last"), "doc_id", *last_resort)
    levels = [stage(_merge(rows.select(*DIGEST, "run", best.alias("best"), F.lit(1).cast("long").alias("n")), 1), "level")]
    left = runs
    while left > 1:
        levels.append(stage(_merge(levels[-1], fan), "level"))
        left = -(-left // fan)
    answer = levels[-1]
    for level in reversed(levels[:-1]):
        below = level.select(*DIGEST, "run", F.expr(f"run div {fan}").cast("int").alias("above"))
        answer = below.join(answer.withColumnRenamed("run", "above"), [*DIGEST, "above"]).drop("above")
    return rows.join(answer, [*DIGEST, "run"])


def exact_dedup(docs: DataFrame, runs: int = RUNS, fan: int = FAN) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for each row of ``docs``."""
    return _answered(stage(digest_runs(docs, runs), "digests"), runs, fan).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.doc_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, runs: int = RUNS, fan: int = FAN) -> DataFrame:
    """Exactly one row of each group of equal texts, with all its columns, whatever ids are null or repeated."""
    rows, tag = tagged(docs)
    found = _answered(stage(digest_runs(rows, runs, F.col(tag)), "digests"), runs, fan, "row")
    kept = found.filter(F.col("row") == F.col("best.row")).select(F.col("row").alias("_kept_row"))
    return rows.join(kept, rows[tag] == kept["_kept_row"], "left_semi").drop(tag)
