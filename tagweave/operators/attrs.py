"""Classes of dotted post attributes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.paths import last_segment, n_segments, segment
from tagweave.operators.audience import PERSON, POST_COLUMNS, share_of
from tagweave.sources.runs import Runs


@dataclass(frozen=True)
class AttrScheme:
    """Words of the attribute grammar."""

    # Path roots and track names of the attribute grammar.
    scene: str = "场景"
    touch: str = "TP"
    track_a: str = "A"
    track_b: str = "B"

    def is_scene(self, attr: Column) -> Column:
        return attr.startswith(f"{self.scene}.")

    def is_touch(self, attr: Column) -> Column:
        return attr.startswith(f"{self.touch}.")

    def is_track(self, attr: Column) -> Column:
        return attr.contains(f".{self.track_a}.") | attr.contains(f".{self.track_b}.")

    def kind(self, attr: Column) -> Column:
        """Class of a path of two or three parts, by the first rule that fits; null if none does."""
        return (
            F.when(self.is_touch(attr) & (n_segments(attr) == 3), "sub_tp")
            .when(self.is_touch(attr) & (n_segments(attr) == 2), "tp")
            .when(attr.contains(f".{self.track_a}."), "scene_A")
            .when(attr.contains(f".{self.track_b}."), "scene_B")
            .when(self.is_scene(attr), "scene")
        )


def classed_rows(post_attr: DataFrame, runs: Runs, scheme: AttrScheme = AttrScheme()) -> DataFrame:
    """Post attributes with ``kind`` and ``run_key``, one row each.

    Paths of one part or of four and more, paths of no class, and scenes that no run asks for are
    left out. Rows are not copied for each run before they must be.
    """
    attr = F.col("attr")
    rows = post_attr.filter(n_segments(attr).isin(2, 3)).select(*POST_COLUMNS, "attr", scheme.kind(attr).alias("kind"))
    # A scene path is limited by its last word even where it is classed as a track.
    return runs.limit(rows.filter(F.col("kind").isNotNull()), scheme.is_scene(attr), last_segment(attr))


def classify_attrs(
    post_attr: DataFrame, special_people: DataFrame | None = None, scheme: AttrScheme = AttrScheme()
) -> DataFrame:
    """Distinct post attributes by run and class.

    A scene path is both a ``sub_scene`` with its whole path and a ``scene`` with its second part; a
    ``tp`` is shortened to its second part.
    """
    runs = Runs(special_people)
    # Rows are brought together before they are copied for runs and classes, by what all copies that can
    # become equal have in common, so that copies are never shuffled: by person and share of a person, where
    # the rows of a post lie beside each other, and an audience finds them.
    rows = classed_rows(post_attr, runs, scheme).repartition(*PERSON, share_of())
    classes = F.when(F.col("kind") == "scene", F.array(F.lit("sub_scene"), F.lit("scene"))).otherwise(F.array("kind"))
    typed = runs.copies(rows).withColumn("attr_type", F.explode(classes))
    short = F.col("attr_type").isin("tp", "scene")
    attr = F.when(short, segment("attr", 1)).otherwise(F.col("attr"))
    typed = typed.select("data_model", *POST_COLUMNS, "attr_type", attr.alias("attr"), share_of().alias("share"))
    return typed.dropDuplicates().drop("share")
