"""Centroid clustering of integer vectors: distances are gathered from tables of squared differences.

A component x becomes the integer floor(64 * x), so a dimension has few different values. Each round
tabulates, for each dimension, the squared difference of every value that occurs in a batch to every
centroid, looks the components of all vectors up in these tables, and sums over the dimensions. No
product is formed for a single vector, and all of it is exact.

The driver holds the centroids and one sum for each centroid and dimension; a task holds the same and
one batch of vectors. Vectors are turned into integers once and written, and each round is a job of
its own over that table, so a lost executor costs the repetition of its own tasks. A round shuffles
one row for each centroid and dimension of a task: a cluster with almost all vectors costs no more.

Defined results: vectors that are null, of another length, or with null or non-finite components are
left out and give no row; rows that repeat an id are vectors of their own; a null id counts as the
empty text when starting centroids are drawn, and equal ids go by their components; with fewer vectors
than centroids each vector starts one; an empty table gives an empty result; further columns are
neither read nor returned. A component of 2**27 or more in size is an error that says so, since
distances would leave the range of a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import stage

DIMENSIONS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 64, 16, 3, 1
LARGEST = 1 << 27


def integer_vectors(vectors: DataFrame, vector: str = "embedding", dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """vec_id and the integer components of each vector that counts."""
    rows = vectors.select("vec_id", F.col(vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.when(F.size("vector") == dimensions, ~bad).otherwise(False)
    too_large = F.raise_error(F.lit(f"a component of a vector is {LARGEST} or more after scaling")).cast("int")
    as_integer = lambda x: F.when(F.abs(x * scale) < LARGEST, F.floor(x * scale).cast("int")).otherwise(too_large)
    return rows.filter(whole).select("vec_id", F.transform("vector", as_integer).alias("vector"))


def first_centroids(rows: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest SHA-256 of seed and id, in the order of these digests."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    drawn = rows.orderBy(digest, "vector").limit(k).select("vector").collect()
    return np.array([row["vector"] for row in drawn], np.int64)


def occurring(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of a column, ascending, and for each entry the place of its value."""
    low = column.min()
    span = int(column.max() - low) + 1
    if span > 4 * len(column) + 1024:
        return np.unique(column, return_inverse=True)
    place = column - low
    here = np.zeros(span, bool)
    here[place] = True
    return np.flatnonzero(here) + low, (np.cumsum(here) - 1)[place]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the nearest centroid, the first of equally near ones, and the squared distance."""
    total = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        values, place = occurring(vectors[:, d])
        table = (values[:, None] - centroids[:, d]) ** 2
        total += table[place]
    cluster = total.argmin(axis=1)
    return cluster, total[np.arange(len(total)), cluster]


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    column = batch.column(batch.schema.names.index("vector"))
    return column.flatten().to_numpy().astype(np.int64).reshape(-1, dimensions)


def _assign(centroids: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest(_matrix(batch, centroids.shape[1]), centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"]
                )

    return run


def _sums(centroids: np.ndarray):
    k, dimensions = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = _matrix(batch, dimensions)
                cluster, _ = nearest(vectors, centroids)
                n += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    total[c] += vectors[cluster == c].sum(axis=0)
        held = np.flatnonzero(n)
        columns = [np.repeat(held, dimensions), np.tile(np.arange(dimensions), len(held)), total[held].ravel(), np.repeat(n[held], dimensions)]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["cluster", "dimension", "total", "n"])

    return run


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid as the floor of the mean of its vectors; one without vectors stays."""
    parts = rows.mapInArrow(_sums(centroids), "cluster long, dimension long, total long, n long")
    sums = parts.groupBy("cluster", "dimension").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for row in sums.collect():  # as many rows as centroids have components
        moved[row["cluster"], row["dimension"]] = row["total"] // row["n"]
    return moved


def cluster_vectors(
    vectors: DataFrame,
    vector: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each vector that counts."""
    spark = vectors.sparkSession
    rows = stage(integer_vectors(vectors, vector, dimensions, scale), "vectors")
    centroids = first_centroids(rows, k, seed).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = next_centroids(rows, centroids)
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    assigned = stage(rows.mapInArrow(_assign(centroids), schema), "assigned")
    inertia = {r["cluster"]: r["inertia"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    whole = sum(inertia.values())
    of_cluster = [
        (c, inertia.get(c, 0), whole, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(centroids.tolist())
    ]
    table = spark.createDataFrame(of_cluster, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row for each centroid, so this side is small by its parameter.
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
