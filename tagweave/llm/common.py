"""What several operators share: tables written between steps, and texts as arrays of bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_unset: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, one of this machine in local mode, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _unset.setdefault("folder", tempfile.mkdtemp(prefix="tagweave-"))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Writes rows to a new table of the shared folder and reads it, so that no step repeats them.

    Shuffle files of the write are removed when it is done, as nothing reads them any more. The table
    outlives lost executors. It stays as long as rows that are read from it may be asked for; the
    owner of the shared folder removes what lies below its folder ``tagweave``.
    """
    return staged(df, name)[0]


def staged(df: DataFrame, name: str, codec: str = "snappy") -> tuple[DataFrame, str]:
    """As ``stage``, with the path of the table for one that wants to ``discard`` it."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tagweave/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``staged`` that nothing will be read from: what was made of it is written."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def tagged(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` written with a number for each row, and the name of that column.

    The number is read from then on, so that rows stay told apart also where ids are null or repeated.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), "tagged"), name


def byte_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts after one another, and where each begins and ends; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
    column = pc.fill_null(column, empty).cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least."""
    column = batch.column(batch.schema.names.index(text))
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // most
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    for begin, end in zip(starts, [*starts[1:], len(part)]):
        yield batch.slice(int(begin), int(end - begin))


BASE, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
BASE_INVERSE, STEP_INVERSE = (np.uint64(pow(int(x), -1, 1 << 64)) for x in (BASE, STEP))
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_lower_1 = _lower.astype(np.uint64) + np.uint64(1)
POWERS = 1 << 21
_known: dict[np.uint64, np.ndarray] = {}


def _powers(x: np.uint64, n: int) -> np.ndarray:
    """The powers of x from 0 on; those of texts of ordinary size are kept."""
    if len(_known.get(x, ())) < n:
        powers = np.ones(n, np.uint64)
        np.cumprod(np.full(max(0, n - 1), x), out=powers[1:])
        if n > POWERS:
            return powers
        _known[x] = powers
    return _known[x][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class Words:
    """Words of many texts, as bytes with A-Z lower-cased: where they lie, whose they are, their hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray):
        inside = is_word[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = inside
        before[bounds] = False  # no word goes on from one text to the next
        after[bounds] = False
        self.start = np.flatnonzero(inside & ~before[:-1])
        self.end = np.flatnonzero(inside & ~after[1:]) + 1
        self.text = np.searchsorted(bounds, self.start, side="right") - 1
        self.length = self.end - self.start
        self._data = data
        # A word's code is the sum of (byte + 1) * BASE ** place; sums from the begin of all are divided by BASE ** start.
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_lower_1[data]) * _powers(BASE, len(data)), out=total[1:])
        code = (total[self.end] - total[self.start]) * _powers(BASE_INVERSE, len(data))[self.start]
        code ^= code >> np.uint64(29)
        self.code = code * BASE

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of n words within one text, and the windows' hashes."""
        count = max(0, len(self.code) - n + 1)
        if n > 12 and count:  # the same sum as below, from the begin of all
            before = np.zeros(len(self.code) + 1, np.uint64)
            np.cumsum(self.code * _powers(STEP_INVERSE, len(self.code)), out=before[1:])
            total = (before[n:] - before[:count]) * _powers(STEP, len(self.code))[n - 1 :]
        else:
            total = np.zeros(count, np.uint64)
            for k in range(n):
                total = total * STEP + self.code[k : k + count]
        at = np.flatnonzero(self.text[:count] == self.text[n - 1 : n - 1 + count])
        return at, total[at]

    @cached_property
    def _plain(self) -> tuple[np.ndarray, bytes]:
        """All words with one space after each, and where each of them begins."""
        place = np.cumsum(self.length + 1) - (self.length + 1)
        plain = np.full(int((self.length + 1).sum()), 32, np.uint8)
        within = np.arange(int(self.length.sum())) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        plain[within + np.repeat(place, self.length)] = _lower[self._data[within + np.repeat(self.start, self.length)]]
        return place, plain.tobytes()

    def bytes_of(self, first: int, n: int) -> bytes:
        """A window as its words with single spaces between."""
        place, plain = self._plain
        return plain[place[first] : place[first + n - 1] + self.length[first + n - 1]]
