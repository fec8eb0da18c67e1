"""Benchmark decontamination: windows of test words, broadcast in blocks, are looked for in documents.

A window is ``WINDOW`` consecutive words of a benchmark item, or all words of a shorter one. Words
are lower-cased runs of ASCII letters, digits and anything beyond ASCII. Every window of a document
is hashed with numpy; those whose hash is one of the benchmark's are verified word for word.

What is broadcast has a bound: items are dealt into blocks by a hash so that a block has about
``BLOCK_BYTES`` bytes of text, and documents pass through one scan for each block, without a shuffle
between them. Memory in a task is some 60 times ``PART_BYTES``, or the same multiple of one longer
text.

Defined results: null text has no words; an item without words has no windows; an item without
an id is looked for as well and has the empty id; rows that repeat an item_id count as one item; repeated documents each give a row; an
empty benchmark hits nothing; further columns of either table may have any name that does not begin
with ``_hit_``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.common import Words, byte_rows, slices

WINDOW = 13
SHARE = 20  # a document is contaminated if one in so many of its words is hit
BLOCK_BYTES, PART_BYTES = 2_000_000, 2_000_000

_chars = np.arange(256)
IS_WORD = (_chars >= 128) | ((_chars >= 48) & (_chars <= 57)) | ((_chars >= 65) & (_chars <= 90)) | ((_chars >= 97) & (_chars <= 122))


def _index(items: list[tuple[str, str]]) -> dict[int, tuple[np.ndarray, dict[bytes, list[str]]]]:
    """By window length: a bit for each hash that occurs, and the items of each window."""
    words = Words(*byte_rows(pa.array([text for _, text in items], pa.string())), IS_WORD)
    count = np.bincount(words.text, minlength=len(items))
    found: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    codes: dict[int, list[np.ndarray]] = defaultdict(list)
    for n in sorted({min(WINDOW, int(c)) for c in count if c}):
        at, code = words.windows(n)
        mine = np.minimum(count[words.text[at]], WINDOW) == n
        codes[n].append(code[mine])
        for i in at[mine]:
            found[n][words.bytes_of(i, n)].add(items[words.text[i]][0])
    index = {}
    for n, windows in found.items():
        seen = np.zeros(1 << 22, bool)
        seen[np.concatenate(codes[n]) >> np.uint64(42)] = True
        index[n] = (np.packbits(seen), {k: sorted(v) for k, v in windows.items()})
    return index


SPAN = T.StructType([T.StructField(n, T.IntegerType()) for n in ("first", "last", "begin", "end")])
CARRIED = [
    T.StructField("_hit_n_words", T.LongType()),
    T.StructField("_hit_spans", T.ArrayType(SPAN)),
    T.StructField("_hit_items", T.ArrayType(T.StringType())),
]


def _spans(hit: np.ndarray, words: Words, base: int, data: np.ndarray, origin: int) -> list[dict[str, int]]:
    """Runs of hit words, ends exclusive: as numbers of words, and as code points of the text."""
    change = np.diff(hit.astype(np.int8), prepend=0, append=0)
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    found = []
    for first, last in zip(np.flatnonzero(change == 1), np.flatnonzero(change == -1)):
        begin, end = words.start[base + first] - origin, words.end[base + last - 1] - origin
        found.append({"first": int(first), "last": int(last), "begin": int(letters[begin]), "end": int(letters[end])})
    return found


def _scan(index):
    def part_of(batch: pa.RecordBatch, tables) -> pa.RecordBatch:
        names = batch.schema.names
        data, bounds = byte_rows(batch.column(names.index("text")))
        words = Words(data, bounds, IS_WORD)
        edge = np.zeros(len(words.code) + 1, np.int32)
        first = np.searchsorted(words.text, np.arange(batch.num_rows + 1))
        spans = batch.column(names.index("_hit_spans")).to_pylist()
        items = [set(x) for x in batch.column(names.index("_hit_items")).to_pylist()]
        touched = set()
        for n, (seen, windows) in tables.items():
            at, code = words.windows(n)
            for i in at[seen[code >> np.uint64(42)]]:
                if hit := windows.get(words.bytes_of(i, n)):
                    edge[i] += 1
                    edge[i + n] -= 1
                    touched.add(int(words.text[i]))
                    items[words.text[i]].update(hit)
        for k in touched:
            for old in spans[k]:
                edge[first[k] + old["first"]] += 1
                edge[first[k] + old["last"]] -= 1
        covered = np.cumsum(edge[:-1]) > 0
        for k in touched:
            mine = data[bounds[k] : bounds[k + 1]]
            spans[k] = _spans(covered[first[k] : first[k + 1]], words, first[k], mine, bounds[k])
        new = {"_hit_n_words": pa.array(np.diff(first)), "_hit_spans": spans, "_hit_items": [sorted(x) for x in items]}
        columns = [
            pa.array(new[f.name], f.type) if f.name in new else batch.column(k) for k, f in enumerate(batch.schema)
        ]
        return pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {n: (np.unpackbits(bits).view(bool), windows) for n, (bits, windows) in index.value.items()}
        for whole in batches:
            for batch in slices(whole, "text", PART_BYTES):
                yield part_of(batch, tables)

    return run


def find_hits(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with three more columns: the number of words, the runs of hit words, the items found."""
    spark = docs.sparkSession
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    items = benchmark.select(item, F.col("text").cast("string").alias("text")).filter("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + 2 * int(size) // block_bytes
    names = docs.columns
    types = [f.dataType for f in CARRIED]
    start = [F.lit(0).cast(types[0]), F.array().cast(types[1]), F.array().cast(types[2])]
    hits = docs.select("*", *(value.alias(f.name) for value, f in zip(start, CARRIED)))
    for k in range(blocks):
        block = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        index = spark.sparkContext.broadcast(_index([tuple(r) for r in block.collect()]))
        hits = hits.mapInArrow(_scan(index), T.StructType([*docs.schema.fields, *CARRIED]))
    return hits.select(*names, *(f.name for f in CARRIED))


def n_hit():
    return F.aggregate("_hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def contaminated(share: int = SHARE):
    return (n_hit() > 0) & (share * n_hit() >= F.col("_hit_n_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document: its words, its hit words, the items found, and whether it is contaminated."""
    hits = find_hits(docs.select("doc_id", "text"), benchmark, block_bytes)
    return hits.select(
        "doc_id",
        F.col("_hit_n_words").alias("n_words"),
        n_hit().alias("n_hit"),
        F.size("_hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
        F.col("_hit_spans").alias("spans"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    return find_hits(docs, benchmark).filter(~contaminated()).select(*docs.columns)


def cut_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, with the runs of hit words cut out of ``text``."""
    hits = find_hits(docs, benchmark)
    start = F.struct(F.lit("").alias("kept"), F.lit(0).alias("at"))

    def cut(state, span):
        piece = F.col("text").substr(state["at"] + 1, span["begin"] - state["at"])
        return F.struct(F.concat(state["kept"], piece).alias("kept"), span["end"].alias("at"))

    left = F.aggregate("_hit_spans", start, cut)
    rest = F.concat(left["kept"], F.col("text").substr(left["at"] + 1, F.length("text")))
    return hits.withColumn("text", F.when(F.size("_hit_spans") > 0, rest).otherwise(F.col("text"))).select(*docs.columns)
