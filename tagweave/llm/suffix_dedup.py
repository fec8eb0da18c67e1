"""Exact repeated passages by hash-compared suffix sorting: bytes under a string that an earlier document has.

Every string of ``LEAST`` bytes has one anchor: the place of its smallest hashed ``GRAM``-byte gram.
Neighbouring strings with the same anchor form a stretch, so a document is cut into stretches, some
15 strings each, and equal strings lie in stretches with equal anchors. All hashes come from prefix
sums of a polynomial, which give the hash of any substring at once.

1. Stretches go, as two hashes each and packed by part, to the bucket of their anchor. Equal
   stretches: all but those of the smallest id are covered. Stretches that share an anchor but
   differ are left over; only they can still have strings in common.
2. The strings of left-over stretches are suffix-sorted part by part: a mergesort of all groups of
   one anchor at once, in numpy, where two suffixes are compared by the length of their common
   extension, found by binary search over prefix hashes. The order is then verified byte by byte,
   and sorted again by bytes if a hash has lied. Of equal strings the one with the smallest id goes
   on, as two independent 64-bit hashes, to the bucket of its hash, where the smallest id of all
   parts is found. Anchors take turns in this, ``WAVES`` of them, so that the strings of only one are on disk.
3. Covered ranges come back to their documents and are merged.

Each part sends an equal stretch or string once, whatever the number of documents that hold it, so
that a passage of a third of all documents makes no large group. Buckets grow in number with the
input (``BUCKET_BYTES`` of text each). A part has ``PART_BYTES`` bytes of text, or one longer text,
and takes some 150 times that in memory.

Defined results: null is empty; a text of fewer than ``LEAST`` bytes loses nothing; a null id counts
as larger than any other; rows that repeat an id do not cover each other, even if they differ; an
empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import byte_rows, mixed, slices, stage

LEAST, GRAM = 50, 20
PART_BYTES, BUCKET_BYTES = 2_000_000, 24_000_000
#: Left-over stretches are dealt over as many rounds by their anchors, whose strings are on disk one round at a time.
WAVES = 2
NO_ID = np.iinfo(np.int64).max
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2 ** 64, and their inverses."""
    if base not in _powers or len(_powers[base][0]) < n:
        pair = []
        for factor in (base, pow(base, -1, 2**64)):
            powers = np.full(n, factor, np.uint64)
            powers[:1] = 1
            pair.append(np.cumprod(powers))
        _powers[base] = tuple(pair)
    return _powers[base]


class Prefixes:
    """Prefix hashes of bytes: the hash of any substring, comparable between places."""

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        power, inverse = _table(base, len(data) + 1)
        self.inverse = inverse[: len(data) + 1]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def grams(self, n: int) -> np.ndarray:
        return (self.sums[n:] - self.sums[:-n]) * self.inverse[: len(self.sums) - n]


def stretches(data: np.ndarray, bounds: np.ndarray, least: int, gram: int):
    """Anchor, first string, number of strings, hash of the anchor and of the whole, for each stretch."""
    empty = np.zeros(0, np.int64)
    if len(data) < least:
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    prefixes = Prefixes(data)
    code = mixed(prefixes.grams(gram))
    bits = np.uint64(max(24, len(code).bit_length()))
    least_so_far = (code >> bits << bits) | np.arange(len(code), dtype=np.uint64)
    width, span = least - gram + 1, 1
    while 2 * span <= width:
        least_so_far = np.minimum(least_so_far[:-span], least_so_far[span:])
        span *= 2
    rest = width - span
    if rest:
        least_so_far = np.minimum(least_so_far[:-rest], least_so_far[rest:])
    anchor = (least_so_far & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    start = np.arange(len(anchor))
    owner = np.searchsorted(bounds, start, side="right") - 1
    start = start[start + least <= bounds[owner + 1]]
    anchor = anchor[start]
    first = np.flatnonzero(np.diff(anchor, prepend=-1) != 0)
    count = np.diff(first, append=len(start))
    at, low = anchor[first], start[first]
    whole = prefixes.of(low, count - 1 + least)
    return at, low, count, code[at], mixed(whole + mixed((at - low).astype(np.uint64) << np.uint64(8) | count.astype(np.uint64)))


def merge_ranges(owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching ranges of one owner become one."""
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    if not len(owner):
        return owner, start, end
    shift = owner.astype(np.int64) * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + shift)
    fresh = np.ones(len(owner), bool)
    fresh[1:] = start[1:] + shift[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(owner)) - 1
    return owner[first], start[first], reach[last] - shift[first]


def _smallest(ids: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by keys, then id; number of the group of each in that order, and the groups' smallest ids."""
    order = np.lexsort((ids, *keys[::-1]))
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.logical_or.reduce([k[order][1:] != k[order][:-1] for k in keys]) if len(order) else False
    return order, np.cumsum(fresh) - 1, ids[order][fresh]


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *(x for a in arrays for x in (ord(a.dtype.char), len(a)))], np.int64)
    return b"".join([head.tobytes(), *(np.ascontiguousarray(a).tobytes() for a in arrays)])


def _unpacked(blob: bytes) -> list[np.ndarray]:
    n = int(np.frombuffer(blob, np.int64, 1)[0])
    head = np.frombuffer(blob, np.int64, 2 * n, 8).reshape(n, 2)
    at, arrays = 8 * (2 * n + 1), []
    for kind, size in head:
        dtype = np.dtype(chr(kind))
        arrays.append(np.frombuffer(blob, dtype, size, at))
        at += int(size) * dtype.itemsize
    return arrays


def _steps(places: np.ndarray) -> np.ndarray:
    """Rising places as differences in as few bytes as they need."""
    steps = np.diff(places, prepend=0)
    return steps.astype(np.uint16 if steps.max(initial=0) < 1 << 16 else np.uint32 if steps.max(initial=0) < 1 << 32 else np.uint64)


FOUND = "doc_id long, tag long, kind int, blob binary"
_SENT = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])
_FOUND = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])
COVERED, LEFT = 0, 1


def _sent(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], schema=_SENT)


def _found(ids, tags, owner, kind: int, *columns: np.ndarray) -> list[tuple]:
    """A row for each owner with what it has of each column; owners rise."""
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    last = np.append(first[1:], len(owner))
    return [(int(ids[owner[a]]), int(tags[owner[a]]), kind, _packed(*(c[a:b] for c in columns))) for a, b in zip(first, last)]


def _as_found(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[], [], [], []]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FOUND)], schema=_FOUND)


def _by_document(ids, tags, owner, start, end) -> list[tuple]:
    owner, start, end = merge_ranges(owner, start, end)
    return _found(ids, tags, owner, COVERED, start, end)


def _cut(n_buckets: int, least: int, gram: int):
    """Parts of documents (doc_id, tag, text) to packed stretches by bucket; what a part covers itself goes to bucket -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", PART_BYTES):
                data, bounds = byte_rows(batch.column(2))
                ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                at, low, count, code, sums = stretches(data, bounds, least, gram)
                owner = np.searchsorted(bounds, low, side="right") - 1
                order, group, smallest = _smallest(ids[owner], code, sums)
                later = np.zeros(len(low), bool)
                later[order] = ids[owner][order] > smallest[group]
                rows = []
                if later.any():
                    start = low[later] - bounds[owner[later]]
                    o, s, e = merge_ranges(owner[later], start, start + count[later] - 1 + least)
                    rows.append((-1 - int(code[0] % np.uint64(n_buckets)), _packed(ids, tags, o, s, e)))
                bucket = (code % np.uint64(n_buckets)).astype(np.int64)
                mine = np.flatnonzero(~later)
                mine = mine[np.argsort(bucket[mine], kind="stable")]
                edges = np.searchsorted(bucket[mine], np.arange(n_buckets + 1))
                for b in np.flatnonzero(np.diff(edges)):
                    one = mine[edges[b] : edges[b + 1]]
                    used, own = np.unique(owner[one], return_inverse=True)
                    arrays = (ids[used], tags[used], np.bincount(own).astype(np.uint32), bounds[used], code[one], sums[one])
                    rows.append((int(b), _packed(*arrays, _steps(low[one]), count[one].astype(np.uint8))))
                yield _sent(rows)

    return run


def _gathered(blobs: list[bytes]):
    """Documents and stretches of all parts of a bucket."""
    parts = [_unpacked(b) for b in blobs]
    ids, tags = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    owners, lows, at = [], [], 0
    for p in parts:
        own = np.repeat(np.arange(len(p[0])), p[2])
        owners.append(own + at)
        lows.append(np.cumsum(p[6].astype(np.int64)) - p[3][own])
        at += len(p[0])
    rest = [np.concatenate([p[k] for p in parts]) for k in (4, 5, 7)]
    return ids, tags, np.concatenate(owners), np.concatenate(lows), *rest


def _match(least: int, waves: int = 1):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        blobs = table.column("blob").to_pylist()
        if key[0].as_py() < 0:
            rows = []
            for ids, tags, owner, start, end in map(_unpacked, blobs):
                rows += _found(ids, tags, owner, COVERED, start, end)
            return _as_found(rows)
        ids, tags, owner, low, code, sums, count = _gathered(blobs)
        count = count.astype(np.int64)
        mine = ids[owner]
        order, group, smallest = _smallest(mine, code, sums)
        later = mine[order] > smallest[group]
        covered = order[later]
        rows = _by_document(ids, tags, owner[covered], low[covered], low[covered] + count[covered] - 1 + least)
        # Anchors with different stretches whose smallest ids differ: their first holders are compared string by string.
        first = order[np.flatnonzero(np.diff(group, prepend=-1))]
        anchor = np.cumsum(np.diff(code[first], prepend=code[first][:1] ^ np.uint64(1)) != 0) - 1
        edge = np.flatnonzero(np.diff(anchor, prepend=-1))
        several = np.minimum.reduceat(smallest, edge) != np.maximum.reduceat(smallest, edge) if len(edge) else np.zeros(0, bool)
        left = order[~later & several[anchor][group]]
        left = left[np.lexsort((low[left], owner[left]))]
        # All stretches of an anchor are in this bucket, so that equal strings are left over to one wave.
        rows += _found(ids, tags, owner[left], LEFT + key[0].as_py() % waves, code[left], low[left], count[left].astype(np.uint8))
        return _as_found(rows)

    return run


def common_extension(prefixes: Prefixes, x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Length of the common extension of suffixes, ``most`` at most, by binary search over prefix hashes."""
    low, high = np.zeros(len(x), np.int64), np.full(len(x), most, np.int64)
    for _ in range(int(most).bit_length()):
        middle = (low + high + 1) >> 1
        same = prefixes.of(x, middle) == prefixes.of(y, middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, np.maximum(middle - 1, low))
    return low


def _before(data, prefixes, x, y, most, or_equal) -> np.ndarray:
    same = common_extension(prefixes, x, y, most)
    end = same == most
    at = np.where(end, 0, same)
    return np.where(end, or_equal, data[x + at] < data[y + at])


def sort_suffixes(data: np.ndarray, suffix: np.ndarray, group: np.ndarray, most: int, prefixes: Prefixes | None = None) -> np.ndarray:
    """Order of suffixes by group, then by their first ``most`` bytes: bottom-up mergesort of all groups at once.

    Each suffix finds by binary search how many of the run beside its own come before it.
    """
    prefixes = prefixes or Prefixes(data)
    order = np.argsort(group, kind="stable")
    grouped = group[order]
    edge = np.flatnonzero(np.diff(grouped, prepend=-1))
    size = np.diff(edge, append=len(order))
    base, size = np.repeat(edge, size), np.repeat(size, size)
    local = np.arange(len(order)) - base
    run = 1
    active = np.flatnonzero(size > run)
    while len(active):
        mine, b, n = local[active], base[active], size[active]
        beside = (mine // run) ^ 1
        start = beside * run
        low, high = start.copy(), np.minimum(start + run, n)
        high = np.maximum(low, high)
        x = suffix[order[active]]
        left = (mine // run) % 2 == 0  # equal suffixes keep their order
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) >> 1
            y = suffix[order[b[todo] + middle]]
            before = _before(data, prefixes, y, x[todo], most, ~left[todo])
            low[todo] = np.where(before, middle + 1, low[todo])
            high[todo] = np.where(before, high[todo], middle)
        rank = np.maximum(low - start, 0)
        pair = (mine // run) & ~1
        target = b + pair * run + (mine % run) + rank
        moved = order[active]
        order[target] = moved
        run *= 2
        active = active[n > run]
    return order


def _bytes_at(data: np.ndarray, start: np.ndarray, most: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(data, most)[start]


def equal_runs(
    data: np.ndarray, suffix: np.ndarray, group: np.ndarray, most: int, prefixes: Prefixes | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """A verified order of suffixes and, in that order, the number of the run of equal ones."""
    order = sort_suffixes(data, suffix, group, most, prefixes)
    same = np.zeros(len(order), bool)
    right = True
    for at in range(1, len(order), 100_000):
        x, y = order[at - 1 : at + 99_999], order[at : at + 100_000]
        x = x[: len(y)]
        differ = _bytes_at(data, suffix[x], most) != _bytes_at(data, suffix[y], most)
        where = differ.argmax(axis=1)
        equal = ~differ[np.arange(len(x)), where]
        one = group[x] == group[y]
        same[at : at + 100_000] = equal & one
        right &= bool((equal | ~one | (data[suffix[x] + where] < data[suffix[y] + where])).all())
    if not right:  # two substrings of one hash: sort by bytes
        text = np.ascontiguousarray(_bytes_at(data, suffix, most)).view(f"V{most}").reshape(-1)
        _, number = np.unique(text, return_inverse=True)
        order = np.lexsort((number, group))
        same = np.zeros(len(order), bool)
        same[1:] = (number[order][1:] == number[order][:-1]) & (group[order][1:] == group[order][:-1])
    return order, np.cumsum(~same) - 1


def _strings(n_buckets: int, least: int):
    """Left-over stretches with their texts to strings by bucket; bucket -1 as in :func:`_cut`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", PART_BYTES):
                data, bounds = byte_rows(batch.column(2))
                ids, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                owner, code, low, count = [], [], [], []
                for k, blobs in enumerate(batch.column(3).to_pylist()):
                    for blob in blobs:
                        c, l, n = _unpacked(blob)
                        code.append(c)
                        low.append(l + bounds[k])
                        count.append(n.astype(np.int64))
                        owner.append(np.full(len(c), k))
                owner, code, low, count = (np.concatenate(x) for x in (owner, code, low, count))
                _, group = np.unique(code, return_inverse=True)
                suffix = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
                owner, group = np.repeat(owner, count), np.repeat(group, count)
                prefixes = Prefixes(data)
                order, number = equal_runs(data, suffix, group, least, prefixes)
                own = owner[order]
                first = np.full(int(number[-1]) + 1, NO_ID)
                np.minimum.at(first, number, ids[own])
                later = ids[own] > first[number]
                rows = []
                if later.any():
                    covered = order[later]
                    start = suffix[covered] - bounds[owner[covered]]
                    o, s, e = merge_ranges(owner[covered], start, start + least)
                    rows.append((-1 - int(code[0] % np.uint64(n_buckets)), _packed(ids, tags, o, s, e)))
                mine = order[~later]
                mine = mine[np.argsort(suffix[mine], kind="stable")]
                hashes = [mixed(p.of(suffix[mine], least)) for p in (prefixes, Prefixes(data, BASES[1]))]
                bucket = (hashes[0] % np.uint64(n_buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[by], np.arange(n_buckets + 1))
                for b in np.flatnonzero(np.diff(edges)):
                    one = by[edges[b] : edges[b + 1]]
                    used, own = np.unique(owner[mine[one]], return_inverse=True)
                    arrays = (ids[used], tags[used], np.bincount(own).astype(np.uint32), bounds[used], hashes[0][one], hashes[1][one])
                    rows.append((int(b), _packed(*arrays, _steps(suffix[mine[one]]), np.zeros(0, np.uint8))))
                yield _sent(rows)

    return run


def _match_strings(least: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        if key[0].as_py() < 0:
            return _match(least)(key, table)
        ids, tags, owner, low, first, second, _ = _gathered(table.column("blob").to_pylist())
        order, group, smallest = _smallest(ids[owner], first, second)
        covered = order[ids[owner][order] > smallest[group]]
        return _as_found(_by_document(ids, tags, owner[covered], low[covered], low[covered] + least))

    return run


def _tagged(docs: DataFrame) -> DataFrame:
    """Documents with an id that is never null, and a tag that tells rows of one id from each other."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(int(NO_ID))).alias("doc_id"), F.xxhash64("doc_id", text).alias("tag"), text.alias("text"))


def _lists(found: DataFrame, name: str) -> DataFrame:
    """What buckets have found for each document: at most a row from each bucket and part."""
    return found.groupBy(F.col("doc_id").alias("of_id"), F.col("tag").alias("of_tag")).agg(F.collect_list("blob").alias(name))


def _of(rows: DataFrame) -> Column:
    return (rows["doc_id"] == F.col("of_id")) & (rows["tag"] == F.col("of_tag"))


def _cleaner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges the ranges of each document and cuts them out."""
    for batch in batches:
        out = []
        for text, blobs in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
            parts = [_unpacked(b) for b in blobs or []]
            start, end = (np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1))
            _, start, end = merge_ranges(np.zeros(len(start), np.int64), start, end)
            kept = b"".join(text[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(text)]))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(start, end)]
            out.append((len(text), int((end - start).sum()), len(start), hashlib.sha256(kept).hexdigest(), spans, kept))
        columns = [pa.array([o[k] for o in out], t) for k, t in enumerate([pa.int64()] * 3 + [pa.string(), _SPANS, pa.binary()])]
        ids = pa.array([None if i == NO_ID else i for i in batch.column(0).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def covered_ranges(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """Ranges of bytes that an earlier document has, packed by document and by where they were found."""
    rows = _tagged(docs)
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_buckets = max(64, -(-int(size) // BUCKET_BYTES))
    sent = rows.mapInArrow(_cut(n_buckets, least, gram), "bucket long, blob binary")
    found = stage(sent.groupBy("bucket").applyInArrow(_match(least, WAVES), FOUND), "stretches")
    more = []
    for wave in range(WAVES):
        left = _lists(found.filter(F.col("kind") == LEFT + wave), "blobs")
        texts = rows.join(left, _of(rows)).select("doc_id", "tag", "text", "blobs")
        sent = texts.mapInArrow(_strings(n_buckets, least), "bucket long, blob binary")
        more.append(stage(sent.groupBy("bucket").applyInArrow(_match_strings(least), FOUND), "strings"))
    return reduce(DataFrame.union, [found.filter(F.col("kind") == COVERED), *more])


def suffix_dedup(docs: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, the spans, and the bytes that are kept."""
    rows = _tagged(docs)
    joined = rows.join(_lists(covered_ranges(docs, least, gram), "blobs"), _of(rows), "left").select("doc_id", "tag", "text", "blobs")
    return joined.mapInArrow(
        _cleaner,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>, kept binary",
    )
