"""Near duplicates: SuperMinHash signatures, banding, verification on whole sets, union-find grouping.

A document is the set of its 5-word shingles. SuperMinHash gives each shingle a random permutation
of the slots, drawn step by step; its value in the slot of step j lies between j and j + 1, and a
document is finished when no slot can fall further. Shingles of one document thus never compete for
a slot at the same step more often than chance wants, which lowers the variance. All documents of a
part take each step together, in numpy.

Equal sets become one class, whose smallest id stands for it. Classes that agree in a band of
``ROWS`` slots are in one bucket, and buckets that share members are one group of candidates, found
as components of stars, so that nothing is made of a bucket's pairs. A group is dealt into blocks of
some ``BLOCK`` classes. Within a block all sets are compared at once, exactly, by products of 0/1
matrices of shingles, and union-find leaves a forest of links. Only where a group of several blocks
still has several components, all but the largest of them meet all others, block by block: so each
pair of a group is either compared or already connected, with no cap, and the work beyond the first
pass grows with what is not connected. Components are merged by union-find within partitions and by
stars across them.

With ``BANDS`` bands of ``ROWS`` slots, a pair of similarity 0.75 shares no bucket with probability
(1 - 0.75 ** 4) ** 32, about 5e-6, and less above.

Defined results: null and empty texts have an empty set and are linked with nothing; texts of fewer
than five words are one shingle; each row is a document of its own, also where its id is null or
repeated, and of a group the smallest id that is not null stands for it (with its smallest row in
``drop_near_copies``, which keeps exactly one); an empty table gives an empty result; further columns
are not read. A text is taken whole; a task needs some
40 times the bytes of its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.llm.common import MIX1, MIX2, STEP, Words, byte_rows, mixed, slices, stage, tagged
from tagweave.llm.components import components

SHINGLE, PERCENT = 5, 75
BANDS, ROWS = 32, 4
SLOTS = BANDS * ROWS
PART_BYTES, BLOCK, COLUMNS = 3_000_000, 512, 4096

IS_WORD = np.ones(256, bool)
IS_WORD[[9, 10, 11, 12, 13, 32]] = False


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts after one another, sorted by text, and where each text's begin."""
    data, bounds = byte_rows(column)
    n_texts = len(bounds) - 1
    words = Words(data, bounds, IS_WORD)
    count = np.bincount(words.text, minlength=n_texts)
    at, code = words.windows(SHINGLE)
    owner = words.text[at]
    for n in range(1, SHINGLE):
        short = count == n
        if short.any():
            at, part = words.windows(n)
            mine = short[words.text[at]]
            owner, code = np.concatenate([owner, words.text[at][mine]]), np.concatenate([code, part[mine]])
    order = np.argsort(owner, kind="stable")
    owner, code = owner[order], mixed(code[order])
    edges = np.searchsorted(owner, np.arange(n_texts + 1))
    parts = [np.unique(code[a:b]) for a, b in zip(edges[:-1], edges[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate([np.zeros(0, np.uint64), *parts]), np.concatenate([[0], np.cumsum(sizes)])


def super_minhash(codes: np.ndarray, bounds: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """For each text and slot the least value: the step in the high half, a random number in the low."""
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    low = np.full((n, slots), np.iinfo(np.int64).max, np.int64)
    flat = low.reshape(-1)
    place = None
    for step in range(slots):
        draw = mixed(codes + np.uint64((step + 1) * int(STEP) % 2**64))
        value = (draw >> np.uint64(32)).astype(np.int64) | (step << 32)
        pick = step + (((draw & np.uint64(0xFFFFFFFF)) * np.uint64(slots - step)) >> np.uint64(32)).astype(np.int64)
        if place is None:
            slot = pick
        else:
            rows = np.arange(len(place))
            slot = place[rows, pick].astype(np.int64)
            place[rows, pick] = place[rows, step]
        np.minimum.at(flat, owner * slots + slot, value)
        open_text = low.max(axis=1) >= (step + 1) << 32
        going = open_text[owner]
        if not going.any():
            break
        if place is None:
            codes, owner, pick = codes[going], owner[going], pick[going]
            place = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint16), (len(codes), 1))
            place[np.arange(len(codes)), pick] = 0
        elif going.sum() < 0.7 * len(going):
            codes, owner, place = codes[going], owner[going], place[going]
    return low


def bands_of(low: np.ndarray) -> np.ndarray:
    """A hash for each band of slots, the number of the band included."""
    parts = low.astype(np.uint64).reshape(len(low), BANDS, ROWS)
    total = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64) * MIX2, (len(low), 1))
    for k in range(ROWS):
        total = mixed(total * STEP + parts[:, :, k])
    return total.astype(np.int64)


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", PART_BYTES):
            codes, bounds = shingle_sets(batch.column(2))
            bands = bands_of(super_minhash(codes, bounds))
            filled = np.diff(bounds) > 0
            lists = pa.array([b if f else [] for b, f in zip(bands, filled)], pa.list_(pa.int64()))
            sums = [pa.array(_sums(mixed(codes ^ key), bounds)) for key in (MIX1, MIX2)]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(bounds)), *sums, lists]
            yield pa.RecordBatch.from_arrays(columns, ["tag", "doc_id", "n", "sum1", "sum2", "bands"])


def _links(sets: list[np.ndarray], outside: np.ndarray, component: np.ndarray) -> list[tuple[int, int]]:
    """Similar pairs that join different components, one of each at least ``outside``, as a forest."""
    size = np.array([len(s) for s in sets])
    code, place = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = np.bincount(place)[place] > 1
    row, place = row[shared], np.unique(place[shared], return_inverse=True)[1]
    both = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(place, kind="stable")
    row, place = row[order], place[order]
    edges = np.searchsorted(place, np.arange(0, len(code) + COLUMNS, COLUMNS))
    for a, b in zip(edges[:-1], edges[1:]):  # counts of common shingles are exact in float32
        if a < b:
            has = np.zeros((len(sets), COLUMNS), np.float32)
            has[row[a:b], place[a:b] % COLUMNS] = 1
            both += has @ has.T
    both = both.astype(np.int64)
    similar = 100 * both >= PERCENT * (size[:, None] + size[None, :] - both)
    similar &= (outside[:, None] | outside[None, :]) & (component[:, None] != component[None, :])
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    found = []
    for a, b in zip(*np.nonzero(np.triu(similar))):
        x, y = find(a), find(b)
        if x != y:
            root[x] = y
            found.append((int(a), int(b)))
    return found


def _verify(table: pa.Table) -> pa.Table:
    """Links within each unit of a bundle, on whole sets."""
    order = np.argsort(table.column("unit").to_numpy(), kind="stable")
    unit, ids = table.column("unit").to_numpy()[order], table.column("id").to_numpy()[order]
    outside, component = table.column("outside").to_numpy()[order], table.column("component").to_numpy()[order]
    codes, bounds = shingle_sets(table.column("text").combine_chunks().take(pa.array(order)))
    first = np.flatnonzero(np.diff(unit, prepend=unit[0] - 1))
    links = []
    for a, b in zip(first, np.append(first[1:], len(unit))):
        sets = [codes[bounds[k] : bounds[k + 1]] for k in range(a, b)]
        links += [(ids[a + x], ids[a + y]) for x, y in _links(sets, outside[a:b], component[a:b])]
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})


def _verified(units: DataFrame, texts: DataFrame, n_rows: int) -> DataFrame:
    """Links (a, b) within units (unit, id, outside, component); a bundle of units has some ``BLOCK`` rows."""
    bundles = max(1, n_rows // BLOCK)
    rows = units.join(texts, "id").withColumn("bundle", F.pmod(F.col("unit"), F.lit(bundles)))
    return rows.select("bundle", "unit", "id", "outside", "component", "text").groupBy("bundle").applyInArrow(_verify, "a long, b long")


def _candidate_groups(classes: DataFrame) -> DataFrame:
    """node and component: classes that are connected by buckets. A bucket adds a star, not its pairs."""
    members = classes.select("id", F.explode("bands").alias("bucket"))
    hubs = members.groupBy("bucket").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    return components(members.join(hubs.drop("size"), "bucket").select(F.col("id").alias("a"), F.col("hub").alias("b")))


def _grouped(docs: DataFrame) -> DataFrame:
    """tag, doc_id, n (size of its set) and best (of its group: what tells the row that stays) for each row.

    ``docs`` is a written table with tag (which tells rows apart), doc_id and text.
    """
    kind = docs.schema["doc_id"].dataType
    numbers = [T.StructField(c, T.LongType()) for c in ("n", "sum1", "sum2")]
    named = [T.StructField("tag", T.LongType()), T.StructField("doc_id", kind)]
    schema = T.StructType([*named, *numbers, T.StructField("bands", T.ArrayType(T.LongType()))])
    rows = stage(docs.mapInArrow(_sketch, schema), "sketches")
    sets = ["sum1", "sum2", "n"]
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tag")
    members = rows.filter("n > 0").groupBy(*sets)
    classes = stage(members.agg(F.min("tag").alias("id"), F.min(own).alias("best"), F.first("bands").alias("bands")), "classes")

    candidates = _candidate_groups(classes)
    groups = stage(candidates.select(F.col("node").alias("id"), F.col("component").alias("group")), "groups")
    texts = stage(docs.join(groups, F.col("tag") == F.col("id")).select("id", "text"), "texts")
    blocks = groups.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = groups.join(blocks, "group").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    units = dealt.select(F.xxhash64("group", "block").alias("unit"), "id", F.lit(True).alias("outside"), F.col("id").alias("component"))
    inner = stage(_verified(units, texts, groups.count()), "links")
    found = stage(components(inner), "components")

    # What is left are links between components of one group. All but the largest meet all.
    placed = groups.join(found, F.col("id") == F.col("node"), "left").select("group", "id", F.coalesce("component", "id").alias("component"))
    placed = stage(placed, "placed")
    parts = placed.groupBy("group", "component").agg(F.count(F.lit(1)).alias("n"))
    main = F.max_by("component", F.struct("n", "component")).alias("main")
    largest = parts.groupBy("group").agg(main, F.sum("n").alias("all"), F.max("n").alias("most"))
    largest = largest.filter("`all` > most").withColumns(
        {"all_blocks": F.ceil(F.col("all") / BLOCK), "outside_blocks": F.ceil((F.col("all") - F.col("most")) / BLOCK)}
    )
    # A group of one block has been compared whole.
    apart = placed.join(largest.filter("all_blocks > 1"), "group").withColumn("outside", F.col("component") != F.col("main"))
    spread = F.xxhash64("id")
    each = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    as_outside = apart.filter("outside").withColumns({"i": F.pmod(spread, F.col("outside_blocks")), "j": F.explode(each("all_blocks"))})
    as_member = apart.withColumns({"i": F.explode(each("outside_blocks")), "j": F.pmod(spread, F.col("all_blocks"))})
    columns = [F.xxhash64("group", "i", "j").alias("unit"), "id", "outside", "component"]
    units = stage(as_outside.select(*columns).union(as_member.select(*columns)).distinct(), "units")
    across = stage(_verified(units, texts, units.count()), "links")
    if not across.isEmpty():
        stars = found.select(F.col("node").alias("a"), F.col("component").alias("b"))
        found = stage(components(stars.union(across)), "components")

    grouped = classes.join(found, classes["id"] == found["node"], "left").select(*sets, "best", F.coalesce("component", "id").alias("component"))
    whole = grouped.groupBy("component").agg(F.min("best").alias("best"))
    grouped = grouped.drop("best").join(whole, "component").drop("component")
    result = rows.drop("bands").join(grouped, sets, "left")
    return result.select("tag", "doc_id", "n", F.when(F.col("n") > 0, F.col("best")).otherwise(own).alias("best"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document."""
    rows, tag = tagged(docs.select("doc_id", "text"))
    found = _grouped(rows.select(F.col(tag).alias("tag"), "doc_id", "text"))
    group = F.col("best.doc_id")
    return found.select("doc_id", F.col("n").alias("n_shingles"), group.alias("component_id"), F.col("doc_id").eqNullSafe(group).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """Exactly one row of each group, with all its columns, whatever ids are null or repeated."""
    rows, tag = tagged(docs)
    found = _grouped(rows.select(F.col(tag).alias("tag"), "doc_id", "text"))
    kept = found.filter(F.col("tag") == F.col("best.tag")).select(F.col("tag").alias("_kept_row"))
    return rows.join(kept, rows[tag] == kept["_kept_row"], "left_semi").drop(tag)
