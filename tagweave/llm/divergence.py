"""Source divergence audit: how differently the sources of a language use its words, by bitmaps of counts.

Terms with the same count in a source weigh the same, so a source is stored as one bitmap of terms for
each count. For two sources, AND and popcount of two bitmaps give the number of terms with this pair of
counts, a joint cell, which is multiplied by the difference f of its two shares. Terms that one source
lacks are never listed: their cells are the complement, what the popcounts leave of a bitmap.

Words are counted in the tasks that read texts, source by source. Terms that enough documents of a
language hold are dealt over blocks of about ``BLOCK`` terms by their hash and numbered there, the
frequent ones first, so that terms of like counts share words of 64 bits. Only words with a bit are
kept, and cells are looked for word by word. A task compares at most ``CHUNK`` sources with ``CHUNK``
others in one block, and values of blocks are summed, so neither a language with all terms nor one with
many sources is one task. The result of the pairs itself has a row for every two sources of a language.

Everything is integer arithmetic. Defined results: null text, language and source are empty; each row is
a document, also one that repeats an id; a group without terms and a language without kept terms still
have pairs, with value 0 where no term is kept; a single source of a language has no pair; of equal
values the item that comes first in UTF-8 ranks first; a text is read in pieces, whatever its length;
an empty table gives an empty result; further columns are neither read nor returned.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.llm.common import slices, stage

LEAST_DOCUMENTS, TOP_TERMS, SMOOTHING, UNIT = 30, 50, 5, 1_000_000_000
BLOCK, CHUNK = 4096, 256
#: Entries that a task counts before it hands them on, and bytes of a text that are cut at once.
ENTRIES, PIECE = 500_000, 1 << 20
#: Joint cells that are worked out at once.
CELLS = 1 << 20

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, piece by piece; a piece ends where a term ends."""
    begin = 0
    while begin < len(text):
        end = min(begin + PIECE, len(text))
        while end < len(text) and _TO_WORDS[text[end]] != 32:
            end += 1
        yield text[begin:end].translate(_TO_WORDS).split()
        begin = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts and numbers of documents by language, source and term, summed over what a task reads."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def flush() -> pa.RecordBatch:
        columns: list[list[pa.Array]] = [[], [], [], [], []]
        for (lang, source), (n, docs) in counts.items():
            terms = list(n)
            told = [pa.repeat(pa.scalar(x, pa.string()), len(terms)) for x in (lang, source)]
            told += [pa.array(terms, pa.binary()), pa.array(n.values(), pa.int64()), pa.array(map(docs.__getitem__, terms), pa.int64())]
            for column, part in zip(columns, told):
                column.append(part)
        counts.clear()
        types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        whole = [pa.concat_arrays(c) if c else pa.array([], t) for c, t in zip(columns, types)]
        return pa.RecordBatch.from_arrays(whole, ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for part in slices(batch, "text", 1 << 22):
            for lang, source, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
                seen: set[bytes] = set()
                for words in words_of(text):
                    n.update(words)
                    seen.update(words)
                docs.update(seen)
            if sum(len(of[0]) for of in counts.values()) > ENTRIES:
                yield flush()
    yield flush()


def _share(count: Column | str) -> Column:
    """Smoothed share of a count, in units of 1 / UNIT and rounded down, and one more; needs total and v."""
    count = F.col(count) if isinstance(count, str) else count
    above = (count + SMOOTHING).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = (F.col("total") + F.lit(SMOOTHING).cast("long") * F.col("v")).cast("decimal(20,0)")
    return F.call_function("div", above, below).cast("long") + 1


def _joint(g: np.ndarray, h: np.ndarray, share: np.ndarray, bits: np.ndarray, zero: np.ndarray, source: np.ndarray):
    """For pairs of entries (a bitmap word of a source each): what their joint cells add to the sources' values.

    Where both have a term, its two complement cells, counted for either source alone, are taken back.
    """
    both = np.bitwise_count(bits[g] & bits[h]).astype(np.int64)
    hit = np.flatnonzero(both)
    g, h, both = g[hit], h[hit], both[hit]
    p, q, p0, q0 = share[g], share[h], zero[source[g]], zero[source[h]]
    f = np.abs(p - q) - np.abs(p - q0) - np.abs(q - p0) + np.abs(p0 - q0)
    return source[g], source[h], both * f


def block_values(
    left: np.ndarray,
    right: np.ndarray,
    zero: np.ndarray,
    size: int,
    source: np.ndarray,
    word: np.ndarray,
    share: np.ndarray,
    bits: np.ndarray,
) -> np.ndarray:
    """Values of pairs of sources within one block of ``size`` terms, as a matrix with one side in the rows.

    ``left`` and ``right`` mark the sources of either side; where the sides are the same, only what is
    above the diagonal is worked out. ``zero`` is each source's share of a term that it lacks. Entries
    are bitmap words of 64 terms: the source, the number of the word, the share that belongs to the
    count, and the bits.
    """
    n, same = len(zero), bool((left == right).all())
    values = np.zeros((n, n), np.int64)
    held = np.bincount(source, weights=np.bitwise_count(bits), minlength=n).astype(np.int64)
    # Each source against one that has none of its terms, and terms that both lack.
    for s in range(n):
        own = source == s
        if own.any():
            alone = np.abs(share[own][:, None] - zero[None, :]) * np.bitwise_count(bits[own]).astype(np.int64)[:, None]
            lacking = alone.sum(axis=0)
            values[s, :] += lacking
            values[:, s] += lacking
    values += (size - held[:, None] - held[None, :]) * np.abs(zero[:, None] - zero[None, :])
    order = np.lexsort((source, word))
    source, word, share, bits = source[order], word[order], share[order], bits[order]
    # Entries of the left meet those of the right with the same word, and later sources if sides are the same.
    partners = np.flatnonzero(right[source])
    place = word.astype(np.int64) * n + source
    first = np.searchsorted(place[partners], place + 1 if same else word.astype(np.int64) * n)
    last = np.searchsorted(place[partners], (word.astype(np.int64) + 1) * n)
    entries = np.flatnonzero(left[source] & (last > first))
    steps = np.cumsum(last[entries] - first[entries])
    begin = 0
    while begin < len(entries):
        done = steps[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(steps, done + CELLS, "right")))
        part = entries[begin:end]
        n_partners = last[part] - first[part]
        g = np.repeat(part, n_partners)
        within = np.arange(len(g)) - np.repeat(np.cumsum(n_partners) - n_partners, n_partners)
        h = partners[np.repeat(first[part], n_partners) + within]
        a, b, value = _joint(g, h, share, bits, zero, source)
        np.add.at(values, (a, b), value)
        begin = end
    return values


def _compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Values of the pairs of two chunks of sources in a block. A row without bits tells of a source."""
    table = pa.Table.from_batches(batches)
    _, _, left_chunk, right_chunk = (k.as_py() for k in key)
    column = {n: table.column(n) for n in table.schema.names}
    is_source = column["bits"].is_null().to_numpy()
    told = table.filter(pa.array(is_source)).sort_by("source")
    names = told.column("source").to_pylist()
    number = {name: k for k, name in enumerate(names)}
    chunk = told.column("chunk").to_numpy()
    entries = table.filter(pa.array(~is_source))
    source = np.array([number[s] for s in entries.column("source").to_pylist()], np.int64)
    left, right = chunk == left_chunk, chunk == right_chunk
    values = block_values(
        left,
        right,
        told.column("share").to_numpy(),
        told.column("size")[0].as_py(),
        source,
        entries.column("word").to_numpy(),
        entries.column("share").to_numpy(),
        entries.column("bits").to_numpy().view(np.uint64),
    )
    a, b = np.nonzero(left[:, None] & right[None, :])
    if left_chunk == right_chunk:
        a, b = a[a < b], b[a < b]
    texts = np.array(names, object)
    lang = [key[0].as_py()] * len(a)
    yield pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(texts[a], pa.string()), pa.array(texts[b], pa.string()), pa.array(values[a, b])],
        ["lang", "one", "other", "value"],
    )


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n and docs: how often and in how many documents, for every term."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    texts = docs.select(empty("lang").alias("lang"), empty("source").alias("source"), empty("text").cast("binary").alias("text"))
    parts = texts.mapInArrow(_counted, "lang string, source string, term binary, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Audit:
    """Counts, kept terms and groups of a corpus, each written once; ``pairs`` and ``terms`` are the results."""

    def __init__(self, docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, block: int = BLOCK, chunk: int = CHUNK):
        counts = stage(term_counts(docs), "terms")
        empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
        found = docs.select(empty("lang"), empty("source")).distinct()
        kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs"))
        kept = stage(kept.filter(F.col("docs") >= least_documents).drop("docs"), "kept")
        sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("of_lang").alias("lang_total"))
        langs = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources")).join(sizes, "lang", "left").fillna(0)
        n_blocks = F.greatest(F.ceil(F.col("v") / block), F.lit(1)).cast("int")
        n_chunks = F.ceil(F.col("n_sources") / chunk).cast("int")
        langs = stage(langs.withColumns({"n_blocks": n_blocks, "n_chunks": n_chunks}), "langs")
        self.counts = stage(
            counts.drop("docs").join(kept, ["lang", "term"]).join(langs.select("lang", "v", "lang_total"), "lang"), "counts"
        )
        totals = self.counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        groups = found.join(totals, ["lang", "source"], "left").fillna(0, ["total"]).join(langs, "lang")
        mixed = F.pmod(F.xxhash64("source"), F.col("n_chunks").cast("long")).cast("int")
        self.groups = stage(groups.withColumn("chunk", mixed), "groups")
        blocks = kept.join(langs.select("lang", "n_blocks"), "lang")
        blocks = blocks.withColumn("block", F.pmod(F.xxhash64("term"), F.col("n_blocks").cast("long")).cast("int"))
        # The numbers of a block's terms: blocks are small, and a language has many of them.
        number = F.row_number().over(Window.partitionBy("lang", "block").orderBy(F.desc("of_lang"), "term")) - 1
        self.numbered = stage(blocks.select("lang", "term", "block", number.alias("number")), "numbered")

    def bitmaps(self) -> DataFrame:
        """Words of 64 bits, by group, block and count (told by its share): bit k is term 64 * word + k."""
        rows = self.counts.select("lang", "source", "term", "n").join(self.numbered, ["lang", "term"])
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("number") % 64).cast("int"))
        keys = ["lang", "source", "block", F.expr("number div 64").cast("int").alias("word"), "n"]
        words = rows.groupBy(*keys).agg(F.bit_or(bit).alias("bits"))
        groups = self.groups.select("lang", "source", "total", "v", "chunk", "n_chunks")
        return words.join(groups, ["lang", "source"]).withColumn("share", _share("n"))

    def pairs(self) -> DataFrame:
        """lang, source, item, value: each group with each other source of its language."""
        told = self.groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        size = self.numbered.groupBy("lang", "block").agg(F.count(F.lit(1)).alias("size"))
        told = told.join(size, ["lang", "block"], "left").fillna(0, ["size"])
        zero = _share(F.lit(0).cast("long"))
        told = told.withColumn("share", F.when(F.col("v") > 0, zero).otherwise(0))
        columns = ["lang", "source", "block", "chunk", "n_chunks", "share"]
        none = lambda kind: F.lit(None).cast(kind)
        rows = told.select(*columns, "size", none("int").alias("word"), none("long").alias("bits"))
        rows = rows.unionByName(self.bitmaps().select(*columns, none("long").alias("size"), "word", "bits"))
        meet = F.transform(
            F.sequence(F.lit(0), F.col("n_chunks") - 1),
            lambda c: F.struct(F.least(c, "chunk").alias("left_chunk"), F.greatest(c, "chunk").alias("right_chunk")),
        )
        rows = rows.select("*", F.inline(meet)).drop("n_chunks")
        parts = rows.groupBy("lang", "block", "left_chunk", "right_chunk").applyInArrow(
            _compare, "lang string, one string, other string, value long"
        )
        values = parts.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
        either = F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("one").alias("item")))
        return values.select("lang", F.inline(either), "value")

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """lang, source, item, value, rank: the terms that a group uses more than its language, by how much."""
        totals = self.groups.select("lang", "source", "total")
        p = _share("n")
        rows = self.counts.join(totals, ["lang", "source"]).withColumn("p", p)
        rows = rows.drop("total").withColumnRenamed("lang_total", "total").withColumn("q", _share("of_lang"))
        rows = rows.filter(F.col("p") > F.col("q"))
        rows = rows.select("lang", "source", F.col("term").cast("string").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        return _ranked(rows).filter(F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def divergence_audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS, **sizes: int) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank; ``docs`` has text, lang and source."""
    audit = Audit(docs, least_documents, **sizes)
    part = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(_ranked(audit.pairs()), "pair").unionByName(part(audit.terms(top), "term"))
