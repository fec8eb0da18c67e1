"""Source divergence, centroid clustering and licence scans, against plain loops over hostile rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from plain import CLASHING, frame, words_of
from tagweave.llm import centroids, divergence, licenses


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ---- source divergence -----------------------------------------------------------------------------


def corpus(seed=5, n=260):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("tha", "in", "Öre", "LO", "Ü") for b in ("x", "nd", "Ring", "ß", "É", "ble")]
    rows = []
    for k in range(n):
        lang, source = rng.choice(["en", "en", "de", None]), rng.choice(["a", "b", "B", "é", None, "", "z9"])
        favoured = rng.sample(words, 9)
        text = rng.choice([" ", "\n", "-", "_7"]).join(rng.choice(favoured) for _ in range(rng.choice((0, 3, 40))))
        rows.append((k % 200, text, lang, source))
    rows += [(1, None, "fr", "only"), (2, "", "it", "x"), (3, "---", "it", "y"), (4, "rare words here", "it", "y")]
    rows += [(5, "tha " * 20_000, "en", "long"), (6, "x" * 300_000, "de", "long")]
    rows += [(7, "ring ring inx", "en", "hot")] * 90
    return rows


def audited(rows, least):
    """The contract of the audit, term by term."""
    pattern = "[^\x00-\x40\x5b-\x60\x7b-\x7f]+"
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        words = words_of(text, pattern)
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        counts[lang, source].update(words)
        docs[lang].update(set(words))
    found = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def shares(count):
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // total for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(whole)
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, top in (("pair", pairs, None), ("term", terms, 50)):
                ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:top]
                found += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(ranked, 1)]
    return sorted(found, key=repr)


DOCS = "doc_id long, text string, lang string, source string"
AUDIT_CLASHES = [*CLASHING, "term", "docs", "total", "v", "share", "word", "bits", "block", "chunk", "number", "value", "item", "part"]


@pytest.mark.parametrize("sizes", [{}, {"block": 3, "chunk": 2}])
def test_audit_equals_plain_loops(spark, sizes):
    rows = corpus()
    found = divergence.divergence_audit(frame(spark, rows, DOCS, AUDIT_CLASHES), least_documents=12, **sizes)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert rows_of(found) == audited(rows, 12)


def test_audit_without_kept_terms_or_rows(spark):
    rows = corpus(n=40)
    assert rows_of(divergence.divergence_audit(frame(spark, rows, DOCS), least_documents=1000)) == audited(rows, 1000)
    assert divergence.divergence_audit(spark.createDataFrame([], DOCS)).collect() == []


def test_shares_of_counts_beyond_a_long(spark):
    rows = spark.createDataFrame([(10**13, 3 * 10**13, 7)], "n long, total long, v long")
    assert rows.select(divergence._share("n")).first()[0] == 1 + 10**9 * (10**13 + 5) // (3 * 10**13 + 35)


def test_words_in_pieces_are_those_of_the_text(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 7)
    text = "Ab cdé-fghijklmnopq  r\tÜß"
    assert [w.decode() for words in divergence.words_of(text.encode()) for w in words] == words_of(text, "[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def test_counts_are_handed_on_when_they_are_many(spark, monkeypatch):
    rows = corpus(9)
    expected = rows_of(divergence.term_counts(frame(spark, rows, DOCS)))
    import pyarrow as pa

    monkeypatch.setattr(divergence, "ENTRIES", 10)
    texts = [(t or "").encode() for _, t, _, _ in rows]
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "" for r in rows]), pa.array([r[3] or "" for r in rows]), pa.array(texts)], ["lang", "source", "text"])
    sums = defaultdict(lambda: [0, 0])
    parts = list(divergence._counted(iter([batch.slice(k, 20) for k in range(0, len(rows), 20)])))
    for part in parts:
        for lang, source, term, n, docs in zip(*(c.to_pylist() for c in part.columns)):
            sums[lang, source, term][0] += n
            sums[lang, source, term][1] += docs
    assert len(parts) > 3 and sorted(((*k, *v) for k, v in sums.items()), key=repr) == sorted(
        ((r[0], r[1], bytes(r[2]), r[3], r[4]) for r in expected), key=repr
    )


# ---- centroid clustering ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>"


def vectors(seed=3, n=300, wide=False):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        centre = rng.choice([-2.0, 0.0, 1.5])
        rows.append((k, [float(np.float32(rng.gauss(centre, 900.0 if wide else 0.4))) for _ in range(64)]))
    same = [0.25] * 64
    rows += [(1000 + k, same) for k in range(80)]
    rows += [(7, same), (None, same), (None, [0.5] * 64)]
    rows += [(2000, None), (2001, [0.1] * 63), (2002, []), (2003, [None] + [0.1] * 63), (2004, [math.nan] + [0.1] * 63), (2005, [math.inf] * 64), (2006, [-math.inf] * 64)]
    return rows


def clustered(rows, k=16, rounds=3):
    fine = lambda v: v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if fine(v)]
    digest = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        of = defaultdict(list)
        for _, v in kept:
            of[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(x) for x in zip(*of[n])] if of[n] else c for n, c in enumerate(centres)]
    last = [(i, *nearest(v)) for i, v in kept]
    sums = Counter()
    for _, far, n in last:
        sums[n] += far
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((i, n, far, sums[n], sum(sums.values()), sha(centres[n])) for i, far, n in last), key=repr)


@pytest.mark.parametrize("n, wide", [(300, False), (300, True), (2, False)])
def test_clusters_equal_plain_loops(spark, n, wide):
    rows = vectors(n=n, wide=wide)
    found = centroids.cluster_vectors(frame(spark, rows, VECTORS, [*CLASHING, "vector", "cluster", "distance", "inertia"]))
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert rows_of(found) == clustered(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    few = vectors()[:3]
    assert rows_of(centroids.cluster_vectors(frame(spark, few, VECTORS))) == clustered(few)
    assert centroids.cluster_vectors(spark.createDataFrame([], VECTORS)).collect() == []
    assert centroids.cluster_vectors(frame(spark, [(1, None), (2, [1.0])], VECTORS)).collect() == []


def test_ties_go_to_the_smaller_number():
    cluster, far = centroids.nearest(np.array([[0, 0], [2, 0]]), np.array([[1, 0], [-1, 0], [3, 0]]))
    assert cluster.tolist() == [0, 0] and far.tolist() == [1, 1]


def test_a_component_out_of_range_is_an_error(spark):
    with pytest.raises(Exception, match="a component of a vector is"):
        centroids.cluster_vectors(frame(spark, [(1, [3e30] * 64)], VECTORS)).collect()


# ---- licence scans ---------------------------------------------------------------------------------

WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def scanned(docs):
    """Base places and accepted templates by looking at every place of every template."""
    words = {k: words_of(text, WORD) for k, (_, text) in enumerate(docs)}
    licence = {w for _, passage, _ in licenses.TEMPLATES for w in passage.split()} | {w for p in licenses.BASE for w in p.split()}
    licence |= {w for _, _, phrases in licenses.TEMPLATES for p in phrases for w in p.split()}
    n_docs = Counter(w for own in words.values() for w in set(own) & licence)
    idf = lambda w: math.log((1 + len(docs)) / (1 + n_docs[w])) if n_docs[w] else math.inf
    found = []
    for k, (doc_id, _) in enumerate(docs):
        own = words[k]
        stands = lambda at, phrase: at >= 0 and own[at : at + len(phrase)] == phrase
        base = [(i, label) for phrase, label in licenses.BASE.items() for i in range(len(own)) if stands(i, phrase.split())]
        labels, best = {label for _, label in base}, 0.0
        for label, passage, phrases in licenses.TEMPLATES:
            template = passage.split()
            rare = sorted(set(template) & set(own), key=lambda w: (-idf(w), w))[: licenses.LOOKED_UP]
            for begin in range(-len(template), len(own)):
                agree = sum(w in rare and 0 <= begin + j < len(own) and own[begin + j] == w for j, w in enumerate(template))
                verified = all(
                    any(stands(begin + licenses._place_in(passage, p) + s, p.split()) for s in range(-licenses.SLACK, licenses.SLACK + 1))
                    for p in phrases
                )
                if agree >= licenses.LEAST and verified:
                    labels.add(label)
                    best = max(best, min(1.0, agree / min(licenses.LOOKED_UP, len(set(template)))))
        places = [i for i, _ in base]
        joined = ",".join(sorted({label for _, label in base}))
        found.append((doc_id, len(own), len(base), min(places, default=None), max(places, default=None), joined, ",".join(sorted(labels)), 1.0 if base else best))
    return sorted(found, key=repr)


def licensed(seed=4):
    rng = random.Random(seed)
    passages = [passage for _, passage, _ in licenses.TEMPLATES] + list(licenses.BASE) + ["mit license", "version 2 0", "gnu general"]
    common = "the of work under this Licence license software gène nué 4 0 by and".split()
    texts = []
    for _ in range(90):
        parts = []
        for _ in range(rng.randint(1, 6)):
            own = rng.choice(passages).split() if rng.random() < 0.6 else [rng.choice(common) for _ in range(rng.randint(1, 12))]
            for _ in range(rng.choice((0, 0, 1, 3))):
                at = rng.randrange(len(own))
                own[at : at + rng.randint(0, 1)] = rng.choice((["changed"], ["Mit"], []))
                own = own or ["x"]
            parts.append("".join(w.upper() if rng.random() < 0.2 else w for w in rng.choice((" ", ", ", "\n - ")).join(own).split("|")))
        texts.append(rng.choice((". ", " ", "\x00")).join(parts))
    texts += [None, "", " -- ", "x" * 50_000, "cc by", "CC-BY", "ccby", "reserved all rights", "All Rights; Reserved!", "gnu lesser general public license"]
    rows = list(enumerate(texts))
    return [*rows, rows[3], (None, texts[5]), (None, None)]


def test_licences_equal_plain_loops(spark):
    docs = licensed()
    found = licenses.scan_licenses(frame(spark, docs, extra=[*CLASHING, "words", "hits", "held", "phrases", "votes", "found", "labels", "asked", "both"]))
    expected = scanned(docs)
    assert rows_of(found.drop("found")) == expected
    assert len({r[6] for r in expected}) > 15 and any(0 < r[7] < 1 for r in expected)


def test_a_very_long_text_of_notices_is_scanned_in_linear_time(spark):
    notice = "Released under the MIT License. Licensed under CC BY-NC 4.0. "
    row = licenses.scan_licenses(frame(spark, [(1, notice * 20_000), (2, "the " * 300_000)])).orderBy("doc_id").collect()
    assert (row[0].n_words, row[0].n_base, row[0].labels, row[0].score) == (240_000, 20_000, "cc-by,cc-by-nc,mit", 1.0)
    assert row[0].last_word == 239_995 and len(row[0].found) == 40_000
    assert (row[1].n_words, row[1].labels) == (300_000, "")


def test_no_documents_and_templates_of_ones_own(spark):
    assert licenses.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    own = [("house", "this belongs to the house of cards", ["house of cards"])]
    docs = frame(spark, [(1, "This belongs to the house of cards."), (2, "a house of cards"), (3, "MIT License")])
    assert [r.labels for r in licenses.scan_licenses(docs, own, {}).orderBy("doc_id").collect()] == ["house", "house", ""]
    with pytest.raises(ValueError):
        licenses.scan_licenses(docs, [("x", "a b", ["c"])], {})


def test_only_built_in_functions_are_used(spark):
    plan = licenses.scan_licenses(frame(spark, [(1, "MIT License")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
