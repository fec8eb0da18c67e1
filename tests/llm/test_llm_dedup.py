"""Duplicates: exact, near, and repeated passages, against plain loops over hostile documents."""

import random
import re

import pytest

from plain import covered_bytes, documents, exact_groups, frame, near_groups, sha
from tagweave.llm import exact_dedup, minhash, substring_dedup, suffix_dedup

DOCS = documents()
UNIQUE = [r for r in dict(DOCS).items() if r[0] is not None]


RECALL = {0.1: 0.98, 0.15: 0.95, 0.18: 0.9}


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_exact_copies(spark):
    groups = exact_groups(DOCS)
    expected = []
    for doc_id, text in DOCS:
        plain = re.sub("[\x20\x09-\x0d]", "", text or "")
        keep, size = groups[plain]
        expected.append((doc_id, keep, size, doc_id == keep, sha(plain)))
    assert rows_of(exact_dedup.exact_dedup(frame(spark, DOCS))) == sorted(expected, key=repr)


@pytest.mark.parametrize("runs, fan", [(1, 2), (10, 3)])
def test_exact_copies_through_any_tree(spark, runs, fan):
    found = exact_dedup.exact_dedup(frame(spark, DOCS), runs, fan)
    groups = {keep: size for keep, size in exact_groups(DOCS).values()}
    assert {(r.keep_id, r.group_size) for r in found.collect()} == set(groups.items())


def test_exact_stage_keeps_columns_and_one_of_each_group(spark):
    docs = frame(spark, UNIQUE)
    kept = exact_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(keep for keep, _ in exact_groups(UNIQUE).values())


def test_near_copies(spark):
    groups = near_groups(UNIQUE)
    found = minhash.near_duplicates(frame(spark, UNIQUE))
    expected = [(d, n, c, d == c) for d, (n, c) in groups.items()]
    assert rows_of(found) == sorted(expected, key=repr)
    assert sum(d != c for d, (_, c) in groups.items()) > 10


LONG_A, LONG_B = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
ODD_IDS = [(None, LONG_A), (None, LONG_A), (1, LONG_A), (None, LONG_B), (2, LONG_A), (2, LONG_B), (9, LONG_B), (9, ""), (None, None), (None, "")]


def test_near_copies_of_repeated_and_null_ids(spark):
    """Rows are grouped as if each had an id of its own; the smallest id of a group stands for it."""
    for docs in (DOCS, ODD_IDS):
        groups = near_groups(list(enumerate(text for _, text in docs)))
        smallest = {}
        for k, (_, component) in groups.items():
            smallest[component] = min(smallest.get(component, (True, 0)), (docs[k][0] is None, docs[k][0] or 0))
        named = {c: None if last else d for c, (last, d) in smallest.items()}
        expected = [(docs[k][0], n, named[c], docs[k][0] == named[c]) for k, (n, c) in groups.items()]
        assert rows_of(minhash.near_duplicates(frame(spark, docs))) == sorted(expected, key=repr)


@pytest.mark.parametrize("drop, n_empty", [(exact_dedup.drop_copies, 1), (minhash.drop_near_copies, 3)])
def test_stages_keep_one_row_of_each_group_whatever_the_ids(spark, drop, n_empty):
    docs = frame(spark, ODD_IDS, extra=["_row", "tag", "best", "n", "row", "lang"])
    kept = drop(docs)
    assert kept.columns == docs.columns
    rows = sorted((r.doc_id, r.text) for r in kept.collect() if r.text)
    assert rows == [(1, LONG_A), (2, LONG_B)]
    assert kept.filter("text is null or text = ''").count() == n_empty
    assert drop(docs.limit(0)).collect() == []


@pytest.mark.parametrize("block", [3, 512])
def test_groups_of_several_blocks_are_compared_to_the_end(spark, monkeypatch, block):
    """Links that the smallest member of a group does not have are found through the others."""
    rng = random.Random(4)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(24):  # each next text has one word more changed, so that ends are not alike
        words = list(base)
        for j in range(k):
            words[(7 * j) % 60] = f"v{j}"
        rows.append((k, " ".join(words)))
    rng.shuffle(rows)
    groups = near_groups(rows)
    monkeypatch.setattr(minhash, "BLOCK", block)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    assert found == {d: c for d, (_, c) in groups.items()}


def test_signatures_estimate_similarity():
    import numpy as np

    rng = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.8) * 20:
        n = int(rng.integers(3, 400))
        both = max(1, int(share * n))
        pool = minhash.mixed(rng.integers(0, 2**63, 2 * n, dtype=np.uint64))
        a, b = pool[:n], np.concatenate([pool[:both], pool[n : 2 * n - both]])
        low = minhash.super_minhash(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, n, 2 * n]))
        errors.append((low[0] == low[1]).mean() - both / (2 * n - both))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.05


def test_repeated_strings(spark):
    rows = [r for r in DOCS if r[1] is None or len(r[1]) < 20000]
    found = suffix_dedup.suffix_dedup(frame(spark, rows)).drop("spans", "kept")
    assert rows_of(found) == sorted(covered_bytes(rows), key=repr)


def test_repeated_strings_over_many_small_parts(spark):
    rng = random.Random(3)
    pieces = ["ab", "the ", "é", "x", "\n", "lorem ipsum ", "a" * 20]
    lines = ["".join(rng.choice(pieces) for _ in range(40)) for _ in range(8)]
    rows = []
    for k in range(120):
        text = ""
        for _ in range(rng.randint(0, 5)):
            line = rng.choice(lines)
            at = rng.randint(0, len(line))
            text += line[at : rng.randint(at, len(line))] + rng.choice(pieces)
        rows.append((k * 7 % 120, text))
    found = suffix_dedup.suffix_dedup(frame(spark, rows, extra=()).repartition(16)).drop("spans", "kept")
    assert rows_of(found) == sorted(covered_bytes(rows), key=repr)


def test_strings_of_left_over_stretches_go_in_waves(spark, monkeypatch):
    """Each anchor is left over to one wave, and all waves together cover what one would."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9)))
    lines = [" ".join(word() for _ in range(14)) for _ in range(30)]
    rows = [(k, f"{word()} {rng.choice(lines)} {word()} {rng.choice(lines)[rng.randint(0, 9):]} {word()}") for k in range(80)]
    tables, write = [], suffix_dedup.stage
    monkeypatch.setattr(suffix_dedup, "stage", lambda df, name: tables.append((name, write(df, name))) or tables[-1][1])
    found = suffix_dedup.suffix_dedup(frame(spark, rows, extra=()).repartition(4)).drop("spans", "kept")
    assert rows_of(found) == sorted(covered_bytes(rows), key=repr)
    assert [name for name, _ in tables] == ["stretches", *["strings"] * suffix_dedup.WAVES] and suffix_dedup.WAVES > 1
    waves = {}
    for row in tables[0][1].filter("kind > 0").collect():
        for code in suffix_dedup._unpacked(row.blob)[0].tolist():
            waves.setdefault(code, set()).add(row.kind - suffix_dedup.LEFT)
    assert all(len(w) == 1 for w in waves.values()) and set().union(*waves.values()) == set(range(suffix_dedup.WAVES))


def test_suffixes_are_sorted_and_lies_of_hashes_seen(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    suffix = rng.permutation(2900)
    group = rng.integers(0, 5, len(suffix))
    expected = sorted((int(g), bytes(data[s : s + 50]), int(s)) for g, s in zip(group, suffix))
    for lie in (False, True):
        if lie:  # every hash is the same
            monkeypatch.setattr(suffix_dedup.Prefixes, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
        order, run = suffix_dedup.equal_runs(data, suffix, group, 50)
        found = [(int(group[k]), bytes(data[suffix[k] : suffix[k] + 50])) for k in order]
        assert found == [e[:2] for e in expected]
        assert [a == b for a, b in zip(run, run[1:])] == [a == b for a, b in zip(found, found[1:])]


def test_passages(spark):
    rng = random.Random(5)
    words = [f"w{k}" for k in range(2000)]
    fresh = lambda n: [rng.choice(words) for _ in range(n)]
    passage, other = fresh(120), fresh(51)
    changed = [w if k % 17 else rng.choice(words) for k, w in enumerate(passage)]
    rows = [
        (0, fresh(80) + passage + fresh(30)),
        (1, fresh(200)),
        (2, fresh(10) + passage + fresh(10)),
        (3, fresh(40) + changed + fresh(5)),
        (4, fresh(60) + other + fresh(60)),
        (5, other + fresh(100)),
        (6, passage[:30] + fresh(100)),
        (7, []),
    ]
    rows = [(d, " ".join(w)) for d, w in rows] + [(8, None), (None, " ".join(passage))]
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert len(found) == len(rows)
    # Which of several earlier documents is named depends on the parts they lie in.
    assert {d for d, r in found.items() if r.earlier} == {2, 3, 5, None}
    assert found[2].earlier == [0] and found[5].earlier == [4] and set(found[None].earlier) <= {0, 2, 3}
    assert 118 <= found[2].n_repeated <= 124 and 110 <= found[3].n_repeated <= 124 and 51 <= found[5].n_repeated <= 54
    assert found[0].n_later >= 1 and found[4].n_later == 1 and found[1].n_words == 200


def chained_by_loops(x, y):
    """Scores of the best chains that end in each link, over all predecessors within reach."""
    reach, score = substring_dedup.SEED + substring_dedup.WIDEST, []
    for i in range(len(x)):
        steps = [(x[i] - x[j], y[i] - y[j], score[j]) for j in range(i)]
        paid = [s - substring_dedup.GAP_COST * (a + b) for a, b, s in steps if 0 < a <= reach and 0 < b <= reach]
        score.append(substring_dedup.SEED + max([0, *paid]))
    return score


def test_chains_of_several_passages():
    import numpy as np

    rng = random.Random(6)
    for gap in (70, 90, 300, 1000):
        for n in (2, 3):
            links, at = [], 0
            for _ in range(n):
                links += [(at + k, at + k + 9) for k in range(0, rng.choice((54, 500)), 6)]
                at = links[-1][0] + gap
            x, y = map(np.array, zip(*links))
            found = substring_dedup.chains(x, y)
            assert len(found) == n and sorted(sum(found, [])) == list(range(len(x)))
    for _ in range(200):
        x, y = map(np.array, zip(*sorted({(rng.randrange(400), rng.randrange(400)) for _ in range(60)})))
        score = chained_by_loops(x, y)
        best = max(range(len(x)), key=lambda i: (score[i], -i))
        lines = {line[-1]: line for line in substring_dedup.chains(x, y)}
        gaps = lambda line: sum(x[b] - x[a] + y[b] - y[a] for a, b in zip(line, line[1:]))
        total = substring_dedup.SEED * len(lines[best]) - substring_dedup.GAP_COST * gaps(lines[best])
        assert abs(total - score[best]) < 1e-6


def test_poor_pairs_are_told_before_alignment(monkeypatch):
    """Of pairs with one run of equal words, those that are too poor around it are not aligned, and none that has a passage."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(11)
    rows, expected, poor = [], [], 0
    for k in range(1500):
        a, b = (rng.integers(0, 10**9, rng.integers(60, 260)).astype(np.uint32) for _ in range(2))
        n = int(rng.choice((7, 9, 20, 31, 32, 40, 60)))
        x, y = int(rng.integers(0, len(a) - n + 1)), int(rng.integers(0, len(b) - n + 1))
        share = rng.choice((0, 0, 0.7, 0.84))  # words around the run that are equal, but no six of them in a row
        beside = rng.random(600) < share
        for j in range(-min(x, y), min(len(a) - x, len(b) - y)):
            if 0 <= j < n or (beside[j] and j % 6 != (0 if j >= n else 5) and j not in (-1, n)):
                b[y + j] = a[x + j]
        px, py = substring_dedup._points(*(np.array([v]) for v in (x, y, n)))
        (line,) = substring_dedup.chains(px, py)
        assert line == list(range(len(px)))
        expected.append([p for p in substring_dedup.passages_of(a, b, px, py)])
        rows.append((k, 0, k, 0, np.array([x, y, n], np.int32).tobytes(), a.tobytes(), b.tobytes()))
        poor += n < 32 and not share
    kinds = [*[pa.int64()] * 4, *[pa.binary()] * 3]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    batch = pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "early_id", "early_tag", "places", "words", "early_words"])
    aligned, plain = [], substring_dedup.align
    monkeypatch.setattr(substring_dedup, "align", lambda *args: aligned.append(1) or plain(*args))
    found = [p for out in substring_dedup._chain(iter([batch])) for p in out.column(4).to_pylist()]
    assert [[tuple(p.values()) for p in ps] for ps in found] == expected
    assert 200 < sum(map(bool, expected)) and 300 < poor and len(aligned) <= len(rows) - poor


def test_links_of_a_pair_over_batches():
    """Pairs whose links lie in several batches are told, and joined, as if they lay in one."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(12)
    rows = []
    for pair in range(300):
        for _ in range(rng.choice((1, 1, 2, 3, 40))):
            links = [(rng.randrange(400), rng.randrange(400), rng.choice((6, 6, 6, 9))) for _ in range(rng.choice((1, 2, 60)))]
            rows.append((pair // 9, pair % 3, pair // 3 % 3, 5, links))
    expected = {}
    for *pair, links in rows:
        expected.setdefault(tuple(pair), []).extend(links)
    reach = substring_dedup.SEED + substring_dedup.WIDEST
    near = lambda p: any(0 < a[0] - b[0] <= reach and 0 < a[1] - b[1] <= reach for a in p for b in p)
    expected = {k: p for k, p in expected.items() if any(n > 6 for *_, n in p) or len(p) > 100 or near(p)}
    assert 100 < len(expected) < 290
    rows = [(*r[:4], sum(n - 5 for *_, n in r[4]), np.array(r[4], np.int32).tobytes()) for r in sorted(rows, key=lambda r: r[:4])]
    whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], substring_dedup._LINK.names)
    for size in (1, 7, 100, len(rows)):
        batches = [whole.slice(k, size) for k in range(0, len(rows), size)]
        found = [r for b in substring_dedup._chained(iter([whole.slice(0, 0), *batches])) for r in b.to_pylist()]
        assert [tuple(r.values())[:4] for r in found] == sorted(expected)
        for r in found:
            assert np.frombuffer(r["places"], np.int32).reshape(-1, 3).tolist() == [list(p) for p in expected[tuple(r.values())[:4]]]


def test_several_passages_of_one_pair(spark):
    rng = random.Random(7)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    for n, gap in ((2, 50), (2, 70), (3, 200), (2, 1000)):
        shared = [fresh(60) for _ in range(n)]
        rows = [(d, " ".join(sum((fresh(gap) + p for p in shared), []))) for d in (1, 2)]
        found = {r.doc_id: r for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()}
        assert found[2].n_passages == n and 60 * n <= found[2].n_repeated <= 62 * n


def equal_words(a, b):
    row = [0] * (len(b) + 1)
    for w in a:
        last = 0
        for k, v in enumerate(b):
            last, row[k + 1] = row[k + 1], last + 1 if w == v else max(row[k + 1], row[k])
    return row[-1]


@pytest.mark.parametrize("changed", [0.1, 0.15, 0.18])
def test_recall_of_fuzzy_passages(spark, changed):
    """Passages that brute-force alignment accepts, with words replaced at random places."""
    rng = random.Random(8)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, accepted = [], set()
    for k in range(400):
        passage = fresh(rng.choice((45, 60, 120)))
        other = [w if rng.random() > changed else fresh(1)[0] for w in passage]
        other[0], other[-1] = passage[0], passage[-1]
        if equal_words(passage, other) >= 0.8 * len(passage):
            accepted.add(1000 + k)
        rows += [(k, fresh(20) + passage + fresh(20)), (1000 + k, fresh(30) + other + fresh(10))]
    found = substring_dedup.substring_dedup(frame(spark, [(d, " ".join(w)) for d, w in rows])).collect()
    seen = {r.doc_id for r in found if r.n_passages}
    print(f"recall at {changed}: {len(accepted & seen)} of {len(accepted)}")
    assert len(accepted & seen) >= RECALL[changed] * len(accepted)


@pytest.mark.parametrize("parts", [1, 3, 16])
@pytest.mark.parametrize("changed, least", [(0, 1.0), (0.1, 0.95)])
def test_passages_whose_parts_others_hold(spark, parts, changed, least):
    """Earlier documents hold the beginning, the end, or 39 of 40 words, too little to count."""
    rng = random.Random(9)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    rows, expected = [], set()
    for k in range(0, 1500, 15):
        n = rng.choice((40, 60))
        passage = fresh(n)
        held = 39 if n == 40 else 32
        other = [fresh(1)[0] if 0 < i < n - 1 and rng.random() < changed else w for i, w in enumerate(passage)]
        parted = [passage[:held], passage[-held:]]
        # Where words are changed, nobody between the two that hold all of it holds parts of it.
        texts = [*parted, passage, other] if changed else [*parted, passage, *parted, passage]
        rows += [(k + i, " ".join(fresh(15) + t + fresh(15))) for i, t in enumerate(texts)]
        if equal_words(passage, texts[-1]) >= 0.8 * n:
            expected.add(k + len(texts) - 1)
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    found = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).collect()}
    seen = {d for d in expected if found[d].n_passages and d // 15 * 15 + 2 in found[d].earlier}
    print(f"partial holders, {parts} parts, {changed} changed: {len(seen)} of {len(expected)}")
    assert len(seen) >= least * len(expected)


@pytest.mark.parametrize(
    "apply",
    [exact_dedup.exact_dedup, exact_dedup.drop_copies, minhash.near_duplicates, minhash.drop_near_copies, suffix_dedup.suffix_dedup, substring_dedup.substring_dedup],
)
def test_empty_tables(spark, apply):
    assert apply(frame(spark, [])).isEmpty()
