"""The operators by plain loops over small lists, and the documents they are tried on."""

import hashlib
import random
import re
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Names that operators use inside, as columns of the input.
CLASHING = (
    "id tag n row run sha check size best kept score blob blobs bucket kind spans a b node component at low hub slot used label "
    "labelled_id text_a text_b bands sum1 sum2 keep_id of_id of_tag early_id places begin end host path rule verdict good prior mean"
).split()


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def documents(seed=1):
    """(doc_id, text): words from a small list, copies, near copies, and odd rows."""
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("tha", "in", "öre", "lo", "4") for b in ("x", "nd", "Ring", "s,", "e.", "ble")]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice((3, 40, 90)))) for _ in range(40)]
    for k in range(12):
        parts = texts[k + 2].split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        texts.append(" ".join(parts))
    passage = " ".join(rng.choice(words) for _ in range(70))
    texts += [f"{rng.choice(texts[:30])} {passage} {rng.choice(texts[:30])}" for _ in range(6)]
    texts += [texts[3], texts[3].replace(" ", "\n\t"), texts[5], "", " \n", None, None, "one", "one two", "one  TWO", "ab " * 4000, "x" * 30000]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    return [*rows, rows[0], (None, texts[1]), (None, None)]


def frame(spark, rows, schema="doc_id long, text string", extra=CLASHING):
    """Rows as a frame of several partitions, with columns of clashing names beside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema).repartition(3)
    return df.select("*", *(F.lit("other").alias(c) for c in extra if c not in df.columns))


def words_of(text, pattern):
    return re.findall(pattern, (text or "").translate(LOWER))


def exact_groups(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[re.sub("[\x20\x09-\x0d]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id))
    return {text: (min(rows)[2], len(rows)) for text, rows in groups.items()}


def near_groups(docs):
    """Id to (size of its set, component); ids are unique here."""
    sets = {}
    for doc_id, text in docs:
        words = words_of(text, "[^\x20\x09-\x0d]+")
        sets[doc_id] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in sets}


def covered_bytes(docs, least=50):
    """Position by position: is it under a string that a smaller id has too?"""
    first = {}
    order = lambda d: (d is None, d or 0)
    data = [(d, (t or "").encode()) for d, t in docs]
    for doc_id, text in data:
        for k in range(len(text) - least + 1):
            key = text[k : k + least]
            if key not in first or order(doc_id) < order(first[key]):
                first[key] = doc_id
    found = []
    for doc_id, text in data:
        covered = bytearray(len(text))
        for k in range(len(text) - least + 1):
            if order(first[text[k : k + least]]) < order(doc_id):
                covered[k : k + least] = b"\1" * least
        spans = len(re.findall(b"\1+", bytes(covered)))
        kept = bytes(b for b, c in zip(text, covered) if not c)
        found.append((doc_id, len(text), sum(covered), spans, sha(kept)))
    return found


def contamination(docs, benchmark, window=13):
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    windows = defaultdict(set)
    for item, text in benchmark:
        words = words_of(text, pattern)
        n = min(window, len(words))
        for k in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[k : k + n])].add("" if item is None else str(item))
    found = []
    for doc_id, text in docs:
        words, hit, items = words_of(text, pattern), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    items |= windows[tuple(words[k : k + n])]
        found.append((doc_id, len(words), len(hit), len(items), sha(",".join(sorted(items))), bool(hit) and 20 * len(hit) >= len(words)))
    return found


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def base_spans(text):
    counts, spans = [], []
    for kind, pattern in BASE.items():
        mine = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = kind == "email"
            fine |= kind == "ip" and all(int(p) <= 255 for p in m[0].split("."))
            fine |= kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
            fine |= kind == "phone" and 8 <= len(digits) <= 15
            if fine:
                mine.append(f"{kind}:{m.start()}:{m.end()}")
        counts.append(len(mine))
        spans += mine
    return counts, spans
