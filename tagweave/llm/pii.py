"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs them, a classifier decides.

Candidates are the matches of fixed patterns (the base, which always stays) and of wider ones:
addresses spelled with words, phone numbers without a plus, addresses of version 6, shorter card
numbers, and secrets, long runs of letters and digits, which have no base. Three labelers vote for,
against or not at all: the strict pattern (for secrets, a quoted value that is assigned), a gazetteer
(top-level domains, issuers of cards, reserved networks, prefixes of keys) and the words just before
the span.
Expectation-maximisation (Dawid and Skene) estimates from the counts of vote patterns how reliable
each labeler is for each kind. With the posteriors as soft labels, a naive Bayes classifier over
features of the span is trained; wider candidates that it gives ``LEAST`` or more are added, unless
they overlap a base span.

Only DataFrame functions touch rows. The driver gets counts by vote pattern (at most 5 * 27 rows)
and soft counts by feature value (at most 5 * 19 rows), whatever the number of documents. Each text
is scanned once; what is found is written without the text, and both models read that table.

Positions count code points, ends exclusive. Every pattern takes time in proportion to the text, as
all repetitions are possessive and no match starts inside a run that has already failed; so do the
steps that put places together, but for a root of their number.

Defined results: a null or empty text has no spans, and the digest is that of the empty string; null
ids and repeated rows each give a row; without any candidate nothing is added; an empty table gives an
empty result; texts are read whole, whatever their length; counts are those of
base spans; further columns of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tagweave.llm.common import stage

KINDS = ("email", "ip", "card", "phone")
ALL_KINDS = (*KINDS, "secret")
LEAST, ROUNDS = 0.9, 40

# Base patterns. Each finds, from left to right, the same matches as the plain form of its kind.
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]++"
BASE = {
    # A match begins where a run of local characters begins, or where the match before it ended.
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}(?:\.{DOMAIN})++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Whole runs of digits with single separators; other lengths than 16 to 19 would be dropped.
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,40}+ ?[(\[](?:at|AT|@)[)\]] ?[A-Za-z0-9-]++(?: ?(?:[(\[](?:dot|DOT)[)\]]|\.) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){12,14}+(?![ -]?[0-9])",
    "phone": r"(?<![0-9+(.-])(?<!\+[0-9]{1,3} )\(?[0-9]{3}(?:\) ?|[ .-])[0-9]{3}[ .-][0-9]{4}(?![.-]?[0-9])",
    # A whole run with a digit and a letter in it, that is no part of an address.
    "secret": r"(?<![A-Za-z0-9_+/=@-])(?=[A-Za-z_+/=-]*+[0-9])(?=[0-9_+/=-]*+[A-Za-z])[A-Za-z0-9_+/=-]{20,}+(?!@)",
}
#: What a text must hold for a pattern to be tried, cheaper than the pattern.
NEEDS = {
    ("email", True): lambda t: F.contains(t, F.lit("@")),
    ("ip", True): lambda t: t.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    ("card", True): lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){15}"),
    ("phone", True): lambda t: t.rlike(r"\+[0-9]"),
    ("email", False): lambda t: t.rlike(r"[(\[](?:at|AT|@)[)\]]"),
    ("ip", False): lambda t: t.rlike(r"[0-9A-Fa-f](?::[0-9A-Fa-f]{1,4}+){7}"),
    ("card", False): lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
    ("phone", False): lambda t: t.rlike(r"[0-9]{3}(?:\) ?|[ .-])[0-9]{3}[ .-][0-9]{4}"),
    ("secret", False): lambda t: t.rlike(r"[A-Za-z0-9_+/=-]{20}"),
}

# Gazetteers and context words, for and against.
KNOWN = {
    "email": r"(?i)(com|org|net|edu|gov|io|info|biz|de|fr|es|uk|eu|it|nl|ch|at)$",
    "ip": r"^(?!0+\.|127\.|255\.)[0-9A-Fa-f]",
    "card": r"^(4|5[1-5]|2[2-7]|3[47]|36|6011|65)",
    "phone": r"^[+(]?[1-9]",
    "secret": r"^(AKIA|ASIA|AIza|gh[pousr]_|glpat-|sk_(live|test)_|xox[abprs]-|ey[JK])",
}
UNLIKELY = {
    "email": r"(?i)(png|jpg|gif|svg|css|js)$",
    "ip": r"^(0+\.|127\.0|255\.255)",
    "card": r"^(0|1|7|8|9)",
    "phone": r"^\(?(000|555[ .-]?0100)",
    "secret": r"^[a-z]+([-_/][a-z0-9]+)+$|/.*/|^[0-9]{4}-[0-9]{2}-[0-9]{2}|^([0-9A-Fa-f])\2+$",
}
NEAR = {
    "email": r"(?i)(e-?mail|contact|write|reach|schreib|correo|courriel)",
    "ip": r"(?i)(\bip\b|address|host|server|login|adresse)",
    "card": r"(?i)(card|visa|master|amex|credit|karte|carte|tarjeta)",
    "phone": r"(?i)(tel|phone|call|fax|mobil|cell|contact)",
    "secret": r"(?i)(tokens?|secrets?|passw(or)?d|passphrase|(api|access|private).?key|auth|authorization|bearer|credentials?)[^A-Za-z]*$",
}
AGAINST = r"(?i)(version|isbn|issn|doi|order|serial|invoice|section|\bv)[ .:#]*$"
AGAINST_SECRET = r"(?i)(commit|revision|sha.?[0-9]*|md5|hash|digest|checksum|etag|uuid|version|file|image|build|://\S*)[^A-Za-z]*$"
#: What stands before a value that is assigned, and what a value with a word in it holds.
ASSIGNED, WORD_SHAPE = r"[=:] ?[\"'`]$", r"(^|[-_/+=])[A-Za-z][a-z]{7}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, base: bool, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip" and base:
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return value.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone" and base:
        return n.between(8, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """For each of an array's pairs of gap and size: the sum of all before it and its gap.

    A sum is carried along with a text of all sums so far, which is copied for each step. So the array is
    summed in parts of about the root of its size, and then over the parts.
    """
    width = F.ceil(F.sqrt(F.size(lengths))).cast("int")
    parts = F.transform(F.sequence(F.lit(1), F.size(lengths), width), lambda first: F.slice(lengths, first, width))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("places"))
    put = lambda places, n: F.concat(places, n.cast("string"), F.lit(" "))
    numbers = lambda places: F.transform(F.split(F.rtrim(places), " "), lambda n: n.cast("int"))

    def step(state, pair):
        begin = state["at"] + pair["gap"]
        return F.struct((begin + pair["size"]).alias("at"), put(state["places"], begin).alias("places"))

    def over(sums):
        add = lambda state, part: F.struct((state["at"] + part["at"]).alias("at"), put(state["places"], state["at"]).alias("places"))
        offsets = numbers(F.aggregate(sums, start, add)["places"])
        moved = lambda part, offset: F.transform(numbers(part["places"]), lambda n: n + offset)
        return F.flatten(F.zip_with(sums, offsets, moved))

    summed = _let(F.transform(parts, lambda part: F.aggregate(part, start, step)), over)
    return F.when(F.size(lengths) > 0, summed).otherwise(F.array().cast("array<int>"))


def located(text: Column, pattern: str) -> Column:
    """All matches with start, end, value and what stands before, by what lies between them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    lengths = F.transform(pairs, lambda p: F.struct(F.length(p["gap"]).alias("gap"), F.length(p["value"]).alias("size")))
    return F.zip_with(
        _let(lengths, _running),
        pairs,
        lambda start, p: F.struct(
            start.alias("start"),
            (start + F.length(p["value"])).alias("end"),
            p["value"].alias("value"),
            F.right(p["gap"], F.lit(30)).alias("before"),
        ),
    )


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, -1).when(yes, 1).otherwise(0)


def _described(kind: str, base: bool, span: Column) -> Column:
    """A candidate as its place, three votes, and features with few values."""
    value, before = span["value"], span["before"]
    plain = _digits(value) if kind in ("card", "phone") else value
    n = F.length(_digits(value))
    secret = kind == "secret"
    shape = _vote(before.rlike(ASSIGNED), value.rlike(WORD_SHAPE)) if secret else F.lit(1 if base else 0)
    against = AGAINST_SECRET if secret else AGAINST
    return F.struct(
        F.lit(kind).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        F.lit(base).alias("base"),
        shape.alias("by_pattern"),
        _vote(plain.rlike(KNOWN[kind]), plain.rlike(UNLIKELY[kind])).alias("by_list"),
        _vote(before.rlike(NEAR[kind]), before.rlike(against)).alias("by_context"),
        F.array(
            F.concat(F.lit("digits "), F.least(n.cast("int") / 4, F.lit(5)).cast("int").cast("string")),
            F.concat(F.lit("split "), value.rlike("[ ()/-]" if secret else "[ ()-]").cast("string")),
            F.concat(F.lit("after "), F.when(before.rlike(r"[\s:(=]$"), "gap").when(F.length(before) == 0, "start").otherwise("text")),
            F.concat(F.lit("near "), F.when(before.rlike(NEAR[kind]), "for").when(before.rlike(against), "against").otherwise("none")),
            F.concat(F.lit("known "), plain.rlike(KNOWN[kind]).cast("string")),
        ).alias("features"),
    )


def _valid_spans(kind: str, base: bool, spans: Column) -> Column:
    valid = F.filter(spans, lambda s: _valid(kind, base, s["value"]))
    return F.transform(valid, lambda s: _described(kind, base, s))


def _clear_of(kind: str) -> Column:
    """Wide spans that overlap no base span of their kind, by their neighbours in the order of both.

    Spans of either sort do not overlap each other, and none is so long that two of the other sort lie
    within it. So a wide one can only meet base ones among the next and the three before it.
    """
    place = lambda s, wide: F.struct(s["start"].alias("start"), F.lit(wide).alias("wide"), s.alias("span"))

    def apart(spans):
        def meets(s, other):
            return F.coalesce(~other["wide"] & (other["start"] < s["span"]["end"]) & (s["start"] < other["span"]["end"]), F.lit(False))

        def kept(s, i):
            near = [meets(s, F.get(spans, i + k)) for k in (1, -1, -2, -3)]
            return F.when(s["wide"] & ~(near[0] | near[1] | near[2] | near[3]), s["span"])

        return F.array_compact(F.transform(spans, kept))

    both = F.array_sort(F.concat(F.transform(kind, lambda s: place(s, False)), F.transform(f"{kind}_wide", lambda s: place(s, True))))
    return F.when((F.size(kind) > 0) & (F.size(f"{kind}_wide") > 0), _let(both, apart)).otherwise(F.col(f"{kind}_wide"))


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and its candidates, base first, by kind and start; wide ones overlap no base span of their kind."""
    text = F.coalesce(F.col("text"), F.lit(""))
    named, wide = [], []
    for base, patterns in ((True, BASE), (False, WIDE)):
        for kind in patterns:
            spans = F.when(NEEDS[kind, base](text), _valid_spans(kind, base, located(text, patterns[kind])))
            none = F.array().cast(f"array<{SPAN}>")
            (named if base else wide).append(F.coalesce(spans, none).alias(kind if base else f"{kind}_wide"))
    rows = docs.select("doc_id", *named, *wide)
    clear = [_clear_of(kind) for kind in KINDS] + ["secret_wide"]  # there is no base of their kind
    return rows.select("doc_id", F.concat(*KINDS).alias("base"), F.concat(*clear).alias("wide"))


SPAN = "struct<kind:string,start:int,end:int,base:boolean,by_pattern:int,by_list:int,by_context:int,features:array<string>>"
VOTES = ("by_pattern", "by_list", "by_context")


def reliabilities(counts: list[Row], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Posterior of each vote pattern of each kind, by expectation-maximisation over their counts."""
    posterior = {}
    for kind in ALL_KINDS:
        mine = [(tuple(r[v] for v in VOTES), r["count"]) for r in counts if r["kind"] == kind]
        belief = {votes: 1 / (1 + math.exp(-2.0 * sum(votes) + 1)) for votes, _ in mine}
        for _ in range(rounds if mine else 0):
            share = (1 + sum(belief[v] * n for v, n in mine)) / (2 + sum(n for _, n in mine))
            rates = []
            for k in range(len(VOTES)):
                table = {}
                for cast in (-1, 0, 1):
                    yes = sum(belief[v] * n for v, n in mine if v[k] == cast)
                    no = sum((1 - belief[v]) * n for v, n in mine if v[k] == cast)
                    table[cast] = [yes, no]
                totals = [sum(t[s] for t in table.values()) for s in (0, 1)]
                rates.append({c: math.log((t[0] + 1) / (totals[0] + 3)) - math.log((t[1] + 1) / (totals[1] + 3)) for c, t in table.items()})
            for votes in belief:
                score = math.log(share / (1 - share)) + sum(rates[k][c] for k, c in enumerate(votes))
                belief[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))
        posterior |= {(kind, *votes): p for votes, p in belief.items()}
    return posterior


def train(found: DataFrame) -> dict[tuple[str, str], float]:
    """Log odds by kind and feature value, and by kind and "" for the kind itself."""
    spans = found.select(F.explode(F.concat("base", "wide")).alias("s")).select("s.*")
    posterior = reliabilities(spans.groupBy("kind", *VOTES).count().collect())
    if not posterior:
        return {}
    key = F.concat_ws("|", "kind", *VOTES)
    belief = F.coalesce(_looked_up(key, {"|".join(map(str, k)): p for k, p in posterior.items()}), F.lit(0.0))
    each = spans.select("kind", belief.alias("p"), F.explode(F.concat(F.array(F.lit("")), "features")).alias("feature"))
    sums = each.groupBy("kind", "feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    total = {r["kind"]: (r["yes"], r["no"]) for r in sums if not r["feature"]}
    odds = {}
    for r in sums:
        yes, no = total[r["kind"]]
        if r["feature"]:
            odds[r["kind"], r["feature"]] = math.log((r["yes"] + 1) / (yes + 2)) - math.log((r["no"] + 1) / (no + 2))
        else:
            odds[r["kind"], ""] = math.log((yes + 1) / (no + 1))
    return odds


def _looked_up(key: Column, values: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))[key]


def find_pii(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, counts of base spans, their digest, all spans as text, how many these are, and all spans as an array."""
    found = stage(candidates(docs), "spans")
    odds = train(found)
    added = F.col("wide")
    if odds:
        table = {f"{kind}|{feature}": x for (kind, feature), x in odds.items()}

        def score(s):
            start = F.coalesce(_looked_up(F.concat(s["kind"], F.lit("|")), table), F.lit(0.0))
            return F.aggregate(
                s["features"], start, lambda x, f: x + F.coalesce(_looked_up(F.concat(s["kind"], F.lit("|"), f), table), F.lit(0.0))
            )

        added = F.filter("wide", lambda s: score(s) >= math.log(least / (1 - least)))

    def ordered(spans):
        rank = F.create_map(*(F.lit(x) for k, kind in enumerate(ALL_KINDS) for x in (kind, k)))
        keyed = F.transform(spans, lambda s: F.struct(rank[s["kind"]].alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        return F.array_sort(keyed)

    def joined(spans):
        return F.array_join(F.transform(ordered(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, KINDS),
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        joined(F.concat("base", added)).alias("spans"),
        F.size(F.concat("base", added)).cast("long").alias("n_spans"),
        F.transform(ordered(F.concat("base", added)), lambda s: F.struct(*(s[c].alias(c) for c in ("kind", "start", "end")))).alias("found"),
    )


def mask(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every span of ``found`` (of :func:`find_pii`) replaced by its kind in brackets.

    Documents are joined by doc_id, which must name one row.
    """
    by_place = F.transform("found", lambda s: F.struct(*(s[c].alias(c) for c in ("start", "end", "kind"))))
    spans = found.select(F.col("doc_id").alias("_found_id"), F.array_sort(by_place).alias("_found"))
    rows = docs.join(spans, F.col("doc_id") == F.col("_found_id"), "left")
    zero = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state, s):
        piece = F.col("text").substr(state["at"] + 1, F.greatest(s["start"] - state["at"], F.lit(0)))
        tag = F.when(s["start"] >= state["at"], F.concat(F.lit("["), s["kind"], F.lit("]"))).otherwise("")
        return F.struct(F.concat(state["out"], piece, tag).alias("out"), F.greatest(state["at"], s["end"]).alias("at"))

    done = F.aggregate("_found", zero, step)
    rest = F.concat(done["out"], F.col("text").substr(done["at"] + 1, F.length("text")))
    return rows.withColumn("text", F.when(F.size("_found") > 0, rest).otherwise(F.col("text"))).select(*docs.columns)
