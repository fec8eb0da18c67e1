"""License scan: rare licence words vote for where a template lies, and its mandatory phrases decide.

Every template is a passage of a licence. A positional index holds, for each word of a template, where
it stands there. Of the licence words that a document holds, those with the highest IDF over all
documents are looked up for each template; every place of such a word, less a posting of it, is the
place where the template would begin. Postings are intersected by this relative position: ``LEAST``
words that name the same one make a candidate. It is accepted where each mandatory phrase of the
template stands in its place as well, moved by ``SLACK`` words at most. A template whose phrases cannot
all be there, as a word of them is missing, is not looked up.

Base labels are those of fixed phrases, wherever these stand. Only DataFrame functions are used, and
texts are read once: what counts of a text is its licence words with their places, which are written;
the driver gets one count for each licence word. All work is within the row of a document and, but for
a sort of its votes, in proportion to its length.

Defined results: a null text is empty; a text without words has no label, null places and score 0; a
phrase counts at each of its places; rows that repeat an id each give a row; words with equal IDF are
looked up in alphabetical order; an empty table gives an empty result; further columns are neither read
nor returned. The score is 1 where a base phrase stands, else the largest share of looked-up words that
an accepted template has in place, else 0.
"""

from __future__ import annotations

import math
import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import stage

# Phrases that give a base label.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# A label, a passage of the licence, and the phrases of the passage that must be there.
TEMPLATES = [
    ("mit", "released under the mit license", ["mit license"]),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software", ["hereby granted free of charge", "associated documentation files"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license", "version 2 0"]),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0", ["in compliance with the license", "apache org licenses"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["source and binary forms", "following conditions are met"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ["creative commons attribution noncommercial"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", ["waived all copyright"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ["gnu general public license", "free software foundation"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", ["gnu general public license", "version 2"]),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license", "version 3"]),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ["gnu affero general public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["with or without fee is hereby granted"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["free and unencumbered software"]),
    ("no-reproduction", "no part of this publication may be reproduced distributed or transmitted in any form or by any means", ["no part of this publication may be reproduced"]),
]

#: Words looked up for a template, how many must agree on its place, and how far a phrase may be moved.
LOOKED_UP, LEAST, SLACK = 8, 3, 4
#: A candidate is a number: template times PLACES, plus where it begins, plus BEFORE (none begins further left).
PLACES, BEFORE = 1 << 40, 256

_KEPT = string.digits + string.ascii_lowercase + string.ascii_uppercase
_SEPARATORS = "".join(chr(c) for c in range(128) if chr(c) not in _KEPT)

Template = tuple[str, str, Sequence[str]]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; everything in ASCII but letters and digits separates them."""
    plain = F.translate(
        F.coalesce(text, F.lit("")), string.ascii_uppercase + _SEPARATORS, string.ascii_lowercase + " " * len(_SEPARATORS)
    )
    plain = F.trim(plain)
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def _with(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with new columns that are worked out once, since nothing is moved past a generator."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _phrases(templates: Sequence[Template], base: Mapping[str, str]) -> list[str]:
    return sorted({*base, *(p for _, _, phrases in templates for p in phrases)})


def _place_in(passage: str, phrase: str) -> int:
    words, wanted = passage.split(), phrase.split()
    for k in range(len(words)):
        if words[k : k + len(wanted)] == wanted:
            return k
    raise ValueError(f"the phrase {phrase!r} is not part of {passage!r}")


def licence_words(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, base: Mapping[str, str] = BASE) -> DataFrame:
    """doc_id, n_words, the licence words a document holds, their places, and places of phrases.

    ``hits`` are left out where no template can be accepted, as nothing asks for them there.
    """
    phrases = _phrases(templates, base)
    vocabulary = sorted({w for text in [*phrases, *(passage for _, passage, _ in templates)] for w in text.split()})
    rows = docs.select("doc_id", "text")
    rows = _with(rows, words=words_of(F.col("text"))).drop("text")
    hit = lambda w, i: F.when(w.isin(vocabulary), F.struct(i.alias("pos"), w.alias("word")))
    rows = _with(rows, hits=F.array_compact(F.transform("words", hit)))

    def begins(h: Column, phrase: str) -> Column:
        first, *rest = phrase.split()
        found = h["word"] == first
        for k, word in enumerate(rest, 1):
            found = found & F.get("words", h["pos"] + k).eqNullSafe(F.lit(word))
        return F.when(found, F.struct(F.lit(phrases.index(phrase)).alias("phrase"), h["pos"].alias("pos")))

    starts = sorted({p.split()[0] for p in phrases})
    none = F.array().cast("array<struct<phrase:int,pos:int>>")
    places = lambda h: F.when(h["word"].isin(starts), F.array_compact(F.array(*[begins(h, p) for p in phrases]))).otherwise(none)
    rows = _with(rows, held=F.array_distinct("hits.word"), phrases=F.flatten(F.transform("hits", places)))
    needed = [F.array(*[F.lit(w) for w in sorted({w for p in phrases for w in p.split()})]) for _, _, phrases in templates]
    possible = F.exists(F.array(*needed), lambda words: F.size(F.array_intersect(words, "held")) == F.size(words))
    return rows.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "held",
        F.when(possible, F.col("hits")).otherwise(F.array().cast("array<struct<pos:int,word:string>>")).alias("hits"),
        "phrases",
    )


def word_idf(found: DataFrame) -> dict[str, float]:
    """IDF of each licence word over all documents; words that are nowhere are not in it."""
    total = found.count()
    held = found.select(F.explode("held").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return {row["word"]: math.log((1 + total) / (1 + row["n"])) for row in held.collect()}  # licence words only


def _lookup(templates: Sequence[Template], idf: Mapping[str, float]) -> Column:
    """The index: for each template its words from rare to frequent, with their places."""
    rows = []
    for t, (_, passage, phrases) in enumerate(templates):
        words = passage.split()
        order = sorted(set(words), key=lambda w: (-idf.get(w, math.inf), w))
        postings = [
            F.struct(F.lit(t).alias("t"), F.lit(w).alias("word"), F.array(*[F.lit(j) for j, x in enumerate(words) if x == w]).alias("at"))
            for w in order
        ]
        needed = sorted({w for p in phrases for w in p.split()})
        rows.append(F.struct(F.array(*[F.lit(w) for w in needed]).alias("needed"), F.array(*postings).alias("words")))
    return F.array(*rows)


def _phrase_votes(templates: Sequence[Template], phrases: list[str], which: int, slack: int) -> Column:
    """Candidates that have the first (0) or the last (-1) of their mandatory phrases about its place."""
    of_phrase: dict[int, list[int]] = {}
    for t, (_, passage, own) in enumerate(templates):
        of_phrase.setdefault(phrases.index(own[which]), []).append(t * PLACES + BEFORE - _place_in(passage, own[which]))
    none = F.array().cast("array<bigint>")
    shifts = F.sequence(F.lit(-slack).cast("long"), F.lit(slack).cast("long"))

    def votes(p: Column) -> Column:
        begins = F.lit(None).cast("array<bigint>")
        for phrase, codes in of_phrase.items():
            begins = F.when(p["phrase"] == phrase, F.array(*[F.lit(c) for c in codes])).otherwise(begins)
        around = F.flatten(F.transform(shifts, lambda s: F.transform(begins, lambda c: c + p["pos"] + s)))
        return F.when(begins.isNotNull(), around).otherwise(none)

    return F.flatten(F.transform("phrases", votes))


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = TEMPLATES,
    base: Mapping[str, str] = BASE,
    looked_up: int = LOOKED_UP,
    least: int = LEAST,
    slack: int = SLACK,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and found.

    ``found`` holds what was accepted: label, first word of the template's place and share of words.
    """
    if any(not 1 <= len(phrases) <= 2 for _, _, phrases in templates):
        raise ValueError("a template has one or two mandatory phrases")
    phrases = _phrases(templates, base)
    rows = stage(licence_words(docs, templates, base), "licence-words")
    asked = lambda t: F.slice(F.filter(t["words"], lambda w: F.array_contains("held", w["word"])), 1, looked_up)
    usable = F.filter(_lookup(templates, word_idf(rows)), lambda t: F.forall(t["needed"], lambda w: F.array_contains("held", w)))
    none = F.array().cast("array<struct<t:int,word:string,at:array<int>>>")
    asked_for = F.when(F.size("hits") > 0, F.flatten(F.transform(usable, asked))).otherwise(none)
    rows = _with(rows, asked=asked_for).drop("held")

    def votes(h: Column) -> Column:
        of_word = F.filter("asked", lambda a: a["word"] == h["word"])
        begins = lambda a: F.transform(a["at"], lambda j: a["t"].cast("long") * PLACES + BEFORE + h["pos"] - j)
        return F.flatten(F.transform(of_word, begins))

    rows = _with(rows, votes=F.array_sort(F.flatten(F.transform("hits", votes)))).drop("hits")
    at = lambda i: F.get("votes", i)
    enough = lambda x, i: F.when(at(i + (least - 1)).eqNullSafe(x) & ~at(i - 1).eqNullSafe(x), F.struct(x.alias("begin"), i.alias("i")))
    first, last = (_phrase_votes(templates, phrases, which, slack) for which in (0, -1))
    rows = _with(rows, candidates=F.array_compact(F.transform("votes", enough)), verified=F.array_intersect(first, last))
    more = F.array(*[F.lit(k) for k in range(least, looked_up + 1)])
    agreed = lambda c: F.array_max(F.filter(more, lambda k: at(c["i"] + k - 1).eqNullSafe(c["begin"])))
    entry = lambda begin, n: F.struct(begin.alias("begin"), n.cast("int").alias("n"))
    # A candidate is accepted if its number is verified too, which then sorts right before it.
    both = F.concat(
        F.transform("verified", lambda begin: entry(begin, F.lit(0))), F.transform("candidates", lambda c: entry(c["begin"], agreed(c)))
    )
    rows = _with(rows, both=F.array_sort(both)).drop("votes", "candidates", "verified")
    before = lambda i: F.get("both", i - 1)["begin"]
    accepted = F.filter("both", lambda x, i: (x["n"] > 0) & before(i).eqNullSafe(x["begin"]))
    label_of = F.array(*[F.lit(label) for label, _, _ in templates])
    words_of_template = F.array(*[F.lit(min(looked_up, len(set(passage.split())))) for _, passage, _ in templates])

    def told(x: Column) -> Column:
        t = F.call_function("div", x["begin"], F.lit(PLACES)).cast("int")
        share = F.least(F.lit(1.0), x["n"] / F.get(words_of_template, t))
        return F.struct(
            F.get(label_of, t).alias("label"), (F.pmod(x["begin"], F.lit(PLACES)) - BEFORE).alias("begin"), share.alias("share")
        )

    base_label = F.array(*[F.lit(base.get(p)) for p in phrases])
    is_base = [phrases.index(p) for p in base]
    rows = _with(rows, found=F.transform(accepted, told), base=F.filter("phrases", lambda p: p["phrase"].isin(is_base)))
    base_labels = F.array_distinct(F.transform("base", lambda p: F.get(base_label, p["phrase"])))
    joined = lambda labels: F.array_join(F.array_sort(labels), ",")
    best = F.coalesce(F.array_max("found.share"), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.pos").cast("long").alias("first_word"),
        F.array_max("base.pos").cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.array_union(base_labels, "found.label")).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(best).alias("score"),
        "found",
    )
