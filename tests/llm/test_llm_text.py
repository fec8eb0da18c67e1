"""Tokens, contamination, personal data, toxicity, pages and urls, against plain loops or known answers."""

import json
import math
import random
import re
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plain import base_spans, contamination, documents, frame, sha
from tagweave.llm import bpe, decontaminate, html_extract, pii, toxicity, url_filter

DOCS = documents(2)
PATH = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(9)
    letters = ["a", "B", "é", "e\u0301", "Σ", "ς", "ß", "İ", "ﬁ", "中", "😀", "1", "½", "٣", "'s", "'LL", "’", " ", "\t", "\u00a0", "\u2003", "\x1c", "\x00", "_", "--", "&"]
    letters += ["<|endoftext|>", "<|startoftext|", "the ", "thing", "ǅ", "\u0301"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    return [*texts, "q" * 3000, "".join(map(chr, range(1, 0x3000))), None, "", " "]


def test_tokens_equal_the_library(spark, odd_texts):
    library = Tokenizer.from_file(PATH)
    rows = list(enumerate(odd_texts)) + DOCS
    found = rows_of(bpe.encode_digests(frame(spark, rows), PATH))
    expected = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), sha(" ".join(map(str, ids))), sha(decoded)))
    assert found == sorted(expected, key=repr)


def test_most_words_need_no_merging():
    with open(PATH) as file:
        encoder = bpe.WordBpe(file.read())
    texts = [t for _, t in DOCS if t]
    encoder.encode(texts)
    assert 0 < encoder.exact < len(encoder.known) / 2


def test_long_words_merge_like_short_ones(monkeypatch):
    with open(PATH) as file:
        encoder = bpe.WordBpe(file.read())
    rng = random.Random(8)
    for _ in range(200):
        symbols = encoder.symbols("".join(rng.choice("theaiou") for _ in range(rng.randint(1, 60))))
        assert encoder._merge_long(symbols) == encoder.merge(symbols)
    assert len(encoder.merge(encoder.symbols("mo" * 100_000))) > 1000


def test_other_tokenizers_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file, pytest.raises(ValueError):
        bpe.WordBpe(file.read())


def benchmark_rows(docs):
    texts = [t for _, t in docs if t and len(t.split()) > 30]
    items = [(k, " ".join(t.split()[5 : 5 + n])) for k, (t, n) in enumerate(zip(texts, (13, 14, 25, 7, 1, 12, 40)))]
    return [*items, (20, None), (21, " , "), (22, items[0][1].upper()), (0, "other words"), (None, texts[0])]


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 60])
def test_contamination(spark, block):
    items = benchmark_rows(DOCS)
    benchmark = frame(spark, items, "item_id long, text string")
    found = decontaminate.decontaminate(frame(spark, DOCS), benchmark, block)
    assert rows_of(found.drop("spans")) == sorted(contamination(DOCS, items), key=repr)


def test_contaminated_documents_and_spans_go(spark):
    text = "Before it. " + " ".join(f"Word{k}," for k in range(13)) + " öAfter."
    docs = frame(spark, [(1, text), (2, "clean words only"), (3, None)])
    benchmark = frame(spark, [(5, " ".join(f"word{k}" for k in range(13)))], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.drop_contaminated(docs, benchmark).collect()} == {2, 3}
    cut = decontaminate.cut_hits(docs, benchmark)
    assert cut.columns == docs.columns
    assert {r.doc_id: r.text for r in cut.collect()} == {1: "Before it. , öAfter.", 2: "clean words only", 3: None}
    none = frame(spark, [], "item_id long, text string")
    assert decontaminate.drop_contaminated(docs, none).count() == 3
    assert decontaminate.decontaminate(frame(spark, []), benchmark).isEmpty()


def test_personal_data(spark):
    rng = random.Random(1)
    parts = ["a", "b.", "@", ".", "-", "1", "22", "4111 1111 1111 1111", "+", "(", ")", " ", "192.168.0.1", "300", "é", "😀", "x@y.z", "5-", "\n"]
    parts += ["0", "%", "_", "4", "+1 (454) 555-9913", "5555-5555-5555-4444", "Σ"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(0, 50)))) for k in range(2000)]
    rows += [(9001, None), (9002, ""), (9003, "x@y.zz " * 500), (9003, "x@y.zz " * 500), (None, "x@y.zz")]
    found = pii.find_pii(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    texts = dict(rows)
    for r in found:
        counts, spans = base_spans(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == sha(",".join(spans))
        assert set(spans) <= set(r.spans.split(","))


@pytest.mark.parametrize("text", ["a" * 200_000, "1" * 200_000, "1-" * 100_000, "a@" * 100_000, "1." * 100_000, "+1" * 100_000, "1:" * 100_000])
def test_patterns_take_time_in_proportion(spark, text):
    assert pii.find_pii(frame(spark, [(1, text)])).count() == 1


def test_wider_spans_are_added_and_masked(spark):
    rows = [(k, f"email: ann{k}@mail.com now. Call +1 454 555 {1000 + k} or phone: 454-555-{2000 + k}. Version 1.2.3.") for k in range(300)]
    docs = frame(spark, rows + [(999, "write to bob [at] mail [dot] com, e-mail: eve (at) mail.org")])
    found = pii.find_pii(docs)
    spans = {r.doc_id: r.spans for r in found.collect()}
    assert all("phone:" in s and "email:" in s for d, s in spans.items() if d != 999)
    assert sum(s.count("phone:") == 2 for s in spans.values()) == 300
    masked = pii.mask(docs, found)
    assert masked.columns == docs.columns
    assert {r.text for r in masked.filter("doc_id < 300").collect()} == {"email: [email] now. Call [phone] or phone: [phone]. Version 1.2.3."}
    assert pii.find_pii(frame(spark, [])).isEmpty()


def test_toxicity_by_subwords(spark):
    rng = random.Random(2)
    clean = ["bread", "table", "window", "garden", "river", "mountain", "letter", "yellow", "quiet", "morning"]
    bad = ["stupid", "moron", "worthless", "pathetic"]
    rows, labels = [], []
    for k in range(900):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 120))]
        toxic = k % 3 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(bad)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(2000, "you sttupid"), (2001, "quiet rivers"), (2002, None), (2003, ""), (None, "morning"), (2001, "quiet rivers")]
    labels += [(2000, None), (5000, 1), (None, 1), (3, 7)]
    docs, marks = frame(spark, rows), frame(spark, labels, "doc_id long, toxic int", ())
    found = toxicity.score_toxicity(docs, marks).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    truth = dict(labels)
    held = [r for r in found if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert len(held) > 150 and sum(r.predicted == truth[r.doc_id] for r in held) > 0.97 * len(held)
    by = {r.doc_id: r for r in found}
    assert by[2000].predicted == 1 and by[2001].predicted == 0 and by[2002].predicted == by[2003].predicted == 0
    left = toxicity.drop_toxic(docs, marks)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in found if not r.predicted}


def test_toxicity_without_both_labels(spark):
    docs = frame(spark, [(1, "a b"), (2, None)])
    assert all(r.score < 1e-6 for r in toxicity.score_toxicity(docs, frame(spark, [], "doc_id long, toxic int", ())).collect())
    assert toxicity.score_toxicity(frame(spark, []), frame(spark, [(1, 1)], "doc_id long, toxic int", ())).isEmpty()


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class="home">
<header><h1>Site</h1><p>Slogan of the site, which is long, too.</p></header><nav><ul><li><a href="/a">A, b, c.</a></li></ul></nav>
<div id="cookie-notice">We use cookies, as everyone does. You may accept them.</div><!-- <p>no</p> -->
<main><div class="content"><h1>The   title</h1><p>First &amp; only <b>bold</b>face,<br>with a break.
<p>Second paragraph, unclosed, with enough words to count as text.<aside>Aside, not of it.</aside><ul><li>One<li>Two</ul>
<div class="ad">Buy now, it is cheap.</div><pre>a  b</pre><form><label>Name</label><input value="x"></form></div>
<div class="comments"><p>A reader says a lot, really a lot, about this.</p></div></main>
<div class="sidebar">Links, links.</div><footer>&copy; 2020, all of it.</footer></body></html>"""


def test_main_text():
    found = html_extract.main_text(PAGE)
    assert found.split("\n\n") == [
        "The title", "First & only boldface, with a break.", "Second paragraph, unclosed, with enough words to count as text.", "One", "Two", "a b",
    ]


def test_content_is_found_without_names():
    menu = "".join(f"<div><span>Item {k}</span></div>" for k in range(30))
    body = "".join(f"<p>Sentence {k} of the story, which goes on, and on, for quite some time.</p>" for k in range(8))
    found = html_extract.main_text(f"<body><table><tr><td>{menu}</td><td><section><h2>Story</h2>{body}</section></td></tr></table></body>")
    assert found.startswith("Story\n\nSentence 0") and "Item" not in found and found.count("Sentence") == 8


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""), ("just text &lt;", "just text <"), ("<p>a", "a"), ("<", "<"), ("<p", "<p"), ("<script>x", ""), ("<div>" * 3000 + "deep", "deep"),
        ("<nav>a</nav>", ""), ("<p>a</b></i>b</p></p><!-- x", "ab"), ("a<style>b", "a"), ("<P>A</P ><DIV>B</DIV>", "A\n\nB"),
    ],
)
def test_broken_pages(page, text):
    assert html_extract.main_text(page) == text


def test_pages(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "v", ""), (3, "v", ""), (None, "w", "<p>é</p>")]
    found = html_extract.extract(frame(spark, rows, "page_id long, url string, html string", ("text", "n_chars", "doc_id")))
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    expected = [(1, "u", len(html_extract.main_text(PAGE))), (2, None, 0), (3, "v", 0), (3, "v", 0), (None, "w", 1)]
    assert rows_of(found.select("page_id", "url", "n_chars")) == sorted(expected, key=repr)
    assert html_extract.extract(frame(spark, [], "page_id long, url string, html string", ())).isEmpty()


RULES = [("org/", "allow"), ("example.org/es/", "block"), ("com/fr/", "allow")]


def test_urls(spark):
    urls = [
        "http://A.example.ORG/es/1?x#y", "https://example.org/es", "http://example.org", "x://b.com/fr/#", "http://myexample.org/es/", "http://c.net:80/p",
        "no scheme", None, "", "http://c.net/q://r", "http://u@c.net?z", "HTTP://É.net/",
    ]
    found = url_filter.filter_urls(
        frame(spark, list(enumerate(urls)) + [(3, urls[3])], "page_id long, url string", ("host", "path", "rule", "verdict", "good", "labelled_id")),
        frame(spark, [(5, 1), (5, None), (99, 0), (None, 1)], "page_id long, good int", ()),
        RULES,
    )
    got = sorted((r.page_id, r.host, r.path, r.rule) for r in found.collect() if r.rule is not None)
    assert got == [
        (0, "a.example.org", "/es/1", "example.org/es/"), (1, "example.org", "/es", "org/"), (3, "b.com", "/fr/", "com/fr/"),
        (3, "b.com", "/fr/", "com/fr/"), (4, "myexample.org", "/es/", "org/"),
    ]
    rest = {r.page_id: (r.host, r.path) for r in found.collect() if r.rule is None}
    assert rest[2] == ("example.org", "") and rest[5] == ("c.net:80", "/p") and rest[6] == rest[7] == rest[8] == ("", "")
    assert rest[9] == ("c.net", "/q://r") and rest[10] == ("u@c.net", "") and rest[11] == ("É.net", "/")
    with pytest.raises(ValueError):
        url_filter.filter_urls(frame(spark, [(1, "")], "page_id long, url string", ()), frame(spark, [], "page_id long, good int", ()), [("a/", "allow"), ("a/", "block")])


def test_hosts_are_shrunk_towards_their_domain(spark):
    rows = [(h, g) for h, n, good in (("a.bad.net", 40, 1), ("b.bad.net", 40, 3), ("c.good.net", 400, 380), ("d.org", 300, 290)) for g in [1] * good + [0] * (n - good)]
    rows += [("new.bad.net", None), ("new.good.net", None), ("once.good.net", 0), ("odd.good.net", 5)]
    found = {r.host: r for r in url_filter.host_reputation(spark.createDataFrame(rows, "host string, good int")).collect()}
    assert found["a.bad.net"].by_reputation == found["b.bad.net"].by_reputation == "block"
    assert found["c.good.net"].by_reputation == found["d.org"].by_reputation == "allow"
    assert found["new.bad.net"].mean < 0.5 < found["new.good.net"].mean
    assert 0 < found["once.good.net"].mean < found["new.good.net"].mean and found["odd.good.net"].mean == found["new.good.net"].mean
    empty = spark.createDataFrame([], "host string, good int")
    assert url_filter.host_reputation(empty).isEmpty()


def test_byte_letters_are_those_of_the_vocabulary():
    with open(PATH) as file:
        ids = json.load(file)["model"]["vocab"]
    assert all(letter in ids for letter in bpe.byte_letters())


def test_items_without_an_id_are_looked_for(spark):
    item = " ".join(f"w{k}" for k in range(20))
    benchmark = frame(spark, [(None, item), (7, "short item")], "item_id long, text string")
    rows = decontaminate.decontaminate(frame(spark, [(1, item), (2, "clean words"), (3, f"{item} short item")]), benchmark).orderBy("doc_id").collect()
    assert [(r.n_hit, r.n_items, r.contaminated) for r in rows] == [(20, 1, True), (0, 0, False), (22, 2, True)]
    assert rows[2].items_sha256 == sha(",7") and rows[0].items_sha256 == sha("")


def test_labelled_texts_without_words_give_a_constant_score(spark):
    docs = frame(spark, [(1, ""), (2, "..."), (3, None), (4, "  "), (5, "some words")])
    labels = frame(spark, [(k, k % 2) for k in range(1, 5)], "doc_id long, toxic int")
    scores = {r.score for r in toxicity.score_toxicity(docs, labels).collect()}
    assert len(scores) == 1 and 0 < scores.pop() < 1
    assert toxicity.score_toxicity(docs.limit(0), labels).collect() == []


def test_long_texts_are_learned_from_by_stretches(spark):
    long = "".join(chr(97 + k // 1000 % 26) for k in range(60_000))
    short = "x" * toxicity.TRAIN_CHARS
    rows = frame(spark, [(1, long), (2, short), (3, None)]).select("doc_id", toxicity._bounded(F.col("text")).alias("t"), "text").orderBy("doc_id").collect()
    parts = rows[0].t.split(" ")
    assert len(parts) == toxicity.STRETCHES and {len(p) for p in parts} == {toxicity.TRAIN_CHARS // toxicity.STRETCHES}
    assert long.startswith(parts[0]) and long.endswith(parts[-1]) and rows[1].t == short and rows[2].t is None


ARTICLE = '<nav class="menu">Home | About</nav><article><header class="entry-header"><h1>Headline</h1></header><p>First text, with words.</p>'


def test_article_text_stays_whatever_a_word_of_its_class_is():
    text = html_extract.main_text
    page = ARTICLE + '<p class="notice-period">The notice period, is long.</p><div class="side-effects"><p>Side effects, are rare.</p></div>'
    page += '<div class="share-buttons">Share</div><div class="post-comments"><p>I, disagree.</p></div></article><div class="site-footer">Imprint, terms.</div>'
    assert text(page) == "Headline\n\nFirst text, with words.\n\nThe notice period, is long.\n\nSide effects, are rare."
    assert text('<div id="m"><div class="article-header"><h1>Headline</h1></div><p>Body text, with words. More.</p></div>').startswith("Headline")
    for names in ("ad", "ad-slot", "site-header", "cookie-banner top", "article-comments", "left-sidebar", "NavBar", "social_links", "header"):
        assert html_extract.says_never(names, False), names
    for names in ("entry-header", "side-effects", "cookie-recipe", "tag-along", "content", "header"):
        assert not html_extract.says_never(names, True), names


@pytest.mark.parametrize(
    "page, n_chars",
    [
        ('<a "' * 250_000, 1_000_000),
        ('<a ">" ' * 150_000, None),
        ("<div>x" * 160_000, None),
        ("<div>" * 100_000 + "</section>" * 100_000, 0),
        ("<i><div>" + "<b>" * 100_000 + "</i>" * 100_000 + "x", 1),
        ("<p>" + "<span>" * 100_000 + "<td>x" * 100_000, None),
        ("<a<a " * 200_000, None),
        ("<article><p>" + "word, " * 300_000 + "</p></article>", 1_799_999),
    ],
)
def test_broken_nested_and_long_pages_are_read_in_linear_time(page, n_chars):
    begin = time.process_time()
    found = html_extract.main_text(page)
    assert time.process_time() - begin < 5
    assert n_chars is None or len(found) == n_chars


def test_an_unclosed_quote_is_text_of_its_tag():
    assert html_extract.main_text('<p title="open>One, two.</p><p>Three, four.</p>') == "One, two.\n\nThree, four."
    assert html_extract.main_text('<p>One <a "x>y" two.') == 'One <a "x>y" two.'


def plain_content(page, filled):
    """Paths by the fused ratios, one node after another."""
    kernel = [0.05, 0.25, 0.4, 0.25, 0.05]
    paths = [page.path[e] for e, _, _ in filled]
    mine = {p: [t for (_, t, _), q in zip(filled, paths) if q == p] for p in paths}
    length = {p: sum(len(t.strip()) for t in ts) for p, ts in mine.items()}
    marks = {p: sum(sum(c in ".,;:!?…。，、؛،¿¡" for c in t) for t in ts) for p, ts in mine.items()}

    def smooth(values):
        out = []
        for k in range(len(values)):
            near = [(kernel[d + 2], values[k + d]) for d in range(-2, 3) if 0 <= k + d < len(values)]
            out.append(sum(w * v for w, v in near) / sum(w for w, _ in near))
        return out

    text = smooth([length[p] / len(mine[p]) for p in paths])
    mark = smooth([(marks[p] + 0.1) / len(mine[p]) for p in paths])
    fused = [math.sqrt(a * b) for a, b in zip(text, mark)]
    mean = {p: sum(f for f, q in zip(fused, paths) if q == p) / len(mine[p]) for p in mine}
    threshold = 0.5 * sum(mean[p] * length[p] for p in mean) / sum(length.values())
    return {p for p, value in mean.items() if value >= threshold}


def test_tag_path_ratios_equal_plain_loops(spark):
    sources = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    rng = random.Random(2)
    bits = ["<p>", "</p>", "<div class=a>", "</div>", "<a href=x>", "</a>", "<li>", "Some, text. ", "more words here ", "<b>", "</b>", "<h2>", "Title"]
    sources += ["".join(rng.choice(bits) for _ in range(rng.randint(3, 80))) for _ in range(300)]
    n = 0
    for source in sources:
        page = html_extract._Page(source or "")
        filled = [x for x in page.nodes if x[1].strip()]
        if filled:
            n += 1
            assert html_extract._content(page, filled) == plain_content(page, filled)
    assert n > 400


def secret_documents(n=400, seed=8):
    """Tokens behind words that ask for secrecy, and the same shapes behind words that say what else they are."""
    rng = random.Random(seed)
    key = lambda size, letters="0123456789abcdef": "".join(rng.choice(letters) for _ in range(size))
    mixed = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz0123456789"
    rows, secrets = [], {}
    for k in range(n):
        value = key(40) if k % 2 else key(32, mixed) + "7aB"
        if k % 4 < 2:
            text = f'padding words {rng.choice(["token", "api_key", "password", "SECRET", "bearer"])} = "{value}" more words'
            secrets[k] = f"secret:{text.index(value)}:{text.index(value) + len(value)}"
        else:
            quote = rng.choice(['"', ""])
            text = f'padding words {rng.choice(["commit", "sha1", "checksum", "uuid", "revision"])}: {quote}{value}{quote} more words'
        rows.append((k, text))
    rows += [(n + 1, "a-long-name-of-a-page-2024-in-words"), (n + 2, "supercalifragilistic12345"), (n + 3, "x" * 500), (n + 4, "user12345678901234567890@example.org")]
    return rows, secrets


def test_secrets_are_told_from_digests_by_the_classifier(spark):
    rows, secrets = secret_documents()
    found = {r.doc_id: r for r in pii.find_pii(frame(spark, rows)).collect()}
    added = {d: r.spans for d, r in found.items() if "secret" in r.spans}
    assert added == secrets
    plain = {d: base_spans(text) for d, text in rows}
    assert all(r.base_sha256 == sha(",".join(plain[d][1])) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == plain[d][0] for d, r in found.items())
    assert all(r.n_spans == len([x for x in r.spans.split(",") if x]) == len(r.found) for r in found.values())


def test_the_pattern_alone_would_take_digests_for_secrets(spark):
    rows, secrets = secret_documents()
    wide = pii.candidates(frame(spark, rows)).select("doc_id", F.explode("wide").alias("s")).filter("s.kind = 'secret'")
    votes = {tuple(r) for r in wide.select("s.by_pattern", "s.by_list", "s.by_context").distinct().collect()}
    assert wide.count() > 1.9 * len(secrets) and {(1, 0, 1), (1, 0, -1), (0, 0, -1)} <= votes


def test_wide_spans_beside_base_spans(spark):
    """By their neighbours, against every pair."""
    rng = random.Random(1)
    parts = ["+1 212 555 0199", "(212) 555-0123", "212-555-0123", " +49", "x", " ", "212 555 0100", "+44 (212) 555-0199 212-555-0188"]
    rows = [(k, "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))) for k in range(150)]
    named = F.coalesce(pii.located(F.col("text"), pii.BASE["phone"]), F.array().cast("array<struct<start:int,end:int,value:string,before:string>>"))
    wide = pii.located(F.col("text"), pii.WIDE["phone"])
    spans = frame(spark, rows).select("text", named.alias("phone"), wide.alias("phone_wide"))
    n = 0
    for r in spans.select("text", "phone", "phone_wide", pii._clear_of("phone").alias("clear")).collect():
        assert [(s.start, s.end) for s in r.phone] == [m.span() for m in re.finditer(pii.BASE["phone"], r.text)]
        apart = [w for w in r.phone_wide if not any(w.start < b.end and b.start < w.end for b in r.phone)]
        assert r.clear == apart
        n += len(apart) < len(r.phone_wide)
    assert n > 10


def test_personal_data_takes_time_in_proportion(spark):
    begin = time.time()
    text = "a@b.c " * 400_000
    row = pii.find_pii(frame(spark, [(1, text)])).select("n_email", "n_spans").first()
    assert tuple(row) == (400_000, 400_000) and time.time() - begin < 20
    begin = time.time()
    row = pii.find_pii(frame(spark, [(1, "+1 212 555 0199 or 212-555-0123, " * 40_000)])).first()
    assert row.n_phone == 40_000 and time.time() - begin < 20


def test_no_documents_and_no_pages(spark):
    assert bpe.encode_digests(frame(spark, []), PATH).collect() == []
    pages, outcomes = "page_id long, url string", "page_id long, good int"
    none = frame(spark, [], pages), frame(spark, [(1, 0)], outcomes), [("org/", "allow")]
    assert url_filter.filter_urls(*none).collect() == []
    urls = [(1, "https://a.org/x"), (2, None), (3, "http://b.com/" + "y" * 500_000)]
    found = url_filter.filter_urls(frame(spark, urls, pages), frame(spark, [], outcomes), [("org/", "block")]).orderBy("page_id").collect()
    assert [(r.host, len(r.path), r.rule, r.verdict) for r in found] == [("a.org", 2, "org/", "block"), ("", 0, None, "allow"), ("b.com", 500_001, None, "allow")]


def test_hosts_with_bad_outcomes_are_blocked_by_reputation(spark):
    """Through the filter, beside rules: 40 bad pages block a host, 40 good ones do not, a rule wins over both."""
    pages = [(k, f"http://{('bad', 'fine')[k % 2]}{k % 4}.example{k % 4}.net/p") for k in range(160)] + [(900, "http://bad0.example0.net/kept/x"), (901, "http://new.example7.net/")]
    outcomes = [(k, k % 2) for k in range(160)]
    found = url_filter.filter_urls(frame(spark, pages, "page_id long, url string"), frame(spark, outcomes, "page_id long, good int"), [("net/kept/", "allow")])
    verdicts = {r.page_id: (r.rule, r.verdict) for r in found.collect()}
    assert all(verdicts[k] == (None, ("block", "allow")[k % 2]) for k in range(160))
    assert verdicts[900] == ("net/kept/", "allow") and verdicts[901] == (None, "allow")
