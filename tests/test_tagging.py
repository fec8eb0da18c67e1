"""Lexicon tagging from tags to labels."""

import json
import re

import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from tagweave.operators.tagging import (
    apply_dimensions,
    combine_clauses,
    distinct_posts,
    explode_labels,
    flag_objects,
    label_posts,
    retag_clauses,
    tag_columns,
    tag_posts,
)
from tagweave.sources.lexicon import Lexicon, lexicon_entries, load_lexicon

LEXICON = Lexicon(
    "milk",
    {"brand-x": "xmilk", "brand-y": "ymilk", "mood.good": "good|fine", "mood.bad": "bad|b[ao]d"},
    {"x good": "brand-x[&]mood.good", "x bad": "brand-x[&]mood.bad", "mood.bad": "brand-x", "a,b": "brand-y"},
    ["brand"],
)
SCHEMA = "id bigint, content string, place string"
POSTS = [
    (1, "XMilk is good, ymilk is bad", "p"),
    (2, "xmilk is BAD, it is good", "p"),
    (3, None, "p"),
    (4, "nothing", "p"),
    (1, "XMilk is good, ymilk is bad", "p"),
    (5, ",。!", "p"),
]
# Post 1 is cut: "xmilk is good" and "ymilk is bad". Post 2 names one brand, so it stays whole.
LABELS = {(1, "x good"), (1, "mood.bad"), (1, "a,b"), (2, "x good"), (2, "x bad"), (2, "mood.bad")}


@pytest.fixture
def posts(spark):
    return spark.createDataFrame(POSTS, SCHEMA)


def stepwise(posts, lexicon):
    rows = retag_clauses(flag_objects(tag_posts(posts, lexicon), lexicon), lexicon)
    return explode_labels(combine_clauses(apply_dimensions(rows, lexicon), lexicon, posts.columns), posts.columns)


def pairs(labels):
    return sorted((r.id, r.attr) for r in labels.collect())


def test_tags(posts):
    tags = {r.id: r.tags for r in tag_posts(posts, LEXICON).collect()}
    assert tags[1] == ["brand-x", "brand-y", "mood.good", "mood.bad"] and tags[3] == tags[4] == []


def test_tag_columns(posts):
    rows = {r.id: r for r in tag_columns(posts, LEXICON).collect()}
    assert rows[2]["mood.bad"] is True and rows[2]["brand-y"] is False and rows[3]["brand-x"] is False


def test_objects_need_two_tags(posts):
    objects = {r.id: r.objects for r in flag_objects(tag_posts(posts, LEXICON), LEXICON).collect()}
    assert objects == {1: ["brand"], 2: [], 3: [], 4: [], 5: []}


def test_an_object_in_no_tag_is_never_flagged(posts):
    lexicon = Lexicon("l", LEXICON.tags, {}, ["ghost"])
    assert flag_objects(tag_posts(posts, lexicon), lexicon).filter(F.size("objects") > 0).isEmpty()


def test_clauses_are_tagged_on_their_own(posts):
    rows = retag_clauses(flag_objects(tag_posts(posts, LEXICON), LEXICON), LEXICON)
    assert sorted(r.tags for r in rows.filter("id = 1").collect()) == [["brand-x", "mood.good"]] * 2 + [["brand-y", "mood.bad"]] * 2
    assert rows.filter("id = 2").count() == rows.filter("id = 3").count() == 1
    assert {r.content for r in rows.filter("id = 1").collect()} == {POSTS[0][1]}


def test_labels(posts):
    assert pairs(label_posts(posts, LEXICON)) == sorted(LABELS)
    assert pairs(stepwise(posts, LEXICON)) == sorted(LABELS)


def test_whole_rows_are_kept(posts):
    labels = label_posts(posts, LEXICON)
    assert labels.columns == ["id", "content", "place", "attr"]
    assert labels.filter("id = 1").first().content == POSTS[0][1]


def test_equal_posts_become_one_only_with_objects(posts):
    plain = Lexicon("l", LEXICON.tags, LEXICON.dimensions, [])
    assert pairs(label_posts(posts, plain)).count((1, "x good")) == 2
    assert pairs(label_posts(posts, LEXICON, posts_differ=True)).count((1, "x good")) == 2


def test_flagged_post_of_marks_alone_vanishes(spark):
    lexicon = Lexicon("l", {"m1": "!", "m2": ","}, {"any": "m1[|]m2"}, ["m"])
    posts = spark.createDataFrame([(1, ",!", "p"), (2, "a!,b", "p")], SCHEMA)
    assert label_posts(posts, lexicon).isEmpty() and stepwise(posts, lexicon).isEmpty()
    assert retag_clauses(flag_objects(tag_posts(posts, lexicon), lexicon), lexicon).count() == 3


def test_rules_can_name_objects_and_input_columns(spark):
    lexicon = Lexicon("l", LEXICON.tags, {"d": "brand[&]vip[&]mood.bad"}, ["brand"])
    posts = spark.createDataFrame([(1, "xmilk, ymilk, bad", True), (2, "xmilk, ymilk, bad", False)], "id bigint, content string, vip boolean")
    assert pairs(label_posts(posts, lexicon)) == pairs(stepwise(posts, lexicon)) == [(1, "d")]


def test_empty_lexicon(posts):
    assert label_posts(posts, Lexicon("l", {})).isEmpty()
    assert label_posts(posts, Lexicon("l", {}, {}, ["o"])).isEmpty()


def test_both_ways_agree_on_documents(spark, sf_dir):
    posts = fx.posts(spark, sf_dir)
    whole, steps = label_posts(posts, fx.FX1), stepwise(posts, fx.FX1)
    assert whole.exceptAll(steps).isEmpty() and steps.exceptAll(whole).isEmpty() and whole.count() == 981


def test_text_is_matched_once(spark, sf_dir):
    """No filter holds a pattern, so the scan does not match what the projection matches again."""
    posts = fx.posts(spark, sf_dir)
    plan = label_posts(posts, fx.FX1)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter " in line]
    assert not any("RLIKE" in line or "Contains" in line for line in filters)
    # Once over whole texts and once over clauses.
    assert plan.count("[a-z0-9._]+@[a-z0-9.]+") == 2


def keys_of_exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_texts_are_no_keys(spark, posts):
    steps = apply_dimensions(retag_clauses(flag_objects(tag_posts(posts, LEXICON), LEXICON), LEXICON), LEXICON)
    for rows in (label_posts(posts, LEXICON), combine_clauses(steps, LEXICON, posts.columns)):
        keys = keys_of_exchanges(rows)
        assert keys and not any("content" in line.split("hashpartitioning")[1] for line in keys)


def test_posts_that_share_a_digest_stay_apart(spark, posts):
    odd = posts.union(spark.createDataFrame([(None, "a", None), (None, None, "a"), (None, "a", None), (7, "", ""), (7, None, "")], SCHEMA))
    same = lambda columns: F.lit(1)
    assert sorted(map(tuple, distinct_posts(odd, same).collect()), key=repr) == sorted(map(tuple, odd.distinct().collect()), key=repr)
    steps = apply_dimensions(retag_clauses(flag_objects(tag_posts(odd, LEXICON), LEXICON), LEXICON), LEXICON)
    own, collided = (combine_clauses(steps, LEXICON, odd.columns, *d) for d in ((), (same,)))
    rows = lambda df: sorted(((r.id, r.content, r.place, tuple(r.labels)) for r in df.collect()), key=repr)
    assert rows(own) == rows(collided)
    assert [r.labels for r in own.filter("id = 1").collect()] == [["x good", "mood.bad", "a,b"]]


def test_a_lexicon_of_thousands_is_one_pass(spark):
    """The same rows as a plain search, from a plan that has no expression for each tag."""
    posts = fx.posts(spark, "/root/testdata/sf0.001")
    texts = {r.id: r.content for r in posts.collect()}
    words = sorted({w[k:] for t in texts.values() for w in re.findall("[a-z]{5,}", t.lower()) for k in (0, 2)})[:4000]
    tags = {f"w {w}": w for w in words} | {f"p {w}": f"{w[:3]}[a-z]{{1,4}}{w[-1]}" for w in words[::40]}
    tagged = tag_posts(posts, Lexicon("l", tags))
    plan = tagged._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(" not in plan and plan.count("regexp_extract_all") == 1
    found = {r.id: r.tags for r in tagged.select("id", "tags").collect()}
    for id_, text in texts.items():
        low = text.lower()
        assert found[id_] == [n for n, p in tags.items() if (p in low if n[0] == "w" else re.search(p, text, re.I | re.A))]


def rules_table(spark, *rows):
    return spark.createDataFrame(rows, "name string, tags string, dimensions string, objects string")


def test_load_lexicon(spark):
    rules = rules_table(
        spark,
        ("a", json.dumps({"z": "1", "b": "2"}), None, None),
        ("b", json.dumps({"t": "x"}), "{broken", json.dumps(["o"])),
        ("c", None, None, None),
        ("d", "{}", None, None),
        ("d", "{}", None, None),
    )
    assert list(load_lexicon(rules, "a").tags) == ["z", "b"] and load_lexicon(rules, "a").dimensions == {}
    assert load_lexicon(rules, "b") == Lexicon("b", {"t": "x"}, {}, ["o"])
    with pytest.raises(ValueError, match="no tags"):
        load_lexicon(rules, "c")
    with pytest.raises(LookupError, match="more than one"):
        load_lexicon(rules, "d")
    with pytest.raises(LookupError, match="no rule set"):
        load_lexicon(rules, "e")


def test_lexicon_entries(spark):
    rules = rules_table(spark, ("a", json.dumps({"t": "x"}), json.dumps({"d": "t"}), json.dumps(["o"])), ("b", json.dumps({"u": "y"}), None, None))
    rows = {tuple(r) for r in lexicon_entries(rules).collect()}
    assert rows == {("a", "tag", "t", "x"), ("a", "dimension", "d", "t"), ("a", "object", "o", None), ("b", "tag", "u", "y")}
