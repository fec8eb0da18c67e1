"""The pipeline over documents, stage by stage against plain loops, and what is registered."""

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from plain import contamination, exact_groups, frame, near_groups
from tagweave.llm.common import stage
from tagweave.llm.queries import ORACLES, QUERIES


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_what_plain_loops_keep(spark, tmp_path):
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    texts = lambda df: [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    expected = {
        "exact dedup": lambda rows: {keep for keep, _ in exact_groups(rows).values()},
        "near dedup": lambda rows: {d for d, (_, c) in near_groups(rows).items() if d == c},
        "decontamination": lambda rows: {r[0] for r in contamination(rows, benchmark) if not r[5]},
        "bpe": lambda rows: {d for d, _ in rows},
    }
    toxic = {r.doc_id for r in spark.read.parquet(f"{small}/labels.parquet").filter("toxic = 1").collect()}
    for k, (name, apply) in enumerate(corpus_pipeline.STAGES):
        before = texts(docs)
        apply(spark, docs, small).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        if name in expected:
            assert kept == expected[name](before), name
        else:
            assert kept < {d for d, _ in before} and 2 * len(kept & toxic) < len(toxic)
        assert name == "bpe" or docs.columns == columns
    assert docs.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert all(r.n_tokens == len(r.ids.split()) for r in docs.collect())
    assert {r.doc_id for r in corpus_pipeline.run(spark, small).collect()} == kept


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Null and repeated ids, empty and long texts, copies, clashing columns; then no documents at all."""
    copy, other, item = (" ".join(f"{c}{k}" for k in range(40)) for c in "abc")
    near = copy.replace("a39", "changed")
    rows = [
        (None, copy), (None, copy), (1, copy + " "), (1, other), (2, other), (None, item), (3, f"say {item}"), (None, ""), (4, None),
        (5, near), (6, "x" * 200_000), (6, "word " * 60_000), (None, "only without an id here"), (7, "...")
    ]
    docs = frame(spark, rows, extra=["lang", "source", "_row", "tag", "best", "n", "labelled_id"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    frame(spark, [(1, 0), (2, 1), (None, 1)], "doc_id long, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    frame(spark, [(None, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    folder = str(tmp_path)
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    names = kept.columns
    seen = []
    for name, apply in corpus_pipeline.STAGES[1:4]:
        kept = stage(apply(spark, kept, folder), "odd")
        assert kept.columns == names
        seen.append(sorted(((r.doc_id, (r.text or "")[:6]) for r in kept.collect()), key=repr))
    without_copies = [(1, "a0 a1 "), (1, "b0 b1 "), (None, "c0 c1 "), (3, "say c0"), (4, ""), (5, "a0 a1 "), (6, "xxxxxx"), (6, "word w"), (None, "only w"), (7, "...")]
    near_gone = [r for r in without_copies if r not in ((5, "a0 a1 "), (None, "c0 c1 "))]
    clean = [r for r in near_gone if r[0] != 3]
    assert seen == [sorted(x, key=repr) for x in (without_copies, near_gone, clean)]
    assert corpus_pipeline.run(spark, folder).count() <= len(clean)
    empty = tmp_path / "empty"
    docs.limit(0).write.parquet(str(empty / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).collect() == []
