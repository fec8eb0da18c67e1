"""Registered queries of the operators, each over its whole table, and their SQL where it can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tagweave.llm import (
    bpe,
    centroids,
    decontaminate,
    divergence,
    exact_dedup,
    html_extract,
    licenses,
    minhash,
    pii,
    substring_dedup,
    suffix_dedup,
    toxicity,
    url_filter,
)

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(_table(spark, sf_dir, "documents")).drop("spans", "kept")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents")).drop("found")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A page's outcome is the quality that is given for its id.
    outcomes = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), outcomes, URL_RULES)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("spans")


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence_audit(_table(spark, sf_dir, "documents"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(_table(spark, sf_dir, "embeddings"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("found")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_pii": op2_pii,
    "op3_toxicity": op3_toxicity,
    "op4_minhash": op4_minhash,
    "op5_bpe": op5_bpe,
    "op6_url_filter": op6_url_filter,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_decontaminate": op9_decontaminate,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_divergence": op11_divergence,
    "op12_centroids": op12_centroids,
    "op13_licenses": op13_licenses,
}

#: The prior of a level from its children: see url_filter._strength.
_STRENGTH = """(select 1 / least(greatest(coalesce(
         sum(pow(good - n * prior, 2) - n * prior * (1 - prior)) / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0), 0), 0.001), 0.999) - 1
       from {0} where n > 0)"""


def _level(name: str, above: str, keys: str) -> str:
    """A level's counts with the prior from above, then its mean and weight."""
    strength = _STRENGTH.format(f"{name}_counts")
    return f"""
        {name}_counts as (
            select {keys}, sum(h.good) as good, sum(h.n) as n, any_value(a.mean) as prior
            from hosts h join {above} group by {keys}),
        {name}_level as (
            select *, n + {strength} as weight, (good + {strength} * prior) / (n + {strength}) as mean from {name}_counts)"""


_RULES = ", ".join(f"('{rule[: rule.index('/')]}', '{rule[rule.index('/') :]}', '{rule}', '{verdict}')" for rule, verdict in URL_RULES)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Squared distance of vector v of a and c of b, and the clustering written out round by round.
_FAR = "list_sum(list_transform(range(1, 65), lambda i: (v[i] - c[i]) * (v[i] - c[i])))"


def _assignment(table: str, centroids: str) -> str:
    return f"""
        {table} as (
            select rid, any_value(v) as v, arg_min(k, (far, k)) as k, min(far) as far
            from (select rid, v, k, {_FAR} as far from vectors, {centroids}) group by rid)"""


def _moved(centroids: str, before: str, assigned: str) -> str:
    return f"""
        {centroids} as (
            select b.k, coalesce(any_value(m.c), any_value(b.c)) as c
            from {before} b left join (
                select k, list(mean order by d) as c
                from (select k, d, cast(floor(sum(x) / count(*)) as bigint) as mean
                      from (select k, unnest(v) as x, unnest(range(1, 65)) as d from {assigned}) group by k, d)
                group by k) m on b.k = m.k
            group by b.k)"""


ORACLES: dict[str, str] = {
    "op11_divergence": f"""
        with docs as (
            select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
                   translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text
            from documents),
        words as (
            select doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from docs),
        counts as (select lang, source, term, count(*) as n, count(distinct doc) as docs from words group by all),
        kept as (select lang, term, sum(n) as of_lang from counts group by all having sum(docs) >= 30),
        groups as (select distinct lang, source from docs),
        cells as (
            select g.lang, g.source, k.term, coalesce(c.n, 0) as n, k.of_lang
            from groups g join kept k using (lang) left join counts c using (lang, source, term)),
        sums as (select lang, source, sum(n) as total, count(*) as v from cells group by all),
        langs as (select lang, sum(of_lang) as total, count(*) as v from kept group by all),
        shares as (
            select c.lang, c.source, c.term, c.n,
                   1 + (1000000000 * cast(c.n + 5 as hugeint)) // (s.total + 5 * s.v) as p,
                   1 + (1000000000 * cast(c.of_lang + 5 as hugeint)) // (l.total + 5 * l.v) as q
            from cells c join sums s using (lang, source) join langs l using (lang)),
        far as (
            select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        results as (
            select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
            from groups a join groups b on a.lang = b.lang and a.source <> b.source
            left join far f on a.lang = f.lang and a.source = f.source and b.source = f.item
            union all
            select lang, source, 'term', term, p - q from shares where n > 0 and p > q)
        select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
        from (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from results)
        where part = 'pair' or rank <= 50
    """,
    "op12_centroids": f"""
        with vectors as (
            select row_number() over () as rid, vec_id,
                   list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
            from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
        round0 as (
            select row_number() over (order by sha256('1:' || vec_id), v) - 1 as k, v as c
            from vectors qualify k < 16),
        {_assignment("assigned0", "round0")},
        {_moved("round1", "round0", "assigned0")},
        {_assignment("assigned1", "round1")},
        {_moved("round2", "round1", "assigned1")},
        {_assignment("assigned2", "round2")},
        {_moved("round3", "round2", "assigned2")},
        {_assignment("assigned3", "round3")}
        select vec_id, cast(a.k as integer) as cluster, cast(far as bigint) as distance,
               cast(sum(far) over (partition by a.k) as bigint) as cluster_inertia, cast(sum(far) over () as bigint) as inertia,
               sha256(array_to_string(c, ',')) as centroid_sha256
        from assigned3 a join vectors using (rid) join round3 r on a.k = r.k
    """,
    "op6_url_filter": f"""
        with parts as (
            select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                   regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) as path
            from pages),
        counted as (
            select host, coalesce(sum(quality), 0) as good, count(quality) as n
            from parts left join (select doc_id, quality from labels where quality in (0, 1)) on page_id = doc_id group by host),
        named as (select *, string_split(regexp_replace(host, '^.*@|:[0-9]*$', '', 'g'), '.') as names from counted),
        sized as (select *, array_to_string(names[-2:], '.') in ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') as long from named),
        hosts as (
            select host, good, n, array_to_string(case when long then names[-2:] else names[-1:] end, '.') as suffix,
                   array_to_string(case when long then names[-3:] else names[-2:] end, '.') as domain
            from sized),
        total_level as (select (sum(good) + 1) / (sum(n) + 2) as mean from hosts),
        {_level("suffix", "total_level a on true", "h.suffix")},
        {_level("domain", "suffix_level a on h.suffix = a.suffix", "h.suffix, h.domain")},
        {_level("host", "domain_level a on h.suffix = a.suffix and h.domain = a.domain", "h.suffix, h.domain, h.host")},
        rules as (select * from (values {_RULES}) r(name, start, rule, verdict)),
        fit as (
            select page_id, host, path, max_by(rule, length(rule)) as rule, max_by(verdict, length(rule)) as verdict
            from parts join rules on (host = name or ends_with(host, '.' || name)) and starts_with(path, start) group by all)
        select p.page_id, p.host, p.path, f.rule,
               coalesce(f.verdict, case when l.mean + 1.645 * sqrt(l.mean * (1 - l.mean) / (l.weight + 1)) < 0.5
                                        then 'block' else 'allow' end) as verdict
        from parts p join host_level l on p.host = l.host left join fit f on p.page_id = f.page_id
    """,
    "op10_exact_dedup": """
        with normal as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as plain,
                   length(coalesce(text, '')) as n_chars
            from documents),
        ranked as (
            select doc_id, plain,
                   first_value(doc_id) over (partition by plain order by n_chars desc, doc_id) as keep_id,
                   count(*) over (partition by plain) as group_size
            from normal)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(plain) as text_sha256
        from ranked
    """,
}
