"""The registered queries as SQL over the test tables, written from the definition of each metric.

Posts are joined to angles first and users counted with ``count(distinct …)``, so nothing is shared
with the way the Spark queries go about it.
"""

from __future__ import annotations

from checks.fixtures import DIMENSIONS, FX1, OBJECTS, SPECIAL_PEOPLE, TAGS

LINES = """
lines as (
  select cast(o.o_orderkey as varchar) as id, cast(o.o_custkey as varchar) as user_id,
         substring(o.o_orderpriority, 1, 1) as platform_id,
         case l.l_linenumber
           when 1 then '场景.' || p.p_type
           when 2 then '场景.' || p.p_type || '.' || split_part(p.p_name, ' ', 1)
           when 3 then 'TP.' || split_part(p.p_name, ' ', 2)
           when 4 then 'TP.' || split_part(p.p_name, ' ', 2) || '.' || split_part(p.p_name, ' ', 1)
           when 5 then 'TP内圈.A.场景A'
           when 6 then 'TP内圈.B.场景B'
           else 'TP.' || split_part(p.p_name, ' ', 2) || '.' || split_part(p.p_name, ' ', 1) || '.deep' end as attr,
         case when l.l_returnflag <> 'N' then cast(p.p_size % 10 as varchar) end as cat,
         case when l.l_linestatus = 'O' then cast(p.p_size % 10 as varchar) || '_' || substring(p.p_brand, 7) end as brand
  from orders o join lineitem l on o.o_orderkey = l.l_orderkey join part p on l.l_partkey = p.p_partkey),
cat_text as (
  select id, string_agg(cat, ',' order by cat) as categories
  from (select distinct id, cat from lines where cat is not null) group by id),
brand_text as (
  select id, string_agg(brand, ',' order by brand) as brands
  from (select distinct id, brand from lines where brand is not null) group by id),
cats as (select distinct id, try_cast(cat as integer) as category from lines where cat is not null),
codes as (
  select distinct id, try_cast(split_part(brand, '_', 1) as integer) as category,
         try_cast(split_part(brand, '_', 2) as integer) as brand
  from lines where brand is not null)"""

PEOPLE = """
persons as (
  select cast(c.c_custkey as varchar) as user_id, cast(g.p as varchar) as platform_id,
         c.c_mktsegment as people_type, r.r_name as angle, c.c_acctbal > 5000 as vip
  from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
  cross join (select unnest([1, 2, 3, 4, 5]) as p) g
  where (c.c_custkey + g.p) % 3 <> 0),
people as (
  select user_id, platform_id, people_type, angle as people_angle from persons
  union all
  select user_id, platform_id, people_type, 'VIP' from persons where vip)"""

PATHS = """
paths as (
  select distinct id, user_id, platform_id, attr,
         case when attr like 'TP.%' and len(string_split(attr, '.')) = 3 then 'sub_tp'
              when attr like 'TP.%' and len(string_split(attr, '.')) = 2 then 'tp'
              when attr like '%.A.%' then 'scene_A'
              when attr like '%.B.%' then 'scene_B'
              when attr like '场景.%' then 'scene' end as kind
  from lines where len(string_split(attr, '.')) in (2, 3))"""


def _runs(pending: list[tuple[int, str]]) -> str:
    rows = ", ".join(f"({run}, '{value}')" for run, value in pending)
    return f"""
runs as (select cast(run as bigint) as data_model, string_split(value, ',') as words from (values {rows}) v(run, value)),
in_run as (
  select r.data_model, p.* from paths p cross join runs r
  where p.kind is not null and (list_contains(r.words, '') or p.attr not like '场景.%'
        or list_contains(r.words, string_split(p.attr, '.')[-1])))"""


ONE_RUN = _runs([(0, "")])
_WORDS: dict[int, list[str]] = {}
for _id, _value, _state in SPECIAL_PEOPLE:
    if _state in (2, 4) and _id is not None:
        _WORDS.setdefault(_id, []).append(_value)
ALL_RUNS = _runs([(i, ",".join(values)) for i, values in _WORDS.items()])

TYPED = """
typed as (
  select data_model, id, user_id, platform_id, kind as attr_type,
         case when kind = 'tp' then split_part(attr, '.', 2) else attr end as attr
  from in_run where kind <> 'scene'
  union all
  select data_model, id, user_id, platform_id, 'sub_scene', attr from in_run where kind = 'scene'
  union
  select data_model, id, user_id, platform_id, 'scene', split_part(attr, '.', 2) from in_run where kind = 'scene')"""

AUDIENCE = """
aud as (
  select r.*, p.people_type, p.people_angle from in_run r join people p on r.user_id = p.user_id and r.platform_id = p.platform_id),
sc as (select *, split_part(attr, '.', 2) as scene, nullif(split_part(attr, '.', 3), '') as child from aud where kind = 'scene'),
tp as (
  select *, case when kind = 'sub_tp' then split_part(attr, '.', 2) else 'self' end as parent_tp,
         case when kind = 'sub_tp' then split_part(attr, '.', 3) else split_part(attr, '.', 2) end as tp
  from aud where kind in ('tp', 'sub_tp')),
ins as (select * from aud where kind in ('scene_A', 'scene_B'))"""


# Posts of which each line has its own author and lists.
OWN_LINES = """
lines as (
  select cast(o.o_orderkey as varchar) as id, cast(o.o_custkey + l.l_linenumber % 3 as varchar) as user_id,
         substring(o.o_orderpriority, 1, 1) as platform_id,
         case l.l_linenumber
           when 1 then '场景.' || p.p_type
           when 2 then '场景.' || p.p_type || '.' || split_part(p.p_name, ' ', 1)
           when 3 then 'TP.' || split_part(p.p_name, ' ', 2)
           when 4 then 'TP.' || split_part(p.p_name, ' ', 2) || '.' || split_part(p.p_name, ' ', 1)
           when 5 then 'TP内圈.A.场景A'
           when 6 then 'TP内圈.B.场景B'
           else 'TP.' || split_part(p.p_name, ' ', 2) || '.' || split_part(p.p_name, ' ', 1) || '.deep' end as attr,
         case when l.l_returnflag <> 'N' then cast(p.p_size % 10 as varchar) end as cat,
         case when l.l_linestatus = 'O' then cast(p.p_size % 10 as varchar) || '_' || substring(p.p_brand, 7) end as brand
  from orders o join lineitem l on o.o_orderkey = l.l_orderkey join part p on l.l_partkey = p.p_partkey)"""

OWN_PATHS = PATHS.replace("platform_id, attr,", "platform_id, attr, cat, brand,")

OWN_JOINED = """
aud as (
  select r.*, p.people_type, p.people_angle from in_run r join people p on r.user_id = p.user_id and r.platform_id = p.platform_id),
a as (select distinct data_model, people_type, people_angle, platform_id, id, user_id, cat, brand, split_part(attr, '.', 2) as scene
      from aud where kind = 'scene'),
b as (select distinct data_model, people_type, people_angle, platform_id, id, user_id, cat, brand, kind,
             case when kind = 'tp' then split_part(attr, '.', 2) else attr end as tp from aud where kind in ('tp', 'sub_tp')),
c as (select distinct data_model, people_type, people_angle, platform_id, id, kind from aud where kind in ('scene_A', 'scene_B')),
joined as (
  select data_model, people_type, people_angle, platform_id, id, scene, tp, b.kind,
         case when b.tp is null then a.user_id else b.user_id end as user_id,
         case when b.tp is null then a.cat else b.cat end as cat,
         case when b.tp is null then a.brand else b.brand end as brand
  from a full join b using (data_model, people_type, people_angle, platform_id, id))"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


_BASE = _with(LINES, PEOPLE, PATHS, ALL_RUNS, AUDIENCE)
_KEYS = "data_model, people_type, people_angle"
_POST = "data_model, people_type, people_angle, platform_id, id"


def _scene(category: bool) -> str:
    source = "sc join cats using (id)" if category else "sc"
    cat = "category, " if category else ""
    on = f"{_KEYS}, {cat}scene"
    return f"""{_BASE},
base as (select * from {source}),
own as (
  select {on}, count(distinct b.user_id) as user_count, count(distinct case when t.id is not null then b.user_id end) as tp_user
  from base b left join (select distinct {_POST} from tp) t using ({_POST}) group by {on}),
inside as (
  select {on}, count(distinct b.user_id) as inside_track_user,
         count(distinct case when i.kind = 'scene_A' then b.user_id end) as inside_track_A_user,
         count(distinct case when i.kind = 'scene_B' then b.user_id end) as inside_track_B_user
  from base b join (select distinct {_POST}, kind from ins) i using ({_POST}) group by {on}),
total as (select {_KEYS}{', category' if category else ''}, count(distinct user_id) as all_scene_user from base group by all)
select {on}, user_count, tp_user, coalesce(inside_track_user, 0) as inside_track_user,
       coalesce(inside_track_A_user, 0) as inside_track_A_user, coalesce(inside_track_B_user, 0) as inside_track_B_user, all_scene_user
from own left join inside using ({on}) left join total using ({_KEYS}{', category' if category else ''})"""


def _brand_share(source: str, names: str) -> str:
    return f"""{_BASE},
base as (select * from {source}),
own as (select {_KEYS}, {names}, category, brand, count(distinct user_id) as user_count from base group by all),
total as (select {_KEYS}, {names}, category, count(distinct user_id) as brand_all_user from base group by all)
select {_KEYS}, {names}, category, brand, user_count, brand_all_user
from own left join total using ({_KEYS}, {names}, category)"""


def _subscene(category: bool) -> str:
    cat = "category, " if category else ""
    return f"""{_BASE}
select {_KEYS}, scene as parent_scene, child as scene, {cat}count(distinct user_id) as user_count, count(distinct id) as id_count
from {'sc join cats using (id)' if category else 'sc'} group by {_KEYS}, scene, child{', category' if category else ''}"""


_PAIR = f"(select s.data_model, s.people_type, s.people_angle, s.id, s.user_id, s.scene, t.parent_tp, t.tp, t.kind from sc s join tp t using ({_POST}))"

TP_METRICS = f"""{_BASE},
one as (select * from tp where kind = 'tp'),
total as (select {_KEYS}, count(distinct user_id) as tp_all_user from one group by all),
own as (
  select {_KEYS}, tp, count(distinct o.user_id) as user_count, count(distinct case when s.id is not null then o.user_id end) as scene_user
  from one o left join (select distinct {_POST} from sc) s using ({_POST}) group by {_KEYS}, tp)
select {_KEYS}, tp, scene_user, user_count, tp_all_user from own left join total using ({_KEYS})"""

TP_CATEGORY_METRICS = f"""{_BASE},
one as (select * from tp where kind = 'tp'),
by_cat as (select {_KEYS}, category, tp, count(distinct user_id) as user_count from one join cats using (id) group by all),
by_brand as (select {_KEYS}, category, tp, count(distinct user_id) as brand_all_user from one join codes using (id) group by all),
total as (select {_KEYS}, category, count(distinct user_id) as tp_all_user from one join cats using (id) group by all)
select {_KEYS}, category, tp, user_count, coalesce(brand_all_user, 0) as brand_all_user, tp_all_user
from by_cat left join by_brand using ({_KEYS}, category, tp) left join total using ({_KEYS}, category)"""

_OWN = _with(OWN_LINES, PEOPLE, OWN_PATHS, ALL_RUNS, OWN_JOINED)
_OWN_ONE = _with(OWN_LINES, PEOPLE, OWN_PATHS, ONE_RUN, OWN_JOINED)


def _own_scene(category: bool) -> str:
    cat = ", try_cast(cat as integer) as category" if category else ""
    given = "cat is not null" if category else "true"
    key = f"{_KEYS}{', category' if category else ''}"
    return f"""{_OWN},
own as (
  select {_KEYS}{cat}, scene, count(distinct user_id) as user_count,
         count(distinct case when tp is not null then user_id end) as tp_user
  from joined where scene is not null and {given} group by all),
inside as (
  select {_KEYS}{cat}, scene, count(distinct a.user_id) as inside_track_user,
         count(distinct case when c.kind = 'scene_A' then a.user_id end) as inside_track_A_user,
         count(distinct case when c.kind = 'scene_B' then a.user_id end) as inside_track_B_user
  from a join c using ({_POST}) where {given} group by all),
total as (select {_KEYS}{cat}, count(distinct user_id) as all_scene_user from a where {given} group by all)
select {key}, scene, user_count, tp_user, coalesce(inside_track_user, 0) as inside_track_user,
       coalesce(inside_track_A_user, 0) as inside_track_A_user, coalesce(inside_track_B_user, 0) as inside_track_B_user,
       coalesce(all_scene_user, 0) as all_scene_user
from own left join inside using ({key}, scene) left join total using ({key})"""


_TYPED_ONE = _with(LINES, PATHS, ONE_RUN, TYPED)
_TEXTS = "left join cat_text using (id) left join brand_text using (id)"


def _hit(tag: str, text: str) -> str:
    return f"regexp_matches({text}, '{TAGS[tag]}', 'i')"


def _tag_list(text: str) -> str:
    cases = ", ".join(f"case when {_hit(t, text)} then '{t}' end" for t in TAGS)
    return f"[x for x in [{cases}] if x is not null]"


_MARKS = "[，,。;；!！…]"
TAGGED = f"tagged as (select doc_id as id, text as content, {_tag_list('text')} as tags from documents)"
FLAGGED = "flagged as (select *, len([x for x in tags if contains(x, 'suffix')]) as hits from tagged)"
UNITS = f"""
units as (
  select id, tags from flagged where hits < 2
  union all
  select id, {_tag_list('clause')} as tags from (
    select id, unnest(string_split_regex(regexp_replace(content, '{_MARKS}+$', ''), '{_MARKS}')) as clause from flagged where hits >= 2))"""


def _has(tag: str) -> str:
    return f"list_contains(tags, '{tag}')"


# Each dimension written out by hand.
LABEL_RULES = {
    "promo": f"{_has('offer/call')} or ({_has('tone.praise')} and {_has('suffix-ther')})",
    "contact": f"{_has('pii email')} or {_has('pii phone')}",
    "ther only": f"{_has('suffix-ther')} and not {_has('suffix-ouen')}",
    "wild": f"({_has('legal.license')} and {_has('suffix-ther')}) or {_has('suffix-ouen')}",
    "grouped": f"({_has('tone.praise')} or {_has('tone.worth')}) and not {_has('legal.license')}",
    "tone.worth": _has("tone.worth"),
}


def _labels(source: str) -> str:
    cases = ", ".join(f"case when {rule} then '{name}' end" for name, rule in LABEL_RULES.items())
    return f"select distinct id, attr from (select id, unnest([{cases}]) as attr from {source}) where attr is not null"


def _entries() -> str:
    rows = [("fx1", "tag", t, p) for t, p in TAGS.items()] + [("fx1", "dimension", d, r) for d, r in DIMENSIONS.items()]
    rows += [("fx1", "object", o, None) for o in OBJECTS] + [("fx2", "tag", "only", "the")]
    quoted = [", ".join("null" if v is None else f"'{v}'" for v in row) for row in rows]
    return "values " + ", ".join(f"({row})" for row in quoted)


ORACLES: dict[str, str] = {
    "classify_attrs": f"{_TYPED_ONE} select data_model, id, user_id, platform_id, attr_type, attr, categories, brands from typed {_TEXTS}",
    "special_people_runs": f"{_with(LINES, PATHS, ALL_RUNS, TYPED)} select data_model, id, user_id, platform_id, attr_type, attr from typed",
    "audience": f"""{_with(LINES, PEOPLE, PATHS, ONE_RUN, TYPED)}
select people_type, people_angle, id, user_id, attr, attr_type, platform_id, categories, brands
from typed join people using (user_id, platform_id) {_TEXTS}""",
    "audience_semi": f"""{_with(LINES, PEOPLE)}
select id, user_id, attr, platform_id, cast(len(string_split(attr, '.')) as integer) as attr_len, categories, brands
from (select id, user_id, platform_id, attr from lines) l {_TEXTS}
where (user_id, platform_id) in (select (user_id, platform_id) from people where people_type = 'BUILDING' and people_angle = 'VIP')""",
    "angle_list": f"{_with(PEOPLE)} select distinct people_type as type_code, people_angle as value from people order by 1, 2 desc",
    "scene_touch": f"""{_with(LINES, PEOPLE, PATHS, ONE_RUN, TYPED)},
post as (select * from typed join people using (user_id, platform_id)),
a as (select people_type, people_angle, platform_id, id, user_id, attr as scene from post where attr_type = 'scene'),
b as (select people_type, people_angle, platform_id, id, user_id, attr as tp, attr_type from post where attr_type in ('tp', 'sub_tp'))
select people_type, people_angle, platform_id, id, coalesce(b.user_id, a.user_id) as user_id, scene, tp, attr_type, categories, brands
from a full join b using (people_type, people_angle, platform_id, id) {_TEXTS}""",
    "scene_metrics": _scene(False),
    "scene_category_metrics": _scene(True),
    "scene_brand_metrics": _brand_share("sc join codes using (id)", "scene"),
    "subscene_metrics": _subscene(False),
    "subscene_category_metrics": _subscene(True),
    "scene_tp_metrics": f"""{_BASE}
select {_KEYS}, scene, parent_tp, tp, count(distinct user_id) as user_count from {_PAIR} group by all""",
    "scene_tp_category_metrics": f"""{_BASE},
base as (select * from {_PAIR} join cats using (id)),
own as (select {_KEYS}, scene, parent_tp, tp, category, count(distinct user_id) as user_count from base group by all),
in_scene as (select {_KEYS}, scene, category, count(distinct user_id) as tp_user_count from base group by all),
in_tp as (select {_KEYS}, parent_tp, tp, category, count(distinct user_id) as scene_user_count from base group by all)
select {_KEYS}, scene, parent_tp, tp, category, user_count, tp_user_count, scene_user_count
from own left join in_scene using ({_KEYS}, scene, category) left join in_tp using ({_KEYS}, parent_tp, tp, category)""",
    "scene_tp_brand_metrics": _brand_share(f"(select * from {_PAIR} where kind = 'tp') join codes using (id)", "scene, tp"),
    "tp_metrics": TP_METRICS,
    "tp_brand_metrics": f"""{_BASE}
select {_KEYS}, tp, category, brand, count(distinct user_id) as user_count
from (select * from tp where kind = 'tp') join codes using (id) group by all""",
    "tp_category_metrics": TP_CATEGORY_METRICS,
    "metric_rows": f"""select category, scene, user_count, tp_user, all_scene_user, people_type, people_angle,
  cast('2018-04-14' as date) as daterange, data_model from ({_scene(True)})""",
    "line_scene_metrics": _own_scene(False),
    "line_scene_category_metrics": _own_scene(True),
    "line_scene_tp_category_metrics": f"""{_OWN},
base as (
  select {_KEYS}, scene, try_cast(cat as integer) as category, user_id,
         case when kind = 'sub_tp' then split_part(tp, '.', 2) else 'self' end as parent_tp,
         case when kind = 'sub_tp' then split_part(tp, '.', 3) else tp end as tp
  from joined where scene is not null and tp is not null and cat is not null),
own as (select {_KEYS}, scene, parent_tp, tp, category, count(distinct user_id) as user_count from base group by all),
in_scene as (select {_KEYS}, scene, category, count(distinct user_id) as tp_user_count from base group by all),
in_tp as (select {_KEYS}, parent_tp, tp, category, count(distinct user_id) as scene_user_count from base group by all)
select {_KEYS}, scene, parent_tp, tp, category, user_count, tp_user_count, scene_user_count
from own left join in_scene using ({_KEYS}, scene, category) left join in_tp using ({_KEYS}, parent_tp, tp, category)""",
    "line_tp_metrics": f"""{_OWN},
own as (
  select {_KEYS}, tp, count(distinct user_id) as user_count, count(distinct case when scene is not null then user_id end) as scene_user
  from joined where kind = 'tp' group by {_KEYS}, tp),
total as (select {_KEYS}, count(distinct user_id) as tp_all_user from b where kind = 'tp' group by all)
select {_KEYS}, tp, scene_user, user_count, tp_all_user from own left join total using ({_KEYS})""",
    "line_scene_touch": f"""{_OWN_ONE}
select people_type, people_angle, platform_id, id, user_id, scene, tp, kind as attr_type, cat as categories, brand as brands from joined""",
    "appended_metric": f"""select scene, user_count, people_angle, people_type, data_model, cast('2018-05-14' as date) as daterange
from ({_scene(False)})""",
    "orc_labels": f"""with {TAGGED}, {FLAGGED}, {UNITS}
select id, attr from ({_labels('units')}) join documents on doc_id = id where lang <> 'de'""",
    "tag_posts": f"with {TAGGED} select id, unnest(tags) as tag from tagged",
    "tag_columns": "select doc_id as id, " + ", ".join(f'{_hit(t, "text")} as "{t}"' for t in TAGS) + " from documents",
    "word_lexicon": """
with words as (select distinct unnest(regexp_extract_all(text, '[a-z]{5,12}')) as tag from benchmark),
low as (select doc_id, lower(text) as text from documents),
hits as (
  select tag, doc_id from words join low
    on case when length(tag) < 9 then contains(text, tag)
            else regexp_matches(text, substring(tag, 1, 4) || '[a-z]' || substring(tag, 6)) end)
select tag, count(*) as post_count, min(doc_id) as first_id, max(doc_id) as last_id from hits group by tag""",
    "tag_objects": f"with {TAGGED}, {FLAGGED} select id, 'suffix' as object, len(tags) as tag_count from flagged where hits >= 2",
    "retag_clauses": f"""with {TAGGED}, {FLAGGED}, {UNITS}
select id, tag, count(*) as clause_count from (select id, unnest(tags) as tag from units) group by id, tag""",
    "dimensions": f"with {TAGGED} {_labels('tagged')}",
    "post_labels": f"with {TAGGED}, {FLAGGED}, {UNITS} {_labels('units')}",
    "combined_clauses": f"with {TAGGED}, {FLAGGED}, {UNITS} {_labels('units')}",
    "path_pieces": f"""{_with(LINES)}
select distinct attr, string_split(attr, '.')[2] as second, string_split(attr, '.')[-1] as last from lines""",
    "lexicon_rules": f"""with {TAGGED}, entries as (select * from ({_entries()}) v(name, kind, entry, body)),
hits as (select tag, count(*) as n from (select unnest(tags) as tag from tagged) group by tag)
select name, kind, entry, body, coalesce(n, 0) as post_count
from entries left join hits on name = 'fx1' and kind = 'tag' and entry = tag""",
}

_DATED = "(select cast('2018-04-14' as date) as daterange union all select cast('2018-05-14' as date))"
ORACLES["replaced_metric"] = f"select t.*, d.daterange from ({TP_METRICS}) t cross join {_DATED} d"

# The tables of the job and the queries that give them.
JOB_TABLES = {
    "tpa_scene_data": "scene_metrics",
    "tpa_scene_category_data": "scene_category_metrics",
    "tpa_scene_brand_data": "scene_brand_metrics",
    "tpa_subscene_data": "subscene_metrics",
    "tpa_subscene_category_data": "subscene_category_metrics",
    "tpa_scene_tp_data": "scene_tp_metrics",
    "tpa_scene_tp_category_data": "scene_tp_category_metrics",
    "tpa_scene_tp_brand_data": "scene_tp_brand_metrics",
    "tpa_tp_data": "tp_metrics",
    "tpa_tp_brand_data": "tp_brand_metrics",
    "tpa_tp_category_data": "tp_category_metrics",
}
ORACLES["metrics_job"] = " union all ".join(
    f"select '{table}' as metric, data_model, people_type, count(*) as row_count, cast(sum(user_count) as bigint) as users"
    f" from ({ORACLES[query]}) group by all"
    for table, query in JOB_TABLES.items()
)
