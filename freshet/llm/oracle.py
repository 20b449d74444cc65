"""DuckDB SQL with the results of those queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {}


def _words(table: str) -> str:
    upper = "".join(map(chr, range(65, 91)))
    return rf"regexp_extract_all(translate(coalesce({table}.text, ''), '{upper}', '{upper.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLE_SQL["op3_decontaminate"] = f"""
with d as (select row_number() over () as r, doc_id, {_words("documents")} as w from documents),
b as (select item_id, {_words("benchmark")} as w from benchmark),
grams as (
  select distinct item_id, least(10, len(w)) as k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as g
  from b, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(i) where len(w) > 0),
sizes as (select distinct k from grams),
places as (
  select r, k, i, array_to_string(w[i : i + k - 1], ' ') as g from d, sizes, unnest(range(1, len(w) - k + 2)) as t(i)),
met as (select p.r, p.k, p.i, g.item_id from places p join grams g on p.k = g.k and p.g = g.g),
hit as (select r, count(distinct i + j) as n_hit from met, unnest(range(0, k)) as t(j) group by r),
items as (
  select r, count(*) as n_items, string_agg(item, ',' order by item) as joined
  from (select distinct r, cast(item_id as varchar) as item from met where item_id is not null) group by r)
select d.doc_id, len(d.w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(joined, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join items using (r)"""

ORACLE_SQL["op8_maxscore"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: coalesce(not isfinite(x), true))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 5"""


def _group(n: int) -> str:
    """The n-th eight hex digits of the digest, as a number."""
    digits = "0123456789abcdef"
    return " + ".join(f"(strpos('{digits}', substr(hex, {8 * n + i + 1}, 1)) - 1) * {16 ** (7 - i)}::bigint" for i in range(8))


ORACLE_SQL["op12_fill_middle"] = f"""
with d as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as hex from documents),
h as (select *, {_group(0)} as h1, {_group(1)} as h2, {_group(2)} as h3, {_group(3)} as h4 from d),
c as (
  select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form from h),
p as (select *, substr(t, 1, a) as pre, substr(t, a + 1, b - a) as mid, substr(t, b + 1) as suf from c)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
              else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
       sha256(t) as restored_sha256
from p"""


def _clustering(k: int = 8, width: int = 64, rounds: int = 10) -> str:
    """One pair of assignment and new centroids per round."""
    nearest = """(
  select r, arg_min(c, (distance, c)) as c, min(distance) as distance from (
    select v.r, c.c, list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance
    from v, c{n} c) group by r)"""
    parts = [
        f"""v as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
  from embeddings where len(embedding) = {width} and len(list_filter(embedding, lambda x: coalesce(not isfinite(x), true))) = 0)""",
        f"""c0 as materialized (
  select row_number() over (order by h, v) - 1 as c, v from (
    select sha256('3:' || coalesce(cast(vec_id as varchar), '')) as h, v from v order by h, v limit {k}))""",
    ]
    for n in range(rounds):
        means = "list(cast(floor(total / many) as bigint) order by i)"
        parts.append(f"a{n} as materialized {nearest.format(n=n)}")
        parts.append(f"""c{n + 1} as materialized (
  select c.c, coalesce(m.v, c.v) as v from c{n} c left join (
    select c, {means} as v from (
      select a.c, i, sum(v.v[i])::hugeint as total, count(*) as many
      from a{n} a join v using (r), range(1, {width + 1}) t(i) group by a.c, i) group by c) m using (c))""")
    parts.append(f"last as materialized {nearest.format(n=rounds)}")
    return f"""
with {", ".join(parts)}
select v.vec_id, cast(l.c as integer) as "cluster", l.distance,
       cast(sum(l.distance) over (partition by l.c) as bigint) as cluster_inertia, cast(sum(l.distance) over () as bigint) as inertia,
       sha256(array_to_string(c.v, ',')) as centroid_sha256
from last l join v using (r) join c{rounds} c on c.c = l.c"""


ORACLE_SQL["op13_centroid_tree"] = _clustering()
