"""DuckDB SQL of the queries that SQL can express, over the same tables."""

from __future__ import annotations

#: Checksum of a decimal id: 9 steps of a byte, one that takes it in and eight that shift.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(
    string_split(conv_id::varchar, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, 3988292384 * (a & 1)) end), 4294967295)"""

OP6 = r"""with recursive docs as (
  select row_number() over () as uid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
sets as (
  select uid, doc_id, list_distinct(case
    when len(w) >= 3 then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
    when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s
  from docs),
elements as (select uid, len(s) as n, unnest(s) as shingle from sets),
links as (
  select a.uid as a, b.uid as b from elements a join elements b using (shingle) where a.uid <> b.uid
  group by a.uid, b.uid, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached as (
  select uid, uid as other from docs union
  select reached.uid, links.b from reached join links on links.a = reached.other),
least as (select reached.uid, min(docs.doc_id) as component_id from reached join docs on docs.uid = other group by 1)
select doc_id, len(s)::bigint as n_shingles, component_id, doc_id is not distinct from component_id as kept
from sets join least using (uid)"""

OP12 = rf"""with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as txt,
    row_number() over (partition by conv_id order by turn nulls first) as pos
  from conversations where conv_id is not null),
heads as (select conv_id, conv_id - conv_id % 20 as head, {_CRC32} % 4 as h from (select distinct conv_id from turns)),
joined as (
  select heads.conv_id, 0 as part, pos, role, txt from heads join turns on turns.conv_id = head where pos <= h
  union all
  select turns.conv_id, 1, pos, role, txt from heads join turns using (conv_id) where pos > h),
whole as (
  select heads.conv_id, coalesce(list({{'r': role, 't': txt}} order by part, pos) filter (where pos is not null), []) as path
  from heads left join joined using (conv_id) group by heads.conv_id),
members as (
  select conv_id, d, path[1:d] as node, len(path) = d as ends
  from (select *, unnest(range(len(path) + 1)) as d from whole)),
nodes as (
  select node, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256,
    (count(*) - 1) * case when d = 0 then 0
      else len(regexp_extract_all(node[d].t, '[^\x20\x09-\x0D]+')) end as saved
  from members group by node, d),
inner_nodes as (select distinct node[1:depth - 1] as node from nodes where depth > 0),
above as (
  select unnest(range(depth + 1)) as k, node, saved, node not in (select node from inner_nodes) as leaf from nodes),
below as (select node[1:k] as node, sum(saved) as saved_tokens, count_if(leaf) as n_leaves from above group by node[1:k])
select nodes.conv_id as conv_id, nodes.depth as depth, parents.conv_id as parent_conv_id, nodes.n_convs as n_convs,
  coalesce(children.n, 0) as n_children, below.n_leaves::bigint as n_leaves,
  below.saved_tokens::bigint as saved_tokens, nodes.ends_sha256 as ends_sha256
from nodes join below on nodes.node = below.node
left join nodes parents on nodes.depth > 0 and parents.node = nodes.node[1:nodes.depth - 1]
left join (select node[1:depth - 1] as node, count(*) as n from nodes where depth > 0 group by 1) children
  on children.node = nodes.node"""


def _op13(rounds: int = 5, clusters: int = 40) -> str:
    steps = [f"""with kept as (
  select row_number() over () as row_id, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
parts as (select row_id, unnest(v) as x, generate_subscripts(v, 1) as k from kept),
ranked as (select v, row_number() over (order by sha256('2:' || vec_id), v) - 1 as c from kept),
c0 as (select c, unnest(v) as x, generate_subscripts(v, 1) as k from ranked where c < {clusters})"""]
    for n in range(rounds + 1):
        steps.append(f"""a{n} as materialized (
  select row_id, arg_min(c, (d, c)) as c, min(d) as d from (
    select row_id, c, sum((parts.x - c{n}.x) * (parts.x - c{n}.x))::bigint as d
    from parts join c{n} on parts.k = c{n}.k group by row_id, c) group by row_id)""")
        if n < rounds:
            steps.append(f"""m{n} as (
  select c, k, sum(x)::bigint as total, count(*) as n from parts join a{n} using (row_id) group by c, k),
c{n + 1} as materialized (
  select c{n}.c as c, c{n}.k as k, case when m{n}.n is null then c{n}.x
    else m{n}.total // m{n}.n - case when m{n}.total % m{n}.n < 0 then 1 else 0 end end as x
  from c{n} left join m{n} using (c, k))""")
    last = f"a{rounds}"
    steps.append(f"""named as (
  select c, sha256(string_agg(x::varchar, ',' order by k)) as centroid_sha256 from c{rounds} group by c),
sums as (select c, sum(d)::bigint as cluster_inertia from {last} group by c)
select vec_id, {last}.c::integer as cluster, d as distance, cluster_inertia,
  (select sum(d)::bigint from {last}) as inertia, centroid_sha256
from {last} join kept using (row_id) join named on named.c = {last}.c join sums on sums.c = {last}.c""")
    return ",\n".join(steps)


OP13 = _op13()


def oracle_sql() -> dict[str, str]:
    return {"op6_near_dups": OP6, "op12_prefix_trie": OP12, "op13_centroids": OP13}
