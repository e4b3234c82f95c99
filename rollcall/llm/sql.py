"""SQL counterparts of numbered queries, and parts that several of them share."""

from __future__ import annotations


def crc32(number: str) -> str:
    """The unsigned CRC-32 of a number's decimal digits."""
    digits = f"list_transform(string_split(({number})::varchar, ''), lambda c: ascii(c)::bigint)"
    byte = "list_reduce(list_prepend(xor(s, c), range(8)), lambda v, i: xor(v >> 1, (v & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {digits}), lambda s, c: {byte}), 4294967295::bigint)"


WORDS = r"'[^\x20\x09-\x0D]+'"


def groups(size: int, percent: int, kept: str = "") -> str:
    """Documents linked by the Jaccard similarity of their sets of shingles, and the least id each one reaches."""
    return f"""
with recursive given as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) as w from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {size} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' ')) end) as s from given),
places as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
links as (
  select x.doc_id as a, y.doc_id as b from places x join places y on x.shingle = y.shingle and x.doc_id <> y.doc_id
  group by x.doc_id, y.doc_id, x.n, y.n having 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
reached(a, b) as (select doc_id, doc_id from documents union select r.a, l.b from reached r join links l on r.b = l.a)
select doc_id, len(s)::bigint as n_shingles, least_id as component_id{kept}
from sets join (select a, min(b) as least_id from reached group by a) on a = doc_id
"""


TRIE = f"""
with own as (
  select conv_id as c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) order by turn nulls first) as turns
  from conversations where conv_id is not null group by conv_id),
headed as (select c, turns, {crc32("c")} % 4 as h from own),
built as (
  select x.c, list_concat(coalesce(y.turns[1:x.h], []), x.turns[x.h + 1:]) as s
  from headed x left join own y on y.c = x.c - x.c % 20),
nodes as (
  select s[1:d] as p, d, min(c) as conv_id, count(*) as n, string_agg(c::varchar, ',' order by c) filter (where len(s) = d) as done
  from (select c, s, unnest(range(len(s) + 1)) as d from built) group by s[1:d], d),
kids as (select p[1:d - 1] as p, count(*) as k from nodes where d > 0 group by 1),
counted as (
  select nodes.*, coalesce(k, 0) as k, case when d = 0 then 0 else len(regexp_extract_all(p[d].t, {WORDS})) end as words
  from nodes left join kids using (p)),
below as (
  select p[1:j] as p, count(*) filter (where k = 0) as leaves, sum((n - 1) * words)::bigint as saved
  from (select *, unnest(range(d + 1)) as j from counted) group by 1)
select x.conv_id, x.d as depth, y.conv_id as parent_conv_id, x.n as n_convs, x.k as n_children, leaves as n_leaves, saved as saved_tokens,
       sha256(coalesce(x.done, '')) as ends_sha256
from counted x join below on below.p = x.p left join nodes y on x.d > 0 and y.p = x.p[1:x.d - 1]
"""

FIELD = "case when {0} is null then '-' else strlen({0}::varchar) || ':' || {0}::varchar end"


def _h(text: str) -> str:
    return "sha256(" + " || ".join(FIELD.format(name) for name in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree(name: str, rows: str) -> str:
    """The levels of trees over rows (tree, i, d, n), and each node's siblings to the left and right."""
    return f"""
{name}(tree, l, i, d, n) as (
  select tree, 0, i, d, n from {rows}
  union all
  select tree, l + 1, i // 3, sha256(string_agg(d, '' order by i)), max((n + 2) // 3) from {name} where n > 1 group by tree, l, i // 3),
{name}_sides as (
  select x.tree, x.l, x.i, coalesce(string_agg(y.d, '' order by y.i) filter (where y.i < x.i), '') as before,
         coalesce(string_agg(y.d, '' order by y.i) filter (where y.i > x.i), '') as after
  from {name} x left join {name} y on y.tree is not distinct from x.tree and y.l = x.l and y.i // 3 = x.i // 3 and y.i <> x.i
  where x.n > 1 group by x.tree, x.l, x.i),
{name}_walk(id, tree, l, i, d, proof) as (
  select id, tree, 0, i, other, '' from {rows}
  union all
  select w.id, w.tree, w.l + 1, w.i // 3, sha256(s.before || w.d || s.after), w.proof || s.before || s.after
  from {name}_walk w join {name}_sides s on s.tree is not distinct from w.tree and s.l = w.l and s.i = w.i)"""


MERKLE = f"""
with recursive given as (
  select doc_id as id, source as tree, {_h("text")} as d, case when {crc32("doc_id")} % 2 = 0 then {_h("replace(text, chr(10), '')")} else {_h("text")} end as other
  from documents),
leaves as (select *, row_number() over (partition by tree order by id nulls first) - 1 as i, count(*) over (partition by tree) as n from given),
{_tree("sources", "leaves")},
subroots as (
  select tree as source, l as height, d as subroot, null as tree, row_number() over (order by tree nulls first) - 1 as i, d, count(*) over () as n, d as other, tree as id
  from sources where n = 1),
{_tree("top", "subroots")},
ended as (
  select w.id, w.d, w.proof, s.subroot, s.i from sources_walk w join subroots s on s.source is not distinct from w.tree and s.height = w.l),
-- the way from a subroot to the root, for what the tampered leaf led to
climbed(id, l, i, d, proof, subroot) as (
  select id, 0, i, d, proof, subroot from ended
  union all
  select c.id, c.l + 1, c.i // 3, sha256(s.before || c.d || s.after), c.proof || s.before || s.after, c.subroot
  from climbed c join top_sides s on s.l = c.l and s.i = c.i),
summit as (select l, d as root from top where n = 1)
select c.id as doc_id, v.d as leaf, c.subroot, root, sha256(c.proof) as proof_sha256, c.d as folded_root, c.d = root as verified
from climbed c join summit on c.l = summit.l join leaves v on v.id = c.id
"""
