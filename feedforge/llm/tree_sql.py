"""DuckDB SQL of the prefix trie and the Merkle manifest."""

from __future__ import annotations

from .merkle_manifest import FAN, FIELDS
from .prefix_trie import GROUP, SHARED

#: Levels written out in the SQL: up to FAN ** 12 documents a source and FAN ** 8 sources.
SOURCE_LEVELS, TOP_LEVELS = 12, 8


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, as the engine has no such function: polynomial 0xEDB88320, bit by bit."""
    per_bit = "lambda c, i: xor(c >> 1, 3988292384 * (c & 1))"
    per_byte = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {per_bit})"
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({text}, ''), "
            f"lambda x: ascii(x)::bigint)), {per_byte}), 4294967295)")


PREFIX_TRIE_SQL = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) as r
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % {GROUP} as base, {crc32_sql("conv_id::varchar")} % {SHARED} as h
  from turns group by conv_id),
rebuilt as (
  select c.conv_id, list({{'role': t.role, 'text': t.text}} order by t.own, t.r) filter (t.r is not null) as turns
  from convs c left join (
    select conv_id as owner, false as own, r, role, text from turns
    union all select conv_id, true, r, role, text from turns) t
    on (not t.own and t.owner = c.base and t.r <= c.h) or (t.own and t.owner = c.conv_id and t.r > c.h)
  group by c.conv_id),
members as (
  select conv_id, coalesce(len(turns), 0) as length, unnest(range(coalesce(len(turns), 0) + 1)) as depth, turns
  from rebuilt),
prefixes as (
  select conv_id, depth, length, case when depth > 0 then list_slice(turns, 1, depth) else [] end as prefix
  from members),
grouped as (
  select depth, prefix, min(conv_id) as owner, count(*) as n_convs,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (length = depth), '') as ends
  from prefixes group by depth, prefix),
paths as (
  select p.conv_id, p.depth, g.owner, g.n_convs, g.ends,
    case when p.depth > 0 then octet_length(encode(p.prefix[-1].text)) else 0 end as n_bytes
  from prefixes p join grouped g on p.depth = g.depth and p.prefix = g.prefix),
nodes as (
  select n.conv_id, n.depth, up.owner as parent_conv_id, n.n_convs, n.ends, (n.n_convs - 1) * n.n_bytes as saved
  from paths n left join paths up on up.conv_id = n.conv_id and up.depth = n.depth - 1
  where n.owner = n.conv_id),
children as (
  select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from nodes where depth > 0 group by 1, 2),
counted as (select n.*, coalesce(c.n_children, 0) as n_children from nodes n left join children c using (conv_id, depth)),
sums as (
  select a.owner as conv_id, a.depth, sum((n.n_children = 0)::int) as n_leaves, sum(n.saved) as saved_tokens
  from counted n join paths a on a.conv_id = n.conv_id and a.depth <= n.depth
  group by a.owner, a.depth)
select conv_id, depth::bigint as depth, parent_conv_id, n_convs::bigint as n_convs, n_children::bigint as n_children,
  n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, sha256(ends) as ends_sha256
from counted join sums using (conv_id, depth)
"""


def _fields(text: str) -> str:
    return " || ".join(
        f"coalesce(octet_length(encode({c}::varchar)) || ':' || {c}::varchar, '-')"
        for c in [text if f == "text" else f for f in FIELDS])


def _levels(name: str, levels: int) -> str:
    """CTEs from {name}0 (tree, i, h): the nodes and the runs of every level, and the roots."""
    out = []
    for k in range(levels + 1):
        out.append(f"""
{name}_n{k} as materialized (select *, count(*) over (partition by tree) as n from {name}{k}),
{name}_runs{k} as materialized (
  select tree, i // {FAN} as run, list(h order by i) as hs from {name}_n{k} where n > 1 group by tree, i // {FAN}),
{name}{k + 1} as materialized (select tree, run as i, sha256(array_to_string(hs, '')) as h from {name}_runs{k})""")
    roots = " union all ".join(f"select tree, h from {name}_n{k} where n = 1" for k in range(levels + 1))
    return ",".join(out) + f",\n{name}_roots as materialized ({roots})"


def _folded(name: str, levels: int, start: str, table: str, index: str, tree: str) -> str:
    """CTEs that carry (proof, folded) of ``start`` over the levels of one tree."""
    out, before = [], start
    for k in range(levels):
        at = f"({index} // {FAN ** k})"
        hs = [f"array_to_string(list_slice(r.hs, 1, {at} % {FAN}), '')", f"array_to_string(list_slice(r.hs, {at} % {FAN} + 2, {FAN}), '')"]
        out.append(f"""
{name}{k} as materialized (
  select p.* exclude (proof, folded),
    case when r.hs is null then proof else proof || {hs[0]} || {hs[1]} end as proof,
    case when r.hs is null then folded else sha256({hs[0]} || folded || {hs[1]}) end as folded
  from {before} p left join {table}_runs{k} r on r.tree is not distinct from p.{tree} and r.run = {at} // {FAN})""")
        before = f"{name}{k}"
    return ",".join(out)


_CHANGED = "replace(text, chr(10), '')"

MERKLE_SQL = f"""
with leaves as materialized (
  select doc_id, source, sha256({_fields("text")}) as leaf, case when {crc32_sql("doc_id::varchar")} % 2 = 0
    then sha256({_fields(_CHANGED)}) else sha256({_fields("text")}) end as presented
  from documents),
placed as materialized (
  select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from leaves),
s0 as materialized (select source as tree, place as i, leaf as h from placed),{_levels("s", SOURCE_LEVELS)},
subroots as materialized (
  select tree as source, h as subroot, row_number() over (order by tree nulls first) - 1 as source_place from s_roots),
t0 as materialized (select 0 as tree, source_place as i, subroot as h from subroots),{_levels("t", TOP_LEVELS)},
begun as materialized (
  select p.*, subroot, source_place, 0 as all_sources, '' as proof, presented as folded
  from placed p join subroots r on r.source is not distinct from p.source),{_folded("f", SOURCE_LEVELS, "begun", "s", "p.place", "source")},{_folded("g", TOP_LEVELS, f"f{SOURCE_LEVELS - 1}", "t", "p.source_place", "all_sources")}
select doc_id, leaf, subroot, h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = h as verified
from g{TOP_LEVELS - 1}, t_roots
"""
