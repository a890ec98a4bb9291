"""DuckDB SQL twins of the corpus queries that SQL can express, over the whole ``documents`` table.

The others are tested against plain versions in ``tests/llm``: no SQL engine has
the tokenizers, the fingerprints' and rules' own verdicts, the trained classifier,
the fuzzy matcher or byte strings at every offset of a text.
"""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
with d0 as (
  select doc_id, coalesce(text, '') as text, source, len({WORDS}) as size from documents),
d1 as (
  select *, length(text) - length(translate(text, '#*$%&|<>', '')) as symbols,
         (cast('0x' || substr(md5('0:' || coalesce(cast(doc_id as varchar), 'null')), 1, 13) as bigint) + 0.5)
           / cast(4503599627370496 as double) as u,
         coalesce(cast(doc_id as varchar), 'null') || ':' || md5(text) as tie
  from d0),
d as (
  select *, -ln(u) / ((cast(1 as double) + size) / (cast(1 as double) + size + cast(2 as double) * least(symbols, size))) as key from d1),
src as (
  select source, sum(size) as source_size,
         cast(1 + (row_number() over (order by source is null, source) - 1) % 3 as double) as w
  from d group by source),
cap as (
  select *, 3 * cast(source_size as double) as cap from src),
run as (
  select *, coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0) as caps,
         sum(w) over (o rows between current row and unbounded following) as rest,
         sum(cast(source_size as double)) over () as total
  from cap window o as (order by cap / w, source is null, source)),
lev as (
  select *, max(case when (total - caps) / rest * w <= cap then (total - caps) / rest end) over () as level from run),
tgt as (
  select source, source_size, least(cap, coalesce(level * w, cap)) as target from lev),
plan as (
  select *, case when source_size > 0 then least(cast(floor(target / source_size) as bigint), 3) else 0 end as epochs from tgt),
left_over as (
  select *, cast(round(target - epochs * source_size) as bigint) as remaining from plan),
ties as (
  select source, key, tie, sum(size) as words, count(*) as n from d group by source, key, tie),
upto as (
  select *, coalesce(sum(words) over (partition by source order by key, tie rows between unbounded preceding and 1 preceding), 0) as reached
  from ties)
select d.doc_id, cast(d.size as bigint) as size, cast(p.source_size as bigint) as source_size, p.target,
       cast(p.epochs * d.size + case when u.reached >= p.remaining then 0
                                     when u.reached + u.words < p.remaining then d.size
                                     else cast(floor((p.remaining - u.reached) / cast(u.n as double)) as bigint) end as bigint) as taken,
       d.source, cast(p.epochs as bigint) as epochs
from d join left_over p on p.source is not distinct from d.source
       join upto u on u.source is not distinct from d.source and u.key = d.key and u.tie = d.tie"""

JACCARD = rf"""
with recursive w as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as words
  from documents),
s as (
  select r, doc_id, case when len(words) = 0 then []
                         when len(words) < 5 then [array_to_string(words, ' ')]
                         else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) end as grams
  from w),
g as (select r, len(grams) as n, unnest(grams) as gram from s),
pairs as (
  select a.r as a, b.r as b, count(*) as shared, any_value(a.n) as na, any_value(b.n) as nb
  from g a join g b on a.gram = b.gram and a.r < b.r
  group by a.r, b.r),
link as (
  select a, b from pairs where 100 * shared >= 80 * (na + nb - shared)
  union all
  select b, a from pairs where 100 * shared >= 80 * (na + nb - shared)),
reach as (
  select r, r as other from s
  union
  select reach.r, link.b from reach join link on link.a = reach.other)
select s.doc_id, cast(len(s.grams) as bigint) as n_shingles, min(o.doc_id) as component_id
from s join reach on reach.r = s.r join s o on o.r = reach.other
group by s.r, s.doc_id, len(s.grams)"""


def crc32(value: str) -> str:
    """Unsigned CRC-32 (of zlib) of a short ASCII string expression: eight shifts a character, by the fixed polynomial."""
    chars = f"list_transform(range(1, len({value}) + 1), lambda i: cast(ascii(substr({value}, i, 1)) as bigint))"
    shift = "list_reduce(list_concat([xor(acc, x)], cast(range(8) as bigint[])), lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    return f"xor(list_reduce(list_concat([cast(4294967295 as bigint)], {chars}), lambda acc, x: {shift}), cast(4294967295 as bigint))"


def manifest(levels: int = 7, group_levels: int = 3) -> str:
    """The Merkle manifest for up to 8^levels rows a group and 8^group_levels groups."""
    def digested(text: str) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen(cast({c} as varchar)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, nodes: str, deep: int) -> list[str]:
        out, below = [], nodes
        for k in range(deep):
            out.append(f"""{name}{k} as (
  select grp, idx // 8 as idx, (any_value(n) + 7) // 8 as n, list(hash order by idx) as kids, sha256(string_agg(hash, '' order by idx)) as hash
  from {below} where n > 1 group by grp, idx // 8)""")
            below = f"{name}{k}"
        return out

    def tops(name: str, nodes: str, deep: int) -> str:
        return " union all ".join(f"select grp, hash from {t} where n = 1" for t in [nodes, *(f"{name}{k}" for k in range(deep))])

    def climb(start: str, name: str, deep: int, to: str) -> list[str]:
        """Each row of ``start`` (grp, idx, place, proof, folded) up a tree."""
        out, below = [], start
        for k in range(deep):
            left, right = "coalesce(array_to_string(p.kids[1:b.place % 8], ''), '')", "coalesce(array_to_string(p.kids[b.place % 8 + 2:], ''), '')"
            here = to if k == deep - 1 else f"{to}{k}"
            out.append(f"""{here} as (
  select b.* exclude (place, proof, folded), b.place // 8 as place, case when p.kids is null then b.proof else b.proof || {left} || {right} end as proof,
         case when p.kids is null then b.folded else sha256({left} || b.folded || {right}) end as folded
  from {below} b left join {name}{k} p on p.grp is not distinct from b.grp and p.idx = b.place // 8)""")
            below = here
        return out

    parts = [f"""d as (
  select *, {crc32("cast(doc_id as varchar)")} % 3 = 0 as hit from documents),
l as (
  select doc_id, lang as grp, {digested("text")} as hash,
         {digested(f"case when hit then translate(text, '{UPPER}', '{LOWER}') else text end")} as offered from d),
n0 as (
  select *, row_number() over (partition by grp order by doc_id nulls first, hash) - 1 as idx, count(*) over (partition by grp) as n from l)""",
             *tree("p", "n0", levels),
             f"tops as ({tops('p', 'n0', levels)})",
             """g0 as (
  select grp as name, 0 as grp, row_number() over (order by grp nulls first) - 1 as idx, count(*) over () as n, hash from tops)""",
             *tree("q", "g0", group_levels),
             f"root as ({tops('q', 'g0', group_levels)})",
             "sx as (select doc_id, grp, hash as leaf, idx as place, '' as proof, offered as folded from n0)",
             *climb("sx", "p", levels, "s"),
             """tx as (
  select s.doc_id, s.leaf, g.hash as subroot, g.grp, g.idx as place, s.proof, s.folded from s join g0 g on g.name is not distinct from s.grp)""",
             *climb("tx", "q", group_levels, "t")]
    return "with " + ",\n".join(parts) + """
select t.doc_id, t.leaf, t.subroot, r.hash as root, sha256(t.proof) as proof_sha256, t.folded as folded_root, t.folded = r.hash as verified
from t, root r"""


#: A node's key is the text of its turns' digests; every ancestor's sum is taken over the prefixes of that text.
TRIE = rf"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as pos,
         md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as turn, strlen(coalesce(text, '')) as bytes
  from conversations where conv_id is not null),
c as (
  select conv_id, count(*) as n, {crc32("cast(conv_id as varchar)")} % 9 as h, conv_id - ((conv_id % 5) + 5) % 5 as head from t group by conv_id),
k as (
  select c.*, least(c.h, coalesce(b.n, 0)) as taken from c left join c b on b.conv_id = c.head),
r as (
  select k.conv_id, t.pos, t.turn, t.bytes from k join t on t.conv_id = k.head and t.pos < k.h
  union all
  select k.conv_id, t.pos - k.h + k.taken, t.turn, t.bytes from k join t on t.conv_id = k.conv_id and t.pos >= k.h),
path as (
  select conv_id, pos + 1 as depth, bytes, string_agg(turn, '') over (partition by conv_id order by pos rows unbounded preceding) as key,
         coalesce(string_agg(turn, '') over (partition by conv_id order by pos rows between unbounded preceding and 1 preceding), '') as up,
         pos + 1 = count(*) over (partition by conv_id) as last
  from r
  union all
  select conv_id, 0, 0, '', null, not exists (select 1 from r where r.conv_id = k.conv_id) from k),
node as (
  select key, any_value(up) as up, any_value(depth) as depth, any_value(bytes) as bytes, min(conv_id) as conv_id, count(*) as n_convs,
         coalesce(string_agg(case when last then cast(conv_id as varchar) end, ',' order by conv_id), '') as ends
  from path group by key),
kids as (select up as key, count(*) as n_children from node where up is not null group by up),
full_ as (select node.*, coalesce(n_children, 0) as n_children, (n_convs - 1) * bytes as own from node left join kids using (key)),
sums as (
  select key, cast(sum(leaf) as bigint) as n_leaves, cast(sum(own) as bigint) as saved_tokens
  from (select unnest(list_transform(range(0, depth + 1), lambda d: left(key, 32 * d))) as key, cast(n_children = 0 as int) as leaf, own from full_)
  group by key)
select f.conv_id, cast(f.depth as bigint) as depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, sha256(f.ends) as ends_sha256
from full_ f join sums s using (key) left join full_ p on p.key = f.up"""

ORACLE = {"op3_weighted_mixing": MIXING, "op6_ngram_jaccard_join": JACCARD, "op11_merkle_manifest": manifest(), "op13_conversation_trie": TRIE}
