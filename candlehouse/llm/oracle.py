"""SQL counterparts (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from candlehouse.llm import sharding
from candlehouse.llm.queries import RULES, SHARDS
from candlehouse.llm.url_filter import UPPER


def _feistel(seed: int = 20, walks: int = 4) -> str:
    """The rounds as nested selects; ``walks`` cycle-walking steps, more than any row of the test tables needs."""
    m = sharding.M31
    sql = "select *, number as p from numbered, shape"
    for _ in range(walks):
        sql = f"select * exclude (p), p as p0, p % a as l, p // a as r from ({sql})"
        for i, key in enumerate(sharding.round_keys(seed)):
            x, to, side = ("l", "r", "b") if i % 2 else ("r", "l", "a")
            sql = f"select *, ({x} + {key}) % {m} * 48271 % {m} as u from ({sql})"
            sql = (f"select * exclude (u, {to}), ({to} + ((u * u + {key}) % {m} * 69621 + u) % {m}) % {side} as {to} "
                   f"from ({sql})")
        sql = f"select * exclude (l, r, p0), case when walked and p0 < n then p0 else r * a + l end as p, true as w from ({sql})"
        sql = f"select * exclude (w, walked), w as walked from ({sql})"
    return sql


CRC = """with table_ as (
  select list(c order by i) as t from (
    select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c
    from (select unnest(range(256)) as i)))
"""

SHARDING = CRC + f"""
, docs as (
  select doc_id, coalesce(strlen(text), 0) + 16 as size, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::bigint),
    lambda c, b: xor(c >> 8, t[xor(c, b) % 256 + 1]), 4294967295::bigint)) as text_crc32
  from documents, table_)
, bucketed as (select *, (((coalesce(doc_id, -1) % {sharding.M31} + {sharding.M31}) % {sharding.M31}) * 48271 + 12345) % {sharding.M31} * 69621
  % {sharding.M31} % {sharding.BUCKETS} as bucket from docs)
, numbered as (
  select *, row_number() over (order by bucket, doc_id nulls first, size, text_crc32) - 1 as number, false as walked from bucketed)
, shape as (select n, a, (n + a - 1) // a as b from (select n, ceil(sqrt(n))::bigint as a from (select count(*) as n from documents)))
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'rows' as law, (p % {SHARDS})::int as shard, p // {SHARDS} as slot,
  null::int as grown_shard from ({_feistel()})"""

TOP_K = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::hugeint) as v from embeddings
  where vec_id is not null and embedding is not null and len(embedding) > 0
    and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))))
, scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from vectors q join vectors c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
, ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20"""

NEAR_DUPLICATES = r"""
with recursive word_lists as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents)
, sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')] else
    list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from word_lists)
, posted as (select doc_id, len(s) as n, unnest(s) as x from sets)
, linked as (
  select a.doc_id as a, b.doc_id as b from posted a join posted b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*)))
, reach(doc_id, other) as (
  select doc_id, doc_id from documents union select r.doc_id, l.b from reach r join linked l on l.a = r.other)
, least_ as (select doc_id, min(other) as component_id from reach group by doc_id)
select s.doc_id, len(s.s) as n_shingles, component_id, s.doc_id = component_id as kept from sets s join least_ using (doc_id)"""

_RULES = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in RULES)

URL_FILTER = f"""
with parts as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages)
, split as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts)
, rules(verdict, rule_host, rule_path) as (values {_RULES})
, fits as (
  select s.page_id, s.host, s.path, r.verdict, rule_host || rule_path as rule,
    row_number() over (partition by s.page_id, s.host, s.path order by length(rule_host || rule_path) desc nulls last, length(rule_host) desc, r.verdict desc) as best
  from split s left join rules r on (s.host = rule_host or s.host like '%.' || rule_host) and starts_with(s.path, rule_path))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where best = 1"""


def _terms(text: str) -> str:
    lower = f"translate({text}, '{UPPER}', '{UPPER.lower()}')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


LEXICAL = f"""
with words as (select row_number() over () as place, doc_id, {_terms("coalesce(text, '')")} as w from documents)
, totals as (select count(*) filter (where len(w) > 0) as docs, sum(len(w))::bigint as length from words)
, counted as (
  select place, doc_id, n, term, count(*) as tf from (select place, doc_id, len(w) as n, unnest(w) as term from words) group by all)
, frequency as (select term, count(*) as df from counted group by term)
, asked as (select distinct item_id, unnest({_terms("text")}) as term from benchmark where item_id is not null)
, weighed as (
  select item_id, term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)))::bigint as weight from asked join frequency using (term), totals)
, scored as (
  select item_id, place, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::bigint as score
  from weighed join counted using (term), totals group by item_id, place, doc_id)
, ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank from scored where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 50"""

TRIE = CRC + """
, own as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as t
  from conversations where conv_id is not null group by conv_id)
, heads as (
  select conv_id, t, xor(4294967295, list_reduce(
    list_transform(regexp_extract_all(hex(encode(conv_id::varchar)), '..'), lambda h: ('0x' || h)::bigint),
    lambda c, b: xor(c >> 8, crc[xor(c, b) % 256 + 1]), 4294967295::bigint)) % 6 as h
  from own, (select t as crc from table_))
, rebuilt as (
  select c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) as t from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 100)
, prefixes as (select conv_id, len(t) as n, d as depth, t[1:d] as p from (select *, unnest(range(len(t) + 1)) as d from rebuilt))
, nodes as (
  select min(conv_id) as conv_id, depth, p, count(*) as n_convs, case when depth > 0 then (count(*) - 1) * length(p[depth].text) else 0 end as saved,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where n = depth), '')) as ends_sha256
  from prefixes group by depth, p)
, named as (select x.conv_id as member, x.depth, n.conv_id from prefixes x join nodes n on n.depth = x.depth and n.p = x.p)
, parents as (
  select n.*, u.conv_id as parent_conv_id from nodes n left join named u on u.member = n.conv_id and u.depth = n.depth - 1)
, children as (select parent_conv_id as conv_id, depth - 1 as depth, count(*) as n_children from parents where depth > 0 group by all)
, sums as (
  select a.conv_id, a.depth, count(*) filter (where c.n_children is null) as n_leaves, sum(n.saved) as saved_tokens
  from parents n left join children c using (conv_id, depth) join named a on a.member = n.conv_id and a.depth <= n.depth group by all)
select conv_id, depth, parent_conv_id, n_convs, coalesce(n_children, 0)::bigint as n_children, n_leaves, saved_tokens::bigint as saved_tokens, ends_sha256
from parents left join children using (conv_id, depth) join sums using (conv_id, depth)"""

ORACLE = {
    "op1_feistel_sharding": SHARDING,
    "op3_norm_sorted_topk": TOP_K,
    "op7_bottom_k_neardup": NEAR_DUPLICATES,
    "op9_url_filter": URL_FILTER,
    "op11_accumulator_search": LEXICAL,
    "op13_conversation_trie": TRIE,
}
