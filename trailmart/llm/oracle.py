"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

SQL: dict[str, str] = {}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL["op6_exact_dedup"] = f"""
with d as (select doc_id, sha256({LOWERED}) as text_sha256 from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = max(doc_id) over g as kept, text_sha256
from d window g as (partition by text_sha256)
"""

SQL["op7_sharding"] = """
with d as (
  select doc_id, coalesce(strlen(text), 0) as bytes,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint as hashed
  from documents
), levels as (
  select unnest(range(0, 61)) as depth
), prefixes as (
  select depth, hashed >> (60 - depth) as prefix, sum(bytes) as total
  from d, levels group by all having sum(bytes) <= 16777216
), placed as (
  select doc_id, bytes, hashed, min(depth) as depth
  from d join prefixes on hashed >> (60 - depth) = prefix group by all
)
select doc_id, bytes, cast(depth as integer) as depth,
       depth || '-' || substr(lpad(bin(hashed), 60, '0'), 1, depth) || '-0' as shard
from placed
"""

CONTROL = ("<|turn|>", "<|end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>")


def _escaped(column: str, more: tuple[str, ...] = ()) -> str:
    sql = f"replace({column}, '\\', '\\e;')"
    for number, control in enumerate((*CONTROL, *more)):
        sql = f"replace({sql}, '{control}', '\\{number};')"
    return sql


SQL["op9_chat_format"] = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length({_escaped('text')}) + length({_escaped('role', (chr(10),))})
           + length('<|turn|>') + 1 + length('<|end|>') + 1)::bigint as formatted_chars
from t group by conv_id
"""

SQL["op10_warc"] = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), r as (select *, payload_bytes >= 1000 and page_id <> max(page_id) over g as again, max(page_id) over g as first_page
  from p window g as (partition by payload_digest))
select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
       case when again then first_page end as refers_to
from r
"""

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
TERMS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

# Sets that reach 85 per cent share one of their rarest shingles, as many as may be missing and one more.
SQL["op11_minhash"] = f"""
with recursive d as (
  select row_number() over () as r, doc_id, {WORDS.format(text=LOWERED)} as w from documents
), words as (
  select r, unnest(w) as x, generate_subscripts(w, 1) as i from d where len(w) >= 5
), shingles as (
  select distinct r, x || ' ' || lead(x, 1) over o || ' ' || lead(x, 2) over o || ' ' || lead(x, 3) over o || ' '
    || lead(x, 4) over o as x from words window o as (partition by r order by i)
), long as (
  select r, list(x order by x) as s from shingles where x is not null group by r
), s as (
  select doc_id, coalesce(s, case when len(w) = 0 then [] else [array_to_string(w, ' ')] end) as s
  from d left join long using (r)
), named as (
  select doc_id, s, len(s) as n, sha256(array_to_string(s, chr(10))) as name from s
), classes as (
  select row_number() over () as c, * from (
    select name, any_value(s) as s, any_value(n) as n, min(doc_id) as first_id from named where n > 0 group by name)
), listed as (
  select c, n, unnest(s) as x from classes
), frequent as (
  select x, count(*) as f from listed group by x
), prefixes as (
  select c, x from listed join frequent using (x)
  qualify row_number() over (partition by c order by f, x) <= n - (85 * n + 99) // 100 + 1
), candidates as (
  select distinct p.c as a, q.c as b from prefixes p join prefixes q on p.x = q.x and p.c < q.c
), common as (
  select a, b, len(list_intersect(x.s, y.s)) as k, x.n + y.n as total
  from candidates join classes x on x.c = a join classes y on y.c = b
), links as (
  select a, b from common where 100 * k >= 85 * (total - k) union all
  select b, a from common where 100 * k >= 85 * (total - k)
), reached(c, k) as (
  select c, c from classes union select r.c, l.b from reached r join links l on r.k = l.a
), components as (
  select r.c, min(k.first_id) as component_id from reached r join classes k on k.c = r.k group by r.c
)
select doc_id, d.n::bigint as n_shingles, coalesce(component_id, doc_id) as component_id,
       doc_id = coalesce(component_id, doc_id) as kept
from named d left join classes using (name) left join components using (c)
"""

SQL["op12_lexical"] = f"""
with d as (
  select row_number() over () as r, doc_id, {TERMS.format(text=LOWERED)} as t from documents
), counted as (
  select r, doc_id, t, len(t)::bigint as n from d where len(t) > 0
), totals as (
  select count(*)::bigint as docs, sum(n)::bigint as words from counted
), q as (
  select q, item_id, unnest(t) as term
  from (select row_number() over () as q, item_id, list_distinct({TERMS.format(text=LOWERED)}) as t from benchmark)
), held as (
  select r, term, count(*)::bigint as tf from (select r, unnest(t) as term from counted)
  where term in (select term from q) group by all
), weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)))::bigint as w
  from held, totals group by term
), scores as (
  select q, item_id, doc_id, r,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))))::bigint as score
  from q join weights using (term) join held using (term) join counted using (r), totals group by all
)
select item_id, row_number() over (partition by q order by score desc, doc_id)::integer as rank, doc_id, score
from scores where score > 0
qualify row_number() over (partition by q order by score desc, doc_id) <= 10
"""
