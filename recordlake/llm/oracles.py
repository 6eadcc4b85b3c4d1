"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

# \x20 and \x09-\x0D are the blanks; what is between them are the words
WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') as w
  from documents),
windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(generate_series(1, len(w) - 2)) as i from docs)),
again as (
  select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (
  select r, count(distinct p) as n
  from (select r, unnest([i, i + 1, i + 2]) as p from again) group by r),
lines as (
  select r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as l
  from docs),
figures as (
  select doc_id, text, w, len(l) as n_lines, len(w) as n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols,
         len(l) - len(list_distinct(l)) as n_dup_lines,
         coalesce(n, 0) as n_repeat_words,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) as upper_letters,
         length(regexp_replace(text, '[^a-z]', '', 'g')) as lower_letters,
         length(regexp_replace(text, '[^!]', '', 'g')) as bangs,
         len(list_filter(w, lambda x: regexp_full_match(x, '[\x00-\x40\x5B-\x60\x7B-\x7F]+'))) as plain
  from docs join lines using (r) left join covered using (r)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from figures)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 10 * n_symbols <= 2 * n_words
       and word_chars between 2 * n_words and 15 * n_words
       and 2 * bangs <= n_words and 10 * upper_letters <= 6 * (upper_letters + lower_letters)
       and 10 * n_dup_lines <= 7 * n_lines and 10 * plain <= 6 * n_words as kept
from judged
"""

# what SQL can tell of the archives: the pages they hold, not how they are written
ARCHIVES = """
with payloads as (
  select page_id, url, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes
  from pages),
marked as (
  select *, sha256(html) as payload_digest,
         min(page_id) over (partition by sha256(html)) as first_id from payloads)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end
         as record_type,
       case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from marked
"""

def _hashed(columns: list[str]) -> str:
    """sha256 of the columns, each `-` if null, else its UTF-8 length, `:` and itself."""
    parts = [f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')" for c in columns]
    return f"sha256({' || '.join(parts)})"


# CRC-32, bit by bit: its reversed polynomial is 0xEDB88320
CRC = """
xor(list_reduce(
  list_prepend(4294967295::bigint, list_transform(string_split({0}, ''), lambda c: ord(c)::bigint)),
  lambda sum, code: list_reduce(
    list_prepend(xor(sum, code), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, step: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)),
  4294967295::bigint)
"""

MANIFEST = f"""
with recursive
docs as (
  select row_number() over () as r, *, coalesce('=' || source, '') as grp,
         {_hashed(["doc_id", "source", "lang", "n_chars", "text"])} as leaf,
         {_hashed(["doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')"])} as other,
         {CRC.format("doc_id::varchar")} as crc
  from documents),
leaves as (
  select *, case when crc % 2 = 0 then other else leaf end as given,
         row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as pos,
         count(*) over (partition by grp) as size
  from docs),
nodes(grp, l, i, n, d) as (
  select grp, 0, pos, size, leaf from leaves
  union all
  select grp, l + 1, i // 3, (n + 2) // 3, sha256(string_agg(d, '' order by i))
  from nodes where n > 1 group by grp, l, i // 3, n),
subroots as (
  select grp, d, row_number() over (order by grp) - 1 as pos, count(*) over () as size
  from nodes where n = 1),
upper(l, i, n, d) as (
  select 0, pos, size, d from subroots
  union all
  select l + 1, i // 3, (n + 2) // 3, sha256(string_agg(d, '' order by i))
  from upper where n > 1 group by l, i // 3, n),
siblings as (
  select r, 0 as tier, n.l, n.i, n.d
  from leaves join nodes n on n.grp = leaves.grp and n.n > 1
   and n.i // 3 = leaves.pos // (3 ** (n.l + 1))::bigint and n.i <> leaves.pos // (3 ** n.l)::bigint
  union all
  select r, 1, u.l, u.i, u.d
  from leaves join subroots s on s.grp = leaves.grp
  join upper u on u.n > 1
   and u.i // 3 = s.pos // (3 ** (u.l + 1))::bigint and u.i <> s.pos // (3 ** u.l)::bigint),
proofs as (
  select r, string_agg(d, '' order by tier, l, i) as proof from siblings group by r),
folds(r, grp, l, i, d) as (
  select r, grp, 0, pos, given from leaves
  union all
  select f.r, f.grp, f.l + 1, f.i // 3,
         sha256(string_agg(case when n.i = f.i then f.d else n.d end, '' order by n.i))
  from folds f join nodes n on n.grp = f.grp and n.l = f.l and n.n > 1 and n.i // 3 = f.i // 3
  group by f.r, f.grp, f.l, f.i),
below as (select r, grp, arg_max(d, l) as d from folds group by r, grp),
climbs(r, l, i, d) as (
  select r, 0, pos, below.d from below join subroots using (grp)
  union all
  select f.r, f.l + 1, f.i // 3,
         sha256(string_agg(case when u.i = f.i then f.d else u.d end, '' order by u.i))
  from climbs f join upper u on u.l = f.l and u.n > 1 and u.i // 3 = f.i // 3
  group by f.r, f.l, f.i),
ends as (select r, arg_max(d, l) as folded_root from climbs group by r)
select doc_id, leaf, subroots.d as subroot, whole.d as root,
       sha256(coalesce(proof, '')) as proof_sha256, folded_root, folded_root = whole.d as verified
from leaves join subroots using (grp) join ends using (r) left join proofs using (r)
cross join (select d from upper where n = 1) whole
"""

ORACLES = {
    "op2_quality_rules": QUALITY,
    "op4_arc_to_warc": ARCHIVES,
    "op11_merkle_manifest": MANIFEST,
}
