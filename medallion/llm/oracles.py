"""DuckDB SQL of the dealt queries that SQL can express on whole tables.

Ops 4, 6, 7 and 8 have none (tokenizers and fitted models); those are tested
against brute force. Op 3's makes a row of each byte, which suits small tables only.
"""

from __future__ import annotations

_SPLIT = r"list_filter(regexp_split_to_array({text}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ASSIGN = r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"


def _spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    """Rows (blob, start, end, order, kind, of the text t.body)."""
    return f"""
    select blob, '{kind}' as kind, {order} as o, list_sum(list_transform(steps[1:i], lambda s: length(s))) as e,
           list_sum(list_transform(steps[1:i], lambda s: length(s))) - length(matches[i]) as s
    from (select blob, regexp_extract_all(body, '(?s).*?({pattern})', 0) as steps,
                 regexp_extract_all(body, '(?s).*?({pattern})', 1) as matches,
                 regexp_extract_all(body, '(?s).*?({pattern})', {group}) as measured
          from bodies where regexp_matches(body, '{pattern}')), lateral (select unnest(range(1, len(steps) + 1)) as i)
    where length(measured[i]) >= {least}"""


_FOUND = " union all ".join(
    _spans(*x)
    for x in [
        ("assign", 1, _ASSIGN, 2, 12),
        ("access", 2, "AKIA[A-Z0-9]+", 1, 18),
        ("hex", 3, "[0-9a-f]{16,}", 1, 16),
        ("github", 4, "gh[pousr]_[A-Za-z0-9]{36,}", 1, 40),
        ("private_key", 5, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 1, 1),
    ]
)

SQL = {
    "op1_ngram_jaccard": f"""
with recursive words as (select doc_id, {_SPLIT.format(text=_LOWER)} as w from documents),
sh as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from words, lateral (select unnest(range(1, greatest(1, len(w) - 4) + 1)) as i) where len(w) > 0),
n as (select doc_id, count(*) as n from sh group by 1),
o as (select a.doc_id as a, b.doc_id as b, count(*) as o from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 75 * (x.n + y.n - o)),
e as (select a, b from l union all select b, a from l),
r(id, root) as (select doc_id, doc_id from documents union select e.b, r.root from r join e on e.a = r.id where r.root < e.b)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.root) as component_id
from documents d left join n on n.doc_id = d.doc_id join r on r.id = d.doc_id group by d.doc_id""",
    "op1_ngram_jaccard_links": f"""
with recursive words as (select doc_id, {_SPLIT.format(text=_LOWER)} as w from documents),
sh as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as s
  from words, lateral (select unnest(range(1, greatest(1, len(w) - 4) + 1)) as i) where len(w) > 0),
n as (select doc_id, count(*) as n from sh group by 1),
o as (select a.doc_id as a, b.doc_id as b, count(*) as o from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 75 * (x.n + y.n - o)),
e as (select a, b from l union all select b, a from l),
k as (select a, count(*) as n_links from e group by 1),
r(id, root) as (select doc_id, doc_id from documents union select e.b, r.root from r join e on e.a = r.id where r.root < e.b)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.root) as component_id, coalesce(any_value(k.n_links), 0) as n_links
from documents d left join n on n.doc_id = d.doc_id left join k on k.a = d.doc_id join r on r.id = d.doc_id group by d.doc_id""",
    "op2_secret_scan": f"""
with paths as (select doc_id, coalesce(text, '') as body, sha256(coalesce(text, '')) as blob from documents),
bodies as (select distinct blob, body from paths),
found as ({_FOUND}),
sums as (
  select blob, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' order by s, o) filter (o <= 3) as base,
         string_agg(kind || ':' || s || ':' || e, ',' order by s, o) as spans
  from found group by blob)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, paths.blob
from paths left join sums on sums.blob = paths.blob""",
    "op2_secret_ledger": f"""
with paths as (select doc_id, coalesce(text, '') as body, sha256(coalesce(text, '')) as blob from documents),
bodies as (select distinct blob, body from paths),
found as ({_FOUND}),
sums as (select blob, string_agg(kind || ':' || s || ':' || e, ',' order by s, o) as spans from found group by blob)
select doc_id, coalesce(spans, '') as spans, 5::bigint as n_pairs, 5::bigint as n_rules
from paths left join sums on sums.blob = paths.blob""",
    "op5_topk": """
with v as (select distinct vec_id, list_transform(embedding, lambda x: x > 0) as code from embeddings),
d as (
  select a.vec_id as query_id, b.vec_id as neighbour_id,
         list_sum(list_transform(list_zip(a.code, b.code), lambda x: (x[1] <> x[2])::int))::int as distance
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id)
select query_id, rank::int as rank, neighbour_id, distance
from (select *, row_number() over (partition by query_id order by distance, neighbour_id) as rank from d) where rank <= 10""",
    "op9_decontamination": r"""
with norm as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from documents),
item as (
  select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from benchmark),
win as (
  select distinct item_id, least(13, len(w)) as n, array_to_string(w[i : i + 12], ' ') as s
  from item, lateral (select unnest(range(1, greatest(1, len(w) - 12) + 1)) as i) where len(w) > 0),
lens as (select distinct n from win),
occ as (
  select doc_id, i, lens.n as n, array_to_string(w[i : i + lens.n - 1], ' ') as s
  from norm, lens, lateral (select unnest(range(1, len(w) - lens.n + 2)) as i) where len(w) >= lens.n),
m as (select doc_id, i, occ.n, item_id from occ join win on occ.n = win.n and occ.s = win.s),
hit as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + n)) as k from m) group by 1),
its as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as ids from (select distinct doc_id, item_id::varchar as x from m) group by 1)
select norm.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * n_hit >= len(w) as contaminated
from norm left join hit on hit.doc_id = norm.doc_id left join its on its.doc_id = norm.doc_id""",
    "op3_suffix_array_dedup": r"""
with d as (select doc_id, encode(coalesce(text, '')) as x, octet_length(encode(coalesce(text, ''))) as n, row_number() over () as r from documents),
w as (select r, i, md5(x[i : i + 199]) as h from d, lateral (select unnest(range(1, n - 198)) as i)),
again as (select r, i from w semi join (select h from w group by h having count(*) > 1) t on w.h = t.h),
step as (select r, i, case when i > lag(i) over (partition by r order by i) + 200 then 1 else 0 end as cut from again),
isle as (select r, i, sum(cut) over (partition by r order by i) as k from step),
gone as (select r, k, min(i) as a, max(i) + 200 as b from isle group by r, k),
spans as (select r, count(*) as n_spans, sum(b - a) as n_removed from gone group by r),
edges as (select r, coalesce(lag(b) over (partition by r order by a), 1) as f, a as t from gone
  union all select d.r, coalesce(max(gone.b), 1), any_value(d.n) + 1 from d left join gone on gone.r = d.r group by d.r),
kept as (select e.r, coalesce(string_agg(hex(x[f : t - 1]), '' order by f) filter (where f < t), '') as y from edges e join d on d.r = e.r group by e.r)
select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(y)) as kept_sha256
from d join kept on kept.r = d.r left join spans on spans.r = d.r
""",
    "op10_substring_dedup": f"""
with words as (select doc_id, {_SPLIT.format(text="coalesce(text, '')")} as w from documents),
win as (
  select doc_id, i, array_to_string(w[i : i + 34], ' ') as s
  from words, lateral (select unnest(range(1, len(w) - 33)) as i) where len(w) >= 35),
again as (select doc_id, i from (select doc_id, i, count(*) over (partition by s) as c from win) where c > 1),
gone as (select distinct doc_id, k from (select doc_id, unnest(range(i, i + 35)) as k from again)),
kept as (
  select words.doc_id, w, list_filter(range(1, len(w) + 1), lambda k: not list_contains(coalesce(g, []), k)) as k
  from words left join (select doc_id, list(k) as g from gone group by 1) g on g.doc_id = words.doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - len(k))::bigint as n_removed,
       sha256(array_to_string(list_transform(k, lambda x: w[x]), ' ')) as kept_sha256
from kept""",
    "op11_url_filters": r"""
with rest as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as r from pages),
parts as (
  select page_id, translate(coalesce(regexp_extract(r, '^([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') as path
  from rest),
rules(rule_host, rule_path, verdict) as (values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best as (
  select p.*, (select max({'size': length(rule_host) + length(rule_path), 'rule': rule_host || rule_path, 'verdict': verdict}) from rules
               where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)) as b
  from parts p)
select page_id, host, path, b.rule as rule, coalesce(b.verdict, 'allow') as verdict from best""",
}
