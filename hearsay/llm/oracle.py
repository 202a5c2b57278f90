"""The registered queries in DuckDB SQL, where SQL can express them."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

EXACT_DEDUP = f"""
with d as (select doc_id, sha256({_FOLDED}) as text_sha256 from documents)
select doc_id, max(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id is not distinct from max(doc_id) over (partition by text_sha256) as kept, text_sha256
from d
"""

_METRICS = {"symbol_pm": (20, False), "dup_line_pm": (150, False), "word_len_pc": (200, True)}


def _fences(parts: str, keys: str) -> str:
    cells = ", ".join(
        f"max(q3 + 3 * greatest(q3 - q1, {floor})) filter (metric = '{m}') as {m}_high, "
        + (f"max(q1 - 3 * greatest(q3 - q1, {floor})) filter (metric = '{m}')" if low else "-1")
        + f" as {m}_low"
        for m, (floor, low) in _METRICS.items()
    )
    return f"""
    select {keys}, max(total) as total, {cells} from (
      select {keys}, metric, max(total) as total, min(value) filter (4 * below >= total) as q1,
             min(value) filter (4 * below >= 3 * total) as q3
      from (select *, sum(n) over (partition by {keys}, metric order by value) as below,
                   sum(n) over (partition by {keys}, metric) as total
            from (select {keys}, metric, value, sum(n) as n from {parts} group by all))
      group by all) group by all"""


_PICK = ", ".join(
    f"case when o.total >= 200 then o.{m}_{s} when l.total >= 200 then l.{m}_{s} else a.{m}_{s} end as {m}_{s}"
    for m in _METRICS for s in ("low", "high")
)
_INSIDE = " and ".join(f"coalesce({m} between {m}_low and {m}_high, true)" for m in _METRICS)

QUALITY_RULES = rf"""
with d as (select doc_id, lang, source, coalesce(text, '') as text,
                  list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
           from documents),
grams as (select doc_id, i, list_slice(ws, i, i + 4) as g
          from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from d where len(ws) > 5)),
hits as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as n from grams) where n > 1),
rep as (select doc_id, count(distinct i + k) as n from hits, range(0, 5) r(k) group by doc_id),
c as (select d.doc_id, lang, source, len(ws)::bigint as n_words,
             coalesce(length(array_to_string(ws, '')), 0)::bigint as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
             len(ls)::bigint as n_lines,
             (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words
      from d left join rep using (doc_id)),
m as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
             1000 * n_symbols // greatest(word_chars, 1) as symbol_pm,
             1000 * n_dup_lines // greatest(n_lines, 1) as dup_line_pm,
             100 * word_chars // greatest(n_words, 1) as word_len_pc from c),
long as (unpivot (select lang, source, symbol_pm, dup_line_pm, word_len_pc from m where not base_failed)
         on symbol_pm, dup_line_pm, word_len_pc into name metric value v),
parts as (select lang, source, 1 as one, metric,
                 v - v % (1::bigint << greatest(length(format('{{:b}}', v)) - 6, 0)) as value, count(*) as n
          from long group by all),
o as ({_fences("parts", "lang, source")}),
l as ({_fences("parts", "lang")}),
a as ({_fences("parts", "one")}),
t as (select o.lang, o.source, {_PICK} from o join l on o.lang is not distinct from l.lang cross join a)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and {_INSIDE} as kept
from m left join t on m.lang is not distinct from t.lang and m.source is not distinct from t.source
"""


def _crc(values: str) -> str:
    """CTEs that give crc(x, crc32): the checksum of the UTF-8 bytes of each distinct x of the relation `values`."""
    return f"""
crc_table as (select list_transform(range(256), lambda i: list_reduce(range(8),
                lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
crc_bytes as (select x, hex(encode(x)) as h from (select distinct x from {values})),
crc as (select x, xor(4294967295, list_reduce(
                 list_transform(range(1, length(h) + 1, 2), lambda i: 16 * instr('0123456789ABCDEF', h[i]) - 17
                                                                      + instr('0123456789ABCDEF', h[i + 1])),
                 lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::bigint)) as crc32
        from crc_bytes, crc_table)"""


IMPORTANCE = f"""
with d as (select doc_id, row_number() over () as rid,
                  list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as ws
           from documents),
w as (select rid, unnest(ws) as x from d),
v as (select unnest(list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) as x
      from benchmark),
{_crc("(select x from w union all select x from v)")},
s as (select crc32 % 10000 as b, count(*) as n from w join crc using (x) group by all),
t as (select crc32 % 10000 as b, count(*) as n from v join crc using (x) group by all),
totals as (select (select coalesce(sum(n), 0) from s)::bigint as ss, (select coalesce(sum(n), 0) from t)::bigint as tt),
g as (select b, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (ss + 10000)::double
                                / ((coalesce(s.n, 0) + 1)::double * (tt + 10000)::double)))::bigint as gain
      from s left join t using (b), totals),
sums as (select rid, count(*) as n, sum(gain)::double as total from w join crc using (x) join g on crc32 % 10000 = b group by rid),
h as (select doc_id, len(ws)::bigint as n_features, coalesce(floor(total / n), 0)::bigint as weight,
             ('0x' || left(sha256('2024:' || doc_id), 8))::bigint as h
      from d left join sums using (rid)),
z as (select doc_id, n_features, weight,
             weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double)))::bigint as score from h),
r as (select *, n_features >= 20 as able,
             row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
             count(*) over (partition by n_features >= 20) as able_n from z)
select doc_id, n_features, weight, score, case when able and place <= 10 * able_n // 100 then place end as rank from r
"""

PREFIX_TRIE = f"""
with t as (select conv_id, role, text, m, row_number() over (partition by conv_id order by turn nulls first, role, m) - 1 as pos
           from (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text,
                        sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) as m
                 from conversations where conv_id is not null)),
ids as (select distinct conv_id from t),
{_crc("(select conv_id::varchar as x from ids)")},
h as (select conv_id, crc32 % 6 as h from ids join crc on x = conv_id::varchar),
re as (select h.conv_id, 0 as kind, pos, m, text from h join t on t.conv_id = h.conv_id - h.conv_id % 100 and pos < h
       union all select conv_id, 1, pos, m, text from t join h using (conv_id) where pos >= h),
p as (select conv_id, row_number() over w as depth, string_agg(m, '') over w as k, length(text) as n
      from re window w as (partition by conv_id order by kind, pos rows unbounded preceding)),
whole as (select conv_id, coalesce(max(depth), 0) as depth, coalesce(max_by(k, depth), '') as k from ids left join p using (conv_id) group by all),
n as (select k, depth, min(conv_id) as conv_id, count(*) as n_convs, max(n) as n from
        (select conv_id, k, depth, n from p union all select conv_id, '', 0, 0 from ids) group by all),
e as (select k, sha256(string_agg(conv_id::varchar, ',' order by conv_id)) as ends from whole group by k),
c as (select left(k, -64) as k, count(*) as n_children from n where depth > 0 group by all),
u as (select v.k, sum((n.n_convs - 1) * n.n)::bigint as saved_tokens, count(*) filter (c.k is null) as n_leaves
      from n v join n on starts_with(n.k, v.k) left join c on c.k = n.k group by v.k)
select n.conv_id, n.depth, up.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves, saved_tokens,
       coalesce(ends, sha256('')) as ends_sha256
from n join u using (k) left join c using (k) left join e using (k)
left join n up on n.depth > 0 and up.k = left(n.k, -64)
"""

NGRAM_JOIN = f"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array({_FOLDED}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from documents),
sets as (select doc_id, list_distinct(case when len(ws) >= 3
           then list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
           when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as g from w),
s as (select doc_id, unnest(g) as g from sets),
met as (select x.doc_id as a, y.doc_id as b, count(*) as n from s x join s y on x.g = y.g and x.doc_id < y.doc_id group by all),
links as (select a, b from met join sets x on x.doc_id = a join sets y on y.doc_id = b
          where 100 * n >= 90 * (len(x.g) + len(y.g) - n)),
sides as (select a, b from links union all select b, a from links),
reach as (select doc_id as a, doc_id as b from sets union select reach.a, sides.b from reach join sides on reach.b = sides.a)
select doc_id, len(g)::bigint as n_shingles, min(b) as component_id from sets join reach on a = doc_id group by all
"""

# All given pages have one article of headings and paragraphs, bold and line breaks, and two entities.
_ARTICLE = r"regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '</?b>|<br>', ' ', 'g')"
_DECODED = r"regexp_replace(regexp_replace(x, '&quot;?', chr(34), 'g'), '&amp;?', '&', 'g')"
MAIN_TEXT = f"""
select page_id, url, text, length(text)::bigint as n_chars from (
  select page_id, url, array_to_string(list_filter(list_transform(
      regexp_split_to_array({_ARTICLE}, '</?(?:p|h1)>'), lambda x: trim(regexp_replace({_DECODED}, '\\s+', ' ', 'g'))),
    lambda x: x <> ''), chr(10) || chr(10)) as text from pages)
"""

ORACLE = {
    "op3_ngram_join": NGRAM_JOIN, "op13_html_extraction": MAIN_TEXT,
    "op4_quality_rules": QUALITY_RULES, "op9_exact_dedup": EXACT_DEDUP, "op11_importance": IMPORTANCE,
    "op12_prefix_trie": PREFIX_TRIE,
}
