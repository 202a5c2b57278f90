"""The registered queries in SQL, over the same tables.

Views are written again here as common table expressions, flat, without JSON:
the SQL states what each hit holds, the queries have to read it out of raw pages.
"""

from __future__ import annotations

from checks import views as v
from hearsay.settings import CATEGORY_RULES, PERMALINK_PREFIX

WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ORACLE: dict[str, str] = {}


def text_of(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def words_in(words) -> str:
    return "(" + ", ".join(text_of(w) for w in words) + ")"


def iso(ts: str) -> str:
    return (
        f"strftime({ts}, '%Y-%m-%dT%H:%M:%S') || case when epoch_us({ts}) % 1000000 = 0 then '' "
        f"else strftime({ts}, '.%f') end || '+00:00'"
    )


def spaces(value: str) -> str:
    return f"trim(regexp_replace({value}, '{WS}+', ' ', 'g'))"


FETCHED = "2024-02-01T00:00:00+00:00"

MENTIONS = f"""
m as (
  select *, case when sentiment_score is null then null
                 when sentiment_score >= 0.05 then 'positive'
                 when sentiment_score <= -0.05 then 'negative' else 'neutral' end as sentiment
  from (
    select doc_id, cast(doc_id as varchar) as id, source as topic, 'documents' as source, lang as author,
      case doc_id % 4 when 0 then 'Item ' || doc_id when 1 then '' end as title, text,
      'https://example.org/item/' || doc_id as url,
      timestamp '2024-01-01' + to_hours(doc_id // 40) as created_at,
      timestamp '2024-02-01' as fetched_at,
      case when doc_id % 10 <> 0 then n_chars end as points,
      cast(null as bigint) as num_comments,
      case when doc_id % 17 <> 0 then (n_chars % 201 - 100) / 100.0::double end as sentiment_score,
      case when doc_id % 17 <> 0 and doc_id % 29 <> 0 then 'cat' || (n_chars % 5) end as category
    from documents))"""

LISTED = f"""
ranked as (
  select *, case when doc_id % 3 = 0 then doc_id // 3
                 else (doc_id // 3 * 2 + doc_id % 3 - 1) // 10 end as rank1,
    (doc_id // 3 * 2 + doc_id % 3 - 1) % 10 as part
  from documents),
l as (
  select doc_id, text, lang, n_chars, case when doc_id % 3 = 0 then 'hot' else 's' || part end as topic,
    case when doc_id % 3 = 0 then 0 else 1 + part end as ord,
    (rank1 // {v.PAGE_SIZE})::integer as page, (rank1 % {v.PAGE_SIZE})::integer as pos from ranked
  union all
  select doc_id, text, lang, n_chars, 'tag' || (doc_id % 4), 11 + doc_id % 4,
    (doc_id // 4 // {v.PAGE_SIZE})::integer, (doc_id // 4 % {v.PAGE_SIZE})::integer from documents)"""

HITS = LISTED + f""",
h as (
  select *,
    case when reason is null then cast(doc_id as varchar) end as id,
    case when doc_id % 4 = 3 then clean || ' & more' else clean end as full_text,
    case when doc_id % 4 = 0 then clean end as title,
    case when doc_id % 7 <> 0 then lang end as author,
    case when doc_id % 5 in (0, 1) then '{PERMALINK_PREFIX}' else 'https://example.org/' end || doc_id as url,
    timestamp '2024-01-01' + to_minutes(doc_id) as created_at,
    case when doc_id % 6 <> 0 then n_chars end as points, doc_id % 50 as num_comments,
    case when doc_id % 101 <> 0 and doc_id % 13 <> 0 then cast(doc_id as varchar) end as raw_id
  from (
    select *, {spaces('text')} as clean,
      case when doc_id % 101 = 0 then 'Expected a dict hit, got int'
           when doc_id % 13 = 0 then 'Hit has no objectID; cannot assign a stable key.'
           when doc_id % 19 = 0 then 'Hit ' || doc_id || ' has neither title nor text.'
           when doc_id % 23 = 0 and doc_id % 31 <> 0
             then 'Hit ' || doc_id || ' has no parseable creation timestamp.' end as reason
    from l)),
batch as (
  select * from h where reason is null
  qualify row_number() over (partition by id order by ord desc, topic desc, page desc, pos desc) = 1)"""

PAGES = f"""
pg as (
  select topic, page,
    case when topic = 's3' and page = 2 then null when topic = 's6' and page = 1 then 0
         else count(*)::integer end as n_hits,
    case when topic = 's3' and page = 2 then null when topic = 's5' then 2
         when topic like 'tag%' then 1000000000::bigint end as nb_pages
  from l where not (topic = 's4' and page = 2) group by topic, page),
stops as (
  select *, row_number() over (partition by topic order by page) - 1 as rn,
    coalesce(sum(case when n_hits = 0 or page + 1 >= nb_pages then 1 else 0 end) over (
      partition by topic order by page rows between unbounded preceding and 1 preceding), 0) as stopped
  from pg where n_hits is not null),
acc as (select topic, page, n_hits from stops where rn = page and stopped = 0),
ph as (
  select l.*, case when doc_id % 101 <> 0 and doc_id % 13 <> 0 then cast(doc_id as varchar) end as object_id
  from l join pg using (topic, page) where pg.n_hits > 0)"""

GOLD = """
g as (
  select cast(doc_id as varchar) as id, source as topic, text,
    case when doc_id % 17 = 0 then ' ' when doc_id % 19 = 0 then null
      when n_chars >= 1000 then 'good' else ' POOR ' end as predicted_sentiment,
    case when doc_id % 13 = 0 then null when n_chars % 2 = 1 then 'Toxic' else 'clean' end as predicted_category,
    case when doc_id % 9 = 0 then '  ' when quality = 1 then ' Good' else 'poor ' end as true_sentiment,
    case when doc_id % 11 = 0 then null when toxic = 1 then 'toxic' else 'CLEAN' end as true_category
  from labels join documents using (doc_id)),
pairs as (
  select 'sentiment' as kind, lower(trim(true_sentiment)) as "true", coalesce(lower(trim(predicted_sentiment)), '') as predicted
  from g where trim(true_sentiment) <> ''
  union all
  select 'category', lower(trim(true_category)), coalesce(lower(trim(predicted_category)), '')
  from g where trim(true_category) <> ''),
conf as (select kind, "true", predicted, count(*) as n from pairs group by all),
seen as (select kind, "true" as label from conf union select kind, predicted from conf),
cells as (select kind, x.label as "true", y.label as predicted from seen x join seen y using (kind)),
grid as (
  select kind, "true", predicted, coalesce(n, 0)::bigint as n
  from cells left join conf using (kind, "true", predicted)),
sides as (
  select kind, "true" as label, n as support, 0 as guessed,
    case when "true" = predicted then n else 0 end as tp from conf
  union all select kind, predicted, 0, n, 0 from conf),
met as (
  select kind, label, support, prec, rec,
    case when prec + rec > 0 then 2 * prec * rec / (prec + rec) else 0 end as f1
  from (
    select kind, label, sum(support)::bigint as support,
      case when sum(guessed) > 0 then sum(tp) / sum(guessed) else 0 end as prec,
      case when sum(support) > 0 then sum(tp) / sum(support) else 0 end as rec
    from sides group by kind, label)),
acy as (
  select kind, sum(case when "true" = predicted then n else 0 end)::bigint as correct, sum(n)::bigint as n
  from conf group by kind)"""

RUNS = """
ev as (
  select cast(user_id as varchar) as run_id, event_type, ts, event_id, cast(floor(value) as bigint) as n
  from events where event_type in ('signup', 'purchase')),
rl as (
  select run_id, started_at, case when done then last_ts end as finished_at, 0::bigint as fetched,
    case when done then n else 0 end as from_cache, case when done then n * 20 else 0 end as normalised,
    case when done then n % 7 else 0 end as quarantined, case when done then n * 2 else 0 end as inserted,
    case when done then n * 18 else 0 end as duplicates, case when done then n * 2 else 0 end as classified
  from (
    select run_id, ts as last_ts, n, event_type = 'purchase' as done,
      max(case when event_type = 'signup' then ts end) over (partition by run_id) as started_at,
      row_number() over (partition by run_id order by ts desc, event_id desc) as k
    from ev)
  where k = 1 and started_at is not null)"""


def add(name: str, body: str, *ctes: str) -> None:
    ORACLE[name] = ("with " + ",".join(ctes) + "\n" if ctes else "") + body


# Landing and paging

add("raw_page_scan", "select topic, page, n_hits, nb_pages from pg", LISTED, PAGES)
add("landing_path", r"""
select doc_id, folder || '/page_' || case when doc_id < 1000 then lpad(doc_id::varchar, 3, '0') else doc_id::varchar end || '.json' as path,
  folder, doc_id::integer as page
from (select doc_id, regexp_replace(source || '/' || lang || '/é ½.', '[^\p{L}\p{N}_-]', '_', 'g') as folder from documents)""")
add("corrupt_pages", "select topic, page from pg where n_hits is null", LISTED, PAGES)
add("land_new_pages", "select topic, page, n_hits from pg where topic not like 'tag%'", LISTED, PAGES)
add("explode_hits", "select topic, page, pos, object_id from ph", LISTED, PAGES)
add("accepted_pages", "select topic, page, n_hits from acc", LISTED, PAGES)
add("cap_per_topic", f"""
select topic, page, pos, object_id from ph join acc using (topic, page)
where page < {-(-v.CAP // v.PAGE_SIZE)}
qualify row_number() over (partition by topic order by page, pos) <= {v.CAP}""", LISTED, PAGES)
add("hits_per_topic", f"""
select t.topic, count(ah.topic) as hits
from (select unnest([{", ".join(text_of(t.name) for t in v.TOPICS)}]) as topic) t
left join (select ph.topic from ph join acc using (topic, page)) ah on ah.topic = t.topic
group by t.topic""", LISTED, PAGES)
add("page_counters", """
select topic, 0::bigint as fetched, count(*) as from_cache from acc group by rollup (topic)""", LISTED, PAGES)

# Normalisation

add("normalise_hits", f"""
select id, topic, 'documents' as source, author, title, full_text as text, url,
  {iso('created_at')} as created_at, '{FETCHED}' as fetched_at, points, num_comments
from h where reason is null""", HITS)


def json_field(name: str, value: str, given: str = "true") -> str:
    return f"""case when {given} then '"{name}":' || {value} end"""


def json_text(value: str) -> str:
    return f"to_json({value})::varchar"


# The raw hit as compact JSON with sorted keys; keys without a value are left out.
PAYLOAD = "case when doc_id % 101 = 0 then doc_id::varchar else '{' || concat_ws(',', " + ", ".join([
    json_field("author", json_text("case when doc_id % 7 = 0 then '' else lang end")),
    json_field("comment_text", json_text("text"), "doc_id % 19 = 0 or doc_id % 4 = 2"),
    json_field("created_at", json_text("strftime(created_at, '%Y-%m-%dT%H:%M:%SZ')"), "doc_id % 31 = 0"),
    json_field("created_at_i", "epoch(created_at)::bigint", "doc_id % 23 <> 0 and doc_id % 31 <> 0"),
    json_field("num_comments", "doc_id % 50 || '.5'"),
    json_field("objectID", "case when doc_id % 4 = 1 then doc_id::varchar else '\"' || doc_id || '\"' end", "doc_id % 13 <> 0"),
    json_field("points", "case when doc_id % 6 = 0 then '\"n/a\"' else '\"' || n_chars || '\"' end"),
    json_field("story_text", json_text(
        "case when doc_id % 19 = 0 then '<p></p>' when doc_id % 4 = 1 then text else '<p>' || text || ' &amp; more</p>' end"),
        "doc_id % 19 = 0 or doc_id % 4 in (1, 3)"),
    json_field("title", json_text("case when doc_id % 4 = 0 then text else '' end"), "doc_id % 19 <> 0 and doc_id % 4 in (0, 3)"),
    json_field("url", json_text("case when doc_id % 5 = 1 then '' else 'https://example.org/' || doc_id end"), "doc_id % 5 <> 0"),
]) + ") || '}' end"
REJECTS = f"""
bad as (select *, sha256(topic || '|' || payload) as payload_hash
        from (select *, {PAYLOAD} as payload from h where reason is not null))"""
add("quarantine_rows", "select topic, page, pos, raw_id, reason, payload, payload_hash from bad", HITS, REJECTS)
add("text_fallback", f"""
select doc_id, case when doc_id % 3 = 0 then lang
  when doc_id % 5 = 0 then null
  when doc_id % 5 = 2 then {spaces('text')}
  when doc_id % 7 <> 0 then source end as chosen
from documents""")
add("url_default", f"""
select page_id, case when page_id % 3 = 2 and url <> '' then url else '{PERMALINK_PREFIX}' || page_id end as url
from pages""")
add("required_fields", """
select doc_id, case when field is not null
  then 'Record ''' || key || ''' missing required field ''' || field || '''' end as reason
from (
  select doc_id, case when doc_id % 11 = 0 then ' ' else cast(doc_id as varchar) end as key,
    case when doc_id % 11 = 0 then 'id' when doc_id % 7 = 0 then 'topic'
         when doc_id % 5 = 0 or not regexp_matches(text, '\\S') then 'text'
         when doc_id % 3 = 0 then 'created_at' end as field
  from documents)""")
add("payload_hash", "select doc_id, sha256(source || '|' || text) as payload_hash from documents")
add("truncate_text", "select doc_id, substr(text, 1, 90) as excerpt from documents")

# Scalar functions

# The pages hold four entities, some without their semicolon; `&amp` is decoded last.
DECODED = "html"
for entity, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
    DECODED = f"regexp_replace({DECODED}, '&{entity};?', '{char}', 'g')"
UNTAGGED = f"regexp_replace({DECODED}, '<[^>]+>', ' ', 'g')"
add("clean_text", f"select page_id, {spaces(UNTAGGED)} as text from pages")
add("html_unescape", f"select page_id, {DECODED} as html from pages")
add("to_utc_time", f"""
select event_id, case
  when event_id % 9 in (0, 2, 4, 6) then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
  when event_id % 9 = 1 then {iso('ts')}
  when event_id % 9 = 3 then {iso('(ts - interval 150 minute)')}
  when event_id % 9 = 7 then {iso('(ts + interval 3630250 millisecond)')}
  when event_id % 9 = 8 then strftime(ts - interval 1 hour, '%Y-%m-%dT%H:%M:%S') || '+00:00' end as created_at
from events""")
add("iso_format", f"""
select event_id, case when event_id % 2 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00'
  else {iso('ts')} end as iso
from events""")
add("coerce_int", """
select event_id, case event_id % 5 when 0 then trunc(value)::bigint when 1 then floor(value)::bigint
  when 4 then 1::bigint end as n
from events""")
add("json_fields", """
select event_id, cast(json_extract_string(props, '$.k') as bigint) as k,
  json_extract_string(props, '$.none') as missing
from events""")

# Store

add("dedupe_batch", "select id, topic, length(full_text)::integer as text_chars from batch", HITS)
add("upsert_new_mentions", """
select id, topic, length(full_text)::integer as text_chars from batch where lang <> 'en'""", HITS)
add("upsert_counts", """
select count(*) filter (lang <> 'en') as inserted, count(*) filter (lang = 'en') as duplicates from batch""", HITS)
add("quarantine_upsert", """
select distinct payload_hash, raw_id, topic, reason, payload from bad where topic not like 'tag%'""", HITS, REJECTS)
add("quarantine_copies", """
select payload_hash, raw_id, topic, reason, text as payload
from (select *, sha256('any|' || text) as payload_hash from h where reason is not null)
where payload_hash not in (select sha256('any|' || text) from documents where lang = 'de')
qualify row_number() over (partition by payload_hash order by ord, topic, page, pos) = 1""", HITS)
add("apply_labels", """
select m.id, m.topic,
  case when l.doc_id is null then m.sentiment when quality = 1 then 'positive' else 'negative' end as sentiment,
  case when l.doc_id is null then m.sentiment_score when quality = 1 then 0.5 else -0.5 end as sentiment_score,
  case when l.doc_id is null then m.category when toxic = 1 then 'criticism' else 'other' end as category
from m left join labels l using (doc_id)""", MENTIONS)
add("unlabelled", """
select id, title, length(text)::integer as text_chars from m where sentiment is null or category is null""", MENTIONS)
add("all_mentions", f"""
select id, topic, source, author, title, text, url, {iso('created_at')} as created_at,
  '{FETCHED}' as fetched_at, points, num_comments, sentiment, sentiment_score, category
from m order by topic, m.created_at desc, id""", MENTIONS)
add("table_counts", """
select 'mentions' as table_name, count(*) as n from m
union all select 'quarantine', count(*) from h where reason is not null
union all select 'run_log', count(*) from rl""", MENTIONS, HITS, RUNS)
add("run_log_latest", f"""
select run_id, {iso('started_at')} as started_at, {iso('finished_at')} as finished_at,
  fetched, from_cache, normalised, quarantined, inserted, duplicates, classified from rl""", RUNS)
add("run_history", """
select strftime(started_at, '%Y-%m-%dT%H:%M:%S') as run_started, run_id,
  fetched, from_cache, normalised, quarantined, inserted, duplicates, classified
from rl where finished_at is not null order by started_at desc, run_id desc limit 5""", RUNS)
add("batch_counters", """
select 0::bigint as fetched, (select count(*) from acc) as from_cache,
  count(*) filter (reason is null) as normalised,
  count(*) filter (reason is not null) as quarantined,
  count(distinct id) filter (lang <> 'en') as inserted,
  count(distinct id) filter (lang = 'en') as duplicates,
  count(distinct id) filter (lang <> 'en')
    + (select count(*) from m where author = 'en' and (sentiment is null or category is null)) as classified
from (select h.* from h join acc using (topic, page) where acc.n_hits > 0)""", MENTIONS, HITS, PAGES)

# Classification


def edged(pattern: str) -> str:
    """A word-bounded pattern with the word edges spelled out, as RE2's are ASCII only."""
    core = pattern.removeprefix(r"\b").removesuffix(r"\b")
    core = core.replace(r"\w", r"[\p{L}\p{N}_]").replace(r"\d", r"\p{Nd}")
    return text_of(r"(?i)(?:^|[^\p{L}\p{N}_])(" + core + r")(?:$|[^\p{L}\p{N}_])")


def category_case(rules, text: str) -> tuple[str, str]:
    """SQL for the category and the matched term."""
    flat = [(name, edged(p)) for name, patterns in rules for p in patterns]
    category = " ".join(f"when regexp_matches({text}, {p}) then {text_of(n)}" for n, p in flat)
    term = " ".join(f"when regexp_matches({text}, {p}) then regexp_extract({text}, {p}, 1)" for _, p in flat)
    return f"case {category} else 'other' end", f"case {term} end"


def category_sql(rules) -> str:
    category, term = category_case(rules, "text")
    return f"select doc_id, {category} as category, {term} as matched_term from documents"


add("category_rules", category_sql(v.RULES))
add("category_rules_default", category_sql(CATEGORY_RULES))
add("category_rules_subset", category_sql([r for r in v.RULES if r[0] in ("french", "english")]))
add("sentiment_bucket", """
select doc_id, case when doc_id % 17 = 0 then 'neutral' when s >= 0.05 then 'positive'
  when s <= -0.05 then 'negative' else 'neutral' end as sentiment
from (select doc_id, (n_chars % 41 - 20) / 200.0::double as s from documents)""")


def score_ctes(source: str, lexicon: str | None = None) -> str:
    """CTE `scored(key, score)` over `source(key, text)`, by the published scoring rules and SQL for `(word, value)`."""
    r = v.WORDS
    punct = text_of("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    if lexicon is None:
        lexicon = "values " + ", ".join(f"({text_of(w)}, {s}::double)" for w, s in v.LEXICON.items())
    idioms = ", ".join(f"({text_of(w)}, {s}::double)" for w, s in r.idioms)
    up, down, neg = words_in(r.stronger), words_in(r.weaker), words_in(r.negations)

    def step(word: str) -> str:
        return f"case when {word} in {up} then {r.step} when {word} in {down} then -{r.step} else 0 end"

    def caps(word: str) -> str:
        return f"({word} = upper({word}) and {word} <> lower({word}))"

    def negated(word: str) -> str:
        return f"({word} in {neg} or contains({word}, 'n''t'))"

    def boosted(k: int, damp: float) -> str:
        return (
            f"case when p{k} is not null and v{k} is null and {step(f'p{k}')} <> 0 then s + {damp} * ("
            f"{step(f'p{k}')} * case when s < 0 then -1 else 1 end"
            f" + case when mixed and {caps(f'r{k}')} then case when s > 0 then {r.caps} else -{r.caps} end else 0 end"
            f") else s end"
        )

    def turned(k: int) -> str:
        near = [f"p{j}" for j in range(1, k)]
        special = ""
        if near:
            so = " or ".join(f"{p} in ('so', 'this')" for p in near)
            doubt = " or ".join(f"{p} = 'doubt'" for p in near)
            special = f"when p{k} = 'never' and ({so}) then s * 1.25 when p{k} = 'without' and ({doubt}) then s "
        return f"case when p{k} is null or v{k} is not null then s {special}when {negated(f'p{k}')} then s * {r.negate} else s end"

    steps = []
    for k, damp in ((1, 1.0), (2, 0.95), (3, 0.9)):
        steps += [boosted(k, damp), turned(k)]
    chain = "start"
    ctes = []
    for n, expression in enumerate(steps):
        ctes.append(f"step{n} as (select * replace ({expression} as s) from {chain})")
        chain = f"step{n}"
    return f"""
lex(word, value) as ({lexicon}),
idi(phrase, value) as (values {idioms}),
pieces as (select key, text, list_filter(string_split_regex(text, '{WS}+'), lambda x: x <> '') as ws from {source}),
raws as (select key, unnest(ws) as piece, generate_subscripts(ws, 1) as i from pieces),
toks as (
  select key, i, raw, lower(raw) as low from (
    select key, i, case when length(trim(piece, {punct})) <= 2 then piece else trim(piece, {punct}) end as raw
    from raws)),
looked as (select t.*, lex.value as v from toks t left join lex on lex.word = t.low),
docs as (
  select key, count(*) filter ({caps('raw')}) between 1 and count(*) - 1 as mixed,
    min(i) filter (low = '{r.contrast}') as turn
  from toks group by key),
placed as (
  select *, lag(low, 1) over o as p1, lag(low, 2) over o as p2, lag(low, 3) over o as p3,
    lag(raw, 1) over o as r1, lag(raw, 2) over o as r2, lag(raw, 3) over o as r3,
    lag(v, 1) over o as v1, lag(v, 2) over o as v2, lag(v, 3) over o as v3,
    lead(low, 1) over o as n1, lead(low, 2) over o as n2, lead(v, 1) over o as nv
  from looked window o as (partition by key order by i)),
own as (
  select placed.*, docs.mixed, docs.turn,
    case when p1 = 'no' or p2 = 'no' or (p3 = 'no' and p1 in ('or', 'nor')) then v * {r.negate}
         when low = 'no' and nv is not null then 0.0 else v end as s
  from placed join docs using (key)
  where v is not null and {step('low')} = 0 and not (low = 'kind' and coalesce(n1 = 'of', false))),
start as (
  select * replace (s + case when mixed and {caps('raw')} then case when s > 0 then {r.caps} else -{r.caps} end else 0 end as s)
  from own),
{", ".join(ctes)},
phrased as (
  select * replace (case when p3 is not null and v3 is null then coalesce(
    case when n2 is not null then (select value from idi where phrase = low || ' ' || n1 || ' ' || n2) end,
    case when n1 is not null then (select value from idi where phrase = low || ' ' || n1) end,
    (select value from idi where phrase = p1 || ' ' || low),
    (select value from idi where phrase = p2 || ' ' || p1 || ' ' || low),
    (select value from idi where phrase = p2 || ' ' || p1),
    (select value from idi where phrase = p3 || ' ' || p2 || ' ' || p1),
    (select value from idi where phrase = p3 || ' ' || p2), s) else s end as s)
  from {chain}),
leasted as (
  select * replace (case when p1 = 'least' and v1 is null and not coalesce(p2 in ('at', 'very'), false)
    then s * {r.negate} else s end as s) from phrased),
summed as (
  select key, sum(s * case when turn is null or turn = i then 1.0 when i < turn then 0.5 else 1.5 end) as s
  from leasted group by key),
pushed as (
  select key, coalesce(s, 0) + sign(coalesce(s, 0)) * (
      least(length(text) - length(replace(text, '!', '')), 4) * 0.292
      + case when length(text) - length(replace(text, '?', '')) > 3 then 0.96
             when length(text) - length(replace(text, '?', '')) > 1
               then (length(text) - length(replace(text, '?', ''))) * 0.18 else 0 end) as s
  from pieces left join summed using (key)),
scored as (select key, round(s / sqrt(s * s + {r.norm}), 4) as score from pushed)"""


BUCKET = "case when score >= 0.05 then 'positive' when score <= -0.05 then 'negative' else 'neutral' end"
SOURCE = "src as (select doc_id as key, text from documents)"
add("lexicon_sentiment", "select key as doc_id, score from scored", SOURCE, score_ctes("src"))
CATEGORY, TERM = category_case(v.RULES, "text")
add("classify", f"""
select key as doc_id, {BUCKET} as sentiment, score, {CATEGORY} as category, {TERM} as matched_term
from scored join src using (key)""", SOURCE, score_ctes("src"))
add("label_pending", f"""
select key as id, {BUCKET} as sentiment, score as sentiment_score, {CATEGORY} as category, {TERM} as matched_term
from scored join src using (key)""", MENTIONS, """
src as (
  select id as key, coalesce(nullif(title, ''), text) as text
  from m where sentiment is null or category is null)""", score_ctes("src"))

LETTERS = r"""
letters as (select word, sha256(word) as h from (
  select distinct unnest(regexp_extract_all(lower(text), '\p{L}+')) as word from documents) where length(word) >= 3)"""


def number(start: int, size: int) -> str:
    return f"('0x' || substr(h, {start}, {size}))::bigint"


W = r"[\p{L}\p{M}\p{Nd}\p{Pc}]"
add("category_rules_table", f"""
select doc_id, coalesce(category, 'other') as category, term as matched_term
from documents left join (
  select distinct on (doc_id) doc_id, category, term from hit order by doc_id, rule_order, pattern_order, i) using (doc_id)""",
    LETTERS, f"""
r as (select word, {number(16, 1)} // 4 as form, {number(1, 7)} as rule_order, {number(8, 7)} as pattern_order,
             'c' || ({number(17, 4)} % 97) as category, substr(word, 1, 5) as stem from letters),
pieces as (select doc_id, unnest(p) as piece, generate_subscripts(p, 1) as i
           from (select doc_id, regexp_extract_all(text, '{W}+|[^{W[1:-1]}]+') as p from documents)),
near as (select *, lower(piece) as low, lead(piece) over o as gap, lead(piece, 2) over o as after
         from pieces window o as (partition by doc_id order by i)),
tok as (select * from near where regexp_matches(piece, '^{W}')),
forms as (select word as form_word, r.* from r where form = 0
          union all select word || e, r.* from r, (values (''), ('s'), ('ed')) x(e) where form = 1),
starts as (select doc_id, i, piece, left(low, n) as stem from tok, (values (3), (4), (5)) x(n) where length(low) >= n),
hit as (
  select doc_id, i, category, rule_order, pattern_order, piece as term from tok join forms on low = form_word
  union all select doc_id, i, category, rule_order, pattern_order, piece from starts join r using (stem) where form = 2
  union all select doc_id, i, category, rule_order, pattern_order, piece || ' ' || after
  from tok join r on low = word where form = 3 and gap = ' ' and after is not null)""")
add("lexicon_table_sentiment", "select key as doc_id, score from scored", LETTERS, SOURCE, score_ctes("src", f"""
select word || e, max(({number(2, 4)} % 61 - 30) / 10.0::double) from letters, (values (''), ('s'), ('ed'), ('ing')) x(e)
where h < '4' group by 1"""))

# Reports

BY_TOPIC = """
select topic, count(*) as total, count(*) filter (sentiment = 'positive') as positive,
  count(*) filter (sentiment = 'neutral') as neutral, count(*) filter (sentiment = 'negative') as negative,
  round(avg(sentiment_score), 3) as mean_score
from m group by topic"""
add("sentiment_by_topic", BY_TOPIC, MENTIONS)
add("sentiment_share", f"""
select topic, round_even(100 * positive / total, 0)::bigint as positive_pct,
  round_even(100 * negative / total, 0)::bigint as negative_pct from ({BY_TOPIC})""", MENTIONS)
add("category_distribution", """
select category, n, round_even(100 * n / sum(n) over (), 0)::bigint as share_pct
from (select category, count(*) as n from m group by category)""", MENTIONS)
add("headline_counts", """
select count(*) as total, count(distinct topic) as topics,
  (select count(*) from h where reason is not null) as quarantined,
  count(*) filter (sentiment is null or category is null) as unlabelled from m""", MENTIONS, HITS)
add("top_items_per_topic", """
select topic, rank::integer as rank, id, substr(coalesce(nullif(title, ''), text), 1, 110) as label, sentiment, category,
  coalesce(points::varchar, '-') as points, url
from (select *, row_number() over (
        partition by topic order by coalesce(points, 0) desc, created_at desc, id) as rank from m)
where rank <= 3""", MENTIONS)
add("distinct_topics", "select distinct topic from m", MENTIONS)

RELABELLED = """
cur as (
  select m.* replace (
    case when l.doc_id is null then m.sentiment when quality = 1 then 'positive' else 'negative' end as sentiment,
    case when l.doc_id is null then m.sentiment_score when quality = 1 then 0.5 else -0.5 end as sentiment_score,
    case when l.doc_id is null then m.category when toxic = 1 then 'criticism' else 'other' end as category)
  from m left join labels l using (doc_id)),
bt as (select topic, count(*) as total, count(*) filter (sentiment = 'positive') as positive,
    count(*) filter (sentiment = 'neutral') as neutral, count(*) filter (sentiment = 'negative') as negative,
    round(avg(sentiment_score::decimal(24, 12)), 3) as mean from cur group by topic),
top as (select *, row_number() over (partition by topic order by coalesce(points, 0) desc, created_at desc, id) as rank from cur)"""
add("incremental_report", """
select 'topic' as section, topic, side as name, n, mean as value
from (unpivot bt on total, positive, neutral, negative into name side value n)
union all select 'headline', null, 'total', count(*), null from cur
union all select 'headline', null, 'topics', count(distinct topic), null from cur
union all select 'headline', null, 'unlabelled', count(*) filter (sentiment is null or category is null), null from cur
union all select 'category', null, category, n, round_even(100 * n / sum(n) over (), 0)
  from (select category, count(*) as n from cur group by category)
union all select distinct 'topics', topic, null, null::bigint, null::double from cur
union all select 'best', topic, concat_ws('|', id, substr(coalesce(nullif(title, ''), text), 1, 110), sentiment, category,
  coalesce(points::varchar, '-'), url), rank, null from top where rank <= 3""", MENTIONS, RELABELLED)

# Evaluation

SAMPLE = "from m where sentiment is not null order by sha256('42|' || id), id limit 25"
add("seeded_sample", f"select id, topic, sentiment {SAMPLE}", MENTIONS)
add("gold_template", f"""
select id, topic, text, sentiment as predicted_sentiment, category as predicted_category,
  '' as true_sentiment, '' as true_category {SAMPLE}""", MENTIONS)
add("label_pairs", 'select kind, "true", predicted, n from conf', GOLD)
add("confusion_counts", 'select kind, "true", predicted, n from conf', GOLD)
add("label_universe", "select distinct kind, label from sides", GOLD)
add("eval_accuracy", "select kind, correct, n, round(correct / n, 6) as accuracy from acy", GOLD)
add("confusion_grid", """
select * from grid""", GOLD)
add("class_metrics", """
select kind, label, support, round(prec, 6) as precision, round(rec, 6) as recall, round(f1, 6) as f1
from met""", GOLD)
add("evaluation_report", """
select kind, 'accuracy' as section, cast(null as varchar) as label, cast(null as varchar) as predicted,
  round(correct / n, 6) as value from acy
union all select kind, 'support', label, null, support from met
union all select kind, 'precision', label, null, round(prec, 6) from met
union all select kind, 'recall', label, null, round(rec, 6) from met
union all select kind, 'f1', label, null, round(f1, 6) from met
union all select kind, 'confusion', "true", predicted, n from grid""", GOLD)
add("disagreements", r"""
select id, topic, replace(substr(text, 1, 90), '|', '\|') as text,
  predicted_sentiment as predicted, true_sentiment as "true"
from g where trim(true_sentiment) <> '' and lower(trim(true_sentiment)) <> coalesce(lower(trim(predicted_sentiment)), '')
order by id limit 10""", GOLD)

add("store_after_compaction", f"""
select id, topic, source, author, title, text, url, {iso('created_at')} as created_at,
  '{FETCHED}' as fetched_at, points, num_comments, sentiment, sentiment_score, category from m""", MENTIONS)
STORE_CATEGORY, _ = category_case(v.RULES, "body")
# What a run over all landed pages leaves in the store.
STORED = (HITS, PAGES, """
taken as (select h.* from h join acc using (topic, page) where acc.n_hits > 0),
bad as (select topic || '|' || doc_id as payload from taken where reason is not null),
src as (select id as key, coalesce(nullif(title, ''), full_text) as text from taken where reason is null
  qualify row_number() over (partition by id order by ord desc, topic desc, page desc, pos desc) = 1)""", score_ctes("src"), f"""
st as (select *, {BUCKET} as sentiment, {STORE_CATEGORY} as category from (
  select taken.*, score, coalesce(nullif(title, ''), full_text) as body from taken join scored on key = id where reason is null
  qualify row_number() over (partition by id order by ord desc, topic desc, page desc, pos desc) = 1))""")
add("store_report", f"""
select 'topic' as section, topic, side as name, n
from (unpivot (select topic, count(*) as total, count(*) filter (sentiment = 'positive') as positive,
    count(*) filter (sentiment = 'neutral') as neutral, count(*) filter (sentiment = 'negative') as negative from st group by topic)
  on total, positive, neutral, negative into name side value n)
union all select 'category', null, category, count(*) from st group by category
union all select 'headline', null, 'total', count(*) from st
union all select 'headline', null, 'topics', count(distinct topic) from st
union all select 'headline', null, 'unlabelled', 0
union all select 'headline', null, 'quarantined', count(distinct payload) from bad
union all select 'best', topic, concat_ws('|', id, category, coalesce(points::varchar, '-')), rank
from (select *, row_number() over (partition by topic order by coalesce(points, 0) desc, created_at desc, id) as rank from st) where rank <= 3""",
    *STORED)

# Streaming

add("incremental_ingest", f"""
select id, topic, 'documents' as source, author, title, full_text as text, url, {iso('created_at')} as created_at,
  '{FETCHED}' as fetched_at, points, num_comments, sentiment, score as sentiment_score, category from st""", *STORED)
