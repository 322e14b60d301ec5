"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

from shelfwise.llm.quality import LEAST_ROWS, RATES, SPREADS
from shelfwise.llm.url_filter import HOST_RULES

_WORD = r"[^\x20\x09-\x0D]+"

# Documents' 4-word shingles, all pairs that share one, and the least id that links reach.
_NGRAM = rf"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w from documents
), s as (
  select distinct doc_id, hash(array_to_string(w[i:i + 3], ' ')) as h
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from w where len(w) > 0)
), n as (
  select w.doc_id, (select count(*) from s where s.doc_id = w.doc_id) as n from w
), rare as (
  select s.* from s semi join (select h from s group by h having count(*) > 1) using (h)
), pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared from rare a join rare b on a.h = b.h and a.doc_id <> b.doc_id group by all
), links as (
  select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= 85 * (x.n + y.n - shared)
), reach(a, b) as (
  select a, b from links
  union
  select reach.a, links.b from reach join links on reach.b = links.a
)
select n.doc_id, n.n as n_shingles, least(n.doc_id, coalesce((select min(b) from reach where reach.a = n.doc_id), n.doc_id)) as component_id,
  least(n.doc_id, coalesce((select min(b) from pairs join n y on y.doc_id = b where pairs.a = n.doc_id and shared = n.n and shared = y.n), n.doc_id)) as class_id
from n"""

_COUNTS = rf"""
w as (
  select doc_id, lang, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents
), lines as (
  select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines
  from (select doc_id, unnest(string_split(text, chr(10))) as line from w) where regexp_matches(line, '{_WORD}') group by doc_id
), win as (
  select doc_id, i, count(*) over (partition by doc_id, g) as c
  from (select doc_id, i, array_to_string(w[i:i + 7], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from w where len(w) >= 8))
), repeats as (
  select doc_id, count(distinct j) as n_repeat_words from (select doc_id, unnest(range(i, i + 8)) as j from win where c > 1) group by doc_id
), counts as (
  select w.doc_id, lang, source, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0)::bigint as n_lines,
    length(regexp_replace(text, '[^A-Z]', '', 'g'))::bigint as n_caps, length(regexp_replace(text, '[^!?]', '', 'g'))::bigint as n_marks
  from w left join lines using (doc_id) left join repeats using (doc_id)
), rated as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    {", ".join(f"case when {den} > 0 then 10000 * {num} // {den} end as {name}" for name, (num, den, _, _) in RATES.items())}
  from counts
)"""

_BITS = "length(ltrim(bin(v), '0'))"


def _quality() -> str:
    sides = [(name, end) for name in RATES for end in ("low", "high")]
    fails = " or ".join(f"coalesce({name} > high_{name}{f' or {name} < low_{name}' if both else ''}, false)" for name, (_, _, _, both) in RATES.items())
    return f"""with {_COUNTS}, long as (
  {" union all ".join(f"select lang, source, '{name}' as rate, {name} as v, {spec[2]} as unit from rated where {name} is not null" for name, spec in RATES.items())}
), bucketed as (
  select *, case when v < 128 then v else (v >> ({_BITS} - 7)) end as top, case when v < 128 then 0 else {_BITS} - 7 end as shift from long
), valued as (
  select *, case when shift = 0 then v else ((top + 1) << shift) - 1 end as upper from bucketed
), g0 as (
  select lang, source, rate, any_value(unit) as unit, count(*) as n, quantile_disc(upper, 0.25) as q25, quantile_disc(upper, 0.75) as q75 from valued group by all
), g1 as (
  select lang, rate, count(*) as n, quantile_disc(upper, 0.25) as q25, quantile_disc(upper, 0.75) as q75 from valued group by all
), g2 as (
  select rate, count(*) as n, quantile_disc(upper, 0.25) as q25, quantile_disc(upper, 0.75) as q75 from valued group by all
), picked as (
  select g0.lang, g0.source, g0.rate, g0.unit,
    case when g0.n >= {LEAST_ROWS} then g0.q25 when g1.n >= {LEAST_ROWS} then g1.q25 else g2.q25 end as q25,
    case when g0.n >= {LEAST_ROWS} then g0.q75 when g1.n >= {LEAST_ROWS} then g1.q75 else g2.q75 end as q75
  from g0 join g1 on g0.rate = g1.rate and g0.lang is not distinct from g1.lang join g2 on g0.rate = g2.rate
), limits as (
  select lang, source, {", ".join(f"max(case when rate = '{name}' then {'q25 - ' if end == 'low' else 'q75 + '}{SPREADS} * greatest(q75 - q25, unit) end)::bigint as {end}_{name}" for name, end in sides)}
  from picked group by lang, source
)
select doc_id, rated.lang, rated.source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_caps, n_marks, base_failed,
  {", ".join(RATES)}, {", ".join(f"{end}_{name}" for name, end in sides)}, not base_failed and not ({fails}) as kept
from rated left join limits on rated.lang is not distinct from limits.lang and rated.source is not distinct from limits.source"""


# The patterns' regular expressions, written out.
_SEPARATOR = "(?:[^a-z0-9_.%-]|$)"
_PATTERNS = {
    "?page=*&ref=^": rf"\?page=.*&ref={_SEPARATOR}",
    "/login^": rf"/login{_SEPARATOR}",
    "/cart^": rf"/cart{_SEPARATOR}",
    "/wp-admin/": "/wp-admin/",
    "/tag/*/feed|": "/tag/.*/feed$",
    "&sessionid=": "&sessionid=",
    ".cheap-pills.": r"\.cheap-pills\.",
    ".zip|": r"\.zip$",
    ".exe|": r"\.exe$",
    "#comment": "#comment",
    "/search?q=": r"/search\?q=",
    "print=1": "print=1",
}


def _url() -> str:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in HOST_RULES)
    patterns = ", ".join(f"('{p}', '{r}')" for p, r in _PATTERNS.items())
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""with parts as (
  select page_id, url, {lower.format("regexp_extract(rest, '^[^/?#]*')")} as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, url, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages)
), rules(h, p, v) as (values {rules}), patterns(pattern, regex) as (values {patterns}),
judged as (
  select parts.*, (select r from (select h || p as r, v from rules where (host = h or suffix(host, '.' || h)) and prefix(path, p)) order by length(r) desc, r limit 1) as rule,
    (select v from (select h || p as r, v from rules where (host = h or suffix(host, '.' || h)) and prefix(path, p)) order by length(r) desc, r limit 1) as given,
    (select min(pattern) from patterns where regexp_matches({lower.format("url")}, regex, 's')) as fits
  from parts
)
select page_id, host, path, rule, case when given is null then fits end as pattern,
  coalesce(given, case when fits is not null then 'block' end, 'allow') as verdict
from judged"""


_CONTROL = r"(\\|</?s>|\[/?INST\]|<</?SYS>>)"
_CHAT = rf"""with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e as (
  select *, length(regexp_replace(text, '{_CONTROL}', '\\\1', 'g')) + case role when 'user' then 16 when 'assistant' then 4
    else 7 + length(regexp_replace(role, '{_CONTROL}', '\\\1', 'g')) + 7 + 8 end as chars from c
)
select conv_id::bigint as conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn), '')) as loss_sha256, sum(chars)::bigint as formatted_chars
from e group by conv_id"""

# Every 100-byte string as hex, its first place in the corpus, and the bytes that later places cover.
_SUFFIX = r"""with d as (
  select doc_id, coalesce(text, '') as text, hex(encode(coalesce(text, ''))) as x from documents
), starts as (
  select doc_id, i, md5(substr(x, 2 * i + 1, 200)) as h from (select doc_id, x, unnest(range(0, length(x) // 2 - 99)) as i from d)
), later as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by h order by doc_id, i) as k from starts) where k > 1
), runs as (
  select doc_id, min(i) as a, max(i) + 100 as b
  from (select doc_id, i, sum(new) over (partition by doc_id order by i) as run
        from (select doc_id, i, case when i - lag(i) over (partition by doc_id order by i) <= 100 then 0 else 1 end as new from later))
  group by doc_id, run
), kept as (
  select doc_id, coalesce(lag(b) over w, 0) as a, a as b, b - a as gone from runs window w as (partition by doc_id order by a)
  union all select doc_id, max(b), null, 0 from runs group by doc_id
)
select d.doc_id, any_value(length(x) // 2) as n_bytes, coalesce(sum(gone), 0)::bigint as n_removed, count(case when gone > 0 then 1 end) as n_spans,
  sha256(unhex(case when count(kept.doc_id) = 0 then any_value(x) else string_agg(substr(x, (2 * kept.a + 1)::bigint, (2 * (coalesce(kept.b, length(x) // 2) - kept.a))::bigint), '' order by kept.a) end)) as kept_sha256
from d left join kept using (doc_id) group by d.doc_id"""

_WARC = r"""with p as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as x from pages
), bits as (
  select *, [case when b then 1 else 0 end for b in flatten([[(('0x' || substr(x, i, 1))::int & 8) > 0, (('0x' || substr(x, i, 1))::int & 4) > 0, (('0x' || substr(x, i, 1))::int & 2) > 0, (('0x' || substr(x, i, 1))::int & 1) > 0] for i in range(1, 41)])] as b from p
), firsts as (
  select x, min(page_id) as refers_to from p group by x
)
select page_id, octet_length(encode(html))::bigint as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (16 * b[5 * k + 1] + 8 * b[5 * k + 2] + 4 * b[5 * k + 3] + 2 * b[5 * k + 4] + b[5 * k + 5] + 1)::bigint, 1) for k in range(0, 32)], '') as payload_digest,
  case when page_id > refers_to then 'revisit' else 'response' end as record_type, case when page_id > refers_to then refers_to end as refers_to
from bits join firsts using (x)"""

_LINES = r"""with lines as (
  select doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(l) as line, unnest(range(len(l))) as i from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents))
), shared as (
  select k, max(doc_id) as last_id from lines where length(k) >= 20 group by k having count(distinct doc_id) >= 3
), marked as (
  select doc_id, i, line, coalesce(doc_id <> last_id, false) as gone from lines left join shared using (k)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from marked group by doc_id"""

# CRC-32 by its byte table; near words by the strings that are left when one code point goes.
_SPELLING = r"""with recursive crc as (
  select list(c order by i) as t from (select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from range(256) r(i))
), runs as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as k
  from (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) as run from documents) where length(run) >= 7 group by all
), hashed as (
  select run, k, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) as h
  from (select *, hex(encode(doc_id || ':' || run)) as x from runs), crc
), words as (
  select word, sum(k)::bigint as n from (select k, case when h % 31 = 0 then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word from hashed)
  where length(word) >= 7 group by word having sum(k) >= 2
), cuts as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), pairs as (
  select distinct a.word, b.word as near, b.n as near_n from cuts a join cuts b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union all select distinct a.word, b.word, b.n from cuts a join words b on a.rest = b.word
  union all select distinct b.word, a.word, a.n from cuts a join words b on a.rest = b.word
), best as (
  select word, count(*) as n_near, arg_min(struct_pack(near, near_n), (-near_n, near)) as b from pairs group by word
), formed as (
  select words.word, n, coalesce(n_near, 0)::bigint as n_near, case when b.near_n >= 10 * n then b.near end as form, case when b.near_n >= 10 * n then b.near_n end as form_n
  from words left join best using (word)
), path(word, stop, k) as (
  select word, form, 1 from formed where form is not null
  union all
  select path.word, f.form, k + 1 from path join formed f on f.word = path.stop where f.form is not null
)
select formed.word, form, coalesce((select arg_max(stop, k) from path where path.word = formed.word), formed.word) as root, n, n_near, form_n from formed"""

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard_join": _NGRAM,
    "op3_quality_rules": _quality(),
    "op4_url_filter": _url(),
    "op5_suffix_array_dedup": _SUFFIX,
    "op6_warc": _WARC,
    "op8_chat_format": _CHAT,
    "op12_line_dedup": _LINES,
    "op13_spelling_variants": _SPELLING,
}
