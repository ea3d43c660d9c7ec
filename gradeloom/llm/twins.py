"""DuckDB twins of the registered queries, where SQL can state them."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_QUALITY = rf"""
with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_WORDS}') as w from documents),
spots as (select doc_id, len(w) as n, unnest(range(1, len(w) - 6)) as i, w from t where len(w) >= 8),
windows as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as x from spots),
often as (select doc_id, i from windows qualify count(*) over (partition by doc_id, x) > 1),
covered as (select doc_id, count(distinct i + k) as n from often, range(8) as r(k) group by doc_id),
lines as (select doc_id, unnest(string_split(text, chr(10))) as line from t),
line_counts as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from lines where regexp_matches(line, '{_WORDS}') group by doc_id),
c as (
  select t.doc_id, len(w) as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(l.n_dup_lines, 0) as n_dup_lines,
    coalesce(v.n, 0) as n_repeat_words, coalesce(l.n_lines, 0) as n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_upper,
    length(regexp_replace(text, '[^A-Za-z]', '', 'g')) as n_letters, len(list_distinct(w)) as n_distinct
  from t left join covered v on t.doc_id = v.doc_id left join line_counts l on t.doc_id = l.doc_id)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup_lines as bigint) as n_dup_lines, cast(n_repeat_words as bigint) as n_repeat_words,
  (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words or 100 * n_symbols > 5 * word_chars or 100 * n_dup_lines > 50 * n_lines
    or 100 * n_upper > 60 * n_letters or n_words > n_distinct * n_distinct or 2 * n_words > word_chars) as kept
from c
"""

_NEAR = rf"""
with recursive t as (select doc_id, regexp_extract_all({_LOWER}, '{_WORDS}') as w from documents),
spots as (select doc_id, w, unnest(case when len(w) = 0 then [] when len(w) < 4 then [1] else range(1, len(w) - 2) end) as i from t),
s as (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as x from spots),
n as (select t.doc_id, count(x) as n from t left join s using (doc_id) group by t.doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id <> b.doc_id group by all),
links as (select a, b from common join n p on p.doc_id = a join n q on q.doc_id = b where 100 * c >= 80 * (p.n + q.n - c)),
reach as (select doc_id, doc_id as root from t union select l.b, r.root from reach r join links l on l.a = r.doc_id)
select n.doc_id, cast(max(n.n) as bigint) as n_shingles, min(root) as component_id, min(root) = n.doc_id as kept
from n join reach r on r.doc_id = n.doc_id group by n.doc_id
"""

_CHAT = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
t as (select *, lag(role) over (partition by conv_id order by turn, role, text) as before, row_number() over (partition by conv_id order by turn desc, role desc, text desc) as back from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(24 + length(role) + length(text) + len(regexp_extract_all(text, '<\\*\|'))) as bigint) as formatted_chars,
  bool_and(coalesce(before, 'start') || '>' || role in ('start>system', 'start>user', 'system>user', 'user>assistant', 'assistant>user', 'assistant>tool', 'tool>assistant'))
    and bool_or(back = 1 and role = 'assistant') as valid
from t group by conv_id
"""

_DIVERGENCE = r"""
with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w,
    row_number() over () as row from documents),
groups as (select distinct lang, source from d),
words as (select lang, source, row, unnest(w) as term from d),
kept as (select lang, term from words group by lang, term having count(distinct row) >= 30),
counts as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by all),
langs as (select lang, count(*) as v from kept group by lang),
cells as (select g.lang, g.source, k.term, coalesce(c.n, 0) as n from groups g join kept k using (lang) left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
totals as (select lang, source, sum(n) as total from cells group by all),
lang_counts as (select lang, term, sum(n) as n from counts group by all),
lang_totals as (select lang, sum(n) as total from lang_counts group by lang),
q as (select lang, term, cast(1 + (1000000000 * (n::hugeint + 5)) // (total::hugeint + 5 * v) as bigint) as q from lang_counts join lang_totals using (lang) join langs using (lang)),
p as (select lang, source, term, n, cast(1 + (1000000000 * (n::hugeint + 5)) // (total::hugeint + 5 * v) as bigint) as p from cells join totals using (lang, source) join langs using (lang)),
distance as (select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(value, 0) as bigint) as value from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join distance x on x.lang = a.lang and x.source = a.source and x.item = b.source),
terms as (select lang, source, 'term' as part, term as item, p - q as value from p join q using (lang, term) where n > 0 and p > q),
ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, encode(item)) as integer) as rank from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""

_EMBEDDINGS = """
with recursive v as (select vec_id, cast(embedding as double[]) as x from embeddings),
w as (select * from v where x is not null and len(list_filter(x, lambda c: c is null or not isfinite(c))) = 0 and len(list_filter(x, lambda c: c <> 0)) > 0),
links as (select a.vec_id as a, b.vec_id as b from w a join w b on a.vec_id <> b.vec_id and len(a.x) = len(b.x) where list_cosine_similarity(a.x, b.x) >= 0.9),
reach as (select vec_id, vec_id as root from v union select l.b, r.root from reach r join links l on l.a = r.vec_id),
n as (select a as vec_id, count(*) as n_links from links group by a)
select r.vec_id, coalesce(max(n_links), 0) as n_links, min(root) as component_id, min(root) = r.vec_id as kept
from reach r left join n on n.vec_id = r.vec_id group by r.vec_id
"""

TWINS = {
    "op2_chat_format": _CHAT,
    "op1_quality_rules": _QUALITY,
    "op4_near_duplicates": _NEAR,
    "op12_embedding_copies": _EMBEDDINGS,
    "op13_source_divergence": _DIVERGENCE,
}
