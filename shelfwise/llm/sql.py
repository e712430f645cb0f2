"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from shelfwise.llm import secrets

_WHITE = r"\x20\x09-\x0D"
_CONTROL = r"<\\*(s>|/s>|<SYS>>|\|role\|>|\|body\|>)|\[\\*(INST\]|/INST\])"

OP2 = rf"""with t as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^{_WHITE}]+') as w from documents),
n as (select doc_id, text, w, len(w) as n_words, length(regexp_replace(text, '[{_WHITE}]', '', 'g')) as word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as n_symbols,
  length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) as n_digits, len(list_distinct(w)) as n_distinct from t),
l as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup,
  count(*) filter (where regexp_matches(line, '(\.\.\.|…)[{_WHITE}]*$')) as n_open
  from (select doc_id, unnest(string_split(text, chr(10))) as line from t) x where regexp_matches(line, '[^{_WHITE}]') group by doc_id),
g as (select doc_id, p, array_to_string(list_slice(w, p, p + 4), ' ') as gram
  from (select doc_id, w, unnest(range(1, len(w) - 3)) as p from t where len(w) >= 5) x),
twice as (select doc_id, gram from g group by doc_id, gram having count(*) > 1),
rep as (select doc_id, count(distinct p + k) as n_repeat from g join twice using (doc_id, gram)
  cross join (select unnest(range(0, 5)) as k) ks group by doc_id),
a as (select n.*, coalesce(l.n_lines, 0) as n_lines, coalesce(l.n_dup, 0) as n_dup, coalesce(l.n_open, 0) as n_open,
  coalesce(rep.n_repeat, 0) as n_repeat from n left join l on l.doc_id = n.doc_id left join rep on rep.doc_id = n.doc_id),
b as (select *, n_words < 10 or 100 * n_repeat > 20 * n_words as base_failed from a)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
  cast(n_dup as bigint) as n_dup_lines, cast(n_repeat as bigint) as n_repeat_words, base_failed,
  not (base_failed or word_chars < 2 * n_words or word_chars > 12 * n_words or 10 * n_symbols > 3 * n_words or 10 * n_dup > 6 * n_lines
    or 2 * n_digits > word_chars or (n_words >= 20 and 10 * n_distinct < least(n_words, 400))
    or (n_lines >= 5 and 10 * n_open > 3 * n_lines)) as kept
from b"""

OP3 = rf"""with recursive t as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^{_WHITE}]+') as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, p, p + 4), ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as p from t where len(w) >= 1) x),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as m from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (select x, y from c join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 10 * m >= 8 * (nx.n + ny.n - m)),
reach as (select x, y from links union select r.x, l.y from reach r join links l on l.x = r.y)
select d.doc_id, coalesce(k.n_links, 0) as n_links, least(d.doc_id, coalesce(r.low, d.doc_id)) as class_id,
  least(d.doc_id, coalesce(r.low, d.doc_id)) = d.doc_id as kept
from documents d left join (select x, count(*) as n_links from links group by x) k on k.x = d.doc_id
left join (select x, min(y) as low from reach group by x) r on r.x = d.doc_id"""

OP6 = rf"""with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) as pos from documents),
k as (select doc_id, line, pos, translate(regexp_replace(regexp_replace(line, '^[{_WHITE}]+', ''), '[{_WHITE}]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key, max(doc_id) as last from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
m as (select k.doc_id, k.line, k.pos, f.key is not null and k.doc_id <> f.last as gone from k left join f on f.key = k.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from m group by doc_id"""

OP8 = rf"""with c as (select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
h as (select *, case role when 'user' then 6 when 'assistant' then 7 when 'system' then 7
    else 16 + length(role) + len(regexp_extract_all(role, '{_CONTROL}')) end
  + length(text) + len(regexp_extract_all(text, '{_CONTROL}')) + 4 as chars from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(3 + sum(chars) as bigint) as formatted_chars
from h group by conv_id"""

OP10 = """with recursive e as (select vec_id, label, cast(embedding as double[]) as v from embeddings where embedding is not null and label is not null),
g as (select vec_id, label, v, sqrt(list_dot_product(v, v)) as len from e
  where len(v) > 0 and list_count(v) = len(v) and isfinite(list_dot_product(v, v))),
links as (select a.vec_id as x, b.vec_id as y from g a join g b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where a.len > 0 and b.len > 0 and list_dot_product(a.v, b.v) / (a.len * b.len) >= 0.93),
reach as (select x, y from links union select r.x, l.y from reach r join links l on l.x = r.y)
select d.vec_id, coalesce(k.n_links, 0) as n_links, least(d.vec_id, coalesce(r.low, d.vec_id)) as component_id,
  least(d.vec_id, coalesce(r.low, d.vec_id)) = d.vec_id as kept
from embeddings d left join (select x, count(*) as n_links from links group by x) k on k.x = d.vec_id
left join (select x, min(y) as low from reach group by x) r on r.x = d.vec_id"""

OP11 = r"""with t as (select coalesce(lang, 'und') as lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents),
p as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w
  from (select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from t) x),
q as (select lang, w, unnest(range(1, len(w) + 1)) as i from p where len(w) > 0),
g as (select lang, s, array_to_string(list_slice(w, i, i + s - 1), ' ') as phrase
  from q cross join (select unnest(range(1, 6)) as s) z where i + s - 1 <= len(w)),
f as (select lang, phrase, s, count(*) as f from g group by lang, phrase, s),
n as (select lang, cast(sum(f) as bigint) as n from f where s = 1 group by lang),
c as (select lang, phrase, s, f as a, string_split(phrase, ' ') as w from f where s > 1 and f >= 100),
parts as (select lang, w, s, a, i, unnest(range(i + 1, s + 1)) as j from (select lang, w, s, a, unnest(range(1, s)) as i from c) x),
gone as (select distinct parts.lang, c.phrase from parts join c on c.lang = parts.lang
  and c.phrase = array_to_string(list_slice(parts.w, i, j), ' ') where j - i + 1 < parts.s and 100 * parts.a >= 100 * c.a),
cuts as (select lang, phrase, w, s, a, unnest(range(1, s)) as k from c),
scored as (select cuts.lang, cuts.phrase, a, x.f as l, y.f as r, n, k,
  cast((1000 * cast(a as hugeint) * n) // (cast(x.f as hugeint) * y.f) as bigint) as score
  from cuts join n on n.lang = cuts.lang join f x on x.lang = cuts.lang and x.phrase = array_to_string(list_slice(w, 1, k), ' ')
  join f y on y.lang = cuts.lang and y.phrase = array_to_string(list_slice(w, k + 1, cuts.s), ' ')),
best as (select * from (select *, row_number() over (partition by lang, phrase order by score, k) as nr from scored) x where nr = 1),
ranked as (select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
  from best anti join gone using (lang, phrase))
select * from ranked where rank <= 2000"""


def _found(kind: str, rank: int, pattern: str, group: int = 0, keep: str = "true") -> str:
    """Rows (doc_id, kind, rank, start, stop, found) of the leftmost matches that do not overlap."""
    p = pattern.replace("'", "''")
    return f"""select doc_id, '{kind}' as kind, {rank} as rank, stop - length(whole) as start, stop, found from (
  select *, cast(sum(length(gap) + length(whole)) over (partition by doc_id order by i) as bigint) as stop from (
    select doc_id, unnest(whole) as whole, unnest(found) as found, unnest(list_slice(gap, 1, len(whole))) as gap, unnest(range(1, len(whole) + 1)) as i
    from (select doc_id, regexp_extract_all(text, '{p}', 0) as whole, regexp_extract_all(text, '{p}', {group}) as found,
      string_split_regex(text, '{p}') as gap from d where regexp_matches(text, '{p}')) x) y) z where {keep}"""


def _entropy(a: secrets.Alphabet, rank: int, at: str) -> tuple[str, str]:
    """(common table expressions, name) of an alphabet's spans: every window is counted on its own."""
    allowed = secrets.ALLOWED.replace("'", "''")
    keep = (f"not regexp_matches(found, '{allowed}') and regexp_matches(found, '[A-Za-z]')"
            " and (regexp_matches(found, '[0-9]') or regexp_matches(found, '[a-z][A-Z]|[A-Z]{2}[a-z]'))")
    units = ", ".join(map(str, secrets.entropy_units(a.window)))
    return f"""{at}c as ({_found(a.kind, rank, f"{a.chars}{{{a.window},}}", 0, keep)}),
{at}w as (select doc_id, kind, rank, start, found, unnest(range({a.window}, length(found) + 1)) as e from {at}c),
{at}n as (select doc_id, kind, rank, start, e, ch, count(*) as n
  from (select *, substr(found, cast(e - o as int), 1) as ch from {at}w cross join (select unnest(range(0, {a.window})) as o) z) x
  group by doc_id, kind, rank, start, e, ch),
{at}h as (select doc_id, kind, rank, start, e from {at}n group by doc_id, kind, rank, start, e
  having sum(list_extract([{units}], cast(n + 1 as int))) <= {secrets.entropy_limit(a)}),
{at}i as (select *, case when e - lag(e) over w <= {a.window} then 0 else 1 end as opens from {at}h
  window w as (partition by doc_id, start order by e)),
{at}g as (select *, sum(opens) over (partition by doc_id, start order by e) as island from {at}i),
{at}s as (select doc_id, kind, rank, start + min(e) - {a.window} as start, start + max(e) as stop from {at}g
  group by doc_id, kind, rank, start, island)""", f"{at}s"


_SPANS = [_entropy(a, 3 + i, f"e{i}") for i, a in enumerate(secrets.ALPHABETS)]
OP13 = f"""with d as (select doc_id, coalesce(text, '') as text from documents),
b as ({_found("assign", 0, secrets.ASSIGN, 2, f"length(found) >= {secrets.ASSIGN_CHARS}")}
  union all {_found("access", 1, "AKIA[A-Z0-9]+", 0, "length(found) >= 18")}
  union all {_found("hex", 2, "[0-9a-f]+", 0, "length(found) >= 16")}),
{", ".join(text for text, _ in _SPANS)},
s as (select doc_id, kind, rank, start, stop from b {" ".join(f"union all select doc_id, kind, rank, start, stop from {name}" for _, name in _SPANS)}),
x as (select doc_id, count(*) filter (where rank = 0) as n_assign, count(*) filter (where rank = 1) as n_access,
  count(*) filter (where rank = 2) as n_hex,
  string_agg(concat(kind, ':', start, ':', stop), ',' order by start, rank) filter (where rank < 3) as base,
  string_agg(concat(kind, ':', start, ':', stop), ',' order by start, rank) as spans from s group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
  sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join x on x.doc_id = d.doc_id"""

ORACLES = {"op2_quality_rules": OP2, "op3_ngram_jaccard": OP3, "op6_line_dedup": OP6, "op8_chat_format": OP8,
           "op10_embedding_near_dedup": OP10, "op11_collocations": OP11, "op13_secret_scan": OP13}
