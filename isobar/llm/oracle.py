"""DuckDB SQL of the operators that SQL can express."""

from .quality_rules import BOILERPLATE

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _count(text: str, pattern: str) -> str:
    return f"len(regexp_extract_all({text}, '{pattern}'))"


_BOILER = f"regexp_matches(x, '{BOILERPLATE}')"
_BAD = rf"""(({_count("x", "[#*$%&|<>]")} + {_count("x", "!!+")}) > 0.3 * n
    or 2 * {_count("x", r"(?:^|[\x20\x09])[|•·»>]")} >= n
    or ({_count("x", r"\p{L}")} >= 20 and {_count("x", r"\p{Lu}")} > 0.6 * {_count("x", r"\p{L}")})
    or (n >= 8 and u < 0.25 * n))"""

QUALITY_RULES = rf"""
with w as (select doc_id, coalesce(text, '') t, {_WORDS} ws from documents),
k as (select doc_id, i, array_to_string(ws[i:i + 4], ' ') k from w, unnest(range(1, len(ws) - 3)) r(i)),
c as (select doc_id, count(distinct i + j) n from (select doc_id, i, count(*) over (partition by doc_id, k) c from k), range(5) s(j) where c > 1 group by doc_id),
l as (select doc_id, x, len(ws) n, len(list_distinct(ws)) u from (select doc_id, x, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') ws from w, unnest(string_split(t, chr(10))) r(x)) where len(ws) > 0),
b as (select doc_id, count(*) n_lines, count(*) - count(distinct x) n_dup_lines, count_if({_BOILER} or {_BAD}) n_bad_lines, sum(length(x)) filter (not {_BOILER}) chars, coalesce(sum(length(x)) filter ({_BOILER}), 0) boiler, coalesce(sum(length(x)) filter (not {_BOILER} and {_BAD}), 0) lost from l group by doc_id),
f as (select doc_id, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars, {_count("t", "[#*$%&|<>]")}::bigint n_symbols, coalesce(n_dup_lines, 0)::bigint n_dup_lines, coalesce(c.n, 0)::bigint n_repeat_words,
    len(ws) < 10 or 100 * coalesce(c.n, 0) > 20 * len(ws) as base_failed, coalesce(n_lines, 0)::bigint n_lines, coalesce(n_bad_lines, 0)::bigint n_bad_lines, coalesce(chars, 0) chars, coalesce(lost, 0) lost, coalesce(boiler, 0) boiler
    from w left join c using (doc_id) left join b using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and chars > 0 and lost <= 0.5 * chars and boiler + lost <= 0.8 * (boiler + chars) as kept, n_lines, n_bad_lines from f"""

SUBSTRING_DEDUP = rf"""
with w as (select doc_id, {_WORDS} ws from documents),
k as (select doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) k from w, unnest(range(1, len(ws) - 48)) r(i)),
g as (select distinct doc_id, i + j p from (select doc_id, i, min(doc_id) over (partition by k) first from k), range(50) s(j) where first < doc_id),
r as (select doc_id, list(p) cut, count(*) n from g group by doc_id),
x as (select w.doc_id, ws, coalesce(n, 0) n, case when n is null then ws else list_filter(ws, lambda y, i: not list_contains(cut, i)) end left_words from w left join r on w.doc_id = r.doc_id)
select doc_id, len(ws)::bigint n_words, n::bigint n_removed, sha256(array_to_string(left_words, ' ')) kept_sha256 from x"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SOURCE_AUDIT = rf"""
with d as (select coalesce(lang, '') lang, coalesce(source, '') source, row_number() over () r, regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') ts from documents),
o as (select lang, source, r, t from d, unnest(ts) u(t)),
k as (select lang, t, count(*) n from o group by lang, t having count(distinct r) >= 10),
v as (select lang, count(*) v, sum(n)::hugeint n from k group by lang),
g as (select distinct lang, source from d),
c as (select o.lang, o.source, o.t, count(*) n from o join k on o.lang = k.lang and o.t = k.t group by all),
s as (select g.lang, g.source, coalesce(sum(n), 0)::hugeint n from g left join c on g.lang = c.lang and g.source = c.source group by all),
p as (select s.lang, s.source, k.t, coalesce(c.n, 0) own, 1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (s.n + 2 * v) p, 1 + (1000000000::hugeint * (k.n + 2)) // (v.n + 2 * v) q
    from s join k on s.lang = k.lang join v on s.lang = v.lang left join c on s.lang = c.lang and s.source = c.source and k.t = c.t),
a as (select x.lang, x.source, y.source item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) value from p x join p y on x.lang = y.lang and x.t = y.t and x.source <> y.source group by all),
pairs as (select x.lang, x.source, 'pair' part, y.source item, coalesce(value, 0)::bigint value from g x join g y on x.lang = y.lang and x.source <> y.source left join a on x.lang = a.lang and x.source = a.source and y.source = a.item),
terms as (select lang, source, 'term' part, t item, (((p - q) * (p - q)) // (p + q))::bigint value from p where own > 0 and p > q),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) rank from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank::integer rank from ranked where part = 'pair' or rank <= 10"""

EMBEDDING_DEDUP = """
with recursive v as (select vec_id, embedding::double[] x from embeddings where embedding is not null and len(list_filter(embedding, lambda y: y is null or not isfinite(y))) = 0 and len(list_filter(embedding, lambda y: y <> 0)) > 0),
u as (select vec_id, x, sqrt(list_sum(list_transform(x, lambda y: y * y))) norm from v),
l as (select a.vec_id a, b.vec_id b from u a join u b on a.vec_id <> b.vec_id and len(a.x) = len(b.x) and list_dot_product(a.x, b.x) / (a.norm * b.norm) >= 0.95),
r as (select vec_id a, vec_id b from embeddings union select r.a, l.b from r join l on r.b = l.a),
c as (select a vec_id, min(b) component_id from r group by a),
n as (select a vec_id, count(*) n from l group by a)
select vec_id, coalesce(n, 0)::bigint n_links, component_id, vec_id = component_id as kept from embeddings join c using (vec_id) left join n using (vec_id)"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

LEXICAL_SEARCH = rf"""
with d as (select doc_id, {_TERMS} ts from documents),
s as (select count(*)::bigint docs, sum(len(ts))::bigint total from d where len(ts) > 0),
q as (select distinct item_id, t from (select item_id, {_TERMS} ts from benchmark), unnest(ts) u(t)),
o as (select doc_id, t, len(ts)::bigint n, count(*)::bigint tf from d, unnest(ts) u(t) where t in (select t from q) group by all),
w as (select t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint w from o, s group by t, docs),
x as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total)))))::bigint score from q join o using (t) join w using (t), s group by all)
select item_id, rank::integer rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) rank from x where score > 0) where rank <= 10"""

SQL = {"op5_quality_rules": QUALITY_RULES, "op6_substring_dedup": SUBSTRING_DEDUP, "op11_source_audit": SOURCE_AUDIT, "op12_embedding_dedup": EMBEDDING_DEDUP, "op13_lexical_search": LEXICAL_SEARCH}
