"""DuckDB SQL for those queries that SQL can express over whole tables."""

from .secrets import RULES

OP2 = r"""
with w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from documents),
i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from benchmark),
iw as (
  select distinct item_id, least(len(ws), 8) m, array_to_string(ws[k:k + least(len(ws), 8) - 1], ' ') win
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 7, 1) + 1)) k from i where len(ws) > 0)),
sizes as (select distinct m from iw),
dw as (
  select doc_id, m, p, array_to_string(ws[p:p + m - 1], ' ') win
  from (select doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) p from w, sizes where len(ws) >= m)),
hit as (select doc_id, dw.m, p, item_id from dw join iw on dw.win = iw.win and dw.m = iw.m),
covered as (select doc_id, count(distinct q) n_hit from (select doc_id, unnest(range(p, p + m)) q from hit) group by doc_id),
items as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids from (select distinct doc_id, item_id::varchar item_id from hit) group by doc_id)
select w.doc_id, len(ws)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
  sha256(coalesce(ids, '')) items_sha256, coalesce(n_items, 0) >= 2 contaminated
from w left join covered using (doc_id) left join items using (doc_id)
"""

SQL: dict[str, str] = {"op2_decontaminate": OP2}

OP5 = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings
  where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
u as (select * from v where len(e) > 0 and list_dot_product(e, e) > 0),
link as (
  select a.vec_id a, b.vec_id b from u a join u b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.93),
reach as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
select e.vec_id, coalesce(n, 0)::bigint n_links, least(e.vec_id, coalesce(low, e.vec_id)) component_id, least(e.vec_id, coalesce(low, e.vec_id)) = e.vec_id kept
from embeddings e left join (select a, count(*) n from link group by a) l on l.a = e.vec_id
left join (select a, min(b) low from reach group by a) r on r.a = e.vec_id
"""

SQL["op5_embeddings"] = OP5

OP7 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from documents),
s as (
  select distinct doc_id, array_to_string(ws[k:k + least(len(ws), 5) - 1], ' ') g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) k from w where len(ws) > 0)),
n as (select doc_id, count(*) n from s group by doc_id),
p as (select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
one as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 5 * c >= 4 * (x.n + y.n - c)),
link as (select a, b from one union all select b, a from one),
reach as (select a, b from link union select r.a, l.b from reach r join link l on r.b = l.a)
select d.doc_id, least(d.doc_id, coalesce(low, d.doc_id)) class_id, coalesce(n_links, 0)::bigint n_links, least(d.doc_id, coalesce(low, d.doc_id)) = d.doc_id kept
from documents d left join (select a, count(*) n_links from link group by a) l on l.a = d.doc_id
left join (select a, min(b) low from reach group by a) r on r.a = d.doc_id
"""

SQL["op7_jaccard"] = OP7

OP8 = """
with d as (select doc_id, encode(coalesce(text, '')) b, octet_length(encode(coalesce(text, '')))::bigint n from documents),
w as (select doc_id, s, md5(b[s + 1:s + 100]) h from (select doc_id, b, unnest(range(0, n - 99)) s from d where n >= 100)),
again as (select doc_id, s from w qualify row_number() over (partition by h order by doc_id, s) > 1),
step as (select *, (s - lag(s) over (partition by doc_id order by s) <= 100) is not true fresh from again),
run as (select *, sum(fresh::int) over (partition by doc_id order by s) k from step),
gone as (select doc_id, min(s) a, max(s) + 100 z from run group by doc_id, k),
part as (
  select doc_id, coalesce(lag(z) over (partition by doc_id order by a), 0) a, a z from gone
  union all select d.doc_id, coalesce(max(z), 0), any_value(n) from d left join gone on gone.doc_id = d.doc_id group by d.doc_id),
kept as (select part.doc_id, unhex(string_agg(hex(b[a + 1:z]), '' order by a)) k from part join d on d.doc_id = part.doc_id group by part.doc_id),
sums as (select doc_id, sum(z - a)::bigint n_removed, count(*) n_spans from gone group by doc_id)
select d.doc_id, n n_bytes, coalesce(n_removed, 0)::bigint n_removed, coalesce(n_spans, 0)::bigint n_spans, sha256(k) kept_sha256
from d join kept on kept.doc_id = d.doc_id left join sums on sums.doc_id = d.doc_id
"""

SQL["op8_suffixes"] = OP8


def _found(number: int, kind: str, pattern: str, lead: int, group: int, least: int) -> str:
    """CTEs of one kind's spans (doc_id, k, kind, s, e): a match begins after the pieces and matches before it.

    lead: a group of the pattern that stands before the span, or 0; group: the one that has `least` characters or more.
    """
    size = "list_sum(list_transform({}, lambda x: len(x)))"
    before = f"len(regexp_extract(ms[i], {pattern}, {lead}))" if lead else "0"
    return f"""m{number} as (select doc_id, regexp_extract_all(t, {pattern}, 0) ms, regexp_extract_all(t, {pattern}, {group}) gs, string_split_regex(t, {pattern}) ps from d where regexp_matches(t, {pattern})),
e{number} as (
  select doc_id, {number} k, '{kind}' kind, (s + {before})::bigint s, (s + len(ms[i]))::bigint e
  from (select *, {size.format("ps[1:i]")} + coalesce({size.format("ms[1:i - 1]")}, 0) s from (select *, unnest(range(1, len(ms) + 1)) i from m{number}))
  where len(gs[i]) >= {least})"""


def _op4() -> str:
    assign = next(pattern for kind, pattern, *_ in RULES if kind == "assign")
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    kinds = [
        _found(0, "assign", quoted(assign), 0, 2, 6),
        _found(1, "access", "'AKIA[A-Z0-9]{16,}'", 0, 0, 20),
        _found(2, "hex", "'[0-9a-f]{24,}'", 0, 0, 24),
        _found(3, "pem", r"'-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----'", 0, 0, 1),
        _found(4, "jwt", r"'(^|[^A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+'", 1, 0, 1),
        _found(5, "github", "'gh[pousr]_[A-Za-z0-9]{36,}'", 0, 0, 1),
    ]
    return f"""
with d as (select doc_id, coalesce(text, '') t from documents),
{", ".join(kinds)},
e as ({" union all ".join(f"select * from e{n}" for n in range(6))}),
f as (
  select doc_id, count(*) filter (k = 0) a, count(*) filter (k = 1) b, count(*) filter (k = 2) c,
    coalesce(string_agg(kind || ':' || s || ':' || e, ',' order by s, k, e) filter (k < 3), '') base, string_agg(kind || ':' || s || ':' || e, ',' order by s, k, e) spans
  from e group by doc_id)
select d.doc_id, coalesce(a, 0)::bigint n_assign, coalesce(b, 0)::bigint n_access, coalesce(c, 0)::bigint n_hex, sha256(coalesce(base, '')) base_sha256, coalesce(spans, '') spans
from d left join f on f.doc_id = d.doc_id
"""


SQL["op4_secrets"] = _op4()
