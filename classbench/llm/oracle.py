"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from classbench.llm.pii import AFTER, BEFORE, KINDS, OCTET

#: The same languages as :data:`classbench.llm.pii.KINDS`, without Java's possessive loops and look-behind.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "card": r"[0-9](?:[\x20-]?[0-9])+",
         "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"}
VALID = {
    "email": "true",
    "ip": rf"regexp_full_match(m, '{OCTET}(?:\.{OCTET}){{3}}')",
    "card": "length(d) between 14 and 19 and list_sum([case when i % 2 = 1 then cast(reverse(d)[i] as int) "
            "else 2 * cast(reverse(d)[i] as int) - case when cast(reverse(d)[i] as int) > 4 then 9 else 0 end end "
            "for i in range(1, length(d) + 1)]) % 10 = 0",
    "phone": "length(d) between 10 and 15",
    "iban": "length(b) between 15 and 34 and list_reduce(list_prepend(0, [case when c between '0' and '9' then cast(c as int) "
            "else ascii(c) - 55 end for c in string_split(b[5:] || b[1:4], '')]), "
            "lambda acc, v: (acc * case when v > 9 then 100 else 10 end + v) % 97) = 1",
    "ssn": "near",
}


def pii_sql() -> str:
    kinds = []
    for rank, k in enumerate(KINDS):
        pattern = PLAIN.get(k.name, k.pattern).replace("'", "''")
        kinds.append(f"""
    select doc_id, {rank} as kind_rank, '{k.name}' as kind, s as start, s + length(m) as stop from (
        select *, regexp_replace(m, '[^0-9]', '', 'g') as d, replace(m, ' ', '') as b,
               regexp_matches(right(g[i], {BEFORE}), '{k.context}') or regexp_matches(left(g[i + 1], {AFTER}), '{k.context}') as near
        from (select doc_id, i, ms[i] as m, g,
                     coalesce(list_sum([length(x) for x in g[1:i]]), 0) + coalesce(list_sum([length(x) for x in ms[1:i - 1]]), 0) as s
              from (select doc_id, ms, g, unnest(range(1, len(ms) + 1)) as i
                    from (select doc_id, regexp_extract_all(t, '{pattern}') as ms, string_split_regex(t, '{pattern}') as g from texts))))
    where {VALID[k.name]}""")
    item = "kind || ':' || cast(start as bigint) || ':' || cast(stop as bigint)"
    base = tuple(k.name for k in KINDS if k.base)
    counts = ", ".join(f"cast(count(*) filter (where kind = '{k}') as bigint) as n_{k}" for k in base)
    listed = f"coalesce(string_agg({item}, ',' order by start, kind_rank){{0}}, '')".format
    where = f" filter (where kind in {base})"
    return f"""
with texts as (select doc_id, coalesce(text, '') as t from documents),
spans as ({" union all ".join(kinds)})
select d.doc_id, {counts}, sha256({listed(where)}) as base_sha256, {listed("")} as spans
from documents d left join spans s on s.doc_id = d.doc_id group by d.doc_id"""


WARC_SQL = """
with p as (select page_id, encode(coalesce(html, '')) as payload from pages),
q as (select page_id, octet_length(payload) as n, sha1(payload) as digest from p),
r as (select *, max(page_id) over (partition by digest) as holder from q)
select page_id, cast(n as bigint) as payload_bytes, digest as payload_digest,
       case when n >= 1000 and page_id <> holder then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id <> holder then holder end as refers_to
from r"""


def _crc_nibbles() -> str:
    """CRC-32 remainders of the sixteen half bytes, from the polynomial."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return "[" + ", ".join(f"{v}::bigint" for v in table) + "]"


VARIANTS_SQL = f"""
with recursive runs as (
    select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low
    from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) as run from documents) where length(run) >= 6),
once as (select doc_id, low, count(*) as k from runs group by all),
hashed as (select low, k, coalesce(cast(doc_id as varchar), '') || ':' || low as keyed,
                  string_split(lower(hex(encode(coalesce(cast(doc_id as varchar), '') || ':' || low))), '') as x from once),
sums as (select low, k, xor(list_reduce(list_prepend(4294967295::bigint,
             list_transform(range(1, len(x) + 1), lambda i: instr('123456789abcdef', x[i + 2 * (i % 2) - 1]))),
             lambda acc, v: xor(acc >> 4, ({_crc_nibbles()})[(xor(acc, v) & 15) + 1])), 4294967295::bigint) as h from hashed),
words as materialized (
    select word, cast(sum(k) as bigint) as n
    from (select k, case when h % 199 = 0 then left(low, cast(h % length(low) as int)) || substr(low, cast(h % length(low) as int) + 2)
                         else low end as word from sums)
    where length(word) >= 6 group by word having sum(k) >= 5),
less as materialized (
    select word, n, p, left(word, cast(p as int) - 1) || substr(word, cast(p as int) + 1) as rest
    from (select word, n, unnest(range(1, length(word) + 1)) as p from words)),
pairs as (
    select a.word, b.word as near from less a join less b on a.p = b.p and a.rest = b.rest and a.word <> b.word
    union select l.word, w.word from less l join words w on l.rest = w.word
    union select w.word, l.word from less l join words w on l.rest = w.word),
best as materialized (
    select p.word, count(*) as n_near, first(p.near order by w.n desc, p.near) as near, max(w.n) as top
    from pairs p join words w on w.word = p.near group by p.word),
formed as materialized (
    select w.word, w.n, coalesce(b.n_near, 0) as n_near, case when b.top >= 5 * w.n then b.near end as form,
           case when b.top >= 5 * w.n then b.top end as form_n
    from words w left join best b on b.word = w.word),
chain as (
    select word, word as at, form from formed
    union all select c.word, f.word, f.form from chain c join formed f on f.word = c.form)
select f.word, f.form, c.at as root, f.n, cast(f.n_near as bigint) as n_near, cast(f.form_n as bigint) as form_n
from formed f join chain c on c.word = f.word and c.form is null"""
