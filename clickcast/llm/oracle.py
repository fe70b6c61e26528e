"""The same results as SQL for DuckDB, written apart from the operators, where SQL can express them."""

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
with sized as (
  select doc_id, source, len({WORDS.format("coalesce(text, '')")})::bigint as size, md5('17:' || coalesce(doc_id::varchar, '')) as h
  from documents),
sizes as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, 3 * source_size as cap, 1 + (row_number() over (order by source asc nulls last) - 1) % 3 as w,
    (sum(source_size) over ())::bigint as total from sizes),
-- In the order of cap over weight, a source is clamped if the share of what is left lies above its cap, and so were all before.
ordered as (
  select *, total - coalesce(sum(cap) over before, 0)::bigint as num, (sum(w) over onward)::bigint as den
  from weighed
  window before as (order by cap::hugeint * 6 / w, source rows between unbounded preceding and 1 preceding),
         onward as (order by cap::hugeint * 6 / w, source rows between current row and unbounded following)),
level as (
  select num, den from ordered where not num::hugeint * w > cap::hugeint * den
  order by cap::hugeint * 6 / w, source limit 1),
targets as (
  select o.source, source_size,
    case when l.num is null or l.num::hugeint * w > cap::hugeint * l.den then cap::double else (l.num * w)::double / l.den::double end as target
  from ordered o left join level l on true),
plan as (
  select *, case when source_size > 0 then floor(floor(target + 0.5) / source_size)::bigint else 0 end as whole from targets),
placed as (
  select s.doc_id, s.size, s.h, p.*, floor(target + 0.5)::bigint - whole * source_size as rest,
    sum(s.size) over (partition by s.source order by s.h) - sum(s.size) over (partition by s.source, s.h) as earlier,
    sum(s.size) over (partition by s.source, s.h) as alike
  from sized s join plan p on s.source is not distinct from p.source)
select doc_id, size, source_size, target,
  (size * whole + case when earlier + alike <= rest then size when earlier >= rest then 0
    else floor(size * (rest - earlier) / alike) end)::bigint as taken
from placed
"""

OP4 = f"""
with recursive texts as (
  select doc_id, {WORDS.format(_LOWER.format("coalesce(text, '')"))} as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s
  from texts),
sorted_sets as (select doc_id, list_sort(s) as k from sets where len(s) > 0),
classes as (select min(doc_id) as id, len(k) as n, k from sorted_sets group by k),
long as (select id, n, unnest(k) as shingle from classes),
-- A pair that reaches the threshold has sizes at least as near as 85 to 100.
shared as (
  select a.id as a, b.id as b, a.n as na, b.n as nb, count(*) as c
  from long a join long b on a.shingle = b.shingle and a.id < b.id and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by all),
links as (select a, b from shared where 100 * c >= 85 * (na + nb - c)),
both_ways as (select a, b from links union select b, a from links),
reached(id, root) as (
  select id, id from classes
  union
  select e.b, r.root from reached r join both_ways e on r.id = e.a where e.b > r.root),
roots as (select id, min(root) as root from reached group by id)
select t.doc_id, len(t.s)::bigint as n_shingles, coalesce(r.root, t.doc_id) as component_id, t.doc_id = coalesce(r.root, t.doc_id) as kept
from sets t left join classes c on c.k = list_sort(t.s) left join roots r on r.id = c.id
"""

_ITEM_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
OP6 = f"""
with texts as (select doc_id, {_ITEM_WORDS} as w from documents),
items as (select item_id, {_ITEM_WORDS} as w from benchmark),
windows as (
  select distinct item_id, len(part) as n, array_to_string(part, ' ') as win
  from (select item_id, unnest(case when len(w) = 0 then [] when len(w) <= 10 then [w]
    else list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) end) as part from items)),
lengths as (select distinct n from windows),
doc_windows as (
  select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, w from texts, lengths where len(w) >= n),
found as (
  select d.doc_id, d.i, d.n, x.item_id from doc_windows d join windows x on x.n = d.n and x.win = array_to_string(d.w[d.i:d.i + d.n - 1], ' ')),
hit as (select doc_id, count(distinct p)::bigint as n_hit from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
listed as (
  select doc_id, count(*)::bigint as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select t.doc_id, len(t.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from texts t left join hit using (doc_id) left join listed using (doc_id)
"""

OP8 = """
with known as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
targets as (select *, max(page_id) over (partition by payload_digest) as target from known)
select page_id, payload_bytes, payload_digest, case when revisit then 'revisit' else 'response' end as record_type,
  case when revisit then target end as refers_to
from (select *, coalesce(payload_bytes >= 1000 and page_id < target, false) as revisit from targets)
"""

# The CRC-32 of the numbers 0 to 15, as four bits.
_NIBBLES = (
    0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
    0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C,
)


def crc32(text: str) -> str:
    """The CRC-32 of a text's UTF-8 bytes, folded four bits at a time."""
    table = "[" + ", ".join(f"{x}::bigint" for x in _NIBBLES) + "]"
    half = lambda x: f"xor(({x}) >> 4, {table}[(({x}) & 15) + 1])"
    octets = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda x: ('0x' || x)::bigint)"
    return f"xor(4294967295::bigint, list_reduce({octets}, lambda c, v: {half(half('xor(c, v)'))}, 4294967295::bigint))"


# Every pair of equal words at most a third of the text apart; unbroken rows of such pairs at one distance are stretches.
OP11 = f"""
with texts as (
  select doc_id, w, len(w) as n, {crc32("coalesce(doc_id::varchar, '')")} as h
  from (select doc_id, {WORDS.format("coalesce(text, '')")} as w from documents)),
placed as (
  select *, (h // 10) % greatest(n, 1) as a, 3 + (h // 10) % 8 as d from texts),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) - 1 as i from texts),
moved as (
  select doc_id, n, i, case when h % 10 = 0 and i >= a then a + (i - a) % (1 + (n - a) // d) else i end as old
  from (select *, unnest(range(n)) as i from placed)),
changed as (select m.doc_id, m.n, m.i, t.word from moved m join words t on t.doc_id = m.doc_id and t.i = m.old),
pairs as (
  select x.doc_id, x.i, y.i - x.i as q from changed x join changed y
  on x.doc_id = y.doc_id and x.word = y.word and y.i > x.i and 3 * (y.i - x.i) <= x.n),
stretches as (
  select doc_id, q, min(i) as start, count(*) + q as length
  from (select *, i - row_number() over (partition by doc_id, q order by i) as island from pairs)
  group by doc_id, q, island having count(*) + q >= greatest(24, 3 * q)),
runs as (select doc_id, start, length, min(q) as period from stretches group by all),
listed as (
  select doc_id, count(*) as n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as l
  from runs group by doc_id),
best as (
  select * from runs
  qualify row_number() over (partition by doc_id order by length::double / period desc, start, period) = 1),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as l from changed c
  where not exists (select 1 from runs r where r.doc_id = c.doc_id and c.i >= r.start + r.period and c.i < r.start + r.length)
  group by doc_id)
select t.doc_id, coalesce(n_runs, 0)::bigint as n_runs, b.start::bigint as start, b.length::bigint as length, b.period::bigint as period,
  (1000 * b.length // b.period)::bigint as exponent_milli, sha256(coalesce(l.l, '')) as runs_sha256, sha256(coalesce(k.l, '')) as collapsed_sha256
from texts t left join listed l using (doc_id) left join best b using (doc_id) left join kept k using (doc_id)
"""


def _cheapest(*options: str) -> str:
    """Of edits as ``cost, letters, rows`` the cheapest, then the one whose letters come first."""
    return f"list_min([{', '.join(options)}])"


def _repair_step() -> str:
    """The best way to finish from each of four states, before a row ``o`` given those behind it, or before an insertion."""
    role, to = ("user", "user", "assistant", "user"), (3, 3, 4, 3)
    kept = {1: {"s": 2, "u": 3}, 2: {"u": 3}, 3: {"a": 4}, 4: {"u": 3}}

    def edit(cost: str, letter: str, line: str, state: int) -> str:
        return f"{{'c': {cost} + v[{state}].c, 't': '{letter}' || v[{state}].t, 'r': {line} || v[{state}].r}}"

    insert, row = [], []
    for q in range(1, 5):
        i = q - 1
        insert.append(_cheapest(f"v[{q}]", edit("5", "I", f"'{role[i]}:' || chr(10)", to[i])))
        options = [edit("2", "D", "''", q)]
        extra = "(case when o[1].c = 2 then 5 else 0 end)"
        for initial, state in kept[q].items():
            keep = edit(extra, "K", "o[1].t || ':' || o[1].r || chr(10)", state)
            options.append(f"case when o[1].c <> 1 and left(o[1].t, 1) = '{initial}' then {keep} else {edit('2', 'D', chr(39) * 2, q)} end")
        turn = edit(f"1 + {extra}", "R", f"'{role[i]}:' || o[1].r || chr(10)", to[i])
        options.append(f"case when o[1].c <> 1 then {turn} else {edit('2', 'D', chr(39) * 2, q)} end")
        row.append(_cheapest(*options))
    return f"case when o[1].c = 0 then [{', '.join(insert)}] else [{', '.join(row)}] end"


_INSERT = "[{'c': 0::bigint, 't': '', 'r': ''}]"
_END = ", ".join(
    f"{{'c': {c}::bigint, 't': '{t}', 'r': {r}}}"
    for c, t, r in (
        (0, "", "''"),
        (10, "II", "'user:' || chr(10) || 'assistant:' || chr(10)"),
        (5, "I", "'assistant:' || chr(10)"),
        (0, "", "''"),
    )
)

# Each conversation is folded from its last row to its first; two insertions between rows reach every state.
OP12 = f"""
with hashed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {crc32("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as h
  from conversations),
damaged as (
  select conv_id, turn, case when h = 4 then 'user' else role end as role,
    case when h = 1 then '' when h = 2 then translate(text, '.!?', '') else text end as text,
    unnest(range(case when h = 0 then 0 when h = 3 then 2 else 1 end)) as copy
  from hashed),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as place from damaged),
marked as (
  select *, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
    row_number() over (partition by conv_id, role, text order by place) > 1 as again,
    not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') as cut,
    left(lag(role) over (partition by conv_id order by place), 1) || left(role, 1) as meet
  from ordered),
folded as (
  select conv_id, max(turn) - min(turn) + 1 - count(distinct turn) as gaps, count_if(blank) as blank, count_if(not blank and again) as duplicate,
    count_if(not blank and not again and cut) as truncated, count_if(meet not in ('su', 'ua', 'au')) as illegal,
    list_reduce(
      flatten(list([{_INSERT}, {_INSERT}, [{{'c': (case when blank or again then 1 when cut then 2 else 3 end)::bigint, 't': role, 'r': text}}]]
        order by place desc)) || [{_INSERT}, {_INSERT}],
      lambda v, o: {_repair_step()}, [{_END}])[1] as best
  from marked group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(best.c, 0)::bigint as cost,
  coalesce(best.t, '') as audit, sha256(case when best.r <> '' then left(best.r, length(best.r) - 1) else '' end) as repaired_sha256
from (select distinct conv_id from conversations) c left join folded f on f.conv_id is not distinct from c.conv_id
"""

OP13 = f"""
with sized as (
  select doc_id, octet_length(encode(coalesce(text, ''))) + 1 as size, {crc32("coalesce(text, '')")} as text_crc32,
    md5(coalesce(text, '')) as k, md5(coalesce(doc_id::varchar, '')) as l
  from documents),
placed as (
  select *, (sum(size) over (order by k, l rows unbounded preceding) - size) * 16 // sum(size) over () as shard from sized)
select doc_id, size::bigint as size, text_crc32, 'bytes' as law, shard::int as shard,
  row_number() over (partition by shard order by k, l) - 1 as slot, null::int as grown_shard
from placed
"""

ORACLE = {
    "op3_mixing": OP3,
    "op4_minhash": OP4,
    "op6_decontaminate": OP6,
    "op8_warc": OP8,
    "op11_runs": OP11,
    "op12_conversations": OP12,
    "op13_shards": OP13,
}
