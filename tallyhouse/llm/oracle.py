"""The queries that SQL can express, over the same tables, for DuckDB.

The others can't be: they need a trained model (1, 5), a tokenizer's merges (6, 7), hash functions
that the database lacks (3, 8) or a tree's likeness (4). tests/llm hold those against brute force.
"""

from __future__ import annotations

from tallyhouse.llm.chat_format import CONTROLS, END, TURN
from tallyhouse.llm.quality_rules import BASE, CURRENT, POLICIES, RULES, mask

WORD = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
with docs as (
  select row_number() over () as n, doc_id, coalesce(text, '') as text from documents),
parts as (
  select n, doc_id, text, regexp_extract_all(text, '{WORD}') as words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines
  from docs),
windows as (
  select n, i, array_to_string(words[i:i + 7], ' ') as eight
  from parts, unnest(range(1, len(words) - 6)) as t(i)),
twice as (
  select n, i from windows qualify count(*) over (partition by n, eight) > 1),
inside as (
  select n, count(distinct i + k) as n_repeat_words
  from twice, unnest(range(8)) as t(k) group by n),
measured as (
  select doc_id, len(words)::bigint as n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
         (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         len(lines)::bigint as n_lines,
         len(list_filter(words, lambda w: upper(w) = w and lower(w) <> w))::bigint as n_upper_words
  from parts left join inside using (n)),
judged as (
  select *, {" + ".join(f"if({rule}, {1 << i}, 0)" for i, rule in enumerate(RULES.values()))} as failed
  from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & {mask(BASE)} <> 0 as base_failed, failed & {mask(POLICIES[CURRENT])} = 0 as kept,
       failed::bigint as failed
from judged"""


def _quoted(control: str) -> str:
    return "".join("\\" + c if c in r"\|[]" else c for c in control)


_HARM = "|".join([r"\\", *map(_quoted, CONTROLS)])
_ROLE_HARM = "|".join([r"\\", "\n", *map(_quoted, CONTROLS)])

CHAT = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
         as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text)
                       filter (role = 'assistant'), '')) as loss_sha256,
       sum({len(TURN) + len(END) + 2} + length(role) + length(text)
           + len(regexp_extract_all(role, '{_ROLE_HARM}'))
           + len(regexp_extract_all(text, '{_HARM}')))::bigint as formatted_chars
from turns group by conv_id"""

REPEATS = """
with docs as (
  select row_number() over (order by doc_id nulls last, text nulls first) as n, doc_id,
         hex(encode(coalesce(text, ''))) as h
  from documents),
strings as (
  select n, x.i as i, x.s as s from (
    select n, unnest(list_transform(range(0, length(h) // 2 - 99),
                                    lambda i: {'i': i, 's': substr(h, 2 * i + 1, 200)})) as x
    from docs)),
repeats as (
  select n, i from strings qualify row_number() over (partition by s order by n, i) > 1),
marked as (
  select n, i, i > coalesce(lag(i) over (partition by n order by i) + 100, -1) as opens
  from repeats),
numbered as (
  select n, i, sum(opens::int) over (partition by n order by i) as run from marked),
spans as (
  select n, run, min(i) as first, max(i) + 100 as stop from numbered group by n, run),
gaps as (
  select n, first, stop, coalesce(lag(stop) over (partition by n order by first), 0) as open
  from spans),
gone as (
  select n, sum(stop - first) as n_removed, count(*) as n_spans, max(stop) as last,
         string_agg(substr(h, 2 * open + 1, 2 * (first - open)), '' order by first) as kept
  from gaps join docs using (n) group by n)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) as kept_sha256
from docs left join gone using (n)"""

NEGATIVES = """
with rows as (
  select row_number() over () as n, vec_id::bigint as vec_id, label, embedding from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
vectors as (
  select n, vec_id, if(coalesce(vec_id % 7 = 0, false), (label + 1) % 10, label)::bigint as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as whole
  from rows),
anchors as (select * from vectors where vec_id % 100 = 0),
scored as (
  select a.n as anchor, a.vec_id as anchor_id, v.vec_id as id, a.label = v.label as same,
         list_sum(list_transform(list_zip(a.whole, v.whole),
                                 lambda x: coalesce(x[1], 0) * coalesce(x[2], 0)))::bigint as score
  from anchors a join vectors v on a.n <> v.n),
near as (
  select anchor, anchor_id, id as positive_id, score as positive_score,
         row_number() over (partition by anchor order by score desc, id nulls last) as place
  from scored where same qualify place <= 5)
select near.anchor_id, positive_id,
       row_number() over (partition by anchor, place order by score desc, id nulls last)::int as rank,
       id as negative_id, positive_score, score as negative_score
from near join scored using (anchor)
where not same and 80 * positive_score <= 100 * score and score <= positive_score
qualify rank <= 5"""

_CRC = """xor(list_reduce(
    list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''),
                                                    lambda c: ascii(c)::bigint)),
    lambda held, byte: list_reduce(
      list_prepend(xor(held, byte), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]),
      lambda x, y: if(x % 2 = 1, xor(x // 2, 3988292384), x // 2))), 4294967295)"""

TRIE = f"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''),
                            coalesce(text, '')) - 1 as place
  from conversations where conv_id is not null),
own as (
  select conv_id, count(*) as own, {_CRC} % 4 as h, conv_id - conv_id % 20 as donor
  from turns group by conv_id),
convs as (
  select a.*, least(a.h, coalesce(d.own, 0)) as taken
  from own a left join own d on d.conv_id = a.donor),
items as (
  select conv_id, place - h + taken as i, role, text
  from turns join convs using (conv_id) where place >= h
  union all
  select c.conv_id, place, role, text
  from turns t join convs c on t.conv_id = c.donor where place < h),
digests as (
  select conv_id, i, md5(length(role)::varchar || ':' || role || text) as digest,
         len(regexp_extract_all(text, '{WORD}')) as words
  from items),
lists as (
  select conv_id, list(digest order by i) as digests, list(words order by i) as words
  from digests group by conv_id),
every as (
  select conv_id, coalesce(digests, []) as digests, coalesce(words, []) as words
  from convs left join lists using (conv_id)),
prefixes as (
  select conv_id, d, len(digests) as length, coalesce(words[d], 0) as words,
         md5(array_to_string(digests[:d], ',')) as node
  from every, unnest(range(len(digests) + 1)) as t(d)),
nodes as (
  select d, node, min(conv_id) as conv_id, count(*) as n_convs, any_value(words) as words,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (length = d), ''))
           as ends_sha256
  from prefixes group by d, node),
parents as (
  select n.d, n.node, p.node as parent
  from nodes n join prefixes p on p.conv_id = n.conv_id and p.d = n.d - 1),
children as (select d - 1 as d, parent as node, count(*) as n_children from parents group by all),
sums as (
  select p.d, p.node, count(*) filter (n_children is null) as n_leaves,
         sum((n.n_convs - 1) * n.words) as saved_tokens
  from nodes n left join children using (d, node)
  join prefixes p on p.conv_id = n.conv_id and p.d <= n.d
  group by all)
select n.conv_id::bigint as conv_id, n.d::bigint as depth, p.conv_id::bigint as parent_conv_id,
       n.n_convs::bigint as n_convs, coalesce(n_children, 0)::bigint as n_children,
       n_leaves::bigint as n_leaves, saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n join sums using (d, node) left join children using (d, node)
left join parents using (d, node)
left join nodes p on p.d = n.d - 1 and p.node = parent"""

SHINGLES = f"""
with recursive docs as (
  select row_number() over () as n, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as words
  from documents),
shingles as (
  select n, doc_id,
         case when len(words) = 0 then []
              when len(words) < 4 then [array_to_string(words, ' ')]
              else list_distinct(list_transform(
                list_zip(words[:-4], words[2:-3], words[3:-2], words[4:]),
                lambda x: x[1] || ' ' || x[2] || ' ' || x[3] || ' ' || x[4])) end as own
  from docs),
signed as (select *, md5(array_to_string(list_sort(own), chr(10))) as sig from shingles),
distincts as (
  select sig, min(n) as s, any_value(own) as own, any_value(len(own)) as size
  from signed where len(own) > 0 group by sig),
tokens as (select s, size, unnest(own) as token from distincts),
pairs as (
  select a.s as x, b.s as y, count(*) as shared, any_value(a.size) + any_value(b.size) as total
  from tokens a join tokens b on a.token = b.token and a.s < b.s
    and 100 * a.size >= 85 * b.size and 100 * b.size >= 85 * a.size
  group by a.s, b.s),
links as (
  select x, y from pairs where 100 * shared >= 85 * (total - shared)),
ways as (select x, y from links union all select y, x from links),
reach as (
  select s as x, s as y from distincts
  union
  select reach.x, ways.y from reach join ways on ways.x = reach.y),
roots as (select x as s, min(y) as root from reach group by x),
placed as (
  select n, doc_id, len(signed.own) as size, root
  from signed left join distincts using (sig) left join roots using (s))
select doc_id, size::bigint as n_shingles,
       if(size > 0, min(doc_id) over (partition by root), doc_id) as component_id
from placed"""

ORACLE_SQL: dict[str, str] = {
    "op2_quality_rules": QUALITY,
    "op9_chat_format": CHAT,
    "op10_suffixes": REPEATS,
    "op11_hard_negatives": NEGATIVES,
    "op12_prefix_trie": TRIE,
    "op13_shingle_join": SHINGLES,
}
