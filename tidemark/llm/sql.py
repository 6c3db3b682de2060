"""DuckDB statements of the results that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP3 = f"""with doc_words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as words from documents),
  item_words as (select item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') as words from benchmark),
  windows as (select distinct item_id, least(len(words), 10) as size, list_slice(words, pos, pos + 9) as w
    from (select *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) as pos from item_words where len(words) > 0) as k),
  places as (select d.doc_id, d.pos, s.size, list_slice(d.words, d.pos, d.pos + s.size - 1) as w
    from (select *, unnest(range(1, len(words) + 1)) as pos from doc_words) as d join (select distinct size from windows) as s on d.pos + s.size - 1 <= len(d.words)),
  found as (select p.doc_id, p.pos, p.size, w.item_id from places as p join windows as w on w.w = p.w),
  hits as (select doc_id, count(distinct word) as n_hit from (select doc_id, unnest(range(pos, pos + size)) as word from found) as f group by 1),
  named as (select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names from (select distinct doc_id, cast(item_id as varchar) as name from found) as f group by 1)
  select d.doc_id, cast(len(d.words) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(n.n_items, 0) as n_items,
  sha256(coalesce(n.names, '')) as items_sha256, h.n_hit is not null as contaminated
  from doc_words as d left join hits as h on h.doc_id = d.doc_id left join named as n on n.doc_id = d.doc_id"""
_ESCAPED = "replace(replace(replace(replace({0}, '\\', '\\b'), '###', '\\h'), '</turn>', '\\t'), ':' || chr(10), '\\c')"

OP4 = f"""select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text)) as loss_sha256,
  cast(sum(14 + length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')})) as bigint) as formatted_chars
  from (select conv_id, coalesce(turn, -1) as turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '\\### Assistant: </turn> ok' union all select -7, 1, 'assistant', '\\### Assistant: </turn> ok') as t group by 1"""

OP9 = """with recursive vectors as (select vec_id, cast(embedding as double[]) as v from embeddings),
  links as (select a.vec_id as a, b.vec_id as b from vectors as a join vectors as b on a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.9),
  reach(node, other) as (select vec_id, vec_id from vectors union select r.node, l.b from reach as r join links as l on l.a = r.other)
  select c.node as vec_id, (select count(*) from links as l where l.a = c.node) as n_links, c.least as component_id, c.node = c.least as kept
  from (select node, min(other) as least from reach group by 1) as c"""

OP6 = f"""with recursive words as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\\x20\\x09-\\x0D]+') as w from documents),
  shingles as (select distinct doc_id, list_slice(w, pos, pos + 1) as s from (select *, unnest(range(1, greatest(len(w) - 1, 1) + 1)) as pos from words where len(w) > 0) as k),
  sizes as (select d.doc_id, count(s.doc_id) as n from documents as d left join shingles as s on s.doc_id = d.doc_id group by 1),
  shared as (select a.doc_id as a, b.doc_id as b, count(*) as n from shingles as a join shingles as b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
  links as (select a, b from shared as x join sizes as p on p.doc_id = x.a join sizes as q on q.doc_id = x.b where 100 * x.n >= 80 * (p.n + q.n - x.n)),
  reach(node, other) as (select doc_id, doc_id from documents union select r.node, l.b from reach as r join links as l on l.a = r.other)
  select c.node as doc_id, z.n as n_shingles, c.least as component_id, c.node = c.least as kept
  from (select node, min(other) as least from reach group by 1) as c join sizes as z on z.doc_id = c.node"""



def _cheapest(ways: str) -> str:
    return f"list_sort([{ways}])[1]"


def _way(cost: str, letter: str, rest: str, turn: str | None = None) -> str:
    said = f"list_prepend({turn}, {rest}.r)" if turn else f"{rest}.r"
    return f"{{'c': {cost} + {rest}.c, 'a': '{letter}' || {rest}.a, 'r': {said}}}"


#: What a user or assistant turn makes of the states: nothing said, system, user, assistant.
_TURN = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
_OVER_ROW = ", ".join(_cheapest(", ".join([
    _way("4", "D", f"s{q}"),
    (f"case when gone or initial not in ('{role[0]}'{', ' + repr('s') if q == 0 else ''}) then {{'c': 1000000000, 'a': '', 'r': cast([] as varchar[])}} "
     + (f"when initial = 's' then {_way('open', 'K', 's1', 'said')} " if q == 0 else "") + f"else {_way('open', 'K', f's{n}', 'said')} end"),
    f"case when gone then {{'c': 1000000000, 'a': '', 'r': cast([] as varchar[])}} else {_way('3 + open', 'R', f's{n}', repr(role + ':') + ' || text')} end",
])) + f" as b{q}" for q, (role, n) in _TURN.items())
_INSERTED = ", ".join(_cheapest(", ".join([
    f"b{q}", _way("3", "I", f"b{n}", repr(role + ":")),
    _way("6", "II", f"b{_TURN[n][1]}").replace(f"'r': b{_TURN[n][1]}.r", f"'r': list_concat(['{role}:', '{_TURN[n][0]}:'], b{_TURN[n][1]}.r)"),
])) + f" as s{q}" for q, (role, n) in _TURN.items())
_EMPTY = "cast([] as varchar[])"

OP11 = f"""with recursive lots as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as name from conversations),
  numbered as (select range as b, 0 as k, cast(range as bigint) as v from range(256)),
  tab(b, k, v) as (select * from numbered union all select b, k + 1, case when v % 2 = 1 then xor(v // 2, 3988292384) else v // 2 end from tab where k < 8),
  table_ as (select list(v order by b) as t from tab where k = 8),
  sums as (select l.*, xor(list_reduce(list_prepend(cast(4294967295 as bigint), list_transform(string_split(name, ''), lambda c: cast(ascii(c) as bigint))),
    lambda h, c: xor(h // 256, t[cast(xor(h % 256, c) as integer) + 1])), 4294967295) % 20 as lot from lots as l, table_),
  damaged as (select conv_id, turn, case when lot = 4 then 'user' else role end as role,
    case when lot = 1 then '' when lot = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when lot = 0 then [] when lot = 3 then [1, 2] else [1] end) as copy from sums),
  ordered as (select *, coalesce(cast(conv_id as varchar), '') as conv, sha256(text) as digest, not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank,
    not regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') as unended, left(role, 1) as initial from damaged),
  placed as (select *, row_number() over w as i, count(*) over (partition by conv) as n, lead(initial) over w as next_initial
    from ordered window w as (partition by conv order by turn nulls first, role, digest, copy)),
  twins as (select *, not blank and row_number() over (partition by conv, role, digest order by i) > 1 as twin from placed),
  faults as (select *, not blank and not twin and unended as cut, blank or twin as gone, role || ':' || text as said,
    case when not blank and not twin and unended then 3 else 0 end as open from twins),
  walk(conv, i, s0, s1, s2, s3) as (
    select conv, max(i) + 1, {{'c': 0, 'a': '', 'r': {_EMPTY}}}, {{'c': 6, 'a': 'II', 'r': ['user:', 'assistant:']}},
      {{'c': 3, 'a': 'I', 'r': ['assistant:']}}, {{'c': 0, 'a': '', 'r': {_EMPTY}}} from faults group by conv
    union all
    select conv, i, {_INSERTED} from (select f.conv, f.i, {_OVER_ROW} from walk as w join faults as f on f.conv = w.conv and f.i = w.i - 1) as k),
  report as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where blank) as blank,
    count(*) filter (where twin) as duplicate, count(*) filter (where cut) as truncated,
    count(*) filter (where next_initial is not null and initial || next_initial not in ('su', 'ua', 'au')) as illegal from faults group by conv)
  select o.conv_id, coalesce(r.gaps, 0) as gaps, coalesce(r.blank, 0) as blank, coalesce(r.duplicate, 0) as duplicate, coalesce(r.truncated, 0) as truncated,
  coalesce(r.illegal, 0) as illegal, cast(coalesce(w.s0.c, 0) as bigint) as cost, coalesce(w.s0.a, '') as audit,
  sha256(coalesce(array_to_string(w.s0.r, chr(10)), '')) as repaired_sha256
  from (select distinct conv_id from conversations) as o left join report as r on r.conv = coalesce(cast(o.conv_id as varchar), '')
  left join walk as w on w.conv = r.conv and w.i = 1"""

OP13 = f"""with docs as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as d,
    unnest(list_append(regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[a-z\\x{{80}}-\\x{{10FFFF}}]+'), null)) as term from documents),
  kept as (select lang, term, cast(count(*) as hugeint) as n from docs where term is not null group by 1, 2 having count(distinct d) >= 10),
  sizes as (select lang, count(*) as v, sum(n) as n from kept group by 1),
  counts as (select lang, source, term, cast(count(*) as hugeint) as n from docs semi join kept using (lang, term) group by 1, 2, 3),
  sums as (select lang, source, sum(n) as n from counts group by 1, 2),
  groups as (select g.lang, g.source, coalesce(z.v, 0) as v, coalesce(s.n, 0) + 2 * z.v as d, z.n + 2 * z.v as lang_d
    from (select distinct lang, source from docs) as g left join sizes as z using (lang) left join sums as s using (lang, source)),
  shares as (select g.lang, g.source, k.term, c.n is not null as here, 1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // g.d as p,
    1 + 1000000000::hugeint * (k.n + 2) // g.lang_d as q
    from groups as g join kept as k using (lang) left join counts as c on c.lang = g.lang and c.source = g.source and c.term = k.term),
  terms as (select lang, source, 'term' as part, term as item, (p - q) * (p - q) // (p + q) as value from shares where here and p > q),
  far as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from shares as a join shares as b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by 1, 2, 3),
  pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0) as value
    from groups as a join groups as b on a.lang = b.lang and a.source <> b.source
    left join far as f on f.lang = a.lang and f.source = a.source and f.item = b.source)
  select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank
  from (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from (from terms union all from pairs) as u) as r
  where part = 'pair' or rank <= 10"""

SQL = {"op3_decontamination": OP3, "op4_chat": OP4, "op6_near_duplicates": OP6, "op9_near_vectors": OP9, "op11_conversation_repair": OP11, "op13_source_divergence": OP13}
