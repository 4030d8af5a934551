"""DuckDB SQL for the corpus queries that SQL can express.

The SQL takes plainer ways than the operators: it expands all shingles and joins on them, and it orders whole
tables in one window.
"""

from __future__ import annotations

from tidewell.llm.mixing import SHARE
from tidewell.llm.sharding import ROUNDS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingles(name: str, table: str, key: str, word: str) -> str:
    """Distinct five-word shingles (s) of each row, in a table of (key, s); texts of one to four words are one shingle."""
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{word}')"
    return f"""{name}_w as (select {key}, {words} as w from {table}),
 {name} as (select distinct {key}, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ') || ' ' || len(w)] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) end) as s from {name}_w)"""


_NEAR = rf"""with recursive {_shingles('sh', 'documents', 'doc_id', r'[^\x20\x09-\x0D]+')},
 size as (select doc_id, count(*) as n from sh group by 1),
 link as materialized (select x.doc_id as a, y.doc_id as b from sh x join sh y on x.s = y.s and x.doc_id <> y.doc_id join size p on p.doc_id = x.doc_id join size q on q.doc_id = y.doc_id group by x.doc_id, y.doc_id, p.n, q.n having 100 * count(*) >= 75 * (p.n + q.n - count(*))),
 reach as (select doc_id as node, doc_id as root from documents union select l.b, r.root from reach r join link l on l.a = r.node where r.root < l.b)
 select d.doc_id, coalesce(n, 0) as n_shingles, min(root) as component_id, d.doc_id = min(root) as kept from documents d join reach r on r.node = d.doc_id left join size s on s.doc_id = d.doc_id group by d.doc_id, n"""

_LEAKS = f"""with {_shingles('item', 'benchmark', 'item_id', '[A-Za-z0-9' + chr(0x80) + '-' + chr(0x10FFFF) + ']+')}, {_shingles('doc', 'documents', 'doc_id', '[A-Za-z0-9' + chr(0x80) + '-' + chr(0x10FFFF) + ']+')},
 size as (select item_id, count(*) as n_item from item group by 1)
 select item_id, doc_id, n_item, count(*) as n_shared, count(*) / n_item as containment from item join doc using (s) join size using (item_id) group by item_id, doc_id, n_item having count(*) * 100 >= n_item * 75"""


def _feistel(p: str) -> str:
    """A pass of the network over a * b numbers (columns a and b), as nested SQL."""
    left, right = f"({p} // b)", f"({p} % b)"
    for step in range(ROUNDS):
        digest = lambda x, step=step: f"('0x' || substr(md5(cast({x} as varchar) || ':{step}:7'), 1, 8))::bigint"
        if step % 2 == 0:
            left = f"(({left} + {digest(right)}) % a)"
        else:
            right = f"(({right} + {digest(left)}) % b)"
    return f"({left} * b + {right})"


_CRC_TABLE = "list_transform(range(256), lambda n: list_reduce([n::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, _: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))"

_SHARDS = f"""with recursive crc(t) as materialized (select {_CRC_TABLE}),
 bytes as (select doc_id, strlen(coalesce(text, '')) as n, case when strlen(coalesce(text, '')) = 0 then 0 else xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, 2 * strlen(text) + 1, 2), lambda i: ('0x' || substr(hex(encode(text)), i, 2))::bigint)), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) end as text_crc32 from documents, crc),
 rows as materialized (select *, row_number() over (order by md5(cast(doc_id as varchar) || ':' || text_crc32), n) - 1 as r, count(*) over () as total, cast(floor(sqrt(count(*) over ())) as bigint) as a, cast(ceil(count(*) over () / floor(sqrt(count(*) over ()))) as bigint) as b from bytes),
 walk as (select doc_id, n, text_crc32, total, a, b, {_feistel('r')} as p from rows union all select doc_id, n, text_crc32, total, a, b, {_feistel('p')} from walk where p >= total)
 select doc_id, cast(n + 8 as bigint) as size, text_crc32, 'rows' as law, cast(p % 24 as int) as shard, p // 24 as slot, cast(null as int) as grown_shard from walk where p < total"""

_MIX = rf"""with recursive base as (select doc_id, source, md5(cast(doc_id as varchar) || ':' || md5(coalesce(text, ''))) as h, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents),
 src as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as k from base group by 1),
 w as (select *, [5, 2, 1][k % 3 + 1] as weight from src),
 fill as (select 0 as step, [] :: bigint[] as full_, {SHARE} * sum(source_size)::double as budget, sum(weight)::double as open_weight, true as go from w
  union all select step + 1, f.full_ || (select coalesce(list(k), []) from w where not list_contains(f.full_, k) and weight * f.budget / f.open_weight > 2 * source_size),
  f.budget - (select coalesce(sum(2 * source_size), 0) from w where not list_contains(f.full_, k) and weight * f.budget / f.open_weight > 2 * source_size), f.open_weight - (select coalesce(sum(weight), 0) from w where not list_contains(f.full_, k) and weight * f.budget / f.open_weight > 2 * source_size),
  exists (select 1 from w where not list_contains(f.full_, k) and weight * f.budget / f.open_weight > 2 * source_size) from fill f where go),
 last as (select * from fill where not go),
 aims as (select w.*, case when list_contains(full_, k) then 2.0 * source_size else weight * budget / open_weight end as target from w, last),
 turn as (select b.*, source_size, target, k, sum(size) over (partition by k order by h) as upto from base b join aims a on a.source is not distinct from b.source),
 pass as (select doc_id, h, k, size, upto / target as v from turn where size > 0 union all select doc_id, h, k, size, (upto + source_size) / target from turn where size > 0),
 cut as (select doc_id, sum(size) over (order by v, k, h rows unbounded preceding) <= (select {SHARE} * sum(source_size) from src) as taken from pass)
 select doc_id, size, source_size, target, cast(size * coalesce(times, 0) as bigint) as taken from turn left join (select doc_id, count(*) filter (taken) as times from cut group by 1) using (doc_id)"""

_AUDIT = r"""with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by coalesce(text, '')) as first_id from documents),
 mark as (select doc_id, max(quality = 1) as good, max(toxic = 1) as toxic from labels group by 1),
 m as (select part, case when len(w) < 100 then 'A' else '' end || case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' else '' end || case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) then 'C' else '' end
  || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end || case when d.doc_id > first_id then 'E' else '' end as mask, coalesce(good, false) as good, coalesce(toxic, false) as toxic from d left join mark using (doc_id)),
 l as (select unnest(['A', 'B', 'C', 'D', 'E']) as l),
 o as (select a.l || b.l || c.l || d.l || e.l as o from l a, l b, l c, l d, l e where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
 s as (select o, unnest(range(1, 6)) as step from o),
 x as (select part, o, step, o[step] as f, contains(mask, o[step]) as fails, len(mask) > 0 and regexp_matches(mask, '[' || o[:step - 1] || '0]') as gone, mask, good, toxic from m, s),
 y as (select part, o as filter_order, cast(step as int) as step, f, count(*) filter (not gone and not fails) as kept, count(*) filter (not gone and fails) as removed, count(*) filter (gone and fails) as redundant, count(*) filter (mask = f) as unique_fails, count(*) filter (not gone and fails and good) as good_lost, count(*) filter (not gone and fails and toxic) as toxic_lost from x group by all)
 select * exclude (f), cast(sum(removed) over (partition by part, f) as bigint) as shapley from y"""

_DIVERGENCE = rf"""with d as (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
 t as (select lang, source, r, unnest(w) as term from d),
 kept as materialized (select lang, term, count(*) as total from t group by all having count(distinct r) >= 10),
 size as (select lang, count(*) as v, sum(total) as lang_n from kept group by 1),
 grp as (select distinct lang, source from d),
 own as (select lang, source, term, count(*) as n from t join kept using (lang, term) group by all),
 every as (select g.lang, g.source, k.term, k.total, coalesce(n, 0) as n, sum(coalesce(n, 0)) over (partition by g.lang, g.source) as group_n from grp g join kept k using (lang) left join own o on o.lang = g.lang and o.source = g.source and o.term = k.term),
 p as materialized (select lang, source, term, n, 1 + (1000000000 :: hugeint * (n + 2)) // (group_n + 2 * v) :: hugeint as p, 1 + (1000000000 :: hugeint * (total + 2)) // (lang_n + 2 * v) :: hugeint as q from every join size using (lang)),
 pair as (select g.lang, g.source, 'pair' as part, h.source as item, cast(coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) as bigint) as value from grp g join grp h on g.lang = h.lang and g.source <> h.source left join p x on x.lang = g.lang and x.source = g.source left join p y on y.lang = h.lang and y.source = h.source and y.term = x.term group by all),
 term as (select lang, source, 'term' as part, term as item, cast((p - q) * (p - q) // (p + q) as bigint) as value from p where n > 0 and p > q),
 ranked as (select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank from (select * from pair union all select * from term))
 select * from ranked where part = 'pair' or rank <= 10"""

ORACLES: dict[str, str] = {"op2_shards": _SHARDS, "op3_contaminated": _LEAKS, "op4_near_duplicates": _NEAR, "op8_mix": _MIX, "op11_interactions": _AUDIT, "op13_divergence": _DIVERGENCE}
