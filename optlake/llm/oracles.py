"""DuckDB twins of the training-data queries that SQL can express."""

ORACLES: dict[str, str] = {}

ORACLES["op9_top_k"] = """
with whole as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda e: cast(floor(cast(e as double) * 1024) as bigint)) as v
  from embeddings
  where embedding is not null and len(embedding) = len(list_filter(embedding, lambda e: e is not null and isfinite(e)))
), pairs as (
  select q.row, q.vec_id as query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
  from whole q join whole c on q.row <> c.row
  where q.vec_id % 100 = 0
), ranked as (
  select *, row_number() over (partition by row order by score desc, vec_id) as rank from pairs
)
select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 10
"""

# Exact: all pairs of documents that share a shingle, then the smallest reachable id.
ORACLES["op1_minhash_neardup"] = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) = 1 then w
           else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
  from words
), shingles as (
  select doc_id, len(s) as n, unnest(s) as g from sets
), counted as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as both_
  from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id
    and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by 1, 2
), links as (
  select x, y from counted where 100 * both_ >= 80 * (nx + ny - both_)
  union select y, x from counted where 100 * both_ >= 80 * (nx + ny - both_)
), reach as (
  select doc_id as x, doc_id as y from documents
  union select r.x, l.y from reach r join links l on r.y = l.x
), smallest as (
  select x, min(y) as component_id from reach group by x
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, m.component_id, m.component_id = s.doc_id as kept
from sets s join smallest m on m.x = s.doc_id
"""

ORACLES["op10_chat"] = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), escaped as (
  select *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') as body,
         regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g') as head
  from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls first, role, text), '')) as loss_sha256,
       cast(sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1) as bigint) as formatted_chars
from escaped group by conv_id
"""


def _url_sql(depth: int = 10) -> str:
    """Rules and template tree over all segments of paths of up to ``depth``; a level past the deepest path changes nothing."""
    seg = "segs[{0} + 1]"
    put = "list_concat(list_concat(segs[1:{0}], ['*']), segs[{0} + 2:])"
    parts = [r"""
pages_ as (
  select page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), cut as (
  select *, list_filter(string_split(path, '/'), lambda s: s <> '') as all_parts from pages_
), rows_ as (
  select page_id, host, path,
         list_transform(all_parts, lambda s:
           case when regexp_matches(s, '^[0-9]+(\.[A-Za-z]{1,5})?$') then '{n}' || regexp_extract(s, '(\.[A-Za-z]{1,5})?$', 1)
                when regexp_matches(s, '^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$') then '{uuid}'
                when regexp_matches(s, '^[0-9a-fA-F]{12,}(\.[A-Za-z]{1,5})?$') then '{x}' || regexp_extract(s, '(\.[A-Za-z]{1,5})?$', 1)
                else s end) as typed
  from cut
), labels_ as (
  select doc_id as id, 1 - max(case when coalesce(quality, 1) = 0 or coalesce(toxic, 0) = 1 then 1 else 0 end) as good
  from labels where doc_id is not null group by doc_id
), tree_0 as (
  select r.host, r.typed, r.typed as segs, count(*) as n, count(l.good) as lab, cast(sum(coalesce(l.good, 0)) as bigint) as good
  from rows_ r left join labels_ l on l.id = r.page_id group by r.host, r.typed
)"""]
    now = "tree_0"
    for d in range(depth):
        s, p = seg.format(d), put.format(d)
        parts.append(f"""
node_{d} as (select *, array_to_string(segs[1:{d}], chr(31)) as node, {s} as seg from {now}),
child_{d} as (select host, node, seg, sum(n) as child_n from node_{d} where seg is not null and seg not like '{{%' group by all),
fan_{d} as (select host, node from child_{d} group by all having count(*) >= 12 and count(*) filter (where child_n = 1) >= 0.5 * count(*)),
level_{d} as (
  select t.host, t.typed, t.n, t.lab, t.good, case when c.seg is not null then {p} else segs end as segs
  from node_{d} t left join (select c.* from child_{d} c semi join fan_{d} f on f.host = c.host and f.node = c.node where c.child_n <= 2) c
    on c.host = t.host and c.node = t.node and c.seg = t.seg)""")
        now = f"level_{d}"
    for d in range(depth):
        s, p = seg.format(d), put.format(d)
        parts.append(f"""
shape_{d} as (
  select *, case when {s} is null then array_to_string(segs, chr(31)) else array_to_string({p}, chr(31)) end as shape, {s} as seg from {now}),
rate_{d} as (
  select host, shape, seg, cast(sum(lab) as double) as lab, cast(sum(good) as double) as good
  from shape_{d} where seg is not null group by all having sum(lab) > 0),
usual_{d} as (
  select host, shape, sum(least(lab, 10) * good / lab) / sum(least(lab, 10)) as usual from rate_{d} group by all),
odd_{d} as (
  select r.*, power(greatest(abs(r.good - r.lab * u.usual) - 0.5, 0), 2) > 16 * r.lab * u.usual * (1 - u.usual) as odd
  from rate_{d} r join usual_{d} u on u.host = r.host and u.shape = r.shape),
sum_{d} as (
  select host, shape, count(*) as k, sum(lab) as l, sum(good) as g, sum(good * good / lab) as gg from odd_{d} where not odd group by all),
alike_{d} as (
  select host, shape from sum_{d}
  where k >= 2 and case when g / l > 0 and g / l < 1 then (gg - l * (g / l) * (g / l)) / ((g / l) * (1 - g / l)) else 0 end
                   <= k - 1 + 2 * sqrt(2.0 * (k - 1))),
branch_{d} as (
  select t.host, t.typed, t.n, t.lab, t.good,
         case when a.host is not null and t.seg is not null and not coalesce(o.odd, false) then {p} else t.segs end as segs
  from shape_{d} t left join alike_{d} a on a.host = t.host and a.shape = t.shape
  left join odd_{d} o on o.host = t.host and o.shape = t.shape and o.seg = t.seg)""")
        now = f"branch_{d}"
    parts.append(f"""
leaves as (select *, '/' || array_to_string(segs, '/') as template from {now}),
base as (select cast(coalesce(sum(good), 0) + 1 as double) / (coalesce(sum(lab), 0) + 2) as base from leaves),
hosts as (select host, (sum(good) + 10.0::double * (select base from base)) / (sum(lab) + 10.0::double) as prior from leaves group by host),
judged as (
  select l.host, l.template, sum(l.lab) as lab, (sum(l.good) + 10.0::double * any_value(h.prior)) / (sum(l.lab) + 10.0::double) as purity
  from leaves l join hosts h on h.host = l.host group by l.host, l.template),
ruled as (
  select *, case when host = 'example.org' and starts_with(path, '/en/1') or host like '%.example.org' and starts_with(path, '/en/1') then 'example.org/en/1'
                 when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
                 when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
                 when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
                 when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule
  from rows_)
select r.page_id, r.host, r.path, r.rule,
       case when r.rule in ('org/', 'com/fr/') then 'allow' when r.rule is not null then 'block'
            when j.purity >= 0.5 then 'allow' else 'block' end as verdict,
       j.template, cast(j.lab as bigint) as n_labelled, j.purity
from ruled r left join leaves l on l.host = r.host and l.typed = r.typed
left join judged j on j.host = l.host and j.template = l.template""")
    return "with " + ",".join(parts)


ORACLES["op5_url_templates"] = _url_sql()

# Exact: all pairs of documents that share a five-word shingle and whose sizes allow a link, then the smallest reachable id.
ORACLES["op11_jaccard_join"] = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
           else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s
  from words
), shingles as (
  select doc_id, len(s) as n, unnest(s) as g from sets
), counted as (
  select a.doc_id as x, b.doc_id as y, any_value(a.n) as nx, any_value(b.n) as ny, count(*) as both_
  from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id
    and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  group by 1, 2
), links as (
  select x, y from counted where 100 * both_ >= 80 * (nx + ny - both_)
  union select y, x from counted where 100 * both_ >= 80 * (nx + ny - both_)
), reach as (
  select doc_id as x, doc_id as y from documents
  union select r.x, l.y from reach r join links l on r.y = l.x
), smallest as (
  select x, min(y) as component_id from reach group by x
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, m.component_id from sets s join smallest m on m.x = s.doc_id
"""


def _centroid_sql(rounds: int = 5) -> str:
    """Plain rounds: every vector against every centroid."""
    dist = "list_sum(list_transform(list_zip(a.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    near = f"""
near_{{0}} as materialized (
  select a.row, a.vec_id, a.v, arg_min(c.number, struct_pack(d := {dist}, n := c.number)) as number, cast(min({dist}) as bigint) as distance
  from kept a, cent_{{0}} c group by all)"""
    parts = ["""
kept as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda e: cast(floor(cast(e as double) * 256) as bigint)) as v
  from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = 64
), cent_0 as materialized (
  select row_number() over (order by h, v) - 1 as number, v from (
    select sha256('2:' || vec_id) as h, v from kept where vec_id is not null order by 1, 2 limit 40) s
)"""]
    for r in range(rounds):
        parts.append(near.format(r))
        parts.append(f"""
mean_{r} as (
  select number, list(m order by pos) as v from (
    select number, pos, cast(floor(sum(x) / cast(count(*) as double)) as bigint) as m
    from (select number, unnest(v) as x, generate_subscripts(v, 1) as pos from near_{r}) u group by 1, 2) g group by 1),
cent_{r + 1} as materialized (
  select c.number, coalesce(m.v, c.v) as v from cent_{r} c left join mean_{r} m on m.number = c.number)""")
    parts.append(near.format(rounds))
    return "with " + ",".join(parts) + f"""
select n.vec_id, cast(n.number as int) as cluster, n.distance,
       cast(sum(n.distance) over (partition by n.number) as bigint) as cluster_inertia,
       cast(sum(n.distance) over () as bigint) as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from near_{rounds} n join cent_{rounds} c on c.number = n.number
"""


ORACLES["op12_centroids"] = _centroid_sql()

# The CRC-32 of a feature is folded byte by byte over its table, which the reversed polynomial gives.
ORACLES["op13_resample"] = r"""
with crc as materialized (
  select list(c order by i) as t from (
    select i, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) as c from range(256) r(i)) x
), words as materialized (
  select 'd' as side, doc_id as id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from documents
  union all
  select 't', item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')
  from benchmark
), features as materialized (
  select side, id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) as f from words
), named as materialized (
  select f, hex(encode(f)) as h from (select distinct f from features) x
), buckets as materialized (
  select f, xor(4294967295, list_reduce(list_transform(range(0, len(h) // 2), lambda i: cast('0x' || h[2 * i + 1:2 * i + 2] as bigint)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), cast(4294967295 as bigint))) % 10000 as bucket
  from named, crc
), counted as (
  select bucket, count(*) filter (where side = 'd') as s, count(*) filter (where side = 't') as t
  from features join buckets using (f) group by bucket
), total as (
  select sum(s) as all_s, sum(t) as all_t from counted
), gains as (
  select bucket, cast(floor(1000 * ln((t + 1) * (all_s + 10000)::double / ((s + 1) * (all_t + 10000)::double))) as bigint) as gain from counted, total
), weights as (
  select id, count(*) as n_features, cast(floor(sum(gain) / cast(count(*) as double)) as bigint) as weight
  from features join buckets using (f) join gains using (bucket) where side = 'd' group by id
), scored as (
  select d.id as doc_id, len(d.w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || d.id), 1, 8) as bigint) + 0.5::double) / 4294967296::double))) as bigint) as score
  from words d left join weights w on w.id = d.id where d.side = 'd'
), ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from scored where n_words >= 20
)
select s.doc_id, s.n_features, s.weight, s.score, case when r.rank <= 25 * r.n // 100 then r.rank end as rank
from scored s left join ranked r on r.doc_id = s.doc_id
"""
