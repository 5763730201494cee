"""SQL that must agree with the queries of this subpackage that SQL can express."""

from __future__ import annotations

from txnmart.llm.hard_negatives import BAND, EVERY, NEGATIVES, POSITIVES, SCALE
from txnmart.llm.secrets import ACCESS, ASSIGN, BLOB, ENDPOINT, HEX, IDENT, SCOPE


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _matches(rank: int, kind: str, role: str, strong: bool, pattern: str, group: int, ok: str) -> str:
    p = _text(pattern)
    return f"""
select row, doc_id, {rank} as rank, '{kind}' as kind, '{role}' as role, {strong} as strong,
       s as start, s + l as "end"
from (select row, doc_id, v, l,
             sum(g + l) over (partition by row order by i) - l as s
      from (select row, doc_id, unnest(range(1, len(whole) + 1)) as i,
                   unnest(list_transform(gaps[1:len(whole)], lambda x: length(x))) as g,
                   unnest(list_transform(whole, lambda x: length(x))) as l, unnest(part) as v
            from (select row, doc_id, string_split_regex(text, {p}) as gaps,
                         regexp_extract_all(text, {p}, 0) as whole,
                         regexp_extract_all(text, {p}, {group}) as part
                  from texts where regexp_matches(text, {p}))))
where {ok}"""


_PARTS = " union all ".join(
    [
        _matches(0, "assign", "secret", True, ASSIGN, 2, "length(v) >= 12"),
        _matches(1, "access", "identifier", True, ACCESS, 0, "true"),
        _matches(2, "hex", "secret", True, HEX, 0, "true"),
        _matches(3, "ident", "identifier", False, IDENT, 2, "length(v) >= 3"),
        _matches(4, "short", "secret", False, ASSIGN, 2, "length(v) between 6 and 11"),
        _matches(
            5, "blob", "secret", False, BLOB, 0,
            "regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]') and regexp_matches(v, '[0-9]')",
        ),
        _matches(6, "endpoint", "endpoint", False, ENDPOINT, 0, "true"),
    ]
)

_JOINED = "coalesce(string_agg(kind || ':' || start || ':' || \"end\", ',' order by start, rank) {}, '')"

OP1 = f"""
with texts as (select row_number() over () as row, doc_id, coalesce(text, '') as text from documents),
parts as ({_PARTS}),
seen as (
  select w.row, w.rank, w.kind, w.role, w.start, w."end",
         bool_or(not apart and o.strong) as covered,
         bool_or(apart and o.role = 'identifier' and o.strong) as sure_id,
         bool_or(apart and o.role = 'identifier') as any_id,
         bool_or(apart and o.role = 'secret' and o.strong) as sure_secret,
         bool_or(apart and o.role = 'secret') as any_secret,
         bool_or(apart and o.role = 'endpoint') as place
  from parts w join parts o on w.row = o.row and o.start <= w."end" + {SCOPE}
       and w.start <= o."end" + {SCOPE},
       lateral (select o."end" <= w.start or w."end" <= o.start as apart)
  where not w.strong
  group by all),
spans as (
  select row, rank, kind, start, "end" from parts where strong
  union all
  select row, rank, kind, start, "end" from seen
  where not covered and case role
    when 'identifier' then sure_secret or (any_secret and place)
    when 'secret' then sure_id or (any_id and place)
    else any_id and any_secret end)
select t.doc_id,
       count(*) filter (rank = 0) as n_assign,
       count(*) filter (rank = 1) as n_access,
       count(*) filter (rank = 2) as n_hex,
       sha256({_JOINED.format('filter (rank < 3)')}) as base_sha256,
       {_JOINED.format('filter (rank is not null)')} as spans
from texts t left join spans s on t.row = s.row
group by t.row, t.doc_id"""

OP13 = f"""
with rows as (
  select row_number() over () as row, vec_id,
         case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) as v
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.row as anchor, a.vec_id as anchor_id, c.row, c.vec_id, a.label = c.label as alike,
         cast(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i])), 0)
              as bigint) as score
  from rows a join rows c on len(a.v) = len(c.v)
  where a.vec_id % {EVERY} = 0),
positives as (
  select anchor, anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor order by score desc, vec_id) as nth
  from scored where alike and row <> anchor
  qualify nth <= {POSITIVES})
select p.anchor_id, p.positive_id,
       cast(row_number() over (partition by p.anchor, p.nth order by n.score desc, n.vec_id) as int) as rank,
       n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n on p.anchor = n.anchor and not n.alike
where {BAND[0]} * p.positive_score <= 100 * n.score and 100 * n.score <= {BAND[1]} * p.positive_score
qualify rank <= {NEGATIVES}"""

ORACLE: dict[str, str] = {"op1_secret_scan": OP1, "op13_hard_negatives": OP13}
