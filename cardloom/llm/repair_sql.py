"""SQL that repairs conversations row by row: what ``repair`` must equal.

Each conversation carries, per state of the pattern, its cheapest edits so far as
(cost, initials, repaired text); the least of such triples is the cheapest one with
the least initials. A step of the recursion takes in one row, then insertions.
"""

from __future__ import annotations

_NEVER = "{'c': 1000000, 'a': '', 'r': ''}"


def _edit(state: str, cost: str, initial: str, line: str | None = None) -> str:
    text = f"{state}.r" if line is None else f"{state}.r || CASE WHEN {state}.r = '' THEN '' ELSE chr(10) END || {line}"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{initial}', 'r': {text}}}"


def _if(condition: str, edit: str) -> str:
    return f"CASE WHEN {condition} THEN {edit} ELSE {_NEVER} END"


def _delete(state: str) -> str:
    return _edit(state, "4", "D")


def _keep(state: str, letter: str) -> str:
    return _if(f"NOT gone AND letter = '{letter}'", _edit(state, "3 * cut", "K", "(role || ':' || text)"))


def _rerole(state: str, name: str) -> str:
    return _if("NOT gone", _edit(state, "3 + 3 * cut", "R", f"('{name}:' || text)"))


def _insert(state: str, name: str) -> str:
    return _edit(state, "3", "I", f"'{name}:'")


def _least(*edits: str) -> str:
    return f"least({', '.join(edits)})"


_BEFORE_USER = ("s0", "s1", "s3")
_ROW = f"""{_delete('s0')} AS s0, {_least(_delete('s1'), _keep('s0', 's'))} AS s1,
  {_least(_delete('s2'), *[_keep(s, 'u') for s in _BEFORE_USER], *[_rerole(s, 'user') for s in _BEFORE_USER])} AS t2,
  {_least(_delete('s3'), _keep('s2', 'a'), _rerole('s2', 'assistant'))} AS t3"""

SQL = f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
given AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
dealt AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce(list_prepend(4294967295, list_transform(string_split(place, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS chance
  FROM given, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN chance = 4 THEN 'user' ELSE role END AS role,
         CASE chance WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM dealt, range(2) r(copy) WHERE chance <> 0 AND (copy = 0 OR chance = 3)),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(sha256(length(role) || ':' || role || text), 1, 32)) AS i,
         rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS ended FROM damaged),
faults AS (
  SELECT conv_id, turn, role, text, i, left(role, 1) AS letter,
         CASE WHEN ended = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS former
  FROM ordered),
rows_of AS (SELECT conv_id, i, role, text, letter, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::INT AS cut FROM faults),
done AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 'r': ''}} AS s0, {_NEVER} AS s1, {{'c': 3, 'a': 'I', 'r': 'user:'}} AS s2,
         {{'c': 6, 'a': 'II', 'r': 'user:' || chr(10) || 'assistant:'}} AS s3 FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {_least("t3", _insert("s2", "assistant"))} AS s3
  FROM (SELECT conv_id, i, s0, s1, t3, {_least("t2", _insert("s0", "user"), _insert("s1", "user"), _insert("t3", "user"))} AS s2
        FROM (SELECT d.conv_id, r.i, {_ROW} FROM done d JOIN rows_of r ON d.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = d.i + 1))),
last AS (SELECT conv_id, least(s0, s3) AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS k FROM done) WHERE k = 1),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (former || letter NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id)
SELECT l.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, best.c::BIGINT AS cost, best.a AS audit, sha256(best.r) AS repaired_sha256
FROM last l LEFT JOIN counts c ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""
