"""SQL checks of the conversation queries, put together from parts."""

from __future__ import annotations

WHITE = r"[\x20\x09-\x0D]"
POLYNOMIAL = 0xEDB88320


def crc32(text: str) -> str:
    """Checksum of an ASCII text, one bit a step: -1 in the list asks for a shift."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, y: CASE WHEN y >= 0 THEN xor(c, y) ELSE xor(c >> 1, (c & 1) * {POLYNOMIAL}) END)"
    return f"xor({folded}, 4294967295)"


def _best(*ways: str) -> str:
    return f"list_sort([{', '.join(ways)}], 'ASC', 'NULLS LAST')[1]"


def _edit(way: str, cost: str, letter: str, line: str, condition: str = "true") -> str:
    return f"CASE WHEN {way} IS NOT NULL AND {condition} THEN {{'c': ({way}).c + {cost}, 'a': ({way}).a || '{letter}', 'o': ({way}).o || {line}}} END"


def _insert(way: str, role: str) -> str:
    return _edit(way, "3", "I", f"chr(10) || '{role}:'")


def _row(way: str, role: str, keep: bool) -> str:
    line = f"chr(10) || {'role' if keep else repr(role)} || ':' || t"
    condition = "fault NOT IN (1, 2)" + (f" AND left(role, 1) = '{role[0]}'" if keep else "")
    return _edit(way, f"CASE WHEN fault = 3 THEN {3 * (not keep) + 3} ELSE {3 * (not keep)} END", "K" if keep else "R", line, condition)


def _delete(way: str) -> str:
    return _edit(way, "4", "D", "''")


def turn_repair() -> str:
    """The same repair row by row: the least (cost, audit) of each stack top, in a recursion over rows."""
    none = "NULL::STRUCT(c BIGINT, a VARCHAR, o VARCHAR)"
    user = _best(_delete("us"), *[_row(w, "user", k) for w in ("st", "sy", "pa") for k in (True, False)])
    pair = _best(_delete("pa"), _row("us", "assistant", True), _row("us", "assistant", False))
    us = _best("us", *[_insert(w, "user") for w in ("st", "sy", "pa")])
    pa = _best("pa", _insert("us", "assistant"))
    return rf"""
    WITH RECURSIVE src AS (
      SELECT conv_id::BIGINT AS conv_id, turn::BIGINT AS turn, coalesce(role, ' ') AS role, coalesce("text", ' ') AS t,
        {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS x
      FROM conversations
    ), dmg AS (
      SELECT conv_id, turn, role AS r0, sha256(t) AS t0, unnest(range(CASE x WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy,
        CASE x WHEN 4 THEN 'user' ELSE role END AS role, CASE x WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS t
      FROM src
    ), pos AS (
      SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r0, t0, copy) AS p,
        row_number() OVER (PARTITION BY conv_id, role, t ORDER BY turn NULLS FIRST, r0, t0, copy) AS nth
      FROM dmg
    ), flt AS (
      SELECT *, left(role, 1) AS i, CASE WHEN NOT regexp_matches(t, '[^\x20\x09-\x0D]') THEN 1 WHEN nth > 1 THEN 2
        WHEN NOT regexp_matches(t, '[.!?]{WHITE}*$') THEN 3 ELSE 0 END AS fault
      FROM pos
    ), rec AS (
      SELECT DISTINCT conv_id, 0::BIGINT AS p, {{'c': 0::BIGINT, 'a': '', 'o': ''}} AS st, {none} AS sy, {none} AS us, {none} AS pa FROM flt
      UNION ALL
      SELECT conv_id, p, {_delete("st")}, {_best(_delete("sy"), _row("st", "system", True))}, {user}, {pair}
      FROM (SELECT * REPLACE ({pa} AS pa) FROM (SELECT * REPLACE ({us} AS us) FROM (
        SELECT r.conv_id, f.p, r.st, r.sy, r.us, r.pa, f.role, f.t, f.fault FROM rec r JOIN flt f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.p = r.p + 1)))
    ), ends AS (
      SELECT conv_id, {_best("st", "pa")} AS way
      FROM (SELECT * REPLACE ({pa} AS pa) FROM (SELECT * REPLACE ({us} AS us) FROM (SELECT * FROM rec QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) = 1)))
    ), figures AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
        count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (before || i NOT IN ('su', 'ua', 'au')) AS illegal
      FROM (SELECT *, lag(i) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM flt) GROUP BY conv_id
    )
    SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
      coalesce(illegal, 0) AS illegal, coalesce((way).c, 0) AS "cost", coalesce((way).a, '') AS audit, sha256(coalesce(substr((way).o, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id::BIGINT AS conv_id FROM conversations) o
    LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
    """


def prefix_trie() -> str:
    """The same trie from explicit beginnings: a list of turn names and sizes for each."""
    return f"""
    WITH t AS (
      SELECT conv_id::BIGINT AS c, turn, octet_length(encode(coalesce("text", ''))) AS b,
        sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce("text", '')) AS name
      FROM conversations WHERE conv_id IS NOT NULL
    ), o AS (
      SELECT c, list({{'name': name, 'b': b}} ORDER BY turn NULLS FIRST, name) AS l, {crc32("c::VARCHAR")} % 9 AS h FROM t GROUP BY c
    ), r AS (
      SELECT o.c, list_concat(coalesce(s.l[1:o.h], []), o.l[o.h + 1:]) AS l FROM o LEFT JOIN o s ON s.c = o.c - o.c % 5
    ), m AS (
      SELECT c, l[1:d] AS p, d, d = len(l) AS ends FROM (SELECT c, l, unnest(range(len(l) + 1)) AS d FROM r)
    ), n AS (
      SELECT p, d, min(c) AS c, count(*) AS n, CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * p[d].b END AS w,
        sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS e
      FROM m GROUP BY p, d
    ), k AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1, 2
    ), a AS (
      SELECT p[1:x] AS p, x AS d, sum(w)::BIGINT AS saved, count(*) FILTER (kids IS NULL) AS leaves
      FROM (SELECT n.p, n.w, k.kids, unnest(range(n.d + 1)) AS x FROM n LEFT JOIN k ON k.p = n.p AND k.d = n.d) GROUP BY 1, 2
    )
    SELECT n.c AS conv_id, n.d AS "depth", u.c AS parent_conv_id, n.n AS n_convs, coalesce(kids, 0) AS n_children, leaves AS n_leaves,
      saved AS saved_tokens, n.e AS ends_sha256
    FROM n JOIN a ON a.p = n.p AND a.d = n.d LEFT JOIN k ON k.p = n.p AND k.d = n.d LEFT JOIN n u ON u.d = n.d - 1 AND u.p = n.p[1:n.d - 1]
    """
