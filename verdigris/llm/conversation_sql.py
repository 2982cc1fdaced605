"""The checking SQL of the conversation repair: a walk over the rows that keeps the best edits of each state."""

from __future__ import annotations

SQL = r"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS UBIGINT), CAST(range(8) AS UBIGINT[])),
        lambda c, k: CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
),
fates AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS body,
        xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
            string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda ch: CAST(ord(ch) AS UBIGINT))),
            lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) AS BIGINT) + 1])), 4294967295::UBIGINT) % 20 AS fate
    FROM conversations, crc
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(body, '[.!?]', '', 'g') ELSE body END AS body,
        unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
    FROM fates WHERE fate <> 0
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(body)) AS i,
        NOT regexp_matches(body, '[^\x20\x09-\x0D]') AS blank,
        regexp_extract(body, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) NOT IN ('.', '!', '?') AS cut
    FROM damaged
),
judged AS (
    SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, body ORDER BY i) > 1 AS again,
        lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal
    FROM numbered
),
wanted(q, name, after) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
moves AS (
    SELECT q, q AS mid, 0 AS cost, '' AS acts, CAST([] AS VARCHAR[]) AS lines FROM wanted
    UNION ALL SELECT q, after, 5, 'I', [name || ':'] FROM wanted
    UNION ALL SELECT a.q, b.after, 10, 'II', [a.name || ':', b.name || ':'] FROM wanted a JOIN wanted b ON b.q = a.after
),
walk AS (
    SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS q, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM judged
    UNION ALL
    SELECT conv_id, i, q, cost, audit, lines FROM (
        SELECT w.conv_id, r.i, x.q, w.cost + m.cost + x.cost AS cost, w.audit || m.acts || x.act AS audit,
            w.lines || m.lines || x.lines AS lines
        FROM walk w JOIN moves m ON m.q = w.q
        JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
        JOIN wanted n ON n.q = m.mid,
        LATERAL (
            SELECT m.mid AS q, 2 AS cost, 'D' AS act, CAST([] AS VARCHAR[]) AS lines
            UNION ALL SELECT 1, CASE WHEN r.cut THEN 5 ELSE 0 END, 'K', [r.role || ':' || r.body]
                WHERE NOT r.blank AND NOT r.again AND r.role[1] = 's' AND m.mid = 0
            UNION ALL SELECT n.after, CASE WHEN r.cut THEN 5 ELSE 0 END, 'K', [r.role || ':' || r.body]
                WHERE NOT r.blank AND NOT r.again AND r.role[1] = n.name[1]
            UNION ALL SELECT n.after, CASE WHEN r.cut THEN 6 ELSE 1 END, 'R', [n.name || ':' || r.body]
                WHERE NOT r.blank AND NOT r.again
        ) x
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1
),
ends AS (
    SELECT w.conv_id, w.cost + m.cost AS cost, w.audit || m.acts AS audit, w.lines || m.lines AS lines
    FROM walk w JOIN moves m ON m.q = w.q
    JOIN (SELECT conv_id, max(i) AS i FROM judged GROUP BY conv_id) e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i
    WHERE m.mid IN (0, 3)
    QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + m.cost, w.audit || m.acts) = 1
),
faults AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (again) AS duplicate, count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM judged GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit,
    sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
