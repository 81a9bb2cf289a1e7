"""The same results as SQL over the given tables, for operators that SQL can express."""

EXACT_DEDUP = r"""
WITH digested AS (
    SELECT doc_id, length(coalesce(text, '')) AS len,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
    FROM documents
), grouped AS (
    SELECT doc_id, text_sha256,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM digested
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM grouped
"""

MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, md5(CAST(doc_id AS VARCHAR)) AS shuffled,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
), placed AS (
    SELECT *, sum(size) OVER (PARTITION BY source ORDER BY shuffled, doc_id) - size AS start
    FROM sized
), per AS (
    SELECT source, sum(size) AS source_size,
           CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
               WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
    FROM sized GROUP BY source
), level AS (
    SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5 AS total,
           sum(weight) OVER () AS weights,
           coalesce(sum(2 * source_size) OVER w, 0)::DOUBLE AS cap_before,
           coalesce(sum(weight) OVER w, 0) AS weight_before
    FROM per
    WINDOW w AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), chosen AS (
    SELECT min_by(l, cap_before) AS level FROM (
        SELECT cap_before, weight, source_size, (total - cap_before) / (weights - weight_before) AS l
        FROM level)
    WHERE 2 * source_size >= l * weight
), goal AS (
    SELECT source, source_size::BIGINT AS source_size,
           coalesce(least((2 * source_size)::DOUBLE, (SELECT level FROM chosen) * weight),
                    (2 * source_size)::DOUBLE) AS target
    FROM per
), cut AS (
    SELECT p.*, g.source_size, g.target,
           least(round(g.target), 2 * g.source_size)::BIGINT AS words
    FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (greatest(0, least(size, words - start))
        + greatest(0, least(size, words - source_size - start)))::BIGINT AS taken,
       source
FROM cut
"""


def conversation_repair() -> str:
    """The cheapest edits by a table over rows and states, instead of prices.

    A state holds what led to it as one text: the cost in nine digits, the edits, chr(1), and the
    repaired lines. The least of such texts is the cheapest, and of those the least edits.
    """

    def then(state: str, letter: str, cost: str, line: str | None = None) -> str:
        said = f" || chr(10) || {line}" if line else ""
        return (
            f"(lpad(CAST(CAST(substr({state}, 1, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0')"
            f" || substr({state}, 10, strpos({state}, chr(1)) - 10) || '{letter}'"
            f" || substr({state}, strpos({state}, chr(1))){said})"
        )

    def keep(state: str, role: str) -> str:
        return f"CASE WHEN NOT gone AND initial = '{role}' THEN {then(state, 'K', 'extra', 'line')} END"

    def rerole(state: str, role: str) -> str:
        said = f"'{role}:' || text"
        return f"CASE WHEN NOT gone THEN {then(state, 'R', '3 + extra', said)} END"

    user, answer = "'user:'", "'assistant:'"
    read = [
        then("s0", "D", "4"),
        f"least({then('s1', 'D', '4')}, {keep('s0', 's')})",
        "least(" + ", ".join([then("s2", "D", "4"), *(f(s, r) for s in ("s0", "s1", "s3") for f, r in ((keep, "u"), (rerole, "user")))]) + ")",
        f"least({then('s3', 'D', '4')}, {keep('s2', 'a')}, {rerole('s2', 'assistant')})",
    ]  # fmt: skip
    insert_user = f"least(r2, {', '.join(then(s, 'I', '3', user) for s in ('r0', 'r1', 'r3'))})"
    insert_answer = f"least(r3, {then('s2', 'I', '3', answer)})"
    closed = f"SELECT key, n, r0 AS s0, r1 AS s1, s2, {insert_answer} AS s3 FROM (SELECT *, {insert_user} AS s2 FROM"
    return rf"""
WITH RECURSIVE table256 AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t
), given AS (
    SELECT conv_id AS key, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                          lambda c: ascii(c)::BIGINT) AS bytes
    FROM conversations
), hashed AS (
    SELECT key, turn, role, text,
           xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS fault
    FROM given, table256
), damaged AS (
    SELECT key, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE fault WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM hashed WHERE fault <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY key ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS n FROM damaged
), flagged AS (
    SELECT *, NOT regexp_matches(text, '[^ 	-]') AS blank,
           row_number() OVER (PARTITION BY key, role, text ORDER BY n) > 1 AS seen,
           lag(role[1]) OVER (PARTITION BY key ORDER BY n) || role[1] AS pair
    FROM placed
), rated AS (
    SELECT key, n, turn, role || ':' || text AS line, text, role[1] AS initial, blank OR seen AS gone, blank, NOT blank AND seen AS duplicate,
           NOT blank AND NOT seen AND NOT regexp_matches(text, '[.!?][ 	-]*\z') AS truncated,
           coalesce(pair NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM flagged
), rows AS (SELECT *, CASE WHEN truncated THEN 3 ELSE 0 END AS extra FROM rated
), step AS (
    {closed}
        (SELECT DISTINCT key, 0::BIGINT AS n, '000000000' || chr(1) AS r0, NULL::VARCHAR AS r1, NULL::VARCHAR AS r2, NULL::VARCHAR AS r3 FROM rows))
    UNION ALL
    {closed}
        (SELECT key, n, {', '.join(f'{x} AS r{k}' for k, x in enumerate(read))} FROM
            (SELECT s.key, r.n, s0, s1, s2, s3, line, text, initial, gone, extra
             FROM step s JOIN rows r ON s.key IS NOT DISTINCT FROM r.key AND r.n = s.n + 1)))
), last AS (
    SELECT key, least(s0, s3) AS best FROM step
    QUALIFY n = max(n) OVER (PARTITION BY key)
), counted AS (
    SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM rows GROUP BY key
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(CAST(substr(best, 1, 9) AS BIGINT), 0) AS cost,
       coalesce(substr(best, 10, strpos(best, chr(1)) - 10), '') AS audit,
       sha256(coalesce(substr(best, strpos(best, chr(1)) + 2), '')) AS repaired_sha256
FROM ids i LEFT JOIN counted c ON i.conv_id IS NOT DISTINCT FROM c.key
           LEFT JOIN last l ON i.conv_id IS NOT DISTINCT FROM l.key
"""
