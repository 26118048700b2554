"""DuckDB SQL for the operators whose results SQL can express over whole tables."""

from __future__ import annotations

from voltmesh.llm.chat import CLOSE, ESCAPES, OPEN, ROLE_END

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""WITH i AS (SELECT item_id, w, least(10, len(w)) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(w[a:a + n - 1], ' ') AS k FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM i)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
e AS (SELECT doc_id, n, a, array_to_string(w[a:a + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
h AS (SELECT DISTINCT e.doc_id, e.n, e.a, g.item_id FROM e JOIN g ON e.n = g.n AND e.k = g.k),
p AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + n)) AS x FROM h) GROUP BY doc_id),
q AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN q ON d.doc_id = q.doc_id"""


def _escaped_length(column: str) -> str:
    """The length of a text once its control characters are escaped."""
    extra = " + ".join(f"{len(safe) - 1} * (length({column}) - length(replace({column}, '{plain}', '')))" for plain, safe in ESCAPES)
    return f"length({column}) + {extra}"


_MARKS = len(OPEN) + len(ROLE_END) + len(CLOSE)
CHAT = f"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (SELECT conv_id, turn, role, text FROM conversations
 UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
 CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
 sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
 CAST(sum({_MARKS} + {_escaped_length('role')} + {_escaped_length('text')}) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id"""
