"""SQL counterparts of the operators' queries, for DuckDB."""

from __future__ import annotations

from murmuration.llm.chat import CONTROLS

_OF = "(length({0}) - length(replace({0}, {1}, '')))"


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _escapes(column: str) -> str:
    """Characters that escaping adds to a text."""
    controls = [f"{_OF.format(column, _literal(c))} // {len(c)}" for c in CONTROLS]
    return " + ".join([_OF.format(column, "chr(92)"), *controls])


OP3 = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(role) + {_escapes("role")} + {_OF.format("role", "chr(10)")}
    + length(text) + {_escapes("text")}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


OP11 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM runs GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM runs),
places AS (SELECT lang, unnest([array_to_string(w[i:i + k], ' ') FOR k IN range(0, 5) IF i + k <= len(w)]) AS phrase FROM starts),
f AS (SELECT lang, phrase, count(*) AS f, len(string_split(phrase, ' ')) AS k FROM places GROUP BY lang, phrase HAVING count(*) >= 100),
parts AS (SELECT lang, phrase, f AS a, k, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
inner_ AS (SELECT lang, a, unnest([array_to_string(w[x // 6:x % 6], ' ') FOR x IN range(6, 36)
    IF x // 6 <= x % 6 AND x % 6 <= k AND x % 6 - x // 6 < k - 1]) AS phrase FROM parts),
held AS (SELECT lang, phrase, max(a) AS longest FROM inner_ GROUP BY lang, phrase),
cuts AS (SELECT lang, phrase, a, unnest(range(1, k)) AS cut, w, k FROM parts),
scored AS (SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, n,
    (1000 * c.a::HUGEINT * n) // (l.f::HUGEINT * r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[1:cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[cut + 1:c.k], ' ') JOIN total t ON t.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT w.*, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank
  FROM worst w LEFT JOIN held h ON h.lang = w.lang AND h.phrase = w.phrase WHERE h.longest IS NULL OR 100 * h.longest < 100 * a)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_event_sourced_chat": OP3, "op11_son_collocations": OP11}
