"""SQL twins of those corpus queries that SQL can express."""

from __future__ import annotations


def oracle_sql() -> dict[str, str]:
    return {"op4_super_kmer_substrings": _REPEATS, "op8_chat_formatting": _CHAT,
            "op9_golomb_exact_dedup": _EXACT}


# Windows of 50 words as strings; doc_id is unique in the table.
_REPEATS = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM texts WHERE len(words) >= 50),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS sequence FROM starts),
hits AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, min(doc_id) OVER (PARTITION BY sequence) AS first_doc FROM windows)
  WHERE doc_id > first_doc),
covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM hits),
placed AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts),
kept AS (
  SELECT doc_id, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
  FROM placed ANTI JOIN covered USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
       CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""


# White space is taken off by a class of its code points.
_EXACT = r"""
WITH bare AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare,
         length(coalesce(text, '')) AS chars
  FROM documents),
ranked AS (
  SELECT doc_id, bare,
         first_value(doc_id) OVER (PARTITION BY bare ORDER BY chars DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY bare) AS group_size
  FROM bare)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256
FROM ranked
"""

_ESCAPE = r"([<\[])(\\*)(/?s>|\|[a-z_]+\|>|/?(?:INST|ROLE|SAYS|MORE|END)\]|<SYS>>|</SYS>>)"

# A merged turn costs [MORE], 6, another one [ROLE] role [SAYS] [END], 17; <s> and </s> are 7.
_CHAT = rf"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, length(regexp_replace(text, '{_ESCAPE}', '\1\\\2\3', 'g')) AS text_chars,
         length(regexp_replace(role, '{_ESCAPE}', '\1\\\2\3', 'g')) AS role_chars,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, ''
                         ORDER BY turn, role, text)) AS loss_sha256,
       CAST(7 + sum(text_chars + CASE WHEN role = before THEN 6 ELSE 17 + role_chars END) AS BIGINT)
         AS formatted_chars
FROM marked GROUP BY conv_id
"""
