"""SQL for the queries which SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_exact_dedup"] = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM docs
WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""
