"""op1: exact copies over all documents."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.exact_dedup import exact_dedup


def op1_exact_dedup(spark, sf_dir):
    """Groups of identical texts; the largest doc_id stays."""
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY sha) AS keep_id, count(*) OVER (PARTITION BY sha) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY sha) AS kept, sha AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS sha FROM documents) d
"""
