"""op6: quality of all documents."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.quality import fit_quality, score_quality


def op6_quality(spark, sf_dir):
    """Score of each whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
