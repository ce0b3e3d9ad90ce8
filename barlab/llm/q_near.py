"""op2: near copies over all documents."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.near_dedup import near_dedup


def op2_near_dedup(spark, sf_dir):
    """Components of documents whose 2-word shingles are 80 % alike."""
    return near_dedup(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)
