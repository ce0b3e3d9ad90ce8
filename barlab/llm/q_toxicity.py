"""op5: toxicity of all documents."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.toxicity import fit_toxicity, score_toxicity


def op5_toxicity(spark, sf_dir):
    """Score of each whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")))
