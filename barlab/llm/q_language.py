"""op7: the language of all documents."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.language import fit_languages, predict_language


def op7_language_id(spark, sf_dir):
    """Predicted language of each whole text, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return predict_language(docs, fit_languages(docs))
