"""op8: token counts of all documents."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.tokens import count_tokens


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_token_counts(spark, sf_dir):
    """Byte-level BPE tokens of each whole text."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
