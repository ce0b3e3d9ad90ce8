"""op10: all documents as packed token ids."""

from __future__ import annotations

from barlab.llm.common import table
from barlab.llm.packing import pack_tokens
from barlab.llm.q_tokens import tokenizer_path

#: The free id after the vocabulary ends each document and pads rows.
END_ID = 50_256


def op10_token_packing(spark, sf_dir):
    """Rows of 2,048 token ids with segment lengths and position resets."""
    return pack_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.tiktoken"), end_id=END_ID,
                       pad_id=END_ID)
