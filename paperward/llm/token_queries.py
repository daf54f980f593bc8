"""op5, op6 and op10: documents packed, counted and encoded with public tokenizers."""

from __future__ import annotations

import public_tokenizers

from paperward.llm.packing import pack_documents
from paperward.llm.sentencepieces import encode_documents
from paperward.llm.token_counts import count_tokens
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()

WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


@query()
def op5_packing(spark, folder):
    """Packing isn't said by SQL; tests compare with a plain first-fit."""
    return pack_documents(read_table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


@query()
def op6_token_counts(spark, folder):
    """Tokens aren't said by SQL; tests compare with the library."""
    return count_tokens(read_table(spark, folder, "documents"), public_tokenizers.path(WORD_BPE))


@query()
def op10_sentencepiece(spark, folder):
    """Pieces aren't said by SQL; tests compare with the library."""
    return encode_documents(read_table(spark, folder, "documents"), public_tokenizers.path(PIECES)).drop("ids")
