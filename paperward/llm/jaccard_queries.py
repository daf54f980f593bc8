"""op8: documents with like sets of word n-grams."""

from __future__ import annotations

from paperward.llm.jaccard import jaccard_classes
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


@query()
def op8_ngram_jaccard(spark, folder):
    """SQL would need all pairs that share an n-gram; tests compare with brute force."""
    return jaccard_classes(read_table(spark, folder, "documents"))
