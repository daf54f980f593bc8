"""op2: near-equal embeddings of one label."""

from __future__ import annotations

from paperward.llm.neardup import near_duplicates
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


@query()
def op2_embedding_neardup(spark, folder):
    """The tables may miss a pair, which SQL can't say; tests measure recall."""
    return near_duplicates(read_table(spark, folder, "embeddings"))
