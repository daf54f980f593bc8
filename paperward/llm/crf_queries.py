"""op9: quality of all documents."""

from __future__ import annotations

from paperward.llm.crf import score_documents
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


@query()
def op9_quality_classifier(spark, folder):
    """A trained model isn't said by SQL; tests measure it on held-out documents."""
    return score_documents(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))
