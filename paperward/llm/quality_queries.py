"""op4: quality rules over all documents."""

from __future__ import annotations

from paperward.llm.quality import COUNTS, quality_rules
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


@query()
def op4_quality_rules(spark, folder):
    """The steps of the estimate aren't said by SQL; tests work them out by numpy."""
    found = quality_rules(read_table(spark, folder, "documents"))
    return found.select("doc_id", *COUNTS, "base_failed", "kept")
