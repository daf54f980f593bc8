"""op1: all documents in eight shards of near equal bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperward.llm.sharding import shard_by_bytes
from paperward.queries.registry import registry
from paperward.sources.tables import read_table

QUERIES, ORACLES, query = registry()


@query()
def op1_sharding(spark, folder):
    """Law ``bytes``; the shards aren't said by SQL, so tests compare with brute force.

    A null text counts as an empty one and shares its group.
    """
    text = F.coalesce("text", F.lit(""))
    rows = read_table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("group"),
    )
    return shard_by_bytes(rows, "group", "size", ["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
