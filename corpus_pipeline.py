"""A training corpus from raw documents.

Rules and a classifier drop junk, one document of each group of similar ones stays,
passages that an earlier document holds go, and what is left is packed in sequences.
Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and gives the
columns of ``documents``; the last gives the pieces of the sequences.
"""

from __future__ import annotations

import public_tokenizers

from paperward.llm import crf, jaccard, packing, quality, substrings
from paperward.plans.shape import materialize
from paperward.sources.tables import read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
VOCABULARY = "word_bpe_49k.json"


def quality_rules(spark, docs, sf_dir):
    """Documents that fail a base rule or lie far from their language and source go."""
    return quality.keep_good(docs.select(COLUMNS))


def quality_classifier(spark, docs, sf_dir):
    """Documents that score under the classifier's cut go.

    It is trained on the labelled documents as they were before any stage.
    """
    chain = crf.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return crf.keep_good(docs.select(COLUMNS), chain)


def ngram_jaccard(spark, docs, sf_dir):
    """One document of each group of similar ones stays."""
    return jaccard.keep_one_of_each(docs.select(COLUMNS))


def substring_dedup(spark, docs, sf_dir):
    """Passages that a document of smaller id holds are cut from the texts."""
    return substrings.without_repeats(docs.select(COLUMNS))


def pack(spark, docs, sf_dir):
    """Every document's tokens, in sequences of at most 2048."""
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]

#: Estimation, training and packing aren't said by SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; what a stage gives is written before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES):
            docs = materialize(docs)
    return docs
