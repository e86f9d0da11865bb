"""The corpus pipeline: documents in, an encoded mixed training set out.

Every stage works on all rows that the one before it has kept, written as
Parquet and read again.  All but the last return the columns of documents.

Defined results, stage by stage: a null text counts as empty.  The classifier
scores such texts like any other.  Of exact copies the largest id stays (a null
id is below all), of rows that repeat id and text one.  Texts without a word
are near copies of nothing.  The mix takes nothing of an empty text and treats
a null source as a source of its own.  An empty text is encoded as the end id.
Further columns, whatever their names, come back untouched up to the mix, and
empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers

from smelter.llm import exact_dedup, jaccard_join, mixing, quality_gam, sentencepiece_bpe
from smelter.llm.common import documents, stored


def quality(spark, docs, sf_dir):
    """Rejects documents that the quality classifier scores under 0.3."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_gam.keep_good(docs, quality_gam.fit(docs, labels))


def exact_copies(spark, docs, sf_dir):
    """Of documents equal up to ASCII case the one with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark, docs, sf_dir):
    """Of each class of near duplicates the document with the least id stays."""
    return jaccard_join.keep_one(docs)


def mix(spark, docs, sf_dir):
    """Documents repeated or cut so that sources come near their targets."""
    return mixing.apply_mix(docs)


def encode(spark, docs, sf_dir):
    """Piece ids of every document of the mix."""
    return sentencepiece_bpe.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [("quality classifier", quality), ("exact dedup", exact_copies), ("n-gram jaccard join", near_copies),
          ("mixing sources", mix), ("sentencepiece encoding", encode)]

#: The classifier and the encoder cannot be written in SQL; tests/llm holds
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = documents(spark, sf_dir)
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
