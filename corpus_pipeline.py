"""A corpus pipeline from the operators of vectorloom.llm, stage by stage.

Each stage reads what the one before wrote. All but the last give the columns of
documents; the last gives the packed pieces. Because earlier results are written by then,
a stage first deletes the steps that the operators of earlier stages left.
"""

from __future__ import annotations

from vectorloom.llm import exact_dedup, ngram_join, packing, secret_scan, toxicity
from vectorloom.llm.common import documents, release, stored
from vectorloom.llm.queries import vocabulary
from vectorloom.plans.registry import query


def drop_toxic(spark, docs, sf_dir):
    """Documents scored 0.7 or more go; the model learns from the labelled ones of ``docs``."""
    release(spark)
    return toxicity.keep_civil(docs, toxicity.learned(docs, documents(spark, sf_dir, "labels")))


def drop_exact_copies(spark, docs, sf_dir):
    """Of equal texts the row with the smallest identifier stays."""
    release(spark)
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each group connected by similar shingle sets the smallest identifier stays."""
    release(spark)
    return ngram_join.keep_one(docs)


def mask_secrets(spark, docs, sf_dir):
    """All documents stay; secrets in their texts are masked."""
    release(spark)
    return secret_scan.mask_secrets(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of token sequences with their places in sequences of 1024."""
    release(spark)
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("secret scans", mask_secrets),
    ("best-fit packing", pack_sequences),
]

# SQL has no string kernels or tokenizers: tests compare run() with a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages over the documents of a folder, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"), kept=True)
    return docs


@query("pipeline")
def pipeline(spark, sf_dir):
    return run(spark, sf_dir)
