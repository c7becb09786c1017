"""The corpus pipeline: quality, exact and near duplicates, mixing, packing.

``STAGES`` holds (name, function) pairs.  Each function takes the session, the
documents that its predecessor kept, and the folder of the tables, and returns
the documents that it keeps; the last one returns packed pieces.  ``run``
writes the result of each stage to the shared checkpoint folder and hands what
it reads back to the next one.

Nulls and odd rows: a null text counts as an empty one in every stage.  A null id
is an id like others, except that no label meets it.  Of equal texts, and of each
SimHash component, the row with the smallest id stays; rows that share id and text
are one document there, of which one row stays.  Rows that share id and source are
taken into the mix or left together; documents that the mix repeats are packed as
often.  An empty table, or one that a stage empties, gives an empty result of the
same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import exact_dedup, mixing, packing, quality, simhash
from stellate.llm.common import stored, table
from stellate.llm.queries import production_tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    trees = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_quality(docs, trees)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text (white space runs as one blank)."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.drop_near_duplicates(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix has them: left out, once, or repeated."""
    return mixing.sample_mix(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs, production_tokenizer()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("simhash", near_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

#: Trees, fingerprints and a tokenizer have no SQL; see tests/llm/test_corpus_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")[0]
    return docs
