"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
documents. A caller writes a stage's result before it runs the next one, as ``run`` does.

Defined results, beside those that the operators' modules state: a null text counts as empty; rows with null doc_id are documents like any other, but
substring dedup leaves them whole; empty tables give no rows, whatever the stage; texts are read whole, however long; columns that the stages don't name are
kept as they are, under any name, by all stages but the last, which returns pieces; columns of labels other than doc_id, quality and toxic are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrymill.llm import mixing, near_dedup, packing, quality, substring_dedup
from quarrymill.llm.common import Scratch, read


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it learns from the labelled documents of the corpus.

    Null and empty texts have a score like others; equal texts, and so repeated rows, stay or go together; without labels of both classes
    every score is the mean label.
    """
    return quality.keep_good(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8).

    The least (doc_id, copy) of a group stays, once where its row repeats; different texts under one doc_id are different documents; of a group's rows without
    id one stays besides; texts without words link with nothing, and one stays for each doc_id (all, without id).
    """
    return near_dedup.keep_one(docs, percent=80)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words and more that a document of smaller id has.

    Rows that share a doc_id don't shorten each other; a text that loses words is its kept words joined by one space, with n_chars as its new length; a
    document of which nothing is left goes; all others, the empty ones too, stay as they are.
    """
    return substring_dedup.remove_repeats(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities: source, language and topic shares raked to ``mixing.TARGETS``.

    Null source and language count as ''; a text without words has its cell's probability; equal doc_ids in equal cells are taken or left together.
    """
    return mixing.sample(docs, mixing.TARGETS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and offsets. Null text packs as empty text, one piece with the closing id; repeated rows are packed each on its own."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", minhash_near_dedup),
    ("substring dedup", substring_dedup_stage),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

# A fitted model and a tokenizer are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; returns the last one's rows. Extra columns, whatever their names, go along until the last stage."""
    scratch, docs = Scratch(spark), read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.put(out, f"stage{i}")
            if i:
                scratch.drop(f"stage{i - 1}")
    return out
