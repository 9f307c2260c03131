"""The corpus pipeline: quality, exact copies, near copies, mixing, encoding.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps
with the columns they came with; the last one returns the encoded digests.

In every stage a null text counts as empty, repeated rows and rows with equal or null
ids are rows of their own, texts are read whole, columns of any name pass through, and
an empty table gives an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verlog.llm.bpe import round_trip
from verlog.llm.common import stage, table
from verlog.llm.dedup import without_duplicates
from verlog.llm.mixing import mixed_documents
from verlog.llm.quality import good_documents
from verlog.llm.simhash import one_per_group


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts have nothing to judge and go; rows with null ids are judged like others but are no labelled
    rows; equal keys at the edge go to the earlier rows; without labels of both kinds only empty texts go."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the smallest id stays.

    Null and empty texts are one group; null ids come last, and of equal ids one row stays."""
    return without_duplicates(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of close fingerprints, the smallest id stays.

    Texts without words (null ones too) have fingerprint zero and are one group, with whatever is close to it; null ids
    come last, and of equal ids one row stays."""
    return one_per_group(docs, words=4, max_bits=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Null and empty texts have size 0 and are taken no time; a null source is a source, the last one; of documents in
    equal places the seeded order decides, the same in every run."""
    return mixed_documents(docs, weights=(3, 1, 2), share=1.5, max_repeats=2)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row for each document of the mix: its id, token count, and digests of ids and decoded bytes.

    Null and empty texts have no tokens; null ids and repeated rows pass through."""
    coded = round_trip(F.col("text"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return docs.select("doc_id", coded.alias("c")).select("doc_id", "c.n_tokens", "c.ids_sha256", "c.decoded_sha256")


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mix", mix),
          ("encode", encode)]

#: The classifier, the fingerprints and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
