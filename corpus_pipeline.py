"""Corpus pipeline: toxicity, near-duplicates, benchmark decontamination,
personal data, byte-level BPE.

Each stage is (name, function of (spark, docs, sf_dir)); its rows are written
as Parquet and reread as the next stage's documents.  All stages but the last
return the columns of ``documents``.  Toxic documents go; of each group of near
copies the document with the smallest id stays; documents that hold a test item
go; personal data becomes its kind in brackets; the last stage returns token
ids.  A stage's models are fitted on its own input.  Rows without an id cannot
be named as copies or leaks, so those two stages keep them; rows that share an
id go or stay together.  Null and empty texts, very long texts and repeated rows
pass as in the operators; an empty table passes every stage as an empty table.
Stages read and return the columns of ``documents`` alone: others, whatever their
names, are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from optlake.llm import bpe, decontam, neardup, pii, toxicity
from optlake.llm.common import Scratch, broadcast_if_few, prepare, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle and similarity (percent) of near copies.
SHINGLE, SIMILAR = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels").where(~toxicity.held_out()).select("doc_id", "toxic")
    model = toxicity.fit(docs, labels, Scratch(spark))
    return toxicity.score_toxicity(docs, model, keep=COLUMNS).where("score < 0.5").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    prepare(spark)
    scratch = Scratch(spark)
    found = neardup.near_duplicates(docs, scratch, size=SHINGLE, percent=SIMILAR)
    gone = scratch.keep(found.where(~F.col("kept")).select("doc_id").distinct(), "copies")  # counted, then joined
    return docs.select(COLUMNS).join(broadcast_if_few(gone), "doc_id", "left_anti").select(COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    prepare(spark)
    scratch = Scratch(spark)
    leaks = scratch.keep(decontam.find_leaks(docs, table(spark, sf_dir, "benchmark"), scratch).select("doc_id").distinct(), "leaks")
    return docs.select(COLUMNS).join(broadcast_if_few(leaks), "doc_id", "left_anti").select(COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; n_chars follows the text."""
    prepare(spark)
    hidden = pii.redact(docs.select(COLUMNS), pii.train_tagger(docs))
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and the digests of ids and decoded bytes."""
    import public_tokenizers

    prepare(spark)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_decode(docs, ranks, public_tokenizers.PATTERN, Scratch(spark), keep=["doc_id", "lang", "source"], with_decoded=False) \
        .select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_leaks),
    ("personal_data", hide_personal_data),
    ("byte_bpe", encode),
]

#: The classifier, the tagger and the tokenizer are not expressible in SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the rows of the last one."""
    prepare(spark)
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        docs = scratch.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
        scratch.drop(before)
    return docs
