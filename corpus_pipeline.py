"""Documents to packed training sequences: language, toxicity, near-duplicates, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it
kept. All but the last return the columns of ``docs`` as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import langid, packing, simhash, toxicity
from plumbline.llm.common import labelled_sample, table, tokenizer
from plumbline.session import materialise


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a posterior of a half at least.

    Null texts and texts without a letter have none and go. The languages are learned
    from the rows of ``docs`` that are not held out.
    """
    model = langid.fit(docs.filter(~langid.held_out()), tokenizer("piece_bpe_32k.model"))
    found = langid.identify(docs, model)
    return found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= 0.5)).select(*docs.columns)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, by a model of the labelled rows of ``docs``."""
    model = toxicity.fit(labelled_sample(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), "toxic", toxicity.SAMPLE_DOCS))
    return toxicity.score(docs, model, out="__toxic").filter(F.col("__toxic") < toxicity.THRESHOLD).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each near-duplicate group.

    An id names one document, so unlike texts of one id are one group, too, and one row
    of that id stays: of its texts that stand for a group, the one of the least
    fingerprint, and of equal fingerprints the least row. Rows without an id cannot be
    named and stay.
    """
    found = simhash.near_duplicates(docs, shingle=4, radius=4)
    kept = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.min("fp").alias("fp"))
    whole = simhash.fingerprints(docs.filter("doc_id is not null").select(F.struct(*docs.columns).alias("row"), "text"), "row")
    # what is kept grows with the input, so texts meet it by shuffle at every size; the
    # rows of an id and fingerprint are together then, and choosing one needs no second shuffle
    named = whole.withColumn("doc_id", F.col("row.doc_id")).join(kept.hint("merge"), ["doc_id", "fp"])
    least = named.groupBy("doc_id", "fp").agg(F.min("row").alias("row")).select("row.*")
    return least.unionByName(docs.filter("doc_id is null"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, one row each."""
    return packing.pack_documents(docs, tokenizer("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("language", known_language),
    ("toxicity", not_toxic),
    ("near_duplicates", one_of_each),
    ("packing", packed),
]

# learned models and components are beyond SQL; tests hold the stages against plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage kept is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
