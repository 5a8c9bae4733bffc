"""From raw documents to packed training sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galeforge.llm import langid, mixing, neardup, packing, pii
from galeforge.llm.common import held_out, mark, materialize, private, table, tidy

#: Least cosine with the nearest language for short texts; long ones have a limit for each language.
MIN_LANGUAGE_SCORE = 0.05


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the profiles know; the others (no letters, or like none of them) go. A null lang becomes the predicted one.

    Texts of langid.LONG characters need half of what nearly all of the language's own that profiles were learnt from reach; each document is scored once, and the limits come from all of these scores. Null and empty texts go; repeated rows stay; an empty table gives an empty one.
    """
    prototypes = langid.learn_prototypes(docs.where(~held_out()))
    pred, score = private("lang_pred", docs), private("score", docs)
    told = materialize(langid.identify(docs, prototypes, keep=tuple(docs.columns), names=(pred, score)), "told")
    limits = langid.least_scores(told.where(~held_out()), pred, score)
    low = F.lit(MIN_LANGUAGE_SCORE)
    for lang, limit in limits.items():
        low = F.when((F.length("text") >= langid.LONG) & (F.col(pred) == lang), max(limit, MIN_LANGUAGE_SCORE)).otherwise(low)
    known = told.where((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= low))
    return known.withColumn("lang", F.coalesce("lang", pred)).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (Jaccard similarity of five-word shingles of 0.8 or more): that with the smallest id; operator 5 links what is within its radius, bands what is beyond."""
    return neardup.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and secrets replaced by their kind. A null text stays null; repeated rows stay; an empty table gives an empty one."""
    names = tuple(private(x, docs) for x in ("base_spans", "spans", "redacted"))
    found = pii.find_personal_data(docs, pii.learn(docs.select("doc_id", "text")), tuple(c for c in docs.columns if c != "text"), names)
    return found.withColumnRenamed(names[2], "text").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often, and as far, as their source's target takes them; those without words go. Repeated rows take their own share; an empty table gives an empty one."""
    return mixing.take(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences. A null text is an end id alone; an empty table gives an empty result."""
    out = packing.pack_documents(docs)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("near_dedup", near_dedup), ("personal_data", personal_data), ("mixture", mixture), ("packing", packed)]

#: No stage but the mixture has a form in SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on documents, each result written and read again; what a stage wrote on its way, and its input, is deleted once its result is written."""
    docs, since = table(spark, sf_dir, "documents"), mark()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        tidy(spark, since)
    return STAGES[-1][1](spark, docs, sf_dir)
