"""A training corpus from documents: five stages, each written as Parquet and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.llm import langid, packing, pii, quality, simhash
from lineflow.llm.common import held_out, table, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is at least the threshold; learned from labels of documents that aren't held out.

    A null text counts as an empty one, which is scored like any other; equal and repeated
    rows have equal scores and stay or go together; rows without an id are scored, but not
    learned from; without labels every score is 0.5, so all stay; an empty table stays
    empty; other columns are kept, whatever their names.
    """
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.score(docs, model) >= quality.THRESHOLD)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined, with a score of 0.5 or more.

    Null texts, empty ones and ones without a letter go; if no row has a language to learn
    from, all go; equal and repeated rows stay or go together; equal sums go to the
    alphabetically first language; an empty table stays empty; other columns are kept.
    """
    return langid.keep_identified(docs, docs.where(~held_out(F.col("doc_id"))))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (five-word shingles, similarity 0.8).

    Texts without words are one group, null and empty ones among them. A row without an id
    stays if its group has no other; among texts of one id the smaller hash wins; of
    repeated rows one stays; an empty table stays empty; other columns are kept.
    """
    groups = simhash.duplicate_groups(docs)
    key = ["no_id", "doc_id", "h", "g"]
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "h", "g")).alias("key")).select("key.*")
    text, row = F.coalesce("text", F.lit("")), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"), row)
    kept = rows.join(first, key, "left_semi").dropDuplicates(key)
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and revealing terms replaced; n_chars follows the text.

    Null and empty texts stay as they are, and n_chars of a null text is null; repeated
    rows each stay, and count once as evidence; an empty table stays empty; other columns
    are kept, whatever their names.
    """
    cleaned = pii.clean(docs)
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))) if "n_chars" in docs.columns else cleaned


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 token ids.

    A null or empty text has the end id only; repeated rows are each packed; texts of one
    key keep the order of id and of a hash of the text, rows without an id first; an empty
    table gives no pieces; other columns are not looked at.
    """
    return packing.pack(docs, packing.LENGTH)


STAGES = [
    ("quality", quality_stage),
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Fitted models and fingerprints can't be expressed in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
