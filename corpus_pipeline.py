"""Documents to token ids: the stages of a training-data pipeline, each an operator of galley.llm.

Every stage takes (spark, docs, sf_dir), with docs of the columns COLUMNS, and returns a
DataFrame; all but the last return COLUMNS again. Rows with nulls in any column go through:
a null text is rejected by the first stage, a null doc_id is linked and deduplicated with
nothing, a null source is a source of its own. Extra columns are dropped by the first stage.
Empty tables give empty results. Texts are worked on whole, however long. Ties: of near copies the
smallest doc_id stays, of rows with one doc_id the first by text; repeated rows without doc_id all
stay. Equal selection hashes in the mix are taken together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galley.llm import chunk_dedup, mixing, neardup, quality, spm
from galley.session import cut_lineage, written
from galley.sources.export import delete

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.apply_rules(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by near-duplicate links the one with the smallest doc_id stays.

    Of rows that share a doc_id one stays, the first by text; rows without doc_id all stay.
    """
    judged = neardup.near_duplicates(docs, width=5, percent=80).where("doc_id IS NOT NULL")
    kept = judged.groupBy("doc_id").agg(F.bool_and("kept").alias("kept"), F.count("*").alias("n")).where("kept")
    out = docs.join(kept.select("doc_id"), "doc_id", "left_semi").select(*COLUMNS)
    if not kept.where("n > 1").isEmpty():
        row = F.min(F.struct("text", "lang", "source", "n_chars")).alias("r")
        out = out.groupBy("doc_id").agg(row).select("doc_id", "r.*").select(*COLUMNS)
    return out.union(docs.where("doc_id IS NULL").select(*COLUMNS))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller doc_id holds go from the texts."""
    out = chunk_dedup.dedup_substrings(docs.select(*COLUMNS))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to three times."""
    mixed = mixing.mix(docs.select(*COLUMNS), F.array("source")).where("copies > 0")
    return mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts, and whether they decode to the texts, with spaces for space marks."""
    ids = cut_lineage(spm.encode(docs.select("doc_id", "source", "lang", "text")))  # the same workers, with one model each, decode
    out = spm.decode(ids)
    trip = F.col("decoded") == F.translate("text", spm.MARK, " ")
    return out.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids", trip.alias("round_trip"))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("source mix", source_mix),
    ("SentencePiece encoding and decoding", encoding),
]

#: Signatures, rolling hashes and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; the result of each but the last is written as Parquet and read again, and goes when the next is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs, path = written(stage(spark, docs, sf_dir))
        if before:
            delete(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
