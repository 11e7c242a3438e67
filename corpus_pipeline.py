"""From raw documents to packed sequences: quality, exact and near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes every stage's rows to the shared checkpoint
folder and reads them back, so a stage never runs again for a later one.

A stage decides on rows, not on ids: where ids are null or repeat, rows are told apart by id and
text. Rows that are equal in both are judged alike, and ``exact_dedup`` keeps one of them. Null and
empty texts are texts of no words. Other columns are kept as they are, whatever their names; an
empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from arrivals_star.llm.exact_dedup import exact_dedup
from arrivals_star.llm.minhash_dedup import near_dup_components
from arrivals_star.llm.packing import pack_documents
from arrivals_star.llm.quality import quality
from arrivals_star.llm.secrets import redact_secrets
from arrivals_star.session import scratch_path

ROW, ODD, ID, GONE = "__row", "__odd", "__id", "__gone"
FIRST_ODD = 1 << 62  # numbers from here on stand for rows whose id does not name them


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a number that names them, and whether it is not just the id.

    The number is the id where one row has it; else (null, repeated and very large ids) a hash of
    id and text, above all ids. So the rows that are equal in both have the same number.
    """
    spark, row_id = docs.sparkSession, F.col("doc_id").cast("long")
    path = scratch_path(spark, "odd-ids")
    ids = docs.select(row_id.alias(ID)).where(F.col(ID).isNotNull()).groupBy(ID).agg(F.count(F.lit(1)).alias("n"))
    ids.where((F.col("n") > 1) | (F.col(ID) >= FIRST_ODD)).select(ID).write.parquet(path)
    odd_ids = spark.read.schema(f"{ID} long").parquet(path)
    odd = row_id.isNull()
    if odd_ids.isEmpty():  # the usual case: no join
        told = docs.withColumn(ODD, odd)
    else:
        told = docs.join(odd_ids, row_id == F.col(ID), "left").withColumn(ODD, odd | F.col(ID).isNotNull()).drop(ID)
    by_text = F.xxhash64("doc_id", "text").bitwiseAND(F.lit(FIRST_ODD - 1)).bitwiseOR(F.lit(FIRST_ODD))
    return told.withColumn(ROW, F.when(F.col(ODD), by_text).otherwise(row_id))


def _without(numbered: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows whose number is not marked to go."""
    gone = decisions.where(~F.col("kept")).select(F.col("doc_id").alias(GONE)).distinct()
    return numbered.join(gone, F.col(ROW) == F.col(GONE), "left_anti")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go, each row by its own text."""
    rows = _numbered(docs)
    return _without(rows, quality(rows, ROW)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each equal text (blanks as one space) stays: that with the smallest id, or where none
    of its ids names one row, any of them."""
    rows = _numbered(docs)
    kept = _without(rows, exact_dedup(rows, ROW))
    one = kept.where(ODD).groupBy(ROW).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row"))
    return kept.where(~F.col(ODD)).select(*docs.columns).unionByName(one.select("row.*"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8) stays. Texts without
    words are like none and stay."""
    rows = _numbered(docs)
    return _without(rows, near_dup_components(rows, ROW, width=5, per_cent=80)).select(*docs.columns)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; n_chars is that of the new text. Every row stays."""
    return redact_secrets(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences (see ``pack_documents``); rows that repeat an id are
    packed each."""
    return pack_documents(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("secrets", redact),
    ("packing", pack),
]

#: The stages train models, hash and tokenise; SQL cannot express their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
