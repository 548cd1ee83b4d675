"""Cleaning a corpus in stages: every stage works on all that its predecessor kept.

Stages take documents (doc_id, text, n_chars and any other columns) and give the same columns; the
last gives digests of tokens. Each row of the table is a document of its own, whether or not its id
is null or repeated. Null and empty texts are texts without words. An empty table stays empty. Texts
are read whole, however long. Other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.llm import byte_bpe, dart_minhash, decontaminate, importance, secret_scan
from meterflow.llm.queries import table, vocabulary
from meterflow.llm.ship import ship_package
from meterflow.plans.stage import staged

#: Most bytes of row keys that are broadcast; a key has about so many besides its id.
BROADCAST, KEY_BYTES = 16 << 20, 80


def row_column(docs: DataFrame) -> str:
    """A name that no column of `docs` has (names are compared without regard to case)."""
    taken, name = {c.lower() for c in docs.columns}, "row_key"
    while name in taken:
        name += "_"
    return name


def with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """`docs` with a key for every row, and the key's column. Keys are ordered by doc_id (nulls last); a
    key is the row's place in the Parquet file it is read from, of which 96 bits of hash stand for the
    path, or, where it is not read from one, its place in a written copy."""
    row = row_column(docs)
    key = lambda *place: F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), *place)
    try:
        file = F.col("_metadata.file_path")
        return docs.withColumn(row, key(F.col("_metadata.row_index").alias("at"), F.xxhash64(file).alias("file"), F.hash(file).alias("file_2"))), row
    except AnalysisException:
        return staged(docs.withColumn(row, key(F.monotonically_increasing_id().alias("at"))), "rows"), row


def without(docs: DataFrame, row: str, rows: DataFrame) -> DataFrame:
    """`docs` of `with_rows` without the rows whose keys are in `rows`. Keys of few bytes are broadcast,
    so that texts stay where they are; more are met by a shuffle."""
    gone = staged(rows, "gone")
    size = gone.agg(F.sum(F.coalesce(F.octet_length(F.col(f"{row}.id").cast("string")), F.lit(0)) + KEY_BYTES)).first()[0] or 0
    if size <= BROADCAST:
        gone = F.broadcast(gone)
    return docs.join(gone, row, "left_anti").drop(row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling rejects go."""
    return importance.keep_sampled(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near copies the document with the smallest id stays, one of them if there are several."""
    ship_package(spark)
    rows, row = with_rows(docs)
    return without(rows, row, dart_minhash.duplicate_classes(rows, row).where("not representative").select(row))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an occurrence of a benchmark window go; all others stay as they are."""
    rows, row = with_rows(docs)
    return without(rows, row, decontaminate.contamination(rows, table(spark, sf_dir, "benchmark"), row).where("n_hit > 0").select(row))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in its text are replaced and n_chars follows the new text."""
    ship_package(spark)
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of its tokens and digests of the ids and of the bytes they decode to."""
    ship_package(spark)
    return byte_bpe.round_trip(docs, *vocabulary())


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark),
    ("secret_scan", secrets),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs


#: Model scores and token ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
