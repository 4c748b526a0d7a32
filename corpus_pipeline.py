"""A corpus from language identification to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as
Parquet and read again as the next stage's documents. All but the last keep the columns
of documents.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martworks.llm import common, language_id, mixing, near_duplicates, packing, pii

#: Documents of which so many in 100 word shingles are the same are near duplicates here.
NEAR_PERCENT = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model accepts; it is fitted on their own labels. Null
    and empty texts and texts without a letter have no language and go; rows that repeat an id
    or a text are judged one by one; an empty table stays empty."""
    common.prepare(spark)
    return language_id.accepted_rows(docs, language_id.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Of
    rows that repeat an id the first by their other columns stays; rows without an id stay."""
    kept = near_duplicates.near_duplicates(docs, NEAR_PERCENT).where("kept and doc_id is not null")
    ids = kept.select("doc_id").distinct()
    rest = [c for c in docs.columns if c != "doc_id"]
    first = Window.partitionBy("doc_id").orderBy(*rest)
    named = docs.join(ids, "doc_id", "left_semi").withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return named.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their personal data replaced by marks. All rows stay, a null text stays
    null, an empty one empty; rows that repeat are treated alike."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture, within and across the files written. A null
    source is a source, a null or empty text counts as a word, rows that repeat all stay."""
    mixed = mixing.mixed(docs)
    files = max(1, mixed.sparkSession.sparkContext.defaultParallelism)
    ordered = mixed.repartitionByRange(files, "mix_slot", "mix_order").sortWithinPartitions("mix_slot", "mix_order")
    return ordered.select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of tokens. Each file of the mixture is a segment of its own, so sequence
    ids follow the mixture from file to file; rows that come from no file are one segment. A
    null or empty text has its end id only; an empty table gives no sequences."""
    name = F.col("_metadata.file_name")
    try:
        docs.select(name)
    except AnalysisException:
        return packing.packed(docs)
    part = F.regexp_extract(name, r"part-(\d+)", 1)
    return packing.packed(docs, segment=F.when(part != "", part.cast("long")))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No stage but the mixing could be said in SQL, so the rows of run() can't.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    common.prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = common.folder(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
