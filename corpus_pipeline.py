"""From raw documents to packed sequences: each stage works on all that the one
before it kept, and is written as Parquet before the next one reads it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import packing, private, quality, simhash, substrings
from millrace.llm.queries import tokenizer
from millrace.runtime import materialise

#: Not expressible in SQL: tokenizer ids, shingle hashes, packing.
ORACLE_SQL = None


KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def own_names(stage):
    """Columns that no stage knows travel under names that none of them uses."""

    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = [c if c in KNOWN else f"extra_{n}_" for n, c in enumerate(docs.columns)]
        return stage(spark, docs.toDF(*names), sf_dir).toDF(*docs.columns)

    run.__name__, run.__doc__ = stage.__name__, stage.__doc__
    return run


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with the file and the place in it where each row is stored. Rows
    that are not told apart by these, as they are no rows of Parquet files or
    multiply such rows, are stored first."""
    try:
        rows = docs.withColumns({"file_": F.col("_metadata.file_path"), "at_": F.col("_metadata.row_index")})
        if rows.groupBy("file_", "at_").count().where("count > 1").isEmpty():
            return rows
    except AnalysisException:  # no such columns
        pass
    return placed(materialise(docs, "rows", texts=True))


def at_places(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``placed`` whose places ``kept`` has. So what a stage finds out
    about rows is stored without their texts."""
    return rows.join(kept.select("file_", "at_"), ["file_", "at_"], "left_semi")


@own_names
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = placed(docs)
    read = rows.select(*[c for c in ("text", "lang", "source", "file_", "at_") if c in rows.columns])
    return at_places(rows, quality.quality_rules(read).where("kept")).select(*docs.columns)


@own_names
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash component: the one with the smallest doc_id, null
    last; of rows that share that too, the first as stored. Rows of one doc_id whose
    texts are in different components all stay, each for its own."""
    rows = placed(docs)
    found = simhash.near_duplicates(rows, carry=("file_", "at_"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file_", "at_"))
    stays = found.groupBy("root").agg(first.alias("first")).select("first.file_", "first.at_")
    return at_places(rows, stays).select(*docs.columns)


@own_names
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that occur elsewhere."""
    return with_length(substrings.remove_repeats(docs, digests=False), docs)


@own_names
def private_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return with_length(private.mask_private(docs), docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


def with_length(changed: DataFrame, docs: DataFrame) -> DataFrame:
    """n_chars of the new text, and the columns of ``docs``."""
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated passages", substring_stage),
    ("personal data", private_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"), texts=True)
    return docs
