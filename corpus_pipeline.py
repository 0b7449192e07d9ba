"""A corpus pipeline: quality rules, near copies, repeated passages, mixing, packing.

Each stage takes the documents its predecessor kept and returns documents, the
last one the pieces of packed sequences. ``run`` stores each stage's result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from carelake.llm import mixing, packing, parity_join, quality_rules, substring_dedup
from carelake.session import stored


def _boxed(docs: DataFrame, *plain: str) -> DataFrame:
    """The named columns, and all others in one ``_row``, so that no name meets one that an operator uses."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in plain]
    return docs.select(*plain, F.struct(F.lit(0).alias("n"), *others).alias("_row"))


def _unboxed(docs: DataFrame, *plain: str) -> list[Column]:
    """The columns of ``docs`` in their order, from a boxed table."""
    return [F.col(c) if c in plain else F.col(f"_row.c{i}").alias(c) for i, c in enumerate(docs.columns)]


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all quality rules, unchanged, repeated rows each on its own; null and empty texts go."""
    boxed = docs.select(F.struct("*").alias("_row"), "text")
    return quality_rules.apply_rules(boxed, ["_row"]).where("kept").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect, the one with the smallest doc_id, a null one last.

    Documents without words stay. Of rows with one doc_id and one text one stays. An empty table stays empty.
    Sets of five-word shingles link from a similarity of 0.8 on; op10's four words and 85% are that query's own.
    """
    kept = parity_join.one_of_each(_boxed(docs, "doc_id", "text"), k=5, percent=80)
    return kept.select(*_unboxed(docs, "doc_id", "text"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; one that loses all its words goes.

    A text that loses nothing keeps its white space; a cut one has its words
    joined by one space, and n_chars, where there is one, counts anew.
    """
    cut = substring_dedup.remove_repeats(_boxed(docs, "doc_id", "text")).where("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    columns = dict(zip(docs.columns, _unboxed(docs, "doc_id", "text"))) | {"text": text}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length(text).cast(docs.schema["n_chars"].dataType)).otherwise(
            columns["n_chars"])
    return cut.select(*[columns[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it.

    Rows that tie in doc_id and source are ordered by their texts' hash, so a
    rerun takes the same ones; rows with equal texts, too, are alike. A document
    without words, or a null text, is taken no times.
    """
    keyed = _boxed(docs, "doc_id", "source", "text").withColumn("_copy", F.xxhash64("text"))
    same = ["doc_id", "source", "_copy"]
    number = F.row_number().over(Window.partitionBy(*same).orderBy("_copy"))
    times = (mixing.mix(keyed, carry=("_copy",)).withColumn("_nth", number)
             .where("times > 0").select(*[F.col(c).alias(f"_{c}_of") for c in same], F.col("_nth").alias("_nth_of"), F.col("times").alias("_times")))
    rows = keyed.withColumn("_nth", number)
    met = (F.col("doc_id").eqNullSafe(F.col("_doc_id_of")) & F.col("source").eqNullSafe(F.col("_source_of"))
           & (F.col("_copy") == F.col("__copy_of")) & (F.col("_nth") == F.col("_nth_of")))
    return (rows.join(times, met).withColumn("_turn", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
            .select(*_unboxed(docs, "doc_id", "source", "text")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences; a null or empty text is its end token alone."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", filter_quality),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing to target weights", mix_sources),
    ("packing", pack_sequences),
]

# A tokenizer's ids have no equivalent in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole documents table; each stage's result is stored. An empty table gives no pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
