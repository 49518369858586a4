"""The corpus pipeline: the stages in order, each a DataFrame function over the previous stage's rows.

Every stage reads what its predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.llm import bpe, chunkdedup, jaccard, langid, packing, toxicity
from peerscore.llm.common import passes, remainder, saved, sieve, stage_path, table
from peerscore.llm.queries import WORD_BPE


def carried(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` besides whole rows (``row``), so that no column an operator adds can clash with one of theirs."""
    return docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), *columns)


def restored(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from carried rows, some of them changed."""
    return rows.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language is rejected (no letters, or far from every centroid)."""
    model = langid.fit(langid.learnable(docs))
    return restored(langid.identify(carried(docs, "text"), model).where("not _lang_rejected"), docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that score at least the toxicity threshold."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 4) != 2)
    model = toxicity.fit(toxicity.learnable(docs), labels)
    return restored(toxicity.score(carried(docs, "text"), model).where(f"_tox_score < {toxicity.THRESHOLD}"), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of linked documents, that of the smallest id (rows with a NULL id all stay).

    Documents link at a Jaccard similarity of 0.8 or more of their five-word shingles. A document is named by its id and
    text: rows that repeat an id with the same text are one, an id with several texts is several documents. Only rows
    that may be dropped (a sieve of fixed size) are shuffled with their texts, the others stay where they are.
    """
    number = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")  # sorts as the ids do
    name = F.concat_ws(":", number, F.md5(F.coalesce("text", F.lit(""))))
    rows = carried(docs.where("doc_id is not null"), "doc_id", "text").select("row", name.alias("name"), "text")
    linked = jaccard.link_documents(rows, id_col="name", words=5, percent=80)
    found = linked.groupBy(F.col("node").alias("name")).agg(F.count("*").alias("times"), F.min("component").alias("component"))
    doubtful = saved(found.where("times > 1 or component <> name").select("name", (F.col("component") == F.col("name")).alias("first")))
    rows = passes(rows.select("row", "name"), "name", sieve(doubtful, "name"), "some")
    once = rows.where("some").join(doubtful, "name", "left").where("coalesce(first, true)").dropDuplicates(["name"])
    return restored(rows.where("not some").unionByName(once.select(*rows.columns)), docs).unionByName(docs.where("doc_id is null"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages that an earlier document holds out of the texts; ``n_chars`` follows the text."""
    cut = chunkdedup.deduplicate(carried(docs, "doc_id", "text"))
    changed = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("_cut") > 0, F.length("text").cast(kind)).otherwise(F.col("row").getField("n_chars"))
    return restored(cut, docs, **changed)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences: one row per piece."""
    spec = bpe.read_spec(public_tokenizers.path(WORD_BPE))
    return packing.pack(docs, spec).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = stage_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


ORACLE_SQL = None  # the stages are learned models and hashes; tests hold them against brute force
