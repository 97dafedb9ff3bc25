"""The corpus pipeline: quality classifier, n-gram Jaccard join, substring dedup, best-fit packing.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import documents, save, sized
from vigil.llm.lm_scoring import held_out_by_id
from vigil.llm.ngram_join import ngram_components
from vigil.llm.packing import pack
from vigil.llm.quality import accepted
from vigil.llm.substring_dedup import substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_by_id("id", 4, 2))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (shingles of five words, similarity 0.8): the least id's, of rows that
    share it or have none (they come last) the one whose text has the least MD5; of equal rows a single one.

    Texts without words all stay."""
    def same(rows: DataFrame, named: DataFrame):
        return rows.doc_id.eqNullSafe(named.id) & (F.unhex(F.md5(rows.text)) == named.mark)

    found = save(ngram_components(docs, k=5, t=80, mark=F.unhex(F.md5("text"))).where("n_shingles > 0").groupBy(F.col("doc_id").alias("id"), "mark").agg(
        F.min("stays").alias("stays"), F.count("*").alias("rows")), "near")
    gone = sized(found.where("not stays").select("id", "mark"), 96)
    kept = docs.join(gone, same(docs, gone), "left_anti")
    again = found.where("stays and rows > 1").select("id", "mark")
    if again.isEmpty():
        return kept
    again = sized(again, 96)
    return kept.join(again, same(kept, again), "left_anti").union(kept.join(again, same(kept, again), "left_semi").dropDuplicates(["doc_id", "text"]))


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows (13 words) that a document with a smaller id has too; n_chars follows."""
    out = substring_dedup(docs, window=13, rest=True)
    new = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return out.select(*[new.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in training sequences of 2048 tokens."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", passages), ("best-fit packing", packing)]

#: A trained classifier and a tokenizer's ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs, f"stage{i}")
    return docs
