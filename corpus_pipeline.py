"""Corpus pipeline: filters, cleans, de-duplicates, decontaminates and encodes ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. All but the last return the columns of ``documents``; the last
returns the token counts and digests of what is left. Null ids, null or empty
texts, repeated rows and empty tables are handled as the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.llm import decontaminate, line_dedup, queries, simhash
from cohortlab.llm.common import free_name, scratch_dir, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; of rows that repeat an id, all whose text it accepts."""
    mark = free_name(docs, "__mark")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    # Scored by id and text: rows that repeat an id may differ in text.
    each = marked.select(F.struct(F.col("doc_id").alias("id"), F.col(mark).alias("mark")).alias("key"), "doc_id", "text")
    scores = queries.quality_scores(each, table(spark, sf_dir, "labels"), key="key")
    keep = scores.where("predicted = 1").select(F.col("key.id").alias("keep_id"), F.col("key.mark").alias("keep_mark")).distinct()
    same = marked["doc_id"].eqNullSafe(keep["keep_id"]) & (marked[mark] == keep["keep_mark"])
    return marked.join(keep, same, "left_semi").select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in at least 10 documents go everywhere; the count of characters follows."""
    out = line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return out.select(*docs.columns)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays, once; rows
    without an id stay. Rows that repeat an id but not its text are documents of
    their own, the smaller hash of the text first."""
    mark = free_name(docs, "__mark")
    marked = docs.withColumn(mark, F.xxhash64("text"))
    key = F.when(F.col("doc_id").isNotNull(), F.struct(F.col("doc_id").alias("id"), F.col(mark).alias("mark")))
    groups = simhash.near_dedup(marked.select(key.alias("key"), "text"), id_col="key", shingle=4, radius=4)
    first = groups.where("doc_id = component_id").select(F.col("doc_id.id").alias("keep_id"), F.col("doc_id.mark").alias("keep_mark")).distinct()
    same = (marked["doc_id"] == first["keep_id"]) & (marked[mark] == first["keep_mark"])
    kept = marked.join(first, same, "left_semi").dropDuplicates(["doc_id", mark])
    return kept.unionByName(marked.where("doc_id is null")).select(*docs.columns)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item or an edited copy of one go. Rows are known by a
    hash of id and text, so others of the same id, or without an id, stay."""
    row = free_name(docs, "__row")
    marked = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = decontaminate.contaminated(marked.select(row, "text"), table(spark, sf_dir, "benchmark"), id_col=row)
    bad = found.select(F.col("doc_id").alias("bad_row")).distinct()
    return marked.join(bad, marked[row] == bad["bad_row"], "left_anti").select(*docs.columns)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left: counts and digests per document."""
    return queries.encoded(docs)


STAGES = [("quality_classifier", quality_stage), ("line_dedup", line_stage), ("simhash_near_dedup", near_dup_stage),
          ("benchmark_decontamination", decontaminate_stage), ("piece_encode", encode_stage)]

# SQL can express neither the classifier nor the encoder; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each but the last written as Parquet to the shared scratch folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
