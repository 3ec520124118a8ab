"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlab.session import checkpointed, scratch_dir

__all__ = ["checkpointed", "scratch_dir", "table", "remainder", "labelled", "arrow_map", "free_name", "join_per_key"]

# Rows in one Arrow batch inside ``arrow_map``; texts of 100 kB keep a batch below about 50 MB.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read through Spark (any store Spark can open)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as decimal text, modulo ``modulus``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulus)


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """(doc_id, y): one 0/1 label per document. Null ids and null labels are
    left out; a document labelled more than once takes its largest label."""
    return (labels.select("doc_id", F.col(column).cast("int").alias("y"))
            .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1))
            .groupBy("doc_id").agg(F.max("y").alias("y")))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (case ignored, as
    Spark compares names)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` with batches cut to ``BATCH_ROWS`` rows, so that the
    Python objects made from one batch stay small whatever the session's
    batch size is. ``fn`` maps one batch to one batch, or to several."""
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BATCH_ROWS):
                got = fn(b.slice(at, BATCH_ROWS))
                if isinstance(got, pa.RecordBatch):
                    yield got
                else:
                    yield from got
    return df.mapInArrow(run, schema)


def join_per_key(rows: DataFrame, per_key: DataFrame, key: str, share: int = 1000) -> DataFrame:
    """``rows`` joined to ``per_key``: one row per value of ``key``, whose column
    ``n`` counts its rows in ``rows`` (and is left out of the result).

    Keys with more than one in ``share`` of all rows are fewer than ``share``,
    as their counts add up to no more than all rows: they are broadcast, and
    their rows never meet in one task. The rest is an ordinary join, in which
    no key has more than one in ``share`` of the rows. Null keys match nothing.
    """
    per_key = checkpointed(per_key)
    total = per_key.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * share > F.lit(total)
    hot, cold = per_key.where(is_hot).drop("n"), per_key.where(~is_hot).drop("n")
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)
