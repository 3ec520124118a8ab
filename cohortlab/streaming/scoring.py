"""Batch and stream scoring of comma-text rows.

Parse (F7) -> length check -> vector -> fitted ``PipelineModel.transform``.
Rows of the wrong length go to a reject table instead of failing the batch.
All steps are stateless column expressions, so the same function serves a
batch DataFrame and a ``readStream`` DataFrame.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.functions.scalars import split_to_doubles


def parse_rows(df: DataFrame, text_col: str, n_features: int, out: str = "features"):
    """Returns ``(good, rejected)``; good rows carry the vector column."""
    arr = split_to_doubles(text_col)
    parsed = df.withColumn("__arr", arr)
    # Null text gives a null array: rejected, not lost between the two filters.
    ok = F.coalesce((F.size("__arr") == n_features) & F.forall("__arr", lambda x: x.isNotNull()), F.lit(False))
    good = parsed.where(ok).withColumn(out, array_to_vector(F.col("__arr"))).drop("__arr")
    bad = parsed.where(~ok).withColumn("reason", F.concat(F.lit("expected "), F.lit(str(n_features)),
                                                          F.lit(" numbers, got "),
                                                          F.coalesce(F.size("__arr").cast("string"), F.lit("null")))) \
                .drop("__arr")
    return good, bad


def score(model, df: DataFrame, text_col: str, n_features: int, keep=()):
    good, bad = parse_rows(df, text_col, n_features)
    scored = model.transform(good).select(*keep, F.col("prediction").cast("int").alias("prediction"))
    return scored, bad


def score_stream(spark, model, source_path: str, schema, text_expr, n_features: int, out_path: str,
                 rejects_path: str, checkpoint: str, keep=()):
    """Structured Streaming: file source -> parse -> predict -> Parquet files.

    Scored rows go to ``out_path``, rejected ones (with the reason) to
    ``rejects_path``, both from the same micro batch; ``checkpoint`` is in the
    shared folder. Each batch writes to a folder named by its number, so a
    batch that is run again replaces what it had written. Returns the started
    query; ``processAllAvailable()`` drains it.
    """
    stream = spark.readStream.schema(schema).parquet(source_path).withColumn("__text", text_expr)

    def write(batch: DataFrame, number: int) -> None:
        scored, rejected = score(model, batch, "__text", n_features, keep)
        scored.write.mode("overwrite").parquet(f"{out_path}/batch={number}")
        rejected.select(*keep, "reason").write.mode("overwrite").parquet(f"{rejects_path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
