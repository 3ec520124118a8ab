"""Sources and sinks, inventory IDs S1-S7."""

from __future__ import annotations

import datetime as _dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What pandas reads as missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
           "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _inferred(text: DataFrame) -> dict[str, str]:
    """The narrowest type that every value of a column has, from one pass over a table of strings."""
    tries = {"bigint": lambda c: c.try_cast("bigint"), "double": lambda c: c.try_cast("double"),
             "boolean": lambda c: c.try_cast("boolean"), "date": lambda c: F.when(F.char_length(c) <= 10, c.try_cast("date")),
             "timestamp_ntz": lambda c: c.try_cast("timestamp_ntz")}
    cols = [F.col(f"`{c}`") for c in text.columns]
    n = text.agg(*[F.struct(F.count(c).alias("all"), *[F.count(t(c)).alias(k) for k, t in tries.items()]).alias(f"c{i}")
                   for i, c in enumerate(cols)]).first()
    fits = lambda r: next((k for k in tries if r["all"] and r[k] == r["all"]), "string")
    return {c: fits(n[i]) for i, c in enumerate(text.columns)}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             missing: tuple[str, ...] = MISSING, bad: str = "fail") -> DataFrame:
    """Header CSV (a file, or a folder of part files); fields in ``missing`` are null, in text columns too.

    Pass a schema for known tables: without one, types are found in an extra
    pass. A field that does not fit its type raises when it is read
    (``bad='fail'``) or is null (``bad='null'``). A row with more fields than the header raises, or loses them with
    ``bad='null'``; one with fewer has nulls at its end, as has the reference's reader.
    """
    if bad not in ("fail", "null"):
        raise ValueError("bad must be 'fail' or 'null'")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    reader = spark.read.option("header", True)
    names = [f.name for f in schema] if schema is not None else reader.csv(path).columns
    # One column more than the header has: what stands there is a field too many.
    beyond = "__beyond"
    while beyond in names:
        beyond += "_"
    raw = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in [*names, beyond]])).csv(path)
    if bad == "fail":
        message = F.concat(F.lit(f"a row has more than {len(names)} fields: "), F.col(beyond))
        raw = raw.where(F.when(F.col(beyond).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    text = raw.select(*[F.when(~F.col(f"`{c}`").isin(*missing), F.col(f"`{c}`")).alias(c) for c in names])
    types = {f.name: f.dataType for f in schema} if schema is not None else _inferred(text)

    def typed(name: str):
        c = F.col(f"`{name}`")
        value = c.try_cast(types[name])
        if bad == "fail":
            message = F.concat(F.lit(f"column {name}: bad field "), c)
            value = F.when(c.isNotNull() & value.isNull(), F.raise_error(message)).otherwise(value)
        return value.alias(name)

    return text.select(*[typed(c) for c in text.columns])


def read_csv_dir(spark: SparkSession, path: str, schemas: dict | None = None) -> dict[str, DataFrame]:
    """Every ``*.csv`` below ``path``, a file or a folder of part files, as its own table, in
    name order (schemas differ, so no glob union). Spark lists the folder and reads no content for it."""
    base = path.rstrip("/")
    files = spark.read.format("binaryFile").load(f"{base}/*.csv").select("path")
    below = F.element_at(F.split("path", re.escape(base.split("://")[-1] + "/"), 2), -1)
    names = files.select(F.element_at(F.split(below, "/"), 1).alias("name")).distinct().orderBy("name").collect()
    return {r["name"][:-4]: read_csv(spark, f"{base}/{r['name']}", (schemas or {}).get(r["name"][:-4])) for r in names}


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """S3: record-per-line JSON."""
    r = spark.read.schema(schema) if schema is not None else spark.read
    return r.json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV, overwrite, no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, partition_by=()) -> None:
    """Parquet hand-off between pipelines."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


RUNS_SCHEMA = ("run_id string, experiment string, run_name string, kind string, key string, "
               "value string, ts timestamp")


def log_run(spark: SparkSession, path: str, experiment: str, run_name: str, params: dict | None = None,
            metrics: dict | None = None, texts: dict | None = None) -> str:
    """Append parameters, metrics and reports of one run to a Parquet table."""
    rid = uuid.uuid4().hex
    now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(rid, experiment, run_name, "param", k, str(v), now) for k, v in (params or {}).items()]
    rows += [(rid, experiment, run_name, "metric", k, repr(float(v)), now) for k, v in (metrics or {}).items()]
    rows += [(rid, experiment, run_name, "text", k, str(v), now) for k, v in (texts or {}).items()]
    spark.createDataFrame(rows, RUNS_SCHEMA).write.mode("append").parquet(path)
    return rid


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS_SCHEMA).parquet(path)
