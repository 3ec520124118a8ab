"""Quality classifier: random Fourier features, normal equations, ridge, isotonic calibration.

Statistics of each whole text are computed once. Random Fourier features (a
fixed seed) approximate a Gaussian kernel over the standardised statistics.
Each task sums the normal equations of its labelled rows; the sums of all
tasks are added row by row of the matrix, so the driver gets one matrix of a
fixed size and solves the ridge system. Calibration pools adjacent violators
over a histogram of the training scores with a fixed number of bins.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.common import arrow_map, checkpointed

STATS = ["log_chars", "log_words", "mean_word", "sd_word", "upper", "digit", "space", "punct", "symbol", "non_ascii",
         "distinct_words", "top_word", "log_lines", "distinct_lines", "mean_line", "end_mark", "wordlike", "one_sign",
         "capital_words", "repeat_pairs", "shouts", "tagged_words"]
SIGNS = "#$%&*+<=>@\\^_`|~{}[]"
_WORDLIKE = re.compile(r"[^\W\d_]+[.,;:!?]?")
_SHOUT = re.compile(r"[!?]{2,}")
_TAGGED = re.compile(r"\w[#$%&*+<=>@\\^_`|~]{2,}")


def statistics(text: str | None) -> list[float]:
    """``STATS`` of one whole text; an empty or null text gives zeros."""
    if not text:
        return [0.0] * len(STATS)
    n = len(text)
    words = text.split()
    k = max(1, len(words))
    lens = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ascii_n = np.bincount(np.minimum(codes, 128), minlength=129)
    upper = sum(map(str.isupper, text)) if ascii_n[128] > n // 2 else int(ascii_n[65:91].sum())
    digit, space = int(ascii_n[48:58].sum()), int(ascii_n[9:14].sum() + ascii_n[32])
    symbol = int(ascii_n[[ord(c) for c in SIGNS]].sum())
    punct = int(ascii_n[33:48].sum() + ascii_n[58:65].sum() + ascii_n[91:97].sum() + ascii_n[123:127].sum())
    seen = Counter(words)
    lines = text.split("\n")
    pairs = len(set(zip(words, words[1:])))
    return [np.log1p(n), np.log1p(len(words)), float(lens.mean()), float(lens.std()), upper / n, digit / n, space / n,
            punct / n, symbol / n, int(ascii_n[128]) / n, len(seen) / k, max(seen.values(), default=0) / k,
            np.log1p(len(lines)), len(set(lines)) / len(lines), np.log1p(n / len(lines)),
            sum(x.rstrip().endswith((".", "!", "?")) for x in lines) / len(lines),
            sum(c for w, c in seen.items() if _WORDLIKE.fullmatch(w)) / k,
            sum(c for w, c in seen.items() if len(w) == 1 and not w.isalnum()) / k,
            sum(c for w, c in seen.items() if w[0].isupper()) / k,
            1 - pairs / max(1, len(words) - 1) if len(words) > 1 else 0.0,
            sum(c for w, c in seen.items() if _SHOUT.search(w)) / k,
            sum(c for w, c in seen.items() if _TAGGED.search(w)) / k]


def with_statistics(docs: DataFrame, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` of each row and ``x``, the statistics of its whole text."""
    base = docs.select(*columns, F.col(text_col).alias("__text"))
    schema = T.StructType([*base.schema.fields[:-1], T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x = [statistics(t) for t in b.column(b.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(x, pa.list_(pa.float64()))], names=[f.name for f in schema])

    return arrow_map(base, run, schema)


@dataclass
class Model:
    """Everything needed to score: sizes depend on the parameters only."""
    mean: np.ndarray
    scale: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weight: np.ndarray
    edges: np.ndarray
    level: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        r = np.sqrt(2 / len(self.phase)) * np.cos(z @ self.omega + self.phase)
        return np.hstack([r, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weight

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.edges, self.level)


def _matrix(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, len(STATS)))
    return np.array(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def pooled(total: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Rising fit to the shares ones / total: adjacent violators pooled."""
    blocks: list[list[float]] = []
    for n, y in zip(total, ones):
        blocks.append([y, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), y / n) for y, n, k in blocks])


def fit(train: DataFrame, features: int = 256, ridge: float = 1e-3, gamma: float = 0.05, bins: int = 400,
        seed: int = 7) -> Model | float:
    """Fit on ``train`` (x, y), rows of any number. One label only, or no rows:
    the share of label 1 (0.5 without rows), which then is every score."""
    d = len(STATS)
    r = train.agg(F.count("*").alias("n"), F.avg("y").alias("y"),
                  *[F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(d)],
                  *[F.stddev_pop(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(d)]).first()
    if not r["n"] or r["y"] in (0.0, 1.0):
        return float(r["y"]) if r["n"] else 0.5
    rng = np.random.default_rng(seed)
    mean, scale = np.array([r[f"m{i}"] for i in range(d)]), np.array([r[f"s{i}"] or 1.0 for i in range(d)])
    model = Model(mean, np.maximum(scale, 1e-9), rng.normal(0, np.sqrt(2 * gamma), (d, features)),
                  rng.uniform(0, 2 * np.pi, features), np.zeros(features + 1), np.zeros(1), np.zeros(1))

    def partial(batches):
        a = np.zeros((features + 1, features + 2))
        for b in batches:
            z = model.features(_matrix(b.column(0)))
            a += z.T @ np.hstack([z, b.column(1).to_numpy(zero_copy_only=False).astype(float)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(range(features + 1), pa.int32()), pa.array(list(a), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    def added(key, rows):
        total = _matrix(rows.column("row").combine_chunks()).sum(axis=0)
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "row": pa.array([total], pa.list_(pa.float64()))})

    sums = train.select("x", "y").mapInArrow(partial, "i int, row array<double>")
    rows = sums.groupBy("i").applyInArrow(added, "i int, row array<double>").collect()
    a = np.array([x["row"] for x in sorted(rows, key=lambda x: x["i"])])
    gram, target = a[:, :-1], a[:, -1]
    penalty = ridge * r["n"] / features * np.eye(features + 1)
    penalty[-1, -1] = 0
    model.weight = np.linalg.solve(gram + penalty + 1e-9 * np.eye(features + 1), target)

    def binned(b: pa.RecordBatch) -> pa.RecordBatch:
        k = np.clip((model.raw(_matrix(b.column(0))) + 0.5) / 2 * bins, 0, bins - 1).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(k), b.column(1)], names=["bin", "y"])

    hist = (arrow_map(train.select("x", "y"), binned, "bin int, y int").groupBy("bin")
            .agg(F.count("*").alias("n"), F.sum("y").alias("ones")).orderBy("bin").collect())
    total, ones = (np.array([h[k] for h in hist], dtype=float) for k in ("n", "ones"))
    model.edges = (np.array([h["bin"] for h in hist]) + 0.5) / bins * 2 - 0.5
    model.level = pooled(total, ones)
    return model


def scored(stats: DataFrame, model: Model | float, key: str) -> DataFrame:
    """``key`` and ``score`` for every row of ``stats``."""
    if isinstance(model, float):
        return stats.select(key, F.lit(model).alias("score"))
    base = stats.select(key, "x")
    schema = T.StructType([base.schema.fields[0], T.StructField("score", T.DoubleType())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(_matrix(b.column(1))), pa.float64())], names=[key, "score"])

    return arrow_map(base, run, schema)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None,
             **params) -> DataFrame:
    """``key`` (the id unless another column is named), score and predicted for
    every row of ``docs``; learned from ``labels`` (doc_id, y in 0/1, one row
    per document), which are all used.

    Scores come from the text alone. Null and empty texts are scored like any
    other, as statistics of zero. Rows that repeat an id are all scored. Rows
    with a null id are scored and never learned from. Extra columns are not used.
    """
    key = key or id_col
    stats = checkpointed(with_statistics(docs, list(dict.fromkeys([key, id_col])), text_col))
    model = fit(stats.join(labels, stats[id_col] == labels["doc_id"]).select("x", "y"), **params)
    return scored(stats, model, key).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
