"""L3: a forest of deep trees as a pipeline stage, grown without a dense histogram for every small node.

Spark's own forest sends one histogram of (drawn features x 32 bins x classes) a node and partition through a shuffle, also
for nodes of two rows: deep trees on rows of many features cost (nodes x partitions). Here only nodes of more than
``LOCAL_ROWS`` rows are split that way, level by level over all rows. The rows of every smaller node then meet in one task,
bounded by ``LOCAL_ROWS``, that grows the rest of its tree. The rules are Spark's: Poisson(1) bags, 32 equal-frequency bins a
feature, about sqrt(features) drawn for each node, the largest Gini gain above 0, ``minInstancesPerNode`` rows of the bag on
both sides, at most ``maxDepth`` levels; a tree votes with its leaf's class shares. What is drawn hangs on (seed, tree), so
fewer trees or levels of the same seed are the same trees, cut.

A model whose trees outgrow what the driver may hold stays a table of subtrees in the shared folder: rows that are scored then
meet the subtrees in tasks of a bounded number of rows and bytes, and only the upper parts of the trees are on the driver.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable,
                             MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.session import checkpointed

BINS = 32
# Rows of a bag that one task grows a subtree from at most, and that a packed block of rows holds at most.
LOCAL_ROWS, BLOCK_ROWS = 200_000, 5_000
# (row, tree) pairs for which a task is worth starting.
PAIRS_PER_TASK = 100_000
# Bytes of subtrees that a task which scores rows by a spread model holds at most, but for a single larger one.
GROUP_BYTES = 8 << 20


def _checked(rows: pd.Series, width: int, fit: bool = True) -> np.ndarray:
    """The feature arrays as a matrix; null vectors and other sizes raise, in a fit also NaN and infinity."""
    if rows.isna().any():
        raise ValueError("features must not be null")
    x = np.vstack(rows.to_list()).astype("float64") if len(rows) else np.empty((0, width))
    if x.shape[1] != width or (fit and not np.isfinite(x).all()):
        raise ValueError(f"features must be {width} finite numbers")
    return x


def _binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every value: the number of cuts below it, so bin <= b means value <= cuts[b]."""
    return np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)]).astype("uint8")


def _cuts(df: DataFrame, width: int) -> list[np.ndarray]:
    """Cut points of every feature: all values but the last where there are at most ``BINS``, else quantiles over all rows."""
    def values(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, np.ndarray] = {}
        for b in batches:
            x = _checked(b["x"], width)
            for j in range(width):
                if j not in seen or len(seen[j]) <= BINS:
                    seen[j] = np.unique(np.append(seen.get(j, []), x[:, j]))[:BINS + 1]
        if seen:
            yield pd.DataFrame({"j": list(seen), "v": [v.tolist() for v in seen.values()]})

    few: dict[int, np.ndarray] = {}
    for r in df.select("x").mapInPandas(values, "j int, v array<double>").toLocalIterator():  # BINS + 1 values a feature and task
        few[r["j"]] = np.unique(np.append(few.get(r["j"], []), r["v"]))[:BINS + 1]
    many = [j for j in range(width) if len(few[j]) > BINS]
    at = [i / BINS for i in range(1, BINS)]
    got = df.agg(*[F.percentile_approx(F.col("x")[j], at, 2_000).alias(f"q{j}") for j in many]).first() if many else {}
    return [np.unique(got[f"q{j}"]) if j in many else few[j][:-1] for j in range(width)]


def _bag(seed: int, block: int, tree: int, n: int) -> np.ndarray:
    return np.random.default_rng([seed, block, tree]).poisson(1.0, n).astype("float64")


def _split(left: np.ndarray, node: np.ndarray, total: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """``left``: class weights left of each candidate cut, candidates in order of their ``node``; ``total``: by node. The first
    candidate of largest Gini gain of every node (-1: none above 0), and that gain."""
    all_of, whole = total[node], total.sum(1)
    right = all_of - left
    wl, wr = left.sum(1), right.sum(1)
    fine = (wl >= least) & (wr >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((left ** 2).sum(1) / wl + (right ** 2).sum(1) / wr - ((total ** 2).sum(1) / whole)[node]) / whole[node]
    gain = np.where(fine & (gain > 1e-12), gain, 0.0)
    top = np.zeros(len(total))
    np.maximum.at(top, node, gain)
    at = np.flatnonzero((gain > 0) & (gain == top[node]))[::-1]
    best = np.full(len(total), -1)
    best[node[at]] = at
    return best, top


def _grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, k: int, draw: int, least: int, depth: int, rng) -> dict[str, np.ndarray]:
    """A subtree of at most ``depth`` levels of splits, in level order; the right child follows the left one. ``feature`` is -1
    in leaves; ``counts``: class weights of every node, ``level``: splits above it."""
    width = x.shape[1]
    rows, at = np.arange(len(y)), np.zeros(len(y), dtype="int64")  # rows in open nodes, and the open node of each
    total = np.bincount(y, w, k)[None]
    feature, cut, child, counts, importance, done, levels = [], [], [], [], np.zeros(width), 1, []
    for level in range(depth + 1):
        m = len(total)
        feats = np.tile(np.arange(draw), (m, 1))
        if draw < width:
            open_ = (total > 0).sum(1) > 1
            feats[open_] = np.argsort(rng.random((int(open_.sum()), width)), axis=1)[:, :draw]
        best, f_best, c_best = np.full(m, -1), np.full(m, -1), np.zeros(m, dtype="int64")
        gain = np.zeros(m)
        if level < depth and len(rows):
            cell = (at[:, None] * draw + np.arange(draw)) * BINS + x[rows[:, None], feats[at]]
            order = np.sort(((cell.astype("int64") << 32) | np.arange(len(rows))[:, None]).ravel())
            cell, who = order >> 32, rows[order & 0xFFFFFFFF]
            new = np.r_[True, cell[1:] != cell[:-1]]
            number, cells = np.cumsum(new) - 1, cell[new]
            by = np.bincount(number * k + y[who], w[who], len(cells) * k).reshape(-1, k)
            group = cells // BINS
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            run = np.cumsum(by, axis=0)
            left = run - np.repeat(np.vstack([np.zeros((1, k)), run[first[1:] - 1]]), np.diff(np.r_[first, len(group)]), axis=0)
            best, gain = _split(left, group // draw, total, least)
            has = best >= 0
            f_best[has], c_best[has] = feats[has, group[best[has]] % draw], cells[best[has]] % BINS
        has = best >= 0
        kids = np.where(has, done + 2 * (np.cumsum(has) - 1), -1)
        for store, v in ((feature, f_best), (cut, c_best), (child, kids), (counts, total), (levels, np.full(m, level))):
            store.append(v)
        if not has.any():
            break
        np.add.at(importance, f_best[has], gain[has] * total[has].sum(1))
        lefts = left[best[has]]
        open_ = has[at]
        rows, at = rows[open_], at[open_]
        at = 2 * (np.cumsum(has) - 1)[at] + (x[rows, f_best[at]] > c_best[at])
        total = np.stack([lefts, total[has] - lefts], axis=1).reshape(-1, k)
        done += len(total)
        # Rows of pure children need no more work.
        mixed = ((total > 0).sum(1) > 1)[at]
        rows, at = rows[mixed], at[mixed]
    return {"feature": np.concatenate(feature).astype("int16"), "cut": np.concatenate(cut).astype("uint8"),
            "child": np.concatenate(child).astype("int32"), "counts": np.vstack(counts), "importance": importance,
            "level": np.concatenate(levels)}


def _shares(tree: dict, levels: tuple = ()) -> dict:
    """The tree with the class shares of its leaves, and of its nodes at ``levels``, as a short table: the pure ones first, then
    those of other nodes."""
    counts, k = tree["counts"], tree["counts"].shape[1]
    pure, leaf = (counts > 0).sum(1) == 1, (tree["feature"] < 0) | np.isin(tree["level"], levels)
    table, spot = np.unique(counts[leaf & ~pure] / counts[leaf & ~pure].sum(1, keepdims=True), axis=0, return_inverse=True)
    share = np.where(pure, counts.argmax(1), 0)
    share[leaf & ~pure] = k + spot.ravel()
    return {**tree, "share": share.astype("int32"), "table": np.vstack([np.eye(k), table])}


def _walk(tree: dict, x: np.ndarray, levels: list[int]) -> list[np.ndarray]:
    """For each of ``levels`` (rising; splits below the root of ``tree``), and at last for the whole tree: where in its table the
    class shares of the node stand that each row has come to."""
    at, open_, out, step = np.zeros(len(x), dtype="int64"), np.arange(len(x)), [], 0
    while True:
        if step in levels:
            out.append(tree["share"][at])
        f = tree["feature"][at[open_]]
        open_, f = open_[f >= 0], f[f >= 0]
        if not len(open_):
            return out + [tree["share"][at]] * (len(levels) + 1 - len(out))
        here = at[open_]
        at[open_] = tree["child"][here] + (x[open_, f] > tree["cut"][here])
        step += 1


def _route(tops: dict, tree: int, x: np.ndarray) -> np.ndarray:
    """The open node or leaf of the upper part of a tree that each row falls into."""
    t, at = tops[tree], np.zeros(len(x), dtype="int64")
    if len(t["feature"]) == 1:
        return at
    feature, cut, child = np.array(t["feature"]), np.array(t["cut"]), np.array(t["child"])
    while (inner := np.flatnonzero(feature[at] >= 0)).size:
        f = feature[at[inner]]
        at[inner] = child[at[inner]] + (x[inner, f] > cut[at[inner]])
    return at


class _ForestParams(HasFeaturesCol, HasLabelCol, HasSeed):
    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of splits at most", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows of the bag in a child at least", TypeConverters.toInt)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(featuresCol="features", labelCol="label", seed=42, numTrees=20, maxDepth=5, minInstancesPerNode=1)


class DeepForest(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the forest; labels are whole numbers from 0, features are finite."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", seed=42, numTrees=20, maxDepth=5, minInstancesPerNode=1):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "DeepForestModel":
        return self.grown(df)

    def grown(self, df: DataFrame, levels: tuple = (), held: int | None = None) -> "DeepForestModel":
        """The fitted model. It can also vote as its trees cut at ``levels`` (rising, below ``maxDepth``), which are the trees of
        forests of so many levels. Trees of more than ``held`` bytes stay a table in the shared folder."""
        trees, seed = self.getOrDefault(self.numTrees), self.getSeed()
        depth, least = self.getOrDefault(self.maxDepth), self.getOrDefault(self.minInstancesPerNode)
        label = F.col(self.getLabelCol()).cast("double")
        d = df.select(label.alias("y"), vector_to_array(F.col(self.getFeaturesCol())).alias("x"))
        s = d.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("top"), F.max(F.size("x")).alias("width"),
                  F.count_if(F.col("y").isNull() | F.isnan("y") | (F.col("y") < 0) | (F.col("y") != F.floor("y"))).alias("bad")).first()
        if not s["n"] or s["bad"] or s["top"] > 10_000:
            raise ValueError(f"a forest needs rows whose labels are whole numbers from 0; {s['n']} rows, {s['bad']} others, largest {s['top']}")
        n, k, width = s["n"], int(s["top"]) + 1, s["width"]
        draw = width if trees == 1 else math.ceil(math.sqrt(width))
        cuts = _cuts(d, width)

        def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            from pyspark import TaskContext
            part, i = TaskContext.get().partitionId(), 0
            for b in batches:
                for lo in range(0, len(b), BLOCK_ROWS):
                    some = b.iloc[lo:lo + BLOCK_ROWS]
                    x = _binned(_checked(some["x"], width), cuts)
                    yield pd.DataFrame({"block": [(part << 24) + i], "y": [some["y"].to_numpy().astype("int32").tobytes()], "x": [x.tobytes()]})
                    i += 1

        # One small row a block: binned features take a byte each.
        packed = checkpointed(d.mapInPandas(pack, "block long, y binary, x binary"))
        tasks = max(1, min(math.ceil(n * trees / PAIRS_PER_TASK), 2_000))

        def rows_of(b: pd.DataFrame):
            for block, y, x in zip(b["block"], b["y"], b["x"]):
                yield block, np.frombuffer(y, "int32"), np.frombuffer(x, "uint8").reshape(-1, width)

        # The upper part of every tree: a few nodes, as its open ones hold more than LOCAL_ROWS rows; these are held by the driver.
        tops = {t: {"feature": [-1], "cut": [0], "child": [-1], "level": [0], "closed": [False], "importance": np.zeros(width),
                    "parent": [-1], "counts": {}} for t in range(trees)}
        active = [(t, 0) for t in range(trees)] if n > LOCAL_ROWS else []
        while active:
            wanted: dict[int, dict[int, np.ndarray]] = {}
            for t, node in active:
                wanted.setdefault(t, {})[node] = np.sort(np.random.default_rng([seed, t, node]).permutation(width)[:draw])

            def histograms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                sums: dict = {}
                for b in batches:
                    for block, y, x in rows_of(b):
                        for t, nodes in wanted.items():
                            w, at = _bag(seed, block, t, len(y)), _route(tops, t, x)
                            for node, feats in nodes.items():
                                r = np.flatnonzero((at == node) & (w > 0))
                                cell = (np.arange(draw) * BINS + x[r[:, None], feats]) * k + y[r, None]
                                h = np.bincount(cell.ravel(), np.repeat(w[r], draw), draw * BINS * k)
                                sums[t, node] = sums[t, node] + h if (t, node) in sums else h
                for (t, node), h in sums.items():
                    yield pd.DataFrame({"tree": [t], "node": [node], "h": [h.tobytes()]})

            def cut_of(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
                t, node = map(int, key)
                h = sum(np.frombuffer(v) for v in b["h"]).reshape(draw, BINS, k)
                total, left = h[0].sum(0), np.cumsum(h, axis=1).reshape(-1, k)
                best, gain = _split(left, np.zeros(len(left), dtype="int64"), total[None], least)
                i = int(best[0])
                sizes = (left[i].sum(), total.sum() - left[i].sum()) if i >= 0 else (0.0, 0.0)
                pure = [int((c > 0).sum() < 2) for c in (left[i], total - left[i])]
                return pd.DataFrame([(t, node, int(wanted[t][node][i // BINS]) if i >= 0 else -1, i % BINS, float(gain[0]), float(total.sum()), *map(float, sizes), *pure, total.tobytes())])

            # (open nodes x tasks) histograms meet by node.
            found = packed.mapInPandas(histograms, "tree int, node int, h binary").groupBy("tree", "node").applyInPandas(
                cut_of, "tree int, node int, feature int, cut int, gain double, rows double, l double, r double, pl int, pr int, total binary").collect()
            active = []
            for r in sorted(found, key=lambda r: (r["tree"], r["node"])):
                t = tops[r["tree"]]
                if r["feature"] < 0:
                    t["closed"][r["node"]] = True  # no cut among the drawn features: a leaf, as in a subtree
                    continue
                first, level = len(t["feature"]), t["level"][r["node"]] + 1
                t["feature"][r["node"]], t["cut"][r["node"]], t["child"][r["node"]] = r["feature"], r["cut"], first
                t["importance"][r["feature"]] += r["gain"] * r["rows"]
                t["counts"][r["node"]] = np.frombuffer(r["total"])
                for i, (size, pure) in enumerate(((r["l"], r["pl"]), (r["r"], r["pr"]))):
                    leaf = bool(pure) or level >= depth
                    for key, v in (("feature", -1), ("cut", 0), ("child", -1), ("level", level), ("closed", leaf), ("parent", r["node"])):
                        t[key].append(v)
                    if size > LOCAL_ROWS and not leaf:
                        active.append((r["tree"], first + i))

        def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for block, y, x in rows_of(b):
                    for t in range(trees):
                        w, at = _bag(seed, block, t, len(y)), _route(tops, t, x)
                        out = []
                        for node in np.unique(at):
                            r = np.flatnonzero((at == node) & (w > 0))
                            if tops[t]["closed"][node]:  # a leaf takes no rows, only their weights
                                out.append((t, int(node), True, b"", np.bincount(y[r], w[r], k).tobytes(), b""))
                            elif len(r):
                                out.append((t, int(node), False, y[r].tobytes(), w[r].astype("uint8").tobytes(), x[r].tobytes()))
                        yield pd.DataFrame(out, columns=["tree", "node", "closed", "y", "w", "x"])

        def grown(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
            t, node = map(int, key)
            if b["closed"].iloc[0]:
                counts = sum(np.frombuffer(v) for v in b["w"])[None]
                got = {"feature": np.array([-1], "int16"), "cut": np.zeros(1, "uint8"), "child": np.array([-1], "int32"), "counts": counts, "importance": np.zeros(width), "level": np.zeros(1, "int64")}
            else:
                y, w = (np.concatenate([np.frombuffer(v, kind) for v in b[c]]) for c, kind in (("y", "int32"), ("w", "uint8")))
                x = np.concatenate([np.frombuffer(v, "uint8") for v in b["x"]]).reshape(-1, width)
                got = _grow(x, y, w.astype("float64"), k, draw, least, depth - tops[t]["level"][node], np.random.default_rng([seed, t, node, 1]))
            got = _shares(got, tuple(v - tops[t]["level"][node] for v in levels))
            return pd.DataFrame([(t, node, *[got[c].tobytes() for c in ("feature", "cut", "child", "share", "table", "importance")])])

        blob = "feature binary, cut binary, child binary, share binary, table binary, importance binary"
        dealt_rows = packed.mapInPandas(dealt, "tree int, node int, closed boolean, y binary, w binary, x binary")
        parts = dealt_rows.repartition(tasks, "tree", "node").groupBy("tree", "node").applyInPandas(grown, f"tree int, node int, {blob}")
        tops = [tops[t] for t in range(trees)]
        if held is not None:
            parts = checkpointed(parts)
            if _bytes(parts).agg(F.sum("size")).first()[0] > held:
                return self._copyValues(DeepForestModel._spread(parts, tops, cuts, k, levels, n))
        return self._copyValues(DeepForestModel._of(_collected(parts, tops, width, k, levels), cuts, k, levels))


def _bytes(parts: DataFrame) -> DataFrame:
    """(tree, node, size) of each subtree."""
    return parts.select("tree", "node", sum(F.octet_length(c) for c in ("feature", "cut", "child", "share", "table", "importance")).alias("size"))


def _collected(parts: DataFrame, tops: list[dict], width: int, k: int, levels: tuple) -> list[dict]:
    """All trees of a forest, on the driver."""
    nodes: list[list] = [[] for _ in tops]
    for r in parts.collect():
        nodes[r["tree"]].append(r)
    return [_joined(top, below, width, k, levels) for top, below in zip(tops, nodes)]


def _joined(top: dict, parts: list, width: int, k: int, levels: tuple = ()) -> dict[str, np.ndarray]:
    """One tree of its upper part and the subtrees below. An empty bag votes for nothing."""
    if not parts:
        return {"feature": np.array([-1], "int16"), "cut": np.zeros(1, "uint8"), "child": np.array([-1], "int32"),
                "share": np.array([k], "int32"), "table": np.vstack([np.eye(k), np.zeros((1, k))]), "importance": np.zeros(width)}
    feature, cut, child = [np.array(top["feature"], "int16")], [np.array(top["cut"], "uint8")], [np.array(top["child"], "int32")]
    share, table, importance = [np.zeros(len(top["feature"]), "int32")], [np.eye(k)], top["importance"].copy()
    done, shared = len(top["feature"]), k
    for node, counts in top["counts"].items():
        if top["level"][node] in levels:
            share[0][node], shared = shared, shared + 1
            table.append(counts[None] / counts.sum())
    for r in sorted(parts, key=lambda r: r["node"]):
        f, c, ch = np.frombuffer(r["feature"], "int16"), np.frombuffer(r["cut"], "uint8"), np.frombuffer(r["child"], "int32")
        s, t = np.frombuffer(r["share"], "int32"), np.frombuffer(r["table"]).reshape(-1, k)
        importance += np.frombuffer(r["importance"])
        s = np.where(s < k, s, s + shared - k)
        ch = np.where(ch >= 0, ch + done - 1, -1)  # the subtree's root takes the place of the open node, the rest follows
        feature[0][r["node"]], cut[0][r["node"]], child[0][r["node"]], share[0][r["node"]] = f[0], c[0], ch[0], s[0]
        for store, v in ((feature, f[1:]), (cut, c[1:]), (child, ch[1:].astype("int32")), (share, s[1:].astype("int32")), (table, t[k:])):
            store.append(v)
        done, shared = done + len(f) - 1, shared + len(t) - k
    return {"feature": np.concatenate(feature), "cut": np.concatenate(cut), "child": np.concatenate(child), "share": np.concatenate(share),
            "table": np.vstack(table), "importance": importance}


class DeepForestModel(Model, _ForestParams, MLReadable, MLWritable):
    """Adds ``rawPrediction`` (votes by class), ``probability`` and ``prediction`` (the first class of most votes), in Arrow batches."""

    parts = None  # of a spread model: its subtrees, which no driver or task holds all at once

    @classmethod
    def _of(cls, trees: list[dict], cuts: list[np.ndarray], classes: int, levels: tuple = ()) -> "DeepForestModel":
        model = cls()
        model._trees, model.cuts, model.numClasses, model.levels, model._shared = trees, cuts, classes, tuple(levels), None
        return model

    @classmethod
    def _spread(cls, parts: DataFrame, tops: list[dict], cuts: list[np.ndarray], classes: int, levels: tuple, rows: int) -> "DeepForestModel":
        model = cls._of(None, cuts, classes, levels)
        model.parts, model.tops, model.rows = parts, tops, rows
        return model

    @property
    def trees(self) -> list[dict]:
        """All trees on the driver; for a spread model they are collected."""
        if self._trees is None:
            self._trees = _collected(self.parts, self.tops, len(self.cuts), self.numClasses, self.levels)
        return self._trees

    @property
    def featureImportances(self):
        total, width = np.zeros(len(self.cuts)), len(self.cuts)
        if self._trees is None:
            each = [t["importance"].copy() for t in self.tops]
            for r in self.parts.select("tree", "node", "importance").orderBy("tree", "node").toLocalIterator():
                each[r["tree"]] += np.frombuffer(r["importance"], "float64", width)
        else:
            each = [t["importance"] for t in self._trees]
        for t in each:
            if (s := t.sum()) > 0:
                total += t / s
        return Vectors.dense(total / total.sum() if total.sum() > 0 else total)

    def votes(self, df: DataFrame, sizes: list[int], out: str, levels: tuple = ()) -> DataFrame:
        """Adds the votes of the first ``sizes`` trees, one array after the other, from one pass over the trees. For each of
        ``levels`` (some of those the model was grown with, rising) those of the trees cut there come before."""
        if set(levels) - set(self.levels):
            raise ValueError(f"the forest was grown to be cut at {self.levels}, not at {levels}")
        levels = list(levels)
        if self._trees is None and not df.isStreaming:
            return self._spread_votes(df, sizes, out, levels)
        if self._shared is None:
            # Sent once however often the model is asked.
            self._shared = df.sparkSession.sparkContext.broadcast((self.trees, self.cuts, self.numClasses))
        sent = self._shared

        @F.pandas_udf("array<double>")
        def votes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            trees, cuts, k = sent.value
            for batch in batches:
                x = _binned(_checked(batch, len(cuts), fit=False), cuts)
                got, kept = np.zeros((len(levels) + 1, len(x), k)), {}
                for i, t in enumerate(trees[:max(sizes)], 1):
                    got += t["table"][np.stack(_walk(t, x, levels))]
                    if i in sizes:
                        kept[i] = got.copy()
                yield pd.Series(_arrays(kept, sizes), index=batch.index, dtype=object)

        return df.withColumn(out, votes(vector_to_array(F.col(self.getFeaturesCol()))))

    def _spread_votes(self, df: DataFrame, sizes: list[int], out: str, levels: list[int]) -> DataFrame:
        """``votes`` by subtrees that are nowhere held all at once. Blocks of rows go to groups of subtrees; what each subtree says
        of a block (a place in a short table a row) meets by block, where trees are added up in their order."""
        width, k, cuts, tops = len(self.cuts), self.numClasses, self.cuts, self.tops
        used = self.parts.where(F.col("tree") < max(sizes))
        of, group, held = {}, 0, 0
        for r in _bytes(used).orderBy("tree", "node").collect():
            if held and held + r["size"] > GROUP_BYTES:
                group, held = group + 1, 0
            of[r["tree"], r["node"]], held = group, held + r["size"]
        row = "__row"
        while row.lower() in {c.lower() for c in df.columns}:
            row += "_"
        rows = checkpointed(df.withColumn(row, F.monotonically_increasing_id()))
        n = rows.count()
        # A subtree meets at most about as many rows as it, or any, may have been grown from.
        chunks = max(1, math.ceil(n / max(self.rows, LOCAL_ROWS)))

        def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for lo in range(0, len(b), BLOCK_ROWS):
                    some = b.iloc[lo:lo + BLOCK_ROWS]
                    x, asked = _binned(_checked(some["x"], width, fit=False), cuts), {}
                    for t in range(max(sizes)):
                        at = _route(tops, t, x)
                        for node in np.unique(at).tolist():
                            if (t, node) in of:
                                mask = asked.setdefault(of[t, node], np.zeros(len(x), bool))
                                mask |= at == node
                    block = int(some["row"].iloc[0])
                    yield pd.DataFrame([(block // BLOCK_ROWS % chunks, g, block, len(x), np.flatnonzero(m).astype("int32").tobytes(), x[m].tobytes()) for g, m in asked.items()],
                                       columns=["chunk", "grp", "block", "n", "pos", "x"])

        def said(key: tuple, b: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            blocks = [(block, size, np.frombuffer(p, "int32"), np.frombuffer(x, "uint8").reshape(-1, width)) for block, size, p, x in zip(b["block"], b["n"], b["pos"], b["x"])]
            out = []
            for t, node, *blobs in zip(*(trees[c] for c in ("tree", "node", "feature", "cut", "child", "share", "table"))):
                tree = {c: np.frombuffer(v, _TREE[c]) for c, v in zip(("feature", "cut", "child", "share", "table"), blobs)}
                table, top = tree["table"].reshape(-1, k), tops[t]
                base = top["level"][node]
                above = [_above(top, node, v) for v in levels if v < base]
                for block, size, pos, x in blocks:
                    mine = _route(tops, t, x) == node
                    if mine.any():
                        codes = np.stack(_walk(tree, x[mine], [v - base for v in levels if v >= base]))
                        short, spot = np.unique(codes, return_inverse=True)
                        spot = np.vstack([*[np.full(int(mine.sum()), i) for i in range(len(above))], spot.reshape(codes.shape) + len(above)])
                        out.append((block, size, t, pos[mine].tobytes(), spot.astype("int32").tobytes(), np.vstack([*above, table[short]]).tobytes()))
            return pd.DataFrame(out, columns=["block", "n", "tree", "pos", "spot", "table"])

        def added(key: tuple, b: pd.DataFrame) -> pd.DataFrame:
            size = int(b["n"].iloc[0])
            got, kept = np.zeros((len(levels) + 1, size, k)), {}
            b = b.sort_values("tree", kind="stable")
            b = list(zip(b["tree"], b["pos"], b["spot"], b["table"]))
            at = 0
            for t in range(max(sizes)):
                while at < len(b) and b[at][0] == t:
                    _, pos, spot, table = b[at]
                    pos = np.frombuffer(pos, "int32")
                    got[:, pos] += np.frombuffer(table).reshape(-1, k)[np.frombuffer(spot, "int32").reshape(-1, len(pos))]
                    at += 1
                if t + 1 in sizes:
                    kept[t + 1] = got.copy()
            return pd.DataFrame({"row": int(key[0]) + np.arange(size), "votes": pd.Series(_arrays(kept, sizes), dtype=object)})

        spark = df.sparkSession
        groups = F.broadcast(spark.createDataFrame([(*at, g) for at, g in of.items()], "tree int, node int, grp int"))  # a row a subtree
        x = rows.select(F.col(row).alias("row"), vector_to_array(F.col(self.getFeaturesCol())).alias("x"))
        asked = x.mapInPandas(dealt, "chunk long, grp int, block long, n int, pos binary, x binary")
        trees = used.drop("importance").join(groups, ["tree", "node"]).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
        tasks = min(chunks * (group + 1), 2_000)
        asked, trees = (d.repartition(tasks, "chunk", "grp").groupBy("chunk", "grp") for d in (asked, trees))
        heard = asked.cogroup(trees).applyInPandas(said, "block long, n int, tree int, pos binary, spot binary, table binary")
        heard = heard.repartition(max(1, min(math.ceil(n / BLOCK_ROWS), 2_000)), "block")
        voted = heard.groupBy("block").applyInPandas(added, "row long, votes array<double>")
        joined = rows.join(voted.hint("merge"), rows[row] == voted["row"])
        return joined.select(*[rows[f"`{c}`"] for c in df.columns if c.lower() != out.lower()], voted["votes"].alias(out))

    def _transform(self, df: DataFrame) -> DataFrame:
        d = self.votes(df, [len(self._trees or self.tops)], "__votes")
        total = F.aggregate("__votes", F.lit(0.0), lambda a, v: a + v)
        return d.withColumns({"rawPrediction": array_to_vector("__votes"),
                              "probability": array_to_vector(F.transform("__votes", lambda v: F.try_divide(v, total))),
                              "prediction": prediction_of(F.col("__votes"))}).drop("__votes")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


def _arrays(kept: dict[int, np.ndarray], sizes: list[int]) -> list[np.ndarray]:
    """One array a row: by level, then by number of trees, the votes for each class."""
    return list(np.concatenate([kept[s][i] for i in range(len(kept[sizes[0]])) for s in sizes], axis=1))


def _above(top: dict, node: int, level: int) -> np.ndarray:
    """Class shares of the node at ``level`` above ``node``."""
    while top["level"][node] > level:
        node = top["parent"][node]
    return top["counts"][node][None] / top["counts"][node].sum()


def prediction_of(votes):
    """The first class of most votes."""
    return (F.array_position(votes, F.array_max(votes)) - 1).cast("double")


_TREE = {"feature": "int16", "cut": "uint8", "child": "int32", "share": "int32", "table": "float64", "importance": "float64"}


class _ForestWriter(MLWriter):
    def __init__(self, model: DeepForestModel):
        super().__init__()
        self.instance = model

    def saveImpl(self, path: str) -> None:
        m = self.instance
        extra = {"cuts": json.dumps([c.tolist() for c in m.cuts]), "numClasses": m.numClasses, "levels": json.dumps(m.levels)}
        if m.parts is not None:  # its subtrees as they are
            plain = [{**t, "importance": t["importance"].tolist(), "counts": {node: c.tolist() for node, c in t["counts"].items()}} for t in m.tops]
            DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={**extra, "tops": json.dumps(plain), "rows": m.rows})
            m.parts.write.parquet(f"{path}/parts")
            return
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata=extra)
        rows = [(i, *[t[c].astype(kind).tobytes() for c, kind in _TREE.items()]) for i, t in enumerate(m.trees)]
        self.sparkSession.createDataFrame(rows, "tree int, " + ", ".join(f"{c} binary" for c in _TREE)).write.parquet(f"{path}/trees")


class _ForestReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> DeepForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        k, trees = meta["numClasses"], []
        cuts, levels = [np.array(c, "float64") for c in json.loads(meta["cuts"])], tuple(json.loads(meta.get("levels", "[]")))
        if "tops" in meta:
            tops = [{**t, "importance": np.array(t["importance"]), "counts": {int(node): np.array(c) for node, c in t["counts"].items()}} for t in json.loads(meta["tops"])]
            # Copied: what is saved may be overwritten or go.
            return self._named(self.cls._spread(checkpointed(self.sparkSession.read.parquet(f"{path}/parts")), tops, cuts, k, levels, meta["rows"]), meta)
        for r in sorted(self.sparkSession.read.parquet(f"{path}/trees").collect(), key=lambda r: r["tree"]):
            t = {c: np.frombuffer(r[c], kind) for c, kind in _TREE.items()}
            trees.append({**t, "table": t["table"].reshape(-1, k)})
        return self._named(self.cls._of(trees, cuts, k, levels), meta)

    def _named(self, model: DeepForestModel, meta: dict) -> DeepForestModel:
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model
