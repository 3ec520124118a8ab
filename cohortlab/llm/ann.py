"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph; the graph is cut into
parts of equal size with few edges between them; a small classifier learns
which parts hold a vector's neighbours. Every vector is indexed under its most
probable part, and a query visits its most probable parts, where all vectors
are reranked by their exact inner product in double precision.

The number of visited parts is set on the sample: the fewest that reach the
asked recall there, where neighbours are sparser and thus harder than in the
whole table. Parts that would hold too many vectors are parted again, each by a
router that Spark fits on a sample of that part. Rows of a cell are dealt into blocks of a bounded size by a
hash of the id, so a cell that holds very many vectors is many small tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from cohortlab.llm.common import arrow_map, checkpointed


def valid(vector: Column) -> Column:
    """Not null, not empty, all components present and finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


# ------------------------------------------------------------- fit on the sample (driver, numpy)

def neighbour_graph(x: np.ndarray, k: int, block: int = 1024) -> np.ndarray:
    """Indices of the k largest inner products of each row, itself left out."""
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), block):
        s = x[at:at + block] @ x.T
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        out[at:at + block] = np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1)
    return out


def _halved(nodes: np.ndarray, u: np.ndarray, v: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Two halves of equal size with few edges (u, v) between them: split at the
    median of the graph's slowest smooth vector, then swap what gains."""
    n = len(nodes)
    degree = np.bincount(u, minlength=n) + 1e-9
    y = rng.normal(size=n)
    for _ in range(60):  # power iteration on the averaging operator, the constant vector taken out
        y = 0.5 * (y + np.bincount(u, y[v], n) / degree)
        y -= (y * degree).sum() / degree.sum()
        y /= np.abs(y).max() + 1e-12
    side = np.zeros(n, bool)
    side[np.argsort(y, kind="stable")[n // 2:]] = True
    for _ in range(10):  # swap the pairs with the largest gains, half of them at a time
        other = np.bincount(u, (side[u] != side[v]).astype(float), n)
        gain = 2 * other - np.bincount(u, minlength=n)
        a, b = np.flatnonzero(~side), np.flatnonzero(side)
        a, b = a[np.argsort(-gain[a], kind="stable")], b[np.argsort(-gain[b], kind="stable")]
        m = min(len(a), len(b))
        swaps = int((gain[a[:m]] + gain[b[:m]] > 0).sum())
        if not swaps:
            break
        swaps = (swaps + 1) // 2
        side[a[:swaps]], side[b[:swaps]] = True, False
    return np.flatnonzero(~side), np.flatnonzero(side)


def balanced_parts(graph: np.ndarray, parts: int, seed: int) -> np.ndarray:
    """Part of each node; ``parts`` is a power of two, sizes differ by one at most per level."""
    rng = np.random.default_rng(seed)
    n, k = graph.shape
    src, dst = np.repeat(np.arange(n), k), graph.ravel()
    u, v = np.concatenate([src, dst]), np.concatenate([dst, src])
    part = np.zeros(n, np.int64)
    for _ in range(parts.bit_length() - 1):
        new = part * 2
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            place = np.full(n, -1)
            place[nodes] = np.arange(len(nodes))
            inside = (place[u] >= 0) & (place[v] >= 0)
            _, high = _halved(nodes, place[u[inside]], place[v[inside]], rng)
            new[nodes[high]] += 1
        part = new
    return part


@dataclass
class Router:
    """One hidden layer; probabilities over the parts."""
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    visits: int = 1

    def logits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w1 + self.b1, 0)
        return h, h @ self.w2 + self.b2

    def order(self, x: np.ndarray) -> np.ndarray:
        return np.argsort(-self.logits(x)[1], axis=1, kind="stable")


def train_router(x: np.ndarray, target: np.ndarray, hidden: int, epochs: int, seed: int) -> Router:
    """Cross entropy against ``target`` (shares of the parts among a vector's neighbours), Adam."""
    rng = np.random.default_rng(seed)
    d, p = x.shape[1], target.shape[1]
    net = Router(rng.normal(0, np.sqrt(2 / d), (d, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), (hidden, p)), np.zeros(p))
    names = ("w1", "b1", "w2", "b2")
    m, v, t = {n: 0.0 for n in names}, {n: 0.0 for n in names}, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            h, z = net.logits(x[rows])
            e = np.exp(z - z.max(axis=1, keepdims=True))
            g = (e / e.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            gh = (g @ net.w2.T) * (h > 0)
            t += 1
            for n, grad in zip(names, (x[rows].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                m[n] = 0.9 * m[n] + 0.1 * grad
                v[n] = 0.999 * v[n] + 0.001 * grad * grad
                setattr(net, n, getattr(net, n) - 2e-3 * (m[n] / (1 - 0.9 ** t)) / (np.sqrt(v[n] / (1 - 0.999 ** t)) + 1e-8))
    return net


def fit_router(x: np.ndarray, parts: int, k: int, recall: float, hidden: int, epochs: int, seed: int) -> Router:
    """Graph, parts and classifier of a sample. ``visits`` is the fewest parts
    that reach ``recall`` on a fifth of the sample that the classifier hasn't seen."""
    graph = neighbour_graph(x, min(k, len(x) - 1))
    part = balanced_parts(graph, parts, seed)
    k = graph.shape[1]
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x))[:, None], part[graph]), 1.0 / (k + 1))
    target[np.arange(len(x)), part] += 1.0 / (k + 1)
    held = np.arange(len(x)) % 5 == 0
    net = train_router(x[~held], target[~held], hidden, epochs, seed)
    order = net.order(x)
    home = order[:, 0]  # where the index puts each vector
    place = np.argsort(order[held], axis=1)  # rank of each part for the held-out queries
    found = np.take_along_axis(place, home[graph[held]], 1)
    shares = np.array([(found <= m).mean() for m in range(parts)])
    net.visits = int(np.argmax(shares >= recall)) + 1
    return net


def parts_for(rows: int, rows_per_part: int) -> int:
    """Parts of a sample: a power of two with at most ``rows_per_part`` rows in each, two at least; one for less than 16 rows."""
    return 1 if rows < 16 else 1 << max(1, (-(-rows // rows_per_part) - 1).bit_length())


@dataclass
class Cells:
    """The routers of both levels. A cell is (part, part of that part), numbered part x ``finer`` + inner part."""
    top: Router | None
    inner: dict[int, Router]
    parts: int
    finer: int

    def home(self, x: np.ndarray) -> np.ndarray:
        part = self.top.order(x)[:, 0] if self.top else np.zeros(len(x), np.int64)
        cell = part * self.finer
        for p in np.unique(part):
            if p in self.inner:
                cell[part == p] += self.inner[p].order(x[part == p])[:, 0]
        return cell

    def visited(self, x: np.ndarray, sizes: dict[int, int], least: int) -> list[list[int]]:
        """The cells each query visits: its most probable parts, in each the most probable inner parts, and all cells of further
        parts until they hold ``least`` vectors."""
        order = self.top.order(x) if self.top else np.zeros((len(x), 1), np.int64)
        visits = self.top.visits if self.top else 1
        inner = {p: net.order(x) for p, net in self.inner.items()}
        out = []
        for i, parts in enumerate(order.tolist()):
            cells, have = [], 0
            for rank, p in enumerate(parts):
                if rank >= visits and have >= least:
                    break
                whole = rank >= visits or p not in inner
                own = range(self.finer) if whole else inner[p][i, :self.inner[p].visits].tolist()
                new = [c for c in (p * self.finer + s for s in own) if c in sizes]
                cells, have = cells + new, have + sum(sizes[c] for c in new)
            if have < least:  # the inner parts left out
                cells = list(sizes)
            out.append(cells)
        return out


# ------------------------------------------------------------- search (Spark)

def _inner_routers(index: DataFrame, big: list[int], finer: int, rows: int, fit: dict) -> dict[int, Router]:
    """A router for each part in ``big``, fitted by Spark tasks on ``rows`` of its vectors (those of smallest id hash).
    What comes back is bounded: a part's router, for at most ``sample / rows_per_part`` parts."""
    w = W.partitionBy("part").orderBy(F.xxhash64("vec_id"), "vec_id")
    picked = index.where(F.col("part").isin(big)).withColumn("r", F.row_number().over(w)).where(F.col("r") <= rows).drop("r")

    def fitted(t: pa.Table) -> pa.Table:
        x = np.array(t.column("v").to_pylist(), dtype=np.float64)
        net = fit_router(x, finer, **fit)
        flat = [w.ravel().tolist() for w in (net.w1, net.b1, net.w2, net.b2)]
        return pa.table({"part": pa.array([t.column("part")[0].as_py()], pa.int32()), "visits": pa.array([net.visits], pa.int32()),
                         **{n: pa.array([f], pa.list_(pa.float64())) for n, f in zip(("w1", "b1", "w2", "b2"), flat)}})

    got = picked.groupBy("part").applyInArrow(
        fitted, "part int, visits int, w1 array<double>, b1 array<double>, w2 array<double>, b2 array<double>").collect()
    h = fit["hidden"]
    return {r["part"]: Router(np.reshape(r["w1"], (-1, h)), np.array(r["b1"]), np.reshape(r["w2"], (h, -1)), np.array(r["b2"]), r["visits"]) for r in got}


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           sample: int = 8192, rows_per_part: int = 64, part_rows: int = 65536, graph_k: int = 20, recall: float = 0.94,
           hidden: int = 128, epochs: int = 25, block: int = 4096, query_block: int = 512, seed: int = 11) -> DataFrame:
    """(query_id, rank, vec_id, score, visited): the ``k`` nearest found of each row of
    ``queries`` among all rows of ``vectors`` with another id, nearest first,
    ties to the smaller id; score is the inner product in double precision, ``visited`` the number of vectors the query was
    compared with.

    ``sample`` bounds the rows that the fit sees (those of smallest id hash); a
    part stands for at most ``rows_per_part`` of them. Where parts of the table are expected to hold more than ``part_rows``
    vectors, each is parted again by a router of its own, fitted on a sample of its own vectors, so the size of a
    cell does not grow with the table. Every vector is indexed. A query visits the cells
    that reach the asked ``recall`` on held-out sample rows, and further ones until these hold more
    than ``k`` vectors, so all candidates come back if there are fewer. Vectors
    that are null, empty, zero, hold null or non-finite components, have a null
    id, or not the most frequent length take no part. Rows that repeat an id
    are one vector, that of the largest components. Other columns are not used.

    Fewer than 16 vectors are one part. Pairs of a query block and a candidate block are one row each, spread by cell and blocks, so
    neither a cell nor a group of equal vectors meets in one task.
    """
    def clean(df: DataFrame) -> DataFrame:
        v = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
        return v.where(F.col("vec_id").isNotNull() & valid(F.col("v"))).groupBy("vec_id").agg(F.max("v").alias("v"))

    spark = vectors.sparkSession
    base, asked = clean(vectors), clean(queries)
    out = "query_id long, rank int, vec_id long, score double, visited long"
    lengths = base.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if lengths is None:
        return spark.createDataFrame([], out)
    base, asked = base.where(F.size("v") == lengths["d"]), asked.where(F.size("v") == lengths["d"])
    picked = base.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    x = np.array([r["v"] for r in picked])
    parts = parts_for(len(x), rows_per_part)
    finer = 1
    while lengths["n"] > parts * finer * part_rows and finer * rows_per_part < sample:
        finer *= 2
    levels = recall ** 0.5 if finer > 1 else recall
    fit = {"k": graph_k, "recall": levels, "epochs": epochs, "seed": seed}
    cells = Cells(fit_router(x, parts, hidden=hidden, **fit) if parts > 1 else None, {}, parts, finer)

    def matrix(column) -> np.ndarray:
        return np.array(column.flatten(), dtype=np.float64).reshape(len(column), lengths["d"])

    def indexed(df: DataFrame, cells: Cells, name: str) -> DataFrame:
        def home(b: pa.RecordBatch) -> pa.RecordBatch:
            own = cells.home(matrix(b.column(1))) if b.num_rows else np.zeros(0, np.int64)
            return pa.RecordBatch.from_arrays([*b.columns[:2], pa.array(own, pa.int32())], names=["vec_id", "v", name])
        return checkpointed(arrow_map(df.select("vec_id", "v"), home, f"vec_id long, v array<double>, {name} int"))

    if finer > 1:
        first = indexed(base, Cells(cells.top, {}, parts, 1), "part")
        rows = finer * rows_per_part
        big = [r["part"] for r in first.groupBy("part").count().where(F.col("count") >= rows).collect()]  # at most ``parts``
        cells.inner = _inner_routers(first, big, finer, rows, {**fit, "hidden": max(8, hidden // 4)}) if big else {}
        base = first
    index = indexed(base, cells, "cell")
    held = checkpointed(index.groupBy("cell").agg(F.count("*").alias("n")))  # at most parts x finer rows, bounded by the parameters
    sizes = {r["cell"]: r["n"] for r in held.collect()}

    def visit(b: pa.RecordBatch) -> pa.RecordBatch:
        to = cells.visited(matrix(b.column(1)), sizes, k + 1) if b.num_rows else []
        seen = [sum(sizes[c] for c in cs) for cs in to]
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(to, pa.list_(pa.int32())), pa.array(seen, pa.int64())], names=["vec_id", "v", "cells", "visited"])

    routed = checkpointed(arrow_map(asked, visit, "vec_id long, v array<double>, cells array<int>, visited long"))
    each = routed.select("vec_id", "v", F.explode("cells").alias("cell"))

    def blocks(df: DataFrame, counts: DataFrame, rows: int, name: str) -> DataFrame:
        """Vectors of a cell in blocks of about ``rows``, by a hash of the id; ``counts`` has a row a cell."""
        n = F.greatest(F.ceil(F.col("n") / rows), F.lit(1))
        return (df.join(F.broadcast(counts), "cell").groupBy("cell", F.pmod(F.xxhash64("vec_id"), n).alias(f"{name}_deal"))
                .agg(F.collect_list(F.struct("vec_id", "v")).alias("rows"))
                .select("cell", f"{name}_deal", F.col("rows.vec_id").alias(f"{name}_ids"), F.col("rows.v").alias(f"{name}_v")))

    # A query block meets each candidate block of its cell, by a key of its own for every 16 query blocks.
    asks = checkpointed(each.groupBy("cell").agg(F.count("*").alias("n")))
    deals = held.select("cell", F.ceil(F.col("n") / block).alias("n_c")).join(asks.select("cell", F.ceil(F.col("n") / query_block).alias("n_q")), "cell")
    q = (blocks(each, asks, query_block, "q").join(F.broadcast(deals.select("cell", "n_c")), "cell")
         .withColumn("c_deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_c") - 1))).withColumn("group", F.floor(F.col("q_deal") / 16)))
    c = (blocks(index, held, block, "c").join(F.broadcast(deals.select("cell", "n_q")), "cell")
         .withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_q") - 1) / 16)))))
    pairs = q.join(c, ["cell", "c_deal", "group"])

    def rerank(b: pa.RecordBatch):
        for i in range(b.num_rows):
            qi, ci = (np.array(b.column(n)[i].values, dtype=np.int64) for n in (0, 2))
            q, c = (np.array(b.column(n)[i].values.flatten(), dtype=np.float64).reshape(-1, lengths["d"]) for n in (1, 3))
            by_id = np.argsort(ci, kind="stable")  # equal scores then come with the smaller id first
            ci, c = ci[by_id], c[by_id]
            s = q @ c.T
            s[qi[:, None] == ci[None, :]] = -np.inf
            top = np.argsort(-s, axis=1, kind="stable")[:, :k]
            score = np.take_along_axis(s, top, 1)
            keep = score > -np.inf
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.broadcast_to(qi[:, None], top.shape)[keep]), pa.array(ci[top][keep]), pa.array(score[keep])],
                names=["query_id", "vec_id", "score"])

    near = arrow_map(pairs.select("q_ids", "q_v", "c_ids", "c_v"), rerank, "query_id long, vec_id long, score double")
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    seen = routed.select(F.col("vec_id").alias("query_id"), "visited")
    return ranked.join(seen, "query_id").select("query_id", "rank", "vec_id", "score", "visited")
