"""SimHash near-dedup with covering locality-sensitive hashing.

Fingerprints: 64-bit majority of the XXH64 values of word shingles. Links:
pairs of fingerprints at most ``radius`` bits apart, found without comparing
all pairs. Every bit position gets a non-zero vector of ``radius + 1`` bits;
for each non-zero vector v, a mask holds the positions whose vector has an odd
product with v. The positions where two fingerprints differ span at most
``radius`` dimensions, so some v is orthogonal to all of them, and under its
mask the two are equal: with 2^(radius + 1) - 1 tables no pair is missed.

Only distinct fingerprints enter the tables, so exact copies cost nothing. A
bucket that still holds more than ``block`` fingerprints is not compared as it
is: its pairs agree on the mask, so the same construction over the bits that
the mask leaves free splits it further, again without a miss, until a bucket
has at most ``block`` members or at most 8 free bits (256 members). Inside a
bucket a numpy search joins what is within the radius and puts out a spanning
forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import arrow_map, checkpointed, join_per_key
from cohortlab.llm.graph import components

BITS = 64
SEED = 42
# Shingles hashed at a time: bounds the memory that one very long text takes.
SLAB = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The fingerprint of a whole text as a signed 64-bit number.

    A-Z lower-cased; words are runs of other characters than code points 20
    and 09-0D (what ``bytes.lower`` and ``bytes.split`` do on UTF-8). Fewer
    words than a shingle: all of them are one; none: zero."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    begins = begins[:n].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, SLAB):
        h = np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in zip(begins[at:at + SLAB], stops[at:at + SLAB])), "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp) per row, whole texts; a null or empty text has fingerprint zero.
    An id of several fields (a struct) stays one, any other is a long."""
    kind = dict(docs.dtypes)[id_col]
    kind = kind if kind.startswith("struct<") else "long"
    base = docs.select(F.col(id_col).cast(kind).alias("doc_id"), F.col(text_col).alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        fp = [fingerprint(x, shingle) for x in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return arrow_map(base, run, f"doc_id {kind}, fp long")


def covering(free: list[int], radius: int) -> list[int]:
    """Masks over the bit positions ``free`` that cover every set of at most
    ``radius`` of them: some mask avoids the whole set."""
    vectors = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, vectors + 1):
        out.append(sum(1 << p for k, p in enumerate(free) if (v & (1 + k % vectors)).bit_count() % 2))
    return sorted(set(out))


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _refined(mask: int, radius: int) -> list[int]:
    free = [p for p in range(BITS) if not mask >> p & 1]
    return [mask | m for m in covering(free, radius)]


def _forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Edges of a spanning forest of one bucket: each search takes what it reaches out of the rest."""
    rest = np.sort(fps.view(np.uint64))
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            u = queue.pop()
            near = np.bitwise_count(rest ^ u) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                for x in found:
                    yield int(u.view(np.int64)), int(x.view(np.int64))
                queue.extend(found)


def near_links(fps: DataFrame, radius: int = 4, block: int = 2048) -> DataFrame:
    """(u, v): links between distinct fingerprints (column ``fp``) that keep
    together whatever a chain of pairs at most ``radius`` bits apart joins."""
    if block < 256:
        raise ValueError("a bucket with 8 free bits may hold 256 fingerprints")
    spark = fps.sparkSession

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        pairs = [p for x in b.column(0) for p in _forest(np.array(x.values, dtype=np.int64), radius)]
        u, v = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    masks = _refined(0, radius)
    dealt = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)) for m in masks])).alias("mask"))
    links = None
    while True:
        keyed = dealt.select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        sizes = keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        # Spark sizes both sides by the fingerprints before they are dealt to the masks: unhinted, it would broadcast them 31 times as large.
        full = checkpointed(keyed.join(sizes.hint("merge"), ["mask", "key"]))
        last = all(BITS - m.bit_count() <= 8 for m in masks)
        cold = full if last else full.where(F.col("n") <= block)
        found = arrow_map(cold.groupBy("mask", "key").agg(F.collect_list("fp").alias("fps")).select("fps"), run, "u long, v long")
        links = found if links is None else links.unionByName(found)
        hot = full.where(F.col("n") > block)
        if last or hot.isEmpty():
            return links
        # Over-full buckets only: the masks that refine theirs. At most 31 and then 961 rows of masks.
        finer = {m: _refined(m, radius) if BITS - m.bit_count() > 8 else [m] for m in masks}
        steps = spark.createDataFrame([(_signed(m), [_signed(x) for x in xs]) for m, xs in finer.items()],
                                      "mask long, finer array<long>")
        masks = sorted({x for xs in finer.values() for x in xs})
        dealt = hot.join(F.broadcast(steps), "mask").select("fp", F.explode("finer").alias("mask")).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
               radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``: the fingerprint and the
    smallest id of all documents that a chain of links reaches, itself included.

    Equal fingerprints are always linked; a text without words has fingerprint
    zero and is linked like any other. Rows that repeat an id come back as
    often as they stand there. A null id never is the smallest; a group of
    null ids only has a null component. Other columns are not used. An empty
    table gives an empty result.
    """
    fps = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    links = near_links(nodes.select("fp"), radius)
    # The smallest id of a component, for the fingerprints that have links.
    grouped = checkpointed(nodes.join(components(links).withColumnRenamed("node", "fp"), "fp").select("fp", "root", "first"))
    lowest = grouped.groupBy("root").agg(F.min("first").alias("lowest"), F.count("*").alias("n"))
    linked = join_per_key(grouped, lowest, "root").select("fp", "lowest")
    every = nodes.join(linked, "fp", "left").select("fp", F.coalesce("lowest", "first").alias("component_id"), "n")
    return join_per_key(fps, every, "fp").select("doc_id", "fp", "component_id")


def hex16(fp) -> F.Column:
    """A fingerprint as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
