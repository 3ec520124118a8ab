"""Conversation prefix trie by truncation peeling.

A node is a distinct sequence of first turns. The trie is found from its
deepest level up: at depth d the conversations that end there join the nodes
that survive from depth d+1 with their last turn stripped, rows of equal
sequences are merged, and the merge sums up what the subtrees hold. So nodes
are discovered and aggregated in one pass, and what a level shuffles is what
is alive at it.

A sequence is known by 128 bits: the exclusive or of a hash of each turn with
its position. Stripping a turn takes its hash out again. Turns are hashed
where they are read, so texts never travel with the nodes; the hashes of a
conversation's turns lie in blocks of ``BLOCK`` and a node carries the rest of
one block only. Equal conversations are merged before the first level and
every merge is combined before its shuffle, so hot conversations and hot first
turns are counted, not gathered.

Levels with few rows alive (``few``, typically the long tail of a few very long
conversations) are peeled several at a time by one task of bounded size,
by the same rule.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlab.llm.common import checkpointed, join_per_key, scratch_dir

# Turns in one stored block of a conversation.
BLOCK = 64
# Turn rows that one task peels at most when it takes several levels at once.
TASK_TURNS = 200_000
# Ids that differ in their last bits only are digested in one piece: at most 4096 ids.
ID_BITS = 12

STEP = "struct<h1:bigint,h2:bigint,words:bigint>"
NODE = ("depth int, k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def numbered(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, t1, t2, words): the turns numbered from 1 by turn (null first), role, text; null roles and texts
    are empty, repeated rows all count, rows without conversation id are left out. The numbering streams through
    one conversation's turns, on disk if need be."""
    t = turns.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return t.select("conv_id", F.row_number().over(w).cast("long").alias("pos"), F.xxhash64("role", "text").alias("t1"),
                    F.xxhash64(F.lit(1), "text", "role").alias("t2"), words(F.col("text")).alias("words"))


def _classes(steps: DataFrame, convs: DataFrame, base: str) -> tuple[DataFrame, DataFrame]:
    """Distinct sequences and their turns.

    First: (conv_id, n_turns, k1, k2, n_convs, ends_sha256), one row per distinct sequence, named by its smallest
    conversation. Second: (conv_id, block, steps), the turns of those conversations in blocks.
    """
    hashed = steps.select("conv_id", "pos", F.xxhash64("pos", "t1").alias("h1"), F.xxhash64("t2", "pos").alias("h2"), "words")
    blocks = (hashed.groupBy("conv_id", F.floor((F.col("pos") - 1) / BLOCK).cast("int").alias("block"))
              .agg(F.sort_array(F.collect_list(F.struct("pos", "h1", "h2", "words"))).alias("steps"),
                   F.bit_xor("h1").alias("k1"), F.bit_xor("h2").alias("k2"))
              .withColumn("steps", F.transform("steps", lambda s: F.struct(s["h1"].alias("h1"), s["h2"].alias("h2"), s["words"].alias("words")))))
    blocks.write.parquet(f"{base}/blocks")
    blocks = steps.sparkSession.read.parquet(f"{base}/blocks")
    whole = blocks.groupBy("conv_id").agg(F.bit_xor("k1").alias("k1"), F.bit_xor("k2").alias("k2"), F.sum(F.size("steps")).cast("int").alias("n_turns"))
    whole = checkpointed(convs.join(whole, "conv_id", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("k1", "k2")], F.coalesce("n_turns", F.lit(0)).alias("n_turns")))
    key = ["n_turns", "k1", "k2"]
    merged = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    # Both in the order in which the levels read them, so that a level reads its own row groups only.
    (merged.join(_id_digests(whole, key), key).repartitionByRange("n_turns", "conv_id").sortWithinPartitions("n_turns", "conv_id")
     .write.parquet(f"{base}/classes"))
    classes = steps.sparkSession.read.parquet(f"{base}/classes")
    (blocks.join(classes.select("conv_id"), "conv_id", "left_semi").select("conv_id", "block", "steps")
     .repartitionByRange("block", "conv_id").sortWithinPartitions("block", "conv_id").write.parquet(f"{base}/kept"))
    return classes, steps.sparkSession.read.parquet(f"{base}/kept")


def _id_digests(whole: DataFrame, key: list[str]) -> DataFrame:
    """SHA-256 of the ids of each class, ascending, joined by commas.

    Ids are joined to pieces of at most 4096 ids where they are; the pieces of a class are read in order by
    one task, as SHA-256 can only be computed, but never held together.
    """
    pieces = (whole.groupBy(*key, F.shiftright("conv_id", ID_BITS).alias("span"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))
    pieces = pieces.repartition(*key).sortWithinPartitions(*key, "span")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sha = None, None
        for b in batches:
            done = []
            for *k, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if k == last:
                    sha.update(b",")
                else:
                    if last is not None:
                        done.append([*last, sha.hexdigest()])
                    last, sha = k, hashlib.sha256()
                sha.update(ids.encode())
            yield _batch(done)
        if last is not None:
            yield _batch([[*last, sha.hexdigest()]])

    def _batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
            (pa.int32(), pa.int64(), pa.int64(), pa.string()))], [*key, "ends_sha256"])

    return pieces.mapInArrow(run, "n_turns int, k1 long, k2 long, ends_sha256 string")


def _plan(alive: list[int], few: int) -> list[tuple[int, int]]:
    """Levels to peel, from the deepest to 1, as (highest, lowest) of one step: several where at most ``few`` rows are
    alive and ``TASK_TURNS`` turns in all, else one. ``alive[d]``: distinct sequences of at least d turns."""
    steps, d = [], len(alive) - 1
    while d > 0:
        low, total = d, alive[d]
        while low > 1 and alive[low - 1] <= few and total + alive[low - 1] <= TASK_TURNS:
            low -= 1
            total += alive[low]
        steps.append((d, low))
        d = low - 1
    return steps


def trie(conversations: DataFrame, few: int = 64, **columns: str) -> DataFrame:
    """Nodes of the prefix trie of a table of turns, taken as ``numbered`` does; see ``trie_of``."""
    steps = checkpointed(numbered(conversations, **columns))
    return trie_of(steps, steps.where("pos = 1").select("conv_id"), few)


def trie_of(steps: DataFrame, convs: DataFrame, few: int = 64) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256.

    ``steps``: (conv_id, pos, t1, t2, words), each conversation's turns numbered from 1 without gaps; ``convs``: the
    ids (conv_id), once each, those without turns included. Members of a node are the conversations that start with
    its turns; the root, of depth 0, has all. ``saved_tokens`` sums, over the node's subtree, (n_convs - 1) x words
    of a node's last turn; ``ends_sha256`` digests the ids that end at the node. No conversations: no nodes.
    """
    spark = steps.sparkSession
    base = scratch_dir(spark, "trie")
    classes, blocks = _classes(steps, convs, base)
    lengths = {r["n_turns"]: r["n"] for r in classes.groupBy("n_turns").agg(F.count("*").alias("n")).collect()}
    if not lengths:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                         "n_leaves long, saved_tokens long, ends_sha256 string")
    alive = [0] * (max(lengths) + 1)
    total = 0
    for d in range(max(lengths), -1, -1):
        total += lengths.get(d, 0)
        alive[d] = total

    def parents(high: int) -> DataFrame:
        """What the level above ``high`` left, its last turn stripped: rows for the level ``high``."""
        return (spark.read.schema(NODE + f", steps array<{STEP}>").parquet(f"{base}/nodes/{high + 1}").where(F.col("depth") == high + 1)
                .select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"),
                        "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends_sha256"), "steps"))

    ended = classes.select("n_turns", "k1", "k2", "conv_id", "n_convs", *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")],
                           "ends_sha256", F.lit(None).cast(f"array<{STEP}>").alias("steps"))
    written = []
    above = False  # whether a deeper level was written
    for high, low in _plan(alive, few):
        rows = ended.where(F.col("n_turns").between(low, high))
        if low == high:
            level = rows.drop("n_turns")
            level = level.unionByName(parents(high)) if above else level
            nodes = _level(level, blocks, high)
        else:
            level = rows.withColumnRenamed("n_turns", "depth")
            level = level.unionByName(parents(high).withColumn("depth", F.lit(high))) if above else level
            nodes = _levels(level, blocks, high, low)
        nodes.write.parquet(f"{base}/nodes/{low}")
        written.append(low)
        above = True
    top = ended.where("n_turns = 0").drop("n_turns")
    top = top.unionByName(parents(0)) if above else top
    nothing = F.lit(0).cast("long")
    root = _merged(top).select(F.lit(0).alias("depth"), "k1", "k2", nothing.alias("p1"), nothing.alias("p2"), "conv_id", "n_convs", "n_children",
                               _leaves().alias("n_leaves"), "saved_tokens", _ends().alias("ends_sha256"))
    nodes = checkpointed(root)
    if written:
        nodes = nodes.unionByName(spark.read.schema(NODE).parquet(*[f"{base}/nodes/{d}" for d in written]))
    return _with_parents(nodes)


def _leaves() -> Column:
    return F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("n_leaves"))


def _ends() -> Column:
    return F.coalesce("ends_sha256", F.lit(EMPTY_SHA))


def _merged(level: DataFrame) -> DataFrame:
    """Rows of equal sequences become one. Few numbers a row, combined before the shuffle."""
    return level.groupBy("k1", "k2").agg(
        F.min(F.struct("conv_id", "steps")).alias("least"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("ends_sha256").alias("ends_sha256")).select("k1", "k2", "least.*", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _level(level: DataFrame, blocks: DataFrame, depth: int) -> DataFrame:
    """Nodes of one depth, with the key of their parent and the turns of their block that lie above."""
    nodes = _merged(level)
    # Nodes that have no turns with them (their smallest conversation ends here, or the block is used up) fetch their block.
    # Nodes of one depth have different smallest conversations, so no key repeats on either side.
    at = (depth - 1) // BLOCK
    own = blocks.where(F.col("block") == at).select(F.col("conv_id").alias("own_id"), F.col("steps").alias("own"))
    nodes = nodes.join(own, (F.col("conv_id") == F.col("own_id")) & F.col("steps").isNull(), "left")
    here = depth - at * BLOCK
    nodes = nodes.withColumn("steps", F.slice(F.coalesce("steps", "own"), 1, here)).withColumn("last", F.get("steps", F.lit(here - 1)))
    rest = F.when(F.lit(here > 1), F.slice("steps", 1, max(here - 1, 1)))
    return nodes.select(F.lit(depth).alias("depth"), "k1", "k2", F.col("k1").bitwiseXOR(F.col("last.h1")).alias("p1"),
                        F.col("k2").bitwiseXOR(F.col("last.h2")).alias("p2"), "conv_id", "n_convs", "n_children", _leaves().alias("n_leaves"),
                        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("last.words")).alias("saved_tokens"),
                        _ends().alias("ends_sha256"), rest.alias("steps"))


def _levels(level: DataFrame, blocks: DataFrame, high: int, low: int) -> DataFrame:
    """Nodes of the depths ``high`` to ``low``, peeled by one task: its rows and turns are bounded by ``few`` and ``TASK_TURNS``."""
    first, last = (low - 1) // BLOCK, (high - 1) // BLOCK
    own = (blocks.where(F.col("block").between(first, last)).join(level.select("conv_id").distinct(), "conv_id", "left_semi")
           .select("conv_id", "block", "steps"))
    turns = own.groupBy("conv_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("block", "steps"))), lambda b: b["steps"])).alias("path"))
    rows = level.drop("steps").join(turns, "conv_id").select(
        "depth", "k1", "k2", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", F.col("path.h1").alias("h1"),
        F.col("path.h2").alias("h2"), F.col("path.words").alias("words"))
    skip = first * BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh: dict[int, list] = {}
        paths = {}
        for b in batches:
            for r in b.to_pylist():
                fresh.setdefault(r["depth"], []).append(r)
                paths[r["conv_id"]] = r["h1"], r["h2"], r["words"]
        if not fresh:
            return
        alive: dict[tuple, list] = {}  # key: [conv_id, n_convs, n_children, n_leaves, saved_tokens, ends]
        for d in range(high, low - 1, -1):
            for r in fresh.get(d, []):
                _fold(alive, (r["k1"], r["k2"]), [r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"]])
            stripped: dict[tuple, list] = {}
            out = []
            for (k1, k2), (conv, n, children, leaves, saved, ends) in alive.items():
                h1, h2, words_ = (x[d - 1 - skip] for x in paths[conv])
                leaves = leaves if children else 1
                saved += (n - 1) * words_
                out.append((d, k1, k2, k1 ^ h1, k2 ^ h2, conv, n, children, leaves, saved, ends or EMPTY_SHA, None))
                _fold(stripped, (k1 ^ h1, k2 ^ h2), [conv, n, 1, leaves, saved, None])
            alive = stripped
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _TYPES)], _NAMES)

    return rows.repartition(1).mapInArrow(run, NODE + f", steps array<{STEP}>")


_NAMES = [*(x.split()[0] for x in NODE.split(", ")), "steps"]
_TYPES = [pa.int32(), *[pa.int64()] * 9, pa.string(), pa.list_(pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("words", pa.int64())]))]


def _fold(nodes: dict, key: tuple, row: list) -> None:
    had = nodes.get(key)
    nodes[key] = row if had is None else [min(had[0], row[0]), *(a + b for a, b in zip(had[1:5], row[1:5])), had[5] or row[5]]


def _with_parents(nodes: DataFrame) -> DataFrame:
    """The nodes with the smallest member of their parent; a parent of very many children is broadcast, not shuffled."""
    key = ["up", "p1", "p2"]
    above = nodes.where("n_children > 0").select((F.col("depth") + 0).alias("up"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
                                                 F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("n"))
    below = nodes.where("depth > 0").withColumn("up", F.col("depth") - 1)
    named = join_per_key(below, above, key).unionByName(
        nodes.where("depth = 0").withColumn("up", F.lit(None).cast("int")).withColumn("parent_conv_id", F.lit(None).cast("long")))
    return named.select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        "saved_tokens", "ends_sha256")


def with_shared_heads(turns: DataFrame, group: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, pos, t1, t2, words) and all conversations (conv_id), for ``trie_of``.

    The first h turns of a conversation c are those of conversation c - c % ``group`` (none if there's none), its own
    follow after its first h; h = crc32(decimal c) % ``most``. ``turns``: as from ``numbered``. At most ``most`` - 1
    turns of a conversation are lent, to ``group`` others.
    """
    turns = checkpointed(turns)
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(most)
    convs = turns.where("pos = 1").select("conv_id")
    heads = turns.where((F.col("pos") < most) & (F.col("conv_id") % F.lit(group) == 0)).withColumnRenamed("conv_id", "head")
    asked = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % F.lit(group)).alias("head"), h.alias("h"))
    lent = asked.join(heads, "head").where(F.col("pos") <= F.col("h")).select("conv_id", "pos", "t1", "t2", "words")
    # Where the lender has fewer than h turns, the borrower's own move up.
    got = lent.groupBy("conv_id").agg(F.max("pos").alias("got"))
    own = turns.where(F.col("pos") > h).join(got, "conv_id", "left")
    moved = own.select("conv_id", (F.col("pos") - h + F.coalesce("got", F.lit(0))).alias("pos"), "t1", "t2", "words")
    return lent.unionByName(moved), convs
