"""Exact dedup by two passes of a Bloom filter, DataFrame functions only.

First pass: every text's hash marks a few cells of a filter, and the marks of
a cell are counted (combined before the shuffle, which carries cells, never
rows). Cells marked twice or more are the filter of possibly repeated hashes:
4 KB bitmaps, of proven number, so it is broadcast. Second pass: a row that
finds all its cells in the filter may have an equal; only such rows are
shuffled, to be grouped by the SHA-256 of their text. The rest are certain to
be alone and pass straight through.

The filter only says who is shuffled; groups are made of equal digests, so
false positives cost a little traffic and nothing else. A filter of the largest
size that gets too full for its rows still gives right results; more rows are
shuffled then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import checkpointed, free_name, join_per_key

# Cells in one bitmap of bitmap_construct_agg.
BLOCK = 32768


def digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, lowercase hex; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def filter_blocks(n_rows: int, cells_per_row: int, max_blocks: int) -> int:
    """Bitmaps of the filter: a power of two with ``cells_per_row`` cells a row, at most ``max_blocks``."""
    blocks = 1
    while blocks < max_blocks and blocks * BLOCK < n_rows * cells_per_row:
        blocks *= 2
    return blocks


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(F.shiftrightunsigned(h, 30), F.lit(blocks))


def _cells(h: Column) -> list[Column]:
    """Two cells inside the block, from bits that the block isn't taken from."""
    return [h.bitwiseAND(F.lit(BLOCK - 1)), F.shiftrightunsigned(h, 15).bitwiseAND(F.lit(BLOCK - 1))]


def repeat_filter(hashes: DataFrame, blocks: int) -> DataFrame:
    """First pass: (block, bitmap) of the cells that at least two rows of ``hashes`` (column ``h``) mark."""
    cells = hashes.select(_block(F.col("h"), blocks).alias("block"), F.explode(F.array(*_cells(F.col("h")))).alias("cell"))
    return (cells.groupBy("block", "cell").agg(F.count("*").alias("n")).where("n > 1")
            .groupBy("block").agg(F.bitmap_construct_agg("cell").alias("bitmap")))


def may_repeat(rows: DataFrame, h: Column, repeated: DataFrame, blocks: int, name: str) -> DataFrame:
    """Second pass: ``rows`` with a boolean ``name``, false where no other row can have the same hash.

    ``repeated`` has at most ``blocks`` rows of 4 KB and is broadcast.
    """
    block, bitmap = free_name(rows, "__block"), free_name(rows, "__bitmap")
    side = repeated.select(F.col("block").alias(block), F.col("bitmap").alias(bitmap))

    def marked(cell: Column) -> Column:
        byte = F.substring(F.col(bitmap), (F.shiftright(cell, 3) + 1).cast("int"), F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (cell % 8).cast("int")) == 1

    hit = F.lit(True)
    for cell in _cells(h):
        hit = hit & F.coalesce(marked(cell), F.lit(False))
    joined = rows.join(F.broadcast(side), _block(h, blocks) == F.col(block), "left")
    return joined.select(*[rows[f"`{c}`"] for c in rows.columns], hit.alias(name))


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                cells_per_row: int = 16, max_blocks: int = 16384) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id`` (the largest id of its group of equal texts),
    ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when identical; null counts as empty. Exactly one row of a group is kept: the one with the
    largest id, of rows that repeat that id any one. A null id is smaller than all others, and ``keep_id`` is
    null where a group has no other. An empty table gives no rows. Other columns are not used.

    Texts are read once, digested and never shuffled; a group of very many copies is counted before the shuffle and
    its rows are answered by a broadcast of the few largest groups. The filter takes at most ``max_blocks`` x 4 KB.
    """
    rows = checkpointed(docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"),
                                    F.unhex(digest(F.col(f"`{text_col}`"))).alias("sha")).withColumn("h", F.xxhash64("sha")))
    blocks = filter_blocks(rows.count(), cells_per_row, max_blocks)
    tested = may_repeat(rows, F.col("h"), repeat_filter(rows, blocks), blocks, "repeats").drop("h")
    alone = tested.where("not repeats").select("*", F.col("id").alias("keep_id"), F.col("row").alias("keep_row"),
                                               F.lit(1).cast("long").alias("group_size")).drop("repeats")
    # Written once: read by the grouping and by both joins.
    shuffled = checkpointed(tested.where("repeats").drop("repeats"))
    groups = (shuffled.groupBy("sha").agg(F.max(F.struct("id", "row")).alias("top"), F.count("*").alias("n"))
              .select("sha", F.col("top.id").alias("keep_id"), F.col("top.row").alias("keep_row"), F.col("n").alias("group_size"), "n"))
    out = alone.unionByName(join_per_key(shuffled, groups, "sha"))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
                      F.lower(F.hex("sha")).alias("text_sha256"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                cells_per_row: int = 16, max_blocks: int = 16384) -> DataFrame:
    """``docs`` without copies: of rows with identical texts the one with the largest id, whole, with all columns.

    Null texts equal empty ones, a null id is smaller than all others. Of rows that repeat id and text the one
    with the largest hash of all its columns stays, once. Extra columns of any name pass through.

    Rows without a possible equal never leave their task; the others are shuffled, but for the losers of the
    largest groups, which go before.
    """
    named = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        F.unhex(digest(F.col(f"`{text_col}`"))).alias("sha"),
                        F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("hash")).alias("rank"))
    hashes = checkpointed(named.select(F.xxhash64("sha").alias("h")))
    blocks = filter_blocks(hashes.count(), cells_per_row, max_blocks)
    tested = may_repeat(named, F.xxhash64("sha"), checkpointed(repeat_filter(hashes, blocks)), blocks, "repeats")
    rivals = tested.where("repeats").drop("repeats")
    groups = rivals.groupBy("sha").agg(F.max("rank").alias("top"), F.count("*").alias("n"))
    best = join_per_key(rivals, groups, "sha").where(F.col("rank").eqNullSafe(F.col("top"))).dropDuplicates(["sha"])
    return tested.where("not repeats").select("doc.*").unionByName(best.select("doc.*"))
