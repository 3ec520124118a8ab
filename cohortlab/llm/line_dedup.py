"""Line dedup: lines that stand in many documents are dropped everywhere.

Lines are exploded and normalised, their keys hashed, distinct documents
counted per hash, and the documents put together again by line position.
DataFrame functions only. Only hashes and positions are shuffled for the
counts; each text crosses the network once, to meet its positions.

A hot line goes to no single task: documents per hash are counted in two steps
(first per hash *and* document, then per hash, both combined before the
shuffle), and the join that finds the hot lines of each document is salted by
the document.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import free_name

# The white space that a key loses at both ends (code points 20 and 09-0D).
WHITE = " \t\n\x0b\x0c\r"
# Seed of the second 64-bit hash: a key is known by 128 bits.
SECOND = 77
# Tasks over which the documents of one hot line are dealt.
SALTS = 32


def line_key(line: Column) -> Column:
    """The line stripped of ``WHITE`` at both ends, A-Z lower-cased.

    ``lower`` is much faster than ``translate`` and equal to it on ASCII."""
    cut = F.btrim(line, F.lit(WHITE))
    ascii_only = F.octet_length(cut) == F.char_length(cut)
    return F.when(ascii_only, F.lower(cut)).otherwise(
        F.translate(cut, string.ascii_uppercase, string.ascii_lowercase))


def split_lines(text: Column) -> Column:
    """Lines of a text; a null or empty text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` with the kept text in ``text_col`` and two more columns,
    ``n_lines`` (before dropping) and ``n_dropped``.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents loses all its lines in every document. A null or empty text is
    one empty line and comes back as the empty text; a text all of whose lines
    go comes back empty. A document is an id: rows that repeat an id count
    once, rows without an id count together as one document, and every row
    comes back. Columns named ``n_lines`` or ``n_dropped`` are replaced; any
    other extra column passes through.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    mark, drop = free_name(docs, "__mark"), free_name(docs, "__drop")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.xxhash64(F.col(text_col)).alias(mark))

    # (id, text mark, position, 128-bit key): the mark tells rows that repeat an id but not its text apart.
    lines = (rows.select(F.col(id_col).alias("id"), F.col(mark).alias("mark"),
                         F.posexplode(split_lines(F.col(text_col))).alias("pos", "line"))
             .select("id", "mark", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= min_chars)
             .select("id", "mark", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(SECOND), "key").alias("h2")))
    hot = (lines.groupBy("h1", "h2", "id").agg(F.lit(1).alias("one"))
           .groupBy("h1", "h2").agg(F.count("*").alias("n_docs"))
           .where(F.col("n_docs") >= min_docs).select("h1", "h2"))
    # A hot line stands in very many documents: they are dealt over SALTS tasks, and the few hot keys go to each. Spark sizes
    # them by the keys before they are dealt: unhinted, it may broadcast them SALTS times as large.
    salted = hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).hint("merge")
    dropped = (lines.withColumn("salt", F.pmod(F.xxhash64("id", "mark"), F.lit(SALTS)).cast("int")).join(salted, ["h1", "h2", "salt"])
               .groupBy("id", "mark").agg(F.collect_set("pos").alias(drop)))

    out = rows.join(dropped, F.col(id_col).eqNullSafe(dropped["id"]) & (F.col(mark) == dropped["mark"]), "left")
    whole = F.coalesce(F.col(text_col), F.lit(""))
    n_lines = F.size(split_lines(F.col(text_col)))
    # Kept positions come from a hash set difference, so a text of many lines stays linear.
    left = F.array_sort(F.array_except(F.sequence(F.lit(0), n_lines - 1), F.col(drop)))
    # The lines are bound by an outer lambda: split once for a text, not once for each kept line.
    joined = F.get(F.transform(F.array(split_lines(F.col(text_col))), lambda ls: F.array_join(
        F.transform(left, lambda i: F.get(ls, i)), "\n")), F.lit(0))
    text = F.when(F.col(drop).isNull(), whole).otherwise(joined)
    return out.select(*[(text.alias(c) if c == text_col else rows[f"`{c}`"]) for c in kept],
                      n_lines.cast("long").alias("n_lines"),
                      F.coalesce(F.size(F.col(drop)), F.lit(0)).cast("long").alias("n_dropped"))
