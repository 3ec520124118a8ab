"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of letters and digits, lower-cased, known by a 64-bit hash. One pass over the training texts
cuts the windows around n-grams of test items out. A copy that must be found shares at least t n-grams
with its item (``least_shared``), so it also holds one of the item's seeds: all its n-grams but the t - 1 most common
ones, by the items and then by the windows that hold them. Seeds join windows to items; a pair that shares
fewer than t n-grams goes, and a local alignment scores the others, each around the n-grams that the pair
shares. Edited and paraphrased copies keep some n-grams and align with a few gaps and mismatches. Pairs with
too few words in common to reach the score are not aligned, which loses none.

The pass looks n-grams up in a bitmap of a fixed size (2 MB) that Spark
builds from the items, however many there are; false hits go at the exact
join. So nothing that grows with either table is collected or broadcast, and
only windows around n-grams of items leave the scan.

What the seeds can't see: three words in a row must survive t times. An edit of every third word, or a word put in
after every second one, leaves none, though it may score 0.5.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql import Window as W

from cohortlab.llm.common import arrow_map, checkpointed
from cohortlab.session import bounded_broadcast

# Words of a seed. Three survive an edit of every fourth word.
GRAM = 3
# A copy shares this part of its item's n-grams, but needn't share more than so many: 25 words edited at every
# fourth place (a quarter is left), or cut out of a long item, still have them.
SHARED_PART, SHARED_MOST = 5, 4
# Words of items that are broadcast at most, beside the bound on rows.
HOT_WORDS = 4_000_000
# Bits of the bitmap, as a power of two: 2 MB whatever the number of items.
MAP_BITS = 24
# Scores of a match, a mismatch and a gapped word.
MATCH, MISMATCH, GAP = 2, -1, -1
# Distinct words whose hash is remembered in a task (the table starts anew when full).
KNOWN_WORDS = 300_000
# Windows aligned at a time, and their words together (or one window of any length).
ALIGN, ALIGN_WORDS = 64, 1 << 17

_WORD = re.compile(r"[^\W_]+")


class _Hashes(dict):
    """Word to its 64-bit hash, filled on demand."""

    def __missing__(self, word: str) -> int:
        from xxhash import xxh64_intdigest

        if len(self) >= KNOWN_WORDS:
            self.clear()
        h = self[word] = xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


@functools.lru_cache(maxsize=1)
def _known() -> _Hashes:
    """One table per Python worker."""
    return _Hashes()


def word_hashes(text: str | None, known: _Hashes) -> np.ndarray:
    words = _WORD.findall((text or "").lower())
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` words; none for fewer words than that."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + words[k:len(words) - n + 1 + k]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def item_grams(items: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(item_id, words, grams): word hashes and n-gram hashes of each item of at
    least ``n`` words. Shorter items can't be told from ordinary text and take no part."""
    base = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        known = _known()
        got = [(i, w) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if len(w := word_hashes(t, known)) >= n]
        return pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in got], pa.int64()), pa.array([w.view(np.int64) for _, w in got], pa.list_(pa.int64())),
             pa.array([gram_hashes(w, n).view(np.int64) for _, w in got], pa.list_(pa.int64()))], names=["item_id", "words", "grams"])

    return arrow_map(base, run, "item_id long, words array<long>, grams array<long>")


def bitmap(grams: DataFrame) -> np.ndarray:
    """The fixed-size bitmap of a column ``gram``, built by Spark in pieces of 4 kB."""
    at = F.col("gram").bitwiseAND(F.lit((1 << MAP_BITS) - 1)) + 1  # Spark's bitmaps count from 1
    parts = (grams.select(at.alias("at")).distinct()
             .groupBy(F.bitmap_bucket_number("at").alias("k"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect())
    out = np.zeros(1 << MAP_BITS >> 3, np.uint8)
    for p in parts:
        out[(p["k"] - 1) * 4096:p["k"] * 4096] = np.frombuffer(p["bits"], np.uint8)
    return out


def _in_map(grams: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = grams & np.uint64((1 << MAP_BITS) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def windows(docs: DataFrame, bits: np.ndarray, n: int, reach: int) -> DataFrame:
    """(doc_id, start, words, hits): stretches of ``reach`` words to both sides
    of seed n-grams, those that overlap taken together."""
    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known, out = _known(), []
        for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            w = word_hashes(t, known)
            g = gram_hashes(w, n)
            at = np.flatnonzero(_in_map(g, bits))
            for part in np.split(at, np.flatnonzero(np.diff(at) > 2 * reach + n) + 1) if len(at) else ():
                begin, end = max(0, part[0] - reach), min(len(w), part[-1] + n + reach)
                out.append((doc, int(begin), w[begin:end].view(np.int64), np.unique(g[part]).view(np.int64)))
        cols = list(zip(*out)) if out else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64())),
             pa.array(cols[3], pa.list_(pa.int64()))], names=["doc_id", "start", "words", "hits"])

    return arrow_map(docs, run, "doc_id long, start long, words array<long>, hits array<long>")


def smith_waterman(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair and the place in ``b`` just after
    its last word. One numpy step per word of the longest ``a``: gaps along
    ``b`` are a running maximum."""
    rows, cols = max(map(len, a)), max(map(len, b))
    pa_, pb = np.zeros((len(a), rows), np.int64), np.zeros((len(b), cols), np.int64)
    in_a, in_b = np.zeros(pa_.shape, bool), np.zeros(pb.shape, bool)
    for k, (x, y) in enumerate(zip(a, b)):
        pa_[k, :len(x)], in_a[k, :len(x)] = x, True
        pb[k, :len(y)], in_b[k, :len(y)] = y, True
    slope = -GAP * np.arange(cols, dtype=np.int32)
    h = np.zeros((len(a), cols + 1), np.int32)
    best, stop = np.zeros(len(a), np.int32), np.zeros(len(a), np.int64)
    each = np.arange(len(a))
    for i in range(rows):
        same = (pa_[:, i:i + 1] == pb) & in_a[:, i:i + 1] & in_b
        now = np.maximum(h[:, :-1] + np.where(same, MATCH, MISMATCH).astype(np.int32), h[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        top = now.argmax(axis=1)
        better = now[each, top] > best
        best[better], stop[better] = now[each, top][better], top[better] + 1
        h[:, 1:] = now
    return best, stop


def most_matches(a: np.ndarray, b: np.ndarray) -> int:
    """No alignment of ``a`` and ``b`` has more matching words than this."""
    return int(min(np.isin(a, b).sum(), np.isin(b, a).sum()))


def align_batches(order: list[int], size: list[int]) -> Iterator[list[int]]:
    """``order``, of rising ``size``, in runs that fit ``ALIGN`` and ``ALIGN_WORDS``."""
    ks: list[int] = []
    for k in order:
        if ks and (len(ks) == ALIGN or (len(ks) + 1) * size[k] > ALIGN_WORDS):
            yield ks
            ks = []
        ks.append(k)
    if ks:
        yield ks


def least_shared(m: int) -> int:
    """Distinct n-grams that a copy of an item of ``m`` must share with it."""
    return max(1, min(m // SHARED_PART, SHARED_MOST))


def segments(window: np.ndarray, grams: np.ndarray, length: int, n: int) -> list[tuple[int, int]]:
    """Stretches of a window that an item of ``length`` words can be aligned to: its words to both sides of the
    n-grams that both hold, those that overlap taken together."""
    at = np.flatnonzero(np.isin(gram_hashes(window.view(np.uint64), n), grams.view(np.uint64)))
    parts = np.split(at, np.flatnonzero(np.diff(at) > 2 * length + n) + 1) if len(at) else []
    return [(max(0, int(p[0]) - length), min(len(window), int(p[-1]) + n + length)) for p in parts]


def _spread(rows: DataFrame, table: DataFrame, key: str, n: str, small: bool = True, share: int = 1000) -> DataFrame:
    """``rows`` joined to all rows of ``table`` with their ``key``; ``n`` counts the key's rows in ``rows``. Keys with more than one
    in ``share`` of all rows go by broadcast where that is proven small, so their rows don't meet in one task."""
    total = table.select(key, n).distinct().agg(F.sum(n)).first()[0] or 0
    is_hot = F.col(n) * share > F.lit(total)
    hot, cold = table.where(is_hot).drop(n), table.where(~is_hot).drop(n)
    by_hot = rows.join(F.broadcast(hot.select(key).distinct()), key, "left_semi")  # fewer than ``share`` keys
    rest = rows.join(F.broadcast(hot.select(key).distinct()), key, "left_anti")
    return by_hot.join(bounded_broadcast(hot) if small else hot, key).unionByName(rest.join(cold, key))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", gram: int = GRAM,
                 min_score: float = 0.5, min_words: int = 25) -> DataFrame:
    """(doc_id, item_id, score, start_word, end_word): documents that hold a
    test item or an edited copy, with the best window of each pair.

    ``score`` is the alignment score over that of the item against itself. A
    pair is reported from ``min_score`` on, or when the alignment is worth
    ``min_words`` matching words. Word places count runs of letters and digits
    in the document. Null or empty texts and items shorter than ``gram`` words
    match nothing; rows that repeat an id are one document, rows with a null
    id are examined and reported with a null id; items that repeat an id are
    one item with several texts, items of equal words are aligned once. Other columns are not used.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tests = item_grams(items, item_col, item_text, gram).withColumn("item", F.md5(F.array_join(F.col("words").cast("array<string>"), ",").cast("binary")))
    tests = checkpointed(tests)
    unique = checkpointed(tests.select("item", "words", F.array_distinct("grams").alias("grams")).dropDuplicates(["item"]))
    grams = unique.select("item", F.size("grams").alias("m"), F.explode("grams").alias("gram"))
    longest = unique.agg(F.max(F.size("words"))).first()[0] or 0
    found = checkpointed(windows(texts, bitmap(grams), gram, longest).withColumn("mark", F.xxhash64("words"))
                         .dropDuplicates(["doc_id", "start", "mark"]))
    key = ["doc_id", "start", "mark"]
    hits = found.select(*[F.col(c).alias(f"of_{c}") for c in key], F.explode("hits").alias("gram"))
    # The seeds of an item, from its rarest n-gram on.
    shared = F.greatest(F.lit(1), F.least(F.floor(F.col("m") / SHARED_PART), F.lit(SHARED_MOST)))
    held = grams.groupBy("gram").agg(F.count("*").alias("holders")).join(hits.groupBy("gram").agg(F.count("*").alias("n")), "gram", "left")
    order = W.partitionBy("item").orderBy("holders", F.coalesce("n", F.lit(0)), "gram")
    seeds = checkpointed(grams.join(held, "gram").withColumn("rank", F.row_number().over(order)).where(
        (F.col("rank") <= F.col("m") - shared + 1) & F.col("n").isNotNull()).select("gram", "item", "n"))
    pairs = checkpointed(_spread(hits, seeds, "gram", "n").select(*[f"of_{c}" for c in key], "item").distinct())
    asked = unique.join(pairs.groupBy("item").agg(F.count("*").alias("n")), "item").withColumn("m", F.size("grams")).withColumn("least", shared).drop("m")
    asked = checkpointed(asked)
    words = asked.where(F.col("n") * 1000 > F.lit(pairs.count())).agg(F.sum(F.size("words"))).first()[0] or 0
    named = _spread(pairs, asked, "item", "n", small=words <= HOT_WORDS)
    same = F.col("of_doc_id").eqNullSafe(F.col("doc_id")) & (F.col("of_start") == F.col("start")) & (F.col("of_mark") == F.col("mark"))
    windowed = found.select(*key, F.col("words").alias("window"), "hits")
    both = windowed.join(named, same).where(F.size(F.array_intersect("hits", "grams")) >= F.col("least"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        item, doc, start = (b.column(k).to_pylist() for k in range(3))
        win, words, own = ([np.array(x.values, dtype=np.int64) for x in b.column(k)] for k in (3, 4, 5))
        out = []
        enough = [min(min_score * MATCH * len(w), MATCH * min_words) for w in words]
        parts = []  # (row, where the part starts, its words)
        for k in range(b.num_rows):
            parts += [(k, lo, part) for lo, hi in segments(win[k], own[k], len(words[k]), gram)
                      if MATCH * most_matches(words[k], part := win[k][lo:hi]) >= enough[k]]
        size = [len(p) for _, _, p in parts]
        for ks in align_batches(sorted(range(len(parts)), key=size.__getitem__), size):
            best, stop = smith_waterman([words[parts[p][0]] for p in ks], [parts[p][2] for p in ks])
            hit = [(p, s, int(e)) for p, s, e in zip(ks, best.tolist(), stop) if s >= enough[parts[p][0]]]
            if hit:  # where it begins: the same alignment, read backwards from its end
                _, back = smith_waterman([words[parts[p][0]][::-1] for p, _, _ in hit], [parts[p][2][:e][::-1] for p, _, e in hit])
                for (p, s, e), r in zip(hit, back):
                    k, lo, _ = parts[p]
                    out.append((doc[k], item[k], s / (MATCH * len(words[k])), start[k] + lo + e - int(r), start[k] + lo + e))
        cols = list(zip(*out)) if out else [()] * 5
        kinds = [pa.int64(), pa.string(), pa.float64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          names=["doc_id", "item", "score", "start_word", "end_word"])

    aligned = arrow_map(both.select("item", "doc_id", "start", "window", "words", "grams"), run,
                        "doc_id long, item string, score double, start_word long, end_word long")
    each = aligned.join(tests.select("item", "item_id").distinct(), "item")
    best = F.max(F.struct("score", (-F.col("start_word")).alias("before"), "end_word")).alias("best")
    return each.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.score").alias("score"), (-F.col("best.before")).alias("start_word"),
        F.col("best.end_word").alias("end_word"))
