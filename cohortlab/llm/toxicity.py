"""Toxicity by compression distance.

Two pairs of zstandard dictionaries come from bounded samples of labelled texts.
The first pair is trained: one dictionary on windows of toxic texts, the
other on windows of ordinary ones, both followed by the same ordinary part. Most of a toxic text is ordinary, so
the toxic windows are chosen in rounds: the toxic texts are halved, each half is compressed with the
dictionaries of the other, and the windows that the toxic one shortens more than it shortens nearly all
ordinary windows train the next. What only one text says (or a copy of it) is not chosen, what
toxic texts have in common is. A window stands for a word and its neighbours, once for each word before it. Windows
of the whole texts are trained on beside them, for phrases of ordinary words.

The second pair tells words. Both of it hold the same ordinary part, trained on
ordinary windows; the toxic one adds toxic words: words that begin with a stem which follows many more
different words in toxic texts than in ordinary ones. (Counting what stands
before a stem, not how often it stands there, keeps the own words of a text
with many copies out.) The ordinary one adds as many bytes of ordinary text
instead, so on ordinary windows the two compress about alike.

A text is cut into windows of whole words, one after the other for the first pair and
overlapping for the second, each compressed with either
dictionary of the pair. The differences of the two lengths over all windows of the
whole text (the largest ones, number and share of windows above each of some
thresholds) are calibrated by a logistic fit on labelled rows that the
dictionaries have not seen.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import arrow_map, checkpointed

WINDOW, STEP = 48, 24
# Windows of the trained pair, which do not overlap, and the differences that are counted there.
LONG = 64
LONG_THRESHOLDS = (1, 2, 4)
# Words of a window that the trained pair is chosen from.
AROUND = 4
# Length differences (bytes) whose shares of windows are counted.
THRESHOLDS = (1, 2, 3, 4, 5, 6, 8, 10)
N_FEATURES = 2 * len(THRESHOLDS) + 8 + len(LONG_THRESHOLDS) + 5
# Bytes by which a toxic word is known: a space and the next four to eight.
STEMS = (5, 6, 7, 8, 9)


def normal(text: str | None) -> bytes:
    """Lower-cased, runs of white space to one space, a space at both ends."""
    return (" " + " ".join((text or "").lower().split()) + " ").encode("utf-8", "surrogatepass")


def windows(line: bytes, size: int = WINDOW, step: int = STEP) -> list[bytes]:
    """Overlapping runs of whole words, of ``size`` bytes or as many more as the
    last word needs; a word that goes on beyond twice as many is cut there."""
    out, at = [], 0
    while True:
        end = line.find(b" ", at + size, at + 2 * size) + 1 or at + 2 * size
        out.append(line[at:end])
        if end >= len(line):
            return out
        after = line.find(b" ", at + step, at + 2 * step)
        at = after if after >= 0 else at + step


@dataclass
class Dictionaries:
    """Raw contents of the pair with the toxic words and the trained pair;
    compressors are made once per batch of rows."""
    toxic: bytes
    ordinary: bytes
    toxic_trained: bytes
    ordinary_trained: bytes

    def compressors(self):
        import zstandard as zs

        out = []
        for pair, window in (((self.toxic, self.ordinary), WINDOW), ((self.toxic_trained, self.ordinary_trained), LONG)):
            out += compressors(pair, window)
        return out


def compressors(pair: tuple[bytes, bytes], window: int) -> list:
    """A compressor for windows of about ``window`` bytes with each dictionary, given as its content."""
    import zstandard as zs

    params = zs.ZstdCompressionParameters.from_level(
        3, source_size=window, dict_size=max(map(len, pair)), min_match=4, strategy=zs.STRATEGY_LAZY2,
        write_content_size=False, write_checksum=False, write_dict_id=False, format=zs.FORMAT_ZSTD1_MAGICLESS)
    out = []
    for content in pair:
        d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=params)
        out.append(zs.ZstdCompressor(compression_params=params, dict_data=d).compress)
    return out


def toxic_stems(toxic: set, ordinary: set, ratio: float, evidence: float, min_contexts: int) -> dict[bytes, float]:
    """Stems with the evidence (twice the log-likelihood ratio) that they are
    commoner after toxic words than ordinary ones; both sets hold (word before, word)."""
    n_bad, n_fine = len(toxic), len(ordinary)
    bad = Counter(w[:k] for _, w in toxic for k in STEMS if len(w) >= k)
    bad = {s: n for s, n in bad.items() if n >= min_contexts}
    fine = Counter(s for _, w in ordinary for k in STEMS if len(w) >= k and (s := w[:k]) in bad)
    out = {}
    for s, n in bad.items():
        m = fine[s]
        if n * n_fine > ratio * (m + 1) * n_bad:
            expected = (n + m) * n_bad / (n_bad + n_fine)
            g = 2 * (n * math.log(n / expected) + (m * math.log(m / (n + m - expected)) if m else 0.0))
            if g >= evidence:
                out[s] = g
    return out


def trained(samples: list[bytes], size: int, **how) -> bytes:
    """A dictionary trained on the samples; their bytes as they are if those are too few."""
    import zstandard as zs

    try:
        return zs.train_dictionary(size, samples, **how).as_bytes()
    except zs.ZstdError:
        return b"".join(samples)[:size]


def contexts(lines: list[bytes], words: int = AROUND) -> list[bytes]:
    """A window of ``words`` words for each different pair of neighbours, where it first stands."""
    from xxhash import xxh64_intdigest

    seen, out = set(), []
    for line in lines:
        ws = line.split()
        for i, (before, word) in enumerate(zip([b"", *ws], ws)):
            pair = xxh64_intdigest(before + b" " + word)
            if pair not in seen:
                seen.add(pair)
                at = max(0, i - 1)
                window = b" " + b" ".join(ws[at:at + words]) + b" "
                if len(window) >= 8:
                    out.append(window)
    return out


def telling_windows(toxic: list[bytes], ordinary: list[bytes], base: bytes, size: int, rounds: int, share: float,
                    rng: np.random.Generator) -> tuple[list[bytes], list[bytes]]:
    """Windows of toxic lines that a dictionary trained on other toxic lines shortens most, and ordinary ones.

    A window is kept if it gains more than all but ``share`` (halved each round) of the ordinary windows."""
    bad, fine = [contexts(toxic[i::2]) for i in (0, 1)], [contexts(ordinary[i::2]) for i in (0, 1)]
    copied = set(bad[0]) & set(bad[1])
    bad = [[w for w in half if w not in copied] for half in bad]
    for half in (*bad, *fine):
        rng.shuffle(half)
    kept, plain = bad, [f[:len(b)] for f, b in zip(fine, bad)]
    for r in range(rounds):
        new = []
        for own, other in ((0, 1), (1, 0)):
            t, o = compressors((trained(kept[other], size, d=6, k=24) + base, trained(plain[other], size, d=6, k=24) + base), LONG)
            gain = lambda ws: np.array([len(o(w)) - len(t(w)) for w in ws])  # noqa: E731, B023
            beside = gain(fine[own][len(bad[own]):3 * len(bad[own])] or plain[own])
            cut = max(1.0, np.quantile(beside, 1 - share / 2 ** r)) if len(beside) else 1.0
            new.append([w for w, g in zip(bad[own], gain(bad[own])) if g >= cut])
        if min(map(len, new)) < 20:
            break
        kept = new
    return kept[0] + kept[1], plain[0] + plain[1]


def train_dictionaries(texts: list[str], toxic: list[int], base_bytes: int = 32768, base_samples: int = 60_000, base_stride: int = 128,
                       pair_bytes: int = 4096, round_bytes: int = 2048, rounds: int = 3, share: float = 0.05, ratio: float = 6.0,
                       evidence: float = 30.0, min_contexts: int = 3, seed: int = 5) -> Dictionaries | None:
    """Dictionaries of a bounded sample; None if it has too little of either kind.

    The ordinary part is trained on 64 of every ``base_stride`` bytes of ordinary texts, ``base_samples`` of these pieces at most."""
    rng = np.random.default_rng(seed)
    seen: tuple[set, set] = (set(), set())
    pieces: list[bytes] = []
    lines: tuple[list[bytes], list[bytes]] = ([], [])
    for text, y in zip(texts, toxic):
        line = normal(text)
        own = [b" " + w for w in line.split()]
        seen[1 if y else 0].update(zip([b""] + own[:-1], own))
        lines[1 if y else 0].append(line)
        if not y:
            pieces += [line[i:i + 64] for i in range(0, max(1, len(line) - 64 + base_stride), base_stride)]
    stems = toxic_stems(seen[1], seen[0], ratio, evidence, min_contexts)
    words = Counter(w for _, w in seen[1])
    add = []
    # By count, then bytes: a set has no order that would hold from run to run.
    for w, _ in sorted(words.items(), key=lambda x: (-x[1], x[0])):
        if any(w[:k] in stems for k in STEMS if len(w) >= k):
            add.append(w)
    if not lines[1] or len(pieces) < 100:
        return None
    # The commonest words come last, where a match costs least.
    toxic_part = b"".join(reversed(add)) + b" "
    order = rng.permutation(len(pieces))
    rest = max(1, len(pieces) // 20)
    filler = b"".join(pieces[i] for i in order[:rest])
    filler = (filler * (len(toxic_part) // max(1, len(filler)) + 1))[:len(toxic_part)]
    samples = [pieces[i] for i in order[rest:rest + base_samples] if len(pieces[i]) >= 8]
    base = trained(samples, base_bytes)
    del seen, pieces, samples, words
    # Three times as much ordinary text as toxic is enough to compare with.
    left, few = 3 * sum(map(len, lines[1])), []
    for i in rng.permutation(len(lines[0])):
        if left > 0:
            few.append(lines[0][i])
            left -= len(lines[0][i])
    lines = (few, lines[1])
    telling, plain = telling_windows(lines[1], lines[0], base, round_bytes, rounds, share, rng)
    plain = plain[:max(500, len(telling))]
    # Phrases that many texts repeat word for word are no common contexts: windows of the whole texts bring them in.
    whole = [[w for line in lines[y] for w in windows(line, 2 * LONG, 2 * LONG)] for y in (1, 0)]
    whole[1] = [whole[1][i] for i in rng.permutation(len(whole[1]))[:len(whole[0])]]
    pair = [trained(every, pair_bytes // 2) + trained(some, pair_bytes, d=6, k=24) + base for some, every in zip((telling, plain), whole)]
    return Dictionaries(toxic_part + base, filler + base, *pair)


def features(text: str | None, toxic, ordinary, toxic_trained, ordinary_trained) -> list[float]:
    line = normal(text)
    ws, long = windows(line), windows(line, LONG, LONG)
    t = np.fromiter((len(ordinary_trained(w)) - len(toxic_trained(w)) for w in long), np.float64, len(long))
    best = np.concatenate([np.sort(t)[::-1][:3], np.full(3, t.min())])
    d = np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in ws), np.float64, len(ws))
    top = np.concatenate([np.sort(d)[::-1][:5], np.zeros(5)])
    above = np.array([(d >= t).sum() for t in THRESHOLDS])
    n, one = np.log1p(len(d)), 1 / (len(d) + 1)
    return [*np.log1p(above), *np.log(above / len(d) + one), top[0], top[1], top[2], top[4], n, n * n,
            np.log((d < 0).mean() + one), d.mean(), *(np.log1p((t >= k).sum()) for k in LONG_THRESHOLDS),
            t.mean(), best[0], best[1], best[2], (t > 0).mean()]


def with_features(docs: DataFrame, dictionaries: Dictionaries, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, x) for the whole text of each row."""
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        compressors = dictionaries.compressors()
        x = [features(t, *compressors) for t in b.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], names=["doc_id", "x"])

    return arrow_map(base, run, f"doc_id {dict(base.dtypes)['doc_id']}, x array<double>")


@dataclass
class Calibration:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -20, 20)
        return 1 / (1 + np.exp(-np.clip(z @ self.weight[:-1] + self.weight[-1], -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> Calibration:
    """Logistic fit by Newton steps."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    a = np.hstack([np.clip((x - mean) / scale, -20, 20), np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    keep = ridge * np.ones(len(w))
    keep[-1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(keep), a.T @ (p - y) + keep * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Calibration(mean, scale, w)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             dictionary_rows: int = 6000, calibration_rows: int = 20_000, dictionary_chars: int = 50_000) -> DataFrame:
    """(doc_id, score, predicted) for every row of ``docs``.

    ``labels`` (doc_id, y in 0/1, one row per document) teach: two thirds of
    them by a hash of the id are for the dictionaries, of which the
    ``dictionary_rows`` of smallest hash are used (of each the first ``dictionary_chars`` code points of one text, the
    smallest if an id repeats), one third for the
    calibration, of which ``calibration_rows`` are, one row each. Those parameters bound
    the fit in rows and bytes; every row of ``docs`` is scored on its whole text. With one label
    only, or no usable rows, every score is the share of label 1 (0.5 without
    labels). Null and empty texts are scored like any other, as one empty
    window. Rows that repeat an id are all scored; rows with a null id are
    scored and never learned from. Extra columns are not used.
    """
    hashed = labels.where(F.col("doc_id").isNotNull()).select("doc_id", "y", F.xxhash64("doc_id").alias("h"))
    part = F.pmod(F.col("h"), F.lit(3))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # At most dictionary_rows ids, so the join may broadcast them.
    picked = hashed.where(part != 0).orderBy("h", "doc_id").limit(dictionary_rows).select("doc_id", "y")
    rows = (texts.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y")
            .agg(F.min(F.substring("text", 1, dictionary_chars)).alias("text")).orderBy("doc_id").collect())
    made = train_dictionaries([r["text"] for r in rows], [r["y"] for r in rows])
    if made is None:
        share = labels.agg(F.avg("y")).first()[0]
        flat = texts.select("doc_id", F.lit(0.5 if share is None else float(share)).alias("score"))
        return flat.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
    x = checkpointed(with_features(docs, made, id_col, text_col))
    unseen = hashed.where(part == 0).orderBy("h", "doc_id").limit(calibration_rows).select("doc_id", "y")
    fit = x.join(F.broadcast(unseen), "doc_id").groupBy("doc_id", "y").agg(F.min("x").alias("x")).orderBy("doc_id").collect()
    y = np.array([r["y"] for r in fit], dtype=float)
    if len(y) and 0 < y.mean() < 1:
        model = calibrate(np.array([r["x"] for r in fit]), y)
    else:  # nothing to calibrate on: a window that three bytes tell is toxic
        weight = np.zeros(N_FEATURES + 1)
        weight[2 * len(THRESHOLDS)], weight[-1] = 1.0, -3.0
        model = Calibration(np.zeros(N_FEATURES), np.ones(N_FEATURES), weight)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        m = np.array(b.column(1).flatten(), dtype=np.float64).reshape(-1, N_FEATURES)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(model.score(m), pa.float64())], names=["doc_id", "score"])

    out = arrow_map(x, run, f"doc_id {dict(x.dtypes)['doc_id']}, score double")
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
