"""Fill-in-middle transformation over memoized, content-defined chunks.

A rolling hash over the bytes of a text cuts it into chunks at places that
depend on the bytes around them only, so texts that share a passage share its
chunks wherever it stands. A chunk is read once in a task: a cache, looked up
by the chunk's content, holds its boundary summary (tokens, code points,
whether it starts and ends inside a run of letters). Summaries combine: two
neighbours have the sum of their tokens, less one if a run of letters goes on
across the border. The running counts locate the chunk in which a cut falls,
and only that chunk is read again to place it.

Tokens are ``[A-Za-z]+|[^A-Za-z]``, matched left to right over code points.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlab.llm.common import arrow_map, free_name

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Bytes that the rolling hash sees, and the bytes hashed in one go.
WINDOW, STEP = 32, 1 << 22
# A chunk ends where these bits of the hash are zero: every 512 bytes on average.
MASK = np.uint64(511 << 20)
MIN_CHUNK, MAX_CHUNK = 64, 8192
# Bytes of chunks that one task remembers, in two generations.
CACHE_BYTES = 1 << 25

_GEAR = np.frombuffer(b"".join(hashlib.blake2b(bytes([i]), digest_size=8).digest() for i in range(256)), np.uint64)
_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True
# Bytes that start a code point: all but the continuation bytes of UTF-8.
_LEADS = (np.arange(256) & 0xC0) != 0x80


def rolling(data: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each byte (fewer at the start): sum of gear values times powers of 2, modulo 2^64."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:
        h[width:] += h[:-width] << np.uint64(width)
        width *= 2
    return h


def borders(data: bytes) -> list[int]:
    """Ends of the chunks of a text. A chunk has ``MIN_CHUNK`` to ``MAX_CHUNK`` bytes (the last may have fewer) and never cuts a code point."""
    n = len(data)
    array = np.frombuffer(data, np.uint8)
    ends: list[int] = []
    start = 0
    for at in range(0, n, STEP):
        lo = max(0, at - WINDOW + 1)
        piece = array[lo:at + STEP]
        hits = np.flatnonzero((rolling(piece) & MASK) == 0) + lo + 1
        for end in hits[hits > at].tolist():
            while end - start > MAX_CHUNK:
                start = _whole(array, start + MAX_CHUNK)
                ends.append(start)
            if end - start >= MIN_CHUNK and end < n and _LEADS[array[end]]:
                start = end
                ends.append(end)
    while n - start > MAX_CHUNK:
        start = _whole(array, start + MAX_CHUNK)
        ends.append(start)
    if n > start:
        ends.append(n)
    return ends


def _whole(array: np.ndarray, end: int) -> int:
    """The last start of a code point at or before ``end``."""
    while not _LEADS[array[end]]:
        end -= 1
    return end


def _starts(chunk: bytes, goes_on: bool) -> np.ndarray:
    """Byte positions at which tokens of a chunk start; ``goes_on``: the text before it ends in a letter."""
    array = np.frombuffer(chunk, np.uint8)
    letter = _LETTER[array]
    before = np.empty_like(letter)
    before[1:] = letter[:-1]
    before[0] = goes_on
    return np.flatnonzero(np.where(letter, ~before, _LEADS[array]))


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Tokens and code points of a chunk, and whether its first and last bytes are letters."""
    array = np.frombuffer(chunk, np.uint8)
    return len(_starts(chunk, False)), int(_LEADS[array].sum()), bool(_LETTER[array[0]]), bool(_LETTER[array[-1]])


class Memo:
    """Boundary summaries by chunk content. Two generations: when the young one is full it becomes the old one, and the old one goes."""

    def __init__(self, most: int = CACHE_BYTES) -> None:
        self.most, self.size, self.young, self.old = most, 0, {}, {}

    def get(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        # A dictionary finds by hash and then compares the bytes: equal hashes of different chunks do no harm.
        got = self.young.get(chunk)
        if got is None:
            got = self.old.get(chunk) or summary(chunk)
            if self.size + len(chunk) > self.most // 2:
                self.old, self.young, self.size = self.young, {}, 0
            self.young[chunk] = got
            self.size += len(chunk)
        return got


class Counted:
    """A text with the running counts of its chunks."""

    def __init__(self, data: bytes, memo: Memo) -> None:
        self.data, self.ends = data, borders(data)
        self.tokens, self.points, self.goes_on = [0], [0], []
        start, letter = 0, False
        for end in self.ends:
            tokens, points, first, last = memo.get(data[start:end])
            self.goes_on.append(letter)
            self.tokens.append(self.tokens[-1] + tokens - (letter and first))
            self.points.append(self.points[-1] + points)
            start, letter = end, last
        self.n = self.tokens[-1]

    def place(self, units: int) -> tuple[int, int]:
        """Byte and code point after the first ``units`` tokens, at most all: where the next token starts."""
        if units >= self.n:
            return len(self.data), self.points[-1]
        i = bisect_right(self.tokens, units) - 1
        start = self.ends[i - 1] if i else 0
        chunk = self.data[start:self.ends[i]]
        at = int(_starts(chunk, self.goes_on[i])[units - self.tokens[i]])
        return start + at, self.points[i] + int(_LEADS[np.frombuffer(chunk[:at], np.uint8)].sum())


def transformed(data: bytes, h1: int, h2: int, h3: int, h4: int, plain_from: int, spm_below: int, memo: Memo) -> tuple[int, str, int | None, int | None, bytes]:
    """Tokens, form, code points of prefix and middle (None if plain) and the output of one text."""
    text = Counted(data, memo)
    if not data or any(m.encode() in data for m in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= plain_from:
        return text.n, "plain", None, None, data
    low, high = sorted((h1 % (text.n + 1), h2 % (text.n + 1)))
    (a, pa_), (b, pb) = text.place(low), text.place(high)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    if h4 % 100 < spm_below:
        return text.n, "spm", pa_, pb - pa_, s + suffix + p + prefix + m + middle
    return text.n, "psm", pa_, pb - pa_, p + prefix + s + suffix + m + middle


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 that depend on seed and id only: the first groups of eight hex digits of SHA-256 of ``seed:id`` (a null id is empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   rate: int = 90, spm: int = 20) -> DataFrame:
    """``docs`` with five more columns: ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points, null if plain) and ``output``.

    ``rate`` per cent of the texts are cut at two token borders drawn from seed and id, ``spm`` per cent of those
    put the suffix first. A null or empty text, and one that holds a marker, stays plain, so ``restore`` is exact.
    Rows that repeat an id are cut by the same draws. Extra columns pass through; those named like a new column
    are replaced. One text is handled in one task, hashed in blocks of 4 MB. An empty table gives no rows.
    """
    new = ("n", "form", "prefix_chars", "middle_chars", "output")
    kept = [c for c in docs.columns if c.lower() not in new or c in (id_col, text_col)]
    if any(c.lower() in new for c in kept):
        raise ValueError(f"id and text columns can't be named {', '.join(new)}")
    names = [free_name(docs, f"__draw{i}") for i in range(4)]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], *[d.alias(x) for d, x in zip(draws(F.col(f"`{id_col}`"), seed), names)])

    memo = Memo()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, hs = batch.column(kept.index(text_col)), [batch.column(len(kept) + i) for i in range(4)]
        got = [transformed((t.as_py() or "").encode(), *(h[i].as_py() for h in hs), rate, spm, memo) for i, t in enumerate(texts)]
        n, form, prefix, middle, output = zip(*got) if got else [()] * 5
        columns = [*batch.columns[:len(kept)], pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                   pa.array(middle, pa.int64()), pa.array([x.decode() for x in output], pa.string())]
        yield pa.RecordBatch.from_arrays(columns, [*kept, *new])

    types = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:len(kept)]),
                       "n long, form string, prefix_chars long, middle_chars long, output string"])
    return arrow_map(rows, run, types)


def restore(output: Column, form: Column) -> Column:
    """The text that ``fill_in_middle`` made ``output`` from. No marker stands inside the parts, nor across a border: each begins with ``<`` and ends with ``>``."""
    # The parts are bound by an outer lambda, so that a long output is split once.
    def back(o: Column) -> Column:
        first, rest = F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX)), F.substr(o, F.lit(len(PREFIX) + 1))
        cut, mid = F.position(first, rest), F.position(F.lit(MIDDLE), rest)
        one = F.left(rest, cut - 1)
        two = F.substr(rest, cut + len(SUFFIX), mid - cut - len(SUFFIX))
        middle = F.substr(rest, mid + len(MIDDLE))
        return F.when(form == "psm", F.concat(one, middle, two)).otherwise(F.concat(two, middle, one))
    return F.when(form == "plain", output).otherwise(F.get(F.transform(F.array(output), back), F.lit(0)))
