"""SentencePiece encoding and decoding by a prefix table.

For merge-type (BPE) pieces, every prefix of a text has exactly one encoding,
and that of a longer prefix ends in a token whose predecessor is the last
token of the prefix before it. So it is enough to store, for each prefix, its
last token: an automaton over the pieces names the tokens that end at a
position, and the one is taken that is *compatible* with the last token of
the prefix before it, which means that the merge rules leave exactly this
pair when they are run over the pair alone. The ids are then recovered from
the end backwards. The work is linear in the text and no merge queue is kept.

No merge crosses a place where two characters meet that no piece has side by
side. A space mark after another character is such a place (checked when the
model is loaded), so texts are cut there into words, words at the other such
places into parts, and words and parts met before are looked up. The tables
forget what is long unused, which changes nothing but speed.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.common import arrow_map

SPACE = "▁"
# Entries in each generation of the word table; about 50 MB of a Python worker for each.
TABLE_ROWS = 250_000
# Longer words are encoded each time they come.
TABLE_WORD = 64
# Pairs whose compatibility is remembered.
PAIR_ROWS = 500_000


class PrefixTable:
    """Encoder and decoder for one model file of type BPE with byte fallback."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        plain = [i for i in range(len(self.pieces)) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.id = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("a piece holds a space mark after another character")
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte fallback")
        # What an id says: its piece, nothing for controls, a byte as a character or, from 80 on, as a lone surrogate.
        self.said = list(self.pieces)
        for i in range(len(self.pieces)):
            if sp.is_control(i):
                self.said[i] = ""
        self.said[sp.unk_id()] = " \u2047 "
        for x, i in self.bytes.items():
            self.said[i] = chr(x) if x < 0x80 else chr(0xDC00 + x)
        self.is_byte = set(self.bytes.values())
        self.automaton = ahocorasick.Automaton()
        for p in self.id:
            self.automaton.add_word(p, (p, len(p)))
        self.automaton.make_automaton()
        self.met = {p[i:i + 2] for p in self.id for i in range(len(p) - 1)}
        self.letters = {p for p in self.id if len(p) == 1}
        self.after: dict[str, dict[str, bool]] = {"": {}}
        self.n_pairs = 0
        self.words: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.cut = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")

    def merged(self, text: str) -> list[str]:
        """The merge rules run over a short string: best score first, then leftmost."""
        s = list(text)
        while True:
            best, at = None, -1
            for i in range(len(s) - 1):
                x = self.score.get(s[i] + s[i + 1])
                if x is not None and (best is None or x > best):
                    best, at = x, i
            if best is None:
                return s
            s[at:at + 2] = [s[at] + s[at + 1]]

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merge rules over left + right leave just these two."""
        row = self.after.setdefault(left, {})
        got = row.get(right)
        if got is None:
            if self.n_pairs >= PAIR_ROWS:
                self.after, self.n_pairs = {"": {}}, 0
                row = self.after.setdefault(left, {})
            got = row[right] = self.merged(left + right) == ([left, right] if left else [right])
            self.n_pairs += 1
        return got

    def tokens(self, word: str) -> list[str]:
        """Tokens of one word (with its space marks); a character that no piece covers is a token of its own."""
        last = [""]
        if self.letters.issuperset(word):
            # The automaton names the tokens by rising end; the first compatible one settles its prefix.
            settled = -1
            after, none = self.after, {}
            for end, (piece, n) in self.automaton.iter(word):
                if end != settled:
                    left = last[end + 1 - n]
                    ok = after.get(left, none).get(piece)
                    if ok is None:
                        ok = self.compatible(left, piece)
                        after = self.after
                    if ok:
                        last.append(piece)
                        settled = end
        else:
            ends: list[list[str]] = [[] for _ in word]
            for end, (piece, _) in self.automaton.iter(word):
                ends[end].append(piece)
            for end, found in enumerate(ends):
                if word[end] not in self.letters:
                    found.append(word[end])
                last += [p for p in found if self.compatible(last[end + 1 - len(p)], p)][:1]
        if len(last) != len(word) + 1:
            raise AssertionError("a prefix has no last token")
        out, end = [], len(word)
        while end:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def part(self, part: str) -> tuple[int, ...]:
        """Ids of a part, looked up or by the prefix table."""
        got = self.words.get(part) or self.older.get(part)
        if got is None:
            ids: list[int] = []
            for t in self.tokens(part):
                if (i := self.id.get(t)) is not None:
                    ids.append(i)
                else:
                    ids += [self.bytes[b] for b in t.encode()]
            got = self.keep(part, tuple(ids))
        return got

    def keep(self, word: str, ids: tuple[int, ...]) -> tuple[int, ...]:
        if len(word) <= TABLE_WORD:
            if len(self.words) >= TABLE_ROWS:
                self.words, self.older = {}, self.words
            self.words[word] = ids
        return ids

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a word, cut where two characters stand together that no piece has side by side."""
        got = self.older.get(word)
        if got is None:
            met, parts, begin = self.met, [], 0
            for at in range(1, len(word)):
                if word[at - 1:at + 1] not in met:
                    parts.append(word[begin:at])
                    begin = at
            if not parts:
                return self.part(word)
            parts.append(word[begin:])
            got = tuple(itertools.chain.from_iterable(map(self.part, parts)))
        return self.keep(word, got)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        ids: list[int] = []
        if text:
            for w in self.cut.findall(SPACE + text.replace(" ", SPACE)):
                ids.extend(self.words.get(w) or self.word(w))
        return ids

    def decode(self, ids) -> str:
        """Text of a list of ids; the first space mark is the one that encoding adds."""
        s = "".join(map(self.said.__getitem__, ids))
        if not s.isascii() and HIGH_BYTE.search(s):
            # Each run of bytes is read by itself.
            parts = (list(g) for _, g in itertools.groupby(ids, self.is_byte.__contains__))
            s = "".join(_utf8("".join(self.said[i] for i in g).encode("utf-8", "surrogateescape")) for g in parts)
        return (s[1:] if s.startswith(SPACE) else s).replace(SPACE, " ")


HIGH_BYTE = re.compile("[\udc80-\udcff]")


def _utf8(b: bytes) -> str:
    """Bytes read as UTF-8; each byte that doesn't fit becomes one replacement character."""
    out, at = [], 0
    while at < len(b):
        n = 1 if b[at] < 0x80 else 2 if 0xC2 <= b[at] < 0xE0 else 3 if 0xE0 <= b[at] < 0xF0 else 4 if 0xF0 <= b[at] < 0xF5 else 1
        try:
            out.append(b[at:at + n].decode())
            at += n
        except UnicodeDecodeError:
            out.append("\ufffd")
            at += 1
    return "".join(out)


@functools.lru_cache(maxsize=2)
def load(model_file: str) -> PrefixTable:
    """One table per model and Python worker."""
    return PrefixTable(model_file)


def encode(docs: DataFrame, model_file: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int, no begin or end ids) and
    ``decoded``, the text that these ids decode to. Text passes through whole;
    a null or empty text has no ids and decodes to the empty text. Every row
    comes back, repeated ones too; columns named ``ids`` or ``decoded`` are
    replaced. The model file must stand at ``model_file`` on every executor."""
    kept = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    base = docs.select(*[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([*base.schema, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    at = kept.index(text_col)

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        t = load(model_file)
        ids = [t.encode(x) for x in b.column(at).to_pylist()]
        decoded = pa.array([t.decode(x) for x in ids], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.list_(pa.int32())), decoded], names=[f.name for f in schema])

    return arrow_map(base, run, schema)


def decode(rows: DataFrame, model_file: str, ids_col: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of ``ids_col`` (null counts as no ids)."""
    base = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c.lower() != "decoded"])
    schema = T.StructType([*base.schema, T.StructField("decoded", T.StringType())])
    at = base.columns.index(ids_col)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        t = load(model_file)
        out = pa.array([t.decode(x or []) for x in b.column(at).to_pylist()], pa.string())
        return pa.RecordBatch.from_arrays([*b.columns, out], names=[f.name for f in schema])

    return arrow_map(base, run, schema)
