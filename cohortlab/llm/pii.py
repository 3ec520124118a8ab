"""PII: format-preserving pseudonyms by a keyed Feistel permutation.

Numbers, dates and addresses that pass their validation are replaced by
another value of the same format: the value's rank among all values of its
format is permuted by a Feistel network under the key, walking until the
result is in range. The permutation is a bijection of the format's values, so
equal values get equal pseudonyms in every document, different values get
different ones, and ``restore`` undoes it with the key.

Rules (checked in this order; what overlaps an earlier find is skipped):

- email: letters and digits of everything but the top-level domain, each kind
  in its place; equal up to case
- hex secret: 32 to 128 hexadecimal digits with a letter and a digit
- access key: AKIA or ASIA and 16 capitals or digits; the four letters stay
- IBAN: passes mod 97; country stays, check digits are made anew
- card: 13 to 19 digits, single spaces or hyphens between, passes Luhn; the
  check digit is made anew, so the pseudonym passes it as well
- SSN: ddd-dd-dddd with valid area, group and serial number
- date: yyyy-mm-dd, dd/mm/yyyy, dd.mm.yyyy that is in the calendar, within
  the years 1900 to 2099; mm/dd/yyyy with a day above 12, which stays above 12
- IPv4: four numbers to 255
- phone: an international or North American number with a plus sign,
  brackets or separators, 7 to 15 digits; the country code stays

Numbers that fail their validation are left alone.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlab.llm.common import arrow_map

ROUNDS = 8
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

_RULES = {
    "email": r"(?<![\w.+%-])[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z])",
    "access_key": r"(?<![0-9A-Za-z])A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d\d(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![\w-])(?<!\d\.)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "date": r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?!\d|[/-]\d)",
    "ip": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{2,4}(?:[ .-]\d{2,5}){1,3}(?!\w)|(?<![\w+])\+\d{7,15}(?!\w)",
}
_RULE = {k: re.compile(v) for k, v in _RULES.items()}
# Every rule needs a digit or an at sign, but for a key or a secret of letters only; most texts have nothing of it.
_ANY = re.compile(r"[0-9@]|A[KS]IA|[A-Fa-f]{32}")


class Feistel:
    """A keyed bijection of range(n) for each n and tweak."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, n: int, r: int, x: int, modulus: int) -> int:
        size = min(64, modulus.bit_length() // 8 + 9)
        h = hashlib.blake2b(f"{tweak}|{n}|{r}|{x}".encode(), key=self.key, digest_size=size)
        return int.from_bytes(h.digest()) % modulus

    def permute(self, x: int, n: int, tweak: str, back: bool = False) -> int:
        """``x``'s image in range(n). Two halves of about the square root of n;
        images outside are permuted again until one is inside."""
        if n < 2:
            return x
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for r in (range(ROUNDS) if not back else reversed(range(ROUNDS))):
                sign = -1 if back else 1
                if r % 2:
                    right = (right + sign * self._round(tweak, n, r, left, b)) % b
                else:
                    left = (left + sign * self._round(tweak, n, r, right, a)) % a
            x = left * b + right
            if x < n:
                return x

    def text(self, s: str, tweak: str, back: bool = False) -> str:
        """Letters to letters of their case, digits to digits, all else stays.
        The rank is that of the lower-cased letters, so case doesn't part equal values."""
        rank, n = 0, 1
        for c in s:
            if (k := _kind(c)):
                rank, n = rank * k + _digit(c), n * k
        rank = self.permute(rank, n, f"{tweak}:{''.join(_shape(c) for c in s)}", back)
        out = []
        for c in reversed(s):
            if (k := _kind(c)):
                rank, d = divmod(rank, k)
                out.append(str(d) if k == 10 else chr(d + (65 if c.isupper() else 97)))
            else:
                out.append(c)
        return "".join(reversed(out))


def _kind(c: str) -> int:
    return 10 if "0" <= c <= "9" else 26 if c.isascii() and c.isalpha() else 0


def _digit(c: str) -> int:
    return ord(c) - 48 if c <= "9" else ord(c.lower()) - 97


def _shape(c: str) -> str:
    return {10: "9", 26: "a", 0: c}[_kind(c)]


def luhn(digits: str) -> int:
    """Zero for a number that passes; the last digit counts."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _relaid(s: str, digits: str) -> str:
    """``digits`` put in the places of the letters and digits of ``s``."""
    it = iter(digits)
    return "".join(next(it) if c.isalnum() else c for c in s)


def pseudonym(rule: str, s: str, f: Feistel, back: bool = False) -> str | None:
    """The pseudonym of one find, or None if it fails the rule's validation."""
    digits = "".join(c for c in s if "0" <= c <= "9")
    if rule == "email":
        head, dot, top = s.rpartition(".")
        return f.text(head, "email", back) + dot + top
    if rule == "secret":
        if digits == s or not digits:
            return None
        low = f.permute(int(s, 16), 16 ** len(s), f"secret:{len(s)}", back)
        out = f"{low:0{len(s)}x}"
        return out.upper() if s.upper() == s else out
    if rule == "access_key":
        return s[:4] + f.text(s[4:], "access_key", back)
    if rule == "iban":
        bare = s.replace(" ", "")
        if not 15 <= len(bare) <= 34 or mod97(bare) != 1:
            return None
        body = f.text(bare[4:], "iban:" + bare[:2], back)
        check = 98 - mod97(bare[:2] + "00" + body)
        return _relaid(s, f"{bare[:2]}{check:02d}{body}")
    if rule == "card":
        if luhn(digits):
            return None
        body = f"{f.permute(int(digits[:-1]), 10 ** (len(digits) - 1), f'card:{len(digits)}', back):0{len(digits) - 1}d}"
        return _relaid(s, body + str(-luhn(body + "0") % 10))
    if rule == "ssn":
        areas = 898  # 001 to 899 without 666
        area, group, serial = int(s[:3]), int(s[4:6]), int(s[7:])
        if not (0 < area < 900 and area != 666 and group and serial):
            return None
        rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
        rank = f.permute(rank, areas * 99 * 9999, "ssn", back)
        rank, serial = divmod(rank, 9999)
        area, group = divmod(rank, 99)
        return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"
    if rule == "date":
        # Month first only where it can't be the day: then the pseudonym's day is above 12 as well.
        us = s[2] == "/" and int(s[3:5]) > 12
        form = "%Y-%m-%d" if s[4] == "-" else "%m/%d/%Y" if us else "%d/%m/%Y" if s[2] == "/" else "%d.%m.%Y"
        try:
            day = datetime.datetime.strptime(s, form).date().toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        while True:
            day = FIRST_DAY + f.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date", back)
            if not us or datetime.date.fromordinal(day).day > 12:  # a walk along the cycle stays a bijection
                break
        return datetime.date.fromordinal(day).strftime(form)
    if rule == "ip":
        parts = [int(x) for x in s.split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
            return None
        rank = f.permute(int.from_bytes(bytes(parts)), 1 << 32, "ip", back)
        return ".".join(str(x) for x in rank.to_bytes(4))
    # phone: the country code after a plus sign stays
    code = re.match(r"\+\d{1,3}(?=[ .-]|\()", s)
    head = code[0] if code else "+" if s.startswith("+") else ""
    rest = "".join(c for c in s[len(head):] if "0" <= c <= "9")
    if not 7 <= len(digits) <= 15 or len(rest) < 6 or not (head or "(" in s or len(rest) >= 10):
        return None
    got = f"{f.permute(int(rest), 10 ** len(rest), f'phone:{head}:{len(rest)}', back):0{len(rest)}d}"
    return head + _relaid(s[len(head):], got)


def finds(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, rule) of all matches, validated or not yet, without overlaps, by place."""
    taken: list[tuple[int, int, str]] = []
    for rule, pattern in _RULE.items():
        for m in pattern.finditer(text):
            taken.append((m.start(), m.end(), rule))
    return taken


def replaced(text: str | None, f: Feistel, back: bool = False) -> tuple[str | None, list[tuple[str, int, int, int]]]:
    """The text with pseudonyms, and (rule, begin and end in the new text, begin
    in the old text) of each. Rules come in order; a find that overlaps an
    accepted one is skipped."""
    if not text or not _ANY.search(text):
        return text, []
    accepted: list[tuple[int, int, str, str]] = []
    used = bytearray()
    for begin, end, rule in finds(text):
        if not used:
            used = bytearray(len(text))
        if any(used[begin:end]):
            continue
        new = pseudonym(rule, text[begin:end], f, back)
        if new is not None:
            used[begin:end] = b"\1" * (end - begin)
            accepted.append((begin, end, rule, new))
    out, spans, at, made = [], [], 0, 0
    for begin, end, rule, new in sorted(accepted):
        out += [text[at:begin], new]
        made += begin - at
        spans.append((rule, made, made + len(new), begin))
        made += len(new)
        at = end
    return "".join([*out, text[at:]]), spans


SPANS = T.ArrayType(T.StructType([T.StructField("rule", T.StringType()), T.StructField("begin", T.IntegerType()),
                                  T.StructField("end", T.IntegerType()), T.StructField("was", T.IntegerType())]))


def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and one more column ``spans``
    (array of rule, begin, end, was: places in the new and the old text).

    Whole texts; a null text stays null, an empty one empty, both without
    spans. Every row comes back, repeated rows with equal results; a column
    named ``spans`` is replaced, other extra columns pass through. ``back``
    restores texts that the same key made.
    """
    base = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "spans"])
    at = base.columns.index(text_col)
    schema = T.StructType([*base.schema, T.StructField("spans", SPANS)])

    def run(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        f = Feistel(key)
        got = [replaced(t, f, back) for t in b.column(at).to_pylist()]
        cols = list(b.columns)
        cols[at] = pa.array([t for t, _ in got], pa.string())
        kind = pa.list_(pa.struct([("rule", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("was", pa.int32())]))
        spans = pa.array([[dict(zip(("rule", "begin", "end", "was"), s)) for s in x] for _, x in got], kind)
        yield pa.RecordBatch.from_arrays([*cols, spans], names=[c.name for c in schema])

    return arrow_map(base, run, schema)
