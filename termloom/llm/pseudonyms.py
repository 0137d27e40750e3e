"""Format-preserving pseudonyms for personal data.

A value that passes its validator is replaced by another valid value of the same format. Its
free positions are read as one number below the product of their radices, and a keyed Feistel
network permutes the numbers below that product: the same value gives the same pseudonym in
every document and on every executor, two values never share one, and who holds the key can
go back. Check digits are computed anew.

| kind  | validated by            | kept              | permuted                              |
|-------|-------------------------|-------------------|---------------------------------------|
| email | shape                   | domain, separators| letters and digits before the @       |
| phone | area and exchange rules | layout, prefix    | area, exchange, line                  |
| card  | Luhn sum, 13-19 digits  | first digit       | other digits but the check digit      |
| iban  | remainder mod 97        | country, layout   | letters and digits after the checks   |
| ssn   | area, group, serial     | layout            | all three                             |
| ipv4  | four bytes              | dots              | the four bytes                        |
| date  | calendar, 1900-2099     | layout            | the day among all days of that range  |
| secret| known prefixes          | prefix            | letters and digits after the prefix   |
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
KINDS = ("email", "phone", "card", "iban", "ssn", "ipv4", "date", "secret")
# Pseudonyms a worker keeps at hand.
KEPT = 20_000

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY

PATTERN = re.compile(
    r"(?P<secret>\bAKIA[A-Z0-9]{16}\b|(?i:password|passwd|pwd|secret|token|api[_-]?key)\s*[=:]\s*[\"']?[A-Za-z0-9_\-]{8,})"
    r"|(?P<email>(?<![A-Za-z0-9._%+\-])[A-Za-z0-9][A-Za-z0-9._%+\-]*@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,})"
    r"|(?P<iban>\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b)"
    r"|(?<![\d.\-/])(?:"
    r"(?P<phone>(?:\+?1[ .\-]?)?(?:\([2-9]\d\d\) ?|[2-9]\d\d[ .\-])[2-9]\d\d[ .\-]\d{4})"
    r"|(?P<ipv4>\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})"
    r"|(?P<ssn>\d{3}-\d{2}-\d{4})"
    r"|(?P<date>\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})"
    r"|(?P<card>\d{13,19}|\d{4}([ \-])(?:\d{4}\9\d{4}\9\d{1,7}|\d{6}\9\d{5}))"
    r")(?!\d|[.\-/]\d)"
)
# Every value holds one of these; the pattern is tried only around them.
ANCHOR, AROUND, BLANK, BLANKS = re.compile(r"[0-9@=:]"), 100, re.compile(r"\s"), re.compile(r"\s*")


def permute(value: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of range(size): a Feistel network over two halves whose product
    is at least ``size``, walked on until it falls below ``size`` again."""
    if size < 2:
        return value
    left_size = int(size**0.5) if size < 1 << 52 else 1 << (size.bit_length() // 2)
    right_size = -(-size // max(left_size, 1))
    while True:
        left, right = divmod(value, right_size)
        for r in range(ROUNDS) if not back else reversed(range(ROUNDS)):
            source = right if r % 2 == 0 else left
            digest = hashlib.blake2b(f"{tweak}|{size}|{r}|{source}".encode(), key=key, digest_size=32).digest()
            step = int.from_bytes(digest, "big") * (-1 if back else 1)
            if r % 2 == 0:
                left = (left + step) % left_size
            else:
                right = (right + step) % right_size
        value = left * right_size + right
        if value < size:
            return value


def _mixed(text: str, alphabets: list[str], key: bytes, kind: str, back: bool) -> str:
    """Permute characters, each within its own alphabet, as one mixed-radix number."""
    number, size = 0, 1
    for c, a in zip(text, alphabets, strict=True):
        number, size = number * len(a) + a.index(c), size * len(a)
    number = permute(number, size, key, f"{kind}{len(text)}", back)
    out = []
    for a in reversed(alphabets):
        number, i = divmod(number, len(a))
        out.append(a[i])
    return "".join(reversed(out))


def _alphabet(c: str) -> str:
    return next(a for a in (_DIGITS, _UPPER, _LOWER) if c in a)


def _fill(shape: str, characters: str, what: str = r"[A-Za-z0-9]") -> str:
    """Put characters back into the places of a layout."""
    source = iter(characters)
    return re.sub(what, lambda _: next(source), shape)


def _free(value: str, key: bytes, kind: str, back: bool) -> str:
    plain = re.sub(r"[^A-Za-z0-9]", "", value)
    return _fill(value, _mixed(plain, list(map(_alphabet, plain)), key, kind, back))


def _email(value: str, key: bytes, back: bool) -> str:
    local, domain = value.rsplit("@", 1)
    return f"{_free(local, key, 'email', back)}@{domain}"


def _phone(value: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", value)
    own = digits[-10:]
    if own[0] < "2" or own[3] < "2":
        return None
    new = _mixed(own, [_DIGITS[2:] if i in (0, 3) else _DIGITS for i in range(10)], key, "phone", back)
    return _fill(value, digits[:-10] + new, r"\d")


def luhn(digits: str) -> int:
    """Remainder of the Luhn sum; 0 for a valid number."""
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10


def _card(value: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", value)
    if luhn(digits) or len(set(digits)) == 1:
        return None
    new = digits[0] + _mixed(digits[1:-1], [_DIGITS] * (len(digits) - 2), key, "card", back)
    return _fill(value, new + str(-luhn(new + "0") % 10), r"\d")


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _iban(value: str, key: bytes, back: bool) -> str | None:
    plain = value.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    body = _mixed(plain[4:], list(map(_alphabet, plain[4:])), key, "iban" + plain[:2], back)
    return _fill(value, f"{plain[:2]}{98 - _mod97(body + plain[:2] + '00'):02d}{body}", r"[A-Z0-9]")


def _ssn(value: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, value.split("-"))
    if area in (0, 666) or area > 899 or not group or not serial:
        return None
    number = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    number, serial = divmod(permute(number, 898 * 99 * 9999, key, "ssn", back), 9999)
    area, group = divmod(number, 99)
    return f"{area + 1 + (area + 1 >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _ipv4(value: str, key: bytes, back: bool) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    number = permute(int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, key, "ipv4", back)
    return ".".join(map(str, number.to_bytes(4, "big")))


def _date(value: str, key: bytes, back: bool) -> str | None:
    parts = re.split(r"\D", value)
    year_first = len(parts[0]) == 4
    year, second, third = map(int, parts if year_first else (parts[2], parts[1], parts[0]))
    month_first = not year_first and second > 12  # m/d/y where d/m/y is no date
    month, day = (third, second) if month_first else (second, third)
    try:
        ordinal = datetime.date(year, month, day).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    if not 0 <= ordinal < _DAYS:
        return None
    separator = re.search(r"\D", value)[0]
    if year_first:
        new = datetime.date.fromordinal(_FIRST_DAY + permute(ordinal, _DAYS, key, "date", back))
        return f"{new.year:04d}{separator}{new.month:02d}{separator}{new.day:02d}"
    # within the dates that are written in the same way: with the month first only where the
    # day is over 12, else with the day first
    while True:
        ordinal = permute(ordinal, _DAYS, key, "date", back)
        new = datetime.date.fromordinal(_FIRST_DAY + ordinal)
        if not month_first or new.day > 12:
            break
    first, second = (new.month, new.day) if month_first else (new.day, new.month)
    return f"{first:02d}{separator}{second:02d}{separator}{new.year:04d}"


def _secret(value: str, key: bytes, back: bool) -> str:
    head = re.match(r"AKIA|[A-Za-z_\-]+\s*[=:]\s*[\"']?", value)[0]
    body = value[len(head) :]
    if head != "AKIA":
        return head + _free(body, key, "secret", back)
    return head + _mixed(body, [_DIGITS + _UPPER] * len(body), key, "akia", back)


_REWRITE: dict[str, Callable[[str, bytes, bool], str | None]] = {
    "email": _email, "phone": _phone, "card": _card, "iban": _iban, "ssn": _ssn, "ipv4": _ipv4,
    "date": _date, "secret": _secret,
}


def windows(text: str) -> list[tuple[int, int]]:
    """Disjoint parts of a text, whole words each, outside of which no value can stand. Blanks
    beside an anchor, of which a value may hold any number, do not count as its surroundings."""
    out: list[list[int]] = []
    for m in ANCHOR.finditer(text):
        if out and m.start() <= out[-1][1]:
            continue
        floor, lead = out[-1][1] if out else 0, m.start()
        while lead > floor and text[lead - 1].isspace():
            lead -= 1
        start = max(lead - AROUND, 0)
        while start > floor and not text[start - 1].isspace():
            start -= 1
        end = BLANK.search(text, min(BLANKS.match(text, m.end()).end() + AROUND, len(text)))
        stop = end.start() if end else len(text)
        if out and start <= floor:
            out[-1][1] = stop
        else:
            out.append([start, stop])
    grown = []
    for start, stop in out:  # no value may be cut off at the end of a window
        last = max((m.end() for m in ANCHOR.finditer(text, start, stop)), default=stop)
        last = BLANKS.match(text, last).end()
        end = BLANK.search(text, min(max(stop, last + AROUND), len(text)))
        stop = end.start() if end else len(text)
        if grown and start <= grown[-1][1]:
            grown[-1][1] = max(stop, grown[-1][1])
        else:
            grown.append([start, stop])
    return [(a, b) for a, b in grown]


class Pseudonymiser:
    """Rewrites texts under one key; ``back`` undoes it."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.one = lru_cache(KEPT)(lambda kind, value: _REWRITE[kind](value, key, back))

    def rewrite(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The new text and (kind, start, length) of each replaced value in the old one."""
        found: list[tuple[str, int, int]] = []
        out, at = [], 0
        for start, stop in windows(text):
            for m in PATTERN.finditer(text, start, stop):
                kind = next(k for k in KINDS if m[k] is not None)
                new = self.one(kind, m[0])
                if new is None:
                    continue
                out += [text[at : m.start()], new]
                at = m.end()
                found.append((kind, m.start(), m.end() - m.start()))
        return "".join([*out, text[at:]]) if out else text, found


FOUND = "struct<text string, spans array<struct<kind string, start int, length int>>>"


def pseudonymise(
    docs: DataFrame, key: bytes, text: str = "text", spans: str | None = "pii_spans", back: bool = False
) -> DataFrame:
    """``docs`` with the personal data in ``text`` replaced, and where it stood in ``spans``
    (kind, start and length in code points of the old text).

    Rows and extra columns are kept as they are; a column named as ``spans`` is replaced. A
    null text stays null, with null spans; an empty one stays empty. The work is one pass
    without a shuffle. ``key``: 1 to 64 secret bytes; equal keys give equal pseudonyms.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Pseudonymiser(key, back)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))
        for values in batches:
            texts, found = [], []
            for at in range(0, len(values), 256):
                for value in values.slice(at, 256).to_pylist():
                    new, places = (None, None) if value is None else own.rewrite(value)
                    texts.append(new)
                    found.append(places and [dict(zip(("kind", "start", "length"), p, strict=True)) for p in places] if places is not None else None)
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(found, kind)], ["text", "spans"])

    udf = F.arrow_udf(run, FOUND, functionType=F.ArrowUDFType.SCALAR_ITER)
    kept = [F.col("_new.text").alias(text) if c == text else F.col(c) for c in docs.columns if c != spans]
    out = docs.withColumn("_new", udf(F.col(text)))
    return out.select(*kept, *([F.col("_new.spans").alias(spans)] if spans else []))
