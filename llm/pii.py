"""Personal data replaced by format-preserving pseudonyms.

What matches a format and passes its validation (Luhn, IBAN mod 97, octets, calendar, numbering plan)
is read as an integer of that format's domain, moved by a keyed Feistel permutation of the domain, and
written back in the same layout. A permutation is one-to-one, so equal values stay equal and different
ones stay different in all documents, and a pseudonym is itself a valid value of the format.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from collections.abc import Iterator
from datetime import date
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from llm.frames import slices

ROUNDS = 10
#: Letters and digits that are permuted as one number.
LONG = 64
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Feistel:
    """A keyed permutation of range(n) by an alternating Feistel network over a*b >= n and cycle walking."""

    def __init__(self, key: bytes, label: str, n: int):
        self.n = n
        self.a = math.isqrt(max(n - 1, 0)) + 1
        self.b = -(-n // self.a)
        self.key = hashlib.blake2b(label.encode() + b"\0" + n.to_bytes((n.bit_length() + 7) // 8, "little"), key=key[:64], digest_size=32).digest()
        self.size = (self.a.bit_length() + 7) // 8 + 8

    def _f(self, k: int, x: int) -> int:
        data = bytes([k]) + x.to_bytes(max(1, (x.bit_length() + 7) // 8), "little")
        if self.size <= 64:
            return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=self.size).digest(), "little")
        return int.from_bytes(hashlib.shake_256(self.key + data).digest(self.size), "little")

    def _once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for k in range(ROUNDS):
            if k % 2:
                right = (right + self._f(k, left)) % self.b
            else:
                left = (left + self._f(k, right)) % self.a
        return left * self.b + right

    def _back(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for k in reversed(range(ROUNDS)):
            if k % 2:
                right = (right - self._f(k, left)) % self.b
            else:
                left = (left - self._f(k, right)) % self.a
        return left * self.b + right

    def __call__(self, x: int, valid=lambda y: True) -> int:
        """The image of x; values outside the domain, or not valid, are walked over (x itself must be valid)."""
        while True:
            x = self._once(x)
            if x < self.n and valid(x):
                return x

    def inverse(self, x: int, valid=lambda y: True) -> int:
        while True:
            x = self._back(x)
            if x < self.n and valid(x):
                return x


def luhn_digit(payload: str) -> str:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _laid_out(digits: str, like: str) -> str:
    """digits in the places of the digits of ``like``."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in like)


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _iban_check(country: str, rest: str) -> str:
    number = int("".join(str(int(c, 36)) for c in rest + country + "00"))
    return f"{98 - number % 97:02d}"


_EPOCH, _LAST = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if m[3:] else m for m in MONTHS).replace("Sep(?:tember)?", "Sep(?:t(?:ember)?)?") + r")\.?"
_NAMED = rf"(?<![A-Za-z0-9])(?:[0-9]{{1,2}}(?i:st|nd|rd|th)?(?: of)?[ -]{_MONTH},?[ -]|{_MONTH} [0-9]{{1,2}}(?i:st|nd|rd|th)?,? )[0-9]{{4}}(?![A-Za-z0-9])"
#: One alternative per kind; the first that matches at a place and validates wins.
PATTERN = re.compile(
    r"(?P<email>(?<!(?u:\w))(?<![.%+-])(?u:[^\W_])(?u:[\w.%+-]*[\w%+-])?@(?u:[^\W_]|-)+(?:\.(?u:[^\W_]|-)+)+)"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))"
    r"|(?P<date>(?<![0-9.])(?:[0-9]{4}(?P<sep>[./-])[0-9]{1,2}(?P=sep)[0-9]{1,2}|[0-9]{1,2}(?P<sep2>[./-])[0-9]{1,2}(?P=sep2)[0-9]{4})(?!\.?[0-9])|" + _NAMED + ")"
    r"|(?P<ip>(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9]))"
    r"|(?P<phone>(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])[0-9]{3,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])|\+[0-9]{8,15}(?![0-9]))"
    r"|(?P<card>(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]))",
    re.ASCII,
)
KINDS = ("email", "iban", "date", "ip", "ssn", "phone", "card")


@lru_cache(1 << 16)
def _alphabet(c: str) -> str:
    """The characters that may stand for c: digits, letters of its case, or, beyond ASCII, those of its category in its 128 code points; none for others."""
    if c < "\x80":
        return "" if not c.isalnum() else _DIGITS if c.isdigit() else _LOWER if c.islower() else _UPPER
    if not c.isalnum():
        return ""
    kind, low = unicodedata.category(c), ord(c) & ~127
    return "".join(x for x in map(chr, range(low, low + 128)) if unicodedata.category(x) == kind)


class Pseudonymiser:
    """replace(text) under one key; the same key gives the same pseudonyms anywhere."""

    def __init__(self, key: bytes):
        self.key = key
        self.feistel = lru_cache(4096)(lambda label, n: Feistel(key, label, n))
        self.held = lru_cache(100_000)(self._value)

    def value(self, kind: str, s: str) -> str | None:
        """The pseudonym, or None if s is no valid value of its kind; those of short values are held."""
        return self.held(kind, s) if len(s) <= LONG else self._value(kind, s)

    def number(self, label: str, digits: str, valid=lambda s: True) -> str:
        n, width = 10 ** len(digits), len(digits)
        return f"{self.feistel(f'{label}{width}', n)(int(digits), lambda y: valid(f'{y:0{width}d}')):0{width}d}" if width else digits

    def characters(self, label: str, s: str) -> str:
        """Digits stay digits and letters stay letters of their case and script; other characters stay.

        Up to LONG of them are one number of the format's domain. Longer ones are two halves, each of which
        moves character by character by what the other half and the key give: a Feistel network as well,
        and linear in the length.
        """
        sets = [_alphabet(c) for c in s]
        shape = "".join("." if not a else a[0] for a in sets)
        moved = [(c, a) for c, a in zip(s, sets) if a]
        if len(moved) > LONG:
            new = self._halves(label + shape, np.array([a.index(c) for c, a in moved], np.int64), np.array([len(a) for _, a in moved], np.int64)).tolist()
        else:
            x, n = 0, 1
            for c, a in moved:
                x, n = x * len(a) + a.index(c), n * len(a)
            x = self.feistel(label + shape, n)(x)
            new = []
            for _, a in reversed(moved):
                x, k = divmod(x, len(a))
                new.append(k)
            new.reverse()
        it = iter(new)
        return "".join(a[next(it)] if a else c for c, a in zip(s, sets))

    def _halves(self, label: str, values: np.ndarray, sizes: np.ndarray, back: bool = False) -> np.ndarray:
        half, out = len(values) // 2, values.copy()
        key = hashlib.blake2b(label.encode(), key=self.key[:64], digest_size=32).digest()
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            to, by = (slice(half, None), slice(0, half)) if k % 2 else (slice(0, half), slice(half, None))
            stream = np.frombuffer(hashlib.shake_256(key + bytes([k]) + out[by].astype(np.uint8).tobytes()).digest(8 * len(out[to])), "<u8")
            shift = (stream % sizes[to].astype(np.uint64)).astype(np.int64)
            out[to] = (out[to] + (-shift if back else shift)) % sizes[to]
        return out

    def _value(self, kind: str, s: str) -> str | None:
        if kind == "email":
            local, _, domain = s.partition("@")
            return f"{self.characters('email ' + domain.lower(), local)}@{domain}"
        if kind == "card":
            d = _digits(s)
            if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
                return None
            payload = d[0] + self.number(f"card{d[0]}", d[1:-1])
            return _laid_out(payload + luhn_digit(payload), s)
        if kind == "iban":
            plain = s.replace(" ", "")
            country, rest = plain[:2], plain[4:]
            if not 15 <= len(plain) <= 34 or _iban_check(country, rest) != plain[2:4]:
                return None
            rest = self.characters("iban" + country, rest)
            it = iter(country + _iban_check(country, rest) + rest)
            return "".join(c if c == " " else next(it) for c in s)
        if kind == "ip":
            octets = [int(x) for x in s.split(".")]
            if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in s.split(".")):
                return None
            x = self.feistel("ip", 1 << 32)(int.from_bytes(bytes(octets)))
            return ".".join(map(str, x.to_bytes(4)))
        if kind == "ssn":
            valid = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
            return _laid_out(self.number("ssn", _digits(s), valid), s) if valid(_digits(s)) else None
        if kind == "phone":
            d = _digits(s)
            if not 8 <= len(d) <= 15 or "+" not in s and len(d) < 10 and "(" not in s:
                return None
            code = re.match(r"\+([0-9]{1,3})(?=[ .(-])", s)
            if code or "+" not in s:
                keep = code[1] if code else "1" if len(d) == 11 and d[0] == "1" else ""
            else:
                keep = "1" if d[0] == "1" and len(d) == 11 else d[:2]
            own = d[len(keep) :]
            plan = lambda x: x[0] in "23456789" and x[3] in "23456789"  # noqa: E731  of North America
            valid = plan if len(own) == 10 and keep in ("", "1") and plan(own) else lambda x: (x[0] == "0") == (own[0] == "0")
            # A number of the North American plan is one number with and without its country's 1.
            return _laid_out(keep + self.number("phonep" if valid is plan else "phone" + keep, own, valid), s)
        if named := re.search("[A-Za-z]{3,}", s):
            return self._named_date(s, named[0])
        parts = re.split("[-/.]", s)
        year_first = len(parts[0]) == 4
        y, m, d = (int(x) for x in (parts if year_first else reversed(parts)))
        swapped = not year_first and m > 12  # month, day, year
        try:
            day = date(y, d if swapped else m, m if swapped else d).toordinal()
        except ValueError:
            return None
        if not _EPOCH <= day <= _LAST:
            return None
        # A month-first date that could be read day-first is taken as such.
        new = self._moved_day(day)
        sep, width = next(c for c in s if not c.isdigit()), min(map(len, parts))
        y, m, d = f"{new.year:04d}", f"{new.month:0{width}d}", f"{new.day:0{width}d}"
        return sep.join([y, m, d] if year_first else [m, d, y] if swapped else [d, m, y])

    def _moved_day(self, day: int) -> date:
        """The pseudonym of a date, the same in all layouts: days over 12 stay over 12 and others don't, so that a month-first date is still read as one."""
        late = date.fromordinal(day).day > 12
        valid = lambda x: (date.fromordinal(x + _EPOCH).day > 12) == late
        return date.fromordinal(_EPOCH + self.feistel("date", _LAST - _EPOCH + 1)(day - _EPOCH, valid))

    def _named_date(self, s: str, month: str) -> str | None:
        """A date with the month's name, full or short and in its case; the day's ordinal ending follows the new day."""
        k = next(k for k, m in enumerate(MONTHS) if m[:3] == month[:3].title())
        day, ending = re.search("(?<![0-9])([0-9]{1,2})((?i:st|nd|rd|th)?)(?![0-9])", s).groups()
        try:
            x = date(int(s[-4:]), k + 1, int(day)).toordinal()
        except ValueError:
            return None
        if not _EPOCH <= x <= _LAST:
            return None
        new = self._moved_day(x)
        name = MONTHS[new.month - 1]
        name = name if month.title() == MONTHS[k] else name[:3]
        name = name.upper() if month.isupper() else name.lower() if month.islower() else name
        told = f"{new.day:0{len(day) if day[0] == '0' else 1}d}"
        if ending:
            other = "th" if 10 < new.day < 14 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
            told += other.upper() if ending.isupper() else other
        at, to = s.index(month), s.index(day)
        parts = sorted([(at, at + len(month), name), (to, to + len(day + ending), told), (len(s) - 4, len(s), f"{new.year:04d}")])
        out, done = "", 0
        for a, b, x in parts:
            out, done = out + s[done:a] + x, b
        return out

    def replace(self, text: str) -> tuple[str, list[int]]:
        """The text with pseudonyms, and how many values of each kind it had."""
        counts, out, done = [0] * len(KINDS), [], 0
        for begin, end in _windows(text):
            at, failed = max(begin, done), 0
            while (m := PATTERN.search(text, at, end)) is not None:
                kind = m.lastgroup if m.lastgroup in KINDS else "date"
                stop, new = m.end(), self.value(kind, m[0]) if kind != "phone" or m.end() > failed else None
                for cut in [k for k, c in enumerate(m[0]) if c == " "][::-1] if kind == "iban" and new is None else ():
                    # What follows the number may look like a part of it.
                    if (new := self.value(kind, m[0][:cut])) is not None:
                        stop = m.start() + cut
                        break
                if new is None and kind != "card" and (m2 := _CARD.match(text, m.start(), end)) is not None:
                    stop, new = m2.end(), self.value("card", m2[0])
                    kind = kind if new is None else "card"
                if new is None:
                    if kind == "iban":
                        failed = max(failed, m.end())  # its digits are no phone, but may be any other value
                    at = m.start() + 1
                    continue
                out += [text[done : m.start()], new]
                done = at = stop
                counts[KINDS.index(kind)] += 1
        return "".join([*out, text[done:]]) if out else text, counts


_CARD = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])", re.ASCII)
_anchor = re.compile("[0-9@]")
_white = re.compile(r"\s")
#: A month's name, a full stop and a space.
MONTH = 11


def _windows(text: str) -> Iterator[tuple[int, int]]:
    """Disjoint parts of the text that hold every value: digits and @ signs less than 64 characters apart, out to white space.

    No value has a longer stretch without digits, and only IBANs, phones and dates with a month's name hold
    white space; of these only the last have a word before the one with the first digit, in MONTH characters.
    """
    begin = last = None
    floor = 0
    for m in _anchor.finditer(text):
        at = m.start()
        if last is not None and at - last >= 64:
            floor = _end(text, last)
            yield begin, floor
            begin = None
        if begin is None:
            begin = max(at - MONTH, floor)
            while begin > floor and not text[begin - 1].isspace():
                begin -= 1
        last = at
    if begin is not None:
        yield begin, _end(text, last)


def _end(text: str, last: int) -> int:
    m = _white.search(text, min(len(text), last + 40))
    return m.start() if m else len(text)


_workers: dict[bytes, Pseudonymiser] = {}


def with_pseudonyms(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """The rows of docs with all their columns, text_col holding its text with pseudonyms."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _workers.setdefault(key, Pseudonymiser(key))
        for batch in slices(batches, text=at):
            texts = [worker.replace(t)[0] if t else t for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)


def pseudonymise(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_<kind> for each kind, n_replaced) for every row of docs.

    A null text stays null and an empty one empty, both with zero counts; very long texts and values are
    read whole, in time linear in their length. A date has one pseudonym in all its layouts, and so has a North American phone
    with or without its 1; other phones are linked in layouts that tell the same country code. Dates before 1900 and after 2099, and
    values that fail their format's validation, stay as they are. Text outside the replaced values keeps every character. Equal rows give equal rows; other columns of docs play no part.
    """
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = _workers.setdefault(key, Pseudonymiser(key))
        for batch in slices(batches):
            texts, counts = [], []
            for text in batch.column(1).to_pylist():
                new, n = worker.replace(text) if text else (text, _NONE)
                texts.append(new)
                counts.append(n)
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), *columns, pa.array(map(sum, counts), pa.int64())], names)

    names = ["id", "text", *(f"n_{k}" for k in KINDS), "n_replaced"]
    schema = f"id {kind}, text string, " + ", ".join(f"{n} long" for n in names[2:])
    out = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, schema)
    return out.withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)


_NONE = [0] * len(KINDS)
