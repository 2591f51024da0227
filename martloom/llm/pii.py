"""Format-preserving pseudonyms for personal numbers, dates, addresses and secrets.

A value is found by its form and checked (check digits, calendar, ranges). Its content is
a number below a size that the form fixes: sixteen digits, the days of two centuries,
the 32 bits of an address. A keyed Feistel network with cycle walking permutes these
numbers, so that a pseudonym has the same form, equal values get equal pseudonyms in
every document, and whoever holds the key can undo them.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.tables import carried, read_table, restored

# Production takes the key from its own secret store.
DEMONSTRATION_KEY = b"demonstration key, replace it"
ROUNDS = 8

_RESULT = "doc_id long, n_found long, kinds string, text string"

_FIRST_DAY = dt.date(1900, 1, 1).toordinal()
_DAYS = dt.date(2099, 12, 31).toordinal() - _FIRST_DAY + 1


class Feistel:
    """Keyed permutations of the numbers 0 to size - 1, one per ``label``."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, label: str, number: int, half: int) -> int:
        text = f"{label}|{number}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest())

    def _once(self, value: int, side: int, label: str) -> int:
        left, right = divmod(value, side)
        for number in range(ROUNDS):
            left, right = right, (left + self._round(label, number, right)) % side
        return left * side + right

    def _back(self, value: int, side: int, label: str) -> int:
        left, right = divmod(value, side)
        for number in reversed(range(ROUNDS)):
            left, right = (right - self._round(label, number, left)) % side, left
        return left * side + right

    def permute(self, value: int, size: int, label: str) -> int:
        """Image of ``value``; the walk ends, since it stays on the cycle of ``value``."""
        return self._walk(self._once, value, size, label)

    def restore(self, value: int, size: int, label: str) -> int:
        return self._walk(self._back, value, size, label)

    def _walk(self, step: Callable, value: int, size: int, label: str) -> int:
        side = isqrt(size - 1) + 1
        value = step(value, side, f"{label}|{size}")
        while value >= size:
            value = step(value, side, f"{label}|{size}")
        return value


def luhn_digit(digits: str) -> str:
    """Check digit that follows ``digits``."""
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if at % 2 == 0 else 1)
        total += value - 9 if value > 9 else value
    return str(-total % 10)


def is_luhn(digits: str) -> bool:
    return luhn_digit(digits[:-1]) == digits[-1]


def iban_digits(country: str, account: str) -> str:
    """The two check digits of an account number of ``country``."""
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _fill(template: str, digits: str) -> str:
    """``template`` with its digits replaced in order; all other characters stay."""
    supply = iter(digits)
    return "".join(next(supply) if c.isdigit() else c for c in template)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


class Pseudonyms:
    """Replaces values of every kind; with ``undo`` it restores them instead."""

    def __init__(self, key: bytes, undo: bool = False):
        self.feistel = Feistel(key)
        self.step = self.feistel.restore if undo else self.feistel.permute

    def _number(self, text: str, base: int, label: str) -> str:
        """``text``, a number in base 10, 16 or 26, permuted among those of its length."""
        if base == 26:
            value = 0
            for c in text:
                value = value * 26 + ord(c) - 97
        else:
            value = int(text, base)
        value = self.step(value, base ** len(text), f"{label}|{len(text)}")
        if base == 10:
            return f"{value:0{len(text)}d}"
        if base == 16:
            return f"{value:0{len(text)}x}"
        out = []
        for _ in text:
            value, rest = divmod(value, 26)
            out.append(chr(97 + rest))
        return "".join(reversed(out))

    def number(self, found: str) -> str | None:
        """Twelve to nineteen digits; a valid check digit stays valid."""
        digits = _only_digits(found)
        if is_luhn(digits):
            body = self._number(digits[:-1], 10, "card")
            return _fill(found, body + luhn_digit(body))
        # Among the numbers that fail the check, so that the two never mix.
        value = digits
        while True:
            value = self._number(value, 10, "account")
            if not is_luhn(value):
                return _fill(found, value)

    def row(self, found: str) -> tuple[str, int]:
        """Groups set apart by spaces: only numbers of usual groups and a valid check digit.

        A new number is one with which the same groups are found again, so that the way
        back reads the same ones.
        """
        groups, begin, count = found.split(" "), 0, 0
        while (place := _first_number(groups, begin)) is not None:
            while True:
                new = self.number(" ".join(groups[place])).split(" ")
                groups[place] = new
                if _first_number(groups, begin) == place:
                    break
            begin, count = place.stop, count + 1
        return " ".join(groups), count

    def phone(self, found: str) -> str | None:
        """The country code stays; up to ten digits after it change."""
        digits = _only_digits(found)
        body = digits[-10:] if len(digits) > 10 else digits
        return _fill(found, digits[: len(digits) - len(body)] + self._number(body, 10, "phone"))

    def social(self, found: str) -> str | None:
        digits = _only_digits(found)
        if not _valid_social(digits):
            return None
        while True:
            digits = self._number(digits, 10, "social")
            if _valid_social(digits):
                return _fill(found, digits)

    def address(self, found: str) -> str | None:
        parts = [int(p) for p in found.split(".")]
        if max(parts) > 255 or any(str(p) != t for p, t in zip(parts, found.split("."))):
            return None
        value = int.from_bytes(bytes(parts))
        return ".".join(map(str, self.step(value, 2**32, "address").to_bytes(4)))

    def date(self, found: str) -> str | None:
        """Year first, or day or month first as the calendar allows; 1900 to 2099."""
        mark = found[4] if found[4] in "-/." else found[2]
        forms = [f"%Y{mark}%m{mark}%d"] if found[4] == mark else [
            f"%d{mark}%m{mark}%Y", f"%m{mark}%d{mark}%Y"
        ]
        for form in forms:
            try:
                day = dt.datetime.strptime(found, form).toordinal() - _FIRST_DAY
            except ValueError:
                continue
            if 0 <= day < _DAYS:
                # A day that could be read as a month stays one, so that the way back
                # reads the same form.
                while True:
                    day = self.step(day, _DAYS, f"date|{form}")
                    out = dt.date.fromordinal(day + _FIRST_DAY).strftime(form)
                    if form == forms[0] or int(out[3:5]) > 12:
                        return out
        return None

    def iban(self, found: str) -> tuple[str, int] | None:
        """The new number and how far it reached: words that follow are no part of it.

        The longest end with valid check digits counts. A new number is one for which no
        longer end is valid, so that the way back reads the same one.
        """
        ends = [len(found), *(m.start() for m in reversed([*re.finditer(" ", found)]))]
        for longer, end in enumerate(ends):
            if end < len(found) and len(found[:end].replace(" ", "")) < _SHORTEST_IBAN:
                break
            if not _valid_iban(found[:end]):
                continue
            compact = found[:end].replace(" ", "")
            country, account = compact[:2], compact[4:]
            while True:
                digits = self._number(_only_digits(account), 10, f"iban|{country}")
                account = _fill(account, digits)
                supply = iter(country + iban_digits(country, account) + account)
                new = "".join(c if c == " " else next(supply) for c in found[:end])
                if not any(_valid_iban(new + found[end:e]) for e in ends[:longer]):
                    return new, end
        return None

    def email(self, found: str) -> str | None:
        """Letters and digits of the name and of the host's first label change, form kept.

        Case does not take part: names in any case get pseudonyms in lower case.
        """
        name, host = found.rsplit("@", 1)
        label, rest = host.split(".", 1)
        return f"{self._runs(name, 'name')}@{self._runs(label, 'host')}.{rest}"

    def _runs(self, text: str, label: str) -> str:
        return re.sub(
            r"[a-z]+|[0-9]+",
            lambda m: self._number(m[0], 10 if m[0].isdigit() else 26, label),
            text.lower(),
        )

    def secret(self, found: str) -> str | None:
        out = self._number(found.lower(), 16, "secret")
        return out.upper() if found.upper() == found else out


# Norwegian numbers are the shortest.
_SHORTEST_IBAN = 15


def _valid_iban(text: str) -> bool:
    compact = text.replace(" ", "")
    country, check, account = compact[:2], compact[2:4], compact[4:]
    return bool(_only_digits(account)) and iban_digits(country, account) == check


def _valid_social(digits: str) -> bool:
    area = int(digits[:3])
    return 0 < area < 900 and area != 666 and digits[3:5] != "00" and digits[5:] != "0000"


# Digits in the groups of a number that is written with separators.
_GROUPS = ((4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4))


def _first_number(groups: list[str], begin: int) -> slice | None:
    """The first groups from ``begin`` that are a number with a valid check digit."""
    for at in range(begin, len(groups)):
        for form in _GROUPS:
            place = slice(at, at + len(form))
            if tuple(map(len, groups[place])) == form and is_luhn("".join(groups[place])):
                return place
    return None


def _hyphened(form: tuple[int, ...]) -> str:
    return "-".join(f"[0-9]{{{size}}}" for size in form)


# Dates and social numbers come before numbers, which have no mixed separators; every form must not touch further letters or digits.
_FORMS = re.compile(
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z])"
    r"|(?P<secret>(?<![0-9A-Za-z])(?=[0-9a-fA-F]*[a-fA-F])(?=[0-9a-fA-F]*[0-9])"
    r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![0-9A-Za-z]))"
    r"|(?P<iban>(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?!\w))"
    r"|(?P<phone>(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?!\w)"
    r"|(?<![\w+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?!\w)"
    r"|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-]))"
    r"|(?P<social>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<address>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9]|[A-Za-z_]))"
    r"|(?P<date>(?<![\w-])(?:[0-9]{4}(?P<m1>[-/.])[0-9]{2}(?P=m1)[0-9]{2}"
    r"|[0-9]{2}(?P<m2>[-/.])[0-9]{2}(?P=m2)[0-9]{4})(?:(?=T[0-9]{2}:[0-9]{2})|(?![\w-])))"
    r"|(?P<number>(?<![\w.])[0-9]{12,19}(?!\w)"
    rf"|(?<![\w.])(?<![0-9]-)(?:{'|'.join(map(_hyphened, _GROUPS))})(?!\w|-[0-9]))"
    r"|(?P<row>(?<![\w.])[0-9]+(?: [0-9]+){2,}(?![\w-]))",
    re.ASCII,
)
_HINT = re.compile(r"[0-9]\.?[0-9]|@", re.ASCII)


def pseudonymised(text: str, names: Pseudonyms) -> tuple[str, dict[str, int]]:
    """``text`` with every valid value replaced, and how many there were of each kind."""
    counts: dict[str, int] = {}

    if not _HINT.search(text):
        return text, counts
    out, begin = [], 0
    while match := _FORMS.search(text, begin):
        start, end = match.span()
        new, found = match[0], 1
        if match["row"] is not None:
            kind = "number"
            new, found = names.row(match[0])
        else:
            kind = next(k for k in _KINDS if match[k] is not None)
            made = getattr(names, kind)(match[0])
            if kind == "iban":
                # What follows the number, or its first word, may hold other values.
                first = start + (match[0] + " ").index(" ")
                made, end = (made[0], start + made[1]) if made else (None, first)
                new = text[start:end]
            if made is None:
                found = 0
            else:
                new = made
        if found:
            counts[kind] = counts.get(kind, 0) + found
        out += [text[begin:start], new]
        begin = end
    return "".join([*out, text[begin:]]), counts


_KINDS = ("email", "secret", "iban", "phone", "number", "social", "address", "date")


def protect(docs: DataFrame, key: bytes = DEMONSTRATION_KEY, undo: bool = False) -> DataFrame:
    """doc_id, n_found, kinds (sorted, with counts) and the new text of every row.

    A missing text stays missing, and an empty one empty, with nothing found. The result
    depends on the text and the key alone, so repeated rows get equal results. ``undo``
    restores protected texts. An empty table gives an empty result.
    """

    def replaced(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Pseudonyms(key, undo)
        for frame in frames:
            rows = []
            for text in frame["text"]:
                if text is None:
                    rows.append((0, "", None))
                    continue
                new, counts = pseudonymised(text, names)
                kinds = ",".join(f"{k}:{counts[k]}" for k in sorted(counts))
                rows.append((sum(counts.values()), kinds, new))
            out = pd.DataFrame(rows, columns=["n_found", "kinds", "text"])
            out.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield out

    return restored(docs.select(carried(), "text").mapInPandas(replaced, _RESULT))


def op10_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return protect(read_table(spark, folder, "documents"))
