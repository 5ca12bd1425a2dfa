"""Format-preserving pseudonyms by keyed Feistel permutations.

Validated values are replaced by others of the same format: the digits of a
payment card keep a right check digit, a date stays a date in its notation.
The permutation depends on the key and the kind of value alone, so equal
values get equal pseudonyms in every document, and ``restore`` with the key
brings them back.  Nothing is shuffled: each text is its own work.

A day has one pseudonym in all notations (year first, day first with dots,
month first, day first where the day is over 12): days up to 12 and later ones
are permuted among themselves, so the pseudonym tells which of the two a day is.

An IBAN is read in one piece or in groups of four, a telephone number in North
American notation or as an international one with its plus.  What looks like an
IBAN but fails its check is searched for other values; should their pseudonyms
make it pass, which one such text in 97 does, ``restored`` takes it for one.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame

from docengine.llm.common import prepare, text_column

ROUNDS = 10


class Feistel:
    """Keyed permutation of 0 .. size-1: an unbalanced Feistel network with cycle walking."""

    def __init__(self, key: bytes, kind: str, size: int) -> None:
        self.size = size
        self.left = isqrt(max(size - 1, 0)) + 1
        self.right = -(-size // self.left)
        self.key = blake2b(f"{kind}/{size}".encode(), key=key[:64], digest_size=32).digest()

    def _round(self, i: int, half: int) -> int:
        data = i.to_bytes(1, "big") + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        return int.from_bytes(blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def _once(self, x: int, inverse: bool) -> int:
        a, b = divmod(x, self.right)
        for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            sign = -1 if inverse else 1
            if i % 2:
                b = (b + sign * self._round(i, a)) % self.right
            else:
                a = (a + sign * self._round(i, b)) % self.left
        return a * self.right + b

    def permute(self, x: int, inverse: bool = False) -> int:
        x = self._once(x, inverse)
        while x >= self.size:  # the grid is at most a row larger than the domain
            x = self._once(x, inverse)
        return x


def luhn_digit(digits: str) -> int:
    """Check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, account: str) -> str:
    value = "".join(str(int(c, 36)) for c in account + country) + "00"
    return f"{98 - int(value) % 97:02d}"


# Characters of an IBAN by country, from the registry: in grouped print they tell where it ends.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
# Country codes of telephone numbers have 1, 2 or else 3 digits.
SHORT_CODES = {"1", "7"}
TWO_DIGIT_CODES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 "
                      "66 81 82 84 86 90 91 92 93 94 95 98".split())

# Fixed formats.  A number is not part of a longer number or word.
DAY = r"(?:0?[1-9]|[12]\d|3[01])"
MONTH = r"(?:0?[1-9]|1[0-2])"
YEAR = r"(?:19|20)\d\d"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# In one piece for any country, or in groups of four for those of known length.
_GROUPED = "|".join(rf"(?:{countries.replace(' ', '|')})\d{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}"
                    + (rf" [A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, countries in IBAN_LENGTHS.items())
# Shapes of other formats, which an international number does not run into.
_OTHER = (r"(?:\d{3}-\d\d-\d{4}(?!\d)|\d{4}-\d\d?-\d\d?(?!\d)|\d\d?-\d\d?-\d{4}(?!\d)"
          r"|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d|\d{4}[ -]\d{6}[ -]\d{5}(?!\d))")
_DOTTED = r"(?:\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)|\d\d?\.\d\d?\.\d{4}(?!\d)|\d{4}\.\d\d\.\d\d(?!\d))"
_PHONES = (
    r"(?<!\w)\+?1[ .-]?\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\d)",
    r"(?<![\w+.-])\+?1[ .-][2-9]\d{2}[ .-]\d{3}[ .-]\d{4}(?![\d-])",
    # International: 8 to 15 digits after the plus, in groups or not.
    rf"(?<![\w+)])\+(?!{_OTHER})[1-9](?:(?: (?!{_OTHER})|-|[ -]?\(|\)(?: (?!{_OTHER})|-)?)?\d){{7,14}}(?!\d|[-./]\d)",
    rf"(?<![\w+)])\+(?!{_DOTTED})[1-9](?:\.?\d){{7,14}}(?!\d|[-./]\d)",
    r"(?<![\w.-])(?:\([2-9]\d{2}\)[ .-]?|\(?[2-9]\d{2}\)?[ .-])\d{3}[ .-]\d{4}(?![\d-])",
)
PATTERNS = {
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}\d{{2}})(?:[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}}|{_GROUPED})(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)",
    "date_iso": rf"(?<![\d/.-]){YEAR}([-/.])(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])(?![\d/-])",
    "date_num": rf"(?<![\d/.-]){DAY}([-/.]){DAY}\1{YEAR}(?![\d/-])",
    "phone": "|".join(_PHONES),
    "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])",
    "card": r"(?<![\d-])(?:\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19})(?![\d-])",
}
KINDS = ("card", "phone", "ssn", "ip", "iban", "date")


def _combined() -> re.Pattern:
    """One expression over all formats; references to separators are renumbered by name."""
    parts = []
    for kind, pattern in PATTERNS.items():
        seps = iter("ab")
        names: dict[str, str] = {}

        def name(match, kind=kind, names=names, seps=seps):
            letter = next(seps)
            names[str(len(names) + 1)] = letter
            return f"(?P<{kind}_{letter}>{match.group(1)})"

        pattern = re.sub(r"\((\[[^]]*\])\)", name, pattern)
        pattern = re.sub(r"\\([12])(?!\d)", lambda m, names=names, kind=kind: f"(?P={kind}_{names[m.group(1)]})", pattern)
        parts.append(f"(?P<{kind}>{pattern})")
    return re.compile("|".join(parts))


ANY = _combined()
DIGIT = re.compile("[0-9]")
DIGITS, LETTERS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

FIRST_YEAR, YEARS = 1900, 200


def _fill(shape: str, digits: str) -> str:
    """``digits`` in place of the digits of ``shape``."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in shape)


def _country_code(digits: str) -> str:
    return digits[:1 if digits[0] in SHORT_CODES else 2 if digits[:2] in TWO_DIGIT_CODES else 3]


class Pseudonyms:
    """Pseudonyms (or with ``inverse`` the originals) of values of the known formats."""

    def __init__(self, key: bytes, inverse: bool = False) -> None:
        if not key:
            raise ValueError("a key is needed")
        self.key, self.inverse = key, inverse
        self.feistel = lru_cache(None)(lambda kind, size: Feistel(key, kind, size))
        self.value = lru_cache(100_000)(self._value)

    def _permuted(self, kind: str, x: int, size: int) -> int:
        return self.feistel(kind, size).permute(x, self.inverse)

    def _digits(self, kind: str, digits: str) -> str:
        return f"{self._permuted(kind, int(digits), 10 ** len(digits)):0{len(digits)}d}"

    def _value(self, kind: str, text: str) -> tuple[str, str] | None:
        """(kind, pseudonym), or None for a value that fails its check."""
        if kind in ("date_iso", "date_num"):
            new = self._date(kind, text)
            return new and ("date", new)
        digits = re.sub(r"\D", "", text)
        if kind == "card":
            if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]) or not digits.strip("0"):
                return None
            body = self._digits(kind, digits[:-1])
            return kind, _fill(text, body + str(luhn_digit(body)))
        if kind == "phone":
            if text[0] == "+" and (digits[0] != "1" or len(digits) != 11):
                code = _country_code(digits)
                return kind, _fill(text, code + self._digits(f"phone+{code}", digits[len(code):]))
            prefix = "1" if len(digits) == 11 else ""
            return kind, _fill(text, prefix + self._phone(digits[-10:]))
        if kind == "ssn":
            return kind, self._ssn(text)
        if kind == "ip":
            x = 0
            for part in text.split("."):
                x = x << 8 | int(part)
            x = self._permuted(kind, x, 1 << 32)
            return kind, ".".join(str(x >> s & 255) for s in (24, 16, 8, 0))
        country, check, account = text[:2], text[2:4], text[4:].replace(" ", "")
        if iban_check(country, account) != check:
            return None
        account = self._account(f"iban{country}", account)
        it = iter(country + iban_check(country, account) + account)
        return "iban", "".join(c if c == " " else next(it) for c in text)

    def _account(self, kind: str, account: str) -> str:
        """Digits stay digits and letters letters, each place in its own alphabet."""
        alphabets = [DIGITS if c in DIGITS else LETTERS for c in account]
        x, size = 0, 1
        for c, alphabet in zip(account, alphabets):
            x, size = x * len(alphabet) + alphabet.index(c), size * len(alphabet)
        x, out = self._permuted(kind, x, size), []
        for alphabet in reversed(alphabets):
            x, k = divmod(x, len(alphabet))
            out.append(alphabet[k])
        return "".join(reversed(out))

    def _phone(self, digits: str) -> str:
        """Area codes from 200 on stay so, that the result reads as a number of the same kind."""
        area = int(digits[0]) >= 2
        size = 8 * 10 ** 9 if area else 2 * 10 ** 9
        x = self._permuted("phone", int(digits) - (2 * 10 ** 9 if area else 0), size)
        return f"{x + (2 * 10 ** 9 if area else 0):010d}"

    def _ssn(self, text: str) -> str:
        areas = 898  # 001-899 without 666
        a, g, s = int(text[:3]), int(text[4:6]), int(text[7:])
        a -= 1 + (a > 666)
        x = self._permuted("ssn", (a * 99 + g - 1) * 9999 + s - 1, areas * 99 * 9999)
        x, s = divmod(x, 9999)
        a, g = divmod(x, 99)
        a += 1
        return f"{a + (a >= 666):03d}-{g + 1:02d}-{s + 1:04d}"

    def _day(self, day: datetime.date) -> datetime.date:
        """One permutation for all notations, so that they stay linked.

        Days up to 12 and later ones are permuted among themselves: what is
        day first because its day is over 12 is read back as day first.
        """
        first, size, kind = (1, 12, "early") if day.day <= 12 else (13, 19, "late")
        x = ((day.year - FIRST_YEAR) * 12 + day.month - 1) * size + day.day - first
        while True:
            x = self._permuted(kind, x, YEARS * 12 * size)
            months, d = divmod(x, size)
            year, month = divmod(months, 12)
            try:
                return datetime.date(year + FIRST_YEAR, month + 1, d + first)
            except ValueError:
                continue  # no such day in its month: on along the cycle

    def _date(self, kind: str, text: str) -> str | None:
        sep = next(c for c in text if not c.isdigit())
        parts = text.split(sep)
        month_first = False
        try:
            if kind == "date_iso":
                day = datetime.date(*map(int, parts))
            else:
                a, b, year = map(int, parts)
                # The notation of dates with dots is day first; else month first where both could be.
                month_first = sep != "." and a <= 12
                day = datetime.date(year, a, b) if month_first else datetime.date(year, b, a)
        except ValueError:
            return None
        day = self._day(day)
        if kind == "date_iso":
            out = day.year, day.month, day.day
        else:
            out = (day.month, day.day, day.year) if month_first else (day.day, day.month, day.year)
        if kind == "date_iso":
            return sep.join((f"{out[0]:04d}", f"{out[1]:02d}", f"{out[2]:02d}"))
        width = 2 if len(parts[0]) == len(parts[1]) == 2 else 1
        return sep.join((f"{out[0]:0{width}d}", f"{out[1]:0{width}d}", f"{out[2]:04d}"))

    def text(self, text: str) -> tuple[str, list[tuple[str, int, int, str]]]:
        """The text with its values replaced, and (kind, start, end, pseudonym) of each in the new text."""
        if not DIGIT.search(text):
            return text, []
        out, spans, at, length, m = [], [], 0, 0, ANY.search(text)
        while m:
            kind = m.lastgroup if m.lastgroup in PATTERNS else m.lastgroup.rsplit("_", 1)[0]
            found, here = self.value(kind, m.group()), m
            # What only looks like a grouped IBAN may hold other values.
            m = ANY.search(text, here.start() + 4 if found is None and kind == "iban" else here.end())
            if found is None:
                continue
            kind, new = found
            out += [text[at:here.start()], new]
            length += here.start() - at
            spans.append((kind, length, length + len(new), new))
            length += len(new)
            at = here.end()
        out.append(text[at:])
        return "".join(out), spans


VALUES = "array<struct<kind:string,start:int,end:int,pseudonym:string>>"
_VALUES = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                              ("pseudonym", pa.string())]))


def pseudonymized(docs: DataFrame, key: bytes, inverse: bool = False) -> DataFrame:
    """All columns of ``docs``, ``text`` with pseudonyms, and ``pii_values`` (where they are in it).

    A null text stays null and has no values; an empty one stays empty;
    numbers that fail their check and impossible dates stay as they are;
    repeated rows give repeated rows.  A column named pii_values is replaced.
    """
    prepare(docs.sparkSession)
    kept = docs.drop("pii_values")
    fields = ", ".join(f"`{c}` {t}" for c, t in kept.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Pseudonyms(key, inverse)
        for b in batches:
            new = [(None, []) if t is None else names.text(t) for t in text_column(b)]
            at = b.schema.get_field_index("text")
            columns = list(b.columns)
            columns[at] = pa.array([t for t, _ in new], b.schema.field(at).type)
            values = [[dict(zip(("kind", "start", "end", "pseudonym"), s)) for s in spans] for _, spans in new]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(values, _VALUES)],
                                             names=[*b.schema.names, "pii_values"])

    return kept.mapInArrow(run, f"{fields}, pii_values {VALUES}")


def restored(docs: DataFrame, key: bytes) -> DataFrame:
    """The original texts of ``pseudonymized``, for who holds the key."""
    return pseudonymized(docs, key, inverse=True)
