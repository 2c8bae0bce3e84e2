"""Format-preserving pseudonyms of personal data.

Values are found by their form and validated (check digits, octets, calendar), then replaced by a keyed
permutation of all values of that form, a Feistel network over the form's own alphabet. Equal values get equal
pseudonyms in every document and under every key the values stay distinct, so links between documents remain
while the values are gone. Forms:

card: 13 to 19 digits that pass the Luhn check; the pseudonym passes it too. iban: letters and digits with valid
check digits, kept valid. phone: +, country code and 8 to 14 digits; the country code stays. ssn: 3-2-4 digits.
ip: four octets. date: year-month-day or day.month.year (also / between) of 1900 to 2099, permuted among the days
that are written with as many digits; month before day, which is read only where the day comes after the 12th, is
permuted among such days, so it is read the same way again. email: letters and digits of the local part and of the
domain before its last label. secret: what follows a password, token or key name. Signs between the characters and
upper case stay where they are.

A form may run on into digits or capital words that follow a value. So where a whole match fails its check, its
parts between group borders are tried: card groups of the usual sizes, an IBAN of its country's length or any
number of groups, a phone number without its last groups.

The key is an argument; the queries take it from the setting spark.basketry.pseudonymKey or, without one, draw a
key for the application, which then nobody can restore from.

A value that is not valid is no personal data and stays, as do null and empty texts. Where forms overlap, the one
listed first in FORMS wins, of one form the first in the text. Repeated rows change alike; other columns pass as
they are, the counted column's name must be free; tables without rows give none. A text takes time in proportion
to its length. Spans are character offsets of the original text.
"""

from __future__ import annotations

import hashlib
import re
import secrets
from bisect import bisect_left
from collections.abc import Iterator
from datetime import date, timedelta
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from basketry.llm.common import free_name, read_table

KEY_SETTING = "spark.basketry.pseudonymKey"
ROUNDS = 10
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days
# Letters and digits of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20,
}
# Digits of a card's groups, the last one cut where the number is shorter.
CARD_GROUPS = ((4, 4, 4, 4), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3), (4, 4, 4, 1), (4, 6, 5), (4, 6, 4))
# The forms, the first that matches at a place wins.
FORMS = (
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9][A-Za-z0-9.-]{0,252}\.[A-Za-z]{2,24}(?![A-Za-z0-9])"),
    ("secret", r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key))[\"']?\s{0,2}[=:]\s{0,2}[\"']?"
               r"(?P<value>[A-Za-z0-9_+/.-]{6,}[A-Za-z0-9_+/=-])"),
    ("iban", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("date", r"(?<![0-9.-])(?:(?:19|20)[0-9]{2}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([/.-])[0-9]{1,2}\2(?:19|20)[0-9]{2})"
             r"(?![0-9]|[.-][0-9])"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("phone", r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
              r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"),
    ("card", r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"),
)
KINDS = tuple(name for name, _ in FORMS)
# Every form begins at a digit, a plus, an opening bracket, an at sign or a word of a secret.
_FORMS = [(name, re.compile(pattern)) for name, pattern in FORMS]
_GROUP = re.compile(r"[A-Za-z0-9]+|.", re.S)
_HINT = re.compile(r"[0-9@]|(?i:passw|pwd|secret|token|key)")


def luhn(digits: str) -> int:
    """Sum of the Luhn check, 0 for a valid number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10


def iban_rest(value: str) -> int:
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97


class Feistel:
    """Keyed permutations of the numbers below a given size."""

    def __init__(self, key: str):
        self.key = key.encode()

    def _round(self, tweak: str, i: int, value: int) -> int:
        data = f"{tweak}|{i}|{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key[:64], digest_size=32).digest(), "big")

    def permute(self, value: int, size: int, tweak: str) -> int:
        """The image of value, below size: an unbalanced network over two factors, walked until it is in range."""
        if size < 2:
            return value
        left = int(size ** 0.5) if size < 1 << 52 else int(np.sqrt(float(size)))
        left = max(2, left)
        right = -(-size // left)
        while True:
            a, b = divmod(value, right)
            for i in range(ROUNDS):
                if i % 2 == 0:
                    a = (a + self._round(tweak, i, b)) % left
                else:
                    b = (b + self._round(tweak, i, a)) % right
            value = a * right + b
            if value < size:
                return value

    def restore(self, value: int, size: int, tweak: str) -> int:
        """The number whose image is value."""
        if size < 2:
            return value
        left = int(size ** 0.5) if size < 1 << 52 else int(np.sqrt(float(size)))
        left = max(2, left)
        right = -(-size // left)
        while True:
            a, b = divmod(value, right)
            for i in reversed(range(ROUNDS)):
                if i % 2 == 0:
                    a = (a - self._round(tweak, i, b)) % left
                else:
                    b = (b - self._round(tweak, i, a)) % right
            value = a * right + b
            if value < size:
                return value


def classes(text: str) -> list[str]:
    """The alphabet of each letter or digit; an empty one for signs."""
    return [next((s for s in (DIGITS, LOWER, UPPER) if c in s), "") for c in text]


def to_number(text: str) -> tuple[int, int]:
    """The letters and digits as a number of mixed base, and how many such numbers there are."""
    value, size = 0, 1
    for c, letters in zip(text, classes(text), strict=True):
        if letters:
            value, size = value * len(letters) + letters.index(c), size * len(letters)
    return value, size


def from_number(value: int, form: str) -> str:
    """The text of that number in the form of another text."""
    out = []
    for c, letters in reversed(list(zip(form, classes(form), strict=True))):
        if letters:
            value, at = divmod(value, len(letters))
            c = letters[at]
        out.append(c)
    return "".join(reversed(out))


class Pseudonyms:
    """Pseudonyms of validated values under one key. With forward=False the values are restored."""

    def __init__(self, key: str, forward: bool = True):
        feistel = Feistel(key)
        self.move = feistel.permute if forward else feistel.restore
        self.of = lru_cache(maxsize=50_000)(self._of)

    def _letters(self, text: str, tweak: str) -> str:
        value, size = to_number(text)
        shape = "".join("9" if c == DIGITS else "a" if c == LOWER else "A" for c in classes(text) if c)
        return from_number(self.move(value, size, f"{tweak}|{shape}"), text)

    def _of(self, kind: str, value: str) -> str | None:
        """The pseudonym, or None if the value is not valid."""
        return getattr(self, f"_{kind}")(value)

    def _card(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if luhn(digits) or not int(digits):
            return None
        body = self._letters(digits[:-1], "card")
        digits = iter(body + str(-luhn(body + "0") % 10))
        return "".join(next(digits) if c in DIGITS else c for c in value)

    def _iban(self, value: str) -> str | None:
        bare = value.replace(" ", "")
        if not 15 <= len(bare) <= 34 or iban_rest(bare) != 1:
            return None
        body = self._letters(bare[4:], "iban" + bare[:2])
        new = iter(bare[:2] + f"{98 - iban_rest(bare[:2] + '00' + body):02d}" + body)
        return "".join(c if c == " " else next(new) for c in value)

    def _phone(self, value: str) -> str | None:
        digits = re.sub(r"\D", "", value)
        if not 8 <= len(digits) <= 15:
            return None
        code = re.match(r"\+[0-9]{1,3}(?=[ .(-])|\+[0-9]{1,2}|", value)[0]
        # The subscriber's number alone is permuted, so one written with other signs keeps its pseudonym.
        rest = re.sub(r"\D", "", value[len(code):])
        new = iter(self._letters(rest, "phone" + code))
        return code + "".join(next(new) if c in DIGITS else c for c in value[len(code):])

    def _ssn(self, value: str) -> str | None:
        area, group, serial = value.split("-")
        if area in ("000", "666") or area >= "900" or group == "00" or serial == "0000":
            return None
        # Valid numbers: 898 areas, 99 groups, 9999 serials.
        a = int(area) - 1 - (int(area) > 666)
        n = self.move((a * 99 + int(group) - 1) * 9999 + int(serial) - 1, 898 * 99 * 9999, "ssn")
        n, serial = divmod(n, 9999)
        a, group = divmod(n, 99)
        return f"{a + 1 + (a >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"

    def _ip(self, value: str) -> str | None:
        octets = [int(x) for x in value.split(".")]
        if max(octets) > 255:
            return None
        n = 0
        for x in octets:
            n = n * 256 + x
        n = self.move(n, 1 << 32, "ip")
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))

    def _date(self, value: str) -> str | None:
        sign = next(c for c in value if not c.isdigit())
        parts = value.split(sign)
        year_first = len(parts[0]) == 4
        y, m, d = (0, 1, 2) if year_first else (2, 1, 0)
        if not year_first and int(parts[1]) > 12:
            m, d = 0, 1  # month before day: the day is after the 12th
        try:
            at = (date(int(parts[y]), int(parts[m]), int(parts[d])) - FIRST_DAY).days
        except ValueError:
            return None
        days = days_written(len(parts[m]), len(parts[d]), 13 if (m, d) == (0, 1) else 1)
        tweak = "date" if len(days) == DAYS else f"date|{len(parts[m])}{len(parts[d])}{len(days)}"
        new = FIRST_DAY + timedelta(days=days[self.move(bisect_left(days, at), len(days), tweak)])
        for place, number in ((y, new.year), (m, new.month), (d, new.day)):
            parts[place] = f"{number:0{len(parts[place])}d}"
        return sign.join(parts)

    def _email(self, value: str) -> str:
        local, _, domain = value.rpartition("@")
        name, _, last = domain.rpartition(".")
        return self._letters(local, "local") + "@" + self._letters(name, "domain") + "." + last

    def _secret(self, value: str) -> str | None:
        return self._letters(value, "secret") if to_number(value)[1] > 10**6 else None


@lru_cache(maxsize=16)
def days_written(month_digits: int, day_digits: int, first: int) -> tuple[int, ...]:
    """The days, in order, whose month and day of month have at most so many digits, from the `first` of a month on."""
    every = (FIRST_DAY + timedelta(days=i) for i in range(DAYS))
    return tuple(
        i for i, day in enumerate(every)
        if first <= day.day < 10**day_digits and day.month < 10**month_digits
    )


def parts_of(kind: str, value: str) -> Iterator[tuple[int, int]]:
    """(start, end) of what a match may hold if it is not valid as a whole, the likeliest first."""
    groups = [m.span() for m in re.finditer(r"[A-Za-z0-9]+", value)]
    if kind == "card":
        sizes = [b - a for a, b in groups]
        for form in sorted(CARD_GROUPS, key=sum, reverse=True):
            for i in range(len(groups) - len(form) + 1):
                if tuple(sizes[i : i + len(form)]) == form:
                    yield groups[i][0], groups[i + len(form) - 1][1]
        for a, b in groups:  # a number written in one
            if b - a >= 13:
                yield a, b
    elif kind == "iban":
        length, seen = IBAN_LENGTHS.get(value[:2]), 0
        for at, c in enumerate(value, 1):
            seen += c != " "
            if seen == length and not value[at : at + 1].isalnum():
                yield 0, at
                return
        if length is None:
            yield from ((0, b) for _, b in reversed(groups[:-1]))
    elif kind == "phone":
        yield from ((0, b) for _, b in reversed(groups[:-1]))


class Spans:
    """Taken spans in order, without overlap."""

    def __init__(self):
        self.starts: list[int] = []
        self.rows: list[tuple[int, int, str, str]] = []

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return not at or self.rows[at - 1][1] <= start

    def add(self, found: list[tuple[int, int, str, str]]) -> None:
        """Spans in order, none of which overlaps a taken one."""
        if found:
            self.rows = sorted(self.rows + found)
            self.starts = [r[0] for r in self.rows]


def find_values(text: str | None, pseudonyms: Pseudonyms) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of the valid values, in order and without overlap; earlier forms win."""
    if not text or not _HINT.search(text):
        return []
    taken = Spans()
    for kind, pattern in _FORMS:
        found, at = [], 0
        while m := pattern.search(text, at):
            start, end = m.span("value") if kind == "secret" else m.span()
            new = pseudonyms.of(kind, text[start:end])
            if new is None:
                for a, b in parts_of(kind, text[start:end]):
                    new = pseudonyms.of(kind, text[start + a : start + b])
                    if new is not None:
                        start, end = start + a, start + b
                        break
            if new is not None and taken.free(start, end):
                found.append((start, end, kind, new))
            # After a value the search goes on behind it; after none, behind the first group of the match.
            at = end if new is not None else start + len(_GROUP.match(text, start)[0])
        taken.add(found)
    return taken.rows


def replaced(text: str, values: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, new in values:
        out += (text[at:start], new)
        at = end
    return "".join(out) + text[at:]


_DRAWN: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting, or one drawn for the application."""
    application = spark.sparkContext.applicationId
    if application not in _DRAWN:
        _DRAWN[application] = secrets.token_hex(32)
    return spark.conf.get(KEY_SETTING, None) or _DRAWN[application]


def pseudonymise(docs: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """The rows of docs with pseudonyms in their text; count: name of a column for the number replaced."""
    fields = docs.schema.fields + ([StructField(count, IntegerType())] if count else [])
    schema = StructType(fields)
    at = [f.name for f in docs.schema.fields].index("text")

    def run(batches):
        pseudonyms = Pseudonyms(key)
        for batch in batches:
            texts, counts = [], []
            for text in batch.column(at).to_pylist():
                values = find_values(text, pseudonyms)
                texts.append(replaced(text, values) if values else text)
                counts.append(len(values))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.types[at])
            if count:
                columns.append(pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    return docs.mapInArrow(run, schema)


def find_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, kind, start, end, pseudonym) of every value found in docs."""
    schema = StructType([
        StructField("doc_id", LongType()), StructField("kind", StringType()), StructField("start", IntegerType()),
        StructField("end", IntegerType()), StructField("pseudonym", StringType()),
    ])

    def run(batches):
        pseudonyms = Pseudonyms(key)
        for batch in batches:
            rows = [
                (i, *v) for i, t in enumerate(batch.column("text").to_pylist()) for v in find_values(t, pseudonyms)
            ]
            if rows:
                i, start, end, kind, new = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(pa.array(i)), pa.array(kind), pa.array(start, pa.int32()),
                    pa.array(end, pa.int32()), pa.array(new),
                ], schema.fieldNames())

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, schema)


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark), count=free_name(docs, "n_replaced"))


QUERIES = {"op9_pii": op9_pii}
SQL: dict[str, str] = {}
