"""Format-preserving pseudonyms for personal data, by a keyed Feistel network.

Every find is validated, read as a number below the size of its format,
permuted there under a key and written back in the same format. The map is a
bijection of the format, so equal values get equal pseudonyms in all documents
and different values never meet. Kinds:

``card``   13 to 19 digits with a valid Luhn digit (which is recomputed); with points
           between only in the groups of a card
``iban``   valid mod-97 check (recomputed); country and shape stay; in lower case or
           with hyphens only at the length of its country
``phone``  every +1 number, others of that form with area and exchange from 200
           on, and +cc numbers of 9 to 15 digits (the country code stays)
``ssn``    ddd-dd-dddd with valid parts
``ip``     four octets
``date``   year-month-day with any of ``-/.``, or day and month first, on the calendar
``email``  letters and digits of the local part and of the domain but its last label;
           spellings in other letter case link
``secret`` the value after a name with password, token, api key or secret, up to white
           space or a quote: letters and digits, of any length. Behind the last
           three a single word or a number below 8 digits stays, as it is
           rather prose or a count. After "Bearer" values of 8 and more with a digit

Separators, letter case and everything else stay as they are. Not looked for: names of
persons, postal addresses, keys without such a name before them, values spelt in words.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from math import isqrt

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, unpacked

KINDS = ("card", "iban", "phone", "ssn", "ip", "date", "email", "secret")
ROUNDS = 10
#: Symbols of a secret that are permuted as one number.
SECRET_BLOCK = 200

_DIGITS = "0123456789"
_LOWER = "abcdefghijklmnopqrstuvwxyz"
_LETTERS_AND_DIGITS = frozenset(_DIGITS + _LOWER + _LOWER.upper())
_FIRST_DAY = datetime.date(1800, 1, 1).toordinal()
_DAYS = datetime.date(2199, 12, 31).toordinal() - _FIRST_DAY + 1


def permute(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of 0 .. size - 1: a Feistel network on pairs from
    a * b >= size numbers, walked until it lands below ``size``."""
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    # Digests together must be wider than either half, or its upper digits would stay.
    tails = [b"", *(f"|{j}".encode() for j in range(1, -(-(a.bit_length() + 64) // 256)))]
    while True:
        left, right = divmod(value, b)
        for i in range(ROUNDS):
            other = right if i % 2 == 0 else left
            data = f"{tweak}|{size}|{i}|{other}".encode()
            digest = b"".join(hashlib.blake2b(data + tail, key=key, digest_size=32).digest() for tail in tails)
            add = int.from_bytes(digest, "big")
            if i % 2 == 0:
                left = (left + add) % a
            else:
                right = (right + add) % b
        value = left * b + right
        if value < size:
            return value


def _permute_symbols(text: str, key: bytes, tweak: str, fold: bool = False) -> str:
    """Permutes letters (by case) and digits in place; the rest stays. With
    ``fold`` texts that differ in letter case alone get pseudonyms that do so too."""
    places, value, size = [], 0, 1
    for i, c in enumerate(text):
        alphabet = _DIGITS if c in _DIGITS else _LOWER if c.lower() in _LOWER and c.isascii() else ""
        if alphabet and c.strip():
            places.append((i, alphabet, c.isupper()))
            value, size = value * len(alphabet) + alphabet.index(c.lower()), size * len(alphabet)
    # The shape is part of the tweak, so each shape has a permutation of its own.
    shape = "".join("9" if a is _DIGITS else "A" if up and not fold else "a" for _, a, up in places)
    value, out = permute(value, size, key, f"{tweak}|{shape}"), list(text)
    for i, alphabet, upper in reversed(places):
        value, k = divmod(value, len(alphabet))
        out[i] = alphabet[k].upper() if upper else alphabet[k]
    return "".join(out)


def luhn_digit(digits: str) -> int:
    """The check digit to append to ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return -total % 10


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced, in order."""
    source = iter(digits)
    return "".join(next(source) if c in _DIGITS else c for c in shape)


def _card(found: str, key: bytes) -> str | None:
    digits = "".join(c for c in found if c in _DIGITS)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
        return None
    body = str(permute(int(digits[:-1]), 10 ** (len(digits) - 1), key, "card")).zfill(len(digits) - 1)
    return _refill(found, body + str(luhn_digit(body)))


_DIGIT_RUN = re.compile(r"[0-9](?:[ .-]?[0-9]){12,}")
_GROUP = re.compile(r"[0-9]+")


def _cards(text: str, key: bytes, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """Cards from any group of a digit run to any other. Where several overlap,
    those written like a card go first, then by the first digit, place and length."""
    for run in _DIGIT_RUN.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, *run.span())]
        after_plus, tries = text[run.start() - 1:run.start()] == "+", []
        for i, (start, _) in enumerate(groups):
            digits = 0
            for j in range(i, len(groups)):
                end = groups[j][1]
                digits += end - groups[j][0]
                if digits > 19:
                    break
                if digits < 13 or any(end > s and start < e for s, e in taken):
                    continue
                found = text[start:end]
                if not _card(found, key) or after_plus and i == 0 and _phone_abroad("+" + found, key):
                    continue
                sizes = [e - s for s, e in groups[i:j + 1]]
                written = len(sizes) == 1 or sizes[:2] == [4, 6] and len(sizes) == 3 or (
                    set(sizes[:-1]) == {4} and sizes[-1] <= 4 and len({*found} - {*_DIGITS}) == 1)
                if written or not after_plus and "." not in found:
                    tries.append((not written, found[0] not in "23456", start, -end))
        free: list[tuple[int, int]] = []
        for _, _, start, end in sorted(tries):
            if all(-end <= s or start >= e for s, e in free):
                free.append((start, -end))
                yield start, -end, _card(text[start:-end], key)


#: Length of an IBAN by country.
_IBAN_LENGTHS = {c: int(n) for n, cs in (
    (15, "NO"), (16, "BE"), (18, "DK FI FO GL NL SD FK"), (19, "MK SI"), (20, "AT BA EE KZ LT LU XK MN"),
    (21, "CH CR HR LI LV"), (22, "BG BH DE GB GE IE ME RS VA"), (23, "AE GI IL IQ OM SO TL"),
    (24, "AD CZ ES MD PK RO SA SE SK TN VG"), (25, "LY PT ST"), (26, "IS TR"), (27, "BI DJ FR GR IT MC MR SM"),
    (28, "AL AZ BY CY DO GT HN HU LB NI PL SV"), (29, "BR EG PS QA UA"), (30, "JO KW MU YE"), (31, "MT SC"),
    (32, "LC"), (33, "RU")) for c in cs.split()}
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?=[ -]?[A-Za-z0-9])")
_IBAN_RUN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[ -]?[A-Za-z0-9]){0,30}")
_IBAN_END = re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])")
_IBAN_SPACES = re.compile(r"[ -]")


def _ibans(text: str, key: bytes, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """IBANs in a run of groups: of the country's length, or else the longest
    with a valid check; after a failed try the search goes on behind its first four."""
    at = 0
    while m := _IBAN_START.search(text, at):
        start, at = m.start(), m.end()
        run = _IBAN_RUN.match(text, start)[0]
        ends = [e.start() for e in _IBAN_END.finditer(run)]
        length = _IBAN_LENGTHS.get(run[:2].upper())
        sizes = {e: len(_IBAN_SPACES.sub("", run[:e])) for e in ends}
        for end in sorted(ends, key=lambda e: (sizes[e] != length, -e)):
            usual = run[:end].isupper() and "-" not in run[:end]
            if (usual or sizes[end] == length) and (new := _iban(run[:end], key)) and text[start + end:start + end + 1] not in _LETTERS_AND_DIGITS:
                yield start, start + end, new
                at = start + end
                break


def _iban(found: str, key: bytes) -> str | None:
    plain = _IBAN_SPACES.sub("", found).upper()
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or as_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _permute_symbols(plain[4:], key, f"iban{plain[:2]}")
    new = iter(plain[:2] + f"{98 - as_number(body + plain[:2] + '00') % 97:02d}" + body)
    return "".join(c if c in " -" else next(new).lower() if c.islower() else next(new) for c in found)


def _phone(found: str, key: bytes) -> str | None:
    digits = "".join(c for c in found if c in _DIGITS)
    area, exchange, line = int(digits[1:4]), int(digits[4:7]), int(digits[7:])
    if area < 200 or exchange < 200:
        return None
    value = permute(((area - 200) * 800 + exchange - 200) * 10_000 + line, 800 * 800 * 10_000, key, "phone")
    value, line = divmod(value, 10_000)
    area, exchange = divmod(value, 800)
    return _refill(found, f"1{area + 200}{exchange + 200}{line:04d}")


def _phone_1(found: str, key: bytes) -> str:
    """A number written with +1: valid ones among each other, all others likewise."""
    if new := _phone(found, key):
        return new
    value = int("".join(c for c in found if c in _DIGITS)[1:])
    while True:  # cycle walking keeps it a permutation of the numbers that are not valid
        value = permute(value, 10 ** 10, key, "phone other")
        if value // 10 ** 7 < 200 or value // 10_000 % 1000 < 200:
            return _refill(found, f"1{value:010d}")


#: Two-digit country codes, and the digits after the code at most where that is below E.164's 15 in all.
_TWO_DIGIT_CODES = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 "
                             "64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
_NATIONAL_DIGITS = {"7": 10, "27": 9, "30": 10, "31": 9, "32": 9, "33": 9, "34": 9, "39": 11, "41": 9, "44": 10, "45": 8,
                    "46": 9, "47": 8, "48": 9, "52": 10, "55": 11, "61": 9, "65": 8, "81": 10, "82": 10, "86": 11,
                    "90": 10, "91": 10, "351": 9, "353": 9, "358": 10, "420": 9, "852": 8, "971": 9}


def _phone_abroad(found: str, key: bytes) -> str | None:
    """A number written with another country code; the code and a (0) stay."""
    body = found.replace("(0)", "")
    digits = "".join(c for c in body if c in _DIGITS)
    code = digits[:1] if digits[0] == "7" else digits[:2] if digits[:2] in _TWO_DIGIT_CODES else digits[:3]
    rest = digits[len(code):]
    if not 9 <= len(digits) <= 15 or len(rest) > _NATIONAL_DIGITS.get(code, 15):
        return None
    new = iter(code + str(permute(int(rest), 10 ** len(rest), key, f"phone{code}")).zfill(len(rest)))
    return "(0)".join("".join(next(new) if c in _DIGITS else c for c in part) for part in found.split("(0)"))


def _ssn(found: str, key: bytes) -> str | None:
    valid = lambda v: (v // 1_000_000) not in (0, 666) and v // 1_000_000 < 900 and v // 10_000 % 100 and v % 10_000
    value = int(found.replace("-", ""))
    if not valid(value):
        return None
    while True:  # cycle walking keeps it a permutation of the valid numbers
        value = permute(value, 900_000_000, key, "ssn")
        if valid(value):
            return _refill(found, f"{value:09d}")


def _ip(found: str, key: bytes) -> str | None:
    octets = [int(x) for x in found.split(".")]
    if max(octets) > 255 or any(x != "0" and x.startswith("0") for x in found.split(".")):
        return None
    value = permute(int.from_bytes(bytes(octets), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, value.to_bytes(4, "big")))


def _date(found: str, key: bytes) -> str | None:
    a, b, c = re.split(r"[-/.]", found)
    year_first = len(a) == 4
    numbers = [int(x) for x in (a, b, c)]
    orders = ((0, 1, 2),) if year_first else ((2, 0, 1), (2, 1, 0))
    for y, m, d in orders:  # month before day where both readings are dates
        try:
            day = datetime.date(numbers[y], numbers[m], numbers[d]).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= day < _DAYS:
            continue
        while True:  # a date with the day first stays one that reads as such
            day = permute(day, _DAYS, key, "date")
            date = datetime.date.fromordinal(day + _FIRST_DAY)
            if (y, m) != (2, 1) or date.day > 12:
                break
        parts = [""] * 3  # two digits always, as one cannot hold every day or month
        parts[y], parts[m], parts[d] = f"{date.year:04d}", f"{date.month:02d}", f"{date.day:02d}"
        separators = [ch for ch in found if ch not in _DIGITS]
        return parts[0] + separators[0] + parts[1] + separators[1] + parts[2]
    return None


def _email(found: str, key: bytes) -> str | None:
    local, _, domain = found.rpartition("@")
    host, _, top = domain.rpartition(".")
    return f"{_permute_symbols(local, key, 'local', True)}@{_permute_symbols(host, key, 'host', True)}.{top}"


def _secret(found: str, key: bytes) -> str | None:
    only_hex = re.fullmatch(r"[0-9a-f]+", found)
    # Long values go in blocks, each with its place as a tweak, as the cost grows faster than the size of a number.
    blocks = -(-len(found) // SECRET_BLOCK)
    out = []
    for i in range(blocks):
        part = found[len(found) * i // blocks:len(found) * (i + 1) // blocks]
        place = f"|{i} of {blocks}" if blocks > 1 else ""
        if only_hex:
            out.append(f"{permute(int(part, 16), 16 ** len(part), key, f'hex{len(part)}{place}'):0{len(part)}x}")
        else:
            out.append(_permute_symbols(part, key, f"secret{place}"))
    return "".join(out)


_NAMED = re.compile(r"""(?:(passwor[dt]|passwd)|token|api[_-]?key|secret)[A-Za-z_]{0,64}["']?\s{0,4}[:=]\s{0,4}["'`]?"""
                    r"""((?:(?!&[A-Za-z_]+=)[^\s"'`<>])+)""", re.I)
_BEARER = re.compile(r"\bbearer\s{1,4}(?=[A-Za-z+/_.=~-]*[0-9])([A-Za-z0-9+/_.=~-]{8,})", re.I)
_WORD_OR_COUNT = re.compile(r"[A-Za-z]?[a-z]*|[0-9]{1,7}")


def _secrets(text: str, key: bytes, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """Values behind a name, without punctuation around them."""
    for m in _NAMED.finditer(text):
        found = m[2].rstrip(".,;:!?)]}*")
        start = m.start(2) + len(found) - len(found := found.lstrip("([{*"))
        word = _WORD_OR_COUNT.fullmatch(found) and not (len(found) >= 8 and re.fullmatch("[0-9a-f]+", found))
        if found and (m[1] or not word):
            yield start, start + len(found), _secret(found, key)
    for m in _BEARER.finditer(text):
        found = m[1].rstrip(".")
        yield m.start(1), m.start(1) + len(found), _secret(found, key)


def _by(pattern: re.Pattern, change: Callable[[str, bytes], str | None]):
    """Finds of a pattern (its group is the find) that ``change`` takes."""
    def find(text: str, key: bytes, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
        for m in pattern.finditer(text):
            if (new := change(m[1], key)) is not None:
                yield *m.span(1), new
    return find


_ABROAD = re.compile(r"(?<![0-9])(\+(?![0-9]{4}([-/.])[0-9]{1,2}\2[0-9])[2-9][0-9]{0,14}(?:[ ./-]?\([0-9]{1,5}\)[ ./-]?[0-9]{1,14}|[ ./-][0-9]{1,14}){0,8})(?![0-9])")


def _phones_abroad(text: str, key: bytes, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """The last groups of a longer digit run come off until the number is valid and free."""
    for m in _ABROAD.finditer(text):
        start, found = m.start(1), m[1]
        new = _phone_abroad(found, key)
        while (new is None or any(start + len(found) > s and start < e for s, e in taken)) and (
                cut := max(found.rfind(c) for c in " ./-(")) > 0:
            found = found[:cut]
            new = _phone_abroad(found, key)
        if new is not None:
            yield start, start + len(found), new


#: Kind, what must stand in a text for the finder to be tried, and finder: it gives
#: (start, end, new), knowing what is taken. Earlier kinds win where finds overlap.
_FINDERS: tuple[tuple[str, str, Callable[[str, bytes, list], Iterator[tuple[int, int, str]]]], ...] = (
    ("email", "@", _by(re.compile(r"(?<![\w.+%-])([\w.+%-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})"), _email)),
    ("secret", "", _secrets),
    ("iban", "", _ibans),
    ("phone", "+1", _by(re.compile(r"(\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4})(?![0-9])"), _phone_1)),
    ("phone", "", _by(re.compile(r"(?<![0-9])(?<![0-9][ .-])(\([0-9]{3}\) ?[0-9]{3}[.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])"),
     lambda s, k: (r := _phone("1" + s, k)) and r[1:])),
    ("card", "", _cards),
    ("phone", "+", _phones_abroad),
    ("ssn", "-", _by(re.compile(r"(?<![0-9-])([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])"), _ssn)),
    ("ip", "", _by(re.compile(r"(?<![0-9.])([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]|\.[0-9])"), _ip)),
    ("date", "", _by(re.compile(r"(?<![0-9/.-])([0-9]{4}([-/.])[0-9]{1,2}\2[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\3[0-9]{4})(?![0-9]|[/.-][0-9])"), _date)),
)
_DIGIT = re.compile(r"[0-9]")
_HINT = re.compile(r"token|key|secret|passw|bearer", re.I)


def pseudonymise(text: str | None, key: bytes) -> tuple[str | None, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each in the new text
    by code points. Text between finds is untouched."""
    if not text:
        return text, []
    has_digit, spots = _DIGIT.search(text) is not None, []
    taken: list[tuple[int, int]] = []
    for kind, sign, find in _FINDERS:
        if (sign and sign not in text or kind not in ("email", "secret") and not has_digit
                or kind == "secret" and not _HINT.search(text)):
            continue
        for start, end, new in find(text, key, taken):
            if all(end <= s or start >= e for s, e in taken):
                taken.append((start, end))
                spots.append((start, end, kind, new))
    out, spans, at, shift = [], [], 0, 0
    for start, end, kind, new in sorted(spots):
        out += [text[at:start], new]
        spans.append((start + shift, start + shift + len(new), kind))
        shift, at = shift + len(new) - (end - start), end
    return ("".join(out) + text[at:] if spans else text), spans


def with_pseudonyms(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` pseudonymised and ``pii``, an array of (start, end,
    kind) in the new text. One pass, no shuffle; other columns pass through.

    Defined cases: a null text stays null and an empty one empty, both with an
    empty array; rows are treated one by one, so repeated rows come out equal;
    an input column named ``pii`` is replaced. ``key`` has 16 to 64 bytes.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("the key must have 16 to 64 bytes")

    @F.pandas_udf("text string, pii array<struct<start: int, end: int, kind: string>>")
    def change(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            pairs = [pseudonymise(t, key) for t in texts]
            yield pd.DataFrame({"text": [p[0] for p in pairs],
                                "pii": [[{"start": a, "end": b, "kind": k} for a, b, k in p[1]] for p in pairs]})

    rows = docs.select(packed(docs), change(F.col(f"`{text}`")).alias("new"))
    out = [F.col("new.text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c)
           for c in docs.columns if c != "pii"]
    return rows.select(*out, F.col("new.pii").alias("pii"))
