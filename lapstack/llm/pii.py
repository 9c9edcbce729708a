"""Format-preserving pseudonyms: found values are permuted within their own format by a keyed Feistel network.

A value is recognised by its pattern and, where its kind has one, by its check (Luhn, mod 97, calendar, octets). It is
mapped to a number within the domain of its format, permuted there by a Feistel network that is walked until it lands
in the domain again, and written back in the same format with valid check digits. The permutation depends on key, kind
and format alone: equal values get equal pseudonyms in every document, different values different ones, and the owner
of the key can undo it.

A secret is an AWS key id, or what follows ``password``, ``passwd``, ``token``, ``secret`` or ``api_key`` with ``=`` or
``:``: eight or more letters and digits, however many. Where a letter is among them, ``_ - . ~ + /`` between them
belong to the secret and stay in place; so do ``_`` and ``-`` before the first. Other secrets are not recognised.

The longest match of a pattern is tried first. Where its check fails, an IBAN is tried at the fixed length of its
country and a phone number with fewer groups; else the search goes on one token after the start. A value found inside a
span that failed the check of another one cannot be told from it by ``undo`` if its pseudonym makes that span valid
(one in ten for a card after four further digits); everywhere else ``undo`` is exact.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.llm.common import bounded_batches, free_name, text_of

KINDS = ("email", "iban", "ipv4", "date", "phone", "ssn", "card", "secret")
_ROUNDS = 8
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_PATTERN = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,63}(?![A-Za-z]))"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)(?![A-Za-z0-9]))"
    rf"|(?P<ipv4>(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?[0-9]))"
    r"|(?P<date>(?<![0-9])(?:[0-9]{4}([-/.])[0-9]{2}\5[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\6[0-9]{4})(?![0-9]))"
    r"|(?P<phone>\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
    r"|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9]))"
    r"|(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))"
    r"|(?P<card>(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\10[0-9]{4}\10[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\11[0-9]{5})(?![0-9]))"
    r"|(?P<secret>(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![0-9A-Za-z])"
    r"|(?i:password|passwd|token|secret|api_?key)[ ]?[=:][ ]?[\"']?"
    # letters and digits with separators, but no address and no number, which have kinds of their own
    r"(?:(?=[0-9_.~+/-]*[A-Za-z])(?=[_-]*(?:[0-9A-Za-z][_.~+/-]*){8})[_-]*+[0-9A-Za-z]++(?:[_.~+/-]++[0-9A-Za-z]++)*+(?!@)"
    r"|[0-9A-Za-z]{8,}+))"
)
_HINT = re.compile(r"[0-9@]|(?i:passw|token|secret|api)")
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PHONE = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .-]?[0-9]{2,4}){1,4}")
_FIRST_TOKEN = re.compile(r"[^A-Za-z0-9]*[A-Za-z0-9]+")
# The length of an IBAN by country.
_IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to the end of 2099


def permute(value: int, size: int, key: bytes, tweak: str, undo: bool = False) -> int:
    """A keyed permutation of 0 to ``size`` - 1: Feistel rounds over the next even number of bits, cycle-walked."""
    if size < 2:
        return value
    half = ((size - 1).bit_length() + 1) // 2
    mask = (1 << half) - 1
    width = (half + 7) // 8
    name = tweak.encode()

    def mix(r: int, x: int) -> int:
        data = bytes([r]) + x.to_bytes(width, "big") + name
        return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=min(64, width)).digest(), "big") & mask

    rounds = range(_ROUNDS - 1, -1, -1) if undo else range(_ROUNDS)
    while True:
        left, right = value >> half, value & mask
        for r in rounds:
            if undo:
                left, right = right ^ mix(r, left), left
            else:
                left, right = right, left ^ mix(r, right)
        value = (left << half) | right
        if value < size:
            return value


def _walk(value: int, size: int, key: bytes, tweak: str, undo: bool, fits: Callable[[int], bool]) -> int:
    while True:
        value = permute(value, size, key, tweak, undo)
        if fits(value):
            return value


def _chars(text: str, key: bytes, kind: str, undo: bool, fits: Callable[[str], bool] = lambda s: True) -> str:
    """Permute letters and digits each within its class (digits, lower, upper); every other character stays."""
    classes = [_DIGITS if c in _DIGITS else _LOWER if c in _LOWER else _UPPER if c in _UPPER else "" for c in text]
    shape = "".join(c[0] if c else "-" for c in classes)
    size = value = 1
    value = 0
    for c, alphabet in zip(text, classes):
        if alphabet:
            value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)

    def written(v: int) -> str:
        out = []
        for c, alphabet in zip(reversed(text), reversed(classes)):
            if alphabet:
                v, at = divmod(v, len(alphabet))
                c = alphabet[at]
            out.append(c)
        return "".join(reversed(out))

    return written(_walk(value, size, key, f"{kind}:{shape}", undo, lambda v: fits(written(v))))


def luhn_digit(digits: str) -> str:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _like(template: str, digits: str) -> str:
    """The digits in the places of the template's digits."""
    it = iter(digits)
    return "".join(next(it) if c in _DIGITS else c for c in template)


def _only_digits(s: str) -> str:
    return "".join(c for c in s if c in _DIGITS)


def _card(s: str, key: bytes, undo: bool) -> str | None:
    d = _only_digits(s)
    if luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    # the first digit names the network and stays
    body = d[0] + _chars(d[1:-1], key, "card", undo, lambda x: len(set(d[0] + x)) > 1)
    return _like(s, body + luhn_digit(body))


def _iban_check(country: str, rest: str) -> str:
    number = "".join(str(int(c, 36)) for c in rest + country + "00")
    return f"{98 - int(number) % 97:02d}"


def _iban(s: str, key: bytes, undo: bool) -> str | None:
    flat = s.replace(" ", "")
    country, rest = flat[:2], flat[4:]
    fixed = _IBAN_LENGTHS.get(country)
    if not 15 <= len(flat) <= 34 or len(flat) != (fixed or len(flat)) or _iban_check(country, rest) != flat[2:4]:
        return None
    rest = _chars(rest, key, "iban" + country, undo)
    it = iter(country + _iban_check(country, rest) + rest)
    return "".join(c if c == " " else next(it) for c in s)


def _ipv4(s: str, key: bytes, undo: bool) -> str:
    a, b, c, d = map(int, s.split("."))
    v = permute(a << 24 | b << 16 | c << 8 | d, 1 << 32, key, "ipv4", undo)
    return ".".join(str(v >> k & 255) for k in (24, 16, 8, 0))


def _day(order: str, s: str) -> int | None:
    parts = dict(zip(order, re.split(r"[-/.]", s)))
    try:
        day = datetime.date(int(parts["y"]), int(parts["m"]), int(parts["d"])).toordinal() - _FIRST_DAY
    except ValueError:
        return None
    return day if 0 <= day < _DAYS else None


def _date_written(order: str, sep: str, day: int) -> str:
    date = datetime.date.fromordinal(day + _FIRST_DAY)
    return sep.join({"y": f"{date.year:04d}", "m": f"{date.month:02d}", "d": f"{date.day:02d}"}[c] for c in order)


def _date(s: str, key: bytes, undo: bool) -> str | None:
    # day first where that is a date, else month first
    for order in ("ymd",) if s[:4].isdigit() else ("dmy", "mdy"):
        day = _day(order, s)
        if day is None:
            continue
        sep = s[4] if order == "ymd" else s[2]

        def fits(v: int) -> bool:
            return order != "mdy" or _day("dmy", _date_written(order, sep, v)) is None

        return _date_written(order, sep, _walk(day, _DAYS, key, "date" + order, undo, fits))
    return None


def _phone(s: str, key: bytes, undo: bool) -> str | None:
    digits = _only_digits(s)
    if not 8 <= len(digits) <= 15:
        return None
    # the country code stays: 1, or the digits up to the first separator
    keep = 0
    if s.startswith("+"):
        keep = 2 if s.startswith("+1") else re.match(r"\+[0-9]*", s).end()
    if not any(c in _DIGITS for c in s[keep:]):
        keep = 1
    rest = s[keep:]
    first = next(c for c in rest if c in _DIGITS)

    def fits(x: str) -> bool:  # an area code does not start with 0 or 1 unless it did
        return first in "01" or next(c for c in x if c in _DIGITS) not in "01"

    return s[:keep] + _chars(rest, key, "phone" + s[:keep], undo, fits if first not in "01" else lambda x: next(c for c in x if c in _DIGITS) in "01")


def _is_ssn(s: str) -> bool:
    area, group, serial = s.split("-")
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


def _ssn(s: str, key: bytes, undo: bool) -> str | None:
    return _chars(s, key, "ssn", undo, _is_ssn) if _is_ssn(s) else None


def _email(s: str, key: bytes, undo: bool) -> str:
    name, _, host = s.partition("@")
    return _chars(name, key, "email@" + host.lower(), undo) + "@" + host


_HEX = re.compile(r"[0-9a-f]+\Z")
_SECRET_NAME = re.compile(r"AKIA(?=[0-9A-Z]{16}\Z)|[A-Za-z_]+ ?[=:] ?[\"']?[_-]*")
_LONG, _PIECE = 128, 64  # a secret over the one is permuted in pieces of the other


def _base36(value: int, size: int) -> str:
    out = ""
    for _ in range(size):
        value, d = divmod(value, 36)
        out = (_DIGITS + _UPPER)[d] + out
    return out


def _long_secret(value: str, key: bytes, undo: bool) -> str:
    """The value in pieces, each permuted for its place and the whole length: numbers of any length take squared time."""
    out, is_hex = [], _HEX.match(value) and not value.isdigit()
    for at in range(0, len(value), _PIECE):
        piece, kind = value[at : at + _PIECE], f"secret{at}/{len(value)}"
        if is_hex:
            n = len(piece)
            out.append(f"{permute(int(piece, 16), 16**n, key, f'hex{kind}:{n}', undo):0{n}x}")
        else:
            out.append(_chars(piece, key, kind, undo))
    return "".join(out)


def _secret(s: str, key: bytes, undo: bool) -> str:
    at = _SECRET_NAME.match(s).end()
    value = s[at:]
    if len(value) > _LONG:
        return s[:at] + _long_secret(value, key, undo)
    # digits alone stay so, and only they: what belongs to a secret depends on whether it has a letter
    if value.isdigit():
        return s[:at] + _chars(value, key, "secret", undo)
    if _HEX.match(value):
        n = len(value)
        new = _walk(int(value, 16), 16**n, key, f"hex{n}", undo, lambda v: not f"{v:0{n}x}".isdigit())
        return s[:at] + f"{new:0{n}x}"
    if all(c in _DIGITS or c in _UPPER for c in value):
        n = len(value)
        new = _walk(int(value, 36), 36**n, key, f"base36:{n}", undo, lambda v: not _base36(v, n).isdigit())
        return s[:at] + _base36(new, n)
    return s[:at] + _chars(value, key, "secret", undo, lambda x: not _HEX.match(x))


_MAKERS = {
    "email": _email, "iban": _iban, "ipv4": _ipv4, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card, "secret": _secret,
}


def _shorter(kind: str, s: str) -> Iterator[str]:
    """The shorter candidates of a match whose check failed, longest first; which ones there are depends on format alone."""
    if kind == "iban":
        size = _IBAN_LENGTHS.get(s[:2], 0)
        for at, c in enumerate(s):
            if c == " " and at - s.count(" ", 0, at) == size:
                yield s[:at]
    elif kind == "phone":
        for at in range(len(s) - 1, 0, -1):
            if s[at] in " .-" and _PHONE.fullmatch(s, 0, at):
                yield s[:at]


def pseudonyms(text: str, key: bytes, undo: bool = False) -> tuple[str, dict[str, int]]:
    """The text with every validated value replaced, and how many of each kind; ``undo`` restores the values."""
    counts = dict.fromkeys(KINDS, 0)
    if not _HINT.search(text):
        return text, counts

    out, done, at = [], 0, 0
    while m := _PATTERN.search(text, at):
        kind, start = next(k for k in KINDS if m.group(k) is not None), m.start()
        found = m.group()
        new = _MAKERS[kind](found, key, undo)
        if new is None:
            for found in _shorter(kind, m.group()):
                new = _MAKERS[kind](found, key, undo)
                if new is not None:
                    break
        if new is None:
            at = _FIRST_TOKEN.match(text, start).end()
            continue
        counts[kind] += 1
        at = start + len(found)
        out += text[done:start], new
        done = at
    return "".join([*out, text[done:]]), counts


def pseudonym_column(column: Column, key: bytes) -> Column:
    @F.pandas_udf("struct<text string, " + ", ".join(f"{k} int" for k in KINDS) + ">")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            done = [pseudonyms(t, key) for t in batch]
            yield pd.DataFrame([(t, *c.values()) for t, c in done], columns=["text", *KINDS])

    return run(column)


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """The documents with ``text`` pseudonymised and ``found``, a struct with the number of values of each kind.

    ``key`` has 16 to 64 bytes. Texts without any value stay as they are, NULL stays NULL and counts none; values that
    fail their check (a number that is no card, the 31st of June, an address with over 64 characters before its @, which
    mail does not allow) are left alone. Whole texts are read. Other columns
    are kept, but for one named ``found``, which is replaced; ``n_chars`` stays right, as a pseudonym of an address
    may only differ in length for IPv4 and is then counted anew.
    """
    if not 16 <= len(key) <= 64:
        raise ValueError("a key of 16 to 64 bytes is asked for")
    bounded_batches(docs.sparkSession)
    name = free_name(docs.columns, "done")
    done = docs.drop("found").withColumn(name, pseudonym_column(text_of(), key))
    out = done.withColumn("found", F.struct(*[F.col(name)[k].alias(k) for k in KINDS]))
    # the text itself is compared with what it was only where something was found
    changed = F.when(F.col("text").isNotNull(), F.col(name)["text"])
    columns = [changed.alias(c) if c == "text" else F.col(c) for c in docs.columns if c != "found"]
    out = out.select(*columns, "found")
    if "n_chars" in docs.columns:
        counted = F.when(F.col("found.ipv4") > 0, F.length("text").cast(dict(docs.dtypes)["n_chars"]))
        out = out.withColumn("n_chars", F.coalesce(counted, F.col("n_chars")))
    return out
