"""Format-preserving pseudonyms of personal data and secrets.

Matches are validated (check digits, ranges, the calendar) and then permuted
by a keyed Feistel network inside their own format: a card stays a card with a
right check digit, a date a date in the same notation, an address keeps its
shape. The permutation works on the value, not its notation, so a value has
the same pseudonym in every document, however it is grouped or capitalised,
and two values never share one. What a network makes invalid is permuted again
until it is valid, which keeps the map one to one.

The kinds, tried in this order where they start at one place: e-mail, IBAN (mod
97), US social security number, date, IPv4, phone, card (Luhn), access key, and
the value behind password, secret or token. A stretch that fails its kind's
check is tried shorter, then as the other kinds, so values that stand side by
side are told apart. A card that is not grouped as cards are (in fours, 4-6-5,
4-6-4 or not at all) gives way to a shorter one that is, and to a value that
starts behind one of its blanks. What looks like a card, IBAN or date
but fails its check is left alone, and so is a number with an SSN's hyphens in
a range that is never assigned. Phones and addresses have no check: those
outside the assigned ranges are permuted too, among themselves.

A secret's value is as long as its letters, digits and + / _ - run, with the
runs that single dots join to it, if one of the runs has eight characters.

Not treated: the time of day behind a date; a secret's value behind any other
character, and one without a run of eight; dates in words, without four digits
for the year, or outside 1900 to 2099; e-mail addresses with two dots in a row.

Defined results: a null text stays null, an empty one empty, both with no
finding. Repeated rows are treated each on its own; a null doc_id stays null.
An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1), datetime.date(2099, 12, 31)

# Anything that could hold a match has one of these; the rest isn't scanned.
HINT = re.compile(rb"[0-9@]|(?i:password|passwd|secret|token|api_?key)|AKIA")
# The time of day behind a date: T10:30, T103000, T10Z.
TIME = r"[Tt][0-2][0-9](?::?[0-5][0-9]|[Zz]|(?!\w))"
# Runs of a secret's characters joined by dots, one of them of eight or more.
SECRET = r"(?=(?:[A-Za-z0-9+/_-]+\.)*[A-Za-z0-9+/_-]{8})[A-Za-z0-9+/_-]+(?:\.[A-Za-z0-9+/_-]+)*"
# A kind's body, and what must (not) follow it.
PATTERNS = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}", r""),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,4})?)", r"(?![A-Za-z0-9])"),
    "ssn": (r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}", r"(?![\w-])"),
    "date": (r"(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})", rf"(?:(?![\w/-])|(?={TIME}))"),
    "ip": (r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}", r"(?![\w]|\.[0-9])"),
    "phone": (r"(?<![\w+])(?:(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|\+[0-9]{2,3}(?:[ .-]?[0-9]{2,4}){2,5})", r"(?![\w-])"),
    "card": (r"(?<![\w.-])[0-9](?:[ -]?[0-9]){12,18}", r"(?![\w-])"),
    "key": (r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}", r"(?![A-Za-z0-9])"),
    "secret": (r"(?i:password|passwd|secret|token|api_?key)[ ]{0,3}[=:][ ]{0,3}[\"']?" + SECRET, r""),
}
FINDER = re.compile("|".join(f"(?P<{kind}>{body}{after})" for kind, (body, after) in PATTERNS.items()), re.ASCII)
WHOLE = {kind: re.compile(body + after, re.ASCII) for kind, (body, after) in PATTERNS.items()}
BODY = {kind: re.compile(body, re.ASCII) for kind, (body, _) in PATTERNS.items()}
# A shorter address ends where a label does.
AFTER = {kind: re.compile(after or r"(?![A-Za-z0-9])", re.ASCII) for kind, (_, after) in PATTERNS.items()}
HEX = re.compile(r"[0-9a-f]+\Z")
SECRET_NAME = re.compile(r"[a-z_]+[ ]{0,3}[=:][ ]{0,3}[\"']?", re.IGNORECASE | re.ASCII)


class Permutation:
    """Keyed bijections of mixed-radix strings, a network for every kind."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _stream(self, tweak: bytes, step: int, other: list[int], n: int) -> list[int]:
        seeds = [hashlib.blake2b(tweak + struct.pack(f">B{len(other)}Q", step, *other), key=self.key, digest_size=64).digest()]
        while 64 * len(seeds) < 8 * n:
            seeds.append(hashlib.blake2b(seeds[-1], key=self.key, digest_size=64).digest())
        return list(struct.unpack(f">{n}Q", b"".join(seeds)[: 8 * n]))

    def __call__(self, symbols: list[int], radices: list[int], tweak: str) -> list[int]:
        half = (len(symbols) + 1) // 2
        parts, bases = [symbols[:half], symbols[half:]], [radices[:half], radices[half:]]
        label = f"{tweak}:{len(symbols)}:".encode()
        for step in range(ROUNDS):
            side = step % 2
            shift = self._stream(label, step, parts[1 - side], len(parts[side]))
            parts[side] = [(a + s) % r for a, s, r in zip(parts[side], shift, bases[side])]
        return parts[0] + parts[1]

    def in_class(self, symbols: list[int], radices: list[int], tweak: str, valid: Callable[[list[int]], bool]) -> list[int]:
        """Valid strings among themselves, and the others among themselves."""
        inside = valid(symbols)
        return self.within(symbols, radices, tweak, lambda s: valid(s) == inside)

    def within(self, symbols: list[int], radices: list[int], tweak: str, valid: Callable[[list[int]], bool]) -> list[int]:
        """Walk the cycle to the next valid string; the given one is valid."""
        symbols = self(symbols, radices, tweak)
        while not valid(symbols):
            symbols = self(symbols, radices, tweak)
        return symbols


def digits_of(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def refill(text: str, digits: list[int]) -> str:
    """The text with its digits replaced in order."""
    rest = iter(digits)
    return "".join(str(next(rest)) if c.isdigit() else c for c in text)


def luhn_check(payload: list[int]) -> int:
    total = sum(sum(divmod(d * (2 - i % 2), 10)) for i, d in enumerate(reversed(payload)))
    return -total % 10


def iban_check(country: str, account: str) -> int:
    number = "".join(str(int(c, 36)) for c in account + country)
    return 98 - int(number + "00") % 97


def alphanumeric(permute: Permutation, text: str, tweak: str, fold: bool) -> str:
    """Letters for letters and digits for digits; the rest stays.

    fold: the pseudonym depends on the letters only, and keeps their cases.
    """
    places = [i for i, c in enumerate(text) if c.isalnum()]
    symbols = [int(text[i]) if text[i].isdigit() else ord(text[i].lower()) - 97 for i in places]
    radices = [10 if text[i].isdigit() else 26 for i in places]
    # which places hold letters is part of the format, so it picks the network
    shape = "".join("0" if c.isdigit() else ("a" if fold or c.islower() else "A") if c.isalpha() else c for c in text)
    out = list(text)
    for i, value in zip(places, permute(symbols, radices, f"{tweak}:{shape}")):
        out[i] = str(value) if text[i].isdigit() else chr(value + (65 if text[i].isupper() else 97))
    return "".join(out)


def email(permute: Permutation, text: str) -> str | None:
    address, _, last = text.rpartition(".")
    if not last.isalpha() or len(last) < 2 or ".." in text:
        return None
    return alphanumeric(permute, address, "email", fold=True) + "." + last


def iban(permute: Permutation, text: str) -> str | None:
    plain = text.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or int(check) != iban_check(country, account):
        return None
    account = alphanumeric(permute, account, "iban" + country, fold=False)
    rest = iter(f"{country}{iban_check(country, account):02d}{account}")
    return "".join(c if c == " " else next(rest) for c in text)


def card(permute: Permutation, text: str) -> str | None:
    digits = digits_of(text)
    if luhn_check(digits[:-1]) != digits[-1] or not any(digits):
        return None
    payload = [digits[0], *permute(digits[1:-1], [10] * (len(digits) - 2), f"card{digits[0]}")]
    return refill(text, [*payload, luhn_check(payload)])


def ssn(permute: Permutation, text: str) -> str | None:
    valid = lambda s: s[0] not in (0, 666) and s[0] < 900 and s[1] > 0 and s[2] > 0
    parts = [int(p) for p in text.split("-")]
    if not valid(parts):
        return None
    return "{:03d}-{:02d}-{:04d}".format(*permute.within(parts, [1000, 100, 10000], "ssn", valid))


def date(permute: Permutation, text: str) -> str | None:
    numbers = [int(n) for n in re.split(r"[./-]", text)]
    mark = "-" if "-" in text else "." if "." in text else "/"
    year, month, day = numbers if mark == "-" else (numbers[2], numbers[1], numbers[0]) if mark == "." else (numbers[2], numbers[0], numbers[1])
    try:
        when = datetime.date(year, month, day)
    except ValueError:
        return None
    if not FIRST_DAY <= when <= LAST_DAY:
        return None
    days = (LAST_DAY - FIRST_DAY).days + 1
    index = (when - FIRST_DAY).days
    side = int(days**0.5) + 1
    high, low = permute.within([index // side, index % side], [side, side], "date", lambda s: s[0] * side + s[1] < days)
    new = FIRST_DAY + datetime.timedelta(high * side + low)
    if mark == "-":
        return f"{new.year:04d}-{new.month:02d}-{new.day:02d}"
    return f"{new.day:02d}.{new.month:02d}.{new.year:04d}" if mark == "." else f"{new.month:02d}/{new.day:02d}/{new.year:04d}"


def ip(permute: Permutation, text: str) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    return ".".join(map(str, permute.in_class(parts, [256] * 4, "ip", lambda s: 0 < s[0] < 224)))


def phone(permute: Permutation, text: str) -> str | None:
    digits = digits_of(text)
    if text.startswith("+") and not text.startswith("+1"):
        if not 8 <= len(digits) <= 15:
            return None
        return refill(text, digits[:2] + permute(digits[2:], [10] * (len(digits) - 2), f"phone{digits[0]}{digits[1]}"))
    lead, national = digits[:-10], digits[-10:]
    if len(lead) != text.startswith("+"):  # +1 and ten digits, or ten digits
        return None
    return refill(text, lead + permute.in_class(national, [10] * 10, "phone1", lambda s: s[0] >= 2 and s[3] >= 2))


def key(permute: Permutation, text: str) -> str:
    return "AKIA" + alphanumeric(permute, text[4:], "key", fold=False)


def secret(permute: Permutation, text: str) -> str:
    name = SECRET_NAME.match(text).group()
    plain = text[len(name) :]
    if HEX.match(plain):
        new = "".join(f"{d:x}" for d in permute([int(c, 16) for c in plain], [16] * len(plain), "hex"))
    else:
        new = alphanumeric(permute, plain, "secret", fold=False)
    return name + new


RULES = {"email": email, "iban": iban, "card": card, "ssn": ssn, "date": date, "ip": ip, "phone": phone, "key": key, "secret": secret}


def stretches(kind: str, text: str, start: int) -> Iterator[int]:
    """The ends of what looks like the kind at a place, the longest first."""
    m = WHOLE[kind].match(text, start)
    if m is None:
        return
    yield m.end()
    for stop in range(m.end() - 1, start, -1):
        if AFTER[kind].match(text, stop) and BODY[kind].fullmatch(text, start, stop):
            yield stop


def grouped(text: str) -> bool:
    """Whether digits are grouped as on cards."""
    sizes = [len(g) for g in re.split("[ -]", text)]
    fours = sizes[-1] <= 4 and all(n == 4 for n in sizes[:-1])
    return len(sizes) == 1 or not (" " in text and "-" in text) and (fours or sizes in ([4, 6, 5], [4, 6, 4]))


def value_at(permute: Permutation, text: str, start: int, loose: bool = True) -> tuple[str, int, str] | None:
    """Kind, end and pseudonym of the value that starts at a place, if one does.

    loose: also cards that are not grouped as cards are.
    """
    for kind in PATTERNS:
        odd = []
        for stop in stretches(kind, text, start):
            new = RULES[kind](permute, text[start:stop])
            if new is not None and (kind != "card" or grouped(text[start:stop])):
                return kind, stop, new
            if new is not None:
                odd.append((stop, new))
        for stop, new in odd if loose else ():
            if not any(value_at(permute, text, at, False) for at in range(start + 1, stop) if text[at - 1] == " "):
                return kind, stop, new
    return None


def pseudonymise(permute: Permutation, text: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its findings replaced, and their (kind, start, stop) in the old one."""
    out, found, done, at = [], [], 0, 0
    while (m := FINDER.search(text, at)) is not None:
        value = value_at(permute, text, m.start())
        if value is None:  # nothing valid starts here: go on at the next character
            at = m.start() + 1
            continue
        kind, stop, new = value
        out += [text[done : m.start()], new]
        found.append((kind, m.start(), stop))
        done = at = stop
    return ("".join(out) + text[done:] if found else text), found


def pseudonymise_documents(docs: DataFrame, secret_key: str) -> DataFrame:
    """One row per row: doc_id, text (pseudonymised), n_found, spans.

    ``spans`` has kind, start and stop (characters of the old text).
    """
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

    def treat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Permutation(secret_key.encode())
        for batch in batches:
            texts, spans = [], []
            for value in batch.column(1):
                raw = value.as_buffer()
                if raw is None or HINT.search(raw) is None:
                    texts.append(None if raw is None else raw.to_pybytes())
                    spans.append([])
                    continue
                text, found = pseudonymise(permute, raw.to_pybytes().decode("utf-8", "surrogateescape"))
                texts.append(text.encode("utf-8", "surrogateescape"))
                spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in found])
            counts = pa.array(np.array([len(s) for s in spans], np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary()), counts, pa.array(spans, span_type)], names=["doc_id", "text", "n_found", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    treated = rows.mapInArrow(treat, "doc_id long, text binary, n_found int, spans array<struct<kind:string,start:int,stop:int>>")
    return treated.withColumn("text", F.col("text").cast("string"))
