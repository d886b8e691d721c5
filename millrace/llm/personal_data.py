"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their score.

Base kinds (e-mail, IP, card, phone) follow fixed patterns and always stay; their score only says
how sure they are. Further kinds are proposed by patterns of their own and kept from a least score.
All patterns are linear in the text: none can start twice within one run of characters.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import carried, map_batches
from millrace.llm.words import slices

# The base patterns and the order in which kinds are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "pan", "ssn", "tel")
BASE = KINDS[:4]
# A run of name characters is entered only at its start, or where the last match ended.
_EMAIL = r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL)
EMAIL_HERE = re.compile(_EMAIL)
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS = range(14, 20)
PHONE_DIGITS = range(10, 16)

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])")
_IBAN_REST = re.compile(r"\x20?([A-Z0-9])")
# Length of an account number by country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15,
    "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}
SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
TEL = re.compile(r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9-])")
_DIGITS = re.compile(r"[0-9]+")

# Where scores start, what a checksum adds, what words nearby add or take away, and what keeps a
# proposal.
START = {"email": 0.8, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.4, "pan": 0.2, "ssn": 0.3, "tel": 0.4}
CONFIRMED = {"card": 0.4, "iban": 0.5, "pan": 0.4}
NEAR_ADDS = 0.3
NEAR_TAKES = 0.3
LEAST_SCORE = 0.5
BEFORE, AFTER = 48, 24
_WORD = re.compile(r"[a-z]+")
NEAR = {
    "email": {"mail", "email", "contact", "write", "reach"},
    "ip": {"ip", "address", "host", "server", "client", "login"},
    "card": {"card", "visa", "mastercard", "amex", "credit", "debit", "payment", "pay"},
    "phone": {"phone", "tel", "telephone", "call", "mobile", "cell", "fax", "contact"},
    "iban": {"iban", "account", "bank", "transfer", "konto"},
    "ssn": {"ssn", "social", "security", "taxpayer"},
}
NEAR["pan"], NEAR["tel"] = NEAR["card"], NEAR["phone"]
AGAINST = {
    "ip": {"version", "release", "section", "chapter"},
    "pan": {"order", "invoice", "tracking", "isbn", "serial", "id"},
    "ssn": {"order", "invoice", "part", "isbn", "serial"},
    "tel": {"order", "invoice", "part", "isbn", "serial", "version"},
}


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled; the digit sum is a multiple of ten."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def mod_97(account: str) -> bool:
    """The first four characters moved to the end, letters as 10 to 35: one more than a multiple of 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at = 0
    while True:
        m = EMAIL_HERE.match(text, at) if at else None
        m = m or EMAIL.search(text, at)
        if m is None:
            return
        yield m.span()
        at = m.end()


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base patterns, leftmost and not overlapping per kind."""
    return _proposed(text)[0]


def _proposed(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int]]]:
    """Base spans, and the digit chains that the card pattern matched and its rules dropped."""
    out: list[tuple[int, int, str]] = []
    chains = []
    if "@" in text:
        out += [(a, b, "email") for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(map(_octet, m[0].split("."))):
            out.append((*m.span(), "ip"))
    for m in CARD.finditer(text):
        if m.end() - m.start() < CARD_DIGITS[0] - 1:
            continue
        digits = _digits(m[0])
        if len(digits) in CARD_DIGITS and luhn(digits):
            out.append((*m.span(), "card"))
        else:
            chains.append(m.span())
    if "+" in text:
        for m in PHONE.finditer(text):
            if len(_digits(m[0])) in PHONE_DIGITS:
                out.append((*m.span(), "phone"))
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out, chains


def _accounts(text: str) -> Iterator[tuple[int, int, str]]:
    for m in IBAN.finditer(text):
        account, at = m[0], m.end()
        length = IBAN_LENGTH.get(account[:2], 0)
        while len(account) < length and (more := _IBAN_REST.match(text, at)):
            account, at = account + more[1], more.end()
        whole = at == len(text) or not (text[at].isascii() and text[at].isalnum())
        if length and len(account) == length and whole and mod_97(account):
            yield m.start(), at, "iban"


def _card_numbers(text: str, chains: list[tuple[int, int]]) -> Iterator[tuple[int, int, str]]:
    """Numbers of a card's shape among the digit groups of a dropped chain, left to right."""
    for start, end in chains:
        groups = [(m.start(), m.end()) for m in _DIGITS.finditer(text, start, end)]
        i = 0
        while i < len(groups):
            count, j, taken = 0, i, 0
            # A card is printed as one group of 13 to 19 digits or as groups of at most 6.
            while j < len(groups) and count < 20:
                width = groups[j][1] - groups[j][0]
                if width > 6 and j > i:
                    break
                count, j = count + width, j + 1
                number = text[groups[i][0] : groups[j - 1][1]]
                if 13 <= count <= 19 and number[0] in "3456" and luhn(_digits(number)):
                    taken = j
                if width > 6:
                    break
            if taken:
                yield groups[i][0], groups[taken - 1][1], "pan"
            i = taken or i + 1


def _further(text: str, chains: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    out = [*_accounts(text), *_card_numbers(text, chains)]
    for m in SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            out.append((*m.span(), "ssn"))
    out += [(*m.span(), "tel") for m in TEL.finditer(text)]
    return out


def score(text: str, start: int, end: int, kind: str) -> float:
    """How sure a proposed, confirmed span is, by the words around it; 0 to 1."""
    near = text[max(0, start - BEFORE) : start] + " " + text[end : end + AFTER]
    words = set(_WORD.findall(near.lower()))
    out = START[kind] + CONFIRMED.get(kind, 0)
    out += NEAR_ADDS * bool(words & NEAR[kind]) - NEAR_TAKES * bool(words & AGAINST.get(kind, set()))
    return round(min(max(out, 0.0), 1.0), 2)


def all_spans(text: str, least: float = LEAST_SCORE) -> list[tuple[int, int, str, float]]:
    """Base spans, and further ones of at least ``least`` that overlap no other span."""
    base, chains = _proposed(text)
    out = [(a, b, k, score(text, a, b, k)) for a, b, k in base]
    starts = [a for a, _, _ in base]
    reach = np.maximum.accumulate([b for _, b, _ in base]) if base else []
    at = 0
    for a, b, k in sorted(_further(text, chains), key=lambda s: (s[0], KINDS.index(s[2]))):
        before = bisect_left(starts, b)
        if a < at or (before and reach[before - 1] > a):
            continue
        sure = score(text, a, b, k)
        if sure >= least:
            out.append((a, b, k, sure))
            at = b
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


_ANY = re.compile("[0-9@]")


def find_personal(
    docs: DataFrame, carry: list[str], least: float = LEAST_SCORE, redact: bool = False
) -> DataFrame:
    """``carry`` columns and ``spans`` (with ``redact`` also ``redacted``) for every row.

    ``spans`` holds ``kind, first, end, score`` in code points, end exclusive, by start and then by
    kind; base spans of different kinds may overlap, as each kind is read on its own. ``redacted``
    is the text with each stretch of spans replaced by ``[KIND]`` of its first span, a null text
    as it is. Null and empty texts have no spans. Very long texts are read whole, in time linear
    in their length. Rows are judged one by one, so repeated rows get equal results and an empty
    table gives no rows; a carried column named like one of ours gives way to it.
    """
    own = ["spans", *(["redacted"] if redact else [])]
    names, held, picked = carried(docs, carry, *own)

    def work(batch):
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            spans, clean = [], []
            for text in texts.slice(a, b - a).to_pylist():
                found = all_spans(text, least) if text and _ANY.search(text) else []
                spans.append([{"kind": k, "first": s, "end": e, "score": p} for s, e, k, p in found])
                if redact:
                    clean.append(_redacted(text, found))
            yield {"_rows": slice(a, b), "spans": spans, "redacted": clean}

    ddl = "spans array<struct<kind:string,first:int,end:int,score:double>>"
    made = map_batches(docs.select(*picked), work, ddl + (", redacted string" if redact else ""), held)
    return made.select(*[F.col(h).alias(c) for h, c in zip(held, names, strict=True)], *own)


def _redacted(text: str | None, spans: list[tuple[int, int, str, float]]) -> str | None:
    out, at = [], 0
    for start, end, kind, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return text if not out else "".join(out) + text[at:]


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ","
    )
