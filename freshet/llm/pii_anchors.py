"""Personal data by anchor expansion.

One Aho-Corasick automaton finds anchors in a text: at-signs, scheme marks,
plus signs and digits that may begin a number, digit-and-dot pairs, and cue
words of accounts. A local parser at each anchor expands it to the left and
right, and validates what it finds. No pattern is searched over a whole text.

Base kinds, leftmost and without overlaps within a kind: ``email``, ``ip``,
``card``, ``phone``. A match that fails its check is dropped and its
characters stay consumed. Kinds the anchors add: ``url`` (scheme://host...)
and ``account`` (a number after a cue word such as "account" or "IBAN", in
upper or lower case). An IBAN ends at its country's length, other numbers
before a word that follows.

Defined results: a null text counts as empty, with zero counts and empty
``spans``. Offsets are code points, ends exclusive. Repeated rows stay
repeated; rows keep a null id.
"""

from __future__ import annotations

import re
from itertools import accumulate

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from freshet.llm.common import map_rows, sha256_hex

# The kinds in their order, base kinds first.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "url", "account")
# Words that announce an account or identity number.
CUES = ("account", "acct", "iban", "passport", "ssn", "social security", "tax id", "customer id", "member id")
# Lengths of IBANs by country.
IBAN_LENGTHS = {
    x[:2]: int(x[2:])
    for x in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 "
        "GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 "
        "MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 "
        "TN24 TR26 UA29 VA22 VG24 XK20"
    ).split()
}

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DIGITS = frozenset("0123456789")
_SCHEME = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HOST = re.compile(r"[^\s<>\"'\\^`{|}/]+\.[^\s<>\"'\\^`{|}]*[^\s<>\"'\\^`{|}.,;:!?)\]]")
_NUMBER = re.compile(
    r"(?:[\x20]?(?:number|no\.?|nr\.?|id|#|(?!NO[0-9])(?i:number|no|nr|id)(?![A-Za-z])\.?))?[\x20]?[:=#]?[\x20]?"
    r"([A-Z0-9](?:[\x20-]?[A-Z0-9]){5,33})(?![A-Za-z0-9])"
)
_GROUP = re.compile(r"[\x20-]?[A-Z0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def valid_iban(number: str) -> bool:
    turned = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def number_size(number: str) -> int:
    """Length of the account number that begins ``number``, zero if there is none."""
    groups = _GROUP.findall(number)
    ends = list(accumulate(map(len, groups)))
    plain = [number[:e].replace(" ", "").replace("-", "") for e in ends]
    shaped = plain[-1][:2].isalpha() and plain[-1][2:4].isdigit()
    if shaped:
        length = IBAN_LENGTHS.get(plain[-1][:2])
        for end, x in zip(reversed(ends), reversed(plain), strict=True):
            if (len(x) == length if length else len(x) >= 15) and valid_iban(x):
                return end
    # Words after the number don't belong to it; nor do more groups than a number can have.
    for at in range(1, len(groups)):
        if sum(c in _DIGITS for c in plain[at - 1]) >= 6 and re.fullmatch(r" [A-Z]{2,}", groups[at]):
            ends, plain = ends[:at], plain[:at]
            break
    if shaped and len(plain[-1]) >= 15:
        return 0
    return next((e for e, x in zip(reversed(ends), reversed(plain), strict=True) if len(x) <= 20 and sum(c in _DIGITS for c in x) >= 6), 0)


def lowered(text: str) -> str:
    """In lower case, every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c.isascii() else c for c in text)


def automaton() -> ahocorasick.Automaton:
    """Anchors with their kind and length, for a text in lower case."""
    found = ahocorasick.Automaton()
    found.add_word("@", ("email", 1))
    found.add_word("://", ("url", 3))
    for a in "0123456789":
        found.add_word("+" + a, ("phone", 2))
        found.add_word(a + ".", ("ip", 2))
        for b in "0123456789":
            for gap in ("", " ", "-"):
                found.add_word(a + gap + b, ("card", 2 + len(gap)))
    for cue in CUES:
        found.add_word(cue, ("account", len(cue)))
    found.make_automaton()
    return found


def _left(text: str, at: int, floor: int, chars: frozenset[str]) -> int:
    while at > floor and text[at - 1] in chars:
        at -= 1
    return at


def spans(text: str, anchors: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """All valid (start, end, kind) of a text, by start, then kind as listed."""
    done = dict.fromkeys(KINDS, 0)
    found = []
    for last, (kind, size) in anchors.iter(lowered(text)):
        first = last + 1 - size
        floor = done[kind]
        if first < floor:
            continue
        if kind == "card":
            if m := _CARD.match(text, first):
                done[kind] = m.end()
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((first, m.end(), kind))
        elif kind == "email":
            start = _left(text, first, floor, _LOCAL)
            if start < first and (m := _DOMAIN.match(text, last + 1)):
                done[kind] = m.end()
                found.append((start, m.end(), kind))
        elif kind == "ip":
            start = _left(text, first, floor, _DIGITS)
            if m := _IP.match(text, start):
                done[kind] = m.end()
                if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                    found.append((start, m.end(), kind))
        elif kind == "phone":
            if m := _PHONE.match(text, first):
                done[kind] = m.end()
                if 10 <= sum(c in _DIGITS for c in m.group()) <= 15:
                    found.append((first, m.end(), kind))
        elif kind == "url":
            start = _left(text, first, floor, _SCHEME)
            while start < first and not text[start].isalpha():
                start += 1
            if start < first and (m := _HOST.match(text, last + 1)):
                done[kind] = m.end()
                found.append((start, m.end(), kind))
        elif (not first or not text[first - 1].isalnum()) and (m := _NUMBER.match(text, last + 1)):
            if size := number_size(m.group(1)):
                done[kind] = m.start(1) + size
                found.append((m.start(1), m.start(1) + size, kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(found: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_<kind> of every kind, base_sha256, spans."""
    schema = StructType(
        [
            StructField(id_col, docs.schema[id_col].dataType),
            *[StructField(f"n_{k}", LongType()) for k in KINDS],
            StructField("base_sha256", StringType()),
            StructField("spans", StringType()),
        ]
    )

    def start():
        anchors = automaton()

        def work(ids, texts):
            every = [spans(t, anchors) if t else [] for t in texts]
            kinds = [[s[2] for s in x] for x in every]
            return {
                id_col: ids,
                **{f"n_{k}": [x.count(k) for x in kinds] for k in KINDS},
                "base_sha256": [sha256_hex(joined([s for s in x if s[2] in BASE_KINDS])) for x in every],
                "spans": [joined(x) for x in every],
            }

        return work

    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, start)


def mask(text: str, found: list[tuple[int, int, str]]) -> str:
    """The text with each span as <KIND>; of spans that overlap, the first goes on to the end of the last."""
    parts, last = [], 0
    for start, end, kind in found:
        if start >= last:
            parts += [text[last:start], f"<{kind.upper()}>"]
        last = max(last, end)
    return "".join([*parts, text[last:]])


def mask_pii(
    docs: DataFrame, text_col: str = "text", kinds: tuple[str, ...] = ("email", "ip", "card", "phone", "account")
) -> DataFrame:
    """``docs`` with the spans of ``kinds`` masked in the text; every row and column stays, null texts stay null."""
    at = docs.columns.index(text_col)
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])

    def start():
        anchors = automaton()

        def work(*columns):
            columns = list(columns)
            columns[at] = [mask(t, [s for s in spans(t, anchors) if s[2] in kinds]) if t else t for t in columns[at]]
            return {f.name: c for f, c in zip(inner, columns, strict=True)}

        return work

    return map_rows(docs.toDF(*inner.fieldNames()), inner, start).toDF(*docs.columns)
