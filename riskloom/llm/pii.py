"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Values are found by pattern and validated; a keyed Feistel network then permutes each within the set
of values of its kind and format, so equal values get equal pseudonyms in every document, different
values different ones, and whoever has the key and the spans can undo it.  Separators and letter case stay.

=========  =============================================================  ===============================
kind       validated by                                                   permuted
=========  =============================================================  ===============================
email      local part, ``@``, domain with a top-level name                 letters and digits but the last label
iban       mod-97 check                                                   account part; new check digits
ip         four numbers up to 255                                         all 32 bits
date       calendar, 1900 to 2099 (Y-M-D, D.M.Y, M/D/Y)                   the day
ssn        ddd-dd-dddd, assignable                                        among assignable ones
phone      ``+`` and 8 to 15 digits, or (ddd) ddd-dddd                    the last ten digits
card       13 to 19 digits of an issuer's range with a valid      all but the Luhn digit, which is new
           Luhn digit, unbroken or in the groups printed on cards
=========  =============================================================  ===============================

Other long numbers carry no check and stay as they are.  Finding takes three steps, each linear in the text:

1. Cards: in every run of digit groups joined alike (by blanks or by hyphens), each window of groups that is
   a valid card.  Nothing outside the window counts, so a card is seen whatever stands before it.
2. The other kinds, from left to right.  A find is tried at the lengths that its kind can have (IBAN by country, ``+1`` and
   ``+7`` phones at eleven digits; other phones take all groups up to 15 digits, but not those of a card when eight digits
   stand before it).  If none is valid, the search goes on behind its first token.
3. Cards that overlap no other find; of two that overlap, the earlier, so a later one counts only if it is free.  Two
   valid cards that share groups are truly ambiguous; that is the one case in which a card beside digits may differ.

One map over the documents, no shuffle.  Rounds: ten, each BLAKE2b with the key over kind, format, round
and the other half; sets that are no product of digit ranges are reached by cycle walking.

Undoing with the spans that ``pseudonymised`` returned is exact for every text (``restored``).  Without spans, values are
found anew in the changed text, where a pseudonym and the digits beside it may look like another value.

Defined results: the earliest of equal finds wins; very long texts are handled alone in their task; null text stays null; text without personal values stays as it is; repeated rows are
treated alike; an empty table gives no rows.  Other columns are passed through by ``pseudonymised``.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from riskloom.llm import arrowtext as T
from riskloom.llm.state import map_rows, prepare

ROUNDS = 10
KINDS = ("email", "iban", "ip", "date", "ssn", "phone", "card")
_FIND = re.compile(r"""
    (?<![A-Za-z0-9._%+-])(?P<email>[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}(?![A-Za-z0-9]))
  | (?<![A-Za-z0-9])(?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)
  | (?<![0-9.])(?P<ip>[0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]|\.[0-9])
  | (?<![0-9])(?P<date>[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])
  | (?<![0-9-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9-])
  | (?<![0-9A-Za-z])(?P<phone>\+[0-9](?:[ ().-]{0,2}[0-9]){7,14}|\([0-9]{3}\)[ ]?[0-9]{3}-[0-9]{4})(?![0-9])
""", re.X)
_RUN = re.compile(r"(?<![0-9A-Za-z+])(?<![0-9][.,])[0-9]++(?:[ -][0-9]++)*+")
#: Sizes of the groups in which cards are printed, and of unbroken numbers.
CARD_GROUPS = ((4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 1), (4, 4, 4, 4, 1), (4, 4, 4, 4, 2), (4, 4, 4, 4, 3),
               (13,), (14,), (15,), (16,), (17,), (18,), (19,))
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?")
_ADDRESS = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_TOKEN, _ENDS, _GROUP = re.compile(r"[A-Za-z0-9]+|.", re.S), re.compile(r"(?<=[A-Za-z0-9])(?![A-Za-z0-9])"), re.compile("[0-9]+")
#: Characters of an IBAN by country (ISO 13616 registry); other countries' are tried at every length.
_IBAN_CHARS = {k: n for n, ks in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for k in ks.split()}
_FIRST, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal() - datetime.date(1900, 1, 1).toordinal() + 1


def feistel(key: bytes, tweak: str, radices: list[int], values: list[int], undo: bool = False) -> list[int]:
    """Permute a vector of digits with the given radices."""
    half = (len(radices) + 1) // 2
    parts = [radices[:half], radices[half:]]
    size = [math.prod(p) for p in parts]

    def pack(vs, rs):
        n = 0
        for v, r in zip(vs, rs):
            n = n * r + v
        return n

    halves = [pack(values[:half], parts[0]), pack(values[half:], parts[1])]
    for r in reversed(range(ROUNDS)) if undo else range(ROUNDS):
        to, other = r % 2, halves[1 - r % 2]
        note = f"{tweak}|{radices}|{r}|{other}".encode()
        word = int.from_bytes(hashlib.blake2b(note, key=key, digest_size=64).digest(), "big")
        halves[to] = (halves[to] + (-word if undo else word)) % size[to]
    out = []
    for n, rs in zip(halves, parts):
        vs = []
        for r in reversed(rs):
            n, v = divmod(n, r)
            vs.append(v)
        out += reversed(vs)
    return out


def luhn_digit(digits: list[int]) -> int:
    """The check digit that belongs behind ``digits``."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def is_card(digits: list[int]) -> bool:
    """Thirteen to nineteen digits of an issuer's range (3 to 6, 2221 to 2720) with a valid Luhn digit."""
    if not 13 <= len(digits) <= 19:
        return False
    head = digits[0] * 1000 + digits[1] * 100 + digits[2] * 10 + digits[3]
    return (3 <= digits[0] <= 6 or 2221 <= head <= 2720) and luhn_digit(digits[:-1]) == digits[-1]


def find_cards(text: str) -> list[tuple[int, int]]:
    """Spans of all windows of digit groups that are cards, from left to right; they may overlap."""
    out = []
    for run in _RUN.finditer(text):
        if run.end() - run.start() < 13:
            continue
        places = [(a + run.start(), b + run.start()) for a, b in (m.span() for m in _GROUP.finditer(run.group()))]
        sizes = [b - a for a, b in places]
        # a group that goes on as letters or as a decimal ends before the run does
        after = text[run.end():run.end() + 2]
        last = len(places) - (after[:1].isascii() and after[:1].isalpha() or (after[:1] in ".," and after[1:].isdigit() and after[1:].isascii()))
        for i in range(last):
            for groups in CARD_GROUPS:
                k = i + len(groups)
                if sizes[i] == groups[0] and k <= last and tuple(sizes[i:k]) == groups:
                    joins = {text[b] for _, b in places[i:k - 1]}
                    if len(joins) < 2 and is_card([int(c) for a, b in places[i:k] for c in text[a:b]]):
                        out.append((places[i][0], places[k - 1][1]))
    return out


def _lengths(kind: str, value: str, after: str) -> list[int]:
    """Lengths at which the text found by the pattern named ``kind`` may be a value, the likeliest first."""
    if kind == "iban":
        ends = [m.start() for m in _ENDS.finditer(value + after) if m.start() <= len(value)]
        ends = [e for e in reversed(ends) if _IBAN.fullmatch(value, 0, e)]
        due = _IBAN_CHARS.get(value[:2])
        return sorted(ends, key=lambda e: e - value.count(" ", 0, e) != due)
    if kind == "phone" and value[:2] in ("+1", "+7"):  # eleven digits
        at = [m.start() for m in re.finditer("[0-9]", value)]
        if len(at) > 11 and not value[at[10] + 1].isalnum():
            return [at[10] + 1]
    return [len(value)]


def _place(value: str, plain: str) -> str:
    """``plain`` letters and digits at the places of those in ``value``; case as there."""
    left = iter(plain)
    return "".join((next(left).upper() if c.isupper() else next(left).lower()) if c.isascii() and c.isalnum() else c for c in value)


def _walk(step, valid, values):
    values = step(values)
    while not valid(values):
        values = step(values)
    return values


def _alnum(key, tweak, plain, undo):
    kinds = [(10, 48) if c.isdigit() else (26, 97) for c in plain]
    out = feistel(key, tweak, [r for r, _ in kinds], [ord(c) - b for c, (_, b) in zip(plain, kinds)], undo)
    return "".join(chr(v + b) for v, (_, b) in zip(out, kinds))


def _ssn_ok(d):
    area = d[0] * 100 + d[1] * 10 + d[2]
    return area not in (0, 666) and area < 900 and d[3:5] != [0, 0] and d[5:] != [0, 0, 0, 0]


def _date(value: str) -> tuple[datetime.date, str] | None:
    form = "%Y-%m-%d" if "-" in value else "%d.%m.%Y" if "." in value else "%m/%d/%Y"
    try:
        day = datetime.datetime.strptime(value, form).date()
    except ValueError:
        return None
    return (day, form) if 1900 <= day.year <= 2099 else None


def pseudonym(key: bytes, kind: str, value: str, undo: bool = False) -> tuple[str, str] | None:
    """(kind, pseudonym) of a value found by the pattern named ``kind``; None if it isn't valid."""
    digits = [int(c) for c in value if c.isdigit()] if kind not in ("email", "iban") else []
    ten = [10] * len(digits)
    number = lambda ds: _place(value, "".join(map(str, ds)))
    if kind == "email":
        end = value.rindex(".")
        plain = "".join(c for c in value[:end] if c.isalnum()).lower()
        return kind, _place(value[:end], _alnum(key, kind + value[end:].lower(), plain, undo)) + value[end:]
    if kind == "iban":
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1:
            return None
        body = _alnum(key, kind + plain[:2], plain[4:].lower(), undo).upper()
        return kind, _place(value, f"{plain[:2]}{98 - _iban_rest(plain[:2] + '00' + body):02d}{body}")
    if kind == "ip":
        parts = [int(x) for x in value.split(".")]
        return (kind, ".".join(map(str, feistel(key, kind, [256] * 4, parts, undo)))) if max(parts) < 256 else None
    if kind == "date":
        if (found := _date(value)) is None:
            return None
        at = found[0].toordinal() - _FIRST
        a, b = _walk(lambda v: feistel(key, kind, [271, 271], v, undo), lambda v: v[0] * 271 + v[1] < _DAYS, list(divmod(at, 271)))
        return kind, datetime.date.fromordinal(_FIRST + a * 271 + b).strftime(found[1])
    if kind == "ssn":
        return (kind, number(_walk(lambda v: feistel(key, kind, ten, v, undo), _ssn_ok, digits))) if _ssn_ok(digits) else None
    if kind == "phone":
        head, tail = digits[:-10], digits[-10:]
        return kind, number(head + feistel(key, f"{kind}{head}", [10] * len(tail), tail, undo))
    if not is_card(digits):
        return None
    body = _walk(lambda v: feistel(key, "card", ten[:-1], v, undo), lambda v: is_card([*v, luhn_digit(v)]), digits[:-1])
    return "card", number([*body, luhn_digit(body)])


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each value, from left to right; see the module text."""
    cards = find_cards(text)
    found: list[tuple[int, int, str]] = []
    at = next_card = 0
    while (m := _FIND.search(text, at)) is not None:
        start, value, kind = m.start(), m.group(), m.lastgroup
        while next_card < len(cards) and cards[next_card][0] <= start:
            next_card += 1
        if kind == "phone" and next_card < len(cards) and cards[next_card][0] < m.end() < cards[next_card][1]:
            shorter = value[:cards[next_card][0] - start].rstrip(" ().-")
            value = shorter if sum(c.isdigit() for c in shorter) >= 8 else value
        for n in _lengths(kind, value, text[start + len(value):start + len(value) + 1]):
            if valid(kind, value[:n]):
                found.append((start, start + n, kind))
                at = start + n
                break
        else:
            at = _TOKEN.match(text, start).end()  # a value may start behind the first token
    out, i, end = [], 0, 0
    for a, b in cards:
        while i < len(found) and found[i][1] <= a:
            i += 1
        if a >= end and (i == len(found) or found[i][0] >= b):
            out.append((a, b, "card"))
            end = b
    return sorted(found + out)


def valid(kind: str, value: str) -> bool:
    """Whether a text found by the pattern of ``kind`` is a value."""
    if kind == "iban":
        plain = value.replace(" ", "")
        return 15 <= len(plain) <= 34 and _iban_rest(plain) == 1
    if kind == "ip":
        return max(map(int, value.split("."))) < 256
    if kind == "date":
        return _date(value) is not None
    return kind != "ssn" or _ssn_ok([int(c) for c in value if c.isdigit()])


def replace(key: bytes, text: str, undo: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and (start, end, kind) of each."""
    found, out, done = find(text), [], 0
    for a, b, kind in found:
        out += (text[done:a], pseudonym(key, kind, text[a:b], undo)[1])
        done = b
    return "".join([*out, text[done:]]), found


def restore(key: bytes, text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text of which ``replace`` made ``text`` and ``spans``."""
    out, done, shift = [], 0, 0  # shift: addresses change their length
    for a, b, kind in spans:
        start = a + shift
        end = start + len(_ADDRESS.match(text, start).group()) if kind == "ip" else b + shift
        out += (text[done:start], pseudonym(key, kind, text[start:end], True)[1])
        done, shift = end, end - b
    return "".join([*out, text[done:]])


def _may_have(column: pa.Array) -> np.ndarray:
    """Rows with a digit or an ``@``; no other text can match."""
    out = np.zeros(len(column), bool)
    for lo, _, data, offsets in T.chunks(column):
        at = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
        out[lo + np.unique(np.searchsorted(offsets, at, side="right") - 1)] = True
    return out


def _map(key: bytes, at: int, undo: bool):
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches):
        for batch in batches:
            column = batch.column(at)
            rows = np.flatnonzero(_may_have(column))
            texts, found = column.to_pylist(), [[]] * len(column)
            for i in rows.tolist():
                if texts[i] is not None:
                    texts[i], marks = replace(key, texts[i], undo)
                    found[i] = [{"start": a, "end": b, "kind": k} for a, b, k in marks]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*cols, pa.array(found, spans)], names=[*batch.schema.names, "_pii_spans"])

    return run


def pseudonymised(docs: DataFrame, key: bytes, text_col: str = "text", undo: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``_pii_spans``: array of (start, end, kind) in the given text."""
    prepare(docs.sparkSession)
    spans = ArrayType(StructType([StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("kind", StringType())]))
    cast = docs.withColumn(text_col, F.col(text_col).cast("string"))
    return map_rows(cast, _map(key, cast.columns.index(text_col), undo), (StructField("_pii_spans", spans),))


def _restore_map(key: bytes, at: int, spans_at: int):
    def run(batches):
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), batch.column(spans_at).to_pylist()
            for i, (text, marks) in enumerate(zip(texts, spans)):
                if text is not None and marks:
                    texts[i] = restore(key, text, [(m["start"], m["end"], m["kind"]) for m in marks])
            cols = list(batch.columns)
            cols[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return run


def restored(docs: DataFrame, key: bytes, text_col: str = "text", spans_col: str = "_pii_spans") -> DataFrame:
    """The rows of which ``pseudonymised`` made ``docs``, by their spans; exact for every text."""
    prepare(docs.sparkSession)
    return map_rows(docs, _restore_map(key, docs.columns.index(text_col), docs.columns.index(spans_col))).drop(spans_col)
