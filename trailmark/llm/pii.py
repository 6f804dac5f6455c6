"""Personal data by anchor expansion.

An Aho-Corasick automaton finds the places worth a look in one pass over a text: at-signs, dots, digits and plus signs,
schemes, and cues such as "iban" or "account no". From each anchor a small deterministic parser reads outwards to the
borders of the item and validates it; nothing is searched for by regular expression.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_batches, whole_text

BASE = ("email", "ip", "card", "phone")
#: kinds of this method, after the base ones
OWN = ("url", "iban", "ssn", "account", "secret")
KINDS = BASE + OWN

_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LABEL = _DIGITS | _LETTERS | {"-"}
_LOCAL = _DIGITS | _LETTERS | frozenset("._%+-")
_PHONE = _DIGITS | frozenset(" ().-")
_URL_END = frozenset(" \t\r\n\f\v<>\"'`{}|\\^[]")

#: anchor texts by the parser they start; cues are looked for in lower, title and upper case
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security number", "social security no"),
    "account": ("account no", "account number", "acct", "kontonummer", "numéro de compte", "número de cuenta"),
    "secret": ("api_key", "api-key", "apikey", "secret", "token", "password", "passwd"),
}

Span = tuple[int, int]


def _run(text: str, start: int, allowed: frozenset) -> int:
    """End of the run of allowed characters that starts at ``start``."""
    end, size = start, len(text)
    while end < size and text[end] in allowed:
        end += 1
    return end


def _email(text: str, at: int, floor: int) -> Span | None:
    """Local part to the left, at least two domain labels to the right; ``floor`` is where the last one ended."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, at + 1, _LABEL)
    if start == at or end == at + 1:
        return None
    first = end
    while end < len(text) and text[end] == "." and (after := _run(text, end + 1, _LABEL)) > end + 1:
        end = after
    return (start, end) if end > first else None


def _ip(text: str, dot: int, floor: int) -> Span | None:
    """Four numbers with dots between; the anchor is the first dot. Their size is checked by the caller."""
    start = dot
    while start > floor and text[start - 1] in _DIGITS:
        start -= 1
    if start == dot:
        return None
    end = dot
    for _ in range(3):
        if end >= len(text) or text[end] != "." or (after := _run(text, end + 1, _DIGITS)) == end + 1:
            return None
        end = after
    return start, end


def _digit_run(text: str, start: int) -> Span:
    """Digits with at most one blank or hyphen between two of them."""
    end, size = start + 1, len(text)
    while end < size:
        if text[end] in _DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in _DIGITS:
            end += 2
        else:
            break
    return start, end


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        if place % 2:
            value = value * 2 - 9 * (value > 4)
        total += value
    return total % 10 == 0


def _phone(text: str, plus: int) -> Span | None:
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    end = _run(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    return (plus, end) if end > plus + 3 else None


def _digits(text: str) -> str:
    return "".join(c for c in text if c in _DIGITS)


def _url(text: str, start: int, scheme_end: int) -> Span | None:
    end = scheme_end
    while end < len(text) and text[end] not in _URL_END:
        end += 1
    while end > scheme_end and text[end - 1] in ".,;:!?)":
        end -= 1
    return (start, end) if end > scheme_end else None


def _value_start(text: str, at: int) -> int:
    """Past blanks, separators and an opening quote after a cue."""
    limit = min(len(text), at + 12)
    while at < limit and text[at] in " \t:=.#\"'-":
        at += 1
    return at


def _iban(text: str, at: int) -> Span | None:
    """Two letters, two check digits, 11 to 30 more characters in any grouping; the remainder by 97 must be 1."""
    chars, end = [], at
    while end < len(text) and len(chars) < 34:
        if text[end] in _DIGITS or text[end] in _LETTERS:
            chars.append(text[end].upper())
        elif text[end] != " ":
            break
        end += 1
    for size in range(len(chars), 14, -1):
        code = "".join(chars[:size])
        if code[:2].isalpha() and code[2:4].isdigit() and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1:
            end = at
            while size:
                size -= text[end] != " "
                end += 1
            return at, end
    return None


def _ssn(text: str, at: int) -> Span | None:
    part = text[at : at + 11]
    shaped = len(part) == 11 and part[3] == part[6] == "-" and len(_digits(part)) == 9
    free = _run(text, at + 11, _DIGITS) == at + 11
    return (at, at + 11) if shaped and free and part[:3] not in ("000", "666") and part[0] != "9" else None


def _account(text: str, at: int) -> Span | None:
    if at >= len(text) or text[at] not in _DIGITS:
        return None
    start, end = _digit_run(text, at)
    return (start, end) if 6 <= len(_digits(text[start:end])) <= 17 else None


def _secret(text: str, at: int) -> Span | None:
    end = _run(text, at, _DIGITS | _LETTERS | frozenset("_-+/="))
    value = text[at:end]
    return (at, end) if end - at >= 12 and any(c in _DIGITS for c in value) and any(c in _LETTERS for c in value) else None


_CUED = {"iban": _iban, "ssn": _ssn, "account": _account, "secret": _secret}
_machine = None


def _automaton():
    global _machine
    if _machine is None:
        import ahocorasick

        _machine = ahocorasick.Automaton()
        for sign in "@+":
            _machine.add_word(sign, (sign, 1))
        for digit in "0123456789":
            _machine.add_word(digit, ("digit", 1))
            _machine.add_word("." + digit, (".", 2))
        cues = {scheme: "url" for scheme in SCHEMES} | {cue: kind for kind, cues in CUES.items() for cue in cues}
        for cue, kind in cues.items():
            for form in {cue, cue.title(), cue.upper(), cue.capitalize()}:
                _machine.add_word(form, (kind, len(form)))
        _machine.make_automaton()
    return _machine


def find(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of everything found, by kind in the order of ``KINDS``, then start; code points, end exclusive."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    last = dict.fromkeys(KINDS, 0)  # where the last match ended, dropped ones too
    for position, (what, size) in _automaton().iter(text):
        start = position - size + 1
        if what == "digit":
            if start >= last["card"]:
                _, last["card"] = span = _digit_run(text, start)
                if span[1] - start >= 16 and 16 <= len(digits := _digits(text[slice(*span)])) <= 19 and _luhn(digits):
                    found["card"].append(span)
        elif what == ".":
            if start >= last["ip"] and (span := _ip(text, start, last["ip"])):
                last["ip"] = span[1]
                # a part of very many digits is too large without reading it as a number
                if all(len(part.lstrip("0")) <= 3 and int(part[-3:]) <= 255 for part in text[slice(*span)].split(".")):
                    found["ip"].append(span)
        elif what == "@":
            if start >= last["email"] and (span := _email(text, start, last["email"])):
                last["email"] = span[1]
                found["email"].append(span)
        elif what == "+":
            if (span := _phone(text, start)) and 8 <= len(_digits(text[slice(*span)])) <= 15:
                found["phone"].append(span)
        elif what == "url":
            if start >= last["url"] and (span := _url(text, start, start + size)):
                last["url"] = span[1]
                found["url"].append(span)
        elif (span := _CUED[what](text, _value_start(text, start + size))) and span[0] >= last[what]:
            last[what] = span[1]
            found[what].append(span)
    return [(kind, *span) for kind in KINDS for span in sorted(found[kind])]


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, a digest of their spans, and all spans.

    Null and empty texts have no spans (digest of the empty string); a repeated row is scanned again; only ``doc_id`` and
    ``text`` are read. ``spans`` is ``kind:start:end`` joined by commas.
    """

    def rows(texts: list[str]) -> Iterator[list]:
        for text in texts:
            spans = find(text)
            base = [span for span in spans if span[0] in BASE]
            counts = [sum(span[0] == kind for span in base) for kind in BASE]
            yield [*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*rows(batch.column("text").to_pylist()))) or [[]] * 6
        kinds = [pa.int64()] * 4 + [pa.string()] * 2
        arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds)]
        return pa.record_batch([batch.column("doc_id"), *arrays], names=[c.split()[0] for c in SCHEMA.split(", ")])

    return map_batches(whole_text(docs), run, SCHEMA)
