"""Personal data by anchor expansion.

One Aho-Corasick scan finds the places where personal data may be: at-signs, plus signs, digits, the
"://" of addresses and cues such as "password=".  From each anchor a small parser expands to both
sides, as far as the kind's characters go, and checks the result.  Parsers go from left to right and
never look at a place twice.

``base`` spans are what the kinds' patterns match, leftmost and without overlap, kept if they pass
their check.  The method adds what those greedy patterns lose or do not know: numbers glued to a
neighbouring number, key and password values behind their cue, and user names inside addresses.

Defined results: a null text counts as empty (and stays null when redacted); a text without anchors
has no spans; each input row gives one row, also for repeated and null ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treadle.llm.batches import id_and_text, map_texts

#: Kinds in the order of the result; the first four have base patterns.
KINDS = ("email", "ip", "card", "phone", "account", "address")
BASE_KINDS = KINDS[:4]

DIGITS = frozenset("0123456789")
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
LOCAL, LABEL = _ALNUM | frozenset("._%+-"), _ALNUM | frozenset("-")
DIALLED = DIGITS | frozenset(" ().-")
#: Cues that stand directly before a value, and fewest characters of the value.
VALUE_CUES = {"password=": 4, "passwd=": 4, "secret=": 8, "api_key=": 8, "apikey=": 8, "token=": 8}
#: Beginnings of access keys with the number of capital letters and digits that follow.
KEY_CUES = {"AKIA": 16, "ASIA": 16}
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
#: Characters behind its cue in which an account number begins, and the most it may have with blanks.
NEAR, LONGEST = 50, 64

Span = tuple[str, int, int]


@cache
def anchors() -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for d in DIGITS:
        out.add_word(d, ("digit", 1, 0))
    for kind, text in (("at", "@"), ("plus", "+"), ("scheme", "://")):
        out.add_word(text, (kind, len(text), 0))
    for cue, least in VALUE_CUES.items():
        for form in (cue, cue.upper(), cue.capitalize()):
            out.add_word(form, ("value", len(form), least))
    for cue, size in KEY_CUES.items():
        out.add_word(cue, ("key", len(cue), size))
    for form in ("IBAN", "iban", "Iban"):
        out.add_word(form, ("iban", 4, 0))
    out.make_automaton()
    return out


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The first place from ``at`` on whose character is not allowed."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _back(text: str, at: int, floor: int, allowed: frozenset) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign: a local part, and at least two labels."""
    start = _back(text, at, floor, LOCAL)
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == ".":
        stop = _run(text, end + 1, LABEL)
        if stop == end + 1:
            break
        end, labels = stop, labels + 1
    return (start, end) if labels > 1 else None


def dotted(text: str, start: int) -> int | None:
    """The end of four numbers between dots that begin at ``start``."""
    at = _run(text, start, DIGITS)
    for _ in range(3):
        stop = _run(text, at + 1, DIGITS)
        if text[at:at + 1] != "." or stop == at + 1:
            return None
        at = stop
    return at


def chain(text: str, start: int) -> int:
    """The end of digits with at most one blank or hyphen between two of them."""
    at, n = start + 1, len(text)
    while at < n:
        if text[at] in DIGITS:
            at += 1
        elif text[at] in " -" and at + 1 < n and text[at + 1] in DIGITS:
            at += 2
        else:
            break
    return at


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def phone(text: str, plus: int) -> int | None:
    """The end of the dialled characters behind the plus sign: at the last digit of their run."""
    if text[plus + 1:plus + 2] not in DIGITS:
        return None
    end = _run(text, plus + 2, DIALLED)
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end > plus + 3 else None


def cards_within(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Cards among the groups of a chain that is none as a whole, leftmost first, longest first.

    Only runs of groups with 13 to 19 digits are tried, so the work is linear in the chain.
    """
    groups = [(start + m.start(), start + m.end()) for m in re.finditer(r"[0-9]+", text[start:end])]
    k = 0
    while k < len(groups):
        found, last, digits = None, k, 0
        while last < len(groups) and (digits := digits + groups[last][1] - groups[last][0]) <= 19:
            if digits >= 13 and luhn(_digits(text[groups[k][0]:groups[last][1]])):
                found = last
            last += 1
        if found is None:
            k += 1
        else:
            yield groups[k][0], groups[found][1]
            k = found + 1


def phone_within(text: str, start: int, end: int) -> int | None:
    """The end of a phone number whose run went on into other numbers: whole groups up to 15 digits.

    Numbers of country code 1 have eleven.
    """
    best, digits = None, 0
    for m in re.finditer(r"[0-9]+", text[start:end]):
        digits += m.end() - m.start()
        if digits == 11 and text[start + 1] == "1":
            return start + m.end()
        if digits > 15 or m.end() - m.start() > 12:
            break
        if digits >= 9:
            best = start + m.end()
    return best


def iban(text: str, at: int) -> tuple[int, int] | None:
    """The first account number that begins within ``NEAR`` characters of its cue and whose check digits are right."""
    last = min(len(text), at + NEAR + LONGEST)
    first = m = IBAN.search(text, at, last)
    while m and m.start() < at + NEAR:
        # after a failed match, numbers begin a group, which the failed one may have run into
        groups = m.group().split(" ") if m is first or text[m.start() - 1] not in _ALNUM else []
        for k in range(len(groups), 0, -1):
            own = " ".join(groups[:k])
            plain = own.replace(" ", "")
            if len(plain) >= 15 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1:
                return m.start(), m.start() + len(own)
        m = IBAN.search(text, m.start() + 1, last)
    return None


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans and added spans, each by kind and then start."""
    base: list[Span] = []
    more: list[Span] = []
    floor = dict.fromkeys((*BASE_KINDS, "run", "account"), 0)
    for last, (kind, size, extra) in anchors().iter(text):
        at, end = last - size + 1, last + 1
        if kind == "digit":
            if at >= floor["ip"] and at >= floor["run"]:
                stop = dotted(text, at)
                floor["run"] = _run(text, at, DIGITS)
                if stop:
                    floor["ip"] = stop
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text[at:stop].split(".")):
                        base.append(("ip", at, stop))
            if at >= floor["card"]:
                stop = floor["card"] = chain(text, at)
                if stop - at >= 13:
                    if is_card(text[at:stop]):
                        base.append(("card", at, stop))
                    else:
                        more += [("card", a, b) for a, b in cards_within(text, at, stop)]
        elif kind == "at":
            if at >= floor["email"] and (found := email(text, at, floor["email"])):
                base.append(("email", *found))
                floor["email"] = found[1]
        elif kind == "plus":
            if at >= floor["phone"] and (stop := phone(text, at)):
                floor["phone"] = stop
                if is_phone(text[at:stop]):
                    base.append(("phone", at, stop))
                elif stop := phone_within(text, at, stop):
                    more.append(("phone", at, stop))
        elif kind == "scheme":
            stop = end
            while stop < len(text) and not text[stop].isspace() and text[stop] not in "/@?#<>\"'":
                stop += 1
            if text[stop:stop + 1] == "@" and stop > end:
                more.append(("address", end, stop))
        elif at >= floor["account"]:
            found = None
            if kind == "value":
                stop = end
                while stop < len(text) and not text[stop].isspace() and text[stop] not in "&;,\"'<>":
                    stop += 1
                found = (end, stop) if stop - end >= extra else None
            elif kind == "key":
                value = text[end:end + extra]
                if len(value) == extra and all(c in _ALNUM and not c.islower() for c in value):
                    found = (at, end + extra)
            elif kind == "iban":
                found = iban(text, end)
            if found:
                more.append(("account", *found))
                floor["account"] = found[1]
    order = lambda s: (KINDS.index(s[0]), s[1], s[2])
    return sorted(base, key=order), sorted(more, key=order)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id``, counts of the base kinds, ``base_sha256`` and ``spans`` (kind:start:end in code points)."""
    def make():
        def run(records):
            for i, text in records:
                base, more = find(text or "")
                counts = [sum(s[0] == k for s in base) for k in BASE_KINDS]
                spans = sorted(base + more, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
                yield i, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)
        return run
    rows = id_and_text(docs, id_column, text_column)
    return map_texts(rows, make, f"id {rows.schema['id'].dataType.simpleString()}, "
                                 + ", ".join(f"n_{k} long" for k in BASE_KINDS) + ", base_sha256 string, spans string")


def redact_text(text: str) -> str:
    """The text with each span replaced by its kind; spans that overlap become one."""
    base, more = find(text)
    out, at = [], 0
    merged: list[list] = []
    for kind, a, b in sorted(base + more, key=lambda s: (s[1], -s[2])):
        if merged and a < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], b)
        else:
            merged.append([kind, a, b])
    for kind, a, b in merged:
        out += [text[at:a], f"<{kind.upper()}>"]
        at = b
    return "".join([*out, text[at:]])


def redacted(text: Column) -> Column:
    """``redact_text`` of a column; null stays null."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else redact_text(t))
    return run(text)
