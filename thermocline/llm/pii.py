"""Personal data by anchor expansion: one Aho-Corasick pass finds anchors, local parsers expand them."""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame

from thermocline.llm.spans import Covered, Spans, scan

#: Kinds whose spans are fixed by their patterns, in order; then those the anchors add.
BASE = ("email", "ip", "card", "phone")
ADDED = ("address", "account")

_DIGITS = "0123456789"
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_LABEL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-")
_NUMBER = re.compile(r"[0-9](?:[ -]?[0-9])+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HANDLE = re.compile(r"@[A-Za-z0-9_]{2,30}(?![A-Za-z0-9_@.-])")
_URL = re.compile(r"[A-Za-z]+://[^\s<>\"'|\\^`{}]+")
_HOST = re.compile(r"[A-Za-z]+://(?:[^/@?#]*@)?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)(?::[0-9]{1,5})?(?:[/?#]|$)")
#: After a cue: a label's rest, then an account number with an optional country and check digits.
_ACCOUNT = re.compile(r"(?:[ ]?(?:number|nummer|numero|numéro|no|nr|num)\b\.?)?[ ]?[:#=]?[ ]?([A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}|[0-9](?:[ -]?[0-9]){5,17})(?![A-Za-z0-9])", re.I)

#: Words that announce an identifier, by what follows them. Fixed values.
CUES = {
    "number": ("iban", "account", "acct", "konto", "kontonummer", "compte", "cuenta"),
    "routing": ("routing", "aba", "bankleitzahl", "blz", "sort code"),
    "bank": ("bic", "swift"),
    "passport": ("passport", "reisepass", "passeport", "pasaporte"),
    "tax": ("ssn", "social security", "tax id", "ein", "vat", "steuernummer", "nif", "siren"),
    "customer": ("customer", "kundennummer", "client id", "member", "policy", "patient"),
}
SCHEMES = ("http://", "https://", "ftp://")


_LABEL_REST = r"(?:[ ]?(?:number|nummer|numero|numéro|code|no|nr|num|id)\b\.?)?[ ]?[:#=]?[ ]?"
#: What may follow a cue; the group is the identifier.
_AFTER = {
    "number": _ACCOUNT,
    "routing": re.compile(_LABEL_REST + r"([0-9]{2}-[0-9]{2}-[0-9]{2}|[0-9]{8,9})(?![A-Za-z0-9])", re.I),
    "bank": re.compile(_LABEL_REST + r"([A-Z]{6}[A-Z0-9]{2}(?:[A-Z0-9]{3})?)(?![A-Za-z0-9])", re.I),
    "passport": re.compile(_LABEL_REST + r"([A-Z]{0,2}[0-9]{6,9})(?![A-Za-z0-9])", re.I),
    "tax": re.compile(_LABEL_REST + r"([0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{2}-[0-9]{7}|[A-Z]{2}[0-9]{8,12}|[0-9]{8,11}[A-Z]?)(?![A-Za-z0-9])", re.I),
    "customer": re.compile(_LABEL_REST + r"([A-Z]{0,4}-?[0-9]{5,12})(?![A-Za-z0-9])", re.I),
}


def _automaton() -> ahocorasick.Automaton:
    """Anchors of all kinds: (kind, length)."""
    machine = ahocorasick.Automaton()
    machine.add_word("@", ("at", 1))
    for a in _DIGITS:
        machine.add_word("+" + a, ("plus", 2))
        for b in _DIGITS:
            machine.add_word(f"{a}.{b}", ("dot", 3))
            for gap in ("", " ", "-"):
                machine.add_word(a + gap + b, ("pair", len(gap) + 2))
    for kind, words in (*CUES.items(), ("scheme", SCHEMES)):
        for w in words:
            for form in {w, w.upper(), w.capitalize()}:
                machine.add_word(form, (kind, len(w)))
    machine.make_automaton()
    return machine


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _iban(text: str) -> bool:
    rest = text[4:] + text[:4]
    return int("".join(str(int(c, 36)) for c in rest)) % 97 == 1


def _routing(number: str) -> bool:
    """Nine digits must pass the checksum of routing numbers; shorter bank and sort codes have none."""
    return len(number) != 9 or sum(int(c) * (3, 7, 1)[k % 3] for k, c in enumerate(number)) % 10 == 0


def _social(number: str) -> bool:
    """No part of a number written 3-2-4 is zero, nor is its first 666 or over 899."""
    parts = number.split("-")
    return len(parts) != 3 or (all(int(p) for p in parts) and parts[0] != "666" and int(parts[0]) < 900)


#: Whether an identifier after a cue can be one.
_VALID: dict[str, Callable[[str], bool]] = {
    "number": lambda n: not n[0].isalpha() or _iban(n.replace(" ", "").replace("-", "").upper()),
    "routing": _routing,
    "bank": lambda n: n.isupper(),
    "passport": lambda n: True,
    "tax": _social,
    "customer": lambda n: True,
}


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around an at-sign: left over local characters down to floor, right over a domain of two labels or more."""
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at:
        return None
    end, labels, n = at + 1, 0, len(text)
    while True:
        first = end
        while end < n and text[end] in _LABEL:
            end += 1
        if end == first:
            end -= 1  # the dot before isn't part
            break
        labels += 1
        if end == n or text[end] != ".":
            break
        end += 1
    return (start, end) if labels >= 2 else None


def quads(text: str, start: int) -> tuple[list[tuple[int, int]], int]:
    """Groups of four numbers of at most 255, taken four by four from a chain of dotted numbers; and where the chain ends."""
    chain = _DOTTED.match(text, start)
    parts, found, at = chain.group().split("."), [], start
    for k in range(0, len(parts) - 3, 4):
        four = parts[k : k + 4]
        end = at + sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
            found.append((at, end))
        at = end + 1
    return found, chain.end()


def finder() -> Callable[[str], Spans]:
    machine = _automaton()

    def find(text: str) -> Spans:
        spans: dict[str, list[tuple[int, int]]] = {k: [] for k in (*BASE, *ADDED)}
        ends = dict.fromkeys(("email", "dot", "pair", "scheme", "cue"), 0)
        later = []
        for last, (kind, size) in machine.iter(text):
            at = last + 1 - size
            if kind == "pair":
                if at >= ends["pair"]:
                    match = _NUMBER.match(text, at)
                    ends["pair"] = match.end()
                    digits = match.group().replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append(match.span())
            elif kind == "dot":
                if at >= ends["dot"]:
                    while at > ends["dot"] and text[at - 1] in _DIGITS:  # to the first digit of the number
                        at -= 1
                    found, ends["dot"] = quads(text, at)
                    spans["ip"].extend(found)
            elif kind == "plus":
                match = _PHONE.match(text, at)
                if match and 9 <= sum(c in _DIGITS for c in match.group()) <= 15:
                    spans["phone"].append(match.span())
            elif kind == "at":
                found = email_at(text, at, ends["email"])
                if found:
                    ends["email"] = found[1]
                    spans["email"].append(found)
                elif not (at and text[at - 1] in _LOCAL):
                    later.append(("account", _HANDLE.match(text, at), 0))
            elif kind == "scheme":
                if at >= ends["scheme"] and not (at and text[at - 1].isalnum()):
                    match = _URL.match(text, at)
                    if match:
                        ends["scheme"] = match.end()
                        later.append(("address", match, 0))
            elif at >= ends["cue"] and not (at and text[at - 1].isalnum()):
                match = _AFTER[kind].match(text, last + 1)
                if match and _VALID[kind](match.group(1)):
                    ends["cue"] = match.end()
                    later.append(("account", match, 1))
        taken = Covered(s for k in BASE for s in spans[k])
        for kind, match, group in later:
            if match is None:
                continue
            start, end = match.span(group)
            if kind == "address":
                url = text[start:end].rstrip(".,;:!?)]*")
                end = start + len(url)
                if not _HOST.match(url):
                    continue
            if not taken.touches(start, end):
                spans[kind].append((start, end))
        return [(k, a, b) for k, found in spans.items() for a, b in found]

    return find


def personal_data(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """docs with an array of (kind, start, end), in code points, end exclusive, by kind as in BASE and ADDED, then start.

    Base kinds are leftmost matches that don't overlap within a kind; a match that fails its check
    (parts over 255, Luhn, number of digits) is dropped. The anchors add web addresses after
    schemes, identifiers after cues (account, routing, bank, passport, tax and customer numbers, with
    valid check digits where they have them) and
    handles at at-signs, where no base span lies. Null and empty texts have no spans; equal rows
    have equal spans; a column named like the result is replaced.
    """
    return scan(docs, finder, text, spans)
