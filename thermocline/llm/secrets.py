"""Secrets: patterns, and windows of high entropy over candidate strings."""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame

from thermocline.llm.spans import Covered, Spans, scan

BASE = ("assign", "access", "hex")
ADDED = ("entropy",)

_ASSIGN = re.compile(r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")

#: Characters of a window; a shorter candidate is one window.
WINDOW = 20
#: Character classes of candidates, narrowest first: pattern, and least entropy of a window in bits. Fixed values.
CLASSES = (
    (re.compile(r"[0-9]+"), 2.9),  # ten digits reach 3.32 at most; counted after a cue only
    (re.compile(r"[0-9a-fA-F]+"), 3.0),
    (re.compile(r"[A-Za-z0-9]+"), 3.7),
    (re.compile(r"[A-Za-z0-9+/_=-]+"), 3.9),
)
#: Strings, or parts of them between separators, that are no secrets however mixed they look. Fixed values.
KNOWN = re.compile(r"EXAMPLE|example|0123456789|abcdefgh|ABCDEFGH|^(?:https?|www)$")
_UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
_PART = re.compile(r"[^/_=+-]+")
#: Of a run of small letters and digits with separators (a path or a slug), a part with this many changes between letters and digits isn't a word.
_SLUG, CHANGES = re.compile(r"[a-z0-9]+(?:[-_/][a-z0-9]+){3,}"), 3
_CHANGE = re.compile(r"(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
_KINDS = tuple(map(re.compile, ("[A-Z]", "[a-z]", "[0-9]")))
#: Candidates and their parts have at least this length; short of a window, their entropy is this share of the most they can reach.
SHORTEST, SHORT_SHARE = 12, 0.9

#: Digits alone are an identifier or a sum as often as a secret: one of these must stand shortly before them. Fixed values.
_CUE, CUE_REACH = re.compile(r"(?ai:secret|token|passw|passphrase|pin|otp|auth|credential|private|key)"), 24

_TERM = [0.0, *(n * math.log2(n) for n in range(1, WINDOW + 1))]


def entropy_spans(text: str, least: float, width: int = WINDOW) -> list[tuple[int, int]]:
    """Parts of text covered by windows whose Shannon entropy is at least least, in bits a character.

    A step of the window changes two counts, so it costs the same for any width up to WINDOW.
    """
    if len(text) < width:
        return []
    counts: dict[str, int] = {}
    total = 0.0
    most = width * (math.log2(width) - least) + 1e-9  # of the sum of n log n over the counts
    found: list[list[int]] = []
    for k, c in enumerate(text):
        if k >= width:
            old = text[k - width]
            n = counts[old]
            total += _TERM[n - 1] - _TERM[n]
            counts[old] = n - 1
        n = counts.get(c, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
        if k >= width - 1 and total <= most:
            if found and found[-1][1] >= k + 1 - width:
                found[-1][1] = k + 1
            else:
                found.append([k + 1 - width, k + 1])
    return [(a, b) for a, b in found]


def searched(string: str) -> list[tuple[int, int]]:
    """Parts of a candidate to search: parts between separators that the allow-list knows are cut out, words of a path or slug too; parts of a path or slug that are no words are also searched by themselves."""
    if _UUID.fullmatch(string):
        return []
    slug = _SLUG.fullmatch(string) is not None
    out, alone, start = [], [], 0
    for m in _PART.finditer(string):
        part = m.group()
        word = len(_CHANGE.findall(part)) < CHANGES if slug else part == string and part.isalpha()
        if word or KNOWN.search(part):
            out.append((start, m.start()))
            start = m.end()
        elif slug:
            alone.append(m.span())
    return [(a, b) for a, b in [*out, (start, len(string)), *alone] if b - a >= SHORTEST]


def mixed(string: str) -> bool:
    """If a string too short for a window has capital and small letters and digits, or letters and digits by turns."""
    return len(_CHANGE.findall(string)) >= CHANGES or all(p.search(string) for p in _KINDS)


def finder() -> Callable[[str], Spans]:
    def find(text: str) -> Spans:
        base = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
        base += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
        base += [("hex", *m.span()) for m in _HEX.finditer(text)]
        base.sort(key=lambda s: (s[1], BASE.index(s[0])))
        taken = Covered(s[1:] for s in base)
        added = []
        for m in _CANDIDATE.finditer(text):
            string = m.group()
            found: list[tuple[int, int]] = []
            for left, right in searched(string):
                part = string[left:right]
                width = min(len(part), WINDOW)
                digits = part.isdigit()
                if digits:
                    at = m.start() + left
                    if not _CUE.search(text, max(0, at - CUE_REACH), at):
                        continue
                elif width < WINDOW and not mixed(part):
                    continue
                least = SHORT_SHARE * math.log2(min(width, 10) if digits else width) if width < WINDOW else next(x for pattern, x in CLASSES if pattern.fullmatch(part))
                found += [(m.start() + left + a, m.start() + left + b) for a, b in entropy_spans(part, least, width)]
            merged: list[tuple[int, int]] = []
            for start, end in sorted(found):
                if merged and start <= merged[-1][1]:
                    merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
                else:
                    merged.append((start, end))
            # what a base span covers is cut out; a short rest is no secret by itself
            for a, b in merged:
                rest = taken.rest(a, b)
                added += [("entropy", x, y) for x, y in rest if rest == [(a, b)] or y - x >= SHORTEST]
        return [*base, *added] if not added else sorted([*base, *added], key=lambda s: (s[1], (*BASE, *ADDED).index(s[0])))

    return find


def secrets(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """docs with an array of (kind, start, end), in code points, end exclusive, by start, then kind as in BASE and ADDED.

    Base kinds are leftmost matches that don't overlap within a kind; shorter ones than a kind asks
    for are dropped. Of other strings of key characters, parts of high entropy for the narrowest
    character class that holds the string are added, without what the allow-list knows of it and
    where no base span lies. Strings of 12 to 19 characters are one window each. Null and empty texts have no spans; equal rows have equal spans; a column
    named like the result is replaced.
    """
    return scan(docs, finder, text, spans)
