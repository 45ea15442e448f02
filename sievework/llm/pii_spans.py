"""Base spans of personal data: e-mail addresses, IP addresses, card and phone numbers.

Each function returns the (start, end) pairs, in code points, of the
leftmost non-overlapping matches of its pattern that pass its test.  The
scans are linear in the text, also where the patterns as such would try
every start of a long run of digits or letters.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    """A local part holds no ``@``, so each ``@`` has one candidate: all that fits before it."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            out.append((start, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    """In a chain of numbers joined by dots, every four from the left are a match."""
    out = []
    if "." in text:
        for m in _DOTTED.finditer(text):
            parts = m.group().split(".")
            start = m.start()
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                end = start + sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                    out.append((start, end))
                start = end + 1
    return out


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start."""
    return [(k, a, b) for k, f in zip(KINDS, (emails, ips, cards, phones), strict=True) for a, b in f(text)]
