"""Base detectors of personal data: email, ip, card, phone. Spans are code point offsets, end exclusive.

Every detector runs in time linear in the text.
"""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a match of the whole pattern always begins where a digit run begins
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n if n < 5 else 2 * n - 9)
    return total % 10 == 0


def emails(text: str):
    low, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > low and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        low = m.end() if m else at + 1
        at = text.find("@", low)


def ips(text: str):
    for m in _IP.finditer(text):
        if all(len(x.lstrip("0")) < 4 and int(x.lstrip("0") or "0") <= 255 for x in m[0].split(".")):
            yield m.span()


def cards(text: str):
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str):
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", s, e) for s, e in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", s, e) for s, e in ips(text)]
        out += [("card", s, e) for s, e in cards(text)]
        if "+" in text:
            out += [("phone", s, e) for s, e in phones(text)]
    return out
