"""Plain versions of the contracts, to hold operators against."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def secrets(text):
    text = text or ""
    rules = [
        ("assign", re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
    ]
    got = [(m.start(), i, (k, m.start(), m.end())) for i, (k, p, ok) in enumerate(rules) for m in p.finditer(text) if ok(m)]
    return [x[2] for x in sorted(got)]


def luhn(d):
    odd = [int(c) for c in d[::-1]]
    return (sum(odd[0::2]) + sum(sum(divmod(2 * c, 10)) for c in odd[1::2])) % 10 == 0


def pii(text):
    text = text or ""
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m[0])) <= 15),
    ]
    return [(k, m.start(), m.end()) for k, p, ok in rules for m in re.finditer(p, text) if ok(m)]
