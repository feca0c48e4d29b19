"""PII: anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs,
schemes (`://`, `mailto:`, `tel:`), plus signs before digits, digits that
touch, and cues of identifiers; schemes and cues in any case.  From an
anchor a local parser expands to the boundaries of an address, a network
address, an account number or a phone number and validates it (part ranges,
digit counts, check digits).  Each parser reads only the run of characters
that its kind allows, so the work is the text's length plus the runs'.

The base parsers give what the leftmost, non-overlapping matches of their
expressions give.  Added kinds: `ssn` and `iban` need a cue before them (each
one found carries the cue's reach on); `url` is an address of any scheme with
a host, a mailto: with an address or a tel: with a number, without the
punctuation that closes the sentence.

Edge cases: a null text is empty; empty texts have no spans; offsets count
code points; digits and letters are ASCII only; repeated rows are searched
each; an empty table gives an empty result; extra columns are never read.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from weftline.llm._spans import Span, digest_columns
from weftline.llm._text import documents

KINDS = ("email", "ip", "card", "phone")
_DIGITS = frozenset("0123456789")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | _DIGITS
_LOCAL = _ALNUM | frozenset("._%+-")
_LABEL = _ALNUM | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")
#: Words beside which an identifier of the added kinds must stand.
CUES = ("ssn", "social security", "iban")
CUE_REACH = 40
_LETTERS = _ALNUM - _DIGITS
_SCHEME = _ALNUM | frozenset("+.-")
_URL = _ALNUM | frozenset("-._~:/?#[]@!$&'()*+,;=%")
_AUTHORITY = _URL - frozenset("/?#")
_TEL = _DIGITS | frozenset("().-")


def automaton() -> ahocorasick.Automaton:
    """Anchors and what they announce: (parsers, length)."""
    a = ahocorasick.Automaton()
    keys: dict[str, str] = {"@": "e"}
    for d in "0123456789":
        keys["+" + d] = "p"
        for f in "0123456789":
            keys[d + f] = "c"
            keys[d + "." + f] = "i"
            for sep in " -":
                keys[d + sep + f] = "c"
    keys |= {"://": "u", "mailto:": "m", "tel:": "t"} | dict.fromkeys(CUES, "q")
    for key, kind in keys.items():
        a.add_word(key, (kind, len(key)))
    a.make_automaton()
    return a


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def email(text: str, at: int, free: int) -> tuple[int, int] | None:
    """The address around the at-sign at `at`, no earlier than `free`."""
    s = at
    while s > free and text[s - 1] in _LOCAL:
        s -= 1
    if s == at:
        return None
    n, e = len(text), at + 1
    while e < n and text[e] in _LABEL:
        e += 1
    if e == at + 1:
        return None
    dotted = False
    while e + 1 < n and text[e] == "." and text[e + 1] in _LABEL:
        e += 2
        while e < n and text[e] in _LABEL:
            e += 1
        dotted = True
    return (s, e) if dotted else None


def dotted_numbers(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """The numbers of the chain digits(.digits)* around `at`, and the chain's end."""
    s = at
    while s > 0 and (text[s - 1] in _DIGITS or (text[s - 1] == "." and s > 1 and text[s - 2] in _DIGITS and text[s] in _DIGITS)):
        s -= 1
    parts, n = [], len(text)
    while True:
        e = s
        while e < n and text[e] in _DIGITS:
            e += 1
        parts.append((s, e))
        if e + 1 < n and text[e] == "." and text[e + 1] in _DIGITS:
            s = e + 1
        else:
            return parts, e


def digit_chain(text: str, at: int) -> tuple[int, int]:
    """The run of digits around `at` in which single spaces or hyphens may stand between digits."""
    s, e, n = at, at + 1, len(text)
    while s > 0 and (text[s - 1] in _DIGITS or (text[s - 1] in " -" and s > 1 and text[s - 2] in _DIGITS)):
        s -= 1 if text[s - 1] in _DIGITS else 2
    while e < n and (text[e] in _DIGITS or (text[e] in " -" and e + 1 < n and text[e + 1] in _DIGITS)):
        e += 1 if text[e] in _DIGITS else 2
    return s, e


def phone(text: str, at: int) -> tuple[int, int] | None:
    """The number that starts with the plus sign at `at`."""
    e, n = at + 2, len(text)
    while e < n and text[e] in _PHONE:
        e += 1
    while e > at + 2 and text[e - 1] not in _DIGITS:
        e -= 1
    return (at, e) if e >= at + 4 else None


def iban(text: str, s: int) -> int | None:
    """The end of a valid account number that starts at `s`."""
    chars, e, n = [], s, len(text)
    while e < n and len(chars) < 34:
        if text[e] in _ALNUM:
            chars.append(text[e].upper())
        elif text[e] != " ":
            break
        e += 1
        if len(chars) >= 15 and (e == n or text[e] not in _ALNUM):
            moved = "".join(chars[4:] + chars[:4])
            if chars[0].isalpha() and chars[1].isalpha() and chars[2].isdigit() and chars[3].isdigit() and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1:
                return e
    return None


def url_end(text: str, at: int) -> int:
    """The end of the run of address characters from `at`, without closing punctuation and brackets opened before it."""
    e, n = at, len(text)
    while e < n and text[e] in _URL:
        e += 1
    run = text[at:e]
    spare = {close: run.count(close) - run.count(start) for start, close in ("()", "[]")}
    while e > at and (text[e - 1] in ".,;:!?'" or spare.get(text[e - 1], 0) > 0):
        e -= 1
        if text[e] in spare:
            spare[text[e]] -= 1
    return e


def url(text: str, at: int) -> tuple[int, int] | None:
    """The address around the `://` at `at`."""
    s = at
    while s > 0 and text[s - 1] in _SCHEME:
        s -= 1
    while s < at and text[s] not in _LETTERS:
        s += 1
    start = e = at + 3
    while e < len(text) and text[e] in _AUTHORITY:
        e += 1
        if text[e - 1] == "@":
            start = e
    host = text[start : start + 1]
    ok = s < at and (host in _ALNUM or (host == "[" and "]" in text[start:e]))
    return (s, url_end(text, at + 3)) if ok else None


def mailto(text: str, at: int) -> int | None:
    """The end of the addresses of a mailto: that ends at `at`."""
    i, n = at, len(text)
    while i < n and text[i] in _LOCAL:
        i += 1
    got = email(text, i, at) if i < n and text[i] == "@" else None
    return max(got[1], url_end(text, at)) if got else None


def tel(text: str, at: int) -> int | None:
    """The end of the number, with its parameters, of a tel: that ends at `at`."""
    s = e = at + (text[at : at + 1] == "+")
    n = len(text)
    while e < n and text[e] in _TEL:
        e += 1
    more = text[e : e + 1] == ";"
    while e > s and text[e - 1] not in _DIGITS:
        e -= 1
    ok = 3 <= sum(c in _DIGITS for c in text[s:e]) <= 15
    return (max(e, url_end(text, at)) if more else e) if ok else None


def _after_cue(text: str, at: int, free: int) -> tuple[list[Span], int]:
    """The identifiers from `free` on within reach after a cue which ends at `at`, or after one another; and how far was looked."""
    found: list[Span] = []
    i, stop = max(at, free), at + CUE_REACH
    while i < min(len(text), stop):
        e = None
        if text[i - 1] not in _ALNUM and text[i] in _ALNUM:
            if text[i] in _DIGITS:
                p = text[i : i + 11]
                if len(p) == 11 and p[3] == p[6] == "-" and (p[:3] + p[4:6] + p[7:]).isdigit() and (p[:3] + p[4:6] + p[7:]).isascii() and text[i + 11 : i + 12] not in _DIGITS:
                    e = i + 11
                    found.append(("ssn", i, e))
            else:
                e = iban(text, i)
                if e:
                    found.append(("iban", i, e))
        if e:
            stop = e + CUE_REACH
        i = e or i + 1
    return found, i


def find(text: str, anchors: ahocorasick.Automaton) -> tuple[list[Span], list[Span]]:
    """Base spans by kind, then start; then all spans, the added kinds last."""
    own: dict[str, list[Span]] = {k: [] for k in KINDS}
    added: list[Span] = []
    free_email = end_ip = end_card = end_phone = end_url = end_cue = 0
    low = text.encode().lower().decode()  # A-Z alone
    for last, (kind, length) in anchors.iter(low):
        at = last - length + 1
        if kind == "e":
            got = email(text, at, free_email)
            if got:
                own["email"].append(("email", *got))
                free_email = got[1]
        elif kind == "c":
            if at >= end_card:
                s, end_card = digit_chain(text, at)
                digits = "".join(c for c in text[s:end_card] if c in _DIGITS)
                if 13 <= len(digits) <= 19 and luhn(digits):
                    own["card"].append(("card", s, end_card))
        elif kind == "i":
            if at >= end_ip:
                parts, end_ip = dotted_numbers(text, at)
                for i in range(0, len(parts) - 3, 4):
                    four = parts[i : i + 4]
                    if all(len(v := text[s:e].lstrip("0")) <= 3 and int(v or 0) <= 255 for s, e in four):
                        own["ip"].append(("ip", four[0][0], four[3][1]))
        elif kind == "p":
            if at >= end_phone:
                got = phone(text, at)
                if got:
                    end_phone = got[1]
                    if 9 <= sum(c in _DIGITS for c in text[at : got[1]]) <= 15:
                        own["phone"].append(("phone", *got))
        elif kind == "q":
            got, end_cue = _after_cue(text, last + 1, end_cue)
            added += got
        elif at >= end_url:
            if kind == "u":
                got = url(text, at)
            else:
                end = (mailto if kind == "m" else tel)(text, last + 1) if at == 0 or text[at - 1] not in _SCHEME else None
                got = (at, end) if end else None
            if got:
                end_url = got[1]
                added.append(("url", *got))
    base = [s for k in KINDS for s in own[k]]
    return base, [*base, *sorted(set(added))]


def find_pii():
    made: list[ahocorasick.Automaton] = []

    def run(texts: pa.Array):
        if not made:
            made.append(automaton())
        return [find(t or "", made[0]) for t in texts.to_pylist()]

    return run


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, counts of each base kind, base_sha256 and spans of every row."""
    return digest_columns(docs, KINDS, find_pii())


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
