"""Secret scans: a trigram inverted index over each block of documents.

From each rule's regular expression a Boolean query over trigrams is derived:
every match must contain the trigrams of one branch.  For a block of documents
(a few megabytes) the postings of just the trigrams that some rule asks for
are built in one pass over the bytes; a rule's query intersects and unites its
postings; only documents that satisfy it are verified with the expression.
Rules without a mandatory trigram scan fully.  Index and postings live and die
with their block, so nothing is shuffled and nothing grows with the corpus.

Edge cases: a null text is empty; empty texts have no spans; offsets count
code points; a document is verified whole, however long; repeated rows are
scanned each; an empty table gives an empty result; extra columns are never
read.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from weftline.llm._spans import Span, digest_columns
from weftline.llm._text import LOWER, chunks, documents


@dataclass(frozen=True)
class Rule:
    """`accept` sees a match and says whether it counts."""

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] | None = None


#: Rules of the base, in the order in which their kinds are listed.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: m.end() - m.start() >= 16),
    Rule("hex", r"[0-9a-f]+", lambda m: m.end() - m.start() >= 32),
)
#: Rules that the method adds.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

#: A query: a disjunction of conjunctions of trigrams; None if it holds for every text.
Query = frozenset[frozenset[bytes]] | None
_MOST = 64


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, that every match of the pattern contains; None if none is mandatory."""
    strings = _Strings(pattern).branches()
    out = set()
    for parts in strings:
        need = set()
        for run in "".join(c if c is not None else "\0" for c in parts).split("\0"):
            raw = run.lower().encode()
            need.update(raw[i : i + 3] for i in range(len(raw) - 2))
        if not need:
            return None
        out.add(frozenset(need))
    # A branch whose trigrams include another's is implied by it.
    return frozenset(a for a in out if not any(b < a for b in out))


class _Strings:
    """What a pattern may match, as tuples of characters and gaps (None); a gap stands for anything.

    Read are characters and escapes, classes, groups with flags, alternatives,
    repetitions, and assertions, which match nothing.
    """

    def __init__(self, pattern: str):
        self.rest = pattern

    def _take(self, expression: str) -> re.Match | None:
        m = re.match(expression, self.rest, re.S)
        if m:
            self.rest = self.rest[m.end() :]
        return m

    def branches(self) -> list[tuple]:
        out = self._sequence()
        while self._take(r"\|"):
            out += self._sequence()
        return out

    def _sequence(self) -> list[tuple]:
        done: list[tuple] = [()]
        while self.rest and self.rest[0] not in "|)":
            options = list(dict.fromkeys(self._repeated(self._item())))
            if len(done) * len(options) > _MOST:
                options = [(None,)]
            done = list(dict.fromkeys((*a, *b) for a in done for b in options))
        return done

    def _item(self) -> list[tuple]:
        if m := self._take(r"\((?:\?(<?[=!])|\?[a-zA-Z-]*:|\?P<\w+>)?"):
            inner = self.branches()
            if not self._take(r"\)"):
                raise ValueError("a group is not closed")
            return [()] if m[1] else inner
        if m := self._take(r"\[(\^?)(\]?(?:\\.|[^\]\\])*)\]"):
            plain = not m[1] and not re.search(r"\\|.-.", m[2])
            return [(c,) for c in m[2]] if plain and 0 < len(m[2]) <= 8 else [(None,)]
        if m := self._take(r"\\x([0-9a-fA-F]{2})"):
            return [(chr(int(m[1], 16)),)]
        if m := self._take(r"\\(.)"):
            return [()] if m[1] in "bBAZ" else [(None,)] if m[1].isalnum() else [(m[1],)]
        if self._take(r"[$^]"):
            return [()]
        return [(None,)] if self._take(r"\.") else [(self._take(".")[0],)]

    def _repeated(self, inner: list[tuple]) -> list[tuple]:
        m = self._take(r"([?*+]|\{(\d*)(,?)(\d*)\})[?+]?")
        if not m:
            return inner
        least = int(m[2] or 0) if m[2] is not None else int(m[1] == "+")
        once = m[1] == "?" or (m[2] is not None and (m[4] or ("" if m[3] else m[2])) == "1")
        if not least:
            return [(), *inner] if once else [(None,)]
        return inner if once else [(*s, None) for s in inner]


class Scanner:
    """All rules, compiled, with the trigrams they ask for numbered."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = [(r, re.compile(r.pattern, re.ASCII)) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        grams = sorted({g for q in self.queries if q for c in q for g in c})
        self.number = {g: i for i, g in enumerate(grams)}
        self.codes = np.array([int.from_bytes(g, "big") for g in grams], np.int64)
        self.table = np.zeros(1 << 24, bool)
        self.table[self.codes] = True
        first = np.zeros(256, bool)
        first[[g[0] for g in grams]] = True
        self.first = first

    def postings(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Trigram by document: whether the document contains the trigram."""
        n = len(off) - 1
        out = np.zeros((len(self.codes), n), bool)
        if len(buf) < 3 or not len(self.codes):
            return out
        low = LOWER[buf]
        at = np.flatnonzero(self.first[low[:-2]])
        code = (low[at].astype(np.int64) << 16) | (low[at + 1].astype(np.int64) << 8) | low[at + 2]
        hit = self.table[code]
        at, code = at[hit], code[hit]
        doc = np.searchsorted(off, at, "right") - 1
        inside = at + 3 <= off[doc + 1]
        out[np.searchsorted(self.codes, code[inside]), doc[inside]] = True
        return out

    def candidates(self, buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """For each rule the documents that satisfy its query."""
        index = self.postings(buf, off)
        every = np.flatnonzero(off[1:] > off[:-1])
        out = []
        for q in self.queries:
            if q is None:
                out.append(every)
                continue
            ok = np.zeros(len(off) - 1, bool)
            for branch in q:
                ok |= index[[self.number[g] for g in branch]].all(0)
            out.append(np.flatnonzero(ok))
        return out

    def scan(self, texts: pa.Array) -> list[dict[int, list[Span]]]:
        """Of each text the spans by rule number."""
        found: list[dict[int, list[Span]]] = [{} for _ in range(len(texts))]
        for lo, _, buf, off in chunks(texts):
            for k, docs in enumerate(self.candidates(buf, off)):
                rule, expression = self.rules[k]
                for d in docs.tolist():
                    text = texts[lo + d].as_py()
                    spans = [(rule.kind, m.start(), m.end()) for m in expression.finditer(text) if rule.accept is None or rule.accept(m)]
                    if spans:
                        found[lo + d][k] = spans
        return found


def find_secrets(base: tuple[Rule, ...] = BASE, added: tuple[Rule, ...] = ADDED) -> Callable[[pa.Array], list[tuple[list[Span], list[Span]]]]:
    made: list[Scanner] = []

    def find(texts: pa.Array):
        if not made:
            made.append(Scanner((*base, *added)))
        out = []
        for by in made[0].scan(texts):
            every = [(s[1], k, s) for k, spans in by.items() for s in spans]
            every.sort()
            out.append(([s for _, k, s in every if k < len(base)], [s for _, _, s in every]))
        return out

    return find


def scan(docs: DataFrame, base: tuple[Rule, ...] = BASE, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """doc_id, counts of each base kind, base_sha256 and spans of every row."""
    return digest_columns(docs, tuple(r.kind for r in base), find_secrets(base, added))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(documents(spark, sf_dir))
