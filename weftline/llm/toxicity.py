"""Toxicity: Levenshtein automata intersected with a lexicon trie, and context windows.

The lexicon is learned from a bounded sample of labelled documents (`sample`,
by a seeded hash of doc_id; never rows whose crc32(doc_id) is 0 modulo 5):
words, and stems that many words start with, which are far commoner in toxic
documents, as many as pass that test.  Two thirds of the sample choose and weigh terms, the rest fits a
small logistic regression over a document's hits, so that chance terms do not
flatter themselves.

The terms' trie is intersected with the automaton of edit distance 1 and
determinised once on the driver; exact words, misspelled words and stems are
then read off one table of transitions.  A word one edit from a term counts as
its misspelling at `MISSPELT` of its weight, unless clean documents of the
sample use that word, or use more than `DENSE` words so near to the term.  On the executors all words of a
chunk step through the table together, one character at a time, and words
leave as soon as their state is dead, which is after two or three characters
for most.

A hit whose window of `WINDOW` characters has a quotation mark on both sides
counts as quotation, at a fraction `QUOTED` of abuse.

Edge cases: null and empty texts have no hits and score by the intercept; so
do all documents if there is no label, or none of one kind; repeated rows are
scored each; texts are read whole; an empty table gives an empty result; extra
columns are never read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm._text import CONT, chunks, crc_mod, documents, labelled_sample, map_text, splitmix

SAMPLE = 12_000
SAMPLE_BYTES = 256 << 20
FUZZY_LENGTH = 4
#: A term with more neighbours than this in clean documents stands among words of its like, so its neighbours tell nothing.
DENSE = 3
#: A misspelled word's weight, as a part of the term's.
MISSPELT = 0.8
WINDOW = 40
QUOTED = 0.3
THRESHOLD = 0.5
STEM = range(4, 9)
FEATURES = 3
#: Kinds of term: one that may be misspelled, a stem, one that is matched exactly only.
WORD, STEMS, EXACT = 0, 1, 2

_POINTS = 0x110000
_LOWER = np.arange(_POINTS, dtype=np.uint32)
_ALNUM = np.zeros(_POINTS, bool)
for _i in (*range(0xD800), *range(0xE000, 0x32400)):  # beyond, no code point is a letter or a digit
    _c = chr(_i)
    _ALNUM[_i] = _c.isalnum()
    if len(_c.lower()) == 1:
        _LOWER[_i] = ord(_c.lower())
_SPACE = np.zeros(_POINTS, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_QUOTE = np.zeros(_POINTS, bool)
_QUOTE[[ord(c) for c in "\"“”„«»‘’"]] = True


def characters(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points and the documents' offsets among them."""
    points = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    place = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(~CONT[buf], out=place[1:])
    return _LOWER[points], place[off]


def word_sets(texts: list[str]) -> list[set[str]]:
    """The distinct words of each text, by the tokens that scoring sees."""
    out: list[set[str]] = []
    for lo, hi, buf, off in chunks(pa.array(texts, pa.string())):
        points, place = characters(buf, off)
        whole = points.astype("<u4").tobytes().decode("utf-32-le")
        sets = [set() for _ in range(lo, hi)]
        for s, e, d in zip(*(x.tolist() for x in tokens(points, place)), strict=True):
            sets[d].add(whole[s:e])
        out += sets
    return out


def tokens(points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and documents of white-space words, cut to their first and last letter or digit."""
    z = np.zeros(0, np.int64)
    if not len(points):
        return z, z, z
    ink = ~_SPACE[points]
    edge = np.zeros(len(points) + 1, bool)
    edge[off] = True
    before, after = np.ones(len(points), bool), np.ones(len(points), bool)
    before[1:], after[:-1] = ~ink[:-1], ~ink[1:]
    s = np.flatnonzero(ink & (before | edge[:-1]))
    e = np.flatnonzero(ink & (after | edge[1:])) + 1
    solid = np.flatnonzero(_ALNUM[points])
    i, j = np.searchsorted(solid, s), np.searchsorted(solid, e)
    ok = j > i
    s, e = solid[i[ok]], solid[j[ok] - 1] + 1
    return s, e, np.searchsorted(off, s, "right") - 1


@dataclass
class Automaton:
    """Transitions by state and character class; of each state the term it accepts there, exactly, misspelled or as a stem."""

    classes: np.ndarray
    step: np.ndarray
    exact: np.ndarray
    fuzzy: np.ndarray
    stem: np.ndarray

    @classmethod
    def build(cls, terms: list[tuple[str, int]]) -> Automaton:
        """terms: (text, kind)."""
        letters = sorted({ord(c) for t, _ in terms for c in t})
        classes = np.zeros(letters[-1] + 2, np.int32)  # the last one stands for all code points beyond
        classes[letters] = np.arange(1, len(letters) + 1)
        children: list[dict[int, int]] = [{}]
        word: dict[int, int] = {}
        stem: dict[int, int] = {}
        bent: set[int] = set()  # nodes of words that may be misspelled
        below: dict[int, bool] = {}  # nodes on the way to a word that may be misspelled
        for k, (text, kind) in enumerate(terms):
            node = 0
            for c in text:
                node = children[node].setdefault(int(classes[ord(c)]), len(children))
                if node == len(children):
                    children.append({})
                if kind == WORD and len(text) >= FUZZY_LENGTH:
                    below[node] = True
            (stem if kind == STEMS else word)[node] = k
            if kind == WORD and len(text) >= FUZZY_LENGTH:
                bent.add(node)
        below[0] = True

        def closed(states: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
            more = {(n, 1) for node, d in states if d == 0 for n in children[node].values() if below.get(n)}
            out = states | more
            return frozenset((n, d) for n, d in out if d == 0 or (n, 0) not in out)

        # A state also carries the longest stem passed so far.
        start = (closed({(0, 0)}), -1)
        index = {(frozenset(), -1): 0, start: 1}
        queue, rows = [start], [[0] * (len(letters) + 1)]
        exact, fuzzy, stems = [-1], [-1], [-1]
        width = len(letters) + 1
        at = 0
        while at < len(queue):
            nodes, passed = queue[at]
            at += 1
            row = []
            for c in range(width):
                to: set[tuple[int, int]] = set()
                found = passed
                for node, d in nodes:
                    child = children[node].get(c)
                    if child is not None and (d == 0 or below.get(child)):
                        to.add((child, d))
                        if d == 0 and child in stem:
                            found = stem[child]
                    if d == 0 and below.get(node):
                        to.add((node, 1))  # a letter too many
                        to.update((n, 1) for n in children[node].values() if below.get(n))  # a wrong letter
                key = (closed(to), found)
                if key not in index:
                    index[key] = len(index)
                    queue.append(key)
                row.append(index[key])
            rows.append(row)
            exact.append(next((word[n] for n, d in sorted(nodes) if d == 0 and n in word), -1))
            fuzzy.append(next((word[n] for n, d in sorted(nodes) if d == 1 and n in bent), -1))
            stems.append(passed)
        return cls(classes, np.array(rows, np.int32), np.array(exact), np.array(fuzzy), np.array(stems))

    def run(self, points: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The final state of each word; 0 if dead."""
        final = np.zeros(len(s), np.int32)
        live = np.arange(len(s))
        at, state = s.copy(), np.ones(len(s), np.int32)
        kinds = self.classes[np.minimum(points, len(self.classes) - 1)]
        while len(live):
            state = self.step[state, kinds[at]]
            at = at + 1
            ended = at >= e[live]
            final[live[ended]] = state[ended]
            go = ~ended & (state > 0)
            live, at, state = live[go], at[go], state[go]
        return final


@dataclass
class Model:
    terms: list[tuple[str, int]]
    weight: np.ndarray
    bias: float
    coef: np.ndarray
    automaton: Automaton | None = None

    def features(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        n = len(off) - 1
        x = np.zeros((n, FEATURES))
        if not self.terms or not len(buf):
            return x
        if self.automaton is None:
            self.automaton = Automaton.build(self.terms)
        points, place = characters(buf, off)
        s, e, doc = tokens(points, place)
        term, sure = self.hits(points, s, e)
        hit = np.flatnonzero(term >= 0)
        hit = hit[self.weight[term[hit]] > 0]
        term, sure, d = term[hit], sure[hit], doc[hit]
        marks = np.zeros(len(points) + 1, np.int64)
        np.cumsum(_QUOTE[points], out=marks[1:])
        lo = np.maximum(place[d], s[hit] - WINDOW)
        hi = np.minimum(place[d + 1], e[hit] + WINDOW)
        quoted = (marks[s[hit]] > marks[lo]) & (marks[hi] > marks[e[hit]])
        w = self.weight[term] * np.where(quoted, QUOTED, 1.0) * np.where(sure, 1.0, MISSPELT)
        strong = self.weight[term] >= 3
        x[:, 0] = np.log1p(np.bincount(d[strong], weights=w[strong], minlength=n))
        x[:, 1] = np.log1p(np.bincount(d[~strong], weights=w[~strong], minlength=n))
        x[:, 2] = x[:, 0] / np.log1p(np.maximum(1, np.bincount(doc, minlength=n)))
        return x

    def hits(self, points: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The term of each word (-1: none), and whether it is the term itself or its stem."""
        a = self.automaton
        state = a.run(points, s, e)
        exact, fuzzy, stem = a.exact[state], a.fuzzy[state], a.stem[state]
        return np.where(exact >= 0, exact, np.where(stem >= 0, stem, fuzzy)), (exact >= 0) | (stem >= 0)

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.features(buf, off) @ self.coef, -35, 35)))


def choose_terms(texts: list[str], toxic: list[int]) -> tuple[list[tuple[str, int]], np.ndarray]:
    """Words and stems that are commoner in toxic documents beyond chance, with their log odds."""
    bad, good = Counter(), Counter()
    heads: dict[str, Counter] = defaultdict(Counter)
    for words, y in zip(word_sets(texts), toxic, strict=True):
        own = set()
        for word in words:
            if len(word) >= 3:
                own.add((word, WORD))
                own.update((word[:k], STEMS) for k in STEM if len(word) >= k)
                if y:
                    for k in STEM:
                        if len(word) >= k:
                            heads[word[:k]][word] += 1
        (bad if y else good).update(own)
    nb, ng = max(1, sum(toxic)), max(1, len(toxic) - sum(toxic))
    scored = []
    for term, b in bad.items():
        if b < 4:
            continue
        g = good[term]
        least = ((b - 1.5 * b**0.5) / nb) / ((g + 1.5 * g**0.5 + 1) / ng)
        if least > 3:
            scored.append((term, b, float(np.clip(np.log((b + 0.5) / nb) - np.log((g + 0.5) / ng), 0, 6))))
    words = [x for x in scored if not x[0][1]]
    stems: dict[str, tuple] = {}
    for x in sorted((x for x in scored if x[0][1]), key=lambda x: (len(x[0][0]), x[0][0])):
        text = x[0][0]
        if max(heads[text].values()) <= 0.5 * x[1] and not any(text[:k] in stems for k in STEM if k < len(text)):
            stems[text] = x
    kept = sorted([*words, *stems.values()], key=lambda x: (-x[1] * x[2], x[0]))
    return [x[0] for x in kept], np.array([x[2] for x in kept])


def known_neighbours(model: Model, texts: list[str]) -> dict[int, set[str]]:
    """By term, the words of `texts` that are one edit from it: words of their own, not misspellings."""
    found: dict[int, set[str]] = defaultdict(set)
    for _, _, buf, off in chunks(pa.array(texts, pa.string())):
        points, place = characters(buf, off)
        s, e, _ = tokens(points, place)
        term, sure = model.hits(points, s, e)
        whole = points.astype("<u4").tobytes().decode("utf-32-le")
        for i in np.flatnonzero((term >= 0) & ~sure).tolist():
            found[int(term[i])].add(whole[s[i] : e[i]])
    return found


def lexicon(texts: list[str], toxic: list[int], bias: float) -> Model:
    """A model whose terms may be misspelled where that tells: words that clean documents use are no misspellings."""
    terms, weight = choose_terms(texts, toxic)
    model = Model(terms, weight, bias, np.zeros(FEATURES))
    clean = [t for t, y in zip(texts, toxic, strict=True) if not y]
    while terms:  # a word may be a neighbour of two terms, so once more after each change
        model.automaton = Automaton.build(model.terms)
        near = known_neighbours(model, clean)
        if not near:
            break
        kinds = [EXACT if len(near.get(i, ())) > DENSE else kind for i, (_, kind) in enumerate(model.terms)]
        own = sorted({w for i, some in near.items() if len(some) <= DENSE for w in some})
        model.terms = [*((t, k) for (t, _), k in zip(model.terms, kinds, strict=True)), *((w, EXACT) for w in own)]
        model.weight = np.concatenate([model.weight, np.zeros(len(own))])
    return model


def fit(texts: list[str], toxic: list[int]) -> Model:
    """The lexicon from two thirds of the rows, the regression from every third."""
    share = (sum(toxic) + 0.5) / (len(toxic) + 1.0)
    bias = float(np.log(share / (1 - share)))
    third = [i % 3 == 0 for i in range(len(texts))]
    model = lexicon([t for t, x in zip(texts, third, strict=True) if not x], [t for t, x in zip(toxic, third, strict=True) if not x], bias)
    terms = model.terms
    rest = pa.array([t for t, x in zip(texts, third, strict=True) if x], pa.string())
    y = np.array([t for t, x in zip(toxic, third, strict=True) if x], float)
    if terms and 0 < y.sum() < len(y):
        x = np.concatenate([model.features(b, o) for _, _, b, o in chunks(rest)])
        x1 = np.hstack([np.ones((len(x), 1)), x])
        w = np.zeros(FEATURES + 1)
        for _ in range(30):  # Newton's steps with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x1 @ w, -35, 35)))
            ridge = np.diag([1e-3, *[0.05] * FEATURES])
            g = x1.T @ (p - y) + ridge @ w
            step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + ridge + 1e-6 * np.eye(FEATURES + 1), g)
            w -= np.clip(step, -2, 2)
        model.bias, model.coef = float(w[0]), w[1:]
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    rows = labelled_sample(docs, labels, "toxic", sample, SAMPLE_BYTES)

    def learn(batches):
        seen = []
        for b in batches:
            seen += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)
        if not seen:
            return
        seen.sort(key=lambda r: (splitmix(r[0] & ((1 << 64) - 1)) if isinstance(r[0], int) else 0, str(r[0]), r[1] or ""))
        m = fit([r[1] or "" for r in seen], [int(r[2] > 0) for r in seen])
        numbers = [m.bias, *m.coef]
        yield pa.RecordBatch.from_arrays([pa.array([*[t for t, _ in m.terms], *["" for _ in numbers]]), pa.array([*[int(k) for _, k in m.terms], *[10 + i for i in range(len(numbers))]]), pa.array([*m.weight.tolist(), *numbers], pa.float64())], ["term", "kind", "w"])

    got = map_text(rows.repartition(1), learn, "term string, kind long, w double", "doc_id", "text", "_y").toArrow().to_pylist()
    numbers = [r["w"] for r in sorted(got, key=lambda r: r["kind"]) if r["kind"] >= 10]
    if not numbers:
        return Model([], np.zeros(0), 0.0, np.zeros(FEATURES))
    terms = [r for r in got if r["kind"] < 10]
    model = Model([(r["term"], r["kind"]) for r in terms], np.array([r["w"] for r in terms]), numbers[0], np.array(numbers[1:]))
    model.automaton = Automaton.build(model.terms) if model.terms else None
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            out = np.empty(len(b))
            for lo, hi, buf, off in chunks(b.column(1)):
                out[lo:hi] = shared.value.score(buf, off)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out)], ["doc_id", "score"])

    return map_text(docs, run, T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())]))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    scored = score(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", (crc_mod("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
